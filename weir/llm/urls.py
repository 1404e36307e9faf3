"""URL filters with redirect equivalence.

Rules decide by host and path. Pages that redirect to one another or name one canonical page are aliases: connected
components over these links carry a block to aliases that no rule names, and an explicit allow among them goes before it.
"""

from __future__ import annotations

import string

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weir.llm.components import components
from weir.llm.shared import small, staged

#: Rules of the query: (verdict, host, path).
RULES = [("block", "net", "/"), ("allow", "example.net", "/en/"), ("block", "example.com", "/de/"), ("allow", "org", "/fr/")]
CANONICAL = r"""(?is)<link\b(?=[^>]*\brel\s*=\s*["']?canonical\b)[^>]*?\bhref\s*=\s*["']?([^"'\s>]+)"""
REFRESH = r"""(?is)<meta\b(?=[^>]*\bhttp-equiv\s*=\s*["']?refresh\b)[^>]*?\bcontent\s*=\s*["']?[^"'>]*?\burl\s*=\s*([^"'>\s]+)"""


def host(url: Column) -> Column:
    """After the first :// up to /, ? or #, with A-Z in lower case; empty without."""
    found = F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://([^/?#]*)", 1)
    return F.translate(found, string.ascii_uppercase, string.ascii_lowercase)


def path(url: Column) -> Column:
    """What follows the host up to ? or #."""
    return F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^.*?://[^/?#]*([^?#]*)", 1)


def rule_of(host_: Column, path_: Column, rules=RULES) -> tuple[Column, Column]:
    """(rule, verdict) of the longest rule that fits; null if none does."""
    name, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for what, h, p in sorted(rules, key=lambda r: (len(r[1] + r[2]), r[1:])):  # a longer one is asked earlier
        fits = ((host_ == h) | host_.endswith(f".{h}")) & path_.startswith(p)
        name, verdict = F.when(fits, h + p).otherwise(name), F.when(fits, what).otherwise(verdict)
    return name, verdict


def target(url: Column, href: Column) -> Column:
    """The href, resolved against the page's url."""
    href = F.replace(href, F.lit("&amp;"), F.lit("&"))
    scheme, base = F.regexp_extract(url, r"(?s)^(.*?)://", 1), F.regexp_extract(url, r"(?s)^(.*?://[^/?#]*)", 1)
    folder = F.regexp_extract(url, r"(?s)^.*?://[^/?#]*((?:[^?#/]*/)*)", 1)
    return (
        F.when(href.rlike(r"^[A-Za-z][A-Za-z0-9+.-]*://"), href)
        .when(href.startswith("//"), F.concat(scheme, F.lit(":"), href))
        .when(href.startswith("/"), F.concat(base, href))
        .when(href.startswith("?") | href.startswith("#"), F.concat(base, path(url), href))
        .otherwise(F.concat(base, F.when(folder == "", "/").otherwise(folder), href))
    )


def node(url: Column) -> Column:
    """What stands for a url: a hash of host, path and query; scheme and fragment tell nothing."""
    return F.xxhash64(host(url), F.when(path(url) == "", "/").otherwise(path(url)), F.regexp_extract(F.coalesce(url, F.lit("")), r"(?s)^[^?#]*(\?[^#]*)", 1))


def judge(df: DataFrame, rules=RULES, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """(id_col, host, path, rule, verdict, by) for every row of df. by: rule, alias or default, which allows.

    A page that no rule fits takes the verdict of its aliases: allow if a rule allows any of them, else block if a rule blocks
    any. Pages that only links name count as aliases too. Rows with one url are one page. A url that is null or has no ://
    has an empty host and path and no alias. Null pages have no links; repeated rows are all judged; an empty table gives
    an empty one.
    """
    url = F.col("url")
    plain = df.select(F.col(id_col).alias("id"), F.col(url_col).alias("url"))
    html = F.coalesce(F.col(html_col), F.lit(""))
    linked = F.contains(html, F.lit("http-equiv")) | F.lower(html).rlike("canonical|http-equiv")
    hrefs = F.when(linked, F.concat(F.regexp_extract_all(html, F.lit(CANONICAL), F.lit(1)), F.regexp_extract_all(html, F.lit(REFRESH), F.lit(1)))).otherwise(F.array().cast("array<string>"))
    links = df.where(F.col(url_col).contains("://")).select(F.col(url_col).alias("url"), F.explode(F.array_distinct(hrefs)).alias("href"))
    links = staged(links.select("url", target(url, F.col("href")).alias("to")).where("to is not null").select("url", "to", node(url).alias("a"), node(F.col("to")).alias("b")).distinct(), "links")
    roots = components(links)
    ends = links.select(F.col("a").alias("node"), "url").unionByName(links.select(F.col("b").alias("node"), F.col("to").alias("url"))).distinct()
    ruled = ends.join(roots, "node").select("root", rule_of(host(url), path(url), rules)[1].alias("verdict"))
    groups = ruled.groupBy("root").agg(F.max(F.when(F.col("verdict").isNotNull(), F.when(F.col("verdict") == "allow", 2).otherwise(1))).alias("most")).where("most is not null")
    told = staged(roots.join(groups, "root").select("node", F.when(F.col("most") == 2, "allow").otherwise("block").alias("alias")), "told")
    own, verdict = rule_of(F.col("host"), F.col("path"), rules)
    judged = plain.select("id", "url", host(url).alias("host"), path(url).alias("path"), F.when(url.contains("://"), node(url)).alias("node"))
    judged = judged.withColumn("rule", own).withColumn("ruled", verdict).join(small(told), "node", "left")
    by = F.when(F.col("ruled").isNotNull(), "rule").when(F.col("alias").isNotNull(), "alias").otherwise("default")
    return judged.select(F.col("id").alias(id_col), "host", "path", "rule", F.coalesce("ruled", "alias", F.lit("allow")).alias("verdict"), by.alias("by"))


def op7_urls(spark, sf_dir: str) -> DataFrame:
    return judge(spark.read.parquet(f"{sf_dir}/pages.parquet"))


def _sql() -> str:
    """The same in SQL: what can be reached over links is found by a recursive query."""
    upper, lower = string.ascii_uppercase, string.ascii_lowercase
    host_ = lambda u: f"translate(regexp_extract(coalesce({u}, ''), '(?s)^.*?://([^/?#]*)', 1), '{upper}', '{lower}')"
    path_ = lambda u: f"regexp_extract(coalesce({u}, ''), '(?s)^.*?://[^/?#]*([^?#]*)', 1)"
    node_ = lambda u: f"concat_ws(chr(1), {host_(u)}, CASE WHEN {path_(u)} = '' THEN '/' ELSE {path_(u)} END, regexp_extract(coalesce({u}, ''), '(?s)^[^?#]*(\\?[^#]*)', 1))"
    fits = lambda h, p, rule: f"(({h} = '{rule[1]}' OR ends_with({h}, '.{rule[1]}')) AND starts_with({p}, '{rule[2]}'))"
    longest = sorted(RULES, key=lambda r: -len(r[1] + r[2]))
    case = lambda h, p, of: "CASE " + " ".join(f"WHEN {fits(h, p, r)} THEN '{of(r)}'" for r in longest) + " END"
    base = "regexp_extract(url, '(?s)^(.*?://[^/?#]*)', 1)"
    folder = "regexp_extract(url, '(?s)^.*?://[^/?#]*((?:[^?#/]*/)*)', 1)"
    return f"""
WITH RECURSIVE found AS (
  SELECT url, unnest(list_concat(
    list_transform(list_filter(regexp_extract_all(coalesce(html, ''), '(?is)<link\\b[^>]*>'), lambda t: regexp_matches(t, '(?is)\\brel\\s*=\\s*["'']?canonical\\b')), lambda t: regexp_extract(t, '(?is)\\bhref\\s*=\\s*["'']?([^"''\\s>]+)', 1)),
    list_transform(list_filter(regexp_extract_all(coalesce(html, ''), '(?is)<meta\\b[^>]*>'), lambda t: regexp_matches(t, '(?is)\\bhttp-equiv\\s*=\\s*["'']?refresh\\b')), lambda t: regexp_extract(t, '(?is)\\bcontent\\s*=\\s*["'']?[^"''>]*?\\burl\\s*=\\s*([^"''>\\s]+)', 1)))) AS raw
  FROM pages WHERE contains(url, '://')),
href AS (SELECT url, replace(raw, '&amp;', '&') AS h FROM found WHERE raw <> ''),
link AS (SELECT url, CASE WHEN regexp_matches(h, '^[A-Za-z][A-Za-z0-9+.-]*://') THEN h WHEN starts_with(h, '//') THEN regexp_extract(url, '(?s)^(.*?)://', 1) || ':' || h WHEN starts_with(h, '/') THEN {base} || h
    WHEN starts_with(h, '?') OR starts_with(h, '#') THEN {base} || {path_('url')} || h ELSE {base} || CASE WHEN {folder} = '' THEN '/' ELSE {folder} END || h END AS too FROM href),
edge AS (SELECT {node_('url')} AS a, {node_('too')} AS b FROM link UNION SELECT {node_('too')}, {node_('url')} FROM link),
ends AS (SELECT {node_('url')} AS node, url FROM link UNION SELECT {node_('too')}, too FROM link),
ruled AS (SELECT node, max(CASE {case(host_('url'), path_('url'), lambda r: r[0])} WHEN 'allow' THEN 2 WHEN 'block' THEN 1 END) AS most FROM ends GROUP BY 1),
reach(node, way) AS (SELECT DISTINCT a, a FROM edge UNION SELECT reach.node, edge.b FROM reach JOIN edge ON edge.a = reach.way),
alias AS (SELECT reach.node, max(most) AS most FROM reach JOIN ruled ON ruled.node = reach.way GROUP BY 1),
page AS (SELECT page_id, url, {host_('url')} AS host, {path_('url')} AS path, CASE WHEN contains(url, '://') THEN {node_('url')} END AS node FROM pages),
own AS (SELECT *, {case('host', 'path', lambda r: r[1] + r[2])} AS rule, {case('host', 'path', lambda r: r[0])} AS said FROM page)
SELECT page_id, host, path, rule, coalesce(said, CASE most WHEN 2 THEN 'allow' WHEN 1 THEN 'block' END, 'allow') AS verdict,
  CASE WHEN said IS NOT NULL THEN 'rule' WHEN most IS NOT NULL THEN 'alias' ELSE 'default' END AS by
FROM own LEFT JOIN alias ON own.node = alias.node"""


OP7_SQL = _sql()
