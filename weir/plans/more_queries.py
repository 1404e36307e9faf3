"""Queries of sources, sinks, readers and acquisition: what they read is made of the driver's tables, through the shared
folder where an operator reads files, and the SQL says what must come out."""

from __future__ import annotations

import os

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weir import schema
from weir.acquire import client, fetch
from weir.functions import html, license, text
from weir.operators import catalog, discovery, walk
from weir.plans import ingest
from weir.plans.queries import _DOC, _spdx, document_raw, pick, query, table
from weir.sinks import catalog as sink
from weir.sinks import corpus
from weir.sources import records, trees
from weir.sources.records import make
from weir.stage import local_path, scratch, spread, staged
from weir.streaming import mirror, paging, upsert

# ---- files made of tables ----------------------------------------------------------------------------------------------


def written(df: DataFrame, column: Column, name: str) -> str:
    """One text file, in the shared folder, with a line for each row."""
    path = scratch(df.sparkSession, name)
    df.select(column.alias("value")).coalesce(1).write.text(path)
    return path


def nations(spark, sf_dir) -> DataFrame:
    k = F.col("n_nationkey")
    return table(spark, sf_dir, "nation").orderBy(k).select(k.alias("k"), F.col("n_name").alias("name"), F.col("n_regionkey").alias("r"))


def yaml_file(spark, sf_dir) -> str:
    """Nations as a list of challenges; every seventh has no name."""
    k, none = F.col("k"), F.lit(None).cast("string")
    entry = F.struct(
        F.when(k % 7 != 0, F.col("name")).alias("name"), pick(["XSS", "Broken Access Control", "Cryptographic Issues"], k % 3).alias("category"), (k % 6 + 1).alias("difficulty"),
        F.when(k % 2 == 0, F.concat(F.lit("Tag "), k.cast("string"), F.lit(", , two"))).alias("tags"), F.when(k % 4 == 0, F.concat(F.lit("https://m.org/"), k.cast("string"))).otherwise(none).alias("mitigationUrl"),
        F.when(k % 5 == 0, F.concat(F.lit("https://h.org/"), k.cast("string"))).otherwise(none).alias("hintUrl"),
    )
    return written(nations(spark, sf_dir), F.concat(F.lit("- "), F.to_json(entry)), "list-yaml")


@query("SRC-01", "SELECT s AS source, f AS field, n::INTEGER AS nth FROM (SELECT unnest(['event_pages', 'saved_pages', 'yaml_list']) AS s), (SELECT unnest(['origin', 'title', 'event_name', 'edition', 'year', 'raw_category', 'tags', 'difficulty', 'points', 'description', 'flag', 'local_dir', 'files', 'writeups', 'source', 'extra']) AS f, generate_subscripts(['origin', 'title', 'event_name', 'edition', 'year', 'raw_category', 'tags', 'difficulty', 'points', 'description', 'flag', 'local_dir', 'files', 'writeups', 'source', 'extra'], 1) - 1 AS n)")
def src_01(spark, sf_dir):
    """The contract that every source's result has, whatever it reads."""
    made = {"yaml_list": {"path": yaml_file(spark, sf_dir)}, "saved_pages": {"path": pages_table(spark, sf_dir)}, "event_pages": {"path": event_folder(spark, sf_dir)}}
    rows = [(name, f.name, i) for name, options in made.items() for i, f in enumerate(records.REGISTRY[name](spark, **options).schema)]
    return spark.createDataFrame(rows, "source string, field string, nth int")


@query("SRC-02", "SELECT unnest(['checkouts', 'event_pages', 'saved_pages', 'yaml_list']) AS source")
def src_02(spark, sf_dir):
    return spark.createDataFrame([(n,) for n in sorted(records.REGISTRY)], "source string")


_YAML = "(SELECT n_nationkey AS k, n_name AS name FROM nation WHERE n_nationkey % 7 <> 0)"


@query(
    "SRC-03",
    f"SELECT name AS title, ['XSS', 'Broken Access Control', 'Cryptographic Issues'][k % 3 + 1] AS raw_category, (k % 6 + 1)::VARCHAR AS difficulty, CASE WHEN k % 2 = 0 THEN 'Tag ' || k || '|two' ELSE '' END AS tags, 'OWASP Juice Shop' AS event_name, 'MIT' AS spdx_id FROM {_YAML}",
)
def src_03(spark, sf_dir):
    found = records.yaml_list(spark, yaml_file(spark, sf_dir))
    return found.select("title", "raw_category", "difficulty", F.array_join("tags", "|").alias("tags"), "event_name", "source.license.spdx_id")


@query(
    "SRC-03b",
    f"SELECT name AS title, 'Mitigation' AS note, 'https://m.org/' || k AS url, false AS is_inline FROM {_YAML} WHERE k % 4 = 0 UNION ALL SELECT name, 'Hint', 'https://h.org/' || k, false FROM {_YAML} WHERE k % 5 = 0",
)
def src_03b(spark, sf_dir):
    found = records.yaml_list(spark, yaml_file(spark, sf_dir)).select("title", F.explode("writeups").alias("w"))
    return found.select("title", F.col("w.title").alias("note"), "w.url", "w.is_inline")


@query("SRC-04", "SELECT DISTINCT 'https://h.org/' || lang || '/challenges/c' || doc_id % 50 || '/' AS url FROM documents WHERE doc_id % 3 <> 0")
def src_04(spark, sf_dir):
    """A sitemap with repeats, and locations of other kinds."""
    d = F.col("doc_id")
    kind = F.when(d % 3 == 0, "/about/c").otherwise("/challenges/c")
    loc = F.concat(F.lit("<url><loc> https://h.org/"), F.col("lang"), kind, (d % 50).cast("string"), F.lit("/ </loc></url>"))
    whole = table(spark, sf_dir, "documents").agg(F.concat(F.lit("<urlset>"), F.array_join(F.collect_list(loc), "\n"), F.lit("</urlset>")).alias("x"))  # a sitemap is one document
    path = written(whole, F.col("x"), "sitemap")
    return records.read_sitemap(spark, path).select("url")


# ---- challenge pages ---------------------------------------------------------------------------------------------------


def challenge_pages(spark, sf_dir) -> DataFrame:
    """(k, url, html): a page for each part, some without a title, stars, authors or files."""
    k = F.col("p_partkey")
    at = lambda cond, *parts: F.when(cond, F.concat(*[p if isinstance(p, Column) else F.lit(p) for p in parts])).otherwise("")
    always = F.lit(True)
    page = F.concat(
        F.lit("<html><head>"), at(k % 5 != 0, '<meta property="og:title" content="', F.col("p_name"), '">'), at(k % 3 == 0, '<meta name="keywords" content=" ', F.lower("p_type"), ', ctf">'), F.lit("</head><body>"),
        at(k % 10 != 0, "<h1>", F.col("p_brand"), "</h1>"), at(always, '<a class="badge big" href="/en/challenges/web/">Web</a>'), at(k % 4 != 0, '<a class="badge" href="/ctf/cup-', (k % 9 + 2015).cast("string"), '/">Cup ', (k % 9 + 2015).cast("string"), "</a>"),
        at(k % 2 == 0, '<a class="badge" href="/tags/t', (k % 13).cast("string"), '/">T</a>'), F.repeat(F.lit('<svg><use href="#star-fill"></use></svg>'), (k % 4).cast("int")),
        at(k % 6 != 0, '<div class="markdown"><h2>About</h2><p> It is ', F.col("p_name"), " </p><p>size ", F.col("p_size").cast("string"), "</p></div>"),
        at(k % 3 != 0, '<div><img class="avatar" src="a.png"><span class="font-monospace">by', (k % 21).cast("string"), "</span></div>"),
        at(k % 7 == 0, '<a href="/en/writeups/w', k.cast("string"), '">a</a><a href="/en/writeups/w', k.cast("string"), '">b</a>'),
        at(always, '<ul class="list-file"><li><a href="/f/', k.cast("string"), '.zip" download="dir/own.zip">x</a></li><li><a href="g/', k.cast("string"), '.txt">named.txt</a></li><li><a href="/h/last.bin?v=1"></a></li></ul>'),
        F.lit("</body></html>"),
    )
    url = F.concat(F.lit("https://h.org/en/challenges/"), F.when(k % 8 != 0, F.concat(pick(["web", "pwn", "misc"], k % 3), F.lit("/"))).otherwise(""), F.lit("part-"), k.cast("string"), F.when(k % 11 == 0, "-2019").otherwise(""), F.lit("/"))
    narrow = spread(table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_type", "p_brand", "p_size"))
    return narrow.select(k.alias("k"), url.alias("url"), F.when(k % 40 != 0, page).alias("html"))


def pages_table(spark, sf_dir) -> str:
    path = scratch(spark, "pages")
    challenge_pages(spark, sf_dir).select("url", "html").write.parquet(path)
    return path


def read_pages(spark, sf_dir) -> DataFrame:
    """(k, url, p) of the pages, with what the reader finds in each."""
    found = challenge_pages(spark, sf_dir).select("k", "url", html.parsed(html.challenge_page, F.col("html"), F.col("url")).alias("p"))
    return staged(found, "read").where("k % 40 <> 0")


_P = "(SELECT *, p_partkey AS k FROM part WHERE p_partkey % 40 <> 0)"
_LABEL = "CASE WHEN k % 8 <> 0 THEN ['web', 'pwn', 'misc'][k % 3 + 1] WHEN k % 3 = 0 THEN lower(p_type) END"
_EVENT = "CASE WHEN k % 4 <> 0 THEN 'Cup ' || (k % 9 + 2015) ELSE 'Hackropole' END"
_TAGS = f"array_to_string(list_concat(CASE WHEN {_LABEL} = 'web' THEN [] ELSE ['web'] END, CASE WHEN k % 2 = 0 THEN ['t' || k % 13] ELSE [] END), '|')"
_TITLE = "CASE WHEN k % 5 <> 0 THEN p_name WHEN k % 10 <> 0 THEN p_brand ELSE 'part-' || k || CASE WHEN k % 11 = 0 THEN '-2019' ELSE '' END END"


@query("SRC-05", f"SELECT {_TITLE} AS title, {_EVENT} AS event_name, {_LABEL} AS raw_category, 'https://h.org/en/challenges/' || CASE WHEN k % 8 <> 0 THEN ['web', 'pwn', 'misc'][k % 3 + 1] || '/' ELSE '' END || 'part-' || k || CASE WHEN k % 11 = 0 THEN '-2019' ELSE '' END || '/' AS url FROM {_P}")
def src_05(spark, sf_dir):
    """Pages to raw records; one that can't be read has none."""
    found = records.saved_pages(spark, pages_table(spark, sf_dir))
    return found.select("title", "event_name", "raw_category", "source.url")


@query("FN-10", f"SELECT k, CASE WHEN k % 5 <> 0 THEN p_name END AS og_title, CASE WHEN k % 3 = 0 THEN lower(p_type) || ', ctf' END AS keywords FROM {_P}")
def fn_10(spark, sf_dir):
    return read_pages(spark, sf_dir).select("k", "p.og_title", "p.keywords")


@query("FN-11", f"SELECT {_TITLE} AS title, {_EVENT} AS event_name, {_TAGS} AS tags FROM {_P}")
def fn_11(spark, sf_dir):
    found, _ = records.page_records(challenge_pages(spark, sf_dir))
    return found.select("title", "event_name", F.array_join("tags", "|").alias("tags"))


@query("FN-12", f"SELECT k, CASE WHEN k % 6 <> 0 THEN 'It is ' || p_name || 'size ' || p_size END AS description FROM {_P}")
def fn_12(spark, sf_dir):
    return read_pages(spark, sf_dir).select("k", "p.description")


@query("FN-13", f"SELECT k, CASE WHEN k % 3 <> 0 THEN 'by' || k % 21 ELSE '' END AS authors FROM {_P}")
def fn_13(spark, sf_dir):
    return read_pages(spark, sf_dir).select("k", F.array_join("p.authors", "|").alias("authors"))


@query("FN-14", f"SELECT k, CASE WHEN k % 7 = 0 THEN 'https://h.org/en/writeups/w' || k ELSE '' END AS writeups FROM {_P}")
def fn_14(spark, sf_dir):
    return read_pages(spark, sf_dir).select("k", F.array_join("p.writeups", "|").alias("writeups"))


_PAGE_URL = "'https://h.org/en/challenges/' || CASE WHEN k % 8 <> 0 THEN ['web', 'pwn', 'misc'][k % 3 + 1] || '/' ELSE '' END || 'part-' || k || CASE WHEN k % 11 = 0 THEN '-2019' ELSE '' END || '/'"


@query("FN-15", f"SELECT k, unnest([0, 1, 2])::INTEGER AS nth, unnest(['own.zip', 'named.txt', 'last.bin']) AS name, unnest(['https://h.org/f/' || k || '.zip', {_PAGE_URL} || 'g/' || k || '.txt', 'https://h.org/h/last.bin?v=1']) AS url FROM {_P}")
def fn_15(spark, sf_dir):
    return read_pages(spark, sf_dir).select("k", F.posexplode("p.files").alias("nth", "f")).select("k", "nth", "f.name", "f.url")


@query("FN-16", f"SELECT {_TITLE} AS title, CASE WHEN k % 4 <> 0 THEN (k % 9 + 2015)::VARCHAR ELSE nullif(regexp_extract('part-' || k || CASE WHEN k % 11 = 0 THEN '-2019' ELSE '' END, '(?:19|20)\\d{{2}}'), '') END AS year, CASE WHEN k % 4 > 0 THEN (k % 4) || '/5' END AS difficulty, 'etalab-2.0' AS spdx_id FROM {_P}")
def fn_16(spark, sf_dir):
    found, _ = records.page_records(challenge_pages(spark, sf_dir))
    return found.select("title", F.col("year").cast("string").alias("year"), "difficulty", "source.license.spdx_id")


@query("FN-07", "SELECT page_id, regexp_extract(regexp_extract(url, '^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)', 1), '([^/]*)/*$', 1) AS slug, NULL::VARCHAR AS category FROM pages UNION ALL SELECT k, 'part-' || k || CASE WHEN k % 11 = 0 THEN '-2019' ELSE '' END, CASE WHEN k % 8 <> 0 THEN ['web', 'pwn', 'misc'][k % 3 + 1] END FROM (SELECT p_partkey AS k FROM part)")
def fn_07(spark, sf_dir):
    rows = table(spark, sf_dir, "pages").select("page_id", "url").union(challenge_pages(spark, sf_dir).select("k", "url"))
    return rows.select("page_id", text.url_slug(F.col("url")).alias("slug"), text.url_category(F.col("url")).alias("category"))


# ---- event pages -------------------------------------------------------------------------------------------------------


def event_tables(spark, sf_dir) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """Customers as events, their orders as tasks, and of each fourth order two writeups."""
    c, o = table(spark, sf_dir, "customer"), table(spark, sf_dir, "orders")
    k, t = F.col("c_custkey"), F.col("o_orderkey")
    none = F.lit(None).cast("string")
    events = c.select(
        k.alias("id"), (k + 5).alias("ctf_id"), F.when(k % 9 != 0, F.col("c_name")).otherwise("").alias("title"), F.when(k % 10 != 0, F.concat((k % 20 + 2001).cast("string"), F.lit("-03-01T10:00:00+00:00"))).alias("start"),
        none.alias("finish"), F.col("c_acctbal").alias("weight"), F.lit("Jeopardy").alias("format"), none.alias("ctftime_url"), none.alias("url"),
    )
    row = F.concat(
        F.lit('<tr><td><a href="/task/'), t.cast("string"), F.lit('">'), F.when(t % 6 != 0, F.concat(F.lit("Task "), t.cast("string"))).otherwise(""), F.lit("</a></td><td> "), (t % 500).cast("string"), F.lit(' pts</td><td><span class="label">'),
        pick(["zig", "pwn", "heap"], t % 3), F.lit('</span><span class="label">'), pick(["web", "x"], t % 2), F.lit('</span></td><td><a href="/task/'), t.cast("string"), F.lit('">2</a></td></tr>'),
    )
    page = F.concat(F.lit('<table class="table table-striped"><tr><th>Name</th></tr>'), F.array_join(F.array_sort(F.collect_list(row)), ""), F.lit("</table>"))
    tasks = spread(o.select("o_custkey", "o_orderkey"), "o_custkey").groupBy(F.col("o_custkey").alias("event_id")).agg(page.alias("html"))
    rows = lambda i: F.concat(F.lit('<tr><td><a href="/writeup/'), (t * 2 + i).cast("string"), F.lit('">w</a></td><td>'), F.when((t + i) % 3 == 0, "not rated").otherwise(((t + i) % 5).cast("string")), F.lit('</td><td><a href="/team/7">Team '), (t % 30).cast("string"), F.lit("</a></td></tr>"))
    some = spread(o.where(t % 4 == 0).select("o_orderkey"))
    lists = some.select(t.alias("task_id"), F.concat(F.lit("<table>"), rows(0), rows(1), F.lit("</table>")).alias("html"))
    own = F.concat(F.lit('<div class="well" id="id_description"> body '), F.col("w").cast("string"), F.lit(" </div>"))
    away = F.concat(F.lit('<div class="well">Original writeup: <a href="'), pick(["https://github.com/a/", "https://blog.org/"], F.col("w") % 2), F.col("w").cast("string"), F.lit('">here</a></div>'))
    body = F.concat(F.when(F.col("w") % 3 == 0, own).otherwise(""), F.when(F.col("w") % 5 < 2, away).otherwise(""))
    writeups = some.select(F.explode(F.array(t * 2, t * 2 + 1)).alias("w")).select(F.col("w").alias("writeup_id"), body.alias("html"))
    return events, tasks, lists, writeups


def event_folder(spark, sf_dir) -> str:
    """The recorded pages as a folder that the source `event_pages` reads."""
    path = scratch(spark, "event-pages")
    events, tasks, lists, writeups = event_tables(spark, sf_dir)
    one = events.agg(F.to_json(F.sort_array(F.collect_list(F.struct(*events.columns)))).alias("value"))  # a feed is one JSON list
    one.coalesce(1).write.text(f"{path}/events.json")
    for name, df in (("tasks", tasks), ("lists", lists), ("writeups", writeups)):
        df.write.parquet(f"{path}/{name}")
    return path


_TASK = "(SELECT o_orderkey AS t, o_custkey AS c FROM orders)"
_NAME = "CASE WHEN t % 6 <> 0 THEN 'Task ' || t ELSE 'task-' || t END"
_WRITEUP = "(SELECT o_orderkey AS t, o_orderkey * 2 + i AS w, i FROM orders, (SELECT unnest([0, 1]) AS i) WHERE o_orderkey % 4 = 0)"


@query("SRC-07-capped", "WITH e AS (SELECT c_custkey AS k FROM customer ORDER BY CASE WHEN c_custkey % 10 <> 0 THEN c_custkey % 20 END NULLS LAST, c_custkey LIMIT 20) SELECT 'https://ctftime.org/task/' || o_orderkey AS url FROM orders WHERE o_custkey IN (SELECT k FROM e)")
def src_07_capped(spark, sf_dir):
    """The tasks of the first twenty events."""
    return records.task_records(*event_tables(spark, sf_dir), max_events=20).select("source.url")


@query("FN-17", f"SELECT c AS event_id, t AS id, {_NAME} AS name, (t % 500) || ' pts' AS points, ['zig', 'pwn', 'heap'][t % 3 + 1] || '|' || ['web', 'x'][t % 2 + 1] AS tags FROM {_TASK}")
def fn_17(spark, sf_dir):
    found = html.table_rows(html.task_rows, event_tables(spark, sf_dir)[1])
    return found.select("event_id", "id", "name", "points", F.array_join("tags", "|").alias("tags"))


@query("FN-18", f"SELECT t AS task_id, w AS id, CASE WHEN (t + i) % 3 = 0 THEN 'not rated' ELSE ((t + i) % 5)::VARCHAR END AS rating, 'Team ' || t % 30 AS author FROM {_WRITEUP}")
def fn_18(spark, sf_dir):
    return html.table_rows(html.writeup_rows, event_tables(spark, sf_dir)[2]).select("task_id", "id", "rating", "author")


@query("FN-19", f"SELECT w AS writeup_id, CASE WHEN w % 3 = 0 THEN 'body ' || w END AS body FROM {_WRITEUP}")
def fn_19(spark, sf_dir):
    return event_tables(spark, sf_dir)[3].select("writeup_id", html.parsed(html.writeup_page, F.col("html"))["body"].alias("body"))


@query("FN-20", f"SELECT w AS writeup_id, CASE WHEN w % 5 < 2 THEN ['https://github.com/a/', 'https://blog.org/'][w % 2 + 1] || w END AS external FROM {_WRITEUP}")
def fn_20(spark, sf_dir):
    return event_tables(spark, sf_dir)[3].select("writeup_id", html.parsed(html.writeup_page, F.col("html"))["external"].alias("external"))


@query(
    "SRC-07",
    f"""SELECT {_NAME} AS title, CASE WHEN c % 9 <> 0 THEN 'Customer#' || lpad(c::VARCHAR, 9, '0') ELSE 'unknown-event' END AS event_name, (CASE WHEN c % 10 <> 0 THEN c % 20 + 2001 END)::VARCHAR AS year,
  CASE t % 3 WHEN 1 THEN 'pwn' ELSE CASE WHEN t % 2 = 0 THEN 'web' WHEN t % 3 = 0 THEN 'zig' ELSE 'heap' END END AS raw_category, (t % 500)::INTEGER AS points, CASE WHEN t % 4 = 0 THEN 2 ELSE 0 END AS writeups, 'https://ctftime.org/task/' || t AS url
FROM {_TASK}""",
)
def src_07(spark, sf_dir):
    """Events to tasks to writeups, one raw record for each task."""
    made = records.task_records(*event_tables(spark, sf_dir))
    return made.select("title", "event_name", F.col("year").cast("string").alias("year"), "raw_category", "points", F.size("writeups").alias("writeups"), "source.url")


@query(
    "SRC-19",
    f"""SELECT 'https://ctftime.org/task/' || t AS task, CASE WHEN w % 3 = 0 THEN 'https://ctftime.org/writeup/' || w WHEN w % 5 < 2 THEN ['https://github.com/a/', 'https://blog.org/'][w % 2 + 1] || w ELSE 'https://ctftime.org/writeup/' || w END AS url,
  CASE WHEN w % 3 = 0 THEN 'ctftime' WHEN w % 5 < 2 THEN ['github', 'other'][w % 2 + 1] ELSE 'ctftime' END AS origin, w % 3 = 0 AS is_inline, (CASE WHEN (t + i) % 3 <> 0 THEN (t + i) % 5 END)::VARCHAR AS rating FROM {_WRITEUP}""",
)
def src_19(spark, sf_dir):
    """Each writeup is inline, elsewhere or a bare reference."""
    made = records.task_records(*event_tables(spark, sf_dir)).select(F.col("source.url").alias("task"), F.explode("writeups").alias("w"))
    return made.select("task", "w.url", "w.origin", "w.is_inline", F.col("w.rating").cast("long").cast("string").alias("rating"))


@query("SRC-20", "SELECT c_custkey AS id, CASE WHEN c_custkey % 9 <> 0 THEN c_name ELSE 'unknown-event' END AS name, (CASE WHEN c_custkey % 10 <> 0 THEN c_custkey % 20 + 2001 END)::VARCHAR AS year, c_custkey + 5 AS series FROM customer")
def src_20(spark, sf_dir):
    return records.events(event_tables(spark, sf_dir)[0]).select("id", "event.name", F.col("event.year").cast("string").alias("year"), F.col("event.ctftime_series_id").alias("series"))


def feed_folder(spark, sf_dir) -> str:
    """The events as a recorded feed of JSON lines."""
    path = scratch(spark, "feed")
    start = F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    table(spark, sf_dir, "events").select(F.col("event_id").alias("id"), F.col("event_type").alias("title"), start.alias("start")).write.json(path)
    return path


def streamed(df: DataFrame, name: str) -> DataFrame:
    """All of a stream that is there, as a table of the shared folder."""
    spark, path = df.sparkSession, scratch(df.sparkSession, name)
    q = df.writeStream.format("parquet").option("checkpointLocation", f"{path}/check").start(f"{path}/rows")
    try:
        q.processAllAvailable()
    finally:
        q.stop()
    return spark.read.schema(df.schema).parquet(f"{path}/rows")


@query("SRC-06", "SELECT event_id AS id, event_type AS title FROM events")
def src_06(spark, sf_dir):
    """A feed page by page: windows slide over the start times, and what stands on two pages comes once."""
    n = table(spark, sf_dir, "events").count()
    return streamed(paging.event_stream(spark, feed_folder(spark, sf_dir), max(100, n // 8)), "feed").select("id", "title")


@query("INC-01", "WITH e AS (SELECT event_id AS id, floor(epoch(ts))::BIGINT AS s FROM events) SELECT id, s FROM e")
def inc_01(spark, sf_dir):
    n = table(spark, sf_dir, "events").count()
    found = streamed(paging.event_stream(spark, feed_folder(spark, sf_dir), max(100, n // 5)), "window")
    return found.select("id", text.epoch(F.col("start")).alias("s"))


# ---- repositories ------------------------------------------------------------------------------------------------------


@query("SRC-10", "SELECT (row_number() OVER (ORDER BY n_nationkey % 3, n_nationkey) - 1)::INTEGER AS pos, ['official_sources', 'community_archives', 'writeup_archives'][n_nationkey % 3 + 1] AS section, 'o/' || n_name AS repo, n_nationkey % 2 = 0 AS official, CASE WHEN n_nationkey % 4 = 0 THEN 'MIT' END AS license FROM nation")
def src_10(spark, sf_dir):
    return records.read_seeds(spark, seed_file(spark, sf_dir)).select("pos", "section", "repo", "official", "license")


def seed_file(spark, sf_dir) -> str:
    """Nations as curated repositories, their sections in another order than they are read."""
    k = F.col("k")
    entry = F.struct(F.concat(F.lit("o/"), F.col("name")).alias("repo"), (k % 2 == 0).alias("official"), F.when(k % 4 == 0, "MIT").alias("license"), F.lit("sources").alias("kind"))
    rows = nations(spark, sf_dir).select((2 - k % 3).alias("s"), F.array_sort(F.array(F.struct(k, entry.alias("e")))).alias("es"))
    groups = rows.groupBy("s").agg(F.array_sort(F.flatten(F.collect_list("es"))).alias("es"))
    section = pick(["writeup_archives", "community_archives", "official_sources"], F.col("s"))
    return written(groups.orderBy("s"), F.concat(section, F.lit(": "), F.to_json(F.transform("es", lambda x: x["e"]))), "seeds-yaml")


def api_items(spark, sf_dir) -> DataFrame:
    """(page, item): customers as a search service's objects, ten to a page."""
    k, none = F.col("c_custkey"), F.lit(None).cast("string")
    item = F.struct(
        F.concat(F.lit("o"), (k % 7).cast("string"), F.lit("/"), pick(["ctf-writeups", "tasks", "plain"], k % 3), k.cast("string")).alias("full_name"), F.when(k % 4 != 0, F.concat(F.lit("https://x.org/"), k.cast("string"))).alias("html_url"),
        F.when(k % 5 != 0, (k % 90).cast("int")).alias("stargazers_count"), F.when(k % 6 == 0, "no date").otherwise("2024-02-03T04:05:06Z").alias("pushed_at"), none.alias("created_at"),
        F.when(k % 2 == 0, F.array(F.lit("ctf"), none, F.concat(F.lit("t"), (k % 3).cast("string")))).alias("topics"), F.col("c_name").alias("description"),
        F.struct(pick(["MIT", "NOASSERTION", "", "GPL-3.0-only"], k % 4).alias("spdx_id")).alias("license"), F.lit("main").alias("default_branch"), F.when(k % 3 != 0, k * 10).alias("size"),
    )
    return table(spark, sf_dir, "customer").select(F.floor((k - 1) / 10).alias("page"), k.alias("k"), item.alias("item"))


_ITEM = """SELECT 'o' || c_custkey % 7 || '/' || ['ctf-writeups', 'tasks', 'plain'][c_custkey % 3 + 1] || c_custkey AS full_name, CASE WHEN c_custkey % 4 <> 0 THEN 'https://x.org/' || c_custkey ELSE 'https://github.com/o' || c_custkey % 7 || '/' || ['ctf-writeups', 'tasks', 'plain'][c_custkey % 3 + 1] || c_custkey END AS html_url,
  CASE WHEN c_custkey % 5 <> 0 THEN c_custkey % 90 ELSE 0 END::INTEGER AS stars, (CASE WHEN c_custkey % 6 <> 0 THEN 1706933106 END)::VARCHAR AS pushed, CASE WHEN c_custkey % 2 = 0 THEN 'ctf|t' || c_custkey % 3 ELSE '' END AS topics,
  CASE c_custkey % 4 WHEN 0 THEN 'MIT' WHEN 3 THEN 'GPL-3.0-only' END AS license_spdx, CASE WHEN c_custkey % 3 <> 0 THEN c_custkey * 10 ELSE 0 END AS size_kb, ['writeups', 'sources', 'unknown'][c_custkey % 3 + 1] AS kind FROM customer"""


def _shown(c: DataFrame) -> DataFrame:
    return c.select("full_name", "html_url", "stars", F.unix_timestamp("pushed_at").cast("string").alias("pushed"), F.array_join("topics", "|").alias("topics"), "license_spdx", "size_kb", "kind")


@query("SRC-14", _ITEM)
def src_14(spark, sf_dir):
    """Recorded search pages, many to a file, each file a JSON list of them."""
    path = scratch(spark, "search")
    narrow = spread(api_items(spark, sf_dir), "page")
    pages = narrow.groupBy("page").agg(F.count("*").alias("total_count"), F.transform(F.array_sort(F.collect_list(F.struct("k", "item"))), lambda x: x["item"]).alias("items"))
    answer = F.to_json(F.struct("total_count", "items"), {"ignoreNullFields": "false"})
    files = pages.groupBy(F.floor(F.col("page") / 100).alias("file")).agg(F.concat(F.lit("["), F.array_join(F.collect_list(answer), ","), F.lit("]")).alias("value"))
    spread(files, "file").sortWithinPartitions("file").select("value").write.option("maxRecordsPerFile", 1).text(path)
    return _shown(records.read_search_pages(spark, path))


@query("SRC-15", _ITEM)
def src_15(spark, sf_dir):
    return _shown(api_items(spark, sf_dir).select(records.candidate(F.col("item")).alias("c")).select("c.*"))


def candidate_rows(spark, sf_dir) -> DataFrame:
    return api_items(spark, sf_dir).select(records.candidate(F.col("item")).alias("c"), F.col("item.size").alias("own")).select("c.*", "own").withColumn("size_kb", F.col("own")).drop("own")


@query("SRC-11", "SELECT 'o/' || n_name AS repo, 'sources' AS kind, CASE WHEN n_nationkey % 4 = 0 THEN 'MIT' END AS license, n_nationkey % 2 = 0 AS official FROM nation UNION ALL SELECT 'o' || c_custkey % 7 || '/' || ['ctf-writeups', 'tasks', 'plain'][c_custkey % 3 + 1] || c_custkey, ['writeups', 'sources', 'unknown'][c_custkey % 3 + 1], NULL, false FROM customer WHERE c_custkey % 3 = 0 OR c_custkey * 10 <= 5 * 1024")
def src_11(spark, sf_dir):
    """Seeds and the candidates that aren't known to be too large."""
    seeds = records.read_seeds(spark, seed_file(spark, sf_dir))
    return records.discovered_seeds(seeds, candidate_rows(spark, sf_dir), max_mb=5).select("repo", "kind", "license", "official")


_BAD_LINES = """(SELECT doc_id AS k, CASE doc_id % 8
  WHEN 0 THEN '{"id":"x' || doc_id || '","title":"doc' WHEN 1 THEN '{"id":"x' || doc_id || '","title":"t","year":"soon"}' WHEN 2 THEN '{"title":"doc ' || doc_id || '"}' WHEN 3 THEN '[{"id":"x' || doc_id || '","title":"t"}]'
  WHEN 4 THEN '{"id":"x' || doc_id || '","tags":[]}' WHEN 5 THEN '   ' ELSE NULL END AS line FROM documents)"""
_BAD = f"(SELECT line, CASE k % 8 WHEN 2 THEN 'no id' WHEN 4 THEN 'no title' ELSE 'malformed' END AS reason FROM {_BAD_LINES} WHERE k % 8 < 5)"


@query(
    "SRC-12",
    f"""WITH {_DOC} SELECT 'row' AS kind, id AS a, 'doc ' || doc_id AS b, coalesce(spdx, 'none') AS c FROM m UNION ALL SELECT 'line', sha256(line), reason, NULL FROM {_BAD}
UNION ALL SELECT 'count', 'lines', ((SELECT count(*) FROM documents) + (SELECT count(*) FROM {_BAD}))::VARCHAR, NULL UNION ALL SELECT 'count', 'rows', (SELECT count(*) FROM documents)::VARCHAR, NULL
UNION ALL SELECT 'count', reason, count(*)::VARCHAR, NULL FROM {_BAD} GROUP BY 2""",
)
def src_12(spark, sf_dir):
    """A catalog shard with bad lines among its rows, read once: what fits the contract, what doesn't, and how many of each."""
    path, k = scratch(spark, "catalog"), F.col("doc_id")
    sink.write_jsonl(catalog.normalize(document_raw(spark, sf_dir), slug=text.slug_of_normal), path)
    own = F.concat(F.lit('"id":"x'), k.cast("string"), F.lit('"'))
    bad = [F.concat(F.lit("{"), own, F.lit(',"title":"doc')), F.concat(F.lit("{"), own, F.lit(',"title":"t","year":"soon"}')), F.concat(F.lit('{"title":"doc '), k.cast("string"), F.lit('"}')), F.concat(F.lit("[{"), own, F.lit(',"title":"t"}]')), F.concat(F.lit("{"), own, F.lit(',"tags":[]}')), F.lit("   ")]
    table(spark, sf_dir, "documents").where(k % 8 < 6).select(F.get(F.array(*bad), (k % 8).cast("int")).alias("value")).write.mode("append").text(path)
    done = records.read_checked(spark, path)
    none = F.lit(None).cast("string")
    rows = done.rows.select(F.lit("row").alias("kind"), F.col("id").alias("a"), F.col("title").alias("b"), F.coalesce("license.spdx_id", F.lit("none")).alias("c"))
    lines = done.quarantine.select(F.lit("line"), F.sha2("line", 256), "reason", none)
    counts = spark.createDataFrame([("count", k, str(n), None) for k, n in done.counts.items()], "kind string, a string, b string, c string")
    return rows.union(lines).union(counts)


@query("SRC-13", f"SELECT full_name, stars, topics, kind FROM ({_ITEM})")
def src_13(spark, sf_dir):
    path = scratch(spark, "candidates")
    sink.write_candidates(candidate_rows(spark, sf_dir), path)
    missing = records.read_candidates(spark, scratch(spark, "nothing"))
    return records.read_candidates(spark, path).unionByName(missing).select("full_name", "stars", F.array_join("topics", "|").alias("topics"), "kind")


def document_files(spark, sf_dir) -> str:
    """A folder of trees, one for each source, with a file for each document."""
    path = scratch(spark, "tree")
    rows = table(spark, sf_dir, "documents").select(F.coalesce("source", F.lit("none")).alias("source"), "doc_id", F.coalesce("text", F.lit("")).alias("text"))
    top = local_path(path)

    def run(batches):
        for b in batches:
            for r in b.itertuples():
                folder = os.path.join(top, f"o__{r.source}", f"d{r.doc_id % 5}", ".git" if r.doc_id % 50 == 49 else "x")
                os.makedirs(folder, exist_ok=True)
                with open(os.path.join(folder, f"LICENSE{r.doc_id}"), "w", encoding="utf-8", newline="") as f:
                    f.write(r.text)
            yield pd.DataFrame({"n": [len(b)]})

    rows.mapInPandas(run, "n long").agg(F.sum("n")).collect()
    return top


_TREE_FILES = "(SELECT doc_id, 'o/' || coalesce(source, 'none') AS tree, 'd' || doc_id % 5 || '/x/LICENSE' || doc_id AS path, coalesce(text, '') AS text FROM documents WHERE doc_id % 50 <> 49)"


@query("SRC-16", f"SELECT tree, path, false AS is_dir FROM {_TREE_FILES} UNION ALL SELECT DISTINCT tree, 'd' || doc_id % 5, true FROM (SELECT doc_id, 'o/' || coalesce(source, 'none') AS tree FROM documents) UNION ALL SELECT DISTINCT tree, 'd' || doc_id % 5 || '/x', true FROM {_TREE_FILES}")
def src_16(spark, sf_dir):
    return trees.read_tree(spark, document_files(spark, sf_dir), checkouts="true", hash="false").select("tree", "path", "is_dir")


@query("SRC-16-filtered", f"SELECT tree, path, strlen(text)::BIGINT AS size, sha256(text) AS sha256 FROM {_TREE_FILES} WHERE tree <> 'o/src1' AND path LIKE 'd1/%' AND NOT path LIKE '%7' AND strlen(text) > 500")
def src_16_filtered(spark, sf_dir):
    """Filters that the source applies itself: only what passes them is hashed."""
    found = trees.read_tree(spark, document_files(spark, sf_dir), checkouts="true").where("not is_dir and tree <> 'o/src1' and path like 'd1/%' and not path like '%7' and size > 500")
    return found.select("tree", "path", "size", "sha256")


@query("NRM-05", f"SELECT tree, path, strlen(text)::BIGINT AS size, sha256(text) AS sha256, strlen(text) > 1000 AS lfs FROM {_TREE_FILES}")
def nrm_05(spark, sf_dir):
    """Every file with its size and hash, read in pieces; over the cap it counts as large."""
    return trees.read_tree(spark, document_files(spark, sf_dir), checkouts="true", sizeCap=1000).where("not is_dir").select("tree", "path", "size", "sha256", "lfs")


@query("NRM-13", f"SELECT path, sha256(text) AS sha256 FROM {_TREE_FILES}")
def nrm_13(spark, sf_dir):
    return trees.read_tree(spark, document_files(spark, sf_dir), checkouts="true").where("not is_dir").select("path", "sha256")


@query("LIC-06", f"SELECT path, length(text)::BIGINT AS chars, sha256(text) AS head FROM {_TREE_FILES}")
def lic_06(spark, sf_dir):
    found = trees.read_tree(spark, document_files(spark, sf_dir), checkouts="true", hash="false", heads="license").where("not is_dir")
    return found.select("path", F.char_length("head").cast("long").alias("chars"), F.sha2("head", 256).alias("head"))


@query("LIC-04", "WITH f AS (SELECT source, doc_id, 'LICENSE' || doc_id AS file, " + _spdx("text") + " AS spdx FROM documents), r AS (SELECT *, row_number() OVER (PARTITION BY source ORDER BY spdx IS NULL, file) AS n FROM f) SELECT source AS tree, CASE WHEN source = 'src1' THEN 'CC0-1.0' ELSE spdx END AS spdx_id FROM r WHERE n = 1")
def lic_04(spark, sf_dir):
    """What is declared goes first, then the surest of a tree's license files, the first by name of equal ones."""
    name = F.concat(F.lit("LICENSE"), F.col("doc_id").cast("string"))
    tree = table(spark, sf_dir, "documents").select(F.col("source").alias("tree"), name.alias("path"), F.lit(False).alias("is_dir"), F.col("text").alias("head"))
    declared = spark.createDataFrame([("src1", "CC0-1.0"), ("src2", "NOASSERTION")], "tree string, spdx string")
    return walk.license_of_trees(tree, declared).select("tree", "license.spdx_id")


# ---- checkouts ---------------------------------------------------------------------------------------------------------


def checkout_folder(spark, sf_dir, missing: bool = False) -> str:
    """Checkouts of nations in the shared folder; every sixth has none if `missing`."""
    top = local_path(scratch(spark, "checkouts"))

    def run(batches):
        for b in batches:
            for r in b.itertuples():
                if missing and r.k % 6 == 5:
                    continue
                files = {"2021/Cup/pwn/one/chal.py": f"print({r.k})", "2021/Cup/pwn/one/README.md": "about", "2021/Cup/web/two/public/i.js": "js", "LICENSE": "Mozilla Public License Version 2.0" if r.k % 2 else "nothing known", ".git/HEAD": "ref: refs/heads/main\n", ".git/refs/heads/main": f"{r.k:040d}\n"}
                if r.k % 3 == 0:
                    files["2021/Cup/misc/m/challenge.json"] = '{"name": "Em", "category": "crypto", "flag": "F{x}"}'
                for name, body in files.items():
                    path = os.path.join(top, f"o__{r.name}", name)
                    os.makedirs(os.path.dirname(path), exist_ok=True)
                    with open(path, "w", encoding="utf-8") as f:
                        f.write(body)
            yield pd.DataFrame({"n": [len(b)]})

    os.makedirs(top, exist_ok=True)
    nations(spark, sf_dir).mapInPandas(run, "n long").agg(F.sum("n")).collect()
    return top


_CHECKOUT = """(SELECT n_nationkey AS k, 'o/' || n_name AS repo, unnest(CASE WHEN n_nationkey % 3 = 0 THEN ['one', 'two', 'Em'] ELSE ['one', 'two'] END) AS title FROM nation)"""
_DECLARED = "CASE WHEN k % 4 = 0 THEN 'MIT' WHEN k % 2 = 1 THEN 'MPL-2.0' END"


@query(
    "SRC-08",
    f"SELECT repo, title, 2021 AS year, CASE title WHEN 'one' THEN 'pwn' WHEN 'two' THEN 'web' ELSE 'crypto' END AS raw_category, CASE title WHEN 'one' THEN 2 ELSE 1 END AS n_files, lpad(k::VARCHAR, 40, '0') AS commit_sha, {_DECLARED} AS spdx_id, k % 2 = 0 AS is_official FROM {_CHECKOUT}",
)
def src_08(spark, sf_dir):
    """Checkouts on disk to raw records: listed, walked, licensed and placed."""
    made = records.checkouts(spark, checkout_folder(spark, sf_dir), seed_file(spark, sf_dir))
    return made.select("source.repo", "title", "year", "raw_category", F.size("files").alias("n_files"), "source.commit_sha", "source.license.spdx_id", "source.is_official")


@query(
    "ORC-01",
    f"SELECT repo, CASE WHEN k % 6 = 5 THEN 'failed' ELSE 'staged' END AS status, CASE WHEN k % 6 = 5 THEN 0 ELSE count(*) END::INTEGER AS n_challenges, CASE WHEN k % 6 = 5 THEN 0 ELSE count(*) + 1 END::INTEGER AS n_files, CASE WHEN k % 6 = 5 THEN 'no checkout' END AS error FROM {_CHECKOUT} GROUP BY repo, k",
)
def orc_01(spark, sf_dir):
    """Repositories staged side by side: one without a checkout fails alone."""
    folder = checkout_folder(spark, sf_dir, missing=True)
    seeds = staged(records.read_seeds(spark, seed_file(spark, sf_dir)), "seeds")
    results, _ = mirror.stage_trees(spark, folder, seeds, trees.heads_of_commits(spark, folder))(seeds.select("repo"))
    return results.select("repo", "status", "n_challenges", "n_files", "error")


def _stage(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
    """A stage of made-up results: every fifth repository fails, and one in two that are staged has a challenge."""
    n = F.regexp_extract("repo", r"(\d+)$", 1).cast("int")
    values = {"repo": F.col("repo"), "n_challenges": n % 2, "n_files": F.lit(1), "bytes": F.lit(10), "status": F.when(n % 5 == 0, "failed").otherwise("staged")}
    results = batch.select(*[values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.RESULT])
    made = batch.where((n % 2 == 1) & (n % 5 != 0)).select(*[(F.col("repo") if f.name in ("id", "title") else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.CHALLENGE])
    return results, made


def flushed(spark, sf_dir) -> tuple[str, str]:
    """Two batches of nations: the first one's publication fails, the second has its own."""
    manifest, shards = scratch(spark, "manifest"), scratch(spark, "shards")
    rows = staged(nations(spark, sf_dir).select("k", F.concat(F.lit("o/n"), F.col("k").cast("string")).alias("repo")), "repos")

    def publish(challenges: DataFrame, batch: int) -> None:
        if batch == 0:
            raise OSError("down")

    for batch in (0, 1):
        mirror.flush(rows.where(F.col("k") % 2 == batch).select("repo"), batch, _stage, publish, manifest, shards)
    return manifest, shards


@query("ORC-03", "SELECT 'o/n' || n_nationkey AS repo, CASE WHEN n_nationkey % 5 = 0 THEN 'failed' WHEN n_nationkey % 2 = 1 THEN 'ok' ELSE 'ok' END AS status FROM nation")
def orc_03(spark, sf_dir):
    """A batch is ok once it is published. The first has no challenge, so nothing of it is published and it is ok as well."""
    return ingest.read_manifest(spark, flushed(spark, sf_dir)[0]).select("repo", "status")


@query("SNK-11", "SELECT CASE WHEN n_nationkey % 5 = 0 THEN 'failed' ELSE 'ok' END AS status, count(*)::BIGINT AS repos, sum(n_nationkey % 2)::BIGINT AS challenges, sum(10)::BIGINT AS bytes FROM nation GROUP BY 1")
def snk_11(spark, sf_dir):
    """Rows appended by two flushes, summed."""
    return ingest.mirror_summary(ingest.read_manifest(spark, flushed(spark, sf_dir)[0]))


@query("INC-02", "SELECT 'o/n' || n_nationkey AS repo FROM nation WHERE n_nationkey % 5 = 0")
def inc_02(spark, sf_dir):
    """What a rerun takes: all that no published batch holds."""
    repos = nations(spark, sf_dir).select(F.concat(F.lit("o/n"), F.col("k").cast("string")).alias("repo"))
    return ingest.pending(repos, ingest.read_manifest(spark, flushed(spark, sf_dir)[0]))


@query("INC-03", "SELECT 'o/c' || c_custkey AS repo, ((row_number() OVER (ORDER BY c_custkey) - 1) // 40)::BIGINT AS batch FROM customer")
def inc_03(spark, sf_dir):
    """Requests in files of a batch each, by count."""
    path = scratch(spark, "requests")
    repos = table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("pos"), F.concat(F.lit("o/c"), F.col("c_custkey").cast("string")).alias("repo"))
    mirror.request_batches(repos, spark.createDataFrame([], "repo string, size_kb long"), path, 40)
    return spark.read.schema("repo string, batch long").json(path).select("repo", "batch")


_SHARDS = f"""r AS (
  SELECT id, doc_id AS row_pos, 0 AS shard_pos, 'doc ' || doc_id AS title FROM m WHERE doc_id % 5 <> 0
  UNION ALL SELECT id, doc_id + 1000000, 0, 'doc ' || doc_id || ' twice' FROM m WHERE doc_id % 7 = 0 AND doc_id % 5 <> 0
  UNION ALL SELECT id, doc_id * 2, 1, 'doc ' || doc_id || ' again' FROM m WHERE doc_id % 3 = 0
  UNION ALL SELECT id, doc_id, 2, 'doc ' || doc_id || ' late' FROM m WHERE doc_id % 5 = 0)"""


def shard_rows(spark, sf_dir) -> DataFrame:
    """Three shards of one catalog: a third of its records come again, some twice in one shard, some in the last shard only."""
    made = catalog.normalize(document_raw(spark, sf_dir), slug=text.slug_of_normal).select("id", "title", F.col("input_pos").alias("k"))
    some = lambda where, shard, row, mark: made.where(where).select("id", F.concat("title", F.lit(mark)).alias("title"), F.lit(shard).cast("long").alias("shard_pos"), row.cast("long").alias("row_pos"))
    k = F.col("k")
    first = some("k % 5 <> 0", 0, k, "").unionByName(some("k % 7 = 0 and k % 5 <> 0", 0, k + 1_000_000, " twice"))
    return first.unionByName(some("k % 3 = 0", 1, k * 2, " again")).unionByName(some("k % 5 = 0", 2, k, " late"))


@query(
    "INC-04",
    f"WITH {_DOC}, {_SHARDS} SELECT id, arg_max(title, shard_pos * 100000000 + row_pos) AS title, min(shard_pos)::BIGINT AS first_shard_pos, (min(shard_pos * 100000000 + row_pos) % 100000000)::BIGINT AS first_row_pos, count(DISTINCT shard_pos)::BIGINT AS shards FROM r GROUP BY 1",
)
def inc_04(spark, sf_dir):
    """Shards as a stream: their rows lie shuffled in files, and half of the files come after a restart. The table is what the
    state of the stream holds."""
    rows, source, check = staged(shard_rows(spark, sf_dir), "shard-rows"), scratch(spark, "shards"), scratch(spark, "upsert")
    for half in (0, 1):
        rows.where(F.pmod(F.xxhash64("id", "title"), F.lit(2)) == half).repartition(2, "title").write.mode("append").parquet(source)
        stream = spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", "2").parquet(source)
        upsert.start(stream, check).awaitTermination()
    return upsert.snapshot(spark, check, "id string, title string", "shards").select("id", "title", "first_shard_pos", "first_row_pos", "shards")


@query(
    "ORC-07",
    f"SELECT title, count(*)::BIGINT AS n, (count(*) FILTER ({_DECLARED} IS NOT NULL))::VARCHAR AS redistributable FROM {_CHECKOUT} WHERE title = 'one' GROUP BY 1 UNION ALL SELECT title, 1, NULL FROM {_CHECKOUT} WHERE title <> 'one' GROUP BY 1",
)
def orc_07(spark, sf_dir):
    """A source to a shard: read, normalized, merged, laid out, written and read again. Equal challenges of many repositories
    are one."""
    out = scratch(spark, "ingested")
    ingest.ingest_source(spark, "checkouts", out, path=checkout_folder(spark, sf_dir), seeds=seed_file(spark, sf_dir))
    made = records.read_catalog(spark, f"{out}/checkouts.jsonl")
    sums = made.groupBy("title").agg(F.count("*").alias("n"), F.count_if(F.coalesce("license.redistributable", F.lit(False))).alias("r"))
    return sums.select("title", "n", F.when(F.col("title") == "one", F.col("r").cast("string")).alias("redistributable"))  # of mirrors, any one may stand for all


@query("ORC-08", f"SELECT 'yaml_list' AS source, count(*)::BIGINT AS challenges, count(*) FILTER (k % 4 = 0 OR k % 5 = 0)::BIGINT AS with_writeups FROM {_YAML}")
def orc_08(spark, sf_dir):
    """The command line's ingest."""
    from weir import cli

    out = scratch(spark, "by-command")
    cli.main(["ingest", "yaml_list", yaml_file(spark, sf_dir), out], spark)
    made = records.read_catalog(spark, f"{out}/yaml_list.jsonl")
    return made.agg(F.count("*").alias("challenges"), F.count_if(F.size("writeups") > 0).alias("with_writeups")).select(F.lit("yaml_list").alias("source"), "challenges", "with_writeups")


# ---- sinks -------------------------------------------------------------------------------------------------------------


def normalized(spark, sf_dir) -> DataFrame:
    return catalog.normalize(document_raw(spark, sf_dir), slug=text.slug_of_normal)


@query("SNK-01", "SELECT count(*)::BIGINT * 2 AS n, count(DISTINCT doc_id)::BIGINT AS titles FROM documents")
def snk_01(spark, sf_dir):
    """Rows added twice to a catalog that isn't written yet."""
    made = sink.conform(normalized(spark, sf_dir))
    return made.unionByName(made).agg(F.count("*").alias("n"), F.count_distinct("title").alias("titles"))


@query("SNK-02", "SELECT count(*)::BIGINT AS lines, 0::BIGINT AS with_null, count(*)::BIGINT AS with_empty FROM documents")
def snk_02(spark, sf_dir):
    """JSON lines leave nulls out and keep empty arrays."""
    path = scratch(spark, "jsonl")
    sink.write_jsonl(normalized(spark, sf_dir), path)
    lines = spark.read.text(path)
    return lines.agg(F.count("*").alias("lines"), F.count_if(F.contains("value", F.lit(":null"))).alias("with_null"), F.count_if(F.contains("value", F.lit('"writeups":[]'))).alias("with_empty"))


@query("SNK-03", f"WITH {_DOC} SELECT id, category, fp AS content_fingerprint FROM m")
def snk_03(spark, sf_dir):
    path, empty = scratch(spark, "parquet"), scratch(spark, "parquet-empty")
    sink.write_parquet(normalized(spark, sf_dir), path, by=["category"])
    sink.write_parquet(normalized(spark, sf_dir).limit(0), empty)
    return spark.read.parquet(path).unionByName(spark.read.parquet(empty)).select("id", "category", "content_fingerprint")


@query("SNK-03-replaced", "SELECT doc_id, coalesce(lang, 'none') AS lang FROM documents WHERE lang IS DISTINCT FROM 'en' OR doc_id % 2 = 0")
def snk_03_replaced(spark, sf_dir):
    """One partition is replaced, the others stay."""
    path, d = scratch(spark, "partitions"), table(spark, sf_dir, "documents").select("doc_id", F.coalesce("lang", F.lit("none")).alias("lang"))
    sink.write_partitions(d, path, ["lang"])
    sink.write_partitions(d.where("lang = 'en' and doc_id % 2 = 0"), path, ["lang"])
    return spark.read.parquet(path).select("doc_id", "lang")


@query("SNK-04", "SELECT count(*)::BIGINT AS lines, count(*)::BIGINT AS with_null FROM customer")
def snk_04(spark, sf_dir):
    path = scratch(spark, "candidates")
    sink.write_candidates(candidate_rows(spark, sf_dir), path)
    return spark.read.text(path).agg(F.count("*").alias("lines"), F.count_if(F.contains("value", F.lit('"created_at":null'))).alias("with_null"))


def small_corpus(spark, sf_dir, packed: bool) -> tuple[str, DataFrame, DataFrame]:
    """(target, rows written, challenges) of the checkouts' challenges, each with an inline writeup, as a corpus."""
    folder = checkout_folder(spark, sf_dir)
    raw = records.checkouts(spark, folder, seed_file(spark, sf_dir))
    note = make(schema.WRITEUP, origin=F.lit("other"), text=F.concat(F.lit("how "), F.col("title")), is_inline=F.lit(True))
    # a repository's name is part of the event, so that no two challenges share an id
    made = staged(catalog.normalize(raw.withColumns({"writeups": F.array(note), "event_name": F.col("source.repo")})), "challenges")
    local = made.withColumn("corpus_path", F.concat(F.regexp_replace("corpus_path", "^([^/]*)/", "$1__")))
    target = local_path(scratch(spark, "corpus"))
    out = staged(corpus.write(local, corpus.writeup_bodies(made), target, folder, packed), "written")
    return target, out, made


@query("SNK-05", f"SELECT repo, title, CASE title WHEN 'one' THEN 3 ELSE 2 END::BIGINT AS n_files, NULL::VARCHAR AS error FROM {_CHECKOUT}")
def snk_05(spark, sf_dir):
    """Sources copied and writeups written, one folder for each challenge."""
    _, out, made = small_corpus(spark, sf_dir, False)
    return out.join(made.select("id", "title", F.col("event_name").alias("repo")), "id").select("repo", "title", "n_files", "error")


@query("SNK-05-rows", "SELECT conv_id::VARCHAR AS id, (row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1)::INTEGER AS nth, 'writeups/writeup_' || lpad((row_number() OVER (PARTITION BY conv_id ORDER BY turn) - 1)::VARCHAR, 2, '0') || '.md' AS path, sha256(text) AS sha256, strlen(text)::BIGINT AS size FROM conversations")
def snk_05_rows(spark, sf_dir):
    """Turns as inline writeups of their conversation: the rows that materialization adds to manifests."""
    c = table(spark, sf_dir, "conversations")
    note = make(schema.WRITEUP, origin=F.lit("other"), text=F.col("text"), is_inline=F.lit(True))
    ch = c.groupBy(F.col("conv_id").cast("string").alias("id")).agg(F.sort_array(F.collect_list(F.struct("turn", note.alias("w")))).alias("ws")).select("id", F.col("ws.w").alias("writeups"))
    return corpus.writeup_bodies(ch).select("id", "nth", "path", F.sha2("body", 256).alias("sha256"), F.octet_length("body").cast("long").alias("size"))


@query("SNK-05a", f"SELECT regexp_replace(lower(repo), '[^a-z0-9]+', '-', 'g') AS event, unnest(CASE title WHEN 'one' THEN ['README.md', 'chal.py', 'writeups/writeup_00.md'] WHEN 'two' THEN ['public/i.js', 'writeups/writeup_00.md'] ELSE ['challenge.json', 'writeups/writeup_00.md'] END) AS file FROM {_CHECKOUT}")
def snk_05a(spark, sf_dir):
    """What stands in the corpus."""
    target, _, _ = small_corpus(spark, sf_dir, False)
    found = corpus.listing(spark, target).where("not is_dir").select(F.split("path", "/").alias("p"))
    return found.select(F.get("p", F.lit(1)).alias("event"), F.array_join(F.slice("p", F.lit(5), F.size("p")), "/").alias("file"))


@query("SNK-05c", "SELECT n_nationkey AS k, n_nationkey % 2 = 1 AS there FROM nation")
def snk_05c(spark, sf_dir):
    """Writeups that nothing names are deleted; others stay."""
    top = local_path(scratch(spark, "old-corpus"))
    for k in range(nations(spark, sf_dir).count()):  # a file for each of few nations
        os.makedirs(f"{top}/d{k}/writeups", exist_ok=True)
        with open(f"{top}/d{k}/writeups/writeup_00.md", "w") as f:
            f.write("x")
    n = nations(spark, sf_dir).select("k", F.col("k").cast("string").alias("id"), F.concat(F.lit("d"), F.col("k").cast("string")).alias("dir"))
    bodies = n.where("k % 2 = 1").select("id", F.lit(0).alias("nth"), F.lit("writeups/writeup_00.md").alias("path"), F.lit("x").alias("body"))
    gone = staged(corpus.orphans(corpus.listing(spark, top), bodies, n.select("id", "dir")), "gone")
    corpus.prune(top, gone).agg(F.count_if("removed")).collect()
    left = corpus.listing(spark, top).where("not is_dir").select(F.regexp_extract("path", r"^d(\d+)/", 1).cast("int").alias("k"), F.lit(True).alias("t"))
    return n.select("k").join(left, "k", "left").select("k", F.coalesce("t", F.lit(False)).alias("there"))


_ANSWER = "CASE WHEN k % 5 = 0 THEN NULL WHEN k % 7 = 0 THEN NULL WHEN k % 11 = 0 THEN NULL ELSE 'body ' || k END"


def _routes(k: int) -> tuple[int, dict[str, str], list[bytes]]:
    """A made-up site: some pages are missing, too large, or lead to a private address."""
    if k % 5 == 0:
        return 404, {}, []
    if k % 7 == 0:
        return 302, {"Location": "http://10.0.0.1/"}, []
    if k % 11 == 0:
        return 200, {}, [b"x" * 600] * 2
    return 200, {"Content-Type": "text/plain"}, [b"body ", str(k).encode()]


def _client() -> client.Polite:
    return client.Polite(lambda url: _routes(int(url.rsplit("/", 1)[-1] or 0)), client.RateLimiter(1e6, burst=1_000_000), lambda host, port: ["10.0.0.1" if host == "10.0.0.1" else "93.184.216.34"], 1_000, lambda s: None)


@query("SNK-05d", f"SELECT 'http://ok.org/' || k AS url, {_ANSWER} AS body, CASE WHEN {_ANSWER} IS NOT NULL THEN 'text/plain' END AS content_type FROM (SELECT p_partkey AS k FROM part WHERE p_partkey % 2 = 0)")
def snk_05d(spark, sf_dir):
    """Bodies of external writeups, fetched through a guarded client; of what may not be passed on, none."""
    k = F.col("p_partkey")
    note = make(schema.WRITEUP, origin=F.lit("other"), url=F.concat(F.lit("http://ok.org/"), k.cast("string")))
    ch = table(spark, sf_dir, "part").select(F.array(note).alias("writeups"), license.from_spdx(F.when(k % 2 == 0, "MIT")).alias("license"))
    return fetch.writeups(ch, _client, 4).select("url", "body", "content_type")


@query("NET-04", f"SELECT k, {_ANSWER} IS NOT NULL AS fetched FROM (SELECT p_partkey AS k FROM part)")
def net_04(spark, sf_dir):
    """Redirects to private addresses and bodies over the limit are refused."""

    def run(batches):
        one = _client()
        for b in batches:
            done = []
            for k in b["k"]:
                try:
                    done.append(one.fetch(f"http://ok.org/{k}")[0] == 200)
                except client.UnsafeUrl:
                    done.append(False)
            yield pd.DataFrame({"k": b["k"], "fetched": done})

    return spread(table(spark, sf_dir, "part").select(F.col("p_partkey").alias("k"))).mapInPandas(run, "k long, fetched boolean")


@query("SNK-13", f"SELECT 'd' || k % 10 AS dir, 'f' || k AS name, {_ANSWER} IS NOT NULL AS there FROM (SELECT p_partkey AS k FROM part)")
def snk_13(spark, sf_dir):
    """Handouts written whole or not at all; a second run trusts what is there."""
    folder = local_path(scratch(spark, "handouts"))
    k = F.col("p_partkey")
    files = table(spark, sf_dir, "part").select(F.concat(F.lit("d"), (k % 10).cast("string")).alias("dir"), F.concat(F.lit("f"), k.cast("string")).alias("name"), F.concat(F.lit("http://ok.org/"), k.cast("string")).alias("url"))
    staged(fetch.handouts(files, folder, _client, tasks=4), "first")
    return fetch.handouts(files, folder, _client, tasks=4).select("dir", "name", F.col("path").isNotNull().alias("there"))


_MEMBERS = "CASE title WHEN 'one' THEN 'README.md|chal.py|writeups/writeup_00.md' WHEN 'two' THEN 'public/i.js|writeups/writeup_00.md' ELSE 'challenge.json|writeups/writeup_00.md' END"


@query("SNK-06", f"SELECT repo, title, {_MEMBERS} AS members, 0::BIGINT AS latest, 0::BIGINT AS owner FROM {_CHECKOUT}")
def snk_06(spark, sf_dir):
    """Archives with sorted members and neither times nor owners."""
    import tarfile

    target, out, made = small_corpus(spark, sf_dir, True)

    @F.pandas_udf("members string, latest long, owner long")
    def inside(dirs: pd.Series) -> pd.DataFrame:
        rows = []
        for d in dirs:
            with tarfile.open(os.path.join(target, d)) as tar:
                found = tar.getmembers()
            rows.append(("|".join(m.name for m in found), max(m.mtime for m in found), max(m.uid + m.gid for m in found)))
        return pd.DataFrame(rows, columns=["members", "latest", "owner"])

    found = out.select("id", inside("dir").alias("x")).select("id", "x.*")
    return found.join(made.select("id", "title", F.col("event_name").alias("repo")), "id").select("repo", "title", "members", "latest", "owner")


@query("SNK-07", f"SELECT repo, title, true AS packed, CASE title WHEN 'one' THEN 3 ELSE 2 END AS files FROM {_CHECKOUT}")
def snk_07(spark, sf_dir):
    """Challenges that point at their archives and keep their manifests."""
    _, out, made = small_corpus(spark, sf_dir, True)
    final = corpus.archived(corpus.materialized(made, corpus.writeup_bodies(made)))
    joined = final.join(out.select("id", "dir"), "id")
    return joined.select(F.col("event_name").alias("repo"), "title", (F.col("corpus_path") == F.concat(F.lit("corpus/"), F.col("dir"))).alias("packed"), F.size("files").alias("files"))


@query("SNK-08", f"SELECT 'dry run: ' || (SELECT count(*) FROM {_CHECKOUT}) || ' files' AS said, 'nothing to publish' AS empty")
def snk_08(spark, sf_dir):
    """What publishing a corpus says before anything is sent."""
    target, out, _ = small_corpus(spark, sf_dir, True)
    said, nothing = client.publish(target, "data/set", only=".tar.gz"), client.publish(local_path(scratch(spark, "none")), "data/set")
    return spark.createDataFrame([(said.split(",")[0], nothing.split(" in ")[0])], "said string, empty string")


@query("SNK-09", "SELECT 'dry run: 1 files' AS said")
def snk_09(spark, sf_dir):
    """Of a catalog's folder, shards only."""
    top = local_path(scratch(spark, "shards"))
    made = normalized(spark, sf_dir)
    sink.write_jsonl(made, f"{top}/challenges.jsonl", single=True)
    return spark.createDataFrame([(client.publish(top, "data/set", only=".jsonl").split(",")[0],)], "said string")


@query("SNK-10", "SELECT 'sent' AS good, 'upload failed: ZeroDivisionError: division by zero' AS bad, '1|2' AS waits")
def snk_10(spark, sf_dir):
    """Uploads in a process of their own, tried again after growing waits."""
    waits: list[float] = []
    good = client.upload(lambda: "sent")
    try:
        client.upload(lambda: 1 // 0, attempts=3, sleep=waits.append)
        bad = ""
    except RuntimeError as e:
        bad = str(e).replace("integer division or modulo", "division").replace("integer division", "division")
    return spark.createDataFrame([(good, bad, "|".join(f"{w:g}" for w in waits))], "good string, bad string, waits string")


@query("SNK-12", "SELECT 'd' || n_regionkey || '/f' || n_nationkey AS path, CASE WHEN n_nationkey % 2 = 0 THEN 'b' ELSE 'a' END || n_nationkey AS body FROM nation")
def snk_12(spark, sf_dir):
    """Two trees moved into one, the later file standing."""
    top = local_path(scratch(spark, "merge"))
    rows = [(r["k"], r["r"]) for r in nations(spark, sf_dir).collect()]  # few nations
    for turn in "ab":
        for k, r in rows:
            if turn == "a" or k % 2 == 0:
                os.makedirs(f"{top}/{turn}/d{r}", exist_ok=True)
                with open(f"{top}/{turn}/d{r}/f{k}", "w") as f:
                    f.write(f"{turn}{k}")
        corpus.merge_move(f"{top}/{turn}", f"{top}/all")
    found = trees.read_tree(spark, f"{top}/all", heads="f").where("not is_dir")
    return found.select("path", F.col("head").alias("body"))


# ---- discovery and acquisition -----------------------------------------------------------------------------------------


@query(
    "DSC-02",
    """WITH RECURSIVE c AS (SELECT c_custkey % 700 * 3 AS s, count(*) * 40 AS n FROM customer GROUP BY 1),
r(low, high) AS (SELECT 0, 1000000 UNION ALL
  SELECT unnest([r.low, (r.low + r.high) // 2 + 1]), unnest([(r.low + r.high) // 2, r.high]) FROM r WHERE r.low < r.high AND (SELECT sum(n) FROM c WHERE s BETWEEN r.low AND r.high) > 1000),
l AS (SELECT low, high, (SELECT sum(n) FROM c WHERE s BETWEEN low AND high) AS n FROM r)
SELECT low::BIGINT AS low, high::BIGINT AS high, n::BIGINT AS n, n <= 1000 AS whole FROM l WHERE n > 0 AND (n <= 1000 OR low = high)""",
)
def dsc_02(spark, sf_dir):
    stars = table(spark, sf_dir, "customer").groupBy((F.col("c_custkey") % 700 * 3).alias("stars")).agg((F.count("*") * 40).alias("n"))
    return discovery.star_table(stars)


@query(
    "DSC-02-days",
    """WITH RECURSIVE o AS (SELECT o_orderdate::DATE AS day, o_custkey % 9 AS s, count(*) AS n FROM orders GROUP BY 1, 2), c AS (SELECT day, sum(n) AS n FROM o GROUP BY 1),
r(low, high) AS (SELECT min(day), max(day) FROM c UNION ALL
  SELECT unnest([r.low, r.low + ((r.high - r.low) // 2)::INTEGER + 1]), unnest([r.low + ((r.high - r.low) // 2)::INTEGER, r.high]) FROM r
  WHERE r.low < r.high AND (SELECT sum(n) FROM c WHERE day BETWEEN r.low AND r.high) > 5),
s AS (SELECT low, high, (SELECT sum(n) FROM c WHERE day BETWEEN low AND high) AS n FROM r),
t(day, low, high) AS (SELECT low, 0, 63 FROM s WHERE low = high AND n > 5 UNION ALL
  SELECT day, unnest([t.low, (t.low + t.high) // 2 + 1]), unnest([(t.low + t.high) // 2, t.high]) FROM t WHERE t.low < t.high AND (SELECT sum(n) FROM o WHERE o.day = t.day AND o.s BETWEEN t.low AND t.high) > 5),
u AS (SELECT day, low, high, (SELECT sum(n) FROM o WHERE o.day = t.day AND o.s BETWEEN t.low AND t.high) AS n FROM t)
SELECT low::DATE::VARCHAR AS low, high::DATE::VARCHAR AS high, NULL::BIGINT AS low_stars, NULL::BIGINT AS high_stars, n::BIGINT AS n, true AS whole FROM s WHERE n BETWEEN 1 AND 5
UNION ALL SELECT day::DATE::VARCHAR, day::DATE::VARCHAR, low::BIGINT, high::BIGINT, n::BIGINT, n <= 5 FROM u WHERE n > 0 AND (n <= 5 OR low = high)""",
)
def dsc_02_days(spark, sf_dir):
    """Days are halved first, and days that hold too much by a second number; what neither can cut is marked."""
    o = table(spark, sf_dir, "orders").groupBy(F.to_date("o_orderdate").alias("day"), (F.col("o_custkey") % 9).alias("stars")).agg(F.count("*").alias("n"))
    made = discovery.sharded(o, 5, 63)
    return made.select(F.col("low").cast("string").alias("low"), F.col("high").cast("string").alias("high"), "low_stars", "high_stars", "n", "whole")


@query("DSC-03", "SELECT 'r' || o_custkey AS full_name, count(*)::BIGINT AS seen FROM orders GROUP BY 1")
def dsc_03(spark, sf_dir):
    """A population behind a capped search: every day's leaf is read, and a name that several hold comes once."""
    o = table(spark, sf_dir, "orders").select(F.concat(F.lit("r"), F.col("o_custkey").cast("string")).alias("full_name"), F.to_date("o_orderdate").alias("day"))
    leaves = discovery.day_leaves(o.groupBy("day").agg(F.count("*").alias("n")))
    days = leaves.select("low", F.explode(F.sequence("low", "high")).alias("day"))  # each day of the calendar once
    return o.join(days, "day").groupBy("full_name").agg(F.count("*").alias("seen"))


@query("DSC-05", "SELECT DISTINCT lower(p_name) AS low FROM part")
def dsc_05(spark, sf_dir):
    return discovery.seed_names(table(spark, sf_dir, "part").select(F.upper("p_name").alias("repo")))


def _replayed(rows: DataFrame, one, ddl: str) -> DataFrame:
    """one(k) for each row's k."""
    names = [c.split()[0] for c in ddl.split(", ")]

    def run(batches):
        for b in batches:
            yield pd.DataFrame([(k, *one(k)) for k in b["k"]], columns=names)

    return rows.mapInPandas(run, ddl)


@query("DSC-06", "SELECT k, CASE WHEN k % 8 < 6 THEN 7 ELSE 0 END::BIGINT AS total, CASE WHEN k % 8 < 6 THEN 2 ELSE 0 END::BIGINT AS items, (2 * (2 ** least(k % 8, 6) - 1))::BIGINT AS waited FROM (SELECT c_custkey AS k FROM customer)")
def dsc_06(spark, sf_dir):
    """Refused searches are asked again after doubling waits; one that stays refused is an empty page."""

    def one(k: int) -> tuple[int, int, int]:
        refused, waits = [k % 8], []

        def call():
            refused[0] -= 1
            return (503, {}, {}) if refused[0] >= 0 else (200, {}, {"total_count": 7, "items": [1, 2]})

        total, items = client.search_page(call, sleep=waits.append)
        return total, len(items), int(sum(waits))

    return _replayed(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")), one, "k long, total long, items long, waited long")


@query("DSC-07", "SELECT k, CASE k % 3 WHEN 0 THEN 'Bearer one' || k WHEN 1 THEN 'Bearer two' || k END AS header FROM (SELECT n_nationkey AS k FROM nation)")
def dsc_07(spark, sf_dir):
    """A token from the first variable that is set, else from the tool's login, else none."""

    def one(k: int) -> tuple[str | None]:
        env = {0: {"GITHUB_TOKEN": f"one{k}", "GH_TOKEN": "no"}, 1: {"GH_TOKEN": f"two{k}"}, 2: {}}[k % 3]

        def run(*args, **kwargs):
            raise OSError("no tool")

        return (client.auth_headers(client.token(env, run)).get("Authorization"),)

    return _replayed(nations(spark, sf_dir).select("k"), one, "k int, header string")


@query("NET-01", "WITH e AS (SELECT user_id, event_id, floor(epoch(ts))::BIGINT AS t, row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS i FROM events) SELECT event_id, max(t - 600 * i) OVER (PARTITION BY user_id ORDER BY i) + 600 * i - t AS waited FROM e")
def net_01(spark, sf_dir):
    """Calls at the events' times behind a limiter of one call in ten minutes: how long each sleeps."""

    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf, now = pdf.sort_values(["ts", "event_id"]), [0.0]
        limiter, out = None, []
        for r in pdf.itertuples():
            now[0] = max(now[0], float(r.t))
            limiter = limiter or client.RateLimiter(1, 600, 1, 600, clock=lambda: now[0], sleep=lambda s: now.__setitem__(0, now[0] + s))
            limiter.acquire()
            out.append((r.event_id, round(now[0] - r.t)))
        return pd.DataFrame(out, columns=["event_id", "waited"])

    e = table(spark, sf_dir, "events").select("user_id", "event_id", "ts", F.floor(F.unix_timestamp("ts")).alias("t"))
    return e.groupBy("user_id").applyInPandas(run, "event_id long, waited long")


@query("NET-02", "SELECT k, 200::BIGINT AS status, 'text/plain' AS kind FROM (SELECT n_nationkey AS k FROM nation)")
def net_02(spark, sf_dir):
    """A client of its own limiter, guard and limit for each task."""

    def one(k: int) -> tuple[int, str | None]:
        status, _, kind = _client().fetch(f"http://ok.org/{k * 385 + 1}")
        return status, kind

    return _replayed(nations(spark, sf_dir).select("k"), one, "k int, status long, kind string")


@query("NET-03", "SELECT k, CASE WHEN k % 7 < 5 THEN 200 ELSE 503 END::BIGINT AS status, (2 * (2 ** least(k % 7, 4) - 1))::BIGINT AS waited FROM (SELECT c_custkey AS k FROM customer)")
def net_03(spark, sf_dir):
    """Transient answers are tried again, five times in all."""

    def one(k: int) -> tuple[int, int]:
        left, waits = [k % 7], []

        def call():
            left[0] -= 1
            return (503, None) if left[0] >= 0 else (200, None)

        return client.retried(call, sleep=waits.append)[0], int(sum(waits))

    return _replayed(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")), one, "k long, status long, waited long")


@query(
    "FLT-18",
    """WITH a AS (SELECT c_custkey AS k, [10, 127, 169, 172, 192, 8, 224, 100, 203, 240][c_custkey % 10 + 1] AS a, [254, 168, 20, 64, 0][c_custkey // 10 % 5 + 1] AS b, ['http', 'https', 'ftp'][c_custkey // 50 % 3 + 1] AS s FROM customer)
SELECT k, s <> 'ftp' AND CASE a WHEN 10 THEN false WHEN 127 THEN false WHEN 224 THEN false WHEN 240 THEN false WHEN 169 THEN b <> 254 WHEN 172 THEN b NOT BETWEEN 16 AND 31 WHEN 192 THEN b NOT IN (168) AND NOT (b = 0) WHEN 100 THEN b NOT BETWEEN 64 AND 127 ELSE true END AS safe FROM a""",
)
def flt_18(spark, sf_dir):
    """Urls whose host stands for one address: public ones over the web only."""

    def one(k: int) -> tuple[bool]:
        a, b, s = [10, 127, 169, 172, 192, 8, 224, 100, 203, 240][k % 10], [254, 168, 20, 64, 0][k // 10 % 5], ["http", "https", "ftp"][k // 50 % 3]
        try:
            client.check_url(f"{s}://host/", lambda host, port: [f"{a}.{b}.0.8"])
            return (True,)
        except client.UnsafeUrl:
            return (False,)

    return _replayed(table(spark, sf_dir, "customer").select(F.col("c_custkey").alias("k")), one, "k long, safe boolean")


@query("FLT-20", "SELECT n_nationkey AS k, n_nationkey >= 5 AS begins FROM nation")
def flt_20(spark, sf_dir):
    """Folders with so many GiB free: below the floor no checkout begins."""
    from types import SimpleNamespace

    return _replayed(nations(spark, sf_dir).select("k"), lambda k: (client.low_disk("/", usage=lambda _: SimpleNamespace(free=k * 1024**3)) is None,), "k int, begins boolean")


@query("SRC-17", "SELECT 'o/' || n_name AS repo, CASE WHEN n_nationkey % 4 = 3 THEN NULL WHEN n_nationkey % 4 = 2 THEN NULL ELSE lpad(n_nationkey::VARCHAR, 40, '0') END AS commit_sha, CASE n_nationkey % 4 WHEN 2 THEN 'too_big' WHEN 3 THEN 'failed' ELSE 'staged' END AS status FROM nation")
def src_17(spark, sf_dir):
    """Pinned checkouts side by side: one that is too large isn't begun, one that fails stops no other."""
    rows = {f"o/{r['name']}": r["k"] for r in nations(spark, sf_dir).collect()}  # few nations

    def run(args, **kwargs):
        from types import SimpleNamespace

        repo = next(r for r in rows if any(a.endswith((f"/{r.replace('/', '__')}", f"/{r}.git")) for a in args))
        return SimpleNamespace(returncode=int(rows[repo] % 4 == 3), stdout=f"{rows[repo]:040d}\n", stderr="gone")

    folder = local_path(scratch(spark, "clones"))
    done = mirror.acquire(list(rows), folder, lambda repo, f: client.clone(repo, f, run), {r: (k % 4 == 2) * 9_000 for r, k in rows.items()}, 5, 0)
    return spark.createDataFrame([(r, sha, status) for r, sha, status, _ in done], "repo string, commit_sha string, status string")


@query("INC-05", "SELECT 'o/' || n_name AS repo, CASE WHEN n_nationkey % 2 = 0 THEN 1 ELSE 2 END::BIGINT AS commands FROM nation")
def inc_05(spark, sf_dir):
    """A checkout that is there is used again: it is asked for its commit only."""
    from types import SimpleNamespace

    folder, out = local_path(scratch(spark, "again")), []
    for r in nations(spark, sf_dir).collect():  # few nations
        if r["k"] % 2 == 0:
            os.makedirs(os.path.join(folder, f"o__{r['name']}", ".git"))
        calls: list = []
        client.clone(f"o/{r['name']}", folder, lambda args, calls=calls, **kwargs: calls.append(args) or SimpleNamespace(returncode=0, stdout="c\n", stderr=""))
        out.append((f"o/{r['name']}", len(calls)))
    return spark.createDataFrame(out, "repo string, commands long")


# ---- scalar functions --------------------------------------------------------------------------------------------------


@query("FN-01", "SELECT doc_id, sha256(trim(regexp_replace(lower(nfc_normalize(left(text, 2000))), '[^\\p{L}\\p{N}]+', '-', 'g'), '-')) AS slug FROM documents")
def fn_01(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", F.sha2(text.slug(F.left("text", F.lit(2000))), 256).alias("slug"))


@query("FN-06", "SELECT o_orderkey, CASE WHEN o_orderkey % 5 = 0 THEN NULL WHEN o_orderkey % 2 = 1 THEN 'Web' ELSE ['zig', 'heap'][o_orderkey % 4 // 2 + 1] END AS category FROM orders")
def fn_06(spark, sf_dir):
    """The first tag that names a category, else the first tag."""
    k = F.col("o_orderkey")
    first = pick(["zig", "heap"], F.floor(k % 4 / 2))
    tags = F.when(k % 5 == 0, F.array().cast("array<string>")).when(k % 2 == 1, F.array(first, F.lit("Web"), F.lit("crypto"))).otherwise(F.array(first))
    return table(spark, sf_dir, "orders").select("o_orderkey", text.pick_category(tags).alias("category"))


_DIR = "regexp_replace(regexp_replace(split_part(split_part(url, '#', 1), '?', 1), '^[^:]*://[^/]*', ''), '[^/]*$', '')"


@query("FN-09", f"SELECT page_id, regexp_extract(url, '^[^:]*://[^/?#]*') || '/abs/x?y' AS top, regexp_extract(url, '^[^:]*://[^/?#]*') || CASE WHEN {_DIR} IN ('', '/') THEN '/' ELSE regexp_replace({_DIR}, '[^/]+/$', '') END || 'x?y' AS up FROM pages")
def fn_09(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", html.join_url(F.col("url"), F.lit("/abs/x?y")).alias("top"), html.join_url(F.col("url"), F.lit("../x?y")).alias("up"))


# ---- the relations that loops hide -------------------------------------------------------------------------------------


@query("REL-theta", "SELECT p_partkey, min_by(k, (-length(k), k)) AS word FROM part, (SELECT unnest(['steel', 'widget', 'red', 'e', 'green w', 'blue']) AS k) WHERE contains(p_name, k) GROUP BY 1")
def rel_theta(spark, sf_dir):
    """The longest of few words that a text holds: a nested-loop join with a list of known size, ranked."""
    words = spark.createDataFrame([(w,) for w in ("steel", "widget", "red", "e", "green w", "blue")], "k string")
    joined = table(spark, sf_dir, "part").select("p_partkey", "p_name").join(F.broadcast(words), F.contains("p_name", F.col("k")))
    return joined.groupBy("p_partkey").agg(F.min_by("k", F.struct(-F.length("k"), "k")).alias("word"))


@query("REL-union", "SELECT r, min(pos) AS pos FROM (SELECT 's' || (n_nationkey % 10) AS r, n_nationkey::BIGINT AS pos FROM nation UNION ALL SELECT 's' || r_regionkey * 4, 1000 + r_regionkey FROM region) GROUP BY 1")
def rel_union(spark, sf_dir):
    """Ordered tables one after the other, each value at its first place."""
    n, r = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    a = n.select(F.concat(F.lit("s"), (F.col("n_nationkey") % 10).cast("string")).alias("r"), F.col("n_nationkey").cast("long").alias("pos"))
    b = r.select(F.concat(F.lit("s"), (F.col("r_regionkey") * 4).cast("string")).alias("r"), (F.col("r_regionkey") + 1000).cast("long").alias("pos"))
    return discovery.first_seen(a.unionByName(b), "r", "pos")


@query("REL-top", "SELECT o_custkey, count(*)::BIGINT AS n FROM orders GROUP BY 1 ORDER BY n DESC, o_custkey LIMIT 10")
def rel_top(spark, sf_dir):
    return catalog.counts(table(spark, sf_dir, "orders"), "o_custkey").limit(10)


@query("REL-sorted", "SELECT o_custkey, string_agg(o_orderkey::VARCHAR, ',' ORDER BY o_totalprice DESC, o_orderkey) AS keys FROM orders GROUP BY 1")
def rel_sorted(spark, sf_dir):
    o = table(spark, sf_dir, "orders").groupBy("o_custkey").agg(F.sort_array(F.collect_list(F.struct((-F.col("o_totalprice")).alias("p"), F.col("o_orderkey").cast("long").alias("k")))).alias("x"))
    return o.select("o_custkey", F.array_join(F.transform("x", lambda s: s["k"].cast("string")), ",").alias("keys"))


# ---- orchestration -----------------------------------------------------------------------------------------------------


@query("ORC-05", "SELECT 'o/' || n_name AS repo, (row_number() OVER (ORDER BY n_nationkey % 3, n_nationkey) - 1)::VARCHAR AS pos FROM nation UNION ALL SELECT 'o' || c_custkey % 7 || '/' || ['ctf-writeups', 'tasks', 'plain'][c_custkey % 3 + 1] || c_custkey, NULL FROM customer")
def orc_05(spark, sf_dir):
    """Seeds and then discovered repositories, each once."""
    found = ingest.resolve(spark, "both", records.read_seeds(spark, seed_file(spark, sf_dir)), staged(candidate_rows(spark, sf_dir), "candidates"))
    return found.select("repo", F.when(F.col("pos") < 1 << 40, F.col("pos").cast("string")).alias("pos"))


@query("FLT-19", "SELECT 'o' || c_custkey % 7 || '/' || ['ctf-writeups', 'tasks', 'plain'][c_custkey % 3 + 1] || c_custkey AS repo, (CASE WHEN c_custkey % 3 <> 0 THEN c_custkey * 10 END)::VARCHAR AS size_kb, c_custkey % 3 <> 0 AND c_custkey * 10 > 2048 AS too_big FROM customer")
def flt_19(spark, sf_dir):
    """Of discovered repositories, those over the cap; an unknown size passes."""
    found = candidate_rows(spark, sf_dir)
    return ingest.sized(found.select(F.col("full_name").alias("repo")), found, 2).withColumn("size_kb", F.col("size_kb").cast("string"))

