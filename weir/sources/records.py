"""Sources of records: catalogs, candidates, seeds, challenge lists, sitemaps, pages and recorded event feeds."""

from __future__ import annotations

from dataclasses import dataclass

import yaml
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weir import schema
from weir.functions import html, license, paths, text
from weir.stage import numbered, scratch, staged

#: A sources' registry: name -> function (spark, options) -> DataFrame of raw records.
REGISTRY: dict = {}
SEED_SECTIONS = ["official_sources", "community_archives", "writeup_archives"]


def source(name: str):
    """Registers a source. Its result has the raw contract, whatever the source reads."""

    def wrap(f):
        REGISTRY[name] = f
        return f

    return wrap


def raw(df: DataFrame, **columns: Column) -> DataFrame:
    """Rows of the raw contract: given columns, and null or empty for the rest."""
    empty = {"tags", "files", "writeups"}
    made = []
    for f in schema.RAW:
        col = columns.get(f.name, F.array() if f.name in empty else F.lit(None))
        made.append(col.cast(f.dataType).alias(f.name))
    return df.select(*made)


def make(contract: T.StructType, /, **values: Column) -> Column:
    """A struct of a contract from some of its fields, which may have any name."""
    return F.struct(*[values.get(f.name, F.lit(False) if f.name.startswith("is_") else F.lit(None)).cast(f.dataType).alias(f.name) for f in contract])


def read_catalog(spark: SparkSession, path) -> DataFrame:
    """Catalog shards; blank lines are no rows, and lines that don't fit are left out. read_checked() keeps those apart."""
    return spark.read.schema(schema.CHALLENGE).option("mode", "DROPMALFORMED").json(path)


@dataclass
class Checked:
    """rows under the contract; quarantine (file, line, reason); and how many lines, rows and lines of each reason there were."""

    rows: DataFrame
    quarantine: DataFrame
    counts: dict[str, int]


#: Why a line isn't taken, the first that holds: it is no JSON object or a value has another type, or the contract asks for more.
REASONS = ["malformed", "no id", "no title"]


def read_checked(spark: SparkSession, path) -> Checked:
    """Catalog shards with what doesn't fit kept apart. Every line is read and parsed once: rows and quarantine are written by
    the same pass, each to a partition of its own in the shared folder, and the counts are observed on the way."""
    parsed = F.from_json("value", T.StructType([*schema.CHALLENGE, T.StructField("__bad", T.StringType())]), {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "__bad"})
    lines = spark.read.text(path).where(F.trim(F.regexp_replace("value", r"\s", " ")) != "").select("value", F.col("_metadata.file_path").alias("file"))
    found = lines.withColumn("row", parsed)
    object_ = F.startswith(F.ltrim("value"), F.lit("{")) & F.col("row").isNotNull() & F.col("row.__bad").isNull()
    reason = F.when(~object_, REASONS[0]).when(F.coalesce("row.id", F.lit("")) == "", REASONS[1]).when(F.col("row.title").isNull(), REASONS[2])
    judged = found.select("row", "value", "file", reason.alias("reason"))
    kept = judged.select(
        F.when(F.col("reason").isNull(), F.struct(*[F.col(f"row.{f.name}") for f in schema.CHALLENGE])).alias("row"), F.when(F.col("reason").isNotNull(), F.col("value")).alias("line"),
        F.when(F.col("reason").isNotNull(), F.col("file")).alias("file"), "reason", F.col("reason").isNull().alias("fits"),
    )
    seen, to = Observation(), scratch(spark, "checked")
    counts = [F.count("*").alias("lines"), F.count_if("fits").alias("rows"), *[F.count_if(F.col("reason") == r).alias(r) for r in REASONS]]
    kept.observe(seen, *counts).write.partitionBy("fits").parquet(to)
    whole = spark.read.schema(kept.schema).parquet(to)
    return Checked(whole.where("fits").select("row.*"), whole.where("not fits").select("file", "line", "reason"), {k: seen.get[k] for k in ("lines", "rows", *REASONS)})


def read_candidates(spark: SparkSession, path: str) -> DataFrame:
    """Discovered repositories; a missing file is an empty table."""
    try:
        return spark.read.schema(schema.CANDIDATE).json(path)
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema.CANDIDATE)


def _yaml(spark: SparkSession, path: str):
    """A small YAML file, of any store that Spark reads, as the driver's values; a folder is its one file."""
    rows = spark.read.text(path, wholetext=True).head(2)
    if len(rows) > 1:
        raise ValueError(f"{path} is more than one file")
    return yaml.safe_load(rows[0]["value"]) if rows else None


def read_seeds(spark: SparkSession, path: str, only: list[str] | None = None) -> DataFrame:
    """Curated repositories with their place, section by section. The file is small configuration, read on the driver."""
    doc = _yaml(spark, path) or {}
    rows = [(s, e) for s in SEED_SECTIONS for e in doc.get(s) or [] if isinstance(e, dict) and e.get("repo")]
    rows = [(s, e) for s, e in rows if only is None or e["repo"] in only]
    keys = ("repo", "kind", "license", "official", "layout", "note")
    made = [(i, s, *[bool(e.get(k)) if k == "official" else None if e.get(k) is None else str(e[k]) for k in keys]) for i, (s, e) in enumerate(rows)]
    return spark.createDataFrame(made, schema.SEED)


def discovered_seeds(seeds: DataFrame, candidates: DataFrame, only: list[str] | None = None, max_mb: int = 2_048) -> DataFrame:
    """Seeds and, after them, candidates that are none of them, fit the filter and aren't known to be larger than the cap."""
    extra = candidates.where(F.coalesce("size_kb", F.lit(0)) <= max_mb * 1_024).join(seeds.select(F.col("repo").alias("full_name")), "full_name", "left_anti")
    if only is not None:
        extra = extra.where(F.col("full_name").isin(only))
    placed = staged(extra.select("full_name", "kind", F.monotonically_increasing_id().alias("at")), "extra")
    first = placed.groupBy("full_name").agg(F.min_by("kind", "at").alias("kind"), F.min("at").alias("at"))
    made = numbered(first, ["at"], "place").select(
        (F.lit((1 << 20) + 1) + F.col("place")).cast("int").alias("pos"), F.lit("discovered").alias("section"), F.col("full_name").alias("repo"), "kind", F.lit(None).cast("string").alias("license"), F.lit(False).alias("official"),
        F.lit(None).cast("string").alias("layout"), F.lit("discovered by search").alias("note"),
    )
    return seeds.unionByName(made)


def candidate(item: Column) -> Column:
    """A candidate from a search result's object, given as a struct (see API_ITEM)."""
    topics = F.filter(F.coalesce(item["topics"], F.array().cast("array<string>")), lambda t: t.isNotNull())
    spdx = item["license"]["spdx_id"]
    values = {
        "full_name": F.coalesce(item["full_name"], F.lit("")),
        "html_url": F.coalesce(item["html_url"], F.concat(F.lit("https://github.com/"), F.coalesce(item["full_name"], F.lit("")))),
        "stars": F.coalesce(item["stargazers_count"], F.lit(0)),
        "pushed_at": text.timestamp(item["pushed_at"]),
        "created_at": text.timestamp(item["created_at"]),
        "topics": topics,
        "description": item["description"],
        "license_spdx": F.when(~spdx.isin("NOASSERTION", ""), spdx),
        "default_branch": item["default_branch"],
        "size_kb": F.coalesce(item["size"], F.lit(0)),
        "kind": paths.kind_of_repo(F.coalesce(item["full_name"], F.lit("")), item["description"], topics),
    }
    return make(schema.CANDIDATE, **values)


API_ITEM = "full_name string, html_url string, stargazers_count int, pushed_at string, created_at string, topics array<string>, description string, license struct<spdx_id:string>, default_branch string, size long"


def read_search_pages(spark: SparkSession, path) -> DataFrame:
    """Recorded search responses (total_count, items) as candidates, in the order of files and items."""
    pages = spark.read.option("multiLine", True).schema(_pages_schema()).json(path)
    items = pages.select(F.monotonically_increasing_id().alias("page"), F.posexplode("items").alias("pos", "item"))
    return items.select("page", "pos", candidate(F.col("item")).alias("c")).select("page", "pos", "c.*")


def _pages_schema() -> T.StructType:
    return T.StructType([T.StructField("total_count", T.LongType()), T.StructField("items", T.ArrayType(T.StructType.fromDDL(API_ITEM)))])


@source("yaml_list")
def yaml_list(spark: SparkSession, path: str, event: str = "OWASP Juice Shop", url: str = "https://github.com/juice-shop/juice-shop", repo: str = "juice-shop/juice-shop", spdx: str = "MIT") -> DataFrame:
    """A YAML list of challenges of one event. Entries that are no map or have no name are left out."""
    doc = _yaml(spark, path) or []
    rows = []
    for e in doc if isinstance(doc, list) else []:
        if isinstance(e, dict) and e.get("name"):
            tags = e.get("tags")
            tags = [] if tags is None else tags.split(",") if isinstance(tags, str) else tags if isinstance(tags, list) else [tags]
            one = lambda k: None if e.get(k) is None else str(e[k])  # noqa: B023, E731
            rows.append((str(e["name"]), one("category"), one("description"), one("difficulty"), [str(t).strip() for t in tags if str(t).strip()], one("mitigationUrl"), one("hintUrl"), one("key")))
    df = spark.createDataFrame(rows, "name string, category string, description string, difficulty string, tags array<string>, mitigation string, hint string, key string")
    links = F.array(*[F.when(F.col(c).isNotNull(), make(schema.WRITEUP, url=F.col(c), origin=F.lit("juiceshop"), title=F.lit(t))) for c, t in (("mitigation", "Mitigation"), ("hint", "Hint"))])
    src = make(schema.SOURCE, origin=F.lit("juiceshop"), url=F.lit(url), repo=F.lit(repo), is_official=F.lit(True), license=license.from_spdx(F.lit(spdx)))
    return raw(
        df, origin=F.lit("juiceshop"), title=F.col("name"), event_name=F.lit(event), raw_category=F.col("category"), tags=F.col("tags"), difficulty=F.col("difficulty"),
        description=F.col("description"), writeups=F.filter(links, lambda x: x.isNotNull()), source=src, extra=F.to_json(F.struct("key")),
    )


def read_sitemap(spark: SparkSession, path: str, contains: str = "/challenges/") -> DataFrame:
    """(pos, url) of a sitemap's locations that hold a text, each once, in the order of first sight."""
    rows = spark.read.format("xml").option("rowTag", "url").schema("loc string").load(path)
    placed = rows.select(F.trim("loc").alias("url"), F.monotonically_increasing_id().alias("pos")).where(F.contains("url", F.lit(contains)))
    return placed.groupBy("url").agg(F.min("pos").alias("pos")).select("pos", "url")


def page_records(pages: DataFrame, default_event: str = "Hackropole", html_col: str = "html", url_col: str = "url") -> tuple[DataFrame, DataFrame]:
    """(raw records, failures) of saved challenge pages (url, html). A page that can't be read is a failure and nothing else."""
    read = pages.select(F.col(url_col).alias("url"), html.parsed(html.challenge_page, F.col(html_col), F.col(url_col)).alias("p"))
    good = read.where("p.error is null and p.badges is not null")
    p = F.col("p")
    slug = text.url_slug(F.col("url"))
    label = F.coalesce(text.url_category(F.col("url")), F.nullif(F.trim(F.split_part(F.coalesce(p["keywords"], F.lit("")), F.lit(","), F.lit(1))), F.lit("")))
    year = r"(?:19|20)\d{2}"
    other = F.filter(p["badges"], lambda b: label.isNull() | (b["slug"] != label))
    dated = F.filter(other, lambda b: b["slug"].rlike(year) | b["label"].rlike(year))
    event = F.coalesce(F.nullif(F.try_element_at(F.filter(dated, lambda b: b["label"] != ""), F.lit(-1))["label"], F.lit("")), F.lit(default_event))
    tags = F.transform(F.filter(other, lambda b: ~(b["slug"].rlike(year) | b["label"].rlike(year)) & (b["slug"] != "")), lambda b: b["slug"])
    at = F.coalesce(F.nullif(F.regexp_extract(event, year, 0), F.lit("")), F.nullif(F.regexp_extract(slug, year, 0), F.lit("")))
    notes = F.transform(p["writeups"], lambda u: make(schema.WRITEUP, url=u, origin=F.lit("hackropole")))
    src = make(schema.SOURCE, origin=F.lit("hackropole"), url=F.col("url"), is_official=F.lit(True), license=license.from_spdx(F.lit("etalab-2.0"), note=F.lit("content under Licence Ouverte 2.0")))
    records = raw(
        good, origin=F.lit("hackropole"), title=F.coalesce(F.nullif(p["og_title"], F.lit("")), p["h1"], slug), event_name=event, year=at.try_cast("int"), raw_category=label, tags=tags,
        difficulty=F.when(p["stars"] > 0, F.concat(p["stars"].cast("string"), F.lit("/5"))), description=p["description"], writeups=notes, source=src,
        extra=F.to_json(F.struct(slug.alias("slug"), p["authors"].alias("authors"), p["files"].alias("files"))),
    )
    return records, read.where("p.error is not null").select("url", "p.error")


@source("saved_pages")
def saved_pages(spark: SparkSession, path: str, limit: int | None = None) -> DataFrame:
    """Saved challenge pages, a Parquet table (url, html)."""
    pages = spark.read.parquet(path)
    return page_records(pages.limit(limit) if limit is not None else pages)[0]


API_EVENT = "id long, ctf_id long, title string, start string, finish string, weight double, format string, ctftime_url string, url string"


def events(df: DataFrame) -> DataFrame:
    """(id, event) of rows with API_EVENT's columns."""
    start = text.timestamp(F.col("start"))
    blank = lambda c: F.nullif(F.col(c), F.lit(""))
    event = make(
        schema.EVENT, ctftime_event_id=F.col("id"), ctftime_series_id=F.col("ctf_id"), name=F.coalesce(blank("title"), F.lit("unknown-event")), year=F.year(start), start=start,
        finish=text.timestamp(F.col("finish")), weight=F.col("weight"), format=F.col("format"), ctftime_url=blank("ctftime_url"), homepage=blank("url"),
    )
    return df.select("id", event.alias("event"))


def task_records(event_rows: DataFrame, task_pages: DataFrame, list_pages: DataFrame, writeup_pages: DataFrame, site: str = "https://ctftime.org", max_writeups: int | None = None, max_events: int | None = None) -> DataFrame:
    """Raw records of recorded event pages, one for each task: event_rows as API_EVENT; task_pages (event_id, html) hold the
    task tables, list_pages (task_id, html) the writeups of a task, writeup_pages (writeup_id, html) the writeups. Events
    without a task page have no records; a page that is missing or can't be read leaves out what it would tell. max_events: only
    the first so many events by start and id, those without a start last; max_writeups: of each task at most so many."""
    if max_events is not None:
        event_rows = event_rows.dropDuplicates(["id"]).orderBy(text.timestamp(F.col("start")).asc_nulls_last(), "id").limit(max_events)
        task_pages = task_pages.join(event_rows.select(F.col("id").alias("event_id")), "event_id", "left_semi")  # others aren't parsed
    known = events(event_rows)
    tasks = html.table_rows(html.task_rows, task_pages.select("event_id", "html")).where("error is null").drop("error")
    listed = html.table_rows(html.writeup_rows, list_pages.select("task_id", "html")).where("error is null").select("task_id", F.col("pos").alias("nth"), F.col("id").alias("writeup_id"), "rating", "author")
    if max_writeups is not None:
        listed = listed.where(F.col("nth") < max_writeups)
    bodies = writeup_pages.select("writeup_id", html.parsed(html.writeup_page, F.col("html")).alias("p")).where("p.error is null").select("writeup_id", "p.body", "p.external", F.lit(True).alias("seen"))
    own = F.concat(F.lit(f"{site}/writeup/"), F.col("writeup_id").cast("string"))
    inline = F.col("body").isNotNull()
    away = ~inline & F.col("external").isNotNull()
    one = make(
        schema.WRITEUP, url=F.when(away, F.col("external")).otherwise(own), origin=F.when(away, text.writeup_origin(F.col("external"))).otherwise("ctftime"), author=F.col("author"),
        text=F.col("body"), is_inline=inline, rating=text.first_float(F.col("rating")),
    )
    notes = listed.join(bodies, "writeup_id").groupBy("task_id").agg(F.sort_array(F.collect_list(F.struct("nth", one.alias("w")))).alias("ws")).select("task_id", F.col("ws.w").alias("writeups"))
    joined = tasks.join(known.withColumnRenamed("id", "event_id"), "event_id").join(notes, tasks["id"] == notes["task_id"], "left")
    src = make(schema.SOURCE, origin=F.lit("ctftime"), url=F.concat(F.lit(f"{site}/task/"), F.col("id").cast("string")), license=license.unknown())
    return raw(
        joined, origin=F.lit("ctftime"), title=F.col("name"), event_name=F.col("event.name"), year=F.col("event.year"), raw_category=text.pick_category(F.col("tags")), tags=F.col("tags"),
        points=text.first_int(F.col("points")), writeups=F.coalesce("writeups", F.array().cast(schema.RAW["writeups"].dataType)), source=src,
        extra=F.to_json(F.struct(F.col("event.ctftime_event_id"), F.col("event.ctftime_series_id"), F.col("id").alias("ctftime_task_id"))),
    )


@source("event_pages")
def event_pages(spark: SparkSession, path: str, max_writeups: int | None = None, max_events: int | None = None) -> DataFrame:
    """Recorded pages of an event site below a folder: events.json (a JSON list), and Parquet tables tasks (event_id, html),
    lists (task_id, html) and writeups (writeup_id, html)."""
    rows = spark.read.schema(API_EVENT).option("multiLine", True).json(f"{path}/events.json")
    return task_records(rows, *(spark.read.parquet(f"{path}/{n}") for n in ("tasks", "lists", "writeups")), max_writeups=max_writeups, max_events=max_events)


@source("checkouts")
def checkouts(spark: SparkSession, path: str, seeds: str, discovered: str | None = None, only: list[str] | None = None, limit: int | None = None, max_mb: int = 2_048) -> DataFrame:
    """Challenges of checked-out repositories, a folder of folders owner__name: those that a seeds file names and, after
    them, discovered ones. A repository without a checkout has no records; each is a partition of the listing."""
    from weir.operators import walk  # which uses this module
    from weir.sources.trees import heads_of_commits, read_tree

    known = read_seeds(spark, seeds, only)
    if discovered is not None:
        known = discovered_seeds(known, read_candidates(spark, discovered), only, max_mb)
    known = staged(known, "seeds")
    tree = read_tree(spark, path, checkouts="true", heads="license,licence,copying,unlicense,challenge.json")
    tree = tree.join(known.select(F.col("repo").alias("tree")).distinct(), "tree", "left_semi")
    return walk.records(tree, known, heads_of_commits(spark, path), limit=limit)
