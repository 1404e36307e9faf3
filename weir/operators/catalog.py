"""Operators over catalogs: normalization, clustering and merging of mirrors, upsert and statistics."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weir import schema
from weir.functions import license, text
from weir.sources.records import make
from weir.stage import staged

# How far each origin is trusted; others count as 0.
AUTHORITY = {"google_ctf": 5, "hackropole": 5, "juiceshop": 5, "nyu_ctf_bench": 4, "sajjadium": 3, "pwncollege": 3, "ctftime": 2, "github": 1}


def normalize(raw: DataFrame, ingested_at: Column | None = None, slug=text.slug) -> DataFrame:
    """Challenges of raw records, in one projection. Columns that raw records don't have, such as an order, are kept."""
    first = raw.withColumns({"__category": text.category(F.col("raw_category")), "__slug": slug(F.col("title"))})
    first = first.withColumn("__id", text.challenge_id(F.col("event_name"), F.col("year"), F.col("title"), F.col("__category"), slug))
    files, src = F.coalesce("files", F.array().cast(schema.RAW["files"].dataType)), F.col("source")
    event = F.when(F.col("event_name") != "", make(schema.EVENT, name=F.col("event_name"), edition=F.col("edition"), year=F.col("year")))
    values = {
        "id": F.col("__id"), "title": F.col("title"), "slug": F.coalesce(F.nullif(F.col("__slug"), F.lit("")), F.concat(F.lit("chal-"), F.substring("__id", 1, 8))), "event": event,
        "event_name": F.col("event_name"), "year": F.col("year"), "category": F.col("__category"), "raw_category": F.col("raw_category"), "tags": F.col("tags"),
        "difficulty": F.col("difficulty"), "points": F.col("points"), "description": F.col("description"), "flag": F.col("flag"), "has_source": text.has_source(files), "files": files,
        "solve_languages": text.solve_languages(files), "docker": text.has_docker(files), "writeups": F.col("writeups"),
        "sources": F.when(src.isNotNull(), F.array(src)).otherwise(F.array().cast(schema.CHALLENGE["sources"].dataType)), "license": F.coalesce(src["license"], license.unknown()),
        "content_fingerprint": text.fingerprint(files), "corpus_path": F.col("local_dir"), "ingested_at": F.lit(None) if ingested_at is None else ingested_at, "schema_version": F.lit(schema.SCHEMA_VERSION),
    }
    made = [values.get(f.name, F.lit(None)).cast(f.dataType).alias(f.name) for f in schema.CHALLENGE]
    return first.select(*made, *[c for c in raw.columns if c not in schema.RAW.names and c not in values])


def cluster_key(fingerprint: Column, id_: Column) -> Column:
    return F.coalesce(fingerprint, F.concat(F.lit("__nofp__:"), id_))


def origin_rank(origin: Column) -> Column:
    return F.coalesce(F.try_element_at(F.create_map(*[F.lit(x) for kv in AUTHORITY.items() for x in kv]), origin), F.lit(0))


def authority(source: Column) -> Column:
    return F.struct(F.coalesce(source["is_official"], F.lit(False)).cast("int").alias("official"), origin_rank(source["origin"]).alias("rank"))


def url_key(url: Column) -> Column:
    """A url with scheme and host in lower case and a path, as links are compared."""
    head = F.regexp_extract(url, r"^([A-Za-z][A-Za-z0-9+.-]*://[^/?#]*)", 1)
    rest = F.regexp_replace(url, r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*", "")
    return F.when(head == "", url).otherwise(F.concat(F.lower(head), F.when(rest.startswith("/"), "").otherwise("/"), rest))


def merge(challenges: DataFrame, pos: str = "input_pos") -> tuple[DataFrame, DataFrame]:
    """(canonical rows, duplicates (id, duplicate_of)). Rows with one fingerprint are one challenge; the row with the most
    trusted source stands for it, the earliest of equal ones, and takes over the sources and writeups of the others that
    it hasn't. `pos` gives the order of rows and has no ties; canonical rows keep the first of their cluster.

    Everything is aggregated by (cluster, edge) before edges meet, with map-side combining: a fingerprint that very many
    rows share costs its distinct edges. The rows are written once, for all branches to read.
    """
    challenges = staged(challenges, "normalized")
    ranks = F.transform("sources", authority)
    c = challenges.withColumn("__cluster", cluster_key(F.col("content_fingerprint"), F.col("id")))
    c = c.withColumn("__rank", F.coalesce(F.array_max(ranks), F.struct(F.lit(0).alias("official"), F.lit(0).alias("rank"))))
    best = c.groupBy("__cluster").agg(F.max_by(pos, F.struct("__rank", (-F.col(pos)).alias("p"))).alias("__best"), F.count("*").alias("__n"), F.min(pos).alias("__first"))
    of = c.join(best, "__cluster")
    canonical = of.where(F.col(pos) == F.col("__best"))
    many = of.where("__n > 1")
    own = F.col(pos) == F.col("__best")

    def folded(column: str, key: Column, order: list[Column]) -> DataFrame:
        e = many.select("__cluster", (~own).cast("int").alias("member"), F.col(pos).alias("at"), F.posexplode(column).alias("nth", "e"))
        others = e.groupBy("__cluster", key.alias("k")).agg(F.min(F.struct("member", "at", "nth", "e")).alias("x")).select("__cluster", "x.*").where("member = 1")
        edges = e.where("member = 0").unionByName(others)
        return edges.groupBy("__cluster").agg(F.sort_array(F.collect_list(F.struct(*order, "member", "at", "nth", "e"))).alias("x")).select("__cluster", F.col("x.e").alias(f"__{column}"))

    e = F.col("e")
    edge = F.struct(e["origin"].alias("o"), F.coalesce(url_key(e["url"]), F.lit("None")).alias("u"), e["repo"].alias("r"), e["path_in_repo"].alias("p"))
    note = F.struct(e["origin"].alias("o"), F.coalesce(url_key(e["url"]), F.lit("None")).alias("u"))
    trust = authority(e)
    sources = folded("sources", edge, [(-trust["official"]).alias("a"), (-trust["rank"]).alias("b")])
    writeups = folded("writeups", note, [])
    joined = canonical.join(sources, "__cluster", "left").join(writeups, "__cluster", "left")
    first = F.try_element_at(F.col("__sources"), F.lit(1))
    changed = {
        "sources": F.coalesce("__sources", "sources"),
        "writeups": F.coalesce("__writeups", "writeups"),
        "license": F.when(first.isNotNull(), first["license"]).otherwise(F.col("license")),
        "__pos": F.col("__first"),
    }
    out = joined.withColumns(changed).drop(pos).withColumnRenamed("__pos", pos).select(*challenges.columns)
    pairs = of.select("__cluster", "id").join(canonical.select("__cluster", F.col("id").alias("duplicate_of")), "__cluster").where(F.col("id") != F.col("duplicate_of")).select("id", "duplicate_of")
    return out, pairs


def upsert(shards: DataFrame, key: str = "id", order: tuple[str, ...] = ("shard_pos", "row_pos")) -> DataFrame:
    """The last row of each key, standing where the first one stood: `order` names the columns that give the order, and the
    first place is kept in `first_<name>`."""
    last = F.max_by(F.struct(*shards.columns), F.struct(*order))
    rows = shards.groupBy(key).agg(last.alias("x"), F.min(F.struct(*order)).alias("first"))
    return rows.select("x.*", *[F.col(f"first.{o}").alias(f"first_{o}") for o in order])


def collisions(challenges: DataFrame) -> DataFrame:
    """(id, fingerprints) of ids that stand for more than one content."""
    return challenges.groupBy("id").agg(F.count_distinct("content_fingerprint").alias("fingerprints")).where("fingerprints > 1")


def stats(challenges: DataFrame) -> DataFrame:
    """One row: total, whitebox, redistributable, with_writeups."""
    yes = lambda c: F.count_if(F.coalesce(c, F.lit(False)))
    return challenges.agg(F.count("*").alias("total"), yes(F.col("has_source")).alias("whitebox"), yes(F.col("license.redistributable")).alias("redistributable"), yes(F.size("writeups") > 0).alias("with_writeups"))


def counts(df: DataFrame, column: str) -> DataFrame:
    """(column, n), the most frequent first."""
    return df.groupBy(column).agg(F.count("*").alias("n")).orderBy(F.col("n").desc(), column)


def corpus_stats(files: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Of a listing: (files, bytes), and the ten most frequent suffixes."""
    own = files.where("not is_dir") if "is_dir" in files.columns else files
    ext = own.select(text.suffix(F.col("path")).alias("suffix"))
    return own.agg(F.count("*").alias("files"), F.coalesce(F.sum("size"), F.lit(0)).alias("bytes")), counts(ext, "suffix").limit(10)


def first_commit(challenges: DataFrame, pos: str = "input_pos") -> DataFrame:
    """One row: the first commit among the sources of the challenges in order."""
    e = challenges.select(pos, F.posexplode("sources").alias("nth", "s")).where("s.commit_sha is not null")
    return e.agg(F.min_by("s.commit_sha", F.struct(pos, "nth")).alias("commit_sha"))


def capped(df: DataFrame, by: str, order: str, n: int) -> DataFrame:
    """The first n rows of each group."""
    return df.withColumn("__nth", F.row_number().over(Window.partitionBy(by).orderBy(order))).where(F.col("__nth") <= n).drop("__nth")


def invalid(challenges: DataFrame) -> DataFrame:
    """Rows that break the contract, with the reasons; values are never clamped."""
    reasons = {
        "no id": F.col("id").isNull() | (F.col("id") == ""),
        "no title": F.col("title").isNull(),
        "category": ~F.col("category").isin(schema.CATEGORIES),
        "confidence": ~F.col("license.confidence").between(0, 1),
        "origin": F.exists("sources", lambda s: ~s["origin"].isin(schema.ORIGINS)),
        "points": F.col("points") < 0,
    }
    why = F.filter(F.array(*[F.when(c, F.lit(k)) for k, c in reasons.items()]), lambda x: x.isNotNull())
    return challenges.withColumn("reasons", why).where(F.size("reasons") > 0)
