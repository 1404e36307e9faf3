"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

Each document draws an exponential key divided by its quality weight. A source whose target holds whole multiples of its
size takes complete epochs of all its documents first; what is left of the target goes to its documents in the order of
their keys, by the prefix sums of their sizes. Prefix sums are taken in two steps, within ranges of source and key that are
cut by sampled splitters, and over the ranges, so that no task holds a whole source or many equal keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weir.llm.shared import small, staged

WORD = r"[^\x20\x09-\x0D]+"


def uniform(*cols: Column) -> Column:
    """A number in (0, 1) that depends on the values only."""
    text = F.concat_ws(":", *[F.coalesce(c.cast("string"), F.lit("")) for c in cols])
    return (F.conv(F.substring(F.md5(text), 1, 12), 16, 10).cast("double") + 0.5) / float(1 << 48)


def quality(text: Column) -> Column:
    """A weight from 0.01 to 1: the share of letters among the characters that aren't white space."""
    letters = F.char_length(F.regexp_replace(text, r"[^\p{L}]+", ""))
    return F.greatest(F.lit(0.01), letters / F.greatest(F.lit(1), F.char_length(F.regexp_replace(text, r"[\x20\x09-\x0D]+", ""))))


def sized(df: DataFrame, id_col: str, text_col: str, seed: int) -> list[Column]:
    """The columns by which a document is dealt: its words, and its exponential key scaled by its quality. The key comes from
    id and text, so that documents without an id, or of one id, have keys of their own."""
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    drawn = -F.log(uniform(F.col(f"`{id_col}`"), F.lit(seed), F.md5(text)))
    return [F.regexp_count(text, F.lit(WORD)).cast("long").alias("size"), (drawn / quality(text)).alias("key")]


def fill(sources: DataFrame, factor: float, cap: float) -> DataFrame:
    """sources (source, source_size, weight, docs) with target: `factor` of all sizes, shared by weight; no target is above
    `cap` times its size, and what is cut is shared again until none is. Every round is one aggregate of the sources."""
    total = factor * (sources.agg(F.sum("source_size")).first()[0] or 0)
    level, limit = -1.0, F.lit(cap) * F.col("source_size")
    while True:
        full = limit <= F.lit(level) * F.col("weight")
        row = sources.agg(F.sum(F.when(full, limit).otherwise(0.0)).alias("cut"), F.sum(F.when(full, 0.0).otherwise(F.col("weight").cast("double"))).alias("weight")).first()
        new = (total - row["cut"]) / row["weight"] if row["weight"] else level
        if new <= level:
            break
        level = new
    return sources.withColumn("target", F.round(F.least(limit, F.lit(level) * F.col("weight")), 6))


def plan(df: DataFrame, weights, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", factor: float = 1.5, cap: float = 2.0, seed: int = 0) -> tuple[DataFrame, DataFrame]:
    """(documents, sources) of a mix, both written and read again.

    documents: id, source, size, key, row, for every row of df; row tells equal ones apart. sources: source, source_size,
    docs, weight, target. weights: a function of the table (source, source_size, docs) that adds a column weight of 0 or more.
    """
    own = [F.col(f"`{id_col}`").alias("id"), F.col(f"`{source_col}`").alias("source"), *sized(df, id_col, text_col, seed), F.monotonically_increasing_id().alias("row")]
    rows = staged(df.select(*own), "sized")
    sums = staged(rows.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("docs")), "sources")
    sources = staged(fill(staged(weights(sums), "weights"), factor, cap), "targets")
    return rows, sources


def placed(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """rows with their source's columns and `before`, the words of the source that come before the row's in key order."""
    order = ["key", "id", "size", "row"]
    ranges = rows.repartitionByRange("source", *order).withColumn("range", F.spark_partition_id())
    ranges = staged(ranges, "ranges")
    sums = ranges.groupBy("source", "range").agg(F.sum("size").alias("words"))
    over = Window.partitionBy("source").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)  # a row for each range
    offsets = sums.select(F.col("source").alias("s"), F.col("range").alias("r"), F.coalesce(F.sum("words").over(over), F.lit(0)).alias("offset"))
    within = Window.partitionBy("source", "range").orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    ranked = ranges.withColumn("inner", F.coalesce(F.sum("size").over(within), F.lit(0)))
    ranked = ranked.join(small(staged(offsets, "offsets")), F.col("source").eqNullSafe(F.col("s")) & (F.col("range") == F.col("r")))
    one = sources.withColumnRenamed("source", "of")
    return ranked.withColumn("before", F.col("offset") + F.col("inner")).join(small(one), F.col("source").eqNullSafe(F.col("of"))).drop("s", "r", "offset", "inner", "of")


def _epochs() -> tuple[Column, Column]:
    """Complete epochs, and the words left for a fractional one."""
    whole = F.round("target").cast("long")
    epochs = F.when(F.col("source_size") > 0, F.floor(whole / F.col("source_size"))).otherwise(0).cast("long")
    return epochs, whole - epochs * F.col("source_size")


def taken(rows: DataFrame, sources: DataFrame) -> DataFrame:
    """rows with `taken`, the words that the mix takes of each. The document at which a target ends gives the part of its
    words that is left, so the words taken of a source are its target, rounded."""
    epochs, rest = _epochs()
    part = F.greatest(F.lit(0), F.least(F.col("size"), rest - F.col("before")))
    return placed(rows, sources).withColumn("taken", (epochs * F.col("size") + part).cast("long"))


def mix(df: DataFrame, weights, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", factor: float = 1.5, cap: float = 2.0, seed: int = 0) -> DataFrame:
    """df with each row as often as the mix takes it, in whole documents: the document at which a source's target ends is
    taken if half of it or more fits.

    Texts aren't shuffled: the plan gives each source a number of epochs and the last key taken, which are joined to the
    rows. Rows with equal id, size and text have one key and are taken or left together. Null and blank texts have no words
    and are taken with the words before them; a null source is a source. An empty table gives an empty one. Columns may have
    any name, with points or like those used here.
    """
    rows, sources = plan(df, weights, id_col, text_col, source_col, factor, cap, seed)
    epochs, rest = _epochs()
    fits = placed(rows, sources).where(F.col("before") + F.col("size") / 2 <= rest)
    last = staged(fits.groupBy("source").agg(F.max(F.struct("key", "id", "size")).alias("last")), "last")
    ends = sources.select(F.col("source").alias("of"), epochs.alias("epochs")).join(last, F.col("of").eqNullSafe(F.col("source")), "left").drop("source")
    plain = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("all"), F.col(f"`{source_col}`").alias("source"), F.struct(*reversed(sized(df, id_col, text_col, seed))).alias("dealt"), F.col(f"`{id_col}`").alias("id"))
    joined = plain.join(small(staged(ends, "ends")), F.col("source").eqNullSafe(F.col("of")))
    own = F.struct(F.col("dealt.key").alias("key"), "id", F.col("dealt.size").alias("size"))
    copies = F.col("epochs") + F.coalesce((own <= F.col("last")).cast("long"), F.lit(0))
    taken_ = joined.select("all", copies.alias("copies")).where("copies > 0").withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))))
    return taken_.select("all.*")


def weights_by_name(sums: DataFrame) -> DataFrame:
    """3, 1, 2, repeating, for the sources by code point, null last. One row for each source: no row of a document."""
    nth = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    return sums.withColumn("weight", F.element_at(F.array(F.lit(3), F.lit(1), F.lit(2)), (nth % 3 + 1).cast("int")))


def op4_mixing(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = taken(*plan(docs, weights_by_name))
    return out.select(F.col("id").alias("doc_id"), "size", "source_size", "target", "taken")


OP4_SQL = r"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS size,
    -ln((('0x' || substr(md5(coalesce(doc_id::VARCHAR, '') || ':0:' || md5(coalesce(text, ''))), 1, 12))::BIGINT + 0.5::DOUBLE) / 281474976710656::DOUBLE)
      / greatest(0.01::DOUBLE, length(regexp_replace(coalesce(text, ''), '[^\p{L}]+', '', 'g'))
        / greatest(1, length(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', '', 'g')))::DOUBLE) AS key
  FROM documents),
s AS (
  SELECT source, sum(size)::BIGINT AS source_size, [3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1]::DOUBLE AS weight
  FROM d GROUP BY source),
r AS (
  SELECT *, coalesce(sum(2.0::DOUBLE * source_size) OVER w, 0) AS cut, (SELECT sum(weight) FROM s) - coalesce(sum(weight) OVER w, 0) AS open
  FROM s WINDOW w AS (ORDER BY source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
l AS (
  SELECT (1.5::DOUBLE * (SELECT sum(source_size) FROM s) - cut) / open AS level
  FROM r WHERE 2.0::DOUBLE * source_size >= (1.5::DOUBLE * (SELECT sum(source_size) FROM s) - cut) / open * weight
  ORDER BY source_size / weight, source NULLS LAST LIMIT 1),
t AS (SELECT source, source_size, round(least(2.0::DOUBLE * source_size, level * weight), 6) AS target FROM s, l),
e AS (SELECT *, round(target)::BIGINT AS whole, CASE WHEN source_size > 0 THEN round(target)::BIGINT // source_size ELSE 0 END AS epochs FROM t),
b AS (
  SELECT *, coalesce(sum(size) OVER (PARTITION BY source ORDER BY key, doc_id, size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before FROM d)
SELECT doc_id, size::BIGINT AS size, source_size, target,
  (epochs * size + greatest(0, least(size, whole - epochs * source_size - before)))::BIGINT AS taken
FROM b JOIN e ON b.source IS NOT DISTINCT FROM e.source
"""
