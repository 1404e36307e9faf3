"""Sharding by sampled splitters.

Records are ordered by a hash of their text. A sample, drawn with a chance in proportion to size, gives quantile boundaries
of that order; the records between two boundaries are a range. What a range really holds is counted then, and an overfull
one is subdivided into units by another hash. Units go to shards by the running sum of their bytes, so the sizes of shards
are near equal, and records get their slots unit by unit: no task holds a shard.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weir.llm.shared import small, staged

#: Ranges, draws of the sample for each, and records of a unit at most, about.
RANGES, DRAWS, UNIT_ROWS = 512, 16, 100_000
#: A group of equal texts stays in one unit up to this share of a shard's bytes.
WHOLE_GROUP = 0.05


def _uniform(*cols: Column) -> Column:
    return F.pmod(F.xxhash64(*cols, F.lit("draw")), F.lit(1 << 32)) / float(1 << 32)


def splitters(rows: DataFrame, total: int, ranges: int = RANGES, draws: int = DRAWS) -> tuple[list[int], list[int]]:
    """(boundaries, heavy): the least hash of each range but the first, and the hashes that fill a range by themselves.

    A record is drawn floor(size * draws * ranges / total + u) times, u a hash of its values. Equal texts come as one row, so
    that the driver gets about ranges * draws rows whatever the input.
    """
    times = F.floor(F.col("size") * (ranges * draws / max(1, total)) + _uniform("id", "key")).cast("long")
    sample = sorted((r["key"], r["n"]) for r in rows.select("key", times.alias("n")).where("n > 0").groupBy("key").agg(F.sum("n").alias("n")).collect())
    edges, heavy, run = set(), [], 0
    for key, n in sample:
        if n >= draws:
            heavy.append(key)
            edges |= {key, key + 1}
            run = 0
        elif run + n > draws:
            edges.add(key)
            run = n
        else:
            run += n
    return sorted(e for e in edges if e < 1 << 63), heavy


def _range(key: Column, edges: list[int]) -> Column:
    """How many of the edges are no greater than the key: first among every 32nd, then among the 32 that follow."""
    if not edges:
        return F.lit(0)
    blocks = [edges[i : i + 32] for i in range(0, len(edges), 32)]
    at_most = lambda a: F.size(F.filter(a, lambda x: x <= key))
    longs = lambda xs: F.array(*[F.lit(x).cast("long") for x in xs])
    coarse = at_most(longs([b[0] for b in blocks]))
    return F.when(coarse == 0, 0).otherwise((coarse - 1) * 32 + at_most(F.get(F.array(*[longs(b) for b in blocks]), coarse - 1)))


def shard(df: DataFrame, shards: int = 8, id_col: str = "doc_id", text_col: str = "text", ranges: int = RANGES) -> DataFrame:
    """(id, size, text_crc32, unit, shard, slot) for every row of df. size: bytes of the text and 1, so that an empty or null
    text counts; slot: from 0 without gaps in each shard.

    Shards are near equal in bytes: they differ by no more than units do, or single texts where those are larger. Equal texts
    share a shard, unless they hold over WHOLE_GROUP of a shard and a boundary falls among them. Repeated rows all get slots.
    No unit has many more than UNIT_ROWS records, whatever key holds them; null and repeated ids change nothing. Of an empty
    table nothing is returned. Other columns may have any name.
    """
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    sizes = [(F.octet_length(text) + F.lit(1)).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")]
    rows = staged(df.select(F.col(f"`{id_col}`").alias("id"), F.xxhash64(text).alias("key"), *sizes, F.monotonically_increasing_id().alias("row")), "sized")
    total = rows.agg(F.sum("size")).first()[0] or 0
    edges, heavy = splitters(rows, total, ranges)
    ranged = rows.withColumn("range", _range(F.col("key"), edges))
    fill, whole = max(1.0, total / ranges), WHOLE_GROUP * total / shards
    held = ranged.groupBy("range").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows"), F.min("key").alias("first"), F.max("key").alias("last"))
    one_key = F.col("first") == F.col("last")
    by_bytes = F.when(one_key & (F.col("bytes") <= whole), 1).otherwise(F.when(F.col("bytes") > 2 * fill, F.ceil(F.col("bytes") / fill)).otherwise(1))
    # a single key can be cut only through its group, others between groups
    held = staged(held.select("range", F.greatest(by_bytes, F.ceil(F.col("rows") / UNIT_ROWS)).alias("cuts"), one_key.alias("one_key")), "ranges")
    mixed = F.when(F.col("one_key"), F.xxhash64("row", F.lit("cut"))).otherwise(F.xxhash64("key", F.lit("cut")))
    cut = ranged.join(small(held), "range").withColumn("sub", F.pmod(mixed, F.col("cuts"))).withColumn("part", F.lit(0))
    sums = staged(cut.groupBy("range", "sub", "part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")), "units")
    # a key of very many small records fills a unit though its range has others; such units are cut by records
    over_full = sums.where(F.col("rows") > 2 * UNIT_ROWS).select("range", "sub", F.ceil(F.col("rows") / UNIT_ROWS).alias("parts"))
    if not over_full.isEmpty():
        cut = cut.join(small(staged(over_full, "over-full")), ["range", "sub"], "left").withColumn("part", F.coalesce(F.pmod(F.xxhash64("row", F.lit("part")), F.col("parts")), F.lit(0)).cast("int")).drop("parts")
        sums = staged(cut.groupBy("range", "sub", "part").agg(F.sum("size").alias("bytes"), F.count("*").alias("rows")), "units")
    over = Window.orderBy("range", "sub", "part")  # units, not records: about RANGES and one for each UNIT_ROWS records
    before = F.coalesce(F.sum("bytes").over(over.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    of = F.least(F.lit(shards - 1), F.floor((before + F.col("bytes") / 2) * shards / F.lit(max(1, total)))).cast("int")
    units = sums.select("range", "sub", "part", (F.row_number().over(over) - 1).alias("unit"), "rows", of.alias("shard"))
    inside = Window.partitionBy("shard").orderBy("unit").rowsBetween(Window.unboundedPreceding, -1)
    units = staged(units.withColumn("offset", F.coalesce(F.sum("rows").over(inside), F.lit(0))), "placed")
    within = Window.partitionBy("range", "sub", "part").orderBy("key", "id", "row")
    placed = cut.withColumn("nth", F.row_number().over(within) - 1).join(small(units.drop("rows")), ["range", "sub", "part"])
    return placed.select("id", "size", "text_crc32", "unit", "shard", (F.col("offset") + F.col("nth")).cast("long").alias("slot"))


def op6_sharding(spark, sf_dir: str) -> DataFrame:
    out = shard(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    return out.select(F.col("id").alias("doc_id"), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard"))
