"""Chat formatting with collapsed snapshots.

Conversations are logged again and again as they grow. A rolling hash of the turns so far names each prefix; a conversation
whose last hash is a prefix of a longer one is left out, as are repeats, and what remains is rendered.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weir.llm.shared import BROADCAST_IDS, small, staged

#: Turns of one rendered segment. A conversation has as many segments as it needs.
SEGMENT = 1_024


def rendered(role: Column, text: Column) -> Column:
    """One turn in the template."""
    return F.concat(F.lit("<|"), F.coalesce(role, F.lit("")), F.lit("|>\n"), F.coalesce(text, F.lit("")), F.lit("<|end|>\n"))


def _turns(df: DataFrame, id_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(c, id, turn, t1, t2, role, text) of each row: what names its conversation, and two hashes of the turn."""
    id_, turn, role, text = (F.col(f"`{c}`") for c in (id_col, turn_col, role_col, text_col))
    hashes = [F.xxhash64(F.lit(i), role.isNull(), role, text.isNull(), text) for i in (1, 2)]
    alone = F.concat_ws(":", F.coalesce(turn.cast("string"), F.lit("")), *[h.cast("string") for h in hashes])
    c = F.when(id_.isNull(), F.concat(F.lit("-"), alone)).otherwise(F.concat(F.lit("="), id_.cast("string")))
    return df.select(c.alias("c"), id_.alias("id"), turn.alias("turn"), *[h.alias(f"t{i}") for i, h in zip((1, 2), hashes, strict=True)], role.alias("role"), text.alias("text"))


def rolled(turns: DataFrame) -> DataFrame:
    """(c, id, turn, t1, t2, pos, n, h1, h2) of each turn, without its text: its place from 1, the turns of its conversation,
    and two hashes of all turns up to it. Turns are sorted over ranges that sampled splitters cut, so that no task holds a
    conversation; places and hashes are summed in a range and then over the ranges."""
    order = ["turn", "t1", "t2"]
    one = turns.groupBy("c", *order).agg(F.min("id").alias("id"))
    own = staged(one.repartitionByRange("c", *order).withColumn("range", F.spark_partition_id()), "turns")
    within = Window.partitionBy("c", "range").orderBy(*order)
    sums = own.groupBy("c", "range").agg(F.count("*").alias("size"))
    over = Window.partitionBy("c").orderBy("range")  # a row for each range of a conversation
    before = over.rowsBetween(Window.unboundedPreceding, -1)
    sizes = sums.select("c", "range", F.coalesce(F.sum("size").over(before), F.lit(0)).alias("skip"), F.sum("size").over(Window.partitionBy("c")).alias("n"))
    placed = own.withColumn("nth", F.row_number().over(within)).join(sizes, ["c", "range"]).withColumn("pos", F.col("skip") + F.col("nth"))
    terms = staged(placed.withColumns({f"x{i}": F.xxhash64(f"t{i}", "pos") for i in (1, 2)}).drop("skip", "nth"), "places")
    parts = terms.groupBy("c", "range").agg(F.bit_xor("x1").alias("x1"), F.bit_xor("x2").alias("x2"))
    carried = parts.select("c", "range", *[F.coalesce(F.bit_xor(f"x{i}").over(before), F.lit(0)).alias(f"y{i}") for i in (1, 2)])
    running = Window.partitionBy("c", "range").orderBy("pos").rowsBetween(Window.unboundedPreceding, 0)
    joined = terms.withColumns({f"x{i}": F.bit_xor(f"x{i}").over(running) for i in (1, 2)}).join(carried, ["c", "range"])
    return staged(joined.select("c", "id", *order, "pos", "n", *[F.col(f"x{i}").bitwiseXOR(F.col(f"y{i}")).alias(f"h{i}") for i in (1, 2)]), "rolled")


def collapse(df: DataFrame, id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(id_col, segment, n_turns, text) of the maximal conversations, each rendered in segments of SEGMENT turns from 0.

    Turns stand by number, a null one first, and equal numbers by a hash of their role and text; a null role or text differs
    from an empty one and is rendered like it. A row that repeats another in all of these is the same turn. A conversation
    that begins another, longer one goes; of equal ones, that with the least id stays. A row without an id is a conversation
    of its own. An empty table gives an empty one. Other columns may have any name.
    """
    turns = _turns(df, id_col, turn_col, role_col, text_col)
    places = rolled(turns)
    ends = places.where("pos = n").groupBy("n", "h1", "h2").agg(F.min(F.struct(F.col("id").isNull(), "id", "c")).alias("x"))
    begun = places.where("pos < n").select(F.col("pos").alias("n"), "h1", "h2").distinct()
    kept = staged(ends.join(begun, ["n", "h1", "h2"], "left_anti").select(F.col("x.c").alias("c")), "kept")
    mine = places.join(small(kept, BROADCAST_IDS // 2), "c", "left_semi").select(F.col("c").alias("d"), "turn", "t1", "t2", "pos")
    same = (F.col("c") == F.col("d")) & turns["turn"].eqNullSafe(mine["turn"]) & (turns["t1"] == mine["t1"]) & (turns["t2"] == mine["t2"])
    told = turns.join(small(kept, BROADCAST_IDS // 2), "c", "left_semi").join(mine, same).select("c", "id", "pos", rendered(F.col("role"), F.col("text")).alias("one"))
    told = told.withColumn("segment", F.floor((F.col("pos") - 1) / SEGMENT).cast("int"))
    out = told.groupBy("c", "segment").agg(F.min("id").alias("id"), F.sort_array(F.collect_set(F.struct("pos", "one"))).alias("all"))
    return out.select(F.col("id").alias(id_col), "segment", F.size("all").cast("long").alias("n_turns"), F.array_join(F.col("all.one"), "").alias("text"))


def op8_chat(spark, sf_dir: str) -> DataFrame:
    return collapse(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


OP8_SQL = f"""
WITH r AS (SELECT DISTINCT conv_id, turn, role, text, CASE WHEN conv_id IS NULL THEN md5(concat_ws(':', coalesce(turn::VARCHAR, ''), coalesce('=' || role, ''), coalesce('=' || text, ''))) ELSE '' END AS lone FROM conversations),
t AS (
  SELECT conv_id, lone, '<|' || coalesce(role, '') || '|>' || chr(10) || coalesce(text, '') || '<|end|>' || chr(10) AS one,
    row_number() OVER (PARTITION BY conv_id, lone ORDER BY turn NULLS FIRST) AS pos, count(*) OVER (PARTITION BY conv_id, lone) AS n FROM r),
p AS (SELECT *, string_agg(one, '' ORDER BY pos) OVER (PARTITION BY conv_id, lone ORDER BY pos ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS so_far FROM t),
e AS (SELECT min((conv_id IS NULL, conv_id, lone)) AS x FROM p WHERE pos = n AND (pos, so_far) NOT IN (SELECT (pos, so_far) FROM p WHERE pos < n) GROUP BY n, so_far)
SELECT conv_id, ((pos - 1) // {SEGMENT})::INTEGER AS segment, count(*)::BIGINT AS n_turns, string_agg(one, '' ORDER BY pos) AS text
FROM t WHERE (conv_id IS NULL, conv_id, lone) IN (SELECT x FROM e) GROUP BY conv_id, lone, segment
"""
