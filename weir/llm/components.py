"""Connected components of a graph that fits no single machine, with DataFrame operations only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir.llm.shared import staged

MAX_ROUNDS = 60


def _stars(edges: DataFrame) -> DataFrame:
    """One round of the large-star and small-star steps (Kiveris et al., 2014). Edges are (a, b) with a > b.

    Neighbours are never collected: a step takes each node's least neighbour by an aggregate with map-side combining and
    joins it to the edges again, so a node with very many neighbours is split by the engine's skewed-join rule.
    """
    both = edges.select(F.col("a").alias("u"), F.col("b").alias("v")).unionByName(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))
    least = both.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    large = both.join(least, "u").where("v > u").select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
    low = large.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
    joined = large.join(low, large["a"] == low["u"]).select("a", "b", "m")
    pairs = joined.select(F.explode(F.array(F.struct(F.col("a").alias("x"), F.col("m").alias("y")), F.struct(F.col("b").alias("x"), F.col("m").alias("y")))).alias("p"))
    return pairs.where("p.x <> p.y").select(F.col("p.x").alias("a"), F.col("p.y").alias("b")).distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether the edges (a, b) with a > b are stars around their least nodes: no a has two of them, or is a b itself."""
    ends = F.explode(F.array(F.struct(F.col("a").alias("node"), F.lit(1).alias("n")), F.struct(F.col("b").alias("node"), F.lit(0).alias("n"))))
    of = edges.select(ends.alias("e")).groupBy("e.node").agg(F.sum("e.n").alias("n"), F.min("e.n").alias("least"))
    return not of.agg(F.count_if((F.col("n") > 1) | (F.col("n") == 1) & (F.col("least") == 0)).alias("n")).first()["n"]


def components(edges: DataFrame) -> DataFrame:
    """(node, root) for each node of edges (a, b): root is the least node reachable, itself included. Edges with an equal
    or null end are dropped; nodes without another end are not returned."""
    at = staged(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    for _ in range(MAX_ROUNDS):
        if _settled(at):
            break
        at = staged(_stars(at), "stars")
    else:
        raise RuntimeError(f"components did not settle in {MAX_ROUNDS} rounds")
    return at.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(at.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct())
