"""Exact top-k search by inner product with a pivot table.

Every vector has its distances to many pivots, computed once and kept with it. For a query q and a vector x, the largest
|d(q, p) - d(x, p)| over the pivots is a lower bound of d(q, x), and 2 q.x = |q|^2 + |x|^2 - d(q, x)^2 turns it into an upper
bound of their score. The vectors of a block stand in tiles, neighbours in their cell, with the range of their distances to each
pivot. The candidates of a query are scored in the order of the bounds of their tiles, and scoring stops at the first whose bound
is below the k-th score found, which is exact; queries that come to a tile together are one matrix product.

Vectors stand in cells, by their nearest pivot. The ranges of a cell's distances bound the score of all in it, so a query
never visits cells that can't reach the score its k-th neighbour surely has: the k-th among a fixed number of vectors, the
scouts. What is left goes to blocks of the rows of one or more cells, and the best of all blocks are merged by rank. Pivots, scouts and
the ranges of cells are of a fixed number; nothing else is sent to all.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from weir.llm.shared import staged

#: Rows of a block of queries and of vectors; pivots, and the rows that they are chosen among, which are the scouts as well;
#: vectors of a tile at most.
QUERY_BLOCK, VECTOR_BLOCK, PIVOTS, SCOUTS, TILE = 32_768, 8_192, 64, 2_048, 256
#: Lengths of vectors that have pivots, the most frequent ones; others are scored without.
LENGTHS = 100
#: A score that can't be held in a long is the nearest long.
LONG = (1 << 63) - 1


def float_for(q: np.ndarray, x: np.ndarray) -> type | None:
    """The narrowest float in which no inner product of the rows can round, if there is one."""
    most = (np.abs(q).max(initial=0) * np.abs(x).max(initial=0)) * max(1, q.shape[1])
    return np.float32 if most < 2**24 else np.float64 if most < 2**53 else None


def scores(q: np.ndarray, x: np.ndarray) -> np.ndarray:
    """Exact integer inner products of all rows: in floats where they can't round, else in unbounded integers."""
    kind = float_for(q, x)
    if kind is not None:
        return (q.astype(kind) @ x.astype(kind).T).astype(np.int64)
    wide = [[min(LONG, max(-LONG - 1, sum(int(a) * int(b) for a, b in zip(r, s, strict=True)))) for s in x] for r in q]
    return np.array(wide, np.int64).reshape(len(q), len(x))


def squares(x: np.ndarray) -> np.ndarray:
    return np.einsum("ij,ij->i", x, x)


def distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    """The pivot table's rows: the distance of each row to each pivot."""
    return np.sqrt(np.maximum(0, squares(x)[:, None] + squares(pivots) - 2 * x @ pivots.T))


def far_apart(x: np.ndarray, n: int) -> np.ndarray:
    """n of the rows, each next one that which is farthest from those before; none twice."""
    if not len(x):
        return x
    chosen = [0]
    near = distances(x, x[:1])[:, 0]
    while len(chosen) < n and near.max() > 0:
        chosen.append(int(near.argmax()))
        near = np.minimum(near, distances(x, x[chosen[-1:]])[:, 0])
    return x[chosen]


def _upper(q_norm: np.ndarray, x_norm: np.ndarray, low: np.ndarray) -> np.ndarray:
    """Scores from squared norms and lower bounds of distances; a margin covers what floats round."""
    total = q_norm + x_norm
    upper = (total - low * low) / 2 + 1e-5 * total + 1e-3
    return np.where(np.isfinite(upper), upper, np.inf)


def bounds(q: np.ndarray, to_q: np.ndarray, x: np.ndarray, to_x: np.ndarray) -> np.ndarray:
    """An upper bound of the score of every query and vector, from their rows of the pivot table."""
    low = np.zeros((len(q), len(x)))
    gap = np.empty_like(low)
    for p in range(to_q.shape[1]):
        np.subtract(to_q[:, p, None], to_x[None, :, p], out=gap)
        np.maximum(low, np.abs(gap, out=gap), out=low)
    return _upper(squares(q)[:, None], squares(x)[None, :], low)


def tiles(x: np.ndarray, to_x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(order, starts): the vectors cell by cell, in a cell by their distance to its pivot, and where runs of at most TILE
    vectors of one cell begin in that order."""
    if not to_x.shape[1]:
        return np.arange(len(x)), np.arange(0, len(x), TILE)
    cell = to_x.argmin(axis=1)
    order = np.lexsort((to_x[np.arange(len(x)), cell], cell))
    first = np.searchsorted(cell[order], np.arange(to_x.shape[1]), "left")
    return order, np.flatnonzero((np.arange(len(x)) - first[cell[order]]) % TILE == 0)


def tile_bounds(q: np.ndarray, to_q: np.ndarray, low: np.ndarray, high: np.ndarray, norm: np.ndarray) -> np.ndarray:
    """An upper bound of every query's scores in every tile, from the ranges of the tile's rows of the pivot table."""
    least = np.zeros((len(q), len(norm)))
    for p in range(to_q.shape[1]):
        np.maximum(least, to_q[:, p, None] - high[None, :, p], out=least)
        np.maximum(least, low[None, :, p] - to_q[:, p, None], out=least)
    return _upper(squares(q)[:, None], norm[None, :], least)


def best(q: np.ndarray, to_q: np.ndarray, q_row: np.ndarray, floor: np.ndarray, x: np.ndarray, to_x: np.ndarray, x_row: np.ndarray, x_id: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, int]:
    """(query's place, vector's place, score) of each query's k highest scores among the vectors, ties to smaller ids and the
    row itself left out, and how many candidates were scored. floor: what each query's k-th score surely reaches; lower ones
    may be left out.

    A query goes through the tiles in the order of their bounds and stops at the first whose bound is below its k-th score.
    The queries that come to the same tile in the same step are scored in one product."""
    order, starts = tiles(x, to_x)
    ends = np.r_[starts[1:], len(x)]
    x, to_x, rows = x[order], to_x[order], x_row[order]
    low, high, norm = np.minimum.reduceat(to_x, starts, axis=0), np.maximum.reduceat(to_x, starts, axis=0), np.maximum.reduceat(squares(x), starts)
    kind = float_for(q, x)
    b = x if kind is None else x.astype(kind)
    by_row = np.argsort(rows, kind="stable")
    out, scored = [], 0
    for at in range(0, len(q), 4_096):
        part = q[at : at + 4_096]
        a = part if kind is None else part.astype(kind)
        place = np.searchsorted(rows, q_row[at : at + 4_096], sorter=by_row)
        own = by_row[np.minimum(place, len(rows) - 1)]
        own = np.where(rows[own] == q_row[at : at + 4_096], own, -1)
        bound = tile_bounds(part, to_q[at : at + 4_096], low, high, norm)
        ranked = np.argsort(-bound, axis=1, kind="stable")
        kth, top = floor[at : at + 4_096].astype(float), np.full((len(part), k), -np.inf)
        alive, found = np.arange(len(part)), []
        for step in range(len(starts)):
            tile = ranked[alive, step]
            going = bound[alive, tile] >= kth[alive]  # an equal score may have a smaller id
            alive, tile = alive[going], tile[going]
            if not len(alive):
                break
            by_tile = np.argsort(tile, kind="stable")
            for some in np.split(by_tile, np.flatnonzero(np.diff(tile[by_tile])) + 1):
                t, mine = tile[some[0]], alive[some]
                got = scores(a[mine], b[starts[t] : ends[t]]) if kind is None else a[mine] @ b[starts[t] : ends[t]].T
                scored += got.size
                high_enough = got >= kth[mine, None]
                itself = np.flatnonzero((own[mine] >= starts[t]) & (own[mine] < ends[t]))
                high_enough[itself, own[mine[itself]] - starts[t]] = False
                hit = np.flatnonzero(high_enough.any(axis=1))
                if not len(hit):
                    continue
                mine, got, high_enough = mine[hit], got[hit], high_enough[hit]
                both = np.concatenate((top[mine], np.where(high_enough, got, -np.inf)), axis=1)
                top[mine] = np.partition(both, both.shape[1] - k, axis=1)[:, both.shape[1] - k :]
                kth[mine] = np.maximum(kth[mine], top[mine].min(axis=1))
                i, j = np.nonzero(high_enough & (got >= kth[mine, None]))
                found.append((mine[i], starts[t] + j, got[i, j].astype(np.int64)))
        i, j, s = (np.concatenate([f[c] for f in found] or [np.empty(0, np.int64)]) for c in range(3))
        still = s >= kth[i]
        i, j, s = i[still], order[j[still]], s[still]
        by = np.lexsort((x_row[j], x_id[j], -s, i))
        i, j, s = i[by], j[by], s[by]
        nth = np.arange(len(i)) - np.searchsorted(i, i, "left")
        out.append((at + i[nth < k], j[nth < k], s[nth < k]))
    return *(np.concatenate([o[c] for o in out] or [np.empty(0, np.int64)]).astype(np.int64) for c in range(3)), scored


def usable(df: DataFrame, id_col: str, vector_col: str) -> DataFrame:
    """(row, id, v, n) of vectors that take part: not null, with finite components only and an id. v: floor(64 * x)."""
    x = F.col(f"`{vector_col}`")
    fine = x.isNotNull() & F.col(f"`{id_col}`").isNotNull() & ~F.exists(x, lambda c: c.isNull() | F.isnan(c) | (F.abs(c) == float("inf")))
    rows = df.where(fine).select(F.monotonically_increasing_id().alias("row"), F.col(f"`{id_col}`").cast("long").alias("id"), F.transform(x, lambda c: F.floor(c.cast("double") * 64).cast("double")).alias("v"))
    return rows.withColumn("n", F.size("v"))


def _matrix(lists, n: int) -> np.ndarray:
    return np.array(list(lists), float).reshape(-1, n)


class Scouts:
    """Pivots and scouts by length of vectors: at most SCOUTS rows of each of the LENGTHS most frequent lengths."""

    def __init__(self, rows: DataFrame, k: int):
        counts = rows.groupBy("n").agg(F.count("*").alias("m")).orderBy(F.desc("m"), "n").limit(LENGTHS).collect()
        self.k, self.rows, self.pivots = k, {}, {}
        for c in counts:
            share = min(1 << 30, -(-(2 * SCOUTS << 30) // c["m"]))  # about twice as many, of which the first are taken
            place = F.pmod(F.xxhash64("id", "row"), F.lit(1 << 30))
            some = rows.where((F.col("n") == c["n"]) & (place < share)).orderBy(place, "row").limit(SCOUTS).select("row", "v").collect()
            x = _matrix([r["v"] for r in some], c["n"])
            self.rows[c["n"]] = np.array([r["row"] for r in some]), x
            self.pivots[c["n"]] = far_apart(x, PIVOTS)

    def table(self, n: int, x: np.ndarray) -> np.ndarray:
        return distances(x, self.pivots[n]) if n in self.pivots else np.zeros((len(x), 0))

    def floor(self, n: int, rows: np.ndarray, x: np.ndarray) -> np.ndarray:
        """What the k-th score of each row surely reaches: the k-th among the scouts."""
        out = np.full(len(x), -np.inf)
        if n in self.rows and len(self.rows[n][0]) > self.k:
            own, scouts = self.rows[n]
            for at in range(0, len(x), 256):
                got = scores(x[at : at + 256], scouts).astype(float)
                got[rows[at : at + 256, None] == own] = -np.inf
                out[at : at + 256] = np.partition(got, got.shape[1] - self.k, axis=1)[:, got.shape[1] - self.k]
        return out


def _mapped(rows: DataFrame, schema: str, of) -> DataFrame:
    """of(n, rows, ids, vectors) for the vectors of one length of a batch, as a list of columns."""
    names = [c.split()[0] for c in schema.split(", ")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            frame = batch.to_pandas()
            for n, part in frame.groupby("n"):
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in of(int(n), part["row"].to_numpy(), part["id"].to_numpy(), _matrix(part["v"], int(n)))], names=names)

    return rows.select("row", "id", "v", "n").mapInArrow(run, schema)


def nearest(df: DataFrame, k: int = 20, is_query=None, id_col: str = "vec_id", vector_col: str = "embedding") -> DataFrame:
    """(query_id, rank, vec_id, score): for each query, a row for which the condition is_query (of a column id) holds (ids
    divisible by 20, if not given), the k highest inner products with other rows of df, all if there are fewer. Ties go to
    the smaller id.

    A row is never its own candidate, but a repeated row is a candidate of the other. Vectors that are null or hold a null or
    non-finite component take no part, neither do rows without an id; vectors of unlike length never meet. An empty table
    gives an empty one. Other columns may have any name.
    """
    spark = df.sparkSession
    rows = staged(usable(df, id_col, vector_col), "vectors")
    asked = F.pmod(F.col("id"), F.lit(20)) == 0 if is_query is None else is_query
    if rows.where(asked).isEmpty():
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    shipped = spark.sparkContext.broadcast(Scouts(rows, k))  # bounded by LENGTHS, SCOUTS and PIVOTS

    def table(n: int, row: np.ndarray, id_: np.ndarray, x: np.ndarray) -> list:
        to = shipped.value.table(n, x)
        return [row, id_, list(x), np.full(len(x), n, np.int32), list(to.astype(np.float32)), (to.argmin(axis=1) if to.shape[1] else np.zeros(len(x))).astype(np.int32), squares(x)]

    vectors = staged(_mapped(rows, "row long, id long, v array<double>, n int, to array<float>, cell int, norm double", table), "table")
    wide = [F.struct(*[f(F.get("to", F.lit(p))).alias(f"p{p}") for p in range(PIVOTS)]).alias(c) for f, c in ((F.min, "low"), (F.max, "high"))]
    ranges = [r.asDict(True) for r in vectors.groupBy("n", "cell").agg(F.count("*").alias("m"), F.max("norm").alias("norm"), *wide).collect()]  # of no more cells than PIVOTS for each of LENGTHS, and one for each other length
    cells: dict[int, list[dict]] = {}
    packs: list[int] = []  # rows of each pack: cells are put together up to a block
    for r in sorted(ranges, key=lambda r: (r["n"], r["cell"])):
        if r["n"] not in cells or packs[-1] + r["m"] > VECTOR_BLOCK:
            packs.append(0)
        packs[-1] += r["m"]
        cells.setdefault(r["n"], []).append(r | {"pack": len(packs) - 1})
    known = spark.sparkContext.broadcast(cells)  # a row for each cell

    def visits(n: int, row: np.ndarray, id_: np.ndarray, x: np.ndarray) -> list:
        """The cells that a query has to visit."""
        to, floor = shipped.value.table(n, x), shipped.value.floor(n, row, x)
        low, every = np.zeros((len(x), len(known.value[n]))), known.value[n]
        for c, r in enumerate(every):
            for p in range(to.shape[1]):
                lo, hi = r["low"][f"p{p}"], r["high"][f"p{p}"]
                low[:, c] = np.maximum(low[:, c], np.maximum(to[:, p] - hi, lo - to[:, p]))
        reach = _upper(squares(x)[:, None], np.array([r["norm"] for r in every])[None, :], low) >= floor[:, None]
        numbers = np.array([r["pack"] for r in every])
        return [row, id_, list(x), np.full(len(x), n, np.int32), list(to.astype(np.float32)), floor, pa.array([np.unique(numbers[f]).tolist() for f in reach], pa.list_(pa.int32()))]

    queries = staged(_mapped(rows.where(asked), "row long, id long, v array<double>, n int, to array<float>, floor double, packs array<int>", visits), "queries")
    pack_of = F.create_map(*[F.lit(x) for n, every in cells.items() for r in every for x in (f"{n}:{r['cell']}", r["pack"])])
    parts = F.array(*[F.lit(-(-m // VECTOR_BLOCK)) for m in packs])
    split = lambda m, salt: F.pmod(F.xxhash64("row", F.lit(salt)), m).cast("int")
    q_blocks = F.lit(max(1, -(-queries.count() // QUERY_BLOCK)))
    q = queries.withColumn("qb", split(q_blocks, 1)).withColumn("pack", F.explode("packs")).drop("packs")
    q = q.withColumn("sub", F.explode(F.sequence(F.lit(0), F.get(parts, F.col("pack")) - 1)))
    x = vectors.withColumn("pack", F.element_at(pack_of, F.concat_ws(":", F.col("n").cast("string"), F.col("cell").cast("string")))).drop("norm", "cell")
    x = x.withColumn("sub", split(F.get(parts, F.col("pack")), 2)).withColumn("qb", F.explode(F.sequence(F.lit(0), q_blocks - 1)))

    def meet(left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
        if not len(left) or not len(right):
            return pd.DataFrame({c: pd.Series(dtype="int64") for c in ("q", "query_id", "vec_id", "row", "score")})
        n = int(left["n"].iloc[0])
        a, b = (_matrix(f["v"], n) for f in (left, right))
        to_a, to_b = (_matrix(f["to"], len(f["to"].iloc[0])) if len(f["to"].iloc[0]) else np.zeros((len(f), 0)) for f in (left, right))
        i, j, s, _ = best(a, to_a, left["row"].to_numpy(), left["floor"].to_numpy(), b, to_b, right["row"].to_numpy(), right["id"].to_numpy(), k)
        return pd.DataFrame({"q": left["row"].to_numpy()[i], "query_id": left["id"].to_numpy()[i], "vec_id": right["id"].to_numpy()[j], "row": right["row"].to_numpy()[j], "score": s})

    keys = ["n", "qb", "pack", "sub"]
    found = q.groupBy(*keys).cogroup(x.groupBy(*keys)).applyInPandas(meet, "q long, query_id long, vec_id long, row long, score long")
    over = Window.partitionBy("q").orderBy(F.col("score").desc(), "vec_id", "row")
    return found.withColumn("rank", F.row_number().over(over)).where(F.col("rank") <= k).select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op3_topk(spark, sf_dir: str) -> DataFrame:
    return nearest(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


OP3_SQL = """
WITH v AS (
  SELECT vec_id, list_transform(embedding, lambda x: floor(64 * x::DOUBLE)) AS v FROM embeddings
  WHERE embedding IS NOT NULL AND vec_id IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id, list_inner_product(q.v, c.v)::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 20 = 0 AND q.vec_id <> c.vec_id AND len(q.v) = len(c.v)),
r AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id)::INTEGER AS rank FROM s)
SELECT query_id, rank, vec_id, score FROM r WHERE rank <= 20
"""
