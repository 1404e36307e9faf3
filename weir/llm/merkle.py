"""Merkle manifest of a table, with a proof for every row.

Rows become leaves, digests over all declared columns. The leaves of a tree (one for each value of a column) are sorted over
sampled ranges and numbered; aligned blocks of fanout ** LEVELS consecutive leaves become one row each, whose digests lie in
memory as a contiguous matrix of 64-byte hex rows. A block is hashed levelwise: the matrix is seen as rows of `fanout`
digests, and each row gives a node. Block digests are the leaves of the next round, so a tree of n leaves takes
log(n) / log(fanout ** LEVELS) rounds, and no task holds more than a block. The way down gives each node the siblings above it,
by index arithmetic in its block.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weir.llm.shared import small, staged

#: Children of a node, and levels of a block.
FANOUT, LEVELS = 8, 3
#: Bytes of a digest in hex.
HEX = 64
#: Blocks whose paths, of about 5 KB each at most, may be broadcast.
BROADCAST_PATHS = 2_000


def leaf(columns: dict[str, Column] | list[str]) -> Column:
    """The digest of a row: of all columns in their order, each `-` if null, else its bytes, `:` and the value as text."""
    cols = columns.values() if isinstance(columns, dict) else [F.col(f"`{c}`") for c in columns]
    told = [F.coalesce(F.concat(F.octet_length(x).cast("string"), F.lit(":"), x), F.lit("-")) for x in (c.cast("string") for c in cols)]
    return F.sha2(F.concat(*told).cast("binary"), 256)


def _placed(nodes: DataFrame, by: list[str]) -> DataFrame:
    """nodes with `index`, from 0 in the order of `by` within `tree`, and `count`, the nodes of the tree."""
    ranged = staged(nodes.repartitionByRange("tree", *by).sortWithinPartitions("tree", *by).withColumn("at", F.monotonically_increasing_id()), "ranged")
    ranged = ranged.withColumn("range", F.shiftright("at", 33))  # the partition's number, which follows the order
    held = ranged.groupBy("tree", "range").agg(F.min("at").alias("first"), F.count("*").alias("n"))
    of_tree = Window.partitionBy("tree")  # a row for each range of a tree
    before = F.coalesce(F.sum("n").over(of_tree.orderBy("range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    held = staged(held.select("tree", "range", (before - F.col("first")).alias("shift"), F.sum("n").over(of_tree).alias("count")), "places")
    return ranged.join(small(held), ["tree", "range"]).withColumn("index", F.col("at") + F.col("shift")).drop("at", "range", "shift")


def _blocks(nodes: DataFrame, fanout: int, *more: str) -> DataFrame:
    """One row for each aligned block: tree, block, count, and its nodes in order, with the columns `more` beside the digests."""
    block = (F.col("index") / F.lit(fanout**LEVELS)).cast("long").alias("block")
    return staged(nodes.groupBy("tree", block, "count").agg(F.array_sort(F.collect_list(F.struct("index", "digest", *more))).alias("nodes")), "blocks")


def hashed(digests: np.ndarray, whole: bool, fanout: int = FANOUT) -> list[np.ndarray]:
    """The matrices of a block from its leaves up, each of digests as rows of 64 bytes: LEVELS hashings if the tree goes on above
    the block, else until one digest is left (`whole`)."""
    levels = [np.ascontiguousarray(digests)]
    while len(levels[-1]) > 1 if whole else len(levels) <= LEVELS:
        below = levels[-1]
        full = len(below) // fanout
        runs = [*below[: full * fanout].reshape(full, fanout * HEX), *([below[full * fanout :].reshape(-1)] if len(below) % fanout else [])]
        levels.append(np.frombuffer("".join(sha256(r).hexdigest() for r in runs).encode(), np.uint8).reshape(-1, HEX))
    return levels


def siblings(levels: list[np.ndarray], fanout: int = FANOUT) -> list[bytes]:
    """For each leaf of a block the digests of all siblings up to the top of the block, level by level, left to right."""
    n = len(levels[0])
    others, there = [], []
    for k, nodes in enumerate(levels[:-1]):
        node = np.arange(n) // fanout**k
        place = np.arange(fanout - 1) + (np.arange(fanout - 1) >= (node % fanout)[:, None])
        at = node[:, None] // fanout * fanout + place
        there.append(at < len(nodes))
        others.append(nodes[np.minimum(at, len(nodes) - 1)])
    if not others:
        return [b""] * n
    all_, there = np.concatenate(others, axis=1), np.concatenate(there, axis=1)
    full = there.all(axis=1)
    return [(x if f else x[t]).tobytes() for x, t, f in zip(all_, there, full, strict=True)]


def _of_blocks(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[pa.RecordBatch, pa.StructArray, np.ndarray, int]]:
    """Each block of one row: the row, its nodes, the matrix of their digests and the count of the tree's nodes on this level."""
    for batch in batches:
        for i in range(batch.num_rows):
            row = batch.slice(i, 1)
            nodes = row.column("nodes").flatten()
            digests = "".join(nodes.field("digest").to_pylist()).encode()
            yield row, nodes, np.frombuffer(digests, np.uint8).reshape(-1, HEX), row.column("count")[0].as_py()


def _climbed(blocks: DataFrame, fanout: int) -> DataFrame:
    """The digest of each block, a node of the next level: tree, index, count, digest."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, _, digests, count in _of_blocks(batches):
            top = hashed(digests, count <= fanout**LEVELS, fanout)[-1].tobytes().decode()
            yield pa.RecordBatch.from_arrays([row.column("tree"), row.column("block"), pa.array([-(-count // fanout**LEVELS)], pa.int64()), pa.array([top])], names=["tree", "index", "count", "digest"])

    return staged(blocks.mapInArrow(run, "tree string, index long, count long, digest string"), "nodes")


def _tables(blocks: DataFrame, fanout: int) -> tuple[list[DataFrame], DataFrame]:
    """The blocks of every round from the leaves up, and the root of each tree."""
    tables = [blocks]
    while True:
        nodes = _climbed(tables[-1], fanout)
        if (nodes.agg(F.max("count")).first()[0] or 1) <= 1:
            return tables, nodes.select("tree", "digest")
        tables.append(_blocks(nodes, fanout))


def _descended(blocks: DataFrame, fanout: int, keep: list[str]) -> DataFrame:
    """A row for each node: the columns `keep` of its block, what its struct holds, and proof, the siblings in the block and those
    above it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for row, nodes, digests, count in _of_blocks(batches):
            above = row.column("above")[0].as_py()
            proofs = [x + above for x in siblings(hashed(digests, count <= fanout**LEVELS, fanout), fanout)]
            same = pa.array(np.zeros(len(nodes), np.int64))
            yield pa.RecordBatch.from_arrays([*[row.column(c).take(same) for c in keep], *nodes.flatten(), pa.array(proofs, pa.binary())], names=out)

    kinds = {f.name: f.dataType for f in blocks.schema["nodes"].dataType.elementType.fields}
    out = [*keep, *kinds, "proof"]
    ddl = ", ".join([f"`{c}` {blocks.schema[c].dataType.simpleString()}" for c in keep] + [f"`{c}` {t.simpleString()}" for c, t in kinds.items()] + ["proof binary"])
    return blocks.select("nodes", "above", *dict.fromkeys([*keep, "count"])).mapInArrow(run, ddl)


def _paths(tables: list[DataFrame], top: DataFrame, fanout: int, keep: list[str]) -> DataFrame:
    """A row for each leaf with its proof; top: (tree, above, ...), the siblings above each tree's root."""
    above = top.select("tree", F.lit(0).cast("long").alias("block"), "above")
    for table in reversed(tables[1:]):
        nodes = _descended(table.join(small(above, BROADCAST_PATHS), ["tree", "block"]), fanout, ["tree"])
        above = staged(nodes.select("tree", F.col("index").alias("block"), F.col("proof").alias("above")), "paths")
    return _descended(tables[0].join(small(above, BROADCAST_PATHS), ["tree", "block"]).join(small(top.drop("above")), "tree"), fanout, keep)


def manifest(df: DataFrame, columns: list[str], id_col: str = "doc_id", tree_col: str = "lang", also: dict[str, Column] | None = None, fanout: int = FANOUT) -> DataFrame:
    """A row for each row of df: id, also (the digest with some columns replaced as `also` says; null without or where all of
    those are null), digest, index and count (the leaf's place in its tree and the tree's leaves), subroot, place and trees (the
    tree's place among all and their number), root, and proof: the siblings' digests as one text of 64 characters each, level by
    level from the leaf to the root, left to right.

    A leaf is leaf(columns). Leaves of a tree ascend by id, null first; those of one id by digest, so repeated rows get places
    of their own. Trees stand in the order of their names by UTF-8 bytes, a null name first. Each run of `fanout` nodes becomes
    its digest while there are several, also a last run of one. Texts may be null, empty or of any length; a table without rows
    has no manifest. Other columns may have any name.
    """
    name = F.coalesce(F.concat(F.lit("="), F.col(f"`{tree_col}`").cast("string")), F.lit("-")).alias("tree")
    replaced = {c: (also or {}).get(c, F.col(f"`{c}`")) for c in columns}
    other = F.when(F.coalesce(*also.values()).isNotNull(), leaf(replaced)) if also else F.lit(None).cast("string")
    leaves = staged(df.select(name, F.col(f"`{id_col}`").alias("id"), leaf(columns).alias("digest"), other.alias("also"), F.monotonically_increasing_id().alias("row")), "leaves")
    tables, roots = _tables(_blocks(_placed(leaves, ["id", "digest", "row"]), fanout, "id", "also"), fanout)
    # the same again over the roots of all trees
    upper, root = _tables(_blocks(_placed(roots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest"), ["name"]), fanout, "name"), fanout)
    above = _paths(upper, root.select("tree", F.col("digest").alias("root"), F.lit(b"").alias("above")), fanout, ["root", "count"])
    top = staged(above.select(F.col("name").alias("tree"), F.col("digest").alias("subroot"), F.col("index").alias("place"), F.col("count").alias("trees"), "root", F.col("proof").alias("above")), "trees")
    return _paths(tables, top, fanout, ["count", "subroot", "place", "trees", "root"])


def _places(index: int, count: int, fanout: int) -> Iterator[tuple[int, int]]:
    """Where a node stands in its run, and the nodes of that run, on each level of a tree."""
    while count > 1:
        at = index % fanout
        yield at, min(fanout, count - index + at)
        index, count = index // fanout, -(-count // fanout)


def fold(digest: str, proof: bytes, places: list[tuple[int, int]]) -> str:
    """The root that a leaf's digest and the digests of its siblings give."""
    node, at = digest.encode(), 0
    for place, nodes in places:
        cut, end = at + HEX * place, at + HEX * (nodes - 1)
        node, at = sha256(b"".join((proof[at:cut], node, proof[cut:end]))).hexdigest().encode(), end
    return node.decode()


def folded(proofs: DataFrame, digest: Column, fanout: int = FANOUT) -> DataFrame:
    """proofs, as manifest() gives them, with folded_root: the root that follows from `digest` as the leaf and the proof's
    siblings, without a look at the tree. It equals root if and only if the row is unchanged."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("__digest", "proof", "index", "count", "place", "trees")]
            roots = [fold(d, p, [*_places(i, n, fanout), *_places(k, m, fanout)]) for d, p, i, n, k, m in zip(*cols, strict=True)]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in keep], pa.array(roots, pa.string())], names=[*keep, "folded_root"])

    keep = proofs.columns
    ddl = ", ".join([f"`{c}` {t}" for c, t in proofs.dtypes] + ["folded_root string"])
    return proofs.withColumn("__digest", digest).mapInArrow(run, ddl)


FIELDS = ["doc_id", "source", "lang", "n_chars", "text"]
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def op11_merkle(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    tampered = F.when(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.translate("text", UPPER, LOWER))
    proofs = folded(manifest(docs, FIELDS, also={"text": tampered}), F.coalesce("also", "digest"))
    return proofs.select(
        F.col("id").alias("doc_id"), F.col("digest").alias("leaf"), "subroot", "root", F.sha2("proof", 256).alias("proof_sha256"),
        "folded_root", (F.col("folded_root") == F.col("root")).alias("verified"),
    )


#: Levels that the SQL hashes in a tree, and among the trees: up to 8 ** 8 rows of a language and 8 ** 3 languages.
SQL_LEVELS, SQL_TOP = 8, 3


def _sql() -> str:
    told = lambda c: f"coalesce(octet_length(encode({c}))::VARCHAR || ':' || {c}, '-')"
    row = lambda text: "sha256(" + " || ".join(told(c) for c in ("doc_id::VARCHAR", "source", "lang", "n_chars::VARCHAR", text)) + ")"
    byte = "list_reduce([v, 0, 0, 0, 0, 0, 0, 0, 0], lambda c, x: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END)"
    crc = "xor(list_reduce(list_prepend(4294967295, [ascii(x)::BIGINT for x in string_split(doc_id::VARCHAR, '')]), lambda c, x: xor(c >> 8, tab[(xor(c, x) & 255) + 1])), 4294967295)"
    parts = [
        f"byte AS (SELECT list({byte} ORDER BY v) AS tab FROM (SELECT range::BIGINT AS v FROM range(256)))",
        f"l AS (SELECT doc_id, coalesce('=' || lang, '-') AS t, {row('text')} AS h, CASE WHEN {crc} % 3 = 0 THEN {row(f"translate(text, '{UPPER}', '{LOWER}')")} END AS o FROM documents, byte)",
        "a0 AS (SELECT t, row_number() OVER (PARTITION BY t ORDER BY doc_id) - 1 AS i, count(*) OVER (PARTITION BY t) AS c, h FROM l)",
        "p0 AS (SELECT doc_id, l.t, row_number() OVER (PARTITION BY l.t ORDER BY doc_id) - 1 AS i, h AS leaf, coalesce(o, h) AS f, '' AS proof FROM l)",
    ]

    def level(nodes: str, rows: str, k: int) -> None:
        parts.append(f"{nodes}r{k} AS (SELECT t, i // 8 AS i, max(c) AS c, list(h ORDER BY i) AS run FROM {nodes}{k} GROUP BY t, i // 8)")
        parts.append(f"{nodes}{k + 1} AS (SELECT t, i, (c + 7) // 8 AS c, CASE WHEN c = 1 THEN run[1] ELSE sha256(array_to_string(run, '')) END AS h FROM {nodes}r{k})")
        left, right = "r.run[1:(p.i % 8)::INT]", "r.run[(p.i % 8 + 2)::INT:]"
        parts.append(
            f"{rows}{k + 1} AS (SELECT doc_id, p.t, p.i // 8 AS i, leaf, CASE WHEN r.c = 1 THEN f ELSE sha256(array_to_string({left} || [f] || {right}, '')) END AS f, "
            f"CASE WHEN r.c = 1 THEN proof ELSE proof || array_to_string({left} || {right}, '') END AS proof FROM {rows}{k} p JOIN {nodes}r{k} r ON p.t = r.t AND p.i // 8 = r.i)"
        )

    for k in range(SQL_LEVELS):
        level("a", "p", k)
    parts.append(f"b0 AS (SELECT 0 AS t, row_number() OVER (ORDER BY encode(t)) - 1 AS i, count(*) OVER () AS c, h, t AS name FROM a{SQL_LEVELS})")
    parts.append(f"q0 AS (SELECT doc_id, 0 AS t, b0.i, leaf, f, proof FROM p{SQL_LEVELS} p JOIN b0 ON p.t = b0.name)")
    for k in range(SQL_TOP):
        level("b", "q", k)
    return (
        "WITH " + ", ".join(parts) + f" SELECT q.doc_id, q.leaf, a.h AS subroot, b.h AS root, sha256(q.proof) AS proof_sha256, q.f AS folded_root, q.f = b.h AS verified "
        f"FROM q{SQL_TOP} q JOIN l ON q.doc_id = l.doc_id JOIN a{SQL_LEVELS} a ON a.t = l.t JOIN b{SQL_TOP} b ON true"
    )


OP11_SQL = _sql()
