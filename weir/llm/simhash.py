"""SimHash near-duplicates by a Gray-order hierarchical index.

Fingerprints that differ in no more than `radius` bits share at least one of `radius + 1` bit blocks. Rows are dealt by
such a shared block (a block with very many fingerprints is cut into blocks of its other bits, until the rest is too
short to hold many), sorted there by Gray rank, and joined by a tree: leaves of consecutive ranks, upper nodes that hold
the bits on which everything below agrees. Two nodes are left aside as soon as the differences gathered on the way down
pass the radius. Each group returns the links as stars, and components() joins the stars of all groups.
"""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir.llm.components import components
from weir.llm.shared import BROADCAST_IDS, by_batches, small, staged

SEED = 42
#: Fingerprints of one leaf of the index, children of a node, and words hashed at a time.
LEAF, FAN, SLICE = 32, 8, 100_000
#: A block shared by more fingerprints is cut further.
GROUP_LIMIT = 16_384


def _hashes(text: str | None, shingle: int) -> Iterator[np.ndarray]:
    """The hashes of all shingles of a text, a slice at a time: of its words, or of the whole sequence if it has fewer."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return
    n = max(1, len(words) - shingle + 1)
    for at in range(0, n, SLICE):
        part = words[at : min(at + SLICE, n) + shingle - 1]
        runs = zip(*(part[i:] for i in range(shingle)), strict=False) if len(words) >= shingle else [words]
        yield np.fromiter(map(xxhash.xxh64_intdigest, map(b" ".join, runs), repeat(SEED)), np.uint64)


def _bits(slices: list[np.ndarray] | Iterator[np.ndarray]) -> int:
    """The majority of each bit of the hashes."""
    n, ones = 0, np.zeros(64, np.int64)
    for hashes in slices:
        n += len(hashes)
        bits = np.unpackbits(hashes.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > n, bitorder="little").view("<u8")[0])


def fingerprint(text: str | None, shingle: int = 3) -> int:
    """The unsigned 64-bit fingerprint of one text."""
    return _bits(_hashes(text, shingle))


def fingerprints(df: DataFrame, keep: list[str], text_col: str = "text", shingle: int = 3, out: str = "fp") -> DataFrame:
    """The columns `keep` and `out`, a signed long, for every row; a text that is null or has no word has 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = np.fromiter((fingerprint(x.as_py(), shingle) for x in batch.column(at)), np.uint64, batch.num_rows)
            yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], pa.array(fps.view(np.int64))], names=[f"c{i}" for i in range(len(keep) + 1)])

    at = keep.index(text_col) if text_col in keep else len(keep)
    plain = df.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(keep if text_col in keep else [*keep, text_col])])
    schema = ", ".join([f"c{i} {plain.schema[i].dataType.simpleString()}" for i in range(len(keep))] + [f"c{len(keep)} long"])
    return by_batches(plain, run, schema).toDF(*keep, out)


def gray_rank(fp):
    """The place of each code word in reflected Gray order, of an unsigned numpy array."""
    rank = fp.copy()
    for by in (1, 2, 4, 8, 16, 32):
        rank ^= rank >> np.uint64(by)
    return rank


def _merge(root: np.ndarray, i: np.ndarray, j: np.ndarray) -> None:
    """Unite the pairs in root, an array of pointers to the least member."""
    while len(i):
        i, j = root[i], root[j]
        apart = i != j
        i, j = i[apart], j[apart]
        np.minimum.at(root, np.maximum(i, j), np.minimum(i, j))
        while True:
            to = root[root]
            if np.array_equal(to, root):
                break
            root[:] = to


def tree_pairs(fps: np.ndarray, radius: int, visit: Callable[[np.ndarray, np.ndarray], None]) -> None:
    """Calls visit(i, j) with all places i < j whose fingerprints differ in `radius` bits at most, some at a time. fps: in
    Gray order."""
    n = len(fps)
    levels = []
    starts = np.arange(0, n, LEAF)
    all_, any_ = np.bitwise_and.reduceat(fps, starts), np.bitwise_or.reduceat(fps, starts)
    levels.append((all_, ~(all_ ^ any_)))
    while len(levels[-1][0]) > 1:
        starts = np.arange(0, len(levels[-1][0]), FAN)
        all_, any_ = np.bitwise_and.reduceat(all_, starts), np.bitwise_or.reduceat(any_, starts)
        levels.append((all_, ~(all_ ^ any_)))

    def leaves(u: np.ndarray, v: np.ndarray) -> None:
        span = np.arange(LEAF)
        for at in range(0, len(u), 256):
            i = (u[at : at + 256, None] * LEAF + span)[:, :, None]
            j = (v[at : at + 256, None] * LEAF + span)[:, None, :]
            i, j = np.broadcast_arrays(i, j)
            ok = (i < j) & (j < n)
            i, j = i[ok], j[ok]
            near = np.bitwise_count(fps[i] ^ fps[j]) <= radius
            visit(i[near], j[near])

    def down(level: int, u: np.ndarray, v: np.ndarray, seen: np.ndarray, gone: np.ndarray) -> None:
        """seen: the bits compared so far of each pair of nodes; gone: the differences on them."""
        all_, same = levels[level]
        new = same[u] & same[v] & ~seen
        gone = gone + np.bitwise_count((all_[u] ^ all_[v]) & new)
        ok = gone <= radius
        u, v, seen, gone = u[ok], v[ok], (seen | new)[ok], gone[ok]
        if not level:
            return leaves(u, v)
        below = len(levels[level - 1][0])
        for at in range(0, len(u), 4096):
            s = slice(at, at + 4096)
            a, b = np.divmod(np.arange(FAN * FAN), FAN)
            cu, cv = (u[s, None] * FAN + a).ravel(), (v[s, None] * FAN + b).ravel()
            more = np.repeat(np.arange(len(u[s])), FAN * FAN)
            ok = (cu <= cv) & (cv < below)
            down(level - 1, cu[ok], cv[ok], seen[s][more[ok]], gone[s][more[ok]])

    if n:
        zero = np.zeros(1, np.int64)
        down(len(levels) - 1, zero, zero, np.zeros(1, np.uint64), zero)


def tree_join(fps: np.ndarray, radius: int = 2) -> np.ndarray:
    """For distinct fingerprints in Gray order, the pointer of each to the least place that links reach."""
    root = np.arange(len(fps))
    tree_pairs(fps, radius, lambda i, j: _merge(root, i, j))
    return root


def link_group(fps: np.ndarray, radius: int = 2) -> tuple[np.ndarray, np.ndarray]:
    """(member, least member) for each fingerprint that has another as its least one. fps: in Gray order."""
    root = tree_join(fps, radius)
    moved = root != np.arange(len(fps))
    return fps[moved], fps[root[moved]]


def _stars(radius: int):
    def close(fps: np.ndarray, keys: np.ndarray) -> pa.RecordBatch:
        """All groups of whole keys; the rows come by key, then Gray rank."""
        starts = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        sizes = np.diff(np.r_[starts, len(keys)])
        a, b = [np.empty(0, np.uint64)], [np.empty(0, np.uint64)]
        two = starts[sizes == 2]
        near = two[np.bitwise_count(fps[two] ^ fps[two + 1]) <= radius]
        a.append(fps[near + 1])
        b.append(fps[near])
        for s, k in zip(starts[sizes > 2], sizes[sizes > 2], strict=True):
            x, y = link_group(fps[s : s + k], radius)
            a.append(x)
            b.append(y)
        return pa.RecordBatch.from_arrays([pa.array(np.concatenate(x).view(np.int64)) for x in (a, b)], names=["a", "b"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        keys, fps = np.empty(0, np.int64), np.empty(0, np.uint64)
        for batch in batches:
            keys = np.r_[keys, batch.column(0).to_numpy(zero_copy_only=False)]
            fps = np.r_[fps, batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)]
            if not len(keys):
                continue
            cut = int(np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])[-1])  # the last key may go on
            if cut:
                yield close(fps[:cut], keys[:cut])
                keys, fps = keys[cut:], fps[cut:]
        if len(keys):
            yield close(fps, keys)

    return run


def _masks(bits: list[int], parts: int) -> list[list[int]]:
    """The bits in so many runs of nearly one length."""
    edges = [round(i * len(bits) / parts) for i in range(parts + 1)]
    return [bits[a:b] for a, b in zip(edges, edges[1:], strict=False)]


def _word(bits: list[int]) -> int:
    """The bits as a signed long."""
    word = sum(1 << b for b in bits)
    return word - (1 << 64) if word >> 63 else word


def _gray(fp):
    rank = fp
    for by in (1, 2, 4, 8, 16, 32):
        rank = rank.bitwiseXOR(F.shiftrightunsigned(rank, by))
    return rank


def links(distinct: DataFrame, radius: int = 2, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """Edges (a, b) between distinct fingerprints (column fp) whose components are those of all pairs at `radius` or fewer
    bits. There are no more edges than rows dealt, whatever the number of such pairs."""
    spark = distinct.sparkSession
    everything = list(range(63, -1, -1))
    todo = [(distinct.select("fp"), [], everything)]
    found = None
    while todo:
        # one table for a depth: (way, key, fp); way numbers the run of bits that is shared
        ways, parts = [], []
        for rows, shared, rest in todo:
            for run in _masks(rest, radius + 1):
                ways.append((sorted(shared + run, reverse=True), [b for b in rest if b not in run]))
                parts.append(rows.select(F.lit(len(ways) - 1).alias("way"), F.col("fp").bitwiseAND(F.lit(_word(ways[-1][0]))).alias("key"), "fp"))
        dealt = parts[0]
        for part in parts[1:]:
            dealt = dealt.unionByName(part)
        last = min(len(rest) for _, rest in ways) <= 13  # no group of a shared key can have more than 2 ** 13 members
        hot = None
        if not last:
            counted = dealt.groupBy("way", "key").agg(F.count("*").alias("n")).where(F.col("n") > group_limit).select("way", "key")
            hot = staged(counted, "hot")
            hot = None if hot.isEmpty() else hot
        cold = dealt if hot is None else dealt.join(hot, ["way", "key"], "left_anti")
        ordered = cold.select(F.xxhash64("way", "key").alias("k"), "fp").repartition("k").sortWithinPartitions("k", _gray(F.col("fp")))
        edges = ordered.mapInArrow(_stars(radius), "a long, b long")
        found = edges if found is None else found.unionByName(edges)
        todo = []
        if hot is not None:
            again = staged(dealt.join(hot, ["way", "key"]), "recut")
            numbers = [r["way"] for r in hot.select("way").distinct().collect()]  # at most the number of ways
            todo = [(again.where(F.col("way") == w).select("fp"), *ways[w]) for w in numbers]
    return found if found is not None else spark.createDataFrame([], "a long, b long")


def _spread(rows: DataFrame, id_col: str, roots_of: Callable[[DataFrame], DataFrame]) -> DataFrame:
    """(id_col, node, component_id, root) of rows (id_col, node), a staged table, by the roots (node, root) of distinct nodes
    that are linked; root is the least node of the group."""
    distinct = staged(rows.groupBy("node").agg(F.min(id_col).alias("least")), "distinct")
    roots = roots_of(distinct)
    linked = staged(distinct.join(roots, "node", "left").select("node", "least", "root"), "roots")
    groups = linked.where("root is not null").groupBy("root").agg(F.min("least").alias("component_id"))
    alone = linked.where("root is null").select("node", F.col("least").alias("component_id"), F.col("node").alias("root"))
    of = linked.where("root is not null").join(groups, "root").select("node", "component_id", "root").unionByName(alone)
    return rows.join(of, "node").select(id_col, "node", "component_id", "root")


def near_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3, radius: int = 2, group_limit: int = GROUP_LIMIT) -> DataFrame:
    """(id_col, node, component_id, root) for every row of df, which needs no other columns than the two named; node is the
    fingerprint, a signed long.

    component_id is the least id among the rows whose fingerprints can be reached by links, the row itself included. Null
    and blank texts have fingerprint 0 and link like any other. Rows with a null id take part and never give their id: it is
    null where no row reached has one. Repeated rows are kept. An empty table gives an empty one.
    """
    rows = staged(fingerprints(df, [id_col], text_col, shingle, "node"), "fingerprints")
    return _spread(rows, id_col, lambda x: components(links(x.select(F.col("node").alias("fp")), radius, group_limit)))


# Near-duplicates by the share of common shingles. Copies that share four fifths of their shingles differ in 4 to 14 of 64
# bits, and in more where shingles are few, too many for blocks of equal bits; so rows are dealt by bands of least hashes.
# In a band they stand in the Gray order of their fingerprints, and an index as above, of masked bytes of the sketch, leaves
# out whole groups; what remains is tested exactly.

#: Bands, and least hashes of each; the same of the finer bands that a band of more than MEET texts is cut by.
BANDS, ROWS, FINER, FINER_ROWS = 14, 3, 6, 4
#: Of the least hashes, the share that must agree before a closer look; pairs of a row that are tested in the first round;
#: texts of a band that are looked at together; in larger bands, neighbours and hubs are linked before the rest.
AGREE, TESTS, MEET = 0.5, 4, 2_048
#: Bins of the closer look, and how far below the similarity its estimate may be. At 0.8 the bands miss 43 of a million pairs,
#: AGREE another 3.2 (fewer than 21 of 42 agree) and SLACK 1.5 (fewer than 758 of 1,024 bins): 48 in all at most. Where all
#: 14 bands of a pair hold over MEET texts, the finer bands miss 79 of a million instead of 43, and 780 if all of those do too.
BINS, SLACK = 1_024, 0.06
_MIX = np.random.default_rng(SEED).integers(1, 1 << 63, BANDS * ROWS + FINER * FINER_ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
PLACES = BANDS * ROWS


def _binned(hashes: np.ndarray) -> np.ndarray:
    """One byte of the least hash in each of BINS bins of distinct hashes; 0 for an empty bin."""
    out = np.zeros(BINS, np.uint8)
    hashes = np.unique(hashes * _MIX[0])  # in order of bin, then hash
    bins = (hashes >> np.uint64(54)).astype(np.int64)
    first = np.flatnonzero(np.r_[True, bins[1:] != bins[:-1]]) if len(bins) else bins
    out[bins[first]] = (hashes[first] >> np.uint64(8)).astype(np.uint8) % 255 + 1
    return out


def sketch(text: str | None, shingle: int) -> tuple[int, np.ndarray, np.ndarray, bytes, bytes]:
    """(Gray rank of the fingerprint of distinct shingles, keys of the finer bands, keys of the bands, one byte of each least
    hash of the bands, one byte of each bin)."""
    hashes = np.unique(np.concatenate([np.empty(0, np.uint64), *_hashes(text, shingle)]))
    least = np.full(len(_MIX), np.iinfo(np.uint64).max)
    for at in range(0, len(hashes), 4_096):
        part = hashes[at : at + 4_096, None] * _MIX
        np.minimum(least, (part ^ (part >> np.uint64(32))).min(axis=0), out=least)
    key = lambda rows: np.array([xxhash.xxh64_intdigest(x.tobytes(), i) for i, x in enumerate(rows)], np.uint64).view(np.int64)
    rank = gray_rank(np.array([_bits(hashes[at : at + SLICE] for at in range(0, len(hashes), SLICE))], np.uint64)).view(np.int64)[0]
    bands, finer = least[:PLACES].reshape(BANDS, ROWS), least[PLACES:].reshape(FINER, FINER_ROWS)
    return int(rank), key(finer), key(bands), (least[:PLACES] >> np.uint64(24)).astype(np.uint8).tobytes(), _binned(hashes).tobytes()


def _node(text_col: str):
    """What stands for a text: a hash of 64 bits, so that equal texts are one."""
    return F.xxhash64(F.coalesce(F.col(f"`{text_col}`"), F.lit("")))


def sketches(df: DataFrame, text_col: str, shingle: int) -> DataFrame:
    """(node, rank, finer, keys, sketch, bins) for every distinct text of df."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for k in range(0, whole.num_rows, 1_000):
                batch = whole.slice(k, 1_000)
                found = [sketch(x.as_py(), shingle) for x in batch.column(1)]
                kinds = (pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary(), pa.binary())
                rest = [pa.array([f[i] for f in found], kind) for i, kind in enumerate(kinds)]
                yield pa.RecordBatch.from_arrays([batch.column(0), *rest], names=["node", "rank", "finer", "keys", "sketch", "bins"])

    one = df.select(_node(text_col).alias("node"), F.col(f"`{text_col}`").alias("text"))
    return by_batches(one, run, "node long, rank long, finer array<long>, keys array<long>, sketch binary, bins binary").dropDuplicates(["node"])


def _agree(x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """The estimated similarity of rows of bins."""
    return ((x == y) & (x > 0)).sum(axis=-1) / np.maximum(1, ((x > 0) | (y > 0)).sum(axis=-1)) + ~((x > 0) | (y > 0)).any(axis=-1)


def alike(pairs: DataFrame, bins: DataFrame, least: float) -> DataFrame:
    """The pairs (a, b) whose bins agree often enough to be worth an exact test."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x, y = (np.frombuffer(b"".join(batch.column(i).to_pylist()), np.uint8).reshape(batch.num_rows, BINS) for i in (2, 3))
            ok = _agree(x, y) >= least
            yield pa.RecordBatch.from_arrays([batch.column(i).filter(pa.array(ok)) for i in (0, 1)], names=["a", "b"])

    left, right = (bins.select(F.col("node").alias(c), F.col("bins").alias(f"{c}s")) for c in "ab")
    return by_batches(pairs.join(left, "a").join(right, "b").select("a", "b", "as", "bs"), run, "a long, b long")


def shingle_sets(df: DataFrame, text_col: str, shingle: int) -> DataFrame:
    """(node, hashes) of rows (node, text): the distinct hashes of each text's shingles."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for k in range(0, batch.num_rows, 1_000):
                part = batch.slice(k, 1_000)
                sets = [np.unique(np.concatenate([np.empty(0, np.uint64), *_hashes(x.as_py(), shingle)])).view(np.int64) for x in part.column(1)]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array(sets, pa.list_(pa.int64()))], names=["node", "hashes"])

    return by_batches(df.select("node", F.col(f"`{text_col}`").alias("text")), run, "node long, hashes array<long>")


def _near_places(marks: np.ndarray, roots: np.ndarray, least: int, visit: Callable[[np.ndarray, np.ndarray, np.ndarray], None]) -> None:
    """Calls visit(i, j, places) with all rows i < j of unlike roots whose marks agree in `least` places or more, some at a
    time. Leaves are runs of rows; an upper node holds the places in which all below agree, and pairs of nodes that differ in
    too many of them are left out with all that is below, as are those of a single root."""
    n, most = len(marks), marks.shape[1] - least
    starts = np.arange(0, n, LEAF)
    low, high = np.minimum.reduceat(marks, starts), np.maximum.reduceat(marks, starts)
    levels = [(low, low == high, np.minimum.reduceat(roots, starts), np.maximum.reduceat(roots, starts))]
    while len(levels[-1][0]) > 1:
        starts = np.arange(0, len(levels[-1][0]), FAN)
        low, high = np.minimum.reduceat(low, starts), np.maximum.reduceat(high, starts)
        levels.append((low, low == high, np.minimum.reduceat(levels[-1][2], starts), np.maximum.reduceat(levels[-1][3], starts)))
    span = np.arange(LEAF)

    def leaves(u: np.ndarray, v: np.ndarray) -> None:
        for at in range(0, len(u), 64):
            i, j = np.broadcast_arrays((u[at : at + 64, None] * LEAF + span)[:, :, None], (v[at : at + 64, None] * LEAF + span)[:, None, :])
            ok = (i < j) & (j < n)
            i, j = i[ok], j[ok]
            apart = roots[i] != roots[j]
            i, j = i[apart], j[apart]
            places = (marks[i] == marks[j]).sum(axis=1)
            near = places >= least
            visit(i[near], j[near], places[near])

    def down(level: int, u: np.ndarray, v: np.ndarray) -> None:
        low, same, first, last = levels[level]
        ok = ((low[u] != low[v]) & same[u] & same[v]).sum(axis=1) <= most
        ok &= (first[u] != last[u]) | (first[v] != last[v]) | (first[u] != first[v])
        u, v = u[ok], v[ok]
        if not level:
            return leaves(u, v)
        below = len(levels[level - 1][0])
        a, b = np.divmod(np.arange(FAN * FAN), FAN)
        for at in range(0, len(u), 1_024):
            cu, cv = (u[at : at + 1_024, None] * FAN + a).ravel(), (v[at : at + 1_024, None] * FAN + b).ravel()
            ok = (cu <= cv) & (cv < below)
            down(level - 1, cu[ok], cv[ok])

    down(len(levels) - 1, np.zeros(1, np.int64), np.zeros(1, np.int64))


def _matrix(column: pa.Array) -> np.ndarray:
    return np.frombuffer(b"".join(column.to_pylist()), np.uint8).reshape(len(column), -1)


def _columns(column: pa.Array) -> np.ndarray:
    """A column as an array, with a row of bytes or longs for each value that is binary or a list of one length."""
    if pa.types.is_binary(column.type):
        return _matrix(column)
    if pa.types.is_list(column.type):
        return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), -1)
    return column.to_numpy(zero_copy_only=False)


def _by_key(of: Callable[..., tuple], names: list[str]):
    """An Arrow function that calls `of` with the arrays of each run of an equal first column, which follow one another; it
    gives arrays of longs, null where a mask of them says so."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(parts: list[tuple]) -> pa.RecordBatch:
            cols = [np.concatenate([p[i] for p in parts] or [np.empty(0, np.int64)]) for i in range(len(names))]
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in cols], names=names)

        held: list[np.ndarray] = []
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [_columns(c) for c in batch.columns]
            held = [np.concatenate(x) for x in zip(held, cols, strict=True)] if held else cols
            starts = np.flatnonzero(np.r_[True, held[0][1:] != held[0][:-1]])
            yield out([of(*(x[s:e] for x in held)) for s, e in zip(starts, starts[1:], strict=False) if e - s > 1])
            held = [x[starts[-1] :] for x in held]  # the last key may go on
        if held and len(held[0]) > 1:
            yield out([of(*held)])

    return run


def _neighbours(keys: np.ndarray, nodes: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """From the rows of a band in Gray order, pairs (a, b): each with the next two, and with the two that agree best with what
    the most agree in, such as the text that copies were made of. 4,096 rows are looked at together."""
    a, b = [nodes[:0]], [nodes[:0]]
    for at in range(0, len(nodes), 4_096):
        own, part = nodes[at : at + 4_096], marks[at : at + 4_096]
        usual = np.array([np.bincount(part[:, c], minlength=256).argmax() for c in range(part.shape[1])], np.uint8)
        hubs = np.argsort(-(part == usual).sum(axis=1), kind="stable")[:2]
        every = np.arange(len(own))
        for i, j in [(every[:-1], every[1:]), (every[:-2], every[2:]), *((every, np.full(len(own), h)) for h in hubs)]:
            near = ((part[i] == part[j]).sum(axis=1) >= AGREE * part.shape[1]) & (own[i] != own[j])
            a.append(own[i[near]])
            b.append(own[j[near]])
    a, b = np.concatenate(a), np.concatenate(b)
    return np.minimum(a, b), np.maximum(a, b)


#: What stands for null in arrays of longs of nodes and keys; it is a hash of nothing with a chance of 1 in 2 ** 64.
NONE = -(1 << 63)


def _to_test(turn: int, least: float):
    """From rows (k, node, root, side, sketch) of a band in Gray order, and their bins in later turns, and the keys of their
    bands where every band is looked at whole: then a pair comes from the first band it shares only. Only unlike sides meet if
    a k has both: (a, b, NONE), pairs of unlike roots to test in this turn, and (NONE, NONE, k) for each k that has pairs
    left for a later one. Each turn takes four times as many pairs of a row."""
    high = TESTS * 4**turn

    def meet(keys: np.ndarray, nodes: np.ndarray, roots: np.ndarray, sides: np.ndarray, marks: np.ndarray, bins: np.ndarray | None = None, bands: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A row's candidates are taken in an order: those first that are like it and like many others."""
        halves, found = bool(sides.any()) and not sides.all(), []

        def visit(i: np.ndarray, j: np.ndarray, places: np.ndarray) -> None:
            if halves:
                across = sides[i] != sides[j]
                i, j, places = i[across], j[across], places[across]
            like = places / np.float64(marks.shape[1])
            if bins is not None:
                like = np.concatenate([like[:0], *(_agree(bins[i[k : k + 10_000]], bins[j[k : k + 10_000]]) for k in range(0, len(i), 10_000))])
                close = like >= least
                i, j, like = i[close], j[close], like[close]
            if bands is not None and len(i):
                here = bands[i, (bands[i] == bands[j]).argmax(axis=1)] == keys[0]
                i, j, like = i[here], j[here], like[here]
            found.append((i.astype(np.int32), j.astype(np.int32), like.astype(np.float32)))

        _near_places(marks, roots, math.ceil(AGREE * marks.shape[1]), visit)
        i, j, like = (np.concatenate([x[c] for x in found] or [np.empty(0, np.int32)]) for c in range(3))
        found.clear()
        liked = (np.bincount(i, like, len(nodes)) + np.bincount(j, like, len(nodes))) / len(nodes)
        a, b, left = [nodes[:0]], [nodes[:0]], False
        for at in range(0, len(nodes), 256):
            mine, theirs = (i >= at) & (i < at + 256), (j >= at) & (j < at + 256)
            own, other, worth = np.r_[i[mine], j[theirs]], np.r_[j[mine], i[theirs]], np.r_[like[mine], like[theirs]]
            order = np.lexsort((nodes[other], -worth - liked[other], own))
            own, other = own[order], other[order]
            first = np.flatnonzero(np.r_[True, own[1:] != own[:-1]]) if len(own) else own
            nth = np.arange(len(own)) - np.repeat(first, np.diff(np.r_[first, len(own)]))
            now = nth < high
            left = left or not now.all()
            a.append(nodes[own[now]])
            b.append(nodes[other[now]])
        a, b, more = np.concatenate(a), np.concatenate(b), keys[: int(left)]
        pairs = np.unique(np.stack((np.minimum(a, b), np.maximum(a, b)), axis=1), axis=0)
        none = np.full(len(more), NONE)
        return np.r_[pairs[:, 0], none], np.r_[pairs[:, 1], none], np.r_[np.full(len(pairs), NONE), more]

    return _by_key(meet, ["a", "b", "more"])


def in_blocks(dealt: DataFrame) -> DataFrame:
    """dealt (k, node, root, n), n texts in a k, as (k, node, side, root): each k is cut into blocks of half of MEET, and each two blocks
    meet under a k of their own, one as side 0 and one as side 1, so that all pairs meet in bounded groups."""
    blocks = F.ceil(F.col("n") * 2 / MEET).cast("int")
    cut = dealt.withColumn("own", F.pmod(F.xxhash64("node", F.lit("block")), blocks).cast("int")).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    return cut.select(F.xxhash64("k", F.least("own", "other"), F.greatest("own", "other")).alias("k"), "node", (F.col("own") > F.col("other")).cast("int").alias("side"), "root")


def similar_components(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 5, similarity: float = 0.8) -> DataFrame:
    """(id_col, node, component_id, root) like near_components, where texts link if the sets of their shingles have a Jaccard
    similarity of `similarity` or more; node is a hash of the text. Each link is tested exactly on whole sets.

    Candidates are, first, the texts whose fingerprints the index above links. Of the others, texts that should link share a
    band's key and pass both looks but for 5 of 100,000 at 0.8 (8 of 10,000 in a crowd that no
    band takes apart). Texts of a large band are first tested against their neighbours in Gray order and against hubs; bands
    whose texts are linked by then go, and what is left of large ones is cut by finer bands. A text's candidates are tested a
    few at a time, the likeliest first, and those that links have joined meanwhile need no test, so a group of copies isn't
    expanded into pairs. Rounds go on until no pair is left. Null and blank texts are alike; nulls among ids, repeated rows
    and empty tables are as in near_components.
    """
    rows = staged(df.select(F.col(f"`{id_col}`"), _node(text_col).alias("node")), "nodes")
    one = staged(sketches(df, text_col, shingle), "sketches")
    return _spread(rows, id_col, lambda _: _Links(df, one, text_col, shingle, similarity).all())


class _Links:
    """The links found so far between the texts of `one` (see sketches)."""

    def __init__(self, df: DataFrame, one: DataFrame, text_col: str, shingle: int, similarity: float):
        self.df, self.one, self.text_col, self.shingle, self.similarity = df, one, text_col, shingle, similarity
        self.roots = self.tested = self.sets = self.bins = None

    def rooted(self, groups: DataFrame) -> DataFrame:
        """groups with the root of each node so far."""
        if self.roots is None:
            return groups.withColumn("root", F.col("node"))
        return groups.join(self.roots, "node", "left").withColumn("root", F.coalesce("root", "node"))

    def apart(self, groups: DataFrame) -> DataFrame:
        """groups (k, node, ...) with root and the number n of texts, without those k that have a single root. A root that
        groups have is taken for the present one."""
        rooted = groups if "root" in groups.columns else self.rooted(groups)
        sizes = rooted.groupBy("k").agg(F.count("*").alias("n"), F.min("root").alias("lo"), F.max("root").alias("hi")).where("lo <> hi").select("k", "n")
        return rooted.join(sizes, "k")

    def _of(self, nodes: DataFrame) -> None:
        """Bins and sets of nodes that have none yet."""
        if self.bins is not None:
            nodes = nodes.join(self.bins.select("node"), "node", "left_anti")
        nodes = staged(nodes, "needed")
        texts = self.df.select(_node(self.text_col).alias("node"), F.col(f"`{self.text_col}`").alias("text")).join(small(nodes, BROADCAST_IDS), "node", "left_semi").dropDuplicates(["node"])
        bins, sets = staged(self.one.select("node", "bins").join(small(nodes, BROADCAST_IDS), "node", "left_semi"), "bins"), staged(shingle_sets(texts, "text", self.shingle), "sets")
        self.bins, self.sets = (bins, sets) if self.bins is None else (self.bins.unionByName(bins), self.sets.unionByName(sets))

    def test(self, pairs: DataFrame, new: bool) -> None:
        """Adds those of pairs (a, b) that pass; new: whether they may hold nodes that no pair has held."""
        if self.tested is not None:
            pairs = pairs.join(self.tested, ["a", "b"], "left_anti")
        pairs = staged(pairs.distinct(), "pairs")
        if self.roots is not None and pairs.isEmpty():
            return
        self.tested = pairs if self.tested is None else self.tested.unionByName(pairs)
        if new:
            self._of(pairs.select(F.explode(F.array("a", "b")).alias("node")).distinct())
        close = alike(pairs, self.bins, self.similarity - SLACK)
        left, right = (self.sets.select(F.col("node").alias(c), F.col("hashes").alias(f"{c}s")) for c in "ab")
        both = F.size(F.array_intersect("as", "bs"))
        passed = close.join(left, "a").join(right, "b").where(both >= F.lit(self.similarity) * (F.size("as") + F.size("bs") - both)).select("a", "b")
        if self.roots is None:
            self.roots = staged(components(passed), "so-far")
            return
        # what is joined now are groups, by their roots
        for c in "ab":
            passed = passed.join(self.roots.select(F.col("node").alias(c), F.col("root").alias("of")), c, "left").withColumn(c, F.coalesce("of", c)).drop("of")
        joined = components(passed)
        moved = self.roots.join(joined.select(F.col("node").alias("root"), F.col("root").alias("now")), "root", "left").select("node", F.coalesce("now", "root").alias("root"))
        self.roots = staged(moved.unionByName(joined.join(self.roots, "node", "left_anti")), "so-far")

    def by_bits(self) -> DataFrame:
        """Pairs (a, b) of texts whose fingerprints link, by the index over blocks of equal bits: as stars, and texts of one
        fingerprint with the least of them."""
        of = self.one.select("node", F.col("rank").bitwiseXOR(F.shiftrightunsigned("rank", 1)).alias("fp"))  # the Gray code of its rank
        first = staged(of.groupBy("fp").agg(F.min("node").alias("first")), "prints")
        linked = links(first.select("fp"))
        ends = [first.select(F.col("fp").alias(c), F.col("first").alias(f"of_{c}")) for c in "ab"]
        stars = linked.join(ends[0], "a").join(ends[1], "b").select(F.least("of_a", "of_b").alias("a"), F.greatest("of_a", "of_b").alias("b"))
        return stars.unionByName(of.join(first, "fp").where("node <> first").select(F.col("first").alias("a"), F.col("node").alias("b")))

    def cut(self, large: DataFrame) -> DataFrame:
        """(k, node, side, root) groups of at most MEET texts from large bands (k, node): those in which more than one root is
        left, cut by finer bands, twice if need be, and what is too large still in blocks."""
        out = None
        for depth in range(3):
            left = staged(self.apart(large).select("k", "node", "root", "n"), "apart")
            ready = left.where(F.col("n") <= MEET).select("k", "node", F.lit(0).alias("side"), "root")
            out = ready if out is None else out.unionByName(ready)
            left = left.where(F.col("n") > MEET)
            if left.isEmpty():
                return out
            if depth < 2:
                finer = left.join(self.one.select("node", "finer"), "node").select("k", "node", "root", F.posexplode("finer").alias("i", "f"))
                large = finer.select(F.xxhash64("k", "i", "f").alias("k"), "node", "root")
        return out.unionByName(in_blocks(left))

    def all(self) -> DataFrame:
        """The roots (node, root) of all texts that are linked. Texts whose fingerprints link are tested first; bands find those
        that differ in more bits."""
        self.test(self.by_bits(), True)
        dealt = self.one.select("node", F.explode("keys").alias("k"))
        sizes = dealt.groupBy("k").agg(F.count("*").alias("n")).where("n > 1")
        bands = staged(dealt.join(sizes, "k"), "bands")
        marks = self.one.select("node", "rank", "sketch")
        groups = bands.where(F.col("n") <= MEET).select("k", "node", F.lit(0).alias("side"))
        large = bands.where(F.col("n") > MEET).select("k", "node")
        whole = large.isEmpty()
        if not whole:
            ordered = staged(large.join(marks, "node"), "crowds").repartitionByRange("k", "rank", "node").sortWithinPartitions("k", "rank", "node").select("k", "node", "sketch")
            self.test(by_batches(ordered, _by_key(_neighbours, ["a", "b"]), "a long, b long"), True)
            groups = staged(groups.unionByName(self.cut(large).select("k", "node", "side")), "groups")
        todo, turn = groups, 0
        while True:
            apart = self.rooted(todo) if self.roots is None else self.apart(todo)
            more = ["bins", *["keys"] * whole] if turn else []
            marked = apart.join(self.one.select("node", "rank", "sketch", "keys").join(self.bins, "node") if turn else marks, "node")
            cols = ["k", "node", "root", "side", "sketch", *more]
            ordered = marked.repartition("k").sortWithinPartitions("k", "rank", "node").select(*cols)
            out = staged(by_batches(ordered, _to_test(turn, self.similarity - SLACK), "a long, b long, more long"), "candidates")
            self.test(out.where(F.col("a") != NONE).select("a", "b"), not turn)
            again = out.where(F.col("more") != NONE).select(F.col("more").alias("k")).distinct()
            if again.isEmpty():
                return self.roots
            todo, turn = groups.join(small(again, BROADCAST_IDS), "k", "left_semi"), turn + 1


def representatives(df: DataFrame, groups: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """df with one row of each of `groups`, which similar_components has found in df: that with the least id; where the group
    repeats that id, that with the least node, any one of equal texts. Groups that share an id keep a row each. Rows with a null
    id stay only where their group has no other, one for each text. All columns stay as they are, whatever their names, and
    an empty table gives an empty one."""
    groups = staged(groups.select(F.col(f"`{id_col}`").alias("id"), "node", "component_id", "root"), "groups")
    packed = df.select(F.struct(*[F.col(f"`{c}`") for c in df.columns]).alias("all"), F.col(f"`{id_col}`").alias("id"), _node(text_col).alias("node"))
    gone = groups.where(F.col("id") != F.col("component_id")).select("id", "node")
    repeated = staged(groups.groupBy("id").agg(F.count("*").alias("n")).where("n > 1 and id is not null").select("id"), "repeated")
    clash = not repeated.isEmpty()
    if clash:
        least = groups.where(F.col("id") == F.col("component_id")).join(repeated, "id", "left_semi").select("id", "node", "root")
        firsts = least.groupBy("root").agg(F.min("node").alias("first"))
        gone = gone.unionByName(least.join(firsts, "root").where("node <> first").select("id", "node"))
    gone = staged(gone.distinct(), "gone")
    kept = packed.where("id is not null").join(small(gone, BROADCAST_IDS // 2), ["id", "node"], "left_anti").select(*packed.columns)
    if clash:
        kept = kept.join(repeated, "id", "left_anti").select(*kept.columns).unionByName(kept.join(repeated, "id", "left_semi").select(*kept.columns).dropDuplicates(["id", "node"]))
    if not groups.where("id is null").isEmpty():
        named = groups.where("component_id is not null").select("node").distinct()
        alone = packed.where("id is null").join(named, "node", "left_anti").select(*packed.columns)
        kept = kept.unionByName(alone.dropDuplicates(["node"]))
    return kept.select("all.*")


def op9_simhash(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    out = near_components(docs)
    return out.select("doc_id", F.lower(F.lpad(F.hex("node"), 16, "0")).alias("fingerprint"), F.col("component_id").cast("long").alias("component_id"))
