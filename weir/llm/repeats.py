"""Removal of passages that an earlier document has, by Rabin-Karp hashes of every window of words.

Documents are dealt to chunks of some megabytes. A chunk hashes its words and then all windows of `size` words by prefix sums
of a polynomial, in numpy over the bytes of all its texts at once, and keeps each hash once, with the least id that has it. The
hashes go to buckets by their leading bits, packed; a bucket counts what the chunks hold of each and gives back to a chunk
those that occur in a document of a smaller id than one of its own. The chunk marks these windows, and marked windows that
touch become maximal intervals. A window that all documents share is one row for each chunk, not for each document.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words of a window.
SIZE = 50
#: Bytes of text of a chunk, and hashes of a bucket, about.
CHUNK_BYTES, BUCKET = 4 << 20, 1 << 18
#: Bytes, and words, that are hashed at a time.
SLICE = 1 << 20
#: Multipliers of the polynomials over bytes and over words, modulo 2 ** 64.
BYTE_BASE, WORD_BASE = 0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F
NO_ID = 2**63 - 1


class _Powers:
    """Powers of an odd base and of its inverse modulo 2 ** 64."""

    def __init__(self, base: int) -> None:
        self.bases = [base, pow(base, -1, 1 << 64)]
        self.tables = [np.ones(1, np.uint64)] * 2

    def upto(self, n: int) -> list[np.ndarray]:
        if len(self.tables[0]) < n:
            self.tables = [np.cumprod(np.concatenate([np.ones(1, np.uint64), np.full(max(n, SLICE) - 1, b, np.uint64)])) for b in self.bases]
        return self.tables


_BYTES, _WORDS = _Powers(BYTE_BASE), _Powers(WORD_BASE)


def _mixed(x: np.ndarray) -> np.ndarray:
    """Spreads what differs in any bit over all bits; one to one."""
    for shift, times in ((30, 0xBF58476D1CE4E5B9), (27, 0x94D049BB133111EB)):
        x = (x ^ (x >> np.uint64(shift))) * np.uint64(times)
    return x ^ (x >> np.uint64(31))


def _ranges(values: np.ndarray, first: np.ndarray, last: np.ndarray, powers: _Powers) -> np.ndarray:
    """The polynomial of values[first:last] for each pair, whatever its place: differences of prefix sums, shifted back."""
    up, down = powers.upto(len(values) + 1)
    sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(values * up[: len(values)], dtype=np.uint64)])
    return _mixed((sums[last] - sums[first]) * down[first])


def word_hashes(data: np.ndarray, docs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each word in the bytes of several texts, and the text it is in. docs: where texts begin, and the end."""
    space = (data == 32) | ((data >= 9) & (data <= 13))
    edge = np.zeros(len(data) + 1, bool)
    edge[docs] = True
    apart = np.concatenate([[True], space, [True]])
    first, last = np.flatnonzero(~space & (apart[:-2] | edge[:-1])), np.flatnonzero(~space & (apart[2:] | edge[1:])) + 1
    hashes, at = np.empty(len(first), np.uint64), 0
    while at < len(first):
        to = max(at + 1, int(np.searchsorted(last, first[at] + SLICE, "right")))
        begin = first[at]
        hashes[at:to] = _ranges(data[begin : last[to - 1]].astype(np.uint64) + np.uint64(1), first[at:to] - begin, last[at:to] - begin, _BYTES)
        at = to
    return hashes, np.searchsorted(docs, first, "right") - 1


def window_hashes(words: np.ndarray, doc: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """The hash of each window of `size` words of one text, and the word it begins at."""
    found, starts = [], []
    for at in range(0, len(words) - size + 1, SLICE):
        part = words[at : at + SLICE + size - 1]
        k = np.arange(len(part) - size + 1)
        k = k[doc[at : at + len(k)] == doc[at + size - 1 : at + size - 1 + len(k)]]
        found.append(_ranges(part, k, k + size, _WORDS))
        starts.append(k + at)
    return (np.concatenate(found), np.concatenate(starts)) if found else (np.empty(0, np.uint64), np.empty(0, np.int64))


def _texts(texts: pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts one after another, and where each begins."""
    column = pa.concat_arrays([c.cast(pa.large_binary()) for c in pc.fill_null(texts, "").chunks] or [pa.array([], pa.large_binary())])
    docs = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(column.buffers()[2], np.uint8)[docs[0] : docs[-1]] if docs[-1] > docs[0] else np.empty(0, np.uint8)
    return data, docs - docs[0]


def _windows(table: pa.Table, size: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(hash, first word) of all windows, and (text of each word, words of each text)."""
    data, docs = _texts(table["text"])
    words, doc = word_hashes(data, docs)
    return *window_hashes(words, doc, size), doc, np.bincount(doc, minlength=len(docs) - 1)


def _planes(x: np.ndarray) -> bytes:
    """64-bit numbers byte by byte, all first bytes together: those that are mostly zero cost next to nothing once compressed."""
    return np.ascontiguousarray(x).view(np.uint8).reshape(-1, 8).T.tobytes()


def pack(hashes: np.ndarray, ids: np.ndarray, several: np.ndarray) -> bytes:
    """Ascending hashes as differences, ids, and a bit for each."""
    return b"".join((_planes(np.diff(hashes, prepend=np.uint64(0))), _planes(ids), np.packbits(several).tobytes()))


def unpack(packed: bytes, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    planes = np.frombuffer(packed, np.uint8, 16 * n).reshape(2, 8, n)
    gaps, ids = (np.ascontiguousarray(p.T).view(kind).reshape(n) for p, kind in zip(planes, (np.uint64, np.int64), strict=True))
    return np.cumsum(gaps, dtype=np.uint64), ids, np.unpackbits(np.frombuffer(packed, np.uint8, offset=16 * n), count=n).astype(bool)


def _unpacked(table: pa.Table) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """What all rows hold, and the row of each."""
    counts = table["n"].to_numpy()
    parts = [unpack(x.as_py(), n) for x, n in zip(table["packed"], counts, strict=True)]
    if not parts:
        return np.empty(0, np.uint64), np.empty(0, np.int64), np.empty(0, bool), np.empty(0, np.int64)
    return *map(np.concatenate, zip(*parts, strict=True)), np.repeat(np.arange(len(counts)), counts)


def _rows(kind: str, keys: np.ndarray, cuts: np.ndarray, other: object, hashes: np.ndarray, ids: np.ndarray, several: np.ndarray) -> pa.Table:
    """Rows (bucket, chunk, n, packed), one for each key, of the entries between its cut and the next."""
    packed = [pack(hashes[a:b], ids[a:b], several[a:b]) for a, b in zip(cuts[:-1], cuts[1:], strict=True)]
    both = {kind: pa.array(keys, pa.int64()), ("chunk" if kind == "bucket" else "bucket"): pa.array(np.full(len(keys), other, np.int64))}
    return pa.table({"bucket": both["bucket"], "chunk": both["chunk"], "n": pa.array(np.diff(cuts), pa.int64()), "packed": pa.array(packed, pa.binary())})


ROWS = "bucket long, chunk long, n long, packed binary"


def _cuts(keys: np.ndarray) -> np.ndarray:
    """Where each run of equal keys begins, and the end."""
    return np.concatenate([np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])), [len(keys)]]) if len(keys) else np.zeros(1, np.int64)


def held(table: pa.Table, size: int, bits: int) -> pa.Table:
    """A chunk's distinct hashes by bucket: each with the least id that has it, and whether a larger one has it too."""
    table = table.sort_by("key")
    hashes, starts, doc, _ = _windows(table, size)
    ids = table["key"].to_numpy()[doc[starts]]
    order = np.argsort(hashes, kind="stable")  # ids ascend among equal hashes
    hashes, ids = hashes[order], ids[order]
    cuts = _cuts(hashes)
    least, most = ids[cuts[:-1]], ids[cuts[1:] - 1]
    hashes = hashes[cuts[:-1]]
    buckets = (hashes >> np.uint64(64 - bits)).astype(np.int64) if bits else np.zeros(len(hashes), np.int64)
    cuts = _cuts(buckets)
    return _rows("bucket", buckets[cuts[:-1]], cuts, table["chunk"][0].as_py(), hashes, least, most > least)


def counted(table: pa.Table) -> pa.Table:
    """What a bucket gives back to each chunk: the hashes that a document with a smaller id than one of the chunk's has, and the
    least id of all."""
    hashes, ids, several, row = _unpacked(table)
    order = np.argsort(hashes, kind="stable")
    hashes, ids, several, row = hashes[order], ids[order], several[order], row[order]
    cuts = _cuts(hashes)
    least = np.repeat(np.minimum.reduceat(ids, cuts[:-1]), np.diff(cuts)) if len(ids) else ids
    back = np.flatnonzero((least < ids) | several)
    back = back[np.argsort(row[back], kind="stable")]
    cuts = _cuts(row[back])
    chunks = table["chunk"].to_numpy()[row[back][cuts[:-1]]]
    return _rows("chunk", chunks, cuts, table["bucket"][0].as_py(), hashes[back], least[back], np.zeros(len(back), bool))


def marked(table: pa.Table, given: pa.Table, size: int) -> Iterator[tuple[int, list[tuple[int, int]]]]:
    """For each text of a chunk the number of its words and the maximal intervals of words that go."""
    hashes, starts, doc, counts = _windows(table, size)
    known, least, _, _ = _unpacked(given)
    order = np.argsort(known, kind="stable")
    known, least = known[order], least[order]
    change = np.zeros(len(doc) + 1, np.int64)
    if len(known):
        at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
        gone = starts[(known[at] == hashes) & (least[at] < table["key"].to_numpy()[doc[starts]])]
        change[gone] += 1
        change[gone + size] -= 1
    covered = np.cumsum(change[:-1]) > 0
    first = np.concatenate([[0], np.cumsum(counts)])
    open_ = np.flatnonzero(covered & ~(np.concatenate([[False], covered[:-1]]) & (np.concatenate([[-1], doc[:-1]]) == doc)))
    close = np.flatnonzero(covered & ~(np.concatenate([covered[1:], [False]]) & (np.concatenate([doc[1:], [-1]]) == doc))) + 1
    of = np.searchsorted(doc[open_], np.arange(len(counts) + 1)) if len(open_) else np.zeros(len(counts) + 1, np.int64)
    for i, n in enumerate(counts):
        yield int(n), [(int(a - first[i]), int(b - first[i])) for a, b in zip(open_[of[i] : of[i + 1]], close[of[i] : of[i + 1]], strict=True)]


def _kept(text: bytes, spans: list[tuple[int, int]]) -> bytes:
    words = text.split()
    for a, b in reversed(spans):
        del words[a:b]
    return b" ".join(words)


def without_repeats(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", size: int = SIZE, chunk_bytes: int = CHUNK_BYTES) -> DataFrame:
    """(id, n_words, spans, kept) for every row of df. spans: the maximal intervals [start, end) of words that lie in a window of
    `size` words which a row with a smaller id has too; kept: the other words, joined by one space.

    Ids are whole numbers. A null id comes after all others; rows of one id, or with null ids, take nothing from each other.
    Windows are judged on the input. Texts may be null or empty (no words), shorter than a window (nothing goes) or of any
    length. Windows are equal if 64-bit hashes are: among n windows any two different ones are taken for equal with a
    probability of about n^2 / 2^65. Rows of one id are in one chunk only as far as they come from one input partition. Other
    columns may have any name; an empty table gives none.
    """
    key, text = F.col(f"`{id_col}`"), F.col(f"`{text_col}`")
    total = df.agg(F.sum(F.octet_length(text))).first()[0] or 0
    chunks, bits = max(1, math.ceil(total / chunk_bytes)), max(0, math.ceil(math.log2(max(1, total / 6 / BUCKET))))
    chunk = F.pmod(F.xxhash64(key, F.spark_partition_id()), F.lit(chunks)).alias("chunk")
    docs = df.select(chunk, key.alias("id"), F.coalesce(key.cast("long"), F.lit(NO_ID)).alias("key"), text.alias("text"))
    kind = docs.schema["id"].dataType

    def finish(table: pa.Table, given: pa.Table) -> pa.Table:
        told = list(marked(table, given, size))
        kept = [_kept((x.as_py() or "").encode(), spans) for x, (_, spans) in zip(table["text"], told, strict=True)]
        spans = pa.array([[{"start": a, "end": b} for a, b in s] for _, s in told], pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))
        return pa.table({"id": table["id"], "n_words": pa.array([n for n, _ in told], pa.int64()), "spans": spans, "kept": pa.array(kept, pa.binary()).cast(pa.string())})

    hashes = docs.groupBy("chunk").applyInArrow(lambda t: held(t, size, bits), ROWS)
    back = hashes.groupBy("bucket").applyInArrow(counted, ROWS)
    ddl = f"id {kind.simpleString()}, n_words long, spans array<struct<start: long, end: long>>, kept string"
    return docs.groupBy("chunk").cogroup(back.groupBy("chunk")).applyInArrow(lambda left, right: finish(left, right), ddl)


def op12_repeats(spark, sf_dir: str) -> DataFrame:
    out = without_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet"))
    removed = F.aggregate("spans", F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select(F.col("id").alias("doc_id"), "n_words", removed.alias("n_removed"), F.sha2(F.col("kept").cast("binary"), 256).alias("kept_sha256"))


OP12_SQL = r"""
WITH d AS (SELECT doc_id, list_filter(regexp_split_to_array(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents),
p AS (SELECT doc_id, unnest(w) AS x, unnest(range(1, len(w) + 1)) AS i, len(w) AS n FROM d),
v AS (SELECT doc_id, i, x, i <= n - 49 AS whole, string_agg(x, ' ') OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN CURRENT ROW AND 49 FOLLOWING) AS z FROM p),
g AS (SELECT doc_id, i, x, whole AND min(doc_id) OVER (PARTITION BY whole, z) < doc_id AS starts FROM v),
c AS (SELECT doc_id, i, x, bool_or(starts) OVER (PARTITION BY doc_id ORDER BY i ROWS BETWEEN 49 PRECEDING AND CURRENT ROW) AS gone FROM g),
k AS (SELECT doc_id, count(*) FILTER (gone) AS n, string_agg(x, ' ' ORDER BY i) FILTER (NOT gone) AS kept FROM c GROUP BY doc_id)
SELECT d.doc_id, len(w)::BIGINT AS n_words, coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256 FROM d LEFT JOIN k ON d.doc_id = k.doc_id
"""
