"""Merkle manifest, removal of repeated passages and fill-in-the-middle against plain Python: nulls, ties, long texts, names."""

import collections
import hashlib
import random
import re

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from weir.llm import infill, merkle, repeats
from weir.llm.queries import QUERIES

SF = "/root/testdata/sf0.001"
CLASH = ["tree", "digest", "index", "count", "at", "row", "range", "n", "nodes", "above", "a.b", "key", "chunk", "bucket", "packed", "id", "output", "form", "kept", "spans", "proof", "root", "place", "also"]
WORD = re.compile(r"[^\x20\x09-\x0D]+")


def named(df):
    return df.select("*", *[F.lit(1).alias(c) for c in CLASH])


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def plain_tree(leaves, fanout):
    """(root, proofs) by runs of a list."""
    proofs, nodes, at = [[] for _ in leaves], list(leaves), list(range(len(leaves)))
    while len(nodes) > 1:
        runs = [nodes[i : i + fanout] for i in range(0, len(nodes), fanout)]
        for k, i in enumerate(at):
            run = runs[i // fanout]
            proofs[k] += run[: i % fanout] + run[i % fanout + 1 :]
        nodes, at = [H(*r) for r in runs], [i // fanout for i in at]
    return nodes[0], ["".join(p) for p in proofs]


def plain_leaf(*values):
    return H(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in values])


@pytest.mark.parametrize("fanout", [2, 8])
def test_manifest(spark, fanout):
    rng = random.Random(fanout)
    rows = [(i, rng.choice([None, "", "Ünï", f"Text {i}"]), rng.choice([None, "en", "de", "zz", "é"])) for i in range(300)] + [(1000 + i, "x", "big") for i in range(1100)]
    rows += [(None, "null id", "en"), (None, "null id", "en"), (7, "Same", "en"), (7, "Same", "en"), (5000, "", "alone")]
    df = named(spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5))
    also = F.when(F.col("doc_id") % 3 == 0, F.lower("text"))
    got = merkle.folded(merkle.manifest(df, ["doc_id", "lang", "text"], also={"text": also}, fanout=fanout), F.coalesce("also", "digest"), fanout).collect()
    trees = collections.defaultdict(list)
    for i, t, lang in rows:
        trees[lang].append((-1 if i is None else i, plain_leaf(i, lang, t), i, t))
    names = sorted(trees, key=lambda x: b"" if x is None else b"=" + x.encode())
    built = {n: plain_tree([x[1] for x in sorted(trees[n], key=lambda x: x[:2])], fanout) for n in names}
    root, upper = plain_tree([built[n][0] for n in names], fanout)
    want = collections.Counter()
    for k, n in enumerate(names):
        for (_, leaf, i, t), proof in zip(sorted(trees[n], key=lambda x: x[:2]), built[n][1], strict=True):
            tampered = i is not None and i % 3 == 0 and t is not None and t.lower() != t
            want[i, leaf, built[n][0], root, proof + upper[k], not tampered] += 1
    assert collections.Counter((r["id"], r["digest"], r["subroot"], r["root"], r["proof"].decode(), r["folded_root"] == r["root"]) for r in got) == want


def test_manifest_of_one_row_and_none(spark):
    df = spark.createDataFrame([(1, None, None)], "doc_id long, text string, lang string")
    r = merkle.folded(merkle.manifest(df, ["doc_id", "text"]), F.col("digest")).first()
    assert r["digest"] == r["subroot"] == r["root"] == r["folded_root"] == plain_leaf(1, None) and bytes(r["proof"]) == b""
    assert merkle.manifest(df.limit(0), ["doc_id", "text"]).count() == 0


def test_manifest_of_many_trees_and_a_hot_id(spark):
    """A third of all rows under one id, and a tree for each of the others."""
    df = spark.range(3_000).select(F.when(F.col("id") % 3 == 0, 1).otherwise(F.col("id")).alias("doc_id"), F.lit("t").alias("text"), F.when(F.col("id") % 3 != 0, F.col("id").cast("string")).alias("lang"))
    got = merkle.folded(merkle.manifest(df, ["doc_id", "text"]), F.col("digest"))
    assert got.where("folded_root = root").count() == 3_000 and got.agg(F.max("trees"), F.max("count")).first()[:] == (2_001, 1_000)


def plain_repeats(rows, size):
    least, texts = {}, [(i, WORD.findall(t or "")) for i, t in rows]
    for i, w in texts:
        for k in range(len(w) - size + 1):
            x = tuple(w[k : k + size])
            least[x] = min(least.get(x, 1 << 70), 1 << 63 if i is None else i)
    for i, w in texts:
        gone = {j for k in range(len(w) - size + 1) if least[tuple(w[k : k + size])] < (1 << 63 if i is None else i) for j in range(k, k + size)}
        yield i, len(w), len(gone), " ".join(x for j, x in enumerate(w) if j not in gone)


@pytest.mark.parametrize("seed", range(3))
def test_repeats(spark, monkeypatch, seed):
    monkeypatch.setattr(repeats, "BUCKET", 64)
    rng = random.Random(seed)
    passages = [" ".join(rng.choice("abcdefgh") + rng.choice("xyzéß") for _ in range(rng.randint(4, 40))) for _ in range(6)]
    body = lambda: rng.choice([" ", "\n", "\x0b ", "  "]).join(rng.choice(passages) if rng.random() < 0.3 else f"w{rng.randint(0, 30)}" for _ in range(rng.randint(0, 60)))
    rows = [(rng.choice([i, i, i, None, 3]), rng.choice([None, "", body(), body(), body()])) for i in range(150)]
    rows += [(i + 500, rows[i][1]) for i in range(30)] + [rows[40]] * 20
    df = named(spark.createDataFrame(rows, "doc_id long, text string").repartition(7))
    got = repeats.without_repeats(df, size=5, chunk_bytes=3_000).collect()
    assert all(s["start"] < s["end"] for r in got for s in r["spans"]) and all(a["end"] < b["start"] for r in got for a, b in zip(r["spans"], r["spans"][1:]))
    assert collections.Counter((r["id"], r["n_words"], sum(s["end"] - s["start"] for s in r["spans"]), r["kept"]) for r in got) == collections.Counter(plain_repeats(rows, 5))
    assert repeats.without_repeats(df.limit(0)).count() == 0


def test_repeats_of_long_texts_in_slices(spark, monkeypatch):
    """Slices of bytes and of words; one word is longer than a slice; a passage repeats within one text and is left there."""
    monkeypatch.setattr(repeats, "SLICE", 256)
    words = [f"word{i % 700}" for i in range(3_000)] + ["z" * 5_000]
    text = " ".join(words)
    got = {r["id"]: r for r in repeats.without_repeats(spark.createDataFrame([(1, text), (2, "new " + text + " end")], "doc_id long, text string")).collect()}
    assert got[1]["spans"] == [] and got[1]["kept"] == text
    assert got[2]["kept"] == "new end" and [tuple(s) for s in got[2]["spans"]] == [(1, 3_002)]


def test_packed_hashes_come_back():
    rng = np.random.default_rng(1)
    for n in (0, 1, 9, 1_000):
        h, i, s = np.sort(rng.integers(0, 2**64, n, np.uint64)), rng.integers(-(2**63), 2**63, n), rng.integers(0, 2, n).astype(bool)
        back = repeats.unpack(repeats.pack(h, i, s), n)
        assert all(np.array_equal(a, b) for a, b in zip((h, i, s), back, strict=True))


def test_word_hashes_tell_words_and_texts_apart():
    data, docs = repeats._texts(pa.chunked_array([["ab c", None, "", "ab"], ["c  ab\tc", "abc", " "]]))
    hashes, doc = repeats.word_hashes(data, docs)
    assert list(doc) == [0, 0, 3, 4, 4, 4, 5] and hashes[0] == hashes[2] == hashes[4] and hashes[1] == hashes[3] == hashes[5] and len({*hashes}) == 3


def plain_infill(i, text):
    h = hashlib.sha256(f"1:{'' if i is None else i}".encode()).hexdigest()
    h = [int(h[k : k + 8], 16) for k in (0, 8, 16, 24)]
    a, b = sorted((h[0] % (len(text) + 1), h[1] % (len(text) + 1)))
    if not text or any(m in text for m in ("<P>", "<S>", "<M>")) or h[2] % 100 >= 90:
        return len(text), "plain", None, None, text
    p, m, s = text[:a], text[a:b], text[b:]
    return (len(text), "spm", a, b - a, f"<S>{s}<P>{p}<M>{m}") if h[3] % 100 < 20 else (len(text), "psm", a, b - a, f"<P>{p}<S>{s}<M>{m}")


def test_infill(spark, monkeypatch):
    monkeypatch.setattr(infill, "BATCH_BYTES", 500)
    rng = random.Random(4)
    odd = ["", None, "a", "<", "<P", "P><S", "x<M>y", "<P>", "\r\n\x00  ", "é" * 700, "á" * 300, "👩‍👩‍👧" * 90, " " * 600, "a b " * 400 + "y" * 1_000 + "\n\n"]
    rows = [(i, rng.choice(odd) if i % 2 else "".join(rng.choice(["a", "é", "👍🏽", " ", "\n", "<", ">", "S", "M>"]) for _ in range(rng.randint(0, 900)))) for i in range(400)] + [(None, "null id"), (5, "again"), (5, "again")]
    got = infill.fill_in_middle(named(spark.createDataFrame(rows, "doc_id long, text string").repartition(3)))
    found = got.withColumn("back", infill.restored(F.col("output"), F.col("form"))).collect()
    assert collections.Counter((r["id"], r["back"], r["n"], r["form"], r["prefix_chars"], r["middle_chars"], r["output"]) for r in found) == collections.Counter((i, t or "", *plain_infill(i, t or "")) for i, t in rows)
    assert infill.fill_in_middle(got.limit(0).select(F.col("id").alias("doc_id"), F.lit("").alias("text"))).count() == 0


def test_remembered_pieces_are_bounded(monkeypatch):
    monkeypatch.setattr(infill, "REMEMBERED", 10)
    cutter = infill.Cutter()
    text = " ".join(f"w{i}" for i in range(500))
    assert cutter.cut(text, len(text), 7) == (len(text), [len(text), 7]) and len(cutter.known) <= 10


@pytest.mark.parametrize("name, kinds", [
    ("op11_merkle", "doc_id bigint leaf string subroot string root string proof_sha256 string folded_root string verified boolean"),
    ("op12_repeats", "doc_id bigint n_words bigint n_removed bigint kept_sha256 string"),
    ("op13_infill", "doc_id bigint n bigint form string prefix_chars bigint middle_chars bigint output_sha256 string restored_sha256 string"),
])
def test_columns(spark, name, kinds):
    assert " ".join(" ".join(x) for x in QUERIES[name](spark, SF).dtypes) == kinds
