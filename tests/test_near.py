"""Near duplicates of code: signatures, bands, hot bands and groups against comparisons of all pairs."""

import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from weir.functions import text
from weir.operators import near


def plain_tokens(x):
    return sorted(set(re.findall("[A-Za-z0-9_]+", re.sub(r"(?m)(#|//).*?$", "", x or "").lower())))


def plain_links(rows, least=0.8):
    sets = {}
    for i, x in sorted(rows):
        if t := frozenset(plain_tokens(x)):
            sets.setdefault(t, i)
    of = sorted((i, t) for t, i in sets.items())
    return {(i, j) for k, (i, s) in enumerate(of) for j, t in of[k + 1 :] if len(s & t) >= least * len(s | t)}


def plain_groups(rows, pairs):
    of = {}
    for i, x in sorted(rows):
        of.setdefault(frozenset(plain_tokens(x)) or i, []).append(i)
    root = {i: g[0] for g in of.values() for i in g}
    for _ in rows:
        before = dict(root)
        for a, b in pairs:
            low = min(root[a], root[b])
            for end in (root[a], root[b]):
                root = {i: low if r == end else r for i, r in root.items()}
        if root == before:
            return root
    return root


def texts(seed, n=120):
    """Programs of 40 to 90 words; copies with a share of the words changed, copies with other comments, and a common frame."""
    rng = random.Random(seed)
    frame = [f"frame{i}" for i in range(45)]
    made = []
    for _ in range(n):
        words = [f"w{rng.randint(0, 2_000)}" for _ in range(rng.randint(40, 90))]
        if rng.random() < 0.3:
            words = frame + words[:25]
        made.append(words)
        for _ in range(rng.randint(0, 3)):
            made.append([w if rng.random() > rng.choice([0.02, 0.1, 0.12, 0.2]) else f"n{rng.randint(0, 9_999)}" for w in words])
    rng.shuffle(made)
    rows = [(i, " ".join(w) + rng.choice(["", " // note", "\n# other"])) for i, w in enumerate(made)]
    return rows + [(len(rows) + k, x) for k, x in enumerate([None, "", "# only", "// notes", rows[3][1], rows[3][1].upper() + " # again"])]


@pytest.mark.parametrize("hot", [128, 4])
def test_links_against_all_pairs(spark, hot):
    """Recall over 0.95 is asked for; nothing false may come. With bands hot from 4 sets on, most pairs come by second bands."""
    rows = texts(1) + [(10_000 + i, x) for i, x in texts(2)]
    found = {(r["a"], r["b"]) for r in near.links(near.token_sets(spark.createDataFrame(rows, "doc_id long, text string"), "doc_id", F.col("text"))[0], hot=hot).collect()}
    want = plain_links(rows)
    assert found <= want and len(want) > 50
    assert len(found) >= 0.97 * len(want)


def test_one_large_group(spark, monkeypatch):
    """300 variants of one text, all alike: every band is hot. As a join all pairs are there; as groups they cost a star."""
    rng = random.Random(5)
    base = [f"w{i}" for i in range(100)]
    rows = [(i, " ".join(base[:k] + [f"x{i}"] + base[k + 1 :])) for i in range(300) for k in [rng.randint(0, 99)]]
    rows += [(1_000 + i, rows[0][1]) for i in range(500)] + [(5_000, "some other text")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    assert near.links(near.token_sets(df, "doc_id", F.col("text"))[0], hot=32).count() == 300 * 299 // 2
    looked, check = [], near.checked
    monkeypatch.setattr(near, "checked", lambda pairs, *a: looked.append(pairs.count()) or check(pairs, *a))
    got = near.groups(df, "doc_id", F.col("text"), hot=32).collect()
    assert len(got) == len(rows) and {(r["id"], r["group_id"]) for r in got} == {(i, 5_000 if i == 5_000 else 0) for i, _ in rows}
    assert sum(looked) < 10 * 300


def test_groups_and_odd_rows(spark):
    rows = texts(3, 40)
    df = spark.createDataFrame(rows, "doc_id long, text string").withColumns({c: F.lit(1) for c in ("node", "key", "band", "a", "tokens", "root")})
    for hot in (128, 3):
        found = near.groups(df.withColumnRenamed("doc_id", "my.id"), "my.id", F.col("text"), hot=hot).collect()
        got = {r["id"]: r["group_id"] for r in found}
        assert len(found) == len(rows)
        if hot == 128:
            assert got == plain_groups(rows, plain_links(rows))
    assert near.groups(spark.createDataFrame([], "doc_id long, text string"), "doc_id", F.col("text")).count() == 0


def test_components_of_long_paths(spark):
    n = 400
    order = random.Random(1).sample(range(n), n)
    edges = [(order[i], order[i + 1]) for i in range(n - 1)] + [(1_000, 1_001), (1_001, 1_000), (1_002, 1_002), (2_000 + 9, 2_000)]
    found = near.components(spark.createDataFrame(edges, "a long, b long")).collect()
    got = {r["node"]: r["root"] for r in found}
    assert len(got) == len(found)
    assert got == {i: 0 for i in range(n)} | {1_000: 1_000, 1_001: 1_000, 2_000: 2_000, 2_009: 2_000}


def test_signature(spark):
    rows = [(0, "alpha beta"), (1, None), (2, ""), (3, "a a a"), (4, " ".join(f"t{i}" for i in range(3_000)))]
    got = {r["doc_id"]: r["s"] for r in spark.createDataFrame(rows, "doc_id long, text string").select("doc_id", text.minhash(text.near_tokens(F.col("text")), 40).alias("s")).collect()}
    for i, x in rows:
        h = [int(hashlib.md5(t.encode()).hexdigest()[:15], 16) % (2**31 - 1) for t in plain_tokens(x)]
        assert got[i] == ([min((a * v + b) % (2**31 - 1) for v in h) for a, b in map(text.permutation, range(40))] if h else None)


def test_token_sets_in_their_order(spark):
    rows = [(0, None), (1, ""), (2, "b a b A a_1"), (3, "x"), (4, "# only a comment"), *((5 + i, " ".join(f"w{(i * j) % 97}" for j in range(i * 40))) for i in range(30))]
    df = spark.createDataFrame(rows, "doc_id long, text string").coalesce(1)
    found = text.near_tokens(F.col("text"))
    both = df.select("doc_id", text.token_set(found).alias("got"), F.array_sort(F.transform(F.array_distinct(found), text.token_hash)).alias("want"))
    assert all(r["got"] == r["want"] for r in both.collect()) and both.where("got is null").count() == 1
    assert both.limit(0).count() == 0 and both.where("got is null").select("got").collect()[0][0] is None


def test_permuted_without_a_division():
    rng = np.random.default_rng(5)
    flat = np.concatenate([rng.integers(0, text.PRIME, 1000), [0, 1, text.PRIME - 1]])
    for a, b in [*map(text.permutation, range(60)), (1, 0), (text.PRIME - 1, text.PRIME - 1)]:
        assert (text._permuted(flat, a, b) == (a * flat + b) % text.PRIME).all()
