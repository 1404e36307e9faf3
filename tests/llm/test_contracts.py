"""The registered queries on the smallest tables: names, types and rows against plain Python or SQL; hot keys; other names."""

import collections
import hashlib
import math
import os
import random
import re
import zlib

import duckdb
import pandas as pd
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from weir.llm import chat, language, mixing, pieces, quality, secrets, sharding, simhash, topk, urls
from weir.llm.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "documents embeddings pages conversations labels".split()
WORD = re.compile(r"[^\x20\x09-\x0D]+")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="no tables")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


@pytest.fixture(scope="module")
def texts(spark):
    return {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()}


def rows(frame):
    cols = sorted(frame.columns)
    text = lambda v: "" if v is None or v is pd.NA or v != v else f"{v:g}" if isinstance(v, float) else str(v)
    return cols, sorted(tuple(map(text, r)) for r in frame[cols].astype(object).itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_sql(spark, con, name):
    assert rows(QUERIES[name](spark, SF).toPandas()) == rows(con.execute(ORACLES[name]).df())


def test_op1(spark, texts):
    got = QUERIES["op1_secrets"](spark, SF)
    assert got.dtypes[:6] == [("doc_id", "bigint"), ("n_assign", "bigint"), ("n_access", "bigint"), ("n_hex", "bigint"), ("base_sha256", "string"), ("spans", "string")]
    kinds = [("assign", r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", 2, 12), ("access", "AKIA[A-Z0-9]+", 0, 18), ("hex", "[0-9a-f]+", 0, 16)]
    table = secrets.trained(spark.read.parquet(f"{SF}/documents.parquet"))
    for r in got.collect():
        t = texts[r["doc_id"]] or ""
        base = sorted((m.start(), k, n, m.end()) for k, (n, p, g, least) in enumerate(kinds) for m in re.finditer(p, t) if len(m.group(g)) >= least)
        more = [(m.start(), 3, "markov", m.end()) for m in re.finditer(r"[A-Za-z0-9+/_-]{20,}", t) if not any(a < m.end() and m.start() < e for a, _, _, e in base)]
        more = [x for x in more if secrets.score(t[x[0] : x[3]], table) >= secrets.MARGIN]
        join = lambda spans: ",".join(f"{n}:{a}:{e}" for a, _, n, e in spans)
        assert r["base_sha256"] == hashlib.sha256(join(base).encode()).hexdigest() and r["spans"] == join(sorted(base + more))
        assert [r["n_assign"], r["n_access"], r["n_hex"]] == [sum(k == n for _, _, n, _ in base) for k in ("assign", "access", "hex")]


def test_markov_against_plain_python(spark):
    """Random strings that no pattern names, among ordinary names; also thousands of matches in one text."""
    rng = random.Random(21)
    noise, plain = secrets.samples(300, seed=5)
    texts = [" ".join(rng.sample([*noise, *plain], 8)) for _ in range(60)] + [" x ".join(noise * 12 + plain * 12), "token=aaaabbbbcccc " * 3_000 + noise[0]]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    for r in secrets.scan(df).collect():
        t = texts[r["doc_id"]]
        base = [(m.start(), m.end()) for n, p, g, least in secrets.BASE for m in re.finditer(p, t) if len(m.group(g)) >= least]
        touched = set(i for a, e in base for i in range(a, e))
        want = [(m.start(), m.end()) for m in re.finditer(secrets.CANDIDATE, t) if secrets.score(m.group()) >= secrets.MARGIN and touched.isdisjoint(range(m.start(), m.end()))]
        assert [(s["start"], s["end"]) for s in r["found"] if s["kind"] == "markov"] == want
    hits = collections.Counter((x in noise, any(s["kind"] != "" for s in r["found"])) for x, r in zip([*noise, *plain], secrets.scan(spark.createDataFrame(list(enumerate([*noise, *plain])), "doc_id long, text string")).orderBy("doc_id").collect(), strict=True) if len(x) >= 20)
    precision, recall = hits[True, True] / (hits[True, True] + hits[False, True]), hits[True, True] / (hits[True, True] + hits[True, False])
    assert precision >= 0.98 and recall >= 0.98


def test_op2(spark, texts):
    got = QUERIES["op2_pieces"](spark, SF)
    assert got.dtypes == [("doc_id", "bigint"), ("ids", "array<int>"), ("n_ids", "bigint"), ("round_trip", "boolean")]
    assert all(r["round_trip"] and r["n_ids"] == len(r["ids"] or []) for r in got.collect()) and got.count() == len(texts)


def test_op3(spark):
    got = QUERIES["op3_topk"](spark, SF)
    assert got.dtypes[:4] == [("query_id", "bigint"), ("rank", "int"), ("vec_id", "bigint"), ("score", "bigint")]
    assert got.groupBy("query_id").count().where("count <> 20").count() == 0


def test_op5(spark, texts):
    got = QUERIES["op5_language"](spark, SF)
    assert got.dtypes[:4] == [("doc_id", "bigint"), ("held_out", "boolean"), ("lang_pred", "string"), ("score", "double")]
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    found = got.collect()
    assert len(found) == len(texts) and all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) and 0 <= r["score"] <= 1 for r in found)
    held = [r for r in found if r["held_out"] and lang[r["doc_id"]] is not None and re.search(r"[^\W\d_]", texts[r["doc_id"]] or "")]
    assert sum(r["lang_pred"] == lang[r["doc_id"]] for r in held) >= 0.95 * len(held)


def brute_shards(got, texts):
    """What op6 promises, from its rows and the texts."""
    shards = collections.defaultdict(list)
    for r in got:
        t = (texts[r["doc_id"]] or "").encode()
        assert r["size"] == len(t) + 1 and r["text_crc32"] == zlib.crc32(t)
        shards[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in shards.values())
    return collections.Counter({k: sum(r["size"] for r in got if r["shard"] == k) for k in shards})


def test_op6(spark, texts):
    got = QUERIES["op6_sharding"](spark, SF)
    assert got.dtypes[:7] == [("doc_id", "bigint"), ("size", "bigint"), ("text_crc32", "bigint"), ("law", "string"), ("shard", "int"), ("slot", "bigint"), ("grown_shard", "int")]
    found = got.collect()
    sizes = brute_shards(found, texts)
    assert len(found) == len(texts) and set(sizes) <= set(range(8)) and {r["law"] for r in found} == {"bytes"}
    largest = max(r["size"] for r in found)
    assert max(sizes.values()) - min(sizes.values()) <= 2 * max(largest, sum(sizes.values()) * sharding.WHOLE_GROUP / 8)
    same = collections.defaultdict(set)
    for r in found:
        same[texts[r["doc_id"]]].add(r["shard"])
    assert all(len(s) == 1 for s in same.values())


def test_op7_against_union_find(spark):
    """Generated redirect graphs with rules, loops, nulls and aliases that no page has."""
    rng = random.Random(3)
    hosts = ["a.net", "example.net", "x.example.com", "b.org", "c.io", "d.io", "EXAMPLE.com"]
    page = lambda: f"http{rng.choice(['', 's'])}://{rng.choice(hosts)}{rng.choice(['', '/', '/en/', '/de/x', '/fr/y', '/z'])}{rng.choice(['', '', '?q=1'])}{rng.choice(['', '#t'])}"
    rows_ = []
    for i in range(250):
        to = page()
        tag = rng.choice(["", "", f'<link href="{to}" rel="canonical">', f"<LINK rel=canonical href='{to}'>", f'<meta http-equiv="refresh" content="0; url={to}">', '<link rel="canonical" href="/de/x">', "<link rel='x' href='/q'>"])
        rows_.append((i, rng.choice([page(), page(), page(), None, "no scheme"]), rng.choice([f"<html>{tag}</html>", tag, None])))
    rows_.append(rows_[7])

    def parts(url):
        m = re.match(r"(?s)^.*?://([^/?#]*)([^?#]*)", url or "")
        return ("".join(c.lower() if "A" <= c <= "Z" else c for c in m[1]), m[2]) if m else ("", "")

    def rule(url):
        h, p = parts(url)
        fit = [(len(host + path), what, host + path) for what, host, path in urls.RULES if (h == host or h.endswith("." + host)) and p.startswith(path)]
        return max(fit)[1:] if fit else (None, None)

    def key(url):
        h, p = parts(url)
        q = re.match(r"(?s)^[^?#]*(\?[^#]*)", url)
        return h, p or "/", q[1] if q else ""

    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    seen = collections.defaultdict(set)
    for _, url, page_html in rows_:
        if not url or "://" not in url or not page_html:
            continue
        m = re.search(r"""url=([^"'>\s]+)""", page_html) if "refresh" in page_html else re.search(r"""href=["']?([^"'\s>]+)""", page_html) if "canonical" in page_html else None
        if m:
            to = m[1] if "://" in m[1] else re.match(r"^(.*?://[^/?#]*)", url)[1] + m[1]
            seen[key(url)].add(url)
            seen[key(to)].add(to)
            a, b = find(key(url)), find(key(to))
            root[a] = b
    verdicts = collections.defaultdict(set)
    for k, us in seen.items():
        verdicts[find(k)] |= {rule(u)[0] for u in us} - {None}
    want = []
    for i, url, _ in rows_:
        what, name = rule(url)
        told = verdicts[find(key(url))] if url and "://" in url and key(url) in root else set()
        want.append((i, *parts(url), name, what or ("allow" if "allow" in told or not told else "block")))
    got = urls.judge(spark.createDataFrame(rows_, "page_id long, url string, html string"))
    assert got.select("page_id", "host", "path", "rule", "verdict").dtypes == [("page_id", "bigint"), *[(c, "string") for c in ("host", "path", "rule", "verdict")]]
    text = lambda x: tuple(map(str, x))
    assert sorted(text((r["page_id"], r["host"], r["path"], r["rule"], r["verdict"])) for r in got.collect()) == sorted(map(text, want))
    assert {r["by"] for r in got.collect()} == {"rule", "alias", "default"} and urls.judge(got.limit(0).select("page_id", F.lit("").alias("url"), F.lit("").alias("html"))).count() == 0


def test_op9(spark, texts):
    got = QUERIES["op9_simhash"](spark, SF)
    assert got.dtypes == [("doc_id", "bigint"), ("fingerprint", "string"), ("component_id", "bigint")]
    found = {r["doc_id"]: r for r in got.collect()}
    assert all(found[i]["fingerprint"] == f"{simhash.fingerprint(t):016x}" for i, t in texts.items())
    fps = {i: int(r["fingerprint"], 16) for i, r in found.items()}
    for i in sorted(fps):
        least, todo = {i}, [i]
        while todo:
            x = todo.pop()
            more = [j for j in fps if j not in least and (fps[x] ^ fps[j]).bit_count() <= 2]
            least |= set(more)
            todo += more
        assert found[i]["component_id"] == min(least)


def test_op10(spark, texts):
    got = QUERIES["op10_quality"](spark, SF)
    assert got.dtypes[:8] == [("doc_id", "bigint"), *[(c, "bigint") for c in ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")], ("base_failed", "boolean"), ("kept", "boolean")]
    docs = spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text")
    rules = quality.fit(docs, spark.read.parquet(f"{SF}/labels.parquet"))
    for r in got.collect():
        t = texts[r["doc_id"]] or ""
        w = WORD.findall(t)
        windows = collections.Counter(tuple(w[i : i + 3]) for i in range(len(w) - 2))
        again = {j for i in range(len(w) - 2) if windows[tuple(w[i : i + 3])] > 1 for j in (i, i + 1, i + 2)}
        lines = [x for x in t.split("\n") if WORD.search(x)]
        n = dict(n_words=len(w), word_chars=sum(map(len, w)), n_symbols=len(re.findall(r"[#*$%&|<>]", t)), n_dup_lines=len(lines) - len(set(lines)), n_repeat_words=len(again))
        assert {k: r[k] for k in n} == n
        failed = n["n_words"] < 50 or 100 * n["n_repeat_words"] > 50 * n["n_words"]
        share = lambda a, b: a / b if b else 0.0
        row = n | {"mean_word": share(n["word_chars"], n["n_words"]), "symbol_share": share(n["n_symbols"], n["word_chars"]), "dup_line_share": share(n["n_dup_lines"], len(lines)), "repeat_share": share(n["n_repeat_words"], n["n_words"])}
        row |= {"upper_share": share(len(re.findall("[A-Z]", t)), n["word_chars"]), "digit_share": share(len(re.findall("[0-9]", t)), n["word_chars"])}
        bad = any(all(c.holds(row) for c in rule) for rule in rules)
        assert r["base_failed"] == failed and r["kept"] == (not failed and not bad)


def test_hot_keys_of_mixing(spark):
    """A source of many texts of low weight, and documents without an id: no range holds many of them."""
    df = spark.range(20_000).select(F.when(F.col("id") % 2 == 0, F.col("id")).alias("doc_id"), F.concat(F.lit("1 2 3 "), (F.col("id") % 7000).cast("string")).alias("text"), F.lit("one").alias("source"))
    rows_, sources = mixing.plan(df, mixing.weights_by_name)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # small ranges aren't put together
    try:
        placed = mixing.placed(rows_, sources)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert placed.count() == 20_000 and placed.groupBy("range").count().agg(F.max("count")).first()[0] <= 2 * 20_000 / 4
    assert mixing.taken(rows_, sources).agg(F.sum("taken")).first()[0] == round(sources.first()["target"])


def test_hot_key_of_sharding(spark, monkeypatch):
    monkeypatch.setattr(sharding, "UNIT_ROWS", 200)
    df = spark.range(6_000).select(F.when(F.col("id") % 3 == 0, F.col("id")).alias("doc_id"), F.when(F.col("id") % 6 != 0, "").otherwise(F.concat(F.lit("text "), F.col("id").cast("string"))).alias("text"))
    got = sharding.shard(df).collect()
    assert max(collections.Counter(r["unit"] for r in got).values()) <= 2 * 200
    slots = collections.defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values()) and len(got) == 6_000


def test_hot_conversation(spark):
    """A conversation that holds most turns, all at one place; its repeats and rows without an id."""
    hot = [(1, None, "u", f"t{i % 900}") for i in range(1_800)]
    other = [(2, i, "u", f"x{i}") for i in range(5)] + [(3, i, "u", f"x{i}") for i in range(3)] + [(None, 1, "u", "lone")] * 40 + [(None, 1, "u", f"lone{i}") for i in range(20)]
    df = spark.createDataFrame(hot + other, "conv_id long, turn long, role string, text string")
    got = chat.collapse(df).collect()
    assert sorted((r["conv_id"] or 0, r["n_turns"]) for r in got) == sorted([(1, 900), (2, 5), *[(0, 1)] * 21])
    turns = chat.rolled(chat._turns(df, "conv_id", "turn", "role", "text"))
    assert turns.where("c = '=1'").count() == 900


CLASH = ["score", "lang_pred", "last", "a.b", "__found", "found", "__text", "__words", "node", "root", "k", "range", "copy", "all", "id", "row", "n", "size", "c0", "__label", "kind"]


def test_columns_of_any_name(spark):
    rng = random.Random(2)
    some = [" ".join(rng.choice("alpha beta gamma delta epsilon zeta eta theta iota kappa".split()) for _ in range(60)) for _ in range(12)]
    base = spark.createDataFrame([(i, t, "en", f"s{i % 3}", len(t or "")) for i, t in enumerate([*some, None, "", some[0]])], "doc_id long, text string, lang string, source string, n_chars long")
    df = base.select("*", *[F.lit(1).alias(c) for c in CLASH])
    for name, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, df, SF)
        assert out.columns == df.columns, name
        assert out.count() > 0
    assert corpus_pipeline.STAGES[-1][1](spark, df, SF).count() == df.count()
    assert set(df.columns) - set(quality.FEATURES) <= set(quality.judge(df, []).columns) and pieces.encode(df, pieces.model_of(spark)).columns == [*df.columns, "ids"]
    assert secrets.scan(df, out="more").columns == [*df.columns, "more"]
    vectors = spark.createDataFrame([(20 * i, [float(i), 1.0]) for i in range(4)], "vec_id long, embedding array<float>").select("*", *[F.lit(1).alias(c) for c in CLASH])
    assert topk.nearest(vectors, 2).count() == 8
    turns = spark.createDataFrame([(1, 0, "u", "x")], "conv_id long, turn long, role string, text string").select("*", *[F.lit(1).alias(c) for c in CLASH])
    assert chat.collapse(turns).count() == 1 and sharding.shard(df).count() == df.count() and mixing.mix(df, mixing.weights_by_name).columns == df.columns
    assert simhash.near_components(df).count() == df.count()
    assert language.identify(df, language.train(df)).columns == ["doc_id", "lang_pred", "score"]
    pages = spark.createDataFrame([(1, "http://a.net/", None)], "page_id long, url string, html string").select("*", *[F.lit(1).alias(c) for c in CLASH])
    assert urls.judge(pages).first()["verdict"] == "block"


def test_empty_tables(spark):
    none = spark.createDataFrame([], "doc_id long, text string, lang string, source string, n_chars long")
    for name, stage in corpus_pipeline.STAGES:
        assert stage(spark, none, SF).count() == 0, name
    assert sharding.shard(none).count() == 0 and quality.judge(none, []).count() == 0 and simhash.near_components(none).count() == 0


def test_very_long_texts(spark):
    """Tens of thousands of words, lines and matches in one text."""
    long = "\n".join(f"line {i % 500} token=abcdefabcdef0123 {i:032x}" for i in range(4_000))
    df = spark.createDataFrame([(1, long)], "doc_id long, text string")
    found = secrets.scan(df).first()["found"]
    assert sum(s["kind"] == "assign" for s in found) == 4_000 and sum(s["kind"] == "hex" for s in found) >= 4_000
    assert "token=abc" not in secrets.redact(df).first()["text"]
    stats = quality.statistics(df).first()
    assert stats["n_words"] == 16_000 and stats["n_dup_lines"] == 0 and math.isclose(stats["symbol_share"], 0)
