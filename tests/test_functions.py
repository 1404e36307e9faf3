import pytest
from pyspark.sql import functions as F

from weir.functions import html, license, paths, text


def one(spark, col):
    return spark.range(1).select(col.alias("x")).first()["x"]


@pytest.mark.parametrize(
    ("event", "year", "title", "category", "expected"),
    [
        ("FCSC 2026", 2026, "10 Fast Fishers", "web", "c5f343bdf7fefa19b9700148"),
        ("HITCON CTF", 2021, "Baby Pwn", "pwn", "76802fc16c5659bf77cace18"),
        ("corCTF 2022", 2022, "zigzag", "pwn", "fa1b01efece7cc353946bb98"),
        ("OWASP Juice Shop", None, "API-only XSS", "web", "cc08a24b8e80efe4ac5b80be"),
        ("Some CTF", 2024, "🎉🎉", "web", "f5cb42340508fdc578cd8a80"),
        ("Some CTF", 2024, "你好世界", "web", "1c5d8bb901906daa79266dc5"),
    ],
)
def test_ids(spark, event, year, title, category, expected):
    assert one(spark, text.challenge_id(F.lit(event), F.lit(year).cast("int"), F.lit(title), F.lit(category))) == expected


def test_slugs(spark):
    got = {x: one(spark, text.slug(F.lit(x))) for x in ["HITCON CTF", "baby_pwn", "À une vache près", "ﬁne ①", "--x--", "!!", "नमस्ते"]}
    assert got["HITCON CTF"] == "hitcon-ctf" and got["baby_pwn"] == "baby-pwn" and got["À une vache près"] == "à-une-vache-près"
    assert got["ﬁne ①"] == "fine-1" and got["--x--"] == "x" and got["!!"] == ""


def test_fingerprint(spark):
    file = lambda p, sha, oid=None, size=1: F.struct(F.lit(p).alias("path"), F.lit(sha).cast("string").alias("sha256"), F.lit(oid).cast("string").alias("lfs_oid"), F.lit(size).alias("size"), text.is_source(F.lit(p)).alias("is_source"))
    fp = lambda *fs: one(spark, text.fingerprint(F.array(*fs)))
    assert fp(file("chal.py", "a" * 64)) == "20e69ad737ad2ea23c5bf4085550dfb766f27613a73fc80aedbf5b8ad2d3b531"
    assert fp(file("Dockerfile", "d" * 64), file("disk.img", "", "oid-aaaa")) == "bbc1877a0fc0788f179cfebbe5019f36e90d4f844578840ec18d5a5389199769"
    assert fp(file("chal.py", "a" * 64), file("README.md", "b" * 64), file("solve.py", "c" * 64)) == fp(file("chal.py", "a" * 64))
    assert fp(file("a", "1"), file("b", "2")) == fp(file("b", "2"), file("a", "1")) and fp(file("README", "1")) is None
    assert fp(file("a", None, None, 7)) != fp(file("a", None, None, 8))


def test_licenses(spark):
    found = lambda t: one(spark, license.from_text(F.lit(t)))
    assert found("Apache License\nVersion 2.0")["spdx_id"] == "Apache-2.0" and found("Apache License\nVersion 2.0")["redistributable"]
    assert found("Released under the MIT License.")["note"] == license.UNRECOGNIZED and not found("  ")["note"]
    assert found("x" * 4001 + "CC0 1.0 Universal")["spdx_id"] is None
    assert one(spark, license.from_spdx(F.lit("noassertion"), note=F.lit("n"))).asDict() | {} == {"spdx_id": None, "name": None, "confidence": 0.0, "redistributable": False, "source_file": None, "note": "n"}


def test_derive(spark):
    def of(path, name=None, category=None):
        df = spark.range(1).select(F.split(F.lit(path), "/").alias("s"), F.lit(name).cast("string").alias("n"), F.lit(category).cast("string").alias("c"))
        return tuple(paths.derive(df, "s", "n", "c").drop("s", "n", "c").first())

    assert of("CTFs/HITCON/2021/Quals/pwn/baby") == ("baby", "HITCON", "Quals", 2021, "pwn")
    assert of("2017/finals/2017-finals-crypto-bender") == ("2017-finals-crypto-bender", None, "finals", 2017, "crypto")
    assert of("web/x", "Named", "Forensics") == ("Named", None, None, None, "Forensics")
    assert of("webhook-abuse") == ("webhook-abuse", None, None, None, None)


PAGE = """<html><head><meta property="og:title" content="Tea Pot"><meta name="keywords" content="web, php"></head><body><h1>Other</h1>
<a class="badge x" href="/c/web/">web</a><a class="badge" href="/t/php">PHP</a><a class="badge" href="/e/cup2024">CUP 2024</a>
<use href="#star-fill"/><use href="#star-fill"/><div class="markdown"><h2>Head</h2><p>One <b>two</b></p></div>
<ul class="list-file"><li><a href="/f/compose.public.yml" download="docker-compose.yml">x</a><li><a href="/f/a.py">a.py</a></ul>
<div><img class="avatar"><span class="font-monospace">amy</span></div><a href="/w/writeups/1/">w</a><a href="/w/writeups/1/">w</a></body></html>"""


def test_challenge_page(spark):
    from weir.sources.records import page_records

    pages = spark.createDataFrame([("https://h.org/en/challenges/web/cup2024-tea/", PAGE), ("https://h.org/x", None)], "url string, html string")
    records, failures = page_records(pages)
    r = records.where("title = 'Tea Pot'").first()
    assert (r["event_name"], r["year"], r["raw_category"], r["tags"], r["difficulty"], r["description"]) == ("CUP 2024", 2024, "web", ["php"], "2/5", "Onetwo")
    assert [w["url"] for w in r["writeups"]] == ["https://h.org/w/writeups/1/"] and r["source"]["license"]["spdx_id"] == "etalab-2.0"
    assert html.challenge_page(PAGE, "https://h.org/p/")["files"][0] == {"url": "https://h.org/f/compose.public.yml", "name": "docker-compose.yml"}
    assert failures.count() == 0


def test_tasks(spark):
    from weir.sources.records import API_EVENT, task_records

    table = '<table class="table table-striped"><tr><th>n</th></tr><tr><td><a href="/task/5">five</a></td><td>50</td><td><span class="label">pwn</span></td><td><a href="/task/5">2</a></td></tr></table>'
    listed = '<table><tr><td><a href="/writeup/7">r</a></td><td>4.0</td><td><a href="/team/1">T</a></td></tr><tr><td><a href="/writeup/8">r</a></td><td>not rated</td></tr></table>'
    inline, away = '<div class="well" id="id_description">Body</div>', '<div class="well">Original writeup (<a href="https://GitHub.com/x">u</a>)</div>'
    df = lambda rows, ddl: spark.createDataFrame(rows, ddl)
    events = df([(1, 2, "Cup", "2022-08-05T00:00:00+00:00", None, 1.0, "J", "", ""), (9, 9, None, "bad", None, None, None, None, None)], API_EVENT)
    got = task_records(events, df([(1, table)], "event_id long, html string"), df([(5, listed)], "task_id long, html string"), df([(7, inline), (8, away)], "writeup_id long, html string")).collect()
    assert len(got) == 1 and (got[0]["title"], got[0]["points"], got[0]["year"], got[0]["raw_category"]) == ("five", 50, 2022, "pwn")
    a, b = got[0]["writeups"]
    assert (a["text"], a["is_inline"], a["rating"], a["author"], a["origin"]) == ("Body", True, 4.0, "T", "ctftime")
    assert (b["url"], b["origin"], b["is_inline"], b["rating"]) == ("https://GitHub.com/x", "github", False, None)


def test_signatures_have_all_permutations(spark):
    from weir.plans import queries

    got = [r["signature"] for r in queries.agg_15(spark, "/root/testdata/sf0.001").collect()]
    assert {len(x) for x in got if x is not None} == {128} and any(len(set(x)) > 100 for x in got if x is not None)
