import json
import socket

import pytest
from pyspark.sql import functions as F

from weir import schema
from weir.acquire import client
from weir.operators import discovery
from weir.plans import ingest
from weir.streaming import mirror, paging


def test_mirror_stream(spark, tmp_path):
    """Batches are published before they are ok; a failed publication fails its batch alone; a rerun takes only the rest."""
    (tmp_path / "in").mkdir()
    for i in range(3):
        (tmp_path / f"in/{i}.json").write_text(json.dumps({"repo": f"r/{i}", "path": "x"}) + "\n")
    published, order = [], []

    def stage(batch):
        results = batch.select("repo", F.lit("c").alias("commit_sha"), F.lit(1).alias("n_challenges"), F.lit(1).alias("n_files"), F.lit(5).cast("long").alias("bytes"), F.lit("staged").alias("status"), F.lit(None).cast("string").alias("error"))
        challenges = batch.select(*[(F.col("repo") if f.name in ("id", "title") else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.CHALLENGE])
        return results, challenges

    def publish(challenges, batch_id):
        order.append(batch_id)
        if batch_id == 1 and len(order) < 3:
            raise OSError("down")
        published.extend(r["id"] for r in challenges.collect())

    run = lambda check: mirror.mirror(spark, str(tmp_path / "in"), stage, publish, str(tmp_path / "manifest"), str(tmp_path / "catalog"), str(tmp_path / check), files_per_batch=1)
    run("check")
    seen = {r["repo"]: r["status"] for r in ingest.read_manifest(spark, str(tmp_path / "manifest")).collect()}
    assert sorted(seen.values()) == ["failed", "ok", "ok"] and {r for r, s in seen.items() if s == "ok"} == set(published)
    run("check2")  # a new checkpoint: the manifest alone says what is left
    assert sorted(published) == ["r/0", "r/1", "r/2"]


def test_event_feed(spark, tmp_path):
    events = [{"id": i, "title": f"e{i}", "start": f"2024-01-0{1 + i // 2}T00:00:00+00:00"} for i in range(8)]
    (tmp_path / "f.json").write_text(json.dumps(events))
    q = paging.event_stream(spark, str(tmp_path / "f.json"), limit=3).writeStream.format("memory").queryName("feed").option("checkpointLocation", str(tmp_path / "c")).start()
    q.processAllAvailable()
    q.stop()
    assert sorted(r["id"] for r in spark.table("feed").collect()) == list(range(8))


def test_bisection():
    from datetime import date, timedelta

    days = {date(2020, 1, 1) + timedelta(d): 400 for d in range(10)} | {date(2020, 1, 5): 1500}

    def count(q):
        lo, hi = (date.fromisoformat(x) for x in q.split("created:")[1].split(" ")[0].split(".."))
        n = sum(c for d, c in days.items() if lo <= d <= hi)
        if "stars:" in q:
            a, b = map(int, q.split("stars:")[1].split(".."))
            n = sum(1 for s in range(1500) if a <= s <= b)
        return n

    leaves = list(discovery.date_leaves("q", count, date(2020, 1, 1), date(2020, 1, 10)))
    assert all(n <= 1000 and whole for _, n, whole in leaves) and sum(n for _, n, _ in leaves) == sum(days.values())
    assert [w for *_, w in discovery.star_leaves("created:2020-01-05..2020-01-05", lambda q: 1200 if q.endswith("stars:0..0") or "0..1" in q else 0, 0, 1)] == [False]


def test_limiter_and_retries():
    now = [0.0]
    limiter = client.RateLimiter(2, 1, 1, clock=lambda: now[0], sleep=lambda s: now.__setitem__(0, now[0] + s))
    assert limiter.acquire() == 0 and limiter.acquire() == pytest.approx(0.5)
    answers, slept = [(503, None), (429, None), (200, "x")], []
    assert client.retried(lambda: answers.pop(0), sleep=slept.append) == (200, "x") and slept == [2, 4]
    assert client.search_page(lambda: (500, {}, {}), sleep=slept.append) == (0, [])
    with pytest.raises(ValueError):
        client.search_page(lambda: (422, {}, {}), sleep=slept.append)
    assert client.search_wait({"Retry-After": "9"}, 0, 0) == 9 and client.search_wait({}, 10, 0) == 180


def test_guard():
    to = {"ok.org": ["93.184.216.34"], "in.org": ["10.0.0.1"], "v6.org": ["::ffff:127.0.0.1"], "two.org": ["93.184.216.34", "127.0.0.1"]}

    def resolve(host, port):
        if host not in to:
            raise socket.gaierror
        return to[host]

    assert client.check_url("https://ok.org/x", resolve)
    for bad in ("ftp://ok.org", "https://in.org", "http://v6.org", "http://two.org", "http://no.org", "http://"):
        with pytest.raises(client.UnsafeUrl):
            client.check_url(bad, resolve)
    routes = {"http://ok.org/": (302, {"Location": "http://in.org/"}, []), "http://ok.org/big": (200, {}, [b"x" * 9]), "http://ok.org/t": (200, {"Content-Type": "text/plain"}, [b"ab", b"c"])}
    get = routes.__getitem__
    assert client.safe_get("http://ok.org/t", get, resolve) == (200, b"abc", "text/plain")
    for bad in ("http://ok.org/", "http://ok.org/big"):
        with pytest.raises(client.UnsafeUrl):
            client.safe_get(bad, get, resolve, limit=8)


def test_download_and_publish(tmp_path):
    target = str(tmp_path / "f")
    assert not client.download([b"x"], target, declared=99, limit=10) and not client.download([b"xxx"], target, limit=2)
    with pytest.raises(OSError):
        client.download([b"ab"], target, declared=3)
    assert not list(tmp_path.iterdir()) and client.download([b"ab"], target, declared=2) and client.download([], target)
    assert client.publish(str(tmp_path), "d").startswith("dry run: 1 files, 2 bytes") and client.publish(str(tmp_path), "d", only=".jsonl").startswith("nothing")
    assert client.upload(lambda: "done", sleep=lambda s: None) == "done"
    with pytest.raises(RuntimeError):
        client.upload(lambda: 1 / 0, attempts=2, sleep=lambda s: None)


def test_clone():
    class Out:
        returncode, stdout, stderr = 0, "abc\n", ""

    calls = []
    path, sha = client.clone("a/b", "/tmp/nowhere-weir", run=lambda args, **k: calls.append((args, k)) or Out())
    assert path.endswith("a__b") and sha == "abc" and calls[0][0][:4] == ["git", "clone", "--depth", "1"] and calls[0][1]["env"]["GIT_LFS_SKIP_SMUDGE"] == "1"
    Out.returncode = 1
    with pytest.raises(client.MirrorError):
        client.clone("a/b", "/tmp/nowhere-weir", run=lambda args, **k: Out())
