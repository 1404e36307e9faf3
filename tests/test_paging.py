"""Pages of a recorded feed: the driver holds what tells where they begin, tasks read their rows."""

import json

from pyspark.sql import functions as F

from weir.streaming import paging


def test_the_driver_turns_pages_without_rows(spark, tmp_path, monkeypatch):
    """Pages of very many events leave the driver as runs of rows of row groups, each event once, and the same after a restart."""
    monkeypatch.setattr(paging, "GROUP", 1 << 16)
    start = F.date_format(F.timestamp_seconds(F.floor(F.col("id") * 7919 % 40_000 / 3)), "yyyy-MM-dd'T'HH:mm:ss'+00:00'")
    spark.range(40_000).select("id", F.sha2(F.col("id").cast("string"), 256).alias("title"), start.alias("start")).write.json(str(tmp_path / "feed"))
    folder = paging.sorted_feed(spark, str(tmp_path / "feed"))
    reader, at, got, pages = paging.RecordedPages({"path": folder.removeprefix("file:"), "limit": "15000"}), None, [], 0
    at = reader.initialOffset()
    while not at["done"]:
        rows, then = reader.read(at)
        rows = list(rows)
        assert rows == list(paging.RecordedPages({"path": reader.path, "limit": "15000"}).readBetweenOffsets(at, then)) and len(rows) < 400
        got, at, pages = got + rows, then, pages + 1
    assert pages == 3 and sum(last - first for *_, first, last in got) == 40_000 and len(json.dumps(at)) < 200
    q = paging.event_stream(spark, str(tmp_path / "feed"), 15_000).writeStream.format("parquet").option("checkpointLocation", str(tmp_path / "c")).start(str(tmp_path / "out"))
    q.processAllAvailable()
    q.stop()
    seen = spark.read.parquet(str(tmp_path / "out")).agg(F.count("*").alias("n"), F.count_distinct("id").alias("ids"), F.count_distinct("title").alias("titles")).first()
    assert tuple(seen) == (40_000, 40_000, 40_000)


def test_odd_feeds(spark, tmp_path):
    """Events without a time, with repeated ids and many of one second, and feeds that hold none."""
    rows = [{"id": i, "start": "2024-01-01T00:00:00+00:00" if 2 <= i < 4 else f"2024-01-0{1 + i}T00:00:00Z" if i < 8 else None} for i in range(10)] + [{"id": 1, "start": "2024-01-09T00:00:00Z"}]
    (tmp_path / "f.json").write_text(json.dumps(rows))
    (tmp_path / "none.json").write_text("[]")
    for name, want in (("f.json", list(range(8))), ("none.json", [])):
        q = paging.event_stream(spark, str(tmp_path / name), 4).writeStream.format("memory").queryName(f"odd_{name[:-5]}").option("checkpointLocation", str(tmp_path / f"c-{name}")).start()
        q.processAllAvailable()
        q.stop()
        assert sorted(r["id"] for r in spark.table(f"odd_{name[:-5]}").collect()) == want
