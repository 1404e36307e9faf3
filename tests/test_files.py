"""How many tasks write, and how many files there are."""

import json

from pyspark.sql import functions as F

from weir import schema
from weir.plans.queries import QUERIES
from weir.sinks import catalog as sink

SF = "/root/testdata/sf0.001"


def test_one_file_by_many_tasks(spark, tmp_path):
    """A catalog of one file has the lines of all partitions, each written by its own task."""
    df = spark.range(0, 500, 1, 7).select(*[(F.col("id").cast("string") if f.name in ("id", "title") else F.spark_partition_id().cast("string") if f.name == "category" else F.lit(None).cast(f.dataType)).alias(f.name) for f in schema.CHALLENGE])
    sink.write_jsonl(df, str(tmp_path / "d/one.jsonl"), single=True)
    rows = [json.loads(x) for x in (tmp_path / "d/one.jsonl").read_text().splitlines()]
    assert sorted(int(r["id"]) for r in rows) == list(range(500)) and len({r["category"] for r in rows}) == 7
    assert [p.name for p in (tmp_path / "d").iterdir()] == ["one.jsonl"]
    sink.write_jsonl(df.limit(0), str(tmp_path / "d/none.jsonl"), single=True)
    assert (tmp_path / "d/none.jsonl").read_text() == ""


def test_search_pages_share_files(spark):
    """Fifteen pages and more are no fifteen files."""
    files = QUERIES["SRC-14"](spark, SF).inputFiles()
    assert len(files) <= 3
