"""Batches by count or bytes, numbered by runs of rows."""

import random

import pytest
from pyspark.sql import functions as F

from weir.plans import ingest
from weir.plans.queries import QUERIES


def plain(sizes, batch_size, limit):
    batch = n = held = 0
    for x in sizes:
        yield batch
        n, held = n + 1, held + (x or 0)
        if n >= batch_size or held >= limit:
            batch, n, held = batch + 1, 0, 0


@pytest.mark.parametrize("batch_size,limit", [(7, 300), (1, 50), (40, 1), (5, 10**9), (64, 2_000)])
def test_runs(spark, monkeypatch, batch_size, limit):
    """Batches go on from run to run, as a pass over all rows says."""
    monkeypatch.setattr(ingest, "RUN", 1)
    monkeypatch.setattr(ingest, "SHARE", 3)
    rng = random.Random(batch_size)
    sizes = [rng.choice([None, 0, 1, 40, 90, 500]) for _ in range(501 if batch_size > 1 else 100)]
    df = spark.createDataFrame([(i * 3, x) for i, x in enumerate(sizes)], "pos long, bytes long").repartition(5)
    got = [r["batch"] for r in ingest.flushes(df, batch_size, limit / 1e6).orderBy("pos").collect()]
    assert got == list(plain(sizes, batch_size, limit))


def test_no_task_reads_all(spark, monkeypatch):
    """More than one task numbers rows, and none but tables of runs goes through one; no rows give none."""
    monkeypatch.setattr(ingest, "RUN", 1)
    monkeypatch.setattr(ingest, "SHARE", 3)
    made = ingest.flushes(spark.range(0, 200, 1, 4).select(F.col("id").alias("pos"), F.lit(1).cast("long").alias("bytes")), 3)
    assert "Repartition 1, false" not in made._jdf.queryExecution().optimizedPlan().toString()
    assert made.groupBy("batch").count().where("count <> 3").count() == 1 and made.columns == ["pos", "bytes", "batch"]
    assert ingest.flushes(made.drop("batch").limit(0), 3).count() == 0
