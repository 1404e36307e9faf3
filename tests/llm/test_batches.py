"""Whole texts reach Python in batches of bounded bytes, and the rows are the same however they are cut."""

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from weir.llm import language, pieces, simhash
from weir.llm.shared import _BATCH, BATCH_BYTES


@pytest.fixture(autouse=True)
def unset(spark):
    spark.conf.unset(_BATCH)
    yield
    spark.conf.unset(_BATCH)


def _texts(spark, n):
    return spark.range(0, n, 1, 1).select(F.col("id").alias("doc_id"), F.repeat(F.concat(F.lit("some words of row "), "id", F.lit(" ")), 120).alias("text"))


def test_a_batch_of_whole_texts_is_bounded(spark):
    held = pieces._by_rows(_texts(spark, 4_000), "text", [("held", "long")], lambda col: [pa.array([col.buffers()[2].size] * len(col))])
    rows, most, all_ = held.agg(F.count("*"), F.max("held"), F.sum(F.length("text"))).first()
    assert rows == 4_000 and all_ > 4 * BATCH_BYTES and most < 1.1 * BATCH_BYTES


@pytest.mark.parametrize(
    "step",
    [
        lambda df: simhash.fingerprints(df, ["doc_id"], "text", 3, "fp"),
        lambda df: simhash.sketches(df, "text", 5),
        lambda df: simhash.shingle_sets(df.withColumnRenamed("doc_id", "node"), "text", 5),
        lambda df: language._identified(df, None, "text", ["doc_id"]),
    ],
)
def test_steps_over_whole_texts_bound_their_batches(spark, step):
    step(_texts(spark, 2))
    assert int(spark.conf.get(_BATCH)) == BATCH_BYTES


def test_small_batches_change_no_row(spark):
    def found():
        df = _texts(spark, 300)
        return sorted(simhash.similar_components(df).collect()), sorted(map(str, simhash.sketches(df, "text", 5).collect()))

    spark.conf.set(_BATCH, "20000")
    small = found()
    assert spark.conf.get(_BATCH) == "20000"  # what a session has set stays
    spark.conf.unset(_BATCH)
    assert found() == small
