"""What several operators use: tables in the shared folder, and joins with a checked side."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir.stage import shared_dir, staged

__all__ = ["BATCH_BYTES", "BROADCAST_IDS", "BROADCAST_ROWS", "by_batches", "shared_dir", "small", "staged"]

#: A table of at most so many rows may be broadcast; beyond it the join is left to shuffle.
BROADCAST_ROWS = 20_000
#: The same for a table of one long column, which takes no more than about 40 MB at this size.
BROADCAST_IDS = 1_000_000
#: Bytes of an Arrow batch that a task hands to Python, and one row more. Of whole texts, the 10,000 rows that Spark gathers otherwise take tens
#: of MB, several times over: as the batch, as its doubled buffers, and in Python.
BATCH_BYTES = 2 << 20
_BATCH = "spark.sql.execution.arrow.maxBytesPerBatch"


def small(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """df with a broadcast hint if it has no more than so many rows. df should be cheap to read, such as a staged table."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def by_batches(df: DataFrame, run: Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]], schema: str) -> DataFrame:
    """df.mapInArrow(run, schema) with batches of BATCH_BYTES. Spark knows the limit for a session only and reads it when the rows are asked
    for, so it stays set; one that the session has already is left as it is."""
    spark = df.sparkSession
    if spark.conf.get(_BATCH, None) is None:
        spark.conf.set(_BATCH, str(BATCH_BYTES))
    return df.mapInArrow(run, schema)
