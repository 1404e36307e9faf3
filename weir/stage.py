"""The shared folder: tables that are written once and read by several branches, and files that executors exchange."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def shared_dir(spark: SparkSession) -> str:
    """A folder below the one named in spark.checkpoint.dir. Where that is unset, a temporary one, on a single machine only."""
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that the driver and all executors share")
        root = getattr(spark, "_weir_scratch", None) or tempfile.mkdtemp(prefix="weir-")
        spark._weir_scratch = root
    return f"{root.rstrip('/')}/weir-{spark.sparkContext.applicationId}"


def scratch(spark: SparkSession, name: str) -> str:
    """A path in the shared folder that nothing has yet."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex[:12]}"


def local_path(path: str) -> str:
    """The path of a file: url as the operating system names it, for readers that open files on the driver."""
    return path[5:].replace("///", "/", 1) if path.startswith("file:") else path


def staged(df: DataFrame, name: str) -> DataFrame:
    """df written to the shared folder and read again: the lineage and the plan end there, and a lost executor costs no more
    than a reread."""
    path = scratch(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def small(df: DataFrame, rows: int = 100_000) -> DataFrame:
    """df with a broadcast hint if it has no more than so many rows, which should be narrow; df is a staged table or cheap to read."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def numbered(df: DataFrame, by: list[str], name: str) -> DataFrame:
    """df with a column `name`: the place from 0 of each row in the order of `by`. Rows are sorted over ranges that sampled
    splitters cut, and numbered in a range and then over the ranges, so that no task holds all rows."""
    ranged = staged(df.repartitionByRange(*by).withColumn("__range", F.spark_partition_id()), "ranges")
    sizes = ranged.groupBy("__range").agg(F.count("*").alias("__n"))
    before = F.coalesce(F.sum("__n").over(Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))  # a row for each range
    offsets = sizes.select("__range", before.alias("__before"))
    nth = F.row_number().over(Window.partitionBy("__range").orderBy(*by)) - 1
    return ranged.withColumn("__nth", nth).join(offsets, "__range").withColumn(name, (F.col("__before") + F.col("__nth")).cast("long")).drop("__range", "__nth", "__before")


def spread(df: DataFrame, *by: str) -> DataFrame:
    """df dealt over all cores, a few partitions for each, evenly or by columns that are grouped next: for narrow rows of which each
    takes long, whatever number of files and row groups they come from, and few bytes though they are."""
    return df.repartition(4 * df.sparkSession.sparkContext.defaultParallelism, *by)
