"""Catalog and candidate sinks."""

from __future__ import annotations

import os
import shutil
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

from weir import schema
from weir.stage import local_path, scratch, spread


def conform(df: DataFrame, kind=schema.CHALLENGE) -> DataFrame:
    """Exactly the contract's columns and types, whatever the rows hold."""
    return df.select(*[df[f.name].cast(f.dataType).alias(f.name) for f in kind])


def write_jsonl(df: DataFrame, path: str, single: bool = False, mode: str = "overwrite") -> None:
    """A catalog as JSON lines: nulls left out, empty arrays kept. single: one file at `path` in place of a folder. Its lines are made
    by all tasks, as files of which each is then copied, by a task, to its place in the one."""
    if not single:
        conform(df).write.mode(mode).option("ignoreNullFields", True).json(path)
        return
    parts = scratch(df.sparkSession, "lines")
    conform(df).write.option("ignoreNullFields", True).json(parts)
    folder, to, at, pieces = local_path(parts), local_path(path), 0, []
    for name in sorted(n for n in os.listdir(folder) if n.startswith("part-")):
        pieces.append((name, at))
        at += os.path.getsize(os.path.join(folder, name))
    os.makedirs(os.path.dirname(to), exist_ok=True)
    with open(f"{to}.part", "wb") as whole:
        whole.truncate(at)

    def copy(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in batch.to_pylist():
                with open(os.path.join(folder, piece["name"]), "rb") as one, open(f"{to}.part", "r+b") as whole:
                    whole.seek(piece["at"])
                    shutil.copyfileobj(one, whole, 1 << 20)
            yield batch

    spread(df.sparkSession.createDataFrame(pieces, "name string, at long")).mapInArrow(copy, "name string, at long").count()
    os.replace(f"{to}.part", to)


def write_parquet(df: DataFrame, path: str, mode: str = "overwrite", by: list[str] | None = None) -> None:
    """A catalog as Parquet under the declared schema, an empty one too."""
    writer = conform(df).write.mode(mode)
    (writer.partitionBy(*by) if by else writer).parquet(path)


def write_candidates(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """Candidates as JSON lines with nulls."""
    conform(df, schema.CANDIDATE).write.mode(mode).option("ignoreNullFields", False).json(path)


def append_manifest(df: DataFrame, path: str) -> None:
    """Results of repositories, added to the manifest: one commit of the writer, so rows are there whole or not at all."""
    conform(df, schema.MANIFEST).write.mode("append").json(path)


def write_partitions(df: DataFrame, path: str, by: list[str]) -> None:
    """Replaces the partitions that df has and leaves the others; a partition appears whole."""
    df.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(*by).parquet(path)
