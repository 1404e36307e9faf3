"""A sink for the corpus of bytes that survives retries, speculation and a driver that stops.

Tasks write below an attempt's folder beside the corpus, `<corpus>.jobs/<job>/<attempt>`, never in it. When all have ended, the
driver names the attempts that count in one small file that appears at once: that is the commit. Only then are finished folders
renamed into the corpus, by a Spark job whose steps may run twice. What is not committed is removed.
"""

from __future__ import annotations

import json
import os
import shutil
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pandas as pd
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.types import StructType

from weir.stage import staged

#: What the sink takes: a folder in the corpus, the source tree that is copied to it, and files that are added.
ROWS = "id string, dir string, local_dir string, notes array<struct<path: string, body: string>>"
#: What is told of each row.
RESULTS = "id string, dir string, n_files long, bytes long, error string"
COMMIT = "_committed.json"


def jobs_of(target: str) -> str:
    return f"{target.rstrip('/')}.jobs"


@dataclass
class Written(WriterCommitMessage):
    attempt: str
    rows: int


def under(top: str, inner: str) -> None:
    """Makes the folders of a path below `top`, never `top` itself."""
    at = top
    for name in filter(None, inner.split("/")):
        at = os.path.join(at, name)
        try:
            os.mkdir(at)
        except FileExistsError:
            pass


class CorpusWriter(DataSourceArrowWriter):
    def __init__(self, options: dict):
        self.job = os.path.join(jobs_of(options["path"]), options["job"])
        self.trees, self.packed = options.get("trees") or None, str(options.get("packed", "false")).lower() == "true"

    def write(self, iterator: Iterator[pa.RecordBatch]) -> Written:
        """Writes the rows of a task. The job's folder isn't made here: once the job is over it is gone, and a copy of a task
        that is still running fails instead of leaving files behind."""
        task = TaskContext.get()
        attempt = f"{task.partitionId()}-{task.attemptNumber()}-{uuid.uuid4().hex[:8]}"
        top, n = os.path.join(self.job, attempt), 0
        os.mkdir(top)
        os.mkdir(os.path.join(top, "files"))
        with open(os.path.join(top, "results.jsonl"), "x", encoding="utf-8") as told:
            for batch in iterator:
                for row in batch.to_pylist():
                    told.write(json.dumps(self.one(os.path.join(top, "files"), row)) + "\n")
                    n += 1
        return Written(attempt, n)

    def one(self, top: str, row: dict) -> dict:
        from weir.sinks import corpus

        folder, error, n, size = os.path.join(top, row["dir"]), None, 0, 0
        try:
            for outer, path in ((top, folder), *((folder, os.path.join(folder, note["path"])) for note in row["notes"] or [])):
                if os.path.commonpath([os.path.abspath(outer), os.path.abspath(path)]) != os.path.abspath(outer):
                    raise ValueError(f"{path!r} leads out of its folder")
            under(top, row["dir"])
            if self.trees and row["local_dir"] and os.path.isdir(os.path.join(self.trees, row["local_dir"])):
                corpus.copy_tree(os.path.join(self.trees, row["local_dir"]), folder)
            for note in row["notes"] or []:
                under(folder, os.path.dirname(note["path"]))
                with open(os.path.join(folder, note["path"]), "w", encoding="utf-8", newline="") as f:
                    f.write(note["body"])
            found = [os.path.join(d, x) for d, _, names in os.walk(folder) for x in names]
            n, size = len(found), sum(map(os.path.getsize, found))
            if self.packed:
                size = os.path.getsize(corpus.archive(folder))
        except Exception as e:  # noqa: BLE001
            if not os.path.isdir(top):  # not this row's fault: the job is over
                raise
            shutil.rmtree(folder, ignore_errors=True)
            error, n, size = f"{type(e).__name__}: {e}", 0, 0
        return {"id": row["id"], "dir": row["dir"] + ".tar.gz" * self.packed, "n_files": n, "bytes": size, "error": error}

    def commit(self, messages: list[Written | None]) -> None:
        attempts = sorted(m.attempt for m in messages if m is not None)
        with open(os.path.join(self.job, COMMIT + ".part"), "w", encoding="utf-8") as f:
            json.dump(attempts, f)
        os.replace(os.path.join(self.job, COMMIT + ".part"), os.path.join(self.job, COMMIT))

    def abort(self, messages: list[Written | None]) -> None:
        shutil.rmtree(self.job, ignore_errors=True)


class CorpusSink(DataSource):
    """Options: path, the corpus; job, a name that no other write has, whose folder is there; trees, where source trees are;
    packed, whether each folder becomes an archive."""

    @classmethod
    def name(cls) -> str:
        return "corpus"

    def schema(self) -> str:
        return ROWS

    def writer(self, schema: StructType, overwrite: bool) -> CorpusWriter:
        return CorpusWriter(self.options)


def put(source: str, to: str, aside: str) -> None:
    """Renames a finished folder or file to its place; what was there goes aside first. Done again it does nothing."""
    if not os.path.lexists(source):
        return
    os.makedirs(os.path.dirname(to), exist_ok=True)
    if os.path.isdir(to) or os.path.isdir(source) and os.path.lexists(to):
        old = os.path.join(aside, uuid.uuid4().hex)
        os.makedirs(aside, exist_ok=True)
        try:
            os.rename(to, old)
        except FileNotFoundError:  # another run of this step has moved it
            pass
        shutil.rmtree(old, ignore_errors=True)
    try:
        os.replace(source, to)
    except FileNotFoundError:
        pass
    except OSError:
        if os.path.lexists(source):
            raise


def publish(spark: SparkSession, target: str, job: str) -> DataFrame:
    """Moves what a committed job wrote into the corpus, and returns its results. It may be run again after a stop anywhere."""
    top = os.path.join(jobs_of(target), job)
    with open(os.path.join(top, COMMIT), encoding="utf-8") as f:
        attempts = json.load(f)
    rows = spark.read.schema(RESULTS + ", attempt string").json([f"file://{os.path.abspath(top)}/{a}/results.jsonl" for a in attempts]) if attempts else spark.createDataFrame([], RESULTS + ", attempt string")
    rows = rows.withColumn("attempt", F.element_at(F.split(F.input_file_name(), "/"), -2))
    results = staged(rows, "corpus-results")

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for r in batch.itertuples():
                put(os.path.join(top, r.attempt, "files", r.dir), os.path.join(target, r.dir), os.path.join(top, "aside"))
            yield pd.DataFrame({"n": [len(batch)]})

    # of two rows with one folder the last by id stays, whatever task wrote it
    last = results.where("error is null").groupBy("dir").agg(F.max_by("attempt", F.struct("id", "attempt")).alias("attempt"))
    last.select("dir", "attempt").mapInPandas(run, "n long").agg(F.sum("n")).collect()
    shutil.rmtree(top, ignore_errors=True)
    return results.drop("attempt")


def write(rows: DataFrame, target: str, trees: str | None = None, packed: bool = False) -> DataFrame:
    """Writes rows (ROWS) to a corpus, in a folder that all executors share, and returns RESULTS. A row that can't be written has an
    error and changes nothing in the corpus; a folder that is there already is replaced as a whole."""
    spark, job = rows.sparkSession, uuid.uuid4().hex
    spark.dataSource.register(CorpusSink)
    os.makedirs(os.path.join(jobs_of(target), job))
    os.makedirs(target, exist_ok=True)
    rows.select("id", "dir", "local_dir", "notes").write.format("corpus").mode("append").options(path=target, job=job, trees=trees or "", packed=str(packed)).save()
    return publish(spark, target, job)


def recover(spark: SparkSession, target: str) -> tuple[list[str], list[str]]:
    """(published, removed): jobs that a stopped driver left. Those committed are published, the others removed. No write to
    this corpus may be running."""
    top, published, removed = jobs_of(target), [], []
    for job in sorted(os.listdir(top)) if os.path.isdir(top) else []:
        if os.path.exists(os.path.join(top, job, COMMIT)):
            publish(spark, target, job)
            published.append(job)
        else:
            shutil.rmtree(os.path.join(top, job), ignore_errors=True)
            removed.append(job)
    return published, removed
