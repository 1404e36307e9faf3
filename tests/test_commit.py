"""The corpus sink under failures: a task that stops half way, a copy of a slow task, a driver that stops, a rerun."""

import json
import os
import subprocess
import sys
from pathlib import Path

import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from weir.sinks import commit

REPO = str(Path(__file__).resolve().parents[1])

RETRIES = """
import sys
from pyspark.sql import SparkSession
from weir.sinks import commit
top = sys.argv[1]
spark = SparkSession.builder.config(map={"spark.master": "local[2,3]", "spark.ui.enabled": "false", "spark.checkpoint.dir": f"file://{top}/shared", "spark.sql.execution.arrow.maxRecordsPerBatch": "30", "spark.sql.shuffle.partitions": "2"}).getOrCreate()
spark.sparkContext.setLogLevel("OFF")

def upset(batches):
    # the first try of partition 0 fails after half of its rows
    from pyspark import TaskContext
    task = TaskContext.get()
    open(f"{top}/tries/{task.partitionId()}-{task.attemptNumber()}", "w").close()
    for k, b in enumerate(batches):
        if task.attemptNumber() == 0 and task.partitionId() == 0 and k == 3:
            raise RuntimeError("half way")
        yield b

rows = spark.range(0, 400, 1, 2).selectExpr("cast(id as string) id", "concat('d', id % 7, '/x', id) dir", "'' local_dir", "array(named_struct('path', 'writeups/a.md', 'body', concat('body ', id)), named_struct('path', 'b', 'body', '')) notes")
out = commit.write(rows.mapInPandas(upset, commit.ROWS), f"{top}/corpus")
print("ROWS", out.count(), out.where("error is null and n_files = 2").count(), out.select("id").distinct().count())
"""


def files(top: Path) -> dict[str, str]:
    return {str(p.relative_to(top)): p.read_text() for p in top.rglob("*") if p.is_file()}


def test_a_task_that_fails_half_way(tmp_path):
    (tmp_path / "tries").mkdir()
    (tmp_path / "run.py").write_text(RETRIES)
    done = subprocess.run([sys.executable, str(tmp_path / "run.py"), str(tmp_path)], env=os.environ | {"PYTHONPATH": REPO}, cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "ROWS 400 400 400" in done.stdout, done.stderr[-3000:]
    assert {p.name for p in (tmp_path / "tries").iterdir()} == {"0-0", "0-1", "1-0"}
    assert files(tmp_path / "corpus") == {f"d{i % 7}/x{i}/{name}": body for i in range(400) for name, body in (("writeups/a.md", f"body {i}"), ("b", ""))}
    assert not any((tmp_path / "corpus.jobs").iterdir())


class Task:
    """A task's context: its partition and which try it is."""

    def __init__(self, partition, attempt):
        self.partition, self.attempt = partition, attempt

    def partitionId(self):
        return self.partition

    def attemptNumber(self):
        return self.attempt


def batches(bodies, n=2):
    made = [{"id": i, "dir": d, "local_dir": "", "notes": [{"path": "a.md", "body": b}]} for i, d, b in bodies]
    return (pa.RecordBatch.from_pylist(made[k : k + n]) for k in range(0, len(made), n))


def test_copies_of_a_slow_task(spark, tmp_path, monkeypatch):
    """Speculation, played through: of two tries that run at once one counts; one that is still writing when all is over fails."""
    top, tries = tmp_path / "corpus", iter([Task(0, 0), Task(0, 1), Task(1, 0)])
    (tmp_path / "corpus.jobs/j").mkdir(parents=True)
    monkeypatch.setattr(commit.TaskContext, "get", lambda: next(tries))
    writer = lambda: commit.CorpusWriter({"path": str(top), "job": "j"})
    some, others = [(str(i), f"d/{i}", f"b{i}") for i in range(6)], [("9", "e/9", "b9")]

    def slow():
        """The first try stands still after two rows; its copy writes all, and all is committed and published meanwhile."""
        source = batches(some)
        yield next(source)
        second = writer().write(batches(some))
        writer().commit([second, writer().write(batches(others))])
        monkeypatch.undo()
        assert commit.publish(spark, str(top), "j").count() == 7
        yield from source

    with pytest.raises(OSError):
        writer().write(slow())
    assert files(top) == {f"{d}/a.md": b for _, d, b in some + others} and not any((tmp_path / "corpus.jobs").iterdir())
    with pytest.raises(FileNotFoundError):  # a try that only begins then makes no folder
        monkeypatch.setattr(commit.TaskContext, "get", lambda: Task(0, 2))
        writer().write(batches(some))


def rows(spark, bodies, local=""):
    note = F.array(F.struct(F.lit("a.md").alias("path"), F.col("body").alias("body")))
    return spark.createDataFrame(bodies, "id string, dir string, body string").select("id", "dir", F.lit(local).alias("local_dir"), note.alias("notes"))


def test_reruns_errors_and_what_was_there(spark, tmp_path):
    top = tmp_path / "corpus"
    first = commit.write(rows(spark, [("1", "a/x", "one"), ("2", "a/y", "two"), ("3", "f", "three")]), str(top)).collect()
    assert {(r["id"], r["n_files"], r["bytes"], r["error"]) for r in first} == {("1", 1, 3, None), ("2", 1, 3, None), ("3", 1, 5, None)}
    (top / "a/x/old").write_text("goes with its folder")
    again = {r["id"]: r for r in commit.write(rows(spark, [("1", "a/x", "new"), ("2", "../../out", "x"), ("4", "a/y", None)]), str(top)).collect()}
    assert again["1"]["error"] is None and "leads out" in again["2"]["error"] and again["4"]["error"]
    assert files(top) == {"a/x/a.md": "new", "a/y/a.md": "two", "f/a.md": "three"} and not (tmp_path / "out").exists()
    packed = {r["id"]: r["dir"] for r in commit.write(rows(spark, [("1", "a/x", "new")]), str(top), packed=True).collect()}
    before = (top / "a/x.tar.gz").read_bytes()
    assert packed == {"1": "a/x.tar.gz"} and commit.write(rows(spark, [("1", "a/x", "new")]), str(top), packed=True).count() == 1 and (top / "a/x.tar.gz").read_bytes() == before
    assert commit.write(rows(spark, []), str(top)).count() == 0 and not any((tmp_path / "corpus.jobs").iterdir())


def test_a_driver_that_stops(spark, tmp_path, monkeypatch):
    """Before the commit nothing is kept, after it everything is, also if half was moved."""
    top = tmp_path / "corpus"
    monkeypatch.setattr(commit, "publish", lambda *a: None)
    commit.write(rows(spark, [(str(i), f"d/{i}", f"b{i}") for i in range(6)]), str(top))
    monkeypatch.undo()
    job = next((tmp_path / "corpus.jobs").iterdir())
    moved = next(job.glob("*/files/d/3"))
    (top / "d").mkdir(parents=True)
    moved.rename(top / "d/3")
    lost = tmp_path / "corpus.jobs/lost"
    (lost / "0-0-x/files/e").mkdir(parents=True)
    assert json.loads((job / commit.COMMIT).read_text()) and commit.recover(spark, str(top)) == ([job.name], ["lost"])
    assert files(top) == {f"d/{i}/a.md": f"b{i}" for i in range(6)} and not any((tmp_path / "corpus.jobs").iterdir())
    assert commit.recover(spark, str(top)) == ([], [])


def test_a_failed_write_is_removed(spark, tmp_path):
    bad = rows(spark, [("1", "a", "x")]).withColumn("id", F.raise_error(F.lit("no")).cast("string"))
    with pytest.raises(Exception, match="no"):
        commit.write(bad, str(tmp_path / "corpus"))
    assert not any((tmp_path / "corpus.jobs").iterdir()) and files(tmp_path / "corpus") == {}
