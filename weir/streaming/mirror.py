"""Mirroring as a stream: repositories come in micro-batches, and one is `ok` only after its batch is published."""

from __future__ import annotations

import os
import shutil
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from weir import schema
from weir.acquire.client import DISK_FLOOR, low_disk
from weir.plans.ingest import flushes, pending, read_manifest
from weir.sinks import corpus
from weir.sinks.catalog import append_manifest, conform
from weir.stage import staged

REQUEST = T.StructType([T.StructField("repo", T.StringType()), T.StructField("path", T.StringType())])


def flush(batch: DataFrame, batch_id: int, stage: Callable[[DataFrame], tuple[DataFrame, DataFrame]], publish: Callable[[DataFrame, int], None], manifest: str, catalog: str) -> None:
    """Stages a batch, publishes it once, then adds its results to the manifest.

    stage: repositories -> (results, challenges). If publishing fails, all of the batch that was staged is `failed` and no
    other batch is touched. A batch without challenges isn't published but its results count. Written under its number, a
    batch that runs again replaces itself.
    """
    results, challenges = stage(batch)
    results = results.persist()
    error = None
    try:
        conform(challenges).write.mode("overwrite").json(f"{catalog}/batch={batch_id}")
        if not challenges.isEmpty():
            publish(challenges, batch_id)
    except Exception as e:  # noqa: BLE001
        error = f"{type(e).__name__}: {e}"[:500]
    done = F.when(F.col("status") == "staged", "ok" if error is None else "failed").otherwise(F.col("status"))
    append_manifest(results.withColumns({"status": done, "ts": F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ssXXX")}), manifest)
    results.unpersist()


def mirror(spark: SparkSession, requests: str, stage, publish, manifest: str, catalog: str, checkpoint: str, files_per_batch: int = 50, nested: bool = False):
    """Runs all requests (JSON lines of repo, path; in folders of batches if nested) that no checkpoint or manifest has done, and returns the ended query."""
    rows = spark.readStream.schema(REQUEST).option("maxFilesPerTrigger", files_per_batch).option("recursiveFileLookup", nested).json(requests)

    def each(batch: DataFrame, batch_id: int) -> None:
        todo = pending(batch.dropDuplicates(["repo"]), read_manifest(spark, manifest))
        if not todo.isEmpty():
            flush(todo, batch_id, stage, publish, manifest, catalog)

    query = rows.writeStream.foreachBatch(each).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    query.awaitTermination()
    return query


def acquire(repos: list[str], folder: str, clone: Callable[[str, str], tuple[str, str]], sizes: dict[str, int] | None = None, max_mb: int = 4_096, floor: int = DISK_FLOOR, workers: int = 6) -> list[tuple[str, str | None, str, str | None]]:
    """(repo, commit_sha, status, error) of checkouts below a folder, some at a time. One that is too big or finds the disk
    low isn't begun; one that fails is `failed` and no other is touched. Those that are there are `staged`."""
    os.makedirs(folder, exist_ok=True)

    def one(repo: str) -> tuple[str, str | None, str, str | None]:
        try:
            if why := low_disk(folder, floor):
                return repo, None, "skipped", why
            size = (sizes or {}).get(repo)
            if size is not None and size > max_mb * 1_024:
                return repo, None, "too_big", f"{size} KB exceed {max_mb} MB"
            return repo, clone(repo, folder)[1], "staged", None
        except Exception as e:  # noqa: BLE001
            return repo, None, "failed", f"{type(e).__name__}: {e}"[:500]

    with ThreadPoolExecutor(workers) as pool:
        return list(pool.map(one, repos))


def stage_clones(spark: SparkSession, folder: str, seeds: DataFrame, clone: Callable[[str, str], tuple[str, str]], candidates: DataFrame | None = None, max_mb: int = 4_096, target: str | None = None, floor: int = DISK_FLOOR, workers: int = 6):
    """A stage that checks out the repositories of a micro-batch, reads them like stage_trees, packs each challenge below
    `target` (a shared folder) if given, and always removes the checkouts. No repository makes another fail."""

    def run(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
        names = [r["repo"] for r in batch.select("repo").collect()]  # one micro-batch of repositories
        sizes: dict[str, int] = {}
        if candidates is not None:
            known = candidates.where(F.col("full_name").isin(names)).select("full_name", "size_kb").collect()
            for r in known:
                sizes.setdefault(r["full_name"], r["size_kb"])
        rows = acquire(names, folder, clone, sizes, max_mb, floor, workers)
        try:
            got = spark.createDataFrame(rows, "repo string, commit_sha string, status string, error string")
            commits = got.where("status = 'staged'").select(F.col("repo").alias("tree"), "commit_sha")
            results, merged = stage_trees(spark, folder, seeds, commits)(got.where("status = 'staged'").select("repo"))
            results, merged = staged(results, "results"), staged(merged, "merged")
            if target is not None:
                written = staged(corpus.write(merged, corpus.writeup_bodies(merged), target, folder, packed=True), "written")
                merged = staged(corpus.archived(corpus.materialized(merged, corpus.writeup_bodies(merged), "corpus")), "archived")
                of = merged.select("id", F.col("sources")[0]["repo"].alias("repo"))
                broken = written.where("error is not null").join(of, "id").groupBy("repo").agg(F.first("error").alias("why"))
                results = results.join(broken, "repo", "left").withColumns({"status": F.when(F.col("why").isNotNull(), "failed").otherwise(F.col("status")), "error": F.coalesce("why", "error")})
            other = got.where("status <> 'staged'").select("repo", "commit_sha", F.lit(0).alias("n_challenges"), F.lit(0).alias("n_files"), F.lit(0).cast("long").alias("bytes"), "status", "error")
            return staged(conform(results, schema.RESULT).unionByName(conform(other, schema.RESULT)), "results"), merged
        finally:
            for name in names:
                shutil.rmtree(os.path.join(folder, name.replace("/", "__", 1)), ignore_errors=True)

    return run


def request_batches(repos: DataFrame, sizes: DataFrame, path: str, batch_size: int = 50, max_mb: float = 8_000) -> int:
    """Writes requests (pos, repo) as JSON files, one for each batch of so many repositories or so many bytes of what `sizes`
    (repo, size_kb) tells of them, so that a stream that takes a file at a time publishes by count or bytes."""
    known = sizes.groupBy("repo").agg((F.max("size_kb") * 1_024).alias("bytes"))
    rows = flushes(repos.select("pos", "repo").join(known, "repo", "left").select("pos", "repo", F.coalesce("bytes", F.lit(0)).cast("long").alias("bytes")), batch_size, max_mb)
    rows = staged(rows, "requests")
    rows.select("repo", F.lit(None).cast("string").alias("path"), "batch").repartition(4 * rows.sparkSession.sparkContext.defaultParallelism, "batch").sortWithinPartitions("batch").write.mode("overwrite").partitionBy("batch").json(path)
    return rows.agg(F.coalesce(F.max("batch") + 1, F.lit(0))).first()[0]


def stage_trees(spark: SparkSession, checkouts: str, seeds: DataFrame, commits: DataFrame):
    """A stage over local checkouts: one partition for each repository, read, walked, normalized and merged within itself. A
    checkout that is missing or can't be read is `failed` and no other is."""
    from weir.operators import catalog, walk
    from weir.sources.trees import read_tree

    def run(batch: DataFrame) -> tuple[DataFrame, DataFrame]:
        names = [r["repo"] for r in batch.select("repo").collect()]  # one micro-batch of repositories
        tree = read_tree(spark, checkouts, checkouts="true", only=",".join(names), heads="license,licence,copying,unlicense,challenge.json")
        tree = staged(tree, "tree")
        broken = tree.where("error is not null").groupBy("tree").agg(F.first("error").alias("why"))
        whole = tree.where("path is not null").join(broken.select("tree"), "tree", "left_anti")
        raw = staged(walk.records(whole, seeds, commits).withColumn("input_pos", F.monotonically_increasing_id()), "raw")
        made = catalog.normalize(raw).withColumn("__repo", F.col("sources")[0]["repo"])
        # mirrors fold within a repository only: its name is part of what a cluster is
        split = made.withColumn("content_fingerprint", F.when(F.col("content_fingerprint").isNotNull(), F.concat_ws("|", "__repo", "content_fingerprint")))
        merged, _ = catalog.merge(split)
        merged = merged.withColumn("content_fingerprint", F.regexp_extract("content_fingerprint", r"([^|]*)$", 1))
        merged = merged.withColumn("content_fingerprint", F.nullif("content_fingerprint", F.lit("")))
        sums = merged.groupBy(F.col("__repo").alias("repo")).agg(
            F.count("*").cast("int").alias("n_challenges"), F.sum(F.size("files")).cast("int").alias("n_files"), F.sum(F.aggregate("files", F.lit(0).cast("long"), lambda a, f: a + F.coalesce(f["size"], F.lit(0)))).alias("bytes")
        )
        seen = tree.select(F.col("tree").alias("repo"), F.lit(True).alias("seen")).distinct()
        joined = batch.select("repo").join(seen, "repo", "left").join(broken.withColumnRenamed("tree", "repo"), "repo", "left").join(sums, "repo", "left").join(commits.select(F.col("tree").alias("repo"), "commit_sha"), "repo", "left")
        zero = lambda c: F.coalesce(c, F.lit(0))
        results = joined.select(
            "repo", "commit_sha", zero("n_challenges").alias("n_challenges"), zero("n_files").alias("n_files"), zero("bytes").cast("long").alias("bytes"),
            F.when(F.col("seen") & F.col("why").isNull(), "staged").otherwise("failed").alias("status"), F.coalesce("why", F.when(F.col("seen").isNull(), "no checkout")).alias("error"),
        )
        return conform(results, schema.RESULT), merged.drop("__repo", "input_pos")

    return run
