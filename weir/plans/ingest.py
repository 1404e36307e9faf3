"""From a source to a catalog shard, and what a mirror of many repositories needs before and after."""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from weir import schema
from weir.operators import catalog, discovery
from weir.sinks import catalog as sink
from weir.sinks import corpus
from weir.sources.records import REGISTRY
from weir.stage import numbered, staged


@dataclass
class Ingested:
    challenges: DataFrame
    duplicates: DataFrame | None
    bodies: DataFrame


def ingest(raw: DataFrame, dedup: bool = True, materialize: bool = True, root: str = "corpus", ingested_at: Column | None = None, pos: str = "input_pos") -> Ingested:
    """Normalizes, merges mirrors and lays out the corpus. Nothing is fetched, and nothing is written outside the shared folder."""
    placed = raw if pos in raw.columns else staged(raw.withColumn(pos, F.monotonically_increasing_id()), "raw")
    made, pairs = catalog.normalize(placed, ingested_at), None
    if dedup:
        made, pairs = catalog.merge(made, pos)
    bodies = corpus.writeup_bodies(made)
    return Ingested(corpus.materialized(made, bodies, root) if materialize else made, pairs, bodies)


def ingest_source(spark: SparkSession, name: str, out: str, parquet: bool = False, **options) -> DataFrame:
    """Reads a registered source and writes its shard; an unknown name is an error that tells the known ones."""
    if name not in REGISTRY:
        raise ValueError(f"unknown source {name!r}; known: {', '.join(sorted(REGISTRY))}")
    done = ingest(REGISTRY[name](spark, **options))
    sink.write_jsonl(done.challenges, f"{out}/{name}.jsonl")
    if parquet:
        sink.write_parquet(done.challenges, f"{out}/{name}.parquet")
    return done.challenges


def resolve(spark: SparkSession, source: str, seeds: DataFrame | None = None, candidates: DataFrame | None = None, only: list[str] | None = None) -> DataFrame:
    """(pos, repo) to mirror: `only` if given, else seeds, discovered ones or both, seeds first; each once."""
    if source not in ("seeds", "discovered", "both"):
        raise ValueError(f"unknown source {source!r}; known: seeds, discovered, both")
    if only:
        rows = spark.createDataFrame(list(enumerate(only)), "pos long, repo string")
    else:
        parts = []
        if source != "discovered" and seeds is not None:
            parts.append(seeds.select(F.col("pos").cast("long").alias("pos"), "repo"))
        if source != "seeds" and candidates is not None:
            parts.append(candidates.select((F.lit(1 << 40) + F.monotonically_increasing_id()).alias("pos"), F.col("full_name").alias("repo")))
        rows = parts[0] if parts else spark.createDataFrame([], "pos long, repo string")
        for p in parts[1:]:
            rows = rows.unionByName(p)
    return discovery.first_seen(rows, "repo", "pos")


def read_manifest(spark: SparkSession, path: str) -> DataFrame:
    """Results so far; lines that can't be read are left out, a missing manifest is empty."""
    try:
        return spark.read.schema(schema.MANIFEST).option("mode", "DROPMALFORMED").json(path)
    except Exception as e:  # noqa: BLE001
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return spark.createDataFrame([], schema.MANIFEST)


def pending(repos: DataFrame, manifest: DataFrame) -> DataFrame:
    """Repositories that were never ok."""
    return repos.join(manifest.where("status = 'ok'").select("repo").distinct(), "repo", "left_anti")


def sized(repos: DataFrame, candidates: DataFrame, max_mb: int) -> DataFrame:
    """repos with size_kb, the first that candidates tell, and too_big; an unknown size passes."""
    placed = candidates.select(F.col("full_name").alias("repo"), "size_kb", F.monotonically_increasing_id().alias("at"))
    sizes = placed.groupBy("repo").agg(F.min_by("size_kb", "at").alias("size_kb"))
    return repos.join(sizes, "repo", "left").withColumn("too_big", F.coalesce(F.col("size_kb") > max_mb * 1_024, F.lit(False)))


def mirror_summary(results: DataFrame) -> DataFrame:
    """(status, repos, challenges, bytes)."""
    return results.groupBy("status").agg(F.count("*").alias("repos"), F.coalesce(F.sum("n_challenges"), F.lit(0)).alias("challenges"), F.coalesce(F.sum("bytes"), F.lit(0)).alias("bytes"))


#: Rows of a run that are numbered together, and how many times a batch a run is at least.
RUN, SHARE = 1 << 16, 1_024


def batch_ends(sizes: np.ndarray, batch_size: int, limit: float) -> np.ndarray:
    """For each row, the place after the last row of the batch that begins there, or len(sizes) if that isn't among them."""
    sums = np.r_[0, np.cumsum(sizes, dtype=np.int64)]
    full = np.searchsorted(sums, sums[:-1] + limit, "left") if limit > 0 else np.zeros(len(sizes), np.int64)
    at = np.arange(len(sizes))
    return np.minimum(np.maximum(at + 1, np.minimum(full, at + batch_size)), len(sizes))


def flushes(results: DataFrame, batch_size: int = 50, max_mb: float = 8_000, pos: str = "pos") -> DataFrame:
    """results in the order they are done, with the batch each is published in: a batch ends when it has so many rows or so
    many bytes. Where one ends depends on all before it; but one that is open where a run of rows begins ends within batch_size rows.
    So each run tells, for every row of these that a batch may begin at, how many batches begin in it from there and where
    the first of the next run begins. That table, at most a row in a thousand, is followed from run to run; then runs number their
    rows, each on its own. Negative and unknown bytes count as none."""
    batch_size = max(1, batch_size)
    spark, limit, run = results.sparkSession, max_mb * 1_000_000, max(RUN, SHARE * batch_size)
    placed = staged(numbered(results.select(pos, F.greatest(F.coalesce("bytes", F.lit(0)), F.lit(0)).cast("long").alias("size"), F.struct(*results.columns).alias("row")), [pos], "at"), "placed")
    own = F.floor(F.col("at") / run).cast("long")
    cut = placed.select("at", "size", own.alias("run"))
    # the first rows of a run are looked at by the one before as well, whose last batch ends among them
    ahead = cut.where((F.col("at") % run < batch_size) & (F.col("run") > 0)).withColumn("run", F.col("run") - 1)

    def tell(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("at")
        ends = batch_ends(pdf["size"].to_numpy(), batch_size, limit)
        n = min(run, len(pdf))
        begun, then = np.zeros(n + 1, np.int64), np.zeros(n + 1, np.int64)
        for i in range(n - 1, -1, -1):
            e = ends[i]
            begun[i], then[i] = (1, e - n) if e >= n else (begun[e] + 1, then[e])
        first = min(batch_size, n) + 1
        return pd.DataFrame({"run": pdf["run"].iloc[0], "first": np.arange(first), "begun": begun[:first], "then": then[:first]})

    table = staged(cut.unionByName(ahead).groupBy("run").applyInPandas(tell, "run long, first int, begun long, then long"), "runs")
    first, batch, known = 0, 0, []
    for r in table.orderBy("run", "first").toLocalIterator():
        if r["run"] == len(known) and r["first"] == first:
            known.append((r["run"], first, batch))
            first, batch = r["then"], batch + r["begun"]
    begins = spark.createDataFrame(known, "run long, first int, before long")

    def number(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values("at")
        ends, i = batch_ends(pdf["size"].to_numpy(), batch_size, limit), int(pdf["first"].iloc[0])
        begin = np.zeros(len(pdf), np.int64)
        while i < len(pdf):
            begin[i] = 1
            i = ends[i]
        return pd.DataFrame({"at": pdf["at"], "batch": (pdf["before"].iloc[0] + np.cumsum(begin) - 1).astype(np.int32)})

    numbers = cut.join(F.broadcast(begins), "run").groupBy("run").applyInPandas(number, "at long, batch int")
    return placed.join(numbers, "at").select("row.*", "batch")
