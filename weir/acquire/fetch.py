"""The opt-in stage that fetches what records only name: bodies of external writeups, and handouts. `client` makes the client
of a task, so that tests and callers choose what is reached; a failure is a row's error and nothing else."""

from __future__ import annotations

import os
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weir.acquire.client import MAX_FILE, Polite, download
from weir.functions import text

#: A limiter is of one task, so this many tasks fetch at once.
TASKS = 1


def writeups(challenges: DataFrame, client: Callable[[], Polite], tasks: int = TASKS) -> DataFrame:
    """(url, body, content_type, error) of the external writeups of challenges that may be passed on, each url once. An answer
    other than 200, or an address that isn't public, has no body."""
    may = challenges.where(F.coalesce("license.redistributable", F.lit(False)))
    urls = may.select(F.explode("writeups").alias("w")).where(F.col("w.url").isNotNull() & F.nullif(F.col("w.text"), F.lit("")).isNull()).select("w.url").distinct()

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        one = client()
        for batch in batches:
            out = []
            for url in batch["url"]:
                try:
                    status, body, kind = one.fetch(url)
                    out.append((url, body.decode("utf-8", "replace") if status == 200 else None, kind, None if status == 200 else f"status {status}"))
                except Exception as e:  # noqa: BLE001
                    out.append((url, None, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(out, columns=["url", "body", "content_type", "error"])

    return urls.repartition(tasks).mapInPandas(run, "url string, body string, content_type string, error string")


def handouts(files: DataFrame, folder: str, client: Callable[[], Polite], limit: int = MAX_FILE, tasks: int = TASKS) -> DataFrame:
    """(dir, name, url, path, error) of handouts (dir, name, url), written below a folder that all executors share. One that is
    there is trusted; of clashing names in a dir the first by url counts."""
    first = files.groupBy("dir", "name").agg(F.min("url").alias("url"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        one = client()
        for batch in batches:
            out = []
            for r in batch.itertuples():
                path, error = os.path.join(folder, r.dir, os.path.basename(r.name)), None
                try:
                    os.makedirs(os.path.dirname(path), exist_ok=True)
                    if not (os.path.exists(path) and os.path.getsize(path)):
                        status, body, _ = one.fetch(r.url)
                        error = f"status {status}" if status != 200 else None if download([body], path, len(body), limit) else "too large"
                except Exception as e:  # noqa: BLE001
                    error = f"{type(e).__name__}: {e}"
                out.append((r.dir, r.name, r.url, None if error else path, error))
            yield pd.DataFrame(out, columns=["dir", "name", "url", "path", "error"])

    return first.repartition(tasks).mapInPandas(run, "dir string, name string, url string, path string, error string")


def handout_links(records: DataFrame) -> DataFrame:
    """(dir, name, url) of the files that page records name in `extra`; dir is the page's slug."""
    kind = "struct<slug:string,files:array<struct<url:string,name:string>>>"
    found = records.select(F.from_json("extra", kind).alias("x")).select(F.col("x.slug").alias("dir"), F.explode("x.files").alias("f"))
    return found.select("dir", text.basename(F.col("f.name")).alias("name"), "f.url")
