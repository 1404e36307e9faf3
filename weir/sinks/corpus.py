"""The corpus of bytes: where a challenge's files go, which rows they add to its manifest, and archives that come out byte
for byte alike. Executors write them, one challenge at a time, to a folder that all of them share."""

from __future__ import annotations

import gzip
import os
import shutil
import tarfile
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weir import schema
from weir.functions import text
from weir.sinks import commit
from weir.sources.records import make


def relpath(slug=text.slug) -> Column:
    """origin/event/year/slug__id8 of a challenge."""
    origin = F.coalesce(F.try_element_at("sources", F.lit(1))["origin"], F.lit("unknown"))
    event = F.coalesce(F.nullif(slug(F.coalesce(F.nullif("event_name", F.lit("")), F.lit("unknown-event"))), F.lit("")), F.lit("unknown-event"))
    year = F.coalesce(F.nullif(F.col("year"), F.lit(0)).cast("string"), F.lit("0000"))
    name = F.coalesce(F.nullif(slug(F.col("title")), F.lit("")), F.lit("challenge"))
    return F.concat_ws("/", origin, event, year, F.concat(name, F.lit("__"), F.substring("id", 1, 8)))


def writeup_bodies(challenges: DataFrame, fetched: DataFrame | None = None) -> DataFrame:
    """(id, nth, path, body) of writeups whose bytes are at hand: inline, or fetched (url, body, content_type)."""
    w = challenges.select("id", F.posexplode("writeups").alias("nth", "w"))
    if fetched is None:
        found = w.withColumns({"body": F.lit(None).cast("string"), "content_type": F.lit(None).cast("string")})
    else:
        found = w.join(fetched, F.col("w.url") == F.col("url"), "left").drop("url")
    inline = F.nullif(F.col("w.text"), F.lit("")).isNotNull()
    suffix = F.when(inline, ".md").otherwise(text.writeup_suffix(F.col("w.url"), F.col("content_type")))
    body = F.when(inline, F.col("w.text")).otherwise(F.nullif("body", F.lit("")))
    return found.select("id", "nth", F.concat(F.lit("writeups/writeup_"), F.lpad(F.col("nth").cast("string"), 2, "0"), suffix).alias("path"), body.alias("body")).where("body is not null")


def materialized(challenges: DataFrame, bodies: DataFrame, root: str = "corpus", slug=text.slug) -> DataFrame:
    """challenges as they stand once their bytes are written: writeups have a local path and no text, their files are in the
    manifest, and corpus_path is relative. What was computed from files before stays as it was."""
    file = make(schema.FILE, path=F.col("path"), sha256=F.sha2("body", 256), size=F.octet_length("body"), is_source=text.is_source(F.col("path")), lfs=F.lit(False))
    made = bodies.groupBy("id").agg(F.sort_array(F.collect_list(F.struct("nth", "path", file.alias("file")))).alias("__made"))
    joined = challenges.join(made, "id", "left")
    at = lambda i: F.try_element_at(F.filter(F.col("__made"), lambda m: m["nth"] == i), F.lit(1))
    notes = F.transform("writeups", lambda w, i: F.when(at(i).isNotNull(), w.withField("local_path", at(i)["path"]).withField("text", F.lit(None).cast("string"))).otherwise(w))
    files = F.concat("files", F.coalesce(F.col("__made.file"), F.array().cast(schema.CHALLENGE["files"].dataType)))
    return joined.withColumns({"writeups": notes, "files": files, "corpus_path": F.concat(F.lit(f"{root}/"), relpath(slug))}).select(*challenges.columns)


def orphans(listing: DataFrame, bodies: DataFrame, places: DataFrame) -> DataFrame:
    """(path) of writeup files in a listing of the corpus that nothing names any more. places: (id, dir)."""
    kept = bodies.join(places, "id").select(F.concat_ws("/", "dir", "path").alias("path"))
    return listing.where("not is_dir").where(F.col("path").rlike("/writeups/[^/]+$")).join(kept, "path", "left_anti").select("path")


def listing(spark, target: str) -> DataFrame:
    """(path, is_dir, size, sha256) of what is in a corpus."""
    from weir.sources.trees import read_tree

    return read_tree(spark, target, hash="true").where("path is not null").select("path", "is_dir", "size", "sha256")


def prune(target: str, gone: DataFrame) -> DataFrame:
    """(path, removed) of files below `target`, deleted where they are there. A path that leads out of it is left alone."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        top = os.path.realpath(target)
        for batch in batches:
            done = []
            for path in batch["path"]:
                full = os.path.join(target, path)
                inside = os.path.commonpath([top, os.path.realpath(full)]) == top
                try:
                    if inside:
                        os.unlink(full)
                    done.append(inside)
                except OSError:
                    done.append(False)
            yield pd.DataFrame({"path": batch["path"], "removed": done})

    return gone.select("path").mapInPandas(run, "path string, removed boolean")


def merge_move(source: str, target: str) -> int:
    """Moves a tree into another, file by file and each at once; of equal paths the one that comes last stays. What was a file
    and is a folder now, or the other way, gives way. Returns the number of files."""
    n = 0
    for folder, _, names in os.walk(source, followlinks=False):
        inner = os.path.relpath(folder, source)
        into = target if inner == "." else os.path.join(target, inner)
        if os.path.isfile(into):
            os.unlink(into)
        os.makedirs(into, exist_ok=True)
        for name in names:
            to = os.path.join(into, name)
            if os.path.isdir(to) and not os.path.islink(to):
                shutil.rmtree(to)
            os.replace(os.path.join(folder, name), to)
            n += 1
    shutil.rmtree(source, ignore_errors=True)
    return n


def copy_tree(source: str, target: str) -> int:
    """Copies a tree without version control, links, or anything that leads out of it; returns the number of files."""
    top, n = os.path.realpath(source), 0
    for folder, dirs, names in os.walk(source, followlinks=False):
        dirs[:] = [d for d in dirs if d != ".git"]
        for name in names:
            path = os.path.join(folder, name)
            if os.path.islink(path) or os.path.commonpath([top, os.path.realpath(path)]) != top:
                continue
            to = os.path.join(target, os.path.relpath(path, source))
            try:
                os.makedirs(os.path.dirname(to), exist_ok=True)
                shutil.copy2(path, to)
                n += 1
            except OSError:  # a name that is a file here and a folder there
                continue
    return n


def archive(folder: str) -> str:
    """Packs a folder as folder.tar.gz with sorted members and no times or owners, then removes it."""
    members = sorted(os.path.relpath(os.path.join(d, n), folder).replace(os.sep, "/") for d, _, names in os.walk(folder) for n in names)

    def plain(info: tarfile.TarInfo) -> tarfile.TarInfo:
        info.mtime = info.uid = info.gid = 0
        info.uname = info.gname = ""
        return info

    target = f"{folder}.tar.gz"
    with open(target + ".part", "wb") as f:
        with gzip.GzipFile(filename="", fileobj=f, mode="wb", mtime=0) as packed, tarfile.open(fileobj=packed, mode="w", format=tarfile.GNU_FORMAT) as tar:
            for name in members:
                tar.add(os.path.join(folder, name), arcname=name, recursive=False, filter=plain)
    os.replace(target + ".part", target)
    shutil.rmtree(folder)
    return target


def write(challenges: DataFrame, bodies: DataFrame, target: str, trees: str | None = None, packed: bool = False, slug=text.slug) -> DataFrame:
    """(id, dir, n_files, bytes, error) of challenges written under `target`, a shared folder. trees: where the folders of
    local_dir are. A challenge that fails has an error and nothing else fails; a rerun gives the same bytes. The write is
    committed as a whole: tasks that fail, or run twice, leave nothing behind."""
    rows = challenges.select("id", relpath(slug).alias("dir"), F.col("corpus_path").alias("local_dir"))
    notes = bodies.groupBy("id").agg(F.collect_list(F.struct("path", "body")).alias("notes"))
    return commit.write(rows.join(notes, "id", "left").repartition("id"), target, trees, packed)


def archived(challenges: DataFrame) -> DataFrame:
    """challenges that point at their archives; their manifests stay."""
    return challenges.withColumn("corpus_path", F.concat("corpus_path", F.lit(".tar.gz")))


def exportable(challenges: DataFrame) -> DataFrame:
    """Only what may be redistributed leaves the engine."""
    return challenges.where(F.coalesce("license.redistributable", F.lit(False)))
