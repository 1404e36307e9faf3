"""Command line: python -m weir.cli list | ingest | discover | mirror | publish | stats | discovered | summary."""

from __future__ import annotations

import argparse
import json
import os
import sys
from datetime import date

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from weir.acquire import client
from weir.operators import catalog, discovery
from weir.plans import ingest
from weir.sinks import catalog as sink
from weir.sources import records
from weir.streaming import mirror


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="weir")
    sub = p.add_subparsers(dest="cmd", required=True)
    sub.add_parser("list", help="registered sources")
    one = sub.add_parser("ingest", help="read a source and write its shard")
    for name in ("source", "path", "out"):
        one.add_argument(name)
    one.add_argument("--parquet", action="store_true")
    one.add_argument("--option", action="append", default=[], metavar="NAME=VALUE", help="an option of the source")
    find = sub.add_parser("discover", help="candidates from recorded search pages")
    for name in ("pages", "out"):
        find.add_argument(name)
    find.add_argument("--seeds")
    find.add_argument("--max-repos", type=int)
    many = sub.add_parser("mirror", help="check out, stage and publish repositories, batch by batch")
    many.add_argument("out")
    many.add_argument("--source", default="seeds", choices=["seeds", "discovered", "both"])
    for name in ("seeds", "discovered", "checkouts"):
        many.add_argument(f"--{name}")
    many.add_argument("--only", action="append")
    many.add_argument("--batch-size", type=int, default=50)
    many.add_argument("--batch-mb", type=float, default=8_000)
    many.add_argument("--max-repo-mb", type=int, default=4_096)
    send = sub.add_parser("publish", help="say what would be published")
    send.add_argument("folder")
    send.add_argument("--dataset", required=True)
    what = send.add_mutually_exclusive_group()
    what.add_argument("--catalog-only", action="store_true")
    what.add_argument("--corpus-only", action="store_true")
    for name in ("stats", "discovered", "summary"):
        sub.add_parser(name).add_argument("path")
    return p


def run_mirror(spark: SparkSession, args) -> int:
    seeds = records.read_seeds(spark, args.seeds) if args.seeds else spark.createDataFrame([], records.schema.SEED)
    candidates = records.read_candidates(spark, args.discovered) if args.discovered else None
    known = seeds if candidates is None else records.discovered_seeds(seeds, candidates, max_mb=args.max_repo_mb)
    repos = ingest.pending(ingest.resolve(spark, args.source, seeds, candidates, args.only), ingest.read_manifest(spark, f"{args.out}/manifest"))
    sizes = (candidates if candidates is not None else spark.createDataFrame([], records.schema.CANDIDATE)).select(F.col("full_name").alias("repo"), "size_kb")
    n = mirror.request_batches(repos, sizes, f"{args.out}/requests", args.batch_size, args.batch_mb)
    if args.checkouts:
        commits = records_commits(spark, args.checkouts)
        stage = mirror.stage_trees(spark, args.checkouts, known, commits)
    else:
        stage = mirror.stage_clones(spark, f"{args.out}/raw", known, client.clone, candidates, args.max_repo_mb, f"{args.out}/corpus")
    if n:
        mirror.mirror(spark, f"{args.out}/requests", stage, lambda rows, batch: None, f"{args.out}/manifest", f"{args.out}/catalog", f"{args.out}/checkpoint-{os.getpid()}", 1, True)
    return summary(spark, f"{args.out}/manifest")


def records_commits(spark: SparkSession, path: str):
    from weir.sources.trees import heads_of_commits

    return heads_of_commits(spark, path)


def summary(spark: SparkSession, path: str) -> int:
    for r in ingest.mirror_summary(ingest.read_manifest(spark, path)).orderBy(F.col("repos").desc(), "status").collect():
        print(json.dumps(r.asDict()))
    return 0


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> int:
    args = parser().parse_args(argv)
    if args.cmd == "list":
        print("\n".join(sorted(records.REGISTRY)))
        return 0
    if args.cmd == "publish":
        kinds = [("catalog", ".jsonl")] * (not args.corpus_only) + [("corpus", None)] * (not args.catalog_only)
        for kind, only in kinds:
            print(f"{kind}: {client.publish(os.path.join(args.folder, kind), args.dataset, only=only)}")
        return 0
    if args.cmd == "ingest" and args.source not in records.REGISTRY:
        print(f"unknown source {args.source!r}; known: {', '.join(sorted(records.REGISTRY))}")
        return 1
    spark = spark or SparkSession.builder.appName("weir").config("spark.sql.session.timeZone", "UTC").getOrCreate()
    if args.cmd == "ingest":
        options = dict(x.split("=", 1) for x in args.option)
        print(f"{ingest.ingest_source(spark, args.source, args.out, args.parquet, path=args.path, **options).count()} challenges")
    elif args.cmd == "discover":
        found = records.read_search_pages(spark, args.pages).withColumnRenamed("page", "query_pos")
        seeds = records.read_seeds(spark, args.seeds) if args.seeds else spark.createDataFrame([], records.schema.SEED)
        made = discovery.union_found(found, seeds, args.max_repos)
        sink.write_candidates(made, args.out)
        print(f"{records.read_candidates(spark, args.out).count()} repositories on {date.today().isoformat()}")
    elif args.cmd == "mirror":
        return run_mirror(spark, args)
    elif args.cmd == "stats":
        done = records.read_checked(spark, args.path)
        df, left = done.rows, {k: done.counts[k] for k in records.REASONS if done.counts[k]}
        if left:
            print(f"lines left out: {json.dumps(left)}", file=sys.stderr)
        print(json.dumps(catalog.stats(df).first().asDict()))
        for r in catalog.counts(df, "category").collect():
            print(f"{r['category']}\t{r['n']}")
    elif args.cmd == "discovered":
        for r in catalog.counts(records.read_candidates(spark, args.path), "kind").collect():
            print(f"{r['kind']}\t{r['n']}")
    else:
        return summary(spark, args.path)
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
