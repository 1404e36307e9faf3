"""Mirroring end to end over checkouts on disk: isolation, commands, corpus actions and fetching."""

import json
import os

import pytest
from pyspark.sql import functions as F

from weir import cli, schema
from weir.acquire import client
from weir.operators import discovery
from weir.plans import ingest
from weir.sinks import corpus
from weir.sources import records, trees
from weir.stage import numbered
from weir.streaming import mirror

FILES = {"2021/Cup/pwn/one/chal.py": "print(1)", "2021/Cup/web/two/public/i.js": "js", "LICENSE": "Mozilla Public License Version 2.0", ".git/HEAD": "ref: refs/heads/main\n", ".git/packed-refs": "# pack\nabc123 refs/heads/main\n"}


def checkout(root, repo, files=FILES):
    for name, body in files.items():
        path = os.path.join(root, repo.replace("/", "__"), name)
        os.makedirs(os.path.dirname(path), exist_ok=True)
        with open(path, "w") as f:
            f.write(body)
    return os.path.join(root, repo.replace("/", "__")), "abc123"


def seeds_of(spark, *repos):
    return spark.createDataFrame([(i, "s", r, "sources", None, False, None, None) for i, r in enumerate(repos)], schema.SEED)


def test_isolation_and_archives(spark, tmp_path):
    """One repository fails to clone, one is too big, one is fine; the checkouts are gone in the end, the archives are there."""

    def clone(repo, folder):
        if repo == "o/bad":
            raise client.MirrorError("gone")
        return checkout(folder, repo)

    candidates = spark.createDataFrame([("o/big", 9_000_000)], "full_name string, size_kb long")
    batch = spark.createDataFrame([("o/good",), ("o/bad",), ("o/big",)], "repo string")
    stage = mirror.stage_clones(spark, str(tmp_path / "raw"), seeds_of(spark, "o/good"), clone, candidates, 100, str(tmp_path / "corpus"), floor=0)
    results, made = stage(batch)
    assert {r["repo"]: (r["status"], r["n_challenges"]) for r in results.collect()} == {"o/good": ("staged", 2), "o/bad": ("failed", 0), "o/big": ("too_big", 0)}
    paths = [r["corpus_path"] for r in made.collect()]
    assert len(paths) == 2 and all(p.endswith(".tar.gz") and (tmp_path / p).exists() for p in paths)
    assert os.listdir(tmp_path / "raw") == []
    low = mirror.acquire(["o/good"], str(tmp_path / "raw"), clone, floor=1 << 60)
    assert low[0][2] == "skipped" and "low disk" in low[0][3]


def test_unreadable_tree_fails_alone(spark, tmp_path, monkeypatch):
    for repo in ("o/a", "o/b"):
        checkout(str(tmp_path), repo)
    reader = trees.TreeReader({"path": str(tmp_path), "checkouts": "true"})
    real = trees.sha256_of

    def broken(path):
        if "o__b" in path:
            raise OSError("disk")
        return real(path)

    monkeypatch.setattr(trees, "sha256_of", broken)
    rows = [r for p in reader.partitions() for b in reader.read(p) for r in b.to_pylist()]
    assert {r["tree"] for r in rows if r["error"]} == {"o/b"} and sum(r["tree"] == "o/a" and not r["is_dir"] for r in rows) == 3
    assert {r["tree"]: r["commit_sha"] for r in trees.heads_of_commits(spark, str(tmp_path)).collect()} == {"o/a": "abc123", "o/b": "abc123"}


def test_commands(spark, tmp_path, capsys):
    root = tmp_path / "checkouts"
    for i in range(3):
        checkout(str(root), f"o/r{i}", FILES | {"2021/Cup/pwn/one/chal.py": f"print({i})"})
    (tmp_path / "seeds.yaml").write_text("official_sources:\n" + "".join(f"- {{repo: o/r{i}}}\n" for i in range(4)))
    out = str(tmp_path / "out")
    assert cli.main(["mirror", out, "--seeds", str(tmp_path / "seeds.yaml"), "--checkouts", str(root), "--batch-size", "2"], spark) == 0
    said = [json.loads(x) for x in capsys.readouterr().out.splitlines() if x.startswith("{")]
    assert {r["status"]: r["repos"] for r in said} == {"ok": 3, "failed": 1}
    manifest = ingest.read_manifest(spark, f"{out}/manifest")
    assert cli.main(["mirror", out, "--seeds", str(tmp_path / "seeds.yaml"), "--checkouts", str(root)], spark) == 0  # only the failed one is asked again
    assert sorted(r["repo"] for r in ingest.read_manifest(spark, f"{out}/manifest").collect()) == ["o/r0", "o/r1", "o/r2", "o/r3", "o/r3"] and manifest.count() >= 4
    assert cli.main(["ingest", "checkouts", str(root), f"{out}/shard", "--option", f"seeds={tmp_path / 'seeds.yaml'}"], spark) == 0
    assert cli.main(["stats", f"{out}/shard/checkouts.jsonl"], spark) == 0 and "whitebox" in capsys.readouterr().out
    item = {"full_name": "me/ctf-writeups", "stargazers_count": 3, "topics": ["ctf"], "license": {"spdx_id": "MIT"}, "size": 5}
    (tmp_path / "p.json").write_text(json.dumps({"total_count": 1, "items": [item]}))
    assert cli.main(["discover", str(tmp_path / "p.json"), f"{out}/found"], spark) == 0 and cli.main(["discovered", f"{out}/found"], spark) == 0
    assert cli.main(["publish", out, "--dataset", "d", "--catalog-only"], spark) == 0 and "catalog: " in capsys.readouterr().out
    assert cli.main(["ingest", "nope", "x", "y"], spark) == 1
    with pytest.raises(SystemExit):
        cli.main(["publish", out, "--dataset", "d", "--catalog-only", "--corpus-only"], spark)


def test_prune_stays_inside(spark, tmp_path):
    (tmp_path / "c").mkdir()
    (tmp_path / "c/x").write_text("1")
    (tmp_path / "keep").write_text("1")
    gone = corpus.prune(str(tmp_path / "c"), spark.createDataFrame([("x",), ("../keep",), ("none",)], "path string"))
    assert {r["path"]: r["removed"] for r in gone.collect()} == {"x": True, "../keep": False, "none": False}
    assert (tmp_path / "keep").exists() and not (tmp_path / "c/x").exists()


def test_merge_move_conflicts(tmp_path):
    for name, body in {"a/d/f": "1", "b/d": "2", "c/d/g": "3"}.items():
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text(body)
    for turn in "abc":
        corpus.merge_move(str(tmp_path / turn), str(tmp_path / "all"))
    assert (tmp_path / "all/d/g").read_text() == "3" and not (tmp_path / "a").exists()


def test_flush_batches(spark):
    rows = spark.createDataFrame([(i, 30 if i % 3 else None) for i in range(20)], "pos long, bytes long")
    got = [r["batch"] for r in ingest.flushes(rows, 4, 80 / 1e6).orderBy("pos").collect()]
    want, batch, n, size = [], 0, 0, 0
    for i in range(20):
        want.append(batch)
        n, size = n + 1, size + (30 if i % 3 else 0)
        if n >= 4 or size >= 80:
            batch, n, size = batch + 1, 0, 0
    assert got == want


def test_numbers_and_unknown_sizes(spark):
    df = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("x"))
    assert all(r["n"] == r["x"] for r in numbered(df, ["x"], "n").collect())
    found = spark.createDataFrame([("a/x", "k", None), ("a/y", "k", 10**9), ("a/z", "k", 5)], "full_name string, kind string, size_kb long")
    assert sorted(r["repo"] for r in records.discovered_seeds(seeds_of(spark), found).collect()) == ["a/x", "a/z"]
    assert discovery.day_leaves(spark.createDataFrame([], "day date, n long")).count() == 0
