"""Merging against a small model of its own, tree walks, files, corpus and sinks."""

import hashlib
import json
import os
import random
import tarfile

import pytest
from pyspark.sql import functions as F

from weir import schema
from weir.operators import catalog, walk
from weir.plans import ingest
from weir.sinks import catalog as sink
from weir.sinks import corpus
from weir.sources import records
from weir.sources.trees import TREE, read_tree


def model(rows):
    """Clusters in order of first sight; each as (canonical, sources, writeups)."""
    clusters = {}
    for r in rows:
        clusters.setdefault(r["fp"] or f"none:{r['id']}", []).append(r)
    out = []
    for members in clusters.values():
        trust = lambda s: (s[1], catalog.AUTHORITY.get(s[0], 0))
        best = max(range(len(members)), key=lambda i: (max(map(trust, members[i]["sources"]), default=(0, 0)), -i))
        top = members[best]
        sources, notes = list(top["sources"]), list(top["writeups"])
        for m in members[:best] + members[best + 1 :]:
            for s in m["sources"]:
                if (s[0], s[2]) not in {(x[0], x[2]) for x in sources}:
                    sources.append(s)
            for w in m["writeups"]:
                if w not in notes:
                    notes.append(w)
        if len(members) > 1:
            sources = sorted(sources, key=lambda s: (-s[1], -catalog.AUTHORITY.get(s[0], 0)))
        out.append((top["id"], sources, notes))
    return out


def test_merge_model(spark):
    rng, rows = random.Random(3), []
    for i in range(300):
        pick = lambda: (rng.choice(["github", "ctftime", "hackropole", "picoctf"]), rng.randint(0, 1), f"r{rng.randint(0, 3)}")
        rows.append({"pos": i, "id": f"i{rng.randint(0, 250)}", "fp": rng.choice([None, *"abcdefgh"]), "sources": [pick() for _ in range(rng.randint(0, 3))], "writeups": [("github", rng.choice([None, "http://x/1", "http://x/2"])) for _ in range(rng.randint(0, 2))]})
    df = spark.createDataFrame([(r["pos"], r["id"], r["fp"], r["sources"], r["writeups"]) for r in rows], "input_pos long, id string, content_fingerprint string, s array<struct<o:string,b:int,r:string>>, w array<struct<o:string,u:string>>")
    src = F.transform("s", lambda s: records.make(schema.SOURCE, origin=s["o"], is_official=s["b"] == 1, repo=s["r"]))
    notes = F.transform("w", lambda w: records.make(schema.WRITEUP, origin=w["o"], url=w["u"]))
    challenges = df.select("input_pos", "id", "content_fingerprint", src.alias("sources"), notes.alias("writeups"), records.make(schema.LICENSE).alias("license"))
    got = catalog.merge(challenges)[0].orderBy("input_pos").collect()
    assert [(r["id"], [(s["origin"], int(s["is_official"]), s["repo"]) for s in r["sources"]], [(w["origin"], w["url"]) for w in r["writeups"]]) for r in got] == model(rows)


def test_tree(spark, tmp_path):
    root = tmp_path / "repos" / "me__arch"
    files = {"2021/Cup/pwn/baby/chal.py": "print(1)", "2021/Cup/pwn/baby/.hidden": "h", "2021/Cup/pwn/baby/_x": "u", "2021/Cup/pwn/baby/solve.py": "s", "2021/Cup/web/a/public/i.js": "j", "2021/Cup/web/a/private/k.py": "k", ".git/config": "no", "LICENSE": "Apache License\nVersion 2.0", "tool.py": "t", "2021/Cup/misc/m/challenge.json": json.dumps({"name": "Em", "category": "crypto", "flag": "F{x}"})}
    for name, body in files.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text(body)
    os.symlink("/etc/passwd", root / "2021/Cup/pwn/baby/leak.py")
    tree = read_tree(spark, str(tmp_path / "repos"), checkouts="true", heads="license,licence,copying,unlicense,challenge.json")
    tree = spark.createDataFrame(tree.collect(), TREE)
    listed = {r["path"]: r for r in tree.where("not is_dir").collect()}
    assert set(listed) == set(files) - {".git/config"}
    assert listed["tool.py"]["sha256"] == hashlib.sha256(b"t").hexdigest()
    dirs = {r["dir"] for r in walk.challenge_dirs(tree.select("tree", "path", "is_dir")).collect()}
    assert dirs == {"2021/Cup/pwn/baby", "2021/Cup/web/a", "2021/Cup/misc/m"}
    shutil_copy = tmp_path / "copied"
    assert corpus.copy_tree(str(root), str(shutil_copy)) == len(files) - 1 and not (shutil_copy / ".git").exists()
    sums = []
    for turn in "ab":
        corpus.copy_tree(str(root / "2021/Cup/pwn/baby"), str(tmp_path / turn))
        path = corpus.archive(str(tmp_path / turn))
        with tarfile.open(path) as tar:
            assert tar.getnames() == [".hidden", "_x", "chal.py", "solve.py"]
        sums.append(hashlib.sha256(open(path, "rb").read()).hexdigest())
    assert sums[0] == sums[1] and not (tmp_path / "a").exists()



def test_sinks(spark, tmp_path):
    raw = records.raw(spark.createDataFrame([("T", "web"), ("U", None)], "t string, c string"), origin=F.lit("github"), title=F.col("t"), raw_category=F.col("c"))
    made = catalog.normalize(raw)
    sink.write_jsonl(made, str(tmp_path / "c.jsonl"), single=True)
    text = next((tmp_path / "c.jsonl").glob("part-*")).read_text().splitlines()
    assert len(text) == 2 and all("null" not in x and '"files":[]' in x for x in text)
    back = records.read_catalog(spark, str(tmp_path / "c.jsonl"))
    assert sorted(r["id"] for r in back.collect()) == sorted(r["id"] for r in made.collect())
    sink.write_parquet(made.limit(0), str(tmp_path / "p"))
    assert spark.read.parquet(str(tmp_path / "p")).columns == schema.CHALLENGE.names
    both = back.withColumns({"shard_pos": F.lit(0), "row_pos": F.lit(0)}).unionByName(back.withColumns({"shard_pos": F.lit(1), "row_pos": F.lit(0), "title": F.lit("new")}))
    assert {r["title"] for r in catalog.upsert(both).collect()} == {"new"}
    assert catalog.invalid(made.withColumn("category", F.lit("nope"))).count() == 2 and catalog.invalid(made).count() == 0
    assert records.read_candidates(spark, str(tmp_path / "none")).count() == 0


def test_yaml_and_sitemap(spark, tmp_path):
    (tmp_path / "c.yml").write_text("- {name: A, category: XSS, difficulty: 3, tags: 'x, y', mitigationUrl: 'https://m'}\n- {category: x}\n- 5\n- {name: B, tags: [p, ' ']}\n")
    got = records.yaml_list(spark, str(tmp_path / "c.yml")).collect()
    assert [(r["title"], r["tags"], r["difficulty"], [w["title"] for w in r["writeups"]]) for r in got] == [("A", ["x", "y"], "3", ["Mitigation"]), ("B", ["p"], None, [])]
    locs = ["https://h/en/challenges/a/", "https://h/en/about/", "https://h/en/challenges/b/", "https://h/en/challenges/a/"]
    (tmp_path / "s.xml").write_text("<urlset>" + "".join(f"<url><loc>{x}</loc></url>" for x in locs) + "</urlset>")
    assert [r["url"] for r in records.read_sitemap(spark, str(tmp_path / "s.xml")).orderBy("pos").collect()] == [locs[0], locs[2]]
    with pytest.raises(ValueError):
        ingest.ingest_source(spark, "nope", str(tmp_path))


def test_search_pages_and_seeds(spark, tmp_path):
    item = {"full_name": "me/ctf-writeups", "stargazers_count": 3, "topics": ["ctf"], "license": {"spdx_id": "NOASSERTION"}, "size": 5, "pushed_at": "2024-01-01T00:00:00Z"}
    (tmp_path / "p.json").write_text(json.dumps({"total_count": 1, "items": [item]}))
    c = records.read_search_pages(spark, str(tmp_path / "p.json")).first()
    assert (c["html_url"], c["license_spdx"], c["kind"], c["stars"]) == ("https://github.com/me/ctf-writeups", None, "writeups", 3)
    (tmp_path / "s.yaml").write_text("writeup_archives:\n- {repo: z/z}\nofficial_sources:\n- {repo: a/a, official: true}\n- 3\n")
    seeds = records.read_seeds(spark, str(tmp_path / "s.yaml"))
    assert [r["repo"] for r in seeds.orderBy("pos").collect()] == ["a/a", "z/z"]
    found = records.read_search_pages(spark, str(tmp_path / "p.json")).drop("page", "pos")
    assert [r["repo"] for r in records.discovered_seeds(seeds, found).orderBy("pos").collect()] == ["a/a", "z/z", "me/ctf-writeups"]
