"""The walk of large listings: one exchange of the listing, a large folder in parts, and odd rows."""

import re

from pyspark.sql import functions as F

from weir.operators import walk

LISTING = "tree string, path string, is_dir boolean, size long, sha256 string, lfs boolean, head string"


def rows(*found):
    return [(t, p, d, None if d else 1, None if d else "h", False, None) for t, p, d in found]


def large(spark, n):
    """A tree whose one challenge has n files in its folder, some below it, and a small tree."""
    path = F.concat(F.lit("web/one/f"), F.col("id").cast("string"), F.lit(".py"))
    files = spark.range(0, n, 1, 8).select(F.lit("o/big").alias("tree"), path.alias("path"), F.lit(False).alias("is_dir"), F.lit(1).cast("long").alias("size"), F.sha1("path").alias("sha256"), F.lit(False).alias("lfs"), F.lit(None).cast("string").alias("head"))
    other = rows(("o/big", "web", True), ("o/big", "web/one", True), ("o/big", "web/one/sub", True), ("o/big", "web/one/sub/x.py", False), ("o/s", "pwn", True), ("o/s", "pwn/a", True), ("o/s", "pwn/a/b.py", False))
    return files.unionByName(spark.createDataFrame(other, LISTING))


def test_a_folder_of_a_million_files(spark):
    n = 1_000_000
    found = walk.files_of(large(spark, n))
    chunks = walk.file_chunks(found).select("repo", "dir", "folder", "part", F.size("files").alias("n")).collect()
    big = [c.n for c in chunks if c.folder == "web/one"]
    assert len(big) == n // walk.CHUNK and sum(big) == n and max(big) < 1.1 * walk.CHUNK
    assert sorted((c.repo, c.dir, c.folder, c.n) for c in chunks if c.folder != "web/one") == [("o/big", "web/one", "web/one/sub", 1), ("o/s", "pwn/a", "pwn/a", 1)]


def test_the_listing_is_exchanged_once(spark, capsys):
    """From the staged listing to chunks: an exchange of the files, one of the folders they go to, none for the aggregation."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", -1)
    try:
        walk.file_chunks(walk.files_of(large(spark, 1_000))).explain("simple")
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    plan = capsys.readouterr().out
    keys = re.findall(r"Exchange hashpartitioning\((\w+)#\d+, (\w+)#\d+, (\w+)#\d+", plan)
    assert keys == [("repo", "folder", "part")] * 2 and plan.count("Exchange hashpartitioning") == 2, plan


def test_parts_give_the_same_records(spark, monkeypatch):
    seeds = spark.createDataFrame([("o/big", "sources", None, False), ("o/s", "sources", "MIT", True)], "repo string, kind string, license string, official boolean")
    commits = spark.createDataFrame([("o/s", "c")], "tree string, commit_sha string")
    made = []
    for chunk in (50_000, 7):
        monkeypatch.setattr(walk, "CHUNK", chunk)
        made.append(walk.records(large(spark, 100), seeds, commits).orderBy("title").collect())
    assert made[0] == made[1] and sorted(len(r.files) for r in made[0]) == [1, 101]
    assert [f.path for f in made[0][1].files] == sorted(f.path for f in made[0][1].files)


def test_odd_rows(spark):
    """A row without path, tree or kind; a file at the root; a repeated row, which stays; noise; a tree of nothing."""
    odd = rows(("o/a", "x.py", False), ("o/a", "x.py", False), ("o/a", "d/solve.txt", False), ("o/b", "node_modules", True), ("o/b", "node_modules/m.py", False), (None, "pwn/z.py", False))
    odd += [("o/c", None, None, None, None, None, None), ("o/a", "q", None, 1, "h", False, None)]
    tree = spark.createDataFrame(odd, LISTING)
    facts = {(r.tree, r.dir): (r.named, r.direct, r.deep, r.parts, r.marked) for r in walk.dir_facts(tree).collect()}
    no = False
    assert {k: v for k, v in facts.items() if k[0]} == {("o/a", ""): (no, True, True, no, no), ("o/a", "d"): facts["o/a", "d"], ("o/b", ""): (no,) * 5, ("o/c", ""): (no,) * 5}
    found = sorted((r.repo, r.dir, r.file.path) for r in walk.files_of(tree).where("repo is not null").collect())
    assert found == [("o/a", "", "d/solve.txt"), ("o/a", "", "x.py"), ("o/a", "", "x.py")]
    assert walk.files_of(tree.limit(0)).count() == 0 and walk.challenge_dirs(tree.limit(0)).count() == 0
