"""`filetree`: filters that it takes, folders that it doesn't enter, and large trees in several partitions."""

import os

import pytest
from pyspark.sql.datasource import EqualTo, GreaterThan, In, IsNull, LessThanOrEqual, Not, StringContains, StringEndsWith, StringStartsWith

from weir.sources import trees

WHERE = [
    "not is_dir", "is_dir", "tree = 'a/x' and size > 10", "tree in ('b/y', 'c')", "tree <> 'a/x'", "path like 'd1/%'", "path = 'd1/e1/f1.txt'", "path in ('d1/e1/f1.txt', 'd2', null)", "not (path like '%.txt')",
    "path like '%e1%'", "size is null", "not (size is null)", "size <= 3 or size > 30", "sha256 is not null and size <> 3", "path like 'd%' and not path like 'd1%' and size >= 5", "error is null", "path is null",
]


@pytest.fixture(scope="module")
def folder(tmp_path_factory):
    top = tmp_path_factory.mktemp("checkouts")
    for r in ("a__x", "b__y"):
        for k in range(40):
            to = top / r / f"d{k % 5}" / f"e{k % 3}"
            to.mkdir(parents=True, exist_ok=True)
            (to / f"f{k}.txt").write_text("z" * k)
        (top / r / ".git").mkdir()
        (top / r / ".git/config").write_text("no")
        (top / r / "empty").mkdir()
        os.symlink("/etc", top / r / "link")
        os.symlink("/etc/passwd", top / r / "d1/link.txt")
    return str(top)


def test_filters_give_what_spark_would(spark, folder):
    plain = trees.read_tree(spark, folder, checkouts="true", splits=1).collect()
    assert len(plain) == 2 * (40 + 5 + 15 + 1)
    spark.createDataFrame(plain, trees.TREE).createOrReplaceTempView("plain_tree")
    trees.read_tree(spark, folder, checkouts="true").createOrReplaceTempView("pushed_tree")
    for where in WHERE:
        got, want = (sorted(map(str, spark.sql(f"select * from {t} where {where}").collect())) for t in ("pushed_tree", "plain_tree"))
        assert got == want, where


def test_the_plan_lists_them(spark, folder, capsys):
    df = trees.read_tree(spark, folder, checkouts="true").where("tree = 'a/x' and size > 10 and lfs")
    df.explain("formatted")
    pushed = next(x for x in capsys.readouterr().out.splitlines() if x.startswith("PushedFilters"))
    assert "EqualTo(tree,a/x)" in pushed and "GreaterThan(size,10)" in pushed and "EqualTo(lfs" not in pushed


def reader(folder, filters=(), **options):
    made = trees.TreeReader({"path": folder, "checkouts": "true", **options})
    return made, list(made.pushFilters(list(filters)))


def rows(made):
    return [r for p in made.partitions() for b in made.read(p) for r in b.to_pylist()]


def test_only_what_passes_is_hashed(folder, monkeypatch):
    hashed, entered = [], []
    monkeypatch.setattr(trees, "sha256_of", lambda path: hashed.append(path) or "h")
    real = os.walk
    monkeypatch.setattr(trees.os, "walk", lambda top, **kw: (entered.append(x[0]) or x for x in real(top, **kw)))
    made, left = reader(folder, [EqualTo(("tree",), "a/x"), StringStartsWith(("path",), "d1/e1/"), GreaterThan(("size",), 10), EqualTo(("lfs",), True), Not(StringEndsWith(("path",), "1.txt"))])
    assert [type(f.attribute) for f in left] == [tuple] and left[0].attribute == ("lfs",)
    assert {os.path.basename(x["path"]) for x in rows(made)} == {"f16.txt"} and [os.path.basename(p) for p in hashed] == ["f16.txt"]
    assert all("a__x" in e and e.rstrip("/").endswith(("a__x", "d1", "e1")) for e in entered)
    made, _ = reader(folder, [In(("path",), ["d2/e2/f2.txt", "d3"]), Not(IsNull(("size",))), LessThanOrEqual(("size",), 2), StringContains(("path",), "/")])
    assert {(x["tree"], x["path"]) for x in rows(made)} == {("a/x", "d2/e2/f2.txt"), ("b/y", "d2/e2/f2.txt")}


def test_a_large_tree_in_several_partitions(spark, tmp_path):
    """10,000 files in one folder and some below others, as one tree: each file comes once, from bounded partitions."""
    for k in range(10_000):
        if k % 500 == 0:
            (tmp_path / f"sub{k}/deep").mkdir(parents=True)
        (tmp_path / (f"sub{k // 500 * 500}/deep" if k % 10 == 0 else "") / f"f{k}").touch()
    df = trees.read_tree(spark, str(tmp_path), partFiles=1_000, splits=12, hash="false")
    assert df.rdd.getNumPartitions() >= 12
    made = trees.TreeReader({"path": str(tmp_path), "partFiles": "1000", "splits": "12", "hash": "false"})
    sizes = [sum(b.num_rows for b in made.read(p)) for p in made.partitions()]
    assert sum(sizes) == 10_000 + 40 and max(sizes) < 1_200
    assert df.where("not is_dir").select("path").distinct().count() == 10_000
    assert trees.read_tree(spark, str(tmp_path)).where("path like 'sub500/%' and not is_dir").count() == 50


def test_what_cant_be_read_says_so(spark, tmp_path, monkeypatch):
    (tmp_path / "a").mkdir()
    made = trees.TreeReader({"path": str(tmp_path / "gone")})
    assert [(r["path"], r["error"] is not None) for r in rows(made)] == [(None, True)]
    assert trees.read_tree(spark, str(tmp_path / "gone")).where("path is not null").count() == 0
    assert trees.read_tree(spark, str(tmp_path), checkouts="true").count() == 0
