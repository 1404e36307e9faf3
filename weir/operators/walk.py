"""From file listings to challenge records: which directories are challenges, and what is in them.

A tree is segmented with aggregates and joins over (tree, directory), not by walking it: a directory qualifies by what its
files and sub-directories are, and the topmost qualifying directory of each path is a challenge. The listing is reduced to a row for
each folder first; it is exchanged itself only once, when files go to the challenge of their folder.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from weir import schema
from weir.functions import license, paths, text
from weir.sources.records import make, raw
from weir.stage import small, staged

MAX_METADATA_BYTES = 1 << 20
#: Files of one folder that are kept together; more are dealt to parts.
CHUNK = 50_000


def parent(path: Column) -> Column:
    return F.regexp_extract(path, "^(.*)/[^/]*$", 1)


def ancestors(path: Column, itself: bool = False) -> Column:
    """All directories above a path, the root "" first, and the path itself if asked for."""
    parts = F.split(path, "/")
    upto = F.size(parts) if itself else F.size(parts) - 1
    return F.transform(F.sequence(F.lit(0), upto), lambda i: F.array_join(F.slice(parts, F.lit(1), i), "/"))


def license_of_trees(tree: DataFrame, declared: DataFrame) -> DataFrame:
    """(tree, license): what is declared (tree, spdx) goes first, then the surest of the root's license files by name."""
    found = tree.where(~F.col("is_dir") & license.is_license_file(F.col("path"))).select("tree", F.col("path").alias("file"), "head", license.spdx_of_text(F.col("head")).alias("spdx"))
    best = found.groupBy("tree").agg(F.min(F.struct(F.col("spdx").isNull().alias("c"), "file", "head")).alias("best")).select("tree", license.from_text(F.col("best.head"), F.col("best.file")).alias("found"))
    named = declared.select("tree", F.when(license.from_spdx(F.col("spdx"))["spdx_id"].isNotNull(), license.from_spdx(F.col("spdx"))).alias("declared"))
    return tree.select("tree").distinct().join(named, "tree", "left").join(best, "tree", "left").select("tree", F.coalesce("declared", "found", license.unknown()).alias("license"))


def folders(tree: DataFrame) -> DataFrame:
    """(tree, dir, files, named, direct) of every folder that a listing (tree, path, is_dir) names or has a file in, and the root "" of
    every tree: how many files are right in it, whether one is a challenge.json, whether one is an artifact. The listing is read
    once and aggregated before it is exchanged; what follows works on folders."""
    at = F.when(F.col("is_dir"), F.col("path")).when(~F.col("is_dir"), parent(F.col("path")))
    rows = tree.select("tree", F.coalesce(at, F.lit("")).alias("dir"), F.when(~F.col("is_dir"), text.basename(F.col("path"))).alias("name"))
    told = rows.groupBy("tree", "dir").agg(F.count("name").alias("files"), F.bool_or(F.col("name") == "challenge.json").alias("named"), F.bool_or(paths.is_artifact(F.col("name"))).alias("direct"))
    return staged(told.select("tree", "dir", "files", F.coalesce("named", F.lit(False)).alias("named"), F.coalesce("direct", F.lit(False)).alias("direct")), "folders")


def dir_facts(tree: DataFrame) -> DataFrame:
    """(tree, dir, named, direct, deep, parts, marked) of every directory of a listing (tree, path, is_dir) that isn't noise; the
    root of a tree is "". named: it has a challenge.json; direct, deep: it or anything below has an artifact; parts: it has
    sub-directories, and all are components; marked: one of them marks a challenge's root."""
    return _facts(folders(tree))


def _facts(of: DataFrame) -> DataFrame:
    clean = of.where(~paths.has_noise(F.col("dir")))
    up = F.when(F.col("files") > 0, F.array_distinct(ancestors(F.col("dir"), True))).otherwise(F.array("dir"))
    above = clean.select("tree", F.col("dir").alias("below"), "named", "direct", F.explode(up).alias("dir"))
    itself = F.col("dir") == F.col("below")
    told = above.select("tree", "dir", (itself & F.col("named")).alias("named"), (itself & F.col("direct")).alias("direct"), F.col("direct").alias("deep"))
    no = F.lit(False)
    roots = of.select("tree", F.lit("").alias("dir"), no.alias("named"), no.alias("direct"), no.alias("deep"))
    every = staged(told.unionByName(roots).groupBy("tree", "dir").agg(*[F.bool_or(c).alias(c) for c in ("named", "direct", "deep")]), "facts")
    name = text.basename(F.col("dir"))
    subs = every.where("dir <> ''").groupBy("tree", parent(F.col("dir")).alias("dir")).agg(F.bool_and(paths.is_component(name)).alias("parts"), F.bool_or(paths.is_root_marker(name)).alias("marked"))
    return every.join(subs, ["tree", "dir"], "left").select("tree", "dir", "named", "direct", "deep", *[F.coalesce(c, no).alias(c) for c in ("parts", "marked")])


def challenge_dirs(tree: DataFrame) -> DataFrame:
    """(tree, dir) of every challenge directory in a listing (tree, path, is_dir); the root of a tree is ""."""
    return _challenges(folders(tree))


def _challenges(of: DataFrame) -> DataFrame:
    judged = staged(_facts(of).select("tree", "dir", "named", (F.col("direct") | ((F.col("parts") | F.col("marked")) & F.col("deep"))).alias("holds")), "judged")
    root = judged.where("dir = ''")
    # directories under a component of the root are parts of the root
    candidates = judged.where(F.col("dir") != "").where((F.col("named") | F.col("holds")) & ~paths.is_component(F.split_part("dir", F.lit("/"), F.lit(1))))
    above = candidates.select("tree", "dir", F.explode(F.filter(ancestors(F.col("dir")), lambda d: d != "")).alias("up"))
    covered = above.join(candidates.select("tree", F.col("dir").alias("up")), ["tree", "up"]).select("tree", "dir").distinct()
    leaves = candidates.join(covered, ["tree", "dir"], "left_anti").select("tree", "dir").join(root.where("named").select("tree"), "tree", "left_anti")
    alone = root.where("named").select("tree", "dir").unionByName(root.where("holds and not named").join(leaves.select("tree").distinct(), "tree", "left_anti").select("tree", "dir"))
    return leaves.unionByName(alone)


def placed_files(tree: DataFrame, of: DataFrame, dirs: DataFrame) -> DataFrame:
    """(repo, dir, folder, part, file) of every file in or below a challenge directory. tree: a staged listing; of: its folders();
    dirs: (repo, dir), none below another.

    A file goes where its folder goes, which is looked up among folders. The listing is exchanged once, by (repo, folder, part); a folder
    of over CHUNK files is dealt to parts by the hash of their paths, so that no task gets all of a large one."""
    above = of.where("files > 0").select(F.col("tree").alias("repo"), F.col("dir").alias("folder"), "files", F.explode(F.array_distinct(ancestors(F.col("dir"), True))).alias("dir"))
    home = staged(above.join(dirs.select("repo", "dir"), ["repo", "dir"]).select("repo", "folder", "dir", F.ceil(F.col("files") / CHUNK).cast("int").alias("parts")), "homes")
    large = small(home.where("parts > 1").select("repo", "folder", "parts"))
    path = F.col("path")
    listed = tree.where("not is_dir").select(F.col("tree").alias("repo"), parent(path).alias("folder"), "path", "size", "sha256", "lfs").join(large, ["repo", "folder"], "left")
    listed = listed.withColumn("part", F.coalesce(F.pmod(F.xxhash64("path"), "parts"), F.lit(0)).cast("int")).drop("parts")
    found = listed.join(home.select("repo", "folder", "dir", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)).alias("part")), ["repo", "folder", "part"])
    inside = F.when(F.col("dir") == "", path).otherwise(F.expr("substring(path, length(dir) + 2)"))
    file = make(schema.FILE, path=inside, sha256=F.col("sha256"), size=F.col("size"), is_source=text.is_source(inside), lfs=F.col("lfs"))
    return found.select("repo", "dir", "folder", "part", file.alias("file"))


def file_chunks(files: DataFrame) -> DataFrame:
    """(repo, dir, folder, part, files): placed files by folder and part, about CHUNK of them in a row at most, without another exchange."""
    return files.groupBy("repo", "folder", "part", "dir").agg(F.collect_list("file").alias("files"))


def files_of(tree: DataFrame) -> DataFrame:
    """(repo, dir, folder, part, file): the files of all challenges of a listing as rows, for challenges whose files are too many for an
    array in a record."""
    tree = staged(tree.where("path is not null"), "tree")
    of = folders(tree)
    return placed_files(tree, of, _challenges(of).withColumnRenamed("tree", "repo"))


def metadata(head: Column, size: Column) -> Column:
    """What a challenge.json holds, as a variant: an object with any fields. Null for one that is too large, no JSON, or no
    object; an object that names a field twice is no JSON here."""
    parsed = F.try_parse_json(F.when(size <= MAX_METADATA_BYTES, head))
    return F.when(F.startswith(F.schema_of_variant(parsed), F.lit("OBJECT")), parsed)


def told(meta: Column, path: str) -> Column:
    """A field of metadata as text, whatever its type; arrays and objects as JSON. Null where it says nothing: it is missing, null,
    false, zero or empty."""
    value = F.try_variant_get(meta, path, "variant")
    as_text, kind = F.try_variant_get(meta, path, "string"), F.schema_of_variant(value)
    nothing = F.when(kind == "STRING", as_text == "").otherwise(as_text.isin("false", "0", "[]", "{}") | F.coalesce(F.try_variant_get(meta, path, "double") == 0, F.lit(False)))
    return F.when(~nothing, as_text)


def records(tree: DataFrame, seeds: DataFrame, commits: DataFrame, retrieved_at: Column | None = None, limit: int | None = None) -> DataFrame:
    """Raw records of source trees (as read by `filetree` with heads "license,licence,copying,unlicense,challenge.json").

    seeds: repo, kind, license, official. commits: (tree, commit_sha). limit: challenges of one tree at most, in path order.
    """
    tree = staged(tree.where("path is not null"), "tree")
    of = folders(tree)
    dirs = _challenges(of).withColumnRenamed("tree", "repo")
    if limit is not None:
        dirs = dirs.withColumn("nth", F.row_number().over(Window.partitionBy("repo").orderBy("dir"))).where(F.col("nth") <= limit).drop("nth")
    meta = tree.where(~F.col("is_dir") & (text.basename(F.col("path")) == "challenge.json")).select(F.col("tree").alias("repo"), parent(F.col("path")).alias("dir"), metadata(F.col("head"), F.col("size")).alias("v"))
    meta = meta.select("repo", "dir", F.struct(*[told(F.col("v"), f"$.{x}").alias(x) for x in ("name", "category", "flag", "description")], F.col("v").alias("all")).alias("m"))
    dirs = staged(dirs, "dirs")
    licensed = license_of_trees(tree, seeds.select(F.col("repo").alias("tree"), F.col("license").alias("spdx"))).withColumnRenamed("tree", "repo").withColumnRenamed("license", "repo_license")
    licensed = staged(licensed, "licenses")
    named = dirs.join(meta, ["repo", "dir"], "left").join(licensed, "repo", "left").join(commits.withColumnRenamed("tree", "repo"), "repo", "left").join(seeds.select("repo", "kind", "official"), "repo", "left")
    segments = F.when(F.col("dir") == "", F.array().cast("array<string>")).otherwise(F.split("dir", "/"))
    named = staged(paths.derive(named.withColumn("__segments", segments), "__segments", "m.name", "m.category"), "derived")
    found = {c: F.col(c) for c in ("title", "event_name", "edition", "year", "raw_category")}
    origin, short = paths.origin_of_repo(F.col("repo")), F.element_at(F.split("repo", "/"), -1)
    src = make(
        schema.SOURCE, origin=origin, url=F.concat(F.lit("https://github.com/"), F.col("repo")), repo=F.col("repo"), commit_sha=F.col("commit_sha"),
        path_in_repo=F.when(F.col("dir") == "", ".").otherwise(F.col("dir")), license=F.col("repo_license"), retrieved_at=F.lit(None) if retrieved_at is None else retrieved_at,
        is_official=F.coalesce("official", F.lit(False)),
    )
    chunks = file_chunks(placed_files(tree, of, dirs))
    held = chunks.groupBy("repo", "dir").agg(F.array_sort(F.flatten(F.collect_list("files"))).alias("files"))
    full = named.join(held, ["repo", "dir"], "left")
    return raw(
        full, origin=origin, title=F.when(F.col("dir") == "", F.coalesce(F.nullif(F.col("m.name"), F.lit("")), short)).otherwise(found["title"]),
        event_name=F.coalesce(found["event_name"], F.when(origin == "google_ctf", "Google CTF").otherwise(F.regexp_extract("repo", "^[^/]*/?(.*)$", 1))), edition=found["edition"],
        year=found["year"], raw_category=found["raw_category"], description=F.col("m.description"), flag=F.col("m.flag"),
        local_dir=F.concat_ws("/", F.col("repo"), F.nullif(F.col("dir"), F.lit(""))), files=F.coalesce("files", F.array().cast(schema.RAW["files"].dataType)), source=src,
        extra=F.to_json(F.struct("kind", F.col("m.all").alias("challenge_json"), F.col("dir").alias("path_in_repo"))),
    )
