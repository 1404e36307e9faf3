"""File trees as a Spark source: `filetree` reads one folder, or each folder of a folder of checkouts as a partition.

Spark's own binary source leaves out names that begin with a point or an underscore and follows links; this one lists every
file, never follows a link, never leaves the root, and hashes a file in pieces, so that a file need not fit in a row.
"""

from __future__ import annotations

import hashlib
import os
from collections import deque
from collections.abc import Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import (
    DataSource,
    DataSourceReader,
    EqualTo,
    Filter,
    GreaterThan,
    GreaterThanOrEqual,
    In,
    InputPartition,
    IsNotNull,
    IsNull,
    LessThan,
    LessThanOrEqual,
    Not,
    StringContains,
    StringEndsWith,
    StringStartsWith,
)
from pyspark.sql.types import BooleanType, LongType, StringType, StructField, StructType

CHUNK = 1 << 20
LFS_BYTES = 50 * 1024 * 1024
#: Bytes of a text file that are read at most.
HEAD_BYTES = 1 << 20
BATCH = 1_024
#: Partitions that a few large trees are cut into, and files of one folder in a partition.
SPLITS, PART_FILES = 64, 20_000

TREE = StructType(
    [
        StructField("tree", StringType()),
        StructField("path", StringType()),
        StructField("is_dir", BooleanType()),
        StructField("size", LongType()),
        StructField("sha256", StringType()),
        StructField("lfs", BooleanType()),
        StructField("head", StringType()),
        StructField("error", StringType()),
    ]
)


def sha256_of(path: str) -> str:
    digest = hashlib.sha256()
    with open(path, "rb") as f:
        while piece := f.read(CHUNK):
            digest.update(piece)
    return digest.hexdigest()


def head_of(path: str, limit: int = HEAD_BYTES) -> str:
    """The beginning of a file as text; bytes that are no text become replacement characters."""
    with open(path, "rb") as f:
        return f.read(limit).decode("utf-8", "replace")


class TreePartition(InputPartition):
    """A folder of a tree: with all below it, or (`shallow`) its own files alone, of these the part-th of `parts` by name."""

    def __init__(self, tree: str, root: str, inner: str = "", shallow: bool = False, part: int = 0, parts: int = 1):
        self.tree, self.root, self.inner, self.shallow, self.part, self.parts = tree, root, inner, shallow, part, parts


def _compare(f: Filter, value: object) -> bool:
    """Whether a value passes a filter; a null passes none but IsNull, as in SQL."""
    if isinstance(f, IsNull):
        return value is None
    if value is None:
        return False
    checks = {
        IsNotNull: lambda: True, EqualTo: lambda: value == f.value, In: lambda: value in f.value, GreaterThan: lambda: value > f.value, GreaterThanOrEqual: lambda: value >= f.value,
        LessThan: lambda: value < f.value, LessThanOrEqual: lambda: value <= f.value, StringStartsWith: lambda: value.startswith(f.value), StringEndsWith: lambda: value.endswith(f.value),
        StringContains: lambda: f.value in value,
    }
    return checks[type(f)]()


#: Filters that a reader applies itself; on path and tree as text, on size as a number.
PUSHED = (IsNull, IsNotNull, EqualTo, In, GreaterThan, GreaterThanOrEqual, LessThan, LessThanOrEqual, StringStartsWith, StringEndsWith, StringContains)
CHEAP = ("tree", "path", "is_dir", "size")


class TreeReader(DataSourceReader):
    def __init__(self, options: dict):
        self.root = options.get("path") or options["root"]
        self.many = str(options.get("checkouts", "false")).lower() == "true"
        self.hashed = str(options.get("hash", "true")).lower() == "true"
        self.size_cap = int(options.get("sizecap", options.get("sizeCap", LFS_BYTES)))
        self.heads = tuple(x for x in str(options.get("heads", "")).lower().split(",") if x)
        self.only = {x for x in str(options.get("only", "")).split(",") if x}
        self.splits, self.part_files = int(options.get("splits", SPLITS)), int(options.get("partfiles", options.get("partFiles", PART_FILES)))
        self.filters: list[tuple[str, Filter, bool]] = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        """Takes comparisons of tree, path, is_dir and size, and their negations; the others stay with Spark."""
        for f in filters:
            inner, turned = (f.child, True) if isinstance(f, Not) else (f, False)
            if isinstance(inner, PUSHED) and len(inner.attribute) == 1 and inner.attribute[0] in CHEAP and None not in (inner.value if isinstance(inner, In) else (getattr(inner, "value", 0),)):
                self.filters.append((inner.attribute[0], inner, turned))
            else:
                yield f

    def _passes(self, **known: object) -> bool:
        """Whether what is known of a row passes; a negated comparison with null doesn't, one with IsNull is its opposite."""
        for name, f, turned in self.filters:
            if name in known:
                value = known[name]
                if turned and value is None and not isinstance(f, (IsNull, IsNotNull)) or _compare(f, value) == turned:
                    return False
        return True

    def _may_hold(self, inner: str) -> bool:
        """Whether a folder can have a path in it that passes: what a path must begin with lies on one line with the folder."""
        for name, f, turned in self.filters:
            if name == "path" and not turned and isinstance(f, (EqualTo, StringStartsWith, In)):
                starts = f.value if isinstance(f, In) else [f.value]
                if not any(inner == "" or s.startswith(f"{inner}/") or (isinstance(f, StringStartsWith) and inner.startswith(s)) or s == inner for s in starts):
                    return False
        return True

    def _open(self, part: TreePartition) -> list[TreePartition] | None:
        """A partition's folder cut into its own files, and each folder below; None if there is none or it can't be read."""
        try:
            entries = [e for e in os.scandir(os.path.join(part.root, part.inner))]
            dirs = sorted(e.name for e in entries if e.name != ".git" and e.is_dir(follow_symlinks=False))
        except OSError:
            return None
        parts = max(1, -(-(len(entries) - len(dirs)) // self.part_files))
        if not dirs and parts == 1:
            return None
        own = [TreePartition(part.tree, part.root, part.inner, True, k, parts) for k in range(parts)]
        return own + [TreePartition(part.tree, part.root, f"{part.inner}/{d}".lstrip("/")) for d in dirs]

    def partitions(self) -> list[TreePartition]:
        """A partition for each tree; where those are fewer than `splits`, folders are opened, those of the least depth first, until
        there are enough. The driver lists no folder below the ones it opens."""
        if not self.many:
            todo = [TreePartition(os.path.basename(os.path.normpath(self.root)), self.root)]
        else:
            names = sorted(e.name for e in os.scandir(self.root) if e.is_dir(follow_symlinks=False))
            todo = [TreePartition(n.replace("__", "/", 1), os.path.join(self.root, n)) for n in names]
        todo = deque(t for t in todo if (not self.only or t.tree in self.only or not self.many) and self._passes(tree=t.tree))
        done: list[TreePartition] = []
        while todo and len(todo) + len(done) < self.splits:
            part = todo.popleft()
            opened = [x for x in self._open(part) or [part] if x.shallow or x.inner == "" or self._may_hold(x.inner)]
            for x in opened:
                (done if x.shallow or x is part else todo).append(x)
        return [*done, *todo] or [TreePartition("", "")]

    def read(self, partition: TreePartition) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        walk = self._walk(partition) if partition.root else iter(())
        while True:
            try:
                row = next(walk, None)
            except OSError as e:  # a tree that can't be read says so in a row; the others are read
                row, walk = (partition.tree, None, None, None, None, None, None, f"{type(e).__name__}: {e}"[:500]), iter(())
                if not self._passes(tree=partition.tree, path=None, is_dir=None, size=None):
                    row = None
            if row is not None:
                rows.append(row)
            if rows and (row is None or len(rows) == BATCH):
                yield self._batch(rows)
                rows = []
            if row is None:
                return

    def _walk(self, partition: TreePartition) -> Iterator[tuple]:
        top, tree = partition.root, partition.tree

        def failed(e: OSError) -> None:
            raise e

        for folder, dirs, names in os.walk(os.path.join(top, partition.inner), followlinks=False, onerror=failed):
            inner = os.path.relpath(folder, top).replace(os.sep, "/")
            inner = "" if inner == "." else inner
            below = [d for d in dirs if d != ".git" and not os.path.islink(os.path.join(folder, d))]
            dirs[:] = [] if partition.shallow else sorted(d for d in below if self._may_hold(f"{inner}/{d}".lstrip("/")))
            if inner and partition.part == 0 and self._passes(tree=tree, path=inner, is_dir=True, size=None):
                yield tree, inner, True, None, None, None, None, None
            for name in sorted(names):
                place = f"{inner}/{name}" if inner else name
                if partition.parts > 1 and crc32(name.encode("utf-8", "surrogateescape")) % partition.parts != partition.part or not self._passes(tree=tree, path=place, is_dir=False):
                    continue
                path = os.path.join(folder, name)
                if os.path.islink(path) or not os.path.isfile(path):
                    continue
                size = os.path.getsize(path)
                if not self._passes(size=size):
                    continue
                wanted = self.heads and name.lower().startswith(self.heads)
                yield tree, place, False, size, sha256_of(path) if self.hashed else None, size > self.size_cap, head_of(path) if wanted else None, None

    def _batch(self, rows: list[tuple]) -> pa.RecordBatch:
        kinds = {StringType: pa.string(), BooleanType: pa.bool_(), LongType: pa.int64()}
        return pa.RecordBatch.from_arrays([pa.array(c, kinds[type(f.dataType)]) for c, f in zip(zip(*rows, strict=True), TREE, strict=True)], names=TREE.names)


class FileTree(DataSource):
    """Options: path; checkouts (each folder below the path is a tree of its own, owner__name read as owner/name); only (trees
    to read); hash; sizeCap (bytes over which a file counts as large); heads (beginnings of names whose text is read); splits
    (partitions that trees are cut into by their folders, where they are fewer); partFiles (files of one folder in a partition).

    Filters on tree, path, is_dir and size are applied before a file is read or hashed, and folders that can't hold a path that
    passes aren't entered; Spark hands them over if spark.sql.python.filterPushdown.enabled is true, as read_tree() sets it."""

    @classmethod
    def name(cls) -> str:
        return "filetree"

    def schema(self) -> StructType:
        return TREE

    def reader(self, schema: StructType) -> TreeReader:
        return TreeReader(self.options)


def read_tree(spark: SparkSession, path: str, **options) -> DataFrame:
    spark.dataSource.register(FileTree)
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    return spark.read.format("filetree").options(path=path, **{k: str(v) for k, v in options.items()}).load()


def heads_of_commits(spark: SparkSession, path: str) -> DataFrame:
    """(tree, commit_sha) of checkouts, as their version control tells without being run: a branch's file, else a packed
    reference, else a bare hash. One short row for each checkout, read on the driver."""
    rows = []
    for e in sorted(os.scandir(path), key=lambda e: e.name):
        top = os.path.join(path, e.name, ".git")
        if not e.is_dir(follow_symlinks=False) or not os.path.isfile(os.path.join(top, "HEAD")):
            continue
        at = head_of(os.path.join(top, "HEAD")).strip()
        if at.startswith("ref: "):
            ref, file = at[5:], os.path.join(top, *at[5:].split("/"))
            if os.path.isfile(file):
                at = head_of(file).strip()
            else:
                packed = os.path.join(top, "packed-refs")
                lines = head_of(packed).splitlines() if os.path.isfile(packed) else []
                at = next((x.split()[0] for x in lines if x.endswith(f" {ref}")), "")
        if at:
            rows.append((e.name.replace("__", "/", 1), at))
    return spark.createDataFrame(rows, "tree string, commit_sha string")
