"""Sliding-window pagination of an event feed as a stream source: offsets are window starts, and pages overlap by a second. The
driver turns the pages from the index of a sorted feed; tasks read their rows."""

from __future__ import annotations

import os
from bisect import bisect_left
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, SimpleDataSourceStreamReader

from weir.functions import text
from weir.sources.records import API_EVENT
from weir.stage import local_path, scratch

#: Bytes of a row group of a sorted feed, and rows that a task reads at a time.
GROUP, BATCH = 16 << 20, 10_000
#: What the stream carries for a page: runs of rows of one row group each.
PIECE = "file string, row_group int, first long, last long"


def sorted_feed(spark: SparkSession, path: str) -> str:
    """A folder of the shared one with the dated events of a recorded feed, each id once, where it stands first, in the order of
    their start as seconds (`s`). The feed is a file with a JSON list, or a folder of JSON lines for one of any size."""
    events = spark.read.schema(API_EVENT).option("multiLine", os.path.isfile(local_path(path))).json(path)
    dated = events.withColumns({"s": text.epoch(F.col("start")).cast("long"), "pos": F.monotonically_increasing_id()}).where("s is not null")
    rest = [c for c in events.columns if c != "id"]
    once = dated.groupBy("id").agg(F.min(F.struct("s", "pos", *rest)).alias("e")).select("id", "e.*")
    to = scratch(spark, "sorted-feed")
    once.repartitionByRange("s", "pos").sortWithinPartitions("s", "pos").select(*events.columns, "s").write.option("parquet.block.size", GROUP).parquet(to)
    return to


@dataclass
class Group:
    """A row group: its file and number, the places of its first row and after its last, its highest start."""

    file: str
    number: int
    first: int
    last: int
    high: int


class RecordedPages(SimpleDataSourceStreamReader):
    """Turns the pages of a sorted feed as the service would give them: the first events from a time on. A page begins at the start
    of the last event of the one before, which may stand on both; a short page or one without a new event is the last. The driver
    reads the footers once and the starts of the groups in which a page begins and ends."""

    def __init__(self, options: dict):
        self.path, self.limit = options["path"], int(options.get("limit", 100))
        self.start, self.known = int(options.get("start", 0)), None

    def initialOffset(self) -> dict:
        return {"start": self.start, "past": 0, "done": False, "pages": 0}

    def _groups(self) -> list[Group]:
        if self.known is None:
            self.known, at = [], 0
            for name in sorted(n for n in os.listdir(self.path) if n.startswith("part-")):
                footer = pq.read_metadata(os.path.join(self.path, name))
                column = footer.schema.names.index("s")
                for i in range(footer.num_row_groups):
                    group = footer.row_group(i)
                    if group.num_rows:
                        self.known.append(Group(name, i, at, at + group.num_rows, group.column(column).statistics.max))
                        at += group.num_rows
        return self.known

    def _starts(self, group: Group):
        return pq.ParquetFile(os.path.join(self.path, group.file)).read_row_group(group.number, columns=["s"]).column(0).to_numpy()

    def _page(self, offset: dict) -> tuple[list[tuple], dict]:
        """The rows of a page that none before had, and where the next begins."""
        groups = self._groups()
        total = groups[-1].last if groups else 0
        g = bisect_left(groups, offset["start"], key=lambda x: x.high)
        first = groups[g].first + int(self._starts(groups[g]).searchsorted(offset["start"])) if g < len(groups) else total
        last, past = min(first + self.limit, total), max(first, offset["past"])
        more = last - first == self.limit and last > past
        then = offset["start"]
        if more:
            end = next(x for x in groups if x.first < last <= x.last)
            then = int(self._starts(end)[last - 1 - end.first])
        pieces = [(x.file, x.number, max(past, x.first) - x.first, min(last, x.last) - x.first) for x in groups if x.first < last and past < x.last and past < last]
        return pieces, {"start": then, "past": max(last, past), "done": not more, "pages": offset["pages"] + 1}

    def read(self, start: dict) -> tuple[Iterator[tuple], dict]:
        if start["done"]:
            return iter(()), start
        pieces, end = self._page(start)
        return iter(pieces), end

    def readBetweenOffsets(self, start: dict, end: dict) -> Iterator[tuple]:
        return iter(self._page(start)[0])


class EventFeed(DataSource):
    @classmethod
    def name(cls) -> str:
        return "eventfeed"

    def schema(self) -> str:
        return PIECE

    def simpleStreamReader(self, schema) -> RecordedPages:
        return RecordedPages(self.options)


def event_stream(spark: SparkSession, path: str, limit: int = 100) -> DataFrame:
    """Events of a recorded feed, each id once though pages overlap. The feed is sorted first; each page is a batch, whose rows are
    read by tasks, a row group at a time."""
    spark.dataSource.register(EventFeed)
    folder, columns = local_path(sorted_feed(spark, path)), [x.split()[0] for x in API_EVENT.split(", ")]

    def rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in batch.to_pylist():
                at, source = 0, pq.ParquetFile(os.path.join(folder, piece["file"]))
                for part in source.iter_batches(BATCH, row_groups=[piece["row_group"]], columns=columns):
                    lo, hi = max(piece["first"] - at, 0), min(piece["last"] - at, part.num_rows)
                    if lo < hi:
                        yield part.slice(lo, hi - lo)
                    at += part.num_rows

    pieces = spark.readStream.format("eventfeed").options(path=folder, limit=str(limit)).load()
    return pieces.repartition(spark.sparkContext.defaultParallelism).mapInArrow(rows, API_EVENT)
