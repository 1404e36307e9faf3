"""Upsert of a stream of catalog shards: the last row of each key stands where the first one stood, whatever order rows
arrive in. What is known of a key is kept in the state of the stream, so a new shard costs its own rows, not all shards."""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

#: The state store that the states below need.
STORE = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
LATEST = "shard_pos long, row_pos long, payload string, first_shard_pos long, first_row_pos long"
STATE = f"{LATEST}, shards array<struct<shard_pos: long, row_pos: long>>"
UPDATE = f"key string, {LATEST}, shards long"


class Upsert(StatefulProcessor):
    """For each key `latest`: the last row by (shard_pos, row_pos), where the first one stood, and `shards`, the last row of the key
    in each shard that has it. Rows that come again, after a retry or in a shard written twice, change nothing; of different rows
    at one place the one with the greater payload counts, so that the order of arrival changes nothing. A call to the store takes
    far longer than the rest, so all is one value: it is read once for a key of a batch, and written if it has changed."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.latest = handle.getValueState("latest", STATE)

    def handleInputRows(self, key: tuple, rows: Iterator[Row], timerValues: object) -> Iterator[Row]:
        known = self.latest.get()
        last, first = (tuple(known[:3]), tuple(known[3:5])) if known else (None, None)
        of_shard: dict[int, int] = {s: r for s, r in known[5]} if known else {}
        before = (last, first, dict(of_shard))
        for r in rows:
            row, place = (r["shard_pos"], r["row_pos"], r["payload"]), (r["shard_pos"], r["row_pos"])
            last = row if last is None or row > last else last
            first = place if first is None or place < first else first
            of_shard[place[0]] = max(place[1], of_shard.get(place[0], place[1]))
        if (last, first, of_shard) != before:
            self.latest.update((*last, *first, sorted(of_shard.items())))
        yield Row(key=key[0], shard_pos=last[0], row_pos=last[1], payload=last[2], first_shard_pos=first[0], first_row_pos=first[1], shards=len(of_shard))

    def close(self) -> None:
        pass


def upserts(shards: DataFrame, key: str = "id", order: tuple[str, str] = ("shard_pos", "row_pos")) -> DataFrame:
    """A stream of (key, shard_pos, row_pos, payload, first_shard_pos, first_row_pos, shards): for each key that a batch holds, what
    stands in the table then. payload: the row as JSON; shards: how many shards hold the key. Rows without a key or a place
    are left out."""
    shard, row = (F.col(o).cast("long") for o in order)
    told = shards.select(F.col(key).cast("string").alias("key"), shard.alias("shard_pos"), row.alias("row_pos"), F.to_json(F.struct(*shards.columns), {"ignoreNullFields": "false"}).alias("payload"))
    placed = told.where("key is not null and shard_pos is not null and row_pos is not null")
    return placed.groupBy("key").transformWithState(statefulProcessor=Upsert(), outputStructType=UPDATE, outputMode="Update", timeMode="None")


def start(shards: DataFrame, checkpoint: str, key: str = "id", order: tuple[str, str] = ("shard_pos", "row_pos"), changes: str | None = None) -> StreamingQuery:
    """Takes what there is of a stream of shards, from where the checkpoint says. changes: a folder that gets the rows of each
    batch as Parquet, in a folder of the batch's own, so that a batch which runs again replaces what it wrote."""

    def write(batch: DataFrame, batch_id: int) -> None:
        if changes is not None:
            batch.write.mode("overwrite").parquet(f"{changes}/batch={batch_id}")
        else:
            batch.write.format("noop").mode("overwrite").save()

    spark, name = shards.sparkSession, "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(name, None)
    spark.conf.set(name, STORE)
    try:
        return upserts(shards, key, order).writeStream.outputMode("update").foreachBatch(write).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()
    finally:
        if before is None:
            spark.conf.unset(name)
        else:
            spark.conf.set(name, before)


def snapshot(spark: SparkSession, checkpoint: str, schema: str, shards: str | None = None) -> DataFrame:
    """The table as the last batch left it, read from the state: one row for each key, with its columns as `schema` says, and
    first_shard_pos and first_row_pos; a column named as `shards` says tells in how many shards the key stands. Nothing is
    grouped or shuffled."""
    state = spark.read.format("statestore").option("stateVarName", "latest").load(checkpoint)
    count = [F.size("value.shards").cast("long").alias(shards)] if shards else []
    return state.select(F.from_json("value.payload", schema).alias("x"), "value.first_shard_pos", "value.first_row_pos", *count).select("x.*", "first_shard_pos", "first_row_pos", *([shards] if shards else []))


def shards_of(spark: SparkSession, checkpoint: str) -> DataFrame:
    """(id, shards): in how many shards each key stands, from the state."""
    state = spark.read.format("statestore").option("stateVarName", "latest").load(checkpoint)
    return state.select(F.col("key.key").alias("id"), F.size("value.shards").cast("long").alias("shards"))
