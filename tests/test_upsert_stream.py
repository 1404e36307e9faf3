"""The upsert of a stream against the same upsert over all shards at once: order of arrival, restarts, repeats, odd rows."""

import collections
import random

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from weir.operators import catalog
from weir.streaming import upsert

ROW = "id string, title string, tags array<string>, shard_pos long, row_pos long"


def taken(spark, source, check, changes=None, at_once="1"):
    stream = spark.readStream.schema(ROW).option("maxFilesPerTrigger", at_once).parquet(source)
    upsert.start(stream, check, changes=changes).awaitTermination()


def plain(rows):
    of = collections.defaultdict(list)
    for i, title, tags, shard, row in rows:
        if i is not None and shard is not None and row is not None:
            of[i].append((shard, row, title, tags))
    return {i: (max(x)[2:], min(x)[:2], len({s for s, *_ in x})) for i, x in of.items()}


def table(spark, check):
    shards = {r["id"]: r["shards"] for r in upsert.shards_of(spark, check).collect()}
    return {r["id"]: ((r["title"], r["tags"]), (r["first_shard_pos"], r["first_row_pos"]), shards[r["id"]]) for r in upsert.snapshot(spark, check, ROW).collect()}


def test_shuffled_shards_with_a_restart(spark, tmp_path):
    rng = random.Random(3)
    places = rng.sample([(s, r) for s in range(5) for r in range(60)], 200)
    rows = [(f"k{rng.randint(0, 40)}", f"t{i} é", [f"a{i}"] * (i % 3), s, r) for i, (s, r) in enumerate(places)]
    rows += [(None, "no key", [], 1, 1), ("k1", "no place", [], None, 1), ("alone", "x", None, 0, 0)]
    source, check, changes = (str(tmp_path / x) for x in ("in", "check", "changes"))
    for part in (rows[:70], rows[70:150], rows[150:] + rows[:20]):  # a stop and a start between; the last brings rows again
        spark.createDataFrame(part, ROW).repartition(2).write.mode("append").parquet(source)
        taken(spark, source, check, changes)
    assert table(spark, check) == plain(rows)
    # the changes alone give the same table, the last batch of each key counting
    last = spark.read.parquet(changes).groupBy("key").agg(F.max_by(F.struct("payload", "shards"), "batch").alias("x")).select("key", "x.*")
    assert {r["key"]: r["shards"] for r in last.collect()} == {i: n for i, (_, _, n) in plain(rows).items()}
    want = catalog.upsert(spark.createDataFrame(rows, ROW).where("id is not null and shard_pos is not null"))
    assert {(r["id"], r["title"], r["first_shard_pos"], r["first_row_pos"]) for r in want.collect()} == {(i, t, *f) for i, ((t, _), f, _) in table(spark, check).items()}


def test_a_batch_that_fails_runs_again(spark, tmp_path, monkeypatch):
    source, check, changes = (str(tmp_path / x) for x in ("in", "check", "changes"))
    rows = [(f"k{i % 7}", f"t{i}", None, i % 2, i) for i in range(40)]
    spark.createDataFrame(rows, ROW).write.parquet(source)
    (tmp_path / "changes").write_text("a file where the folder should be")
    with pytest.raises(StreamingQueryException):
        taken(spark, source, check, changes)
    (tmp_path / "changes").unlink()
    taken(spark, source, check, changes)
    assert table(spark, check) == plain(rows)


def test_two_rows_at_one_place_don_t_depend_on_order(spark, tmp_path):
    found = []
    for k, titles in enumerate((["a", "b", None], [None, "b", "a"])):
        source, check = str(tmp_path / f"in{k}"), str(tmp_path / f"check{k}")
        for t in titles:
            spark.createDataFrame([("k", t, None, 1, 1)], ROW).write.mode("append").parquet(source)
            taken(spark, source, check)
        found.append(table(spark, check))
    assert found[0] == found[1] and found[0]["k"][1:] == ((1, 1), 1)  # by the JSON of the row


def test_the_store_is_set_for_the_query_alone(spark, tmp_path):
    before = spark.conf.get("spark.sql.streaming.stateStore.providerClass")
    spark.createDataFrame([], ROW).write.parquet(str(tmp_path / "in"))
    taken(spark, str(tmp_path / "in"), str(tmp_path / "check"))
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass") == before


def test_the_state_is_read_once_for_a_key_and_written_if_it_changed():
    class State:
        value, calls = None, []

        def get(self):
            self.calls.append("get")
            return self.value

        def update(self, value):
            self.calls.append("update")
            self.value = value

    one = upsert.Upsert()
    one.init(type("Handle", (), {"getValueState": lambda *_: State()}))
    rows = [{"shard_pos": s, "row_pos": r, "payload": f"{s} {r}"} for s, r in ((2, 1), (0, 5), (2, 9), (1, 1))]
    for some in (rows[:2], rows[2:], rows):  # the last brings nothing new
        (told,) = one.handleInputRows(("k",), iter(some), None)
    assert told.asDict() == {"key": "k", "shard_pos": 2, "row_pos": 9, "payload": "2 9", "first_shard_pos": 0, "first_row_pos": 5, "shards": 3}
    assert State.calls == ["get", "update", "get", "update", "get"]
