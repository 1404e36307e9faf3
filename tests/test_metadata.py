"""Open metadata: what counts as an object, what a field says, and that records carry the whole object."""

import json

import pytest
from pyspark.sql import functions as F

from weir.operators import walk
from weir.sources.trees import TREE

HEADS = {
    "object": '{"name": "A", "n": 1.5, "deep": {"er": [1, {"x": "y"}]}}', "empty": "{}", "array": "[1]", "text": '"{}"', "number": "3", "null": "null", "broken": '{"name": ', "none": None, "blank": "", "twice": '{"a": 1, "a": 2}',
    "unicode": '{"name": "\\u00fc\\ud83d\\ude00 \\"q\\""}', "long": '{"name": "' + "x" * 100_000 + '"}', "nested": "[" * 50 + "]" * 50,
}


def test_only_objects_count(spark):
    df = spark.createDataFrame([(k, v, 10) for k, v in HEADS.items()] + [("big", "{}", (1 << 20) + 1), ("at the limit", "{}", 1 << 20)], "k string, head string, size long")
    got = df.select("k", walk.metadata(F.col("head"), F.col("size")).alias("m")).select("k", F.to_json("m").alias("m"), walk.told(F.col("m"), "$.deep.er[1].x").alias("x"), F.length(walk.told(F.col("m"), "$.name")).alias("n"))
    found = {r["k"]: r for r in got.collect()}
    assert {k for k, r in found.items() if r["m"] is not None} == {"object", "empty", "unicode", "long", "at the limit"}
    assert json.loads(found["object"]["m"]) == json.loads(HEADS["object"]) and found["object"]["x"] == "y"
    assert found["long"]["n"] == 100_000 and json.loads(found["unicode"]["m"])["name"] == 'ü😀 "q"'


@pytest.mark.parametrize("value, text", [('"a"', "a"), ("1", "1"), ("1.5", "1.5"), ("true", "true"), ('"0"', "0"), ('"false"', "false"), ('" "', " "), ("[1]", "[1]"), ('{"a":null}', '{"a":null}')] + [(x, None) for x in ("null", "false", "0", "0.0", '""', "[]", "{}")])
def test_what_a_field_says(spark, value, text):
    m = walk.metadata(F.lit(f'{{"f": {value}}}'), F.lit(1))
    assert spark.range(1).select(walk.told(m, "$.f").alias("x"), walk.told(m, "$.other").alias("none")).first()[:] == (text, None)


def test_records_take_fields_of_any_type(spark):
    head = '{"name": 7, "category": "crypto", "flag": false, "description": ["a"], "author": {"who": "me"}, "points": 100}'
    rows = [("o/r", "a", True, None, None, None, None, None), ("o/r", "a/challenge.json", False, 100, "s", False, head, None), ("o/r", "a/x.py", False, 1, "t", False, None, None), ("o/r", "b", True, None, None, None, None, None), ("o/r", "b/challenge.json", False, 100, "s", False, "[]", None)]
    seeds = spark.createDataFrame([("o/r", "sources", None, True)], "repo string, kind string, license string, official boolean")
    made = walk.records(spark.createDataFrame(rows, TREE), seeds, spark.createDataFrame([], "tree string, commit_sha string")).orderBy("title").collect()
    assert [(r["title"], r["raw_category"], r["flag"], r["description"]) for r in made] == [("7", "crypto", None, '["a"]'), ("b", None, None, None)]
    assert json.loads(made[0]["extra"]) == {"kind": "sources", "path_in_repo": "a", "challenge_json": json.loads(head)} and "challenge_json" not in json.loads(made[1]["extra"])
