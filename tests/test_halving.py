"""Halving over counts against the search that asks range by range: caps, gaps, single values, groups."""

import datetime
import random

import pytest
from pyspark.sql import functions as F

from weir.operators import discovery


def asked(counts, low, high, cap):
    """What the search finds that asks for one range after another."""
    count = lambda q: sum(n for v, n in counts.items() if int(q.split(":")[1].split("..")[0]) <= v <= int(q.split("..")[1]))
    leaves = discovery.star_leaves("", count, low, high, cap)
    return sorted((*map(int, q.split(":")[1].split("..")), n, whole) for q, n, whole in leaves)


@pytest.mark.parametrize("low, high, cap", [(0, 1_000_000, 50), (0, 0, 3), (7, 100, 10), (0, 5, 1_000), (3, 4, 1)])
def test_leaves(spark, low, high, cap):
    rng = random.Random(high)
    counts = {rng.randint(low, high): rng.randint(1, 40) for _ in range(150)} | {low: 2 * cap, high: cap}
    rows = [(v, n // 2) for v, n in counts.items()] + [(v, n - n // 2) for v, n in counts.items()] + [(None, 5), (low - 1, 500), (high + 1, 500)]
    made = discovery.halved(spark.createDataFrame(rows, "v long, n long"), "v", F.lit(low), F.lit(high), 21, cap)
    assert sorted(tuple(r) for r in made.collect()) == asked(counts, low, high, cap)


def test_groups_are_halved_apart(spark):
    rng = random.Random(2)
    of = {g: {rng.randint(0, 63): rng.randint(1, 9) for _ in range(30)} for g in ("a", "b", None)}
    rows = [(g, v, n) for g, c in of.items() for v, n in c.items()]
    made = discovery.star_table(spark.createDataFrame(rows, "g string, stars long, n long"), 10, 63, ("g",)).collect()
    assert {g: sorted((r["low"], r["high"], r["n"], r["whole"]) for r in made if r["g"] == g) for g in of} == {g: asked(c, 0, 63, 10) for g, c in of.items()}


def test_days_over_the_cap_by_stars(spark):
    day = lambda d: datetime.date(2024, 1, 1) + datetime.timedelta(days=d)
    rows = [(day(d), s, 3) for d in range(40) for s in range(d % 3)] + [(day(11), s, 7) for s in range(20)] + [(day(12), 5, 99)] + [(None, 1, 4)]
    made = discovery.sharded(spark.createDataFrame(rows, "day date, stars long, n long"), 10, 31).collect()
    assert sum(r["n"] for r in made) == sum(n for d, _, n in rows if d)
    assert [(r["low"], r["low_stars"], r["high_stars"], r["n"]) for r in made if not r["whole"]] == [(day(12), 5, 5, 102 if 12 % 3 > 5 else 99)]
    assert all(r["n"] <= 10 for r in made if r["whole"]) and {r["low"] for r in made if r["low_stars"] is not None} == {day(11), day(12)}
    assert discovery.day_leaves(spark.createDataFrame([], "day date, n long")).count() == 0
