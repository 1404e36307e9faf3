"""Components write a table for each round that joins something, and none to see that nothing is left."""

import random

from weir.llm import components as of


def found(spark, monkeypatch, edges):
    written = []
    monkeypatch.setattr(of, "staged", lambda df, name: written.append(name) or df.localCheckpoint())
    out = {r["node"]: r["root"] for r in of.components(spark.createDataFrame(edges, "a long, b long")).collect()}
    return out, written


def test_stars_are_taken_as_they_are(spark, monkeypatch):
    out, written = found(spark, monkeypatch, [(1, 5), (5, 1), (7, 1), (9, 2), (4, 4), (None, 3)])
    assert out == {1: 1, 5: 1, 7: 1, 9: 2, 2: 2} and written == ["edges"]


def test_no_edges(spark, monkeypatch):
    assert found(spark, monkeypatch, [(3, 3)]) == ({}, ["edges"])


def test_any_graph(spark, monkeypatch):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 140)] + [(rng.randrange(60), rng.randrange(60)) for _ in range(40)]
    least = {x: x for e in edges for x in e if e[0] != e[1]}
    for _ in least:
        for a, b in edges:
            if a != b:
                least[a] = least[b] = min(least[a], least[b])
    assert found(spark, monkeypatch, edges)[0] == least
