"""Every query that SQL can express, against that SQL on the smallest tables."""

import duckdb
import pandas as pd
import pytest

from weir.plans.queries import ORACLES, QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def sql():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return con


def rows(frame):
    cols = sorted(frame.columns)
    text = lambda v: "" if v is None or v is pd.NA or v != v else f"{v:g}" if isinstance(v, float) else str(v)
    return cols, sorted(tuple(map(text, r)) for r in frame[cols].astype(object).itertuples(index=False, name=None))


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query(spark, sql, name):
    assert rows(QUERIES[name](spark, SF).toPandas()) == rows(sql.execute(ORACLES[name]).df())


def test_names():
    """No operator's name stands for another's query."""
    assert len(set(QUERIES.values())) == len(QUERIES)


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
