"""Every registered query with SQL against the rows that DuckDB gives for it."""

import math

import duckdb
import pandas as pd
import pytest

from lifespans import queries as core

from .conftest import DATA

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def _cell(x):
    if x is None or x is pd.NaT or x is pd.NA or (isinstance(x, float) and math.isnan(x)):
        return "null"
    if isinstance(x, float):
        return f"{x:.5f}"
    return str(pd.Timestamp(x)) if hasattr(x, "year") else str(x)


def rows(frame):
    frame = frame[sorted(frame.columns)]
    return list(frame.columns), sorted(tuple(map(_cell, r)) for r in frame.itertuples(index=False, name=None))


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(core.oracle_sql()))
def test_query_matches_sql(spark, duck, name):
    got = core.queries()[name](spark, DATA).toPandas().astype(object)
    want = duck.execute(core.oracle_sql()[name]).df().astype(object)
    number = lambda f: f.map(lambda x: float(x) if isinstance(x, (int, float)) and not isinstance(x, bool) else x)
    assert rows(number(got)) == rows(number(want))


def test_every_query_has_sql():
    assert set(core.queries()) == set(core.oracle_sql())
