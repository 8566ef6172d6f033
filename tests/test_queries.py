"""Every registered query of the engine against its SQL in DuckDB, on a small driver table."""

import os

import duckdb
import numpy as np
import pandas as pd
import pytest

from registra.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    c.execute("SET timezone = 'UTC'")
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def plain(df):
    def value(v):
        if v is None or v is pd.NA or v != v:
            return "null"
        number = isinstance(v, (int, float, np.number)) and not isinstance(v, (bool, np.bool_))
        return f"{float(v):.9g}" if number else str(v)

    cols = sorted(df.columns)
    return cols, sorted(tuple(value(v) for v in row) for row in df[cols].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, duck, name):
    q = QUERIES[name]
    assert q.sql
    assert plain(q.run(spark, SF).toPandas()) == plain(duck.execute(q.sql).df())


def test_entry_and_registry(spark):
    import __spark_entry__ as e

    assert set(QUERIES) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())
    assert e.entry(spark).count() > 0
