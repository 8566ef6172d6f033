"""The registered queries on a driver table: contracts of their columns, and SQL where there is any."""

import os

import duckdb
import pytest

from registra.llm.queries import oracle_sql, queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables are not here")


@pytest.mark.parametrize("name", sorted(queries()))
def test_runs_whole(spark, name):
    df = queries()[name](spark, SF)
    n = spark.read.parquet(f"{SF}/documents.parquet").count()
    got = df.count()
    assert got > 0
    if name.split("_")[0] in ("op2", "op4", "op5", "op7", "op8", "op9", "op10"):
        assert got == n == df.select("doc_id").distinct().count()


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_sql(spark, name):
    c = duckdb.connect()
    c.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF}/documents.parquet')")
    a = queries()[name](spark, SF).toPandas()
    b = c.execute(oracle_sql()[name]).df()[list(a.columns)]
    key = list(a.columns)
    assert a.sort_values(key).astype(str).values.tolist() == b.sort_values(key).astype(str).values.tolist()
