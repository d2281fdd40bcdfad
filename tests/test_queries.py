"""Every query runs, and those with SQL give what DuckDB gives."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from lodestrand.plans import general_queries, reference_queries

NAMES = [*general_queries.QUERIES, *reference_queries.QUERIES]


def rows(df):
    df = df[sorted(df.columns)]
    return sorted(map(repr, df.astype(object).where(df.notna(), None).itertuples(index=False, name=None)))


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for p in glob.glob(f"{data}/*.parquet"):
        con.sql(f"create view {os.path.basename(p)[:-8]} as from '{p}'")
    return con


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, data, duck, name):
    got = entry.queries()[name](spark, data).toPandas()
    if name in entry.oracle_sql():
        want = duck.sql(entry.oracle_sql()[name]).df()
        assert sorted(got.columns) == sorted(want.columns) and rows(got) == rows(want)


def test_entry(spark):
    assert entry.entry(spark).count() > 0
