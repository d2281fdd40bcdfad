import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from lodestrand.llm import queries


@pytest.fixture(scope="module")
def duck(data):
    con = duckdb.connect()
    con.sql("set timezone = 'UTC'")
    for p in glob.glob(f"{data}/*.parquet"):
        con.sql(f"create view {os.path.basename(p)[:-8]} as from '{p}'")
    return con


@pytest.mark.parametrize("name", list(queries.QUERIES))
def test_query(spark, data, duck, name):
    got = entry.queries()[name](spark, data).toPandas()
    assert len(got)
    if name in queries.SQL:
        want = duck.sql(queries.SQL[name]).df()
        cols = sorted(want.columns)
        assert sorted(got.columns) == cols
        assert sorted(map(tuple, got[cols].astype(str).values)) == sorted(map(tuple, want[cols].astype(str).values))


def test_recall_of_p1_found(spark, data):
    """The relaxed search against the exact one."""
    found, exact = ({tuple(r) for r in queries.QUERIES[q](spark, data).collect()} for q in ("p1_found", "p1_exact"))
    assert len(found & exact) >= 0.9 * len(exact) and len(found - exact) <= 0.1 * len(exact)
