"""Every query with a SQL twin, compared on the smallest tables."""

from pathlib import Path

import pytest

import __spark_entry__ as entry
from check import rows_of

duckdb = pytest.importorskip("duckdb")
DATA = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not Path(DATA).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    con = duckdb.connect()
    for f in Path(DATA).glob("*.parquet"):
        con.execute(f"CREATE VIEW {f.stem} AS SELECT * FROM '{f}'")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_matches_sql(spark, con, name):
    got = entry.queries()[name](spark, DATA).toPandas()
    expect = con.execute(entry.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(expect.columns)
    assert rows_of(got) == rows_of(expect)


def test_every_oracle_has_a_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
