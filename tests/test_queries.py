"""Every registered query with SQL gives the same rows in DuckDB on the same tables."""
from pathlib import Path

import duckdb
import pandas as pd
import pytest

import __spark_entry__ as entry_points

DATA = Path("/root/testdata/sf0.001")
TABLES = "documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not DATA.exists(), reason="test tables are not there")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{DATA}/{t}.parquet'")
    return con


def rows(df):
    show = lambda v: "NULL" if pd.isna(v) else f"{v:.6g}" if isinstance(v, float) else str(v)
    return sorted(tuple(show(v) for v in r) for r in df[sorted(df.columns)].itertuples(index=False))


@pytest.mark.parametrize("name", sorted(entry_points.oracle_sql()))
def test_same_as_sql(spark, duck, name):
    got = entry_points.queries()[name](spark, str(DATA)).toPandas()
    want = duck.sql(entry_points.oracle_sql()[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert rows(got) == rows(want)


def test_entry(spark):
    assert entry_points.entry(spark).count() > 0
