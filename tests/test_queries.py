"""Every registered query with SQL against DuckDB on the smallest tables."""

import os

import duckdb
import pytest

from loamgrid.plans import evaluation, grid_queries, other_queries, pixel_queries, polygon_queries, registry  # noqa: F401

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for f in os.listdir(SF):
        c.execute(f"CREATE VIEW {f.removesuffix('.parquet')} AS SELECT * FROM read_parquet('{SF}/{f}')")
    return c


def rows(df):
    cols = sorted(df.columns)
    return sorted(map(tuple, df[cols].astype(str).to_numpy().tolist())), cols


@pytest.mark.parametrize("name", sorted(registry.SQL))
def test_equals_sql(spark, db, name):
    got, want = rows(registry.QUERIES[name](spark, SF).toPandas()), rows(db.execute(registry.SQL[name]).df())
    assert got[1] == want[1]
    assert got[0] == want[0]


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.SQL)))
def test_has_rows(spark, name):
    assert registry.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
