"""Every registered query against its DuckDB oracle on the smallest data
set (row count, column names, order-insensitive values)."""
import duckdb
import pytest

import __spark_entry__ as se
from check_oracle import _rows, type_mismatches
from conftest import SMOKE
from lakemart.sources.tables import TABLES

# the library's own queries; those of optional subpackages have tests of their own
QUERIES = {k: fn for k, fn in se.queries().items() if fn.__module__.startswith("lakemart.queries.")}
ORACLES = {k: sql for k, sql in se.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SMOKE}/{t}.parquet')")
    return c


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)


def test_entry(spark):
    df = se.entry(spark)
    assert "daily_active_users" in df.columns and df.count() > 0


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_oracle(spark, con, name):
    sdf = QUERIES[name](spark, SMOKE)
    res = con.execute(ORACLES[name])
    ocols = [d[0] for d in res.description]
    assert sorted(sdf.columns) == sorted(ocols)
    assert type_mismatches(sdf, res) == []
    assert _rows(sdf.columns, [tuple(r) for r in sdf.collect()]) == _rows(ocols, res.fetchall())
