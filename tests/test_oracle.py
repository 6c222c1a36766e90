"""Every registered query with a SQL text, against DuckDB on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check import TABLES, compare

SF = "/root/testdata/sf0.001"
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, name):
    assert compare(entry.queries()[name](spark, SF), con, ORACLES[name]) == ""


def test_entry_runs(spark):
    assert entry.entry(spark).count() == 2
