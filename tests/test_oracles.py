"""Every registered query with SQL gives the same rows as DuckDB on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_oracles import TABLES, compare

QUERIES = entry.queries()
ORACLES = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    return con


def test_every_oracle_has_a_query():
    assert set(ORACLES) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, con, sf, name):
    state, note, _ = compare(spark, con, name, QUERIES[name], ORACLES[name], sf)
    assert state == "OK", note


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() > 0
