"""Every registered check against DuckDB on the driver tables."""

import duckdb
import pytest

import __spark_entry__ as entry
from tests.conftest import TESTDATA
from vouchlake.plans import checks, oracle

SF_DIR = f"{TESTDATA}/sf0.001"
TABLES = "nation customer part orders lineitem".split()
QUERIES, SQL = checks.CHECKS, oracle.statements()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF_DIR}/{name}.parquet'")
    return con


def test_every_check_has_sql():
    assert set(QUERIES) == set(SQL)
    assert set(QUERIES) <= set(entry.queries()) and set(SQL) <= set(entry.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_matches_sql(spark, duck, name):
    df = QUERIES[name](spark, SF_DIR)
    expected = duck.sql(SQL[name])
    order = sorted(df.columns)
    assert sorted(expected.columns) == order

    def bag(columns, data):
        places = [columns.index(c) for c in order]
        return sorted(repr(tuple(row[i] for i in places)) for row in data)

    got = bag(df.columns, [tuple(r) for r in df.collect()])
    assert got, "a check over the driver tables yields rows"
    assert got == bag(expected.columns, expected.fetchall())


def test_entry(spark):
    assert entry.entry(spark).columns[0] == "customer_id"
