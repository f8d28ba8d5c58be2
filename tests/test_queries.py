"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
from oracle import compare, connect

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, ORACLES = entry.queries(), entry.oracle_sql()

# Queries that have no rows on the smallest tables, as their SQL has none.
EMPTY: set[str] = set()


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_equals_sql(spark, con, name):
    problems = compare(con, QUERIES[name](spark, SF_DIR), ORACLES[name])
    assert problems == (["no rows"] if name in EMPTY else [])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_runs(spark, name):
    assert QUERIES[name](spark, SF_DIR).count() > 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["region", "year", "avg_price"] and df.count() > 0


def test_the_comparison_can_fail(spark, con):
    sql = ORACLES["regional_trend"]
    df = entry.entry(spark)
    assert compare(con, df, sql) == []
    assert compare(con, df, sql.replace("avg(o_totalprice)", "avg(o_totalprice) + 0.01"))
    assert compare(con, df, sql.replace(">= 1990", ">= 1996"))
    assert compare(con, df, sql.replace("AS avg_price", "AS other"))
    assert compare(con, df, sql.replace("CAST(year(o_orderdate) AS INTEGER)", "year(o_orderdate)"))
