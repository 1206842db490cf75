"""Every registered query against DuckDB on the smallest test data."""

from __future__ import annotations

import re

import oracle
import pytest

import __spark_entry__ as contract

SF_DIR = "/root/testdata/sf0.001"
# The training-data operators have tests of their own.
NAMES = [n for n in contract.queries() if n != "pipeline" and not re.match(r"op\d+_", n)]
SQL = {n: sql for n, sql in contract.oracle_sql().items() if n in NAMES}


@pytest.fixture(scope="module")
def con():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", NAMES)
def test_query_equals_sql(spark, con, name):
    got = oracle.spark_result(contract.queries()[name](spark, SF_DIR))
    assert got[1], "no rows"
    if name in SQL:
        assert got == oracle.duckdb_result(con, SQL[name])


def test_every_sql_belongs_to_a_query():
    assert set(SQL) <= set(contract.queries())
    assert set(NAMES) == set(SQL)


def test_filters_and_columns_reach_the_scan(spark):
    df = contract.queries()["top_pages_by_group_window"](spark, SF_DIR)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_type,view)" in plan and "EqualTo(event_type,signup)" in plan
    assert "event_id" not in plan and "c_acctbal" not in plan
    assert "Cartesian" not in plan and "NestedLoop" not in plan


def test_entry(spark):
    assert contract.entry(spark).count() > 0
