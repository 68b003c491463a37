"""Every registered query against its SQL text on the smallest tables, and its plan."""

import pytest

import __spark_entry__ as entry_points
from checks.oracle import ORACLE
from checks.queries import QUERIES
from checks.run import compare, connect

ROOT = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(ROOT)


def test_entry(spark):
    frame = entry_points.entry(spark)
    assert frame.count() > 0 and "avg_price" in frame.columns


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(entry_points.queries())


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, con, name):
    """Same rows as the SQL text, and no join that pairs everything with everything."""
    frame = QUERIES[name](spark, ROOT)
    plan = frame._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    ok, message = compare(spark, con, name, ROOT, frame)
    assert ok, message


def test_latest_limits_groups_before_the_exchange(spark):
    plan = QUERIES["v01_current_items"](spark, ROOT)._jdf.queryExecution().executedPlan().toString()
    assert "row_number(), 1, Partial" in plan


def test_columns_and_filters_reach_the_scan(spark):
    plan = QUERIES["k05_labelled_counts"](spark, ROOT)._jdf.queryExecution().executedPlan().toString()
    assert "l_extendedprice" not in plan
    lookup = QUERIES["p18_order_by_id"](spark, ROOT)._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(o_orderkey,42)" in lookup
