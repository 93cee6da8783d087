"""Plan guards for the scale rules, over every registered query (sf0.001):
no cross joins, no row-at-a-time Python, and no exchange in the row-local
operators."""

import pytest

import __spark_entry__ as E

from .conftest import SF_SMALL

ROW_LOCAL = ["in_network_file_index", "reporting_plans", "allowed_amount_index", "explode_outer_rows",
             "rates_fact", "provider_groups", "contract_audit", "array_chunks", "structured_chunks",
             "multi_path_split", "split_by_field", "plan_file_links"]


@pytest.fixture(scope="module")
def plans(spark):
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        return {n: fn(spark, SF_SMALL)._jdf.queryExecution().executedPlan().toString()
                for n, fn in E.queries().items()}
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_no_cross_joins_and_no_row_python(plans):
    for name, plan in plans.items():
        assert "CartesianProduct" not in plan, name
        assert "BroadcastNestedLoopJoin" not in plan, name
        assert "BatchEvalPython" not in plan, name


def test_row_local_operators_have_no_exchange(plans):
    for name in ROW_LOCAL:
        assert "Exchange" not in plans[name], name


def test_change_feed_needs_no_join(plans):
    assert "Join" not in plans["change_feed"]
