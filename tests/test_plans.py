"""Plan-shape checks: the physical plans we rely on for scale."""

import pytest

from obs_analytics.plans.registry import REGISTRY

from .conftest import SF001

PY_NODES = ("PythonUDF", "BatchEvalPython", "ArrowEvalPython", "FlatMapGroupsInPandas", "MapInPandas")


def _plan(spark, name):
    df = REGISTRY[name].spark(spark, SF001)
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", [n for n, q in REGISTRY.items() if q.sql])
def test_no_python_in_plans(spark, name):
    plan = _plan(spark, name)
    assert not any(p in plan for p in PY_NODES), plan


def test_pushdown_and_pruning(spark):
    plan = _plan(spark, "trend_assessment_recent")
    assert "GreaterThanOrEqual(l_shipdate,2000-01-01" in plan
    # only the used columns are read from lineitem
    assert "ReadSchema: struct<l_partkey:bigint,l_suppkey:bigint,l_quantity:double,l_shipdate" in plan


def test_global_window_is_partitioned(spark):
    plan = _plan(spark, "trailing_mean_global")
    # the row-level windows run per (bucket) and per (block), never over all rows in one task
    assert "hashpartitioning(_tm_block" in plan
    assert "hashpartitioning(_tm_bucket" in plan and "_tm_tie" in plan


def test_partial_aggregation(spark):
    plan = _plan(spark, "rollup_all")
    assert "partial_avg" in plan and "Expand" in plan


def test_ungrouped_days_shuffle_no_rows(spark):
    """The rows look up their day's mean; only daily partial sums are shuffled
    beyond the adapter's own exchanges, and never to a single task."""
    plan = _plan(spark, "trailing_mean_30d_global")
    assert "partial_sum(TAVG" in plan and "BroadcastHashJoin" in plan
    assert "hashpartitioning(_tm_block" in plan and "SinglePartition" not in plan
