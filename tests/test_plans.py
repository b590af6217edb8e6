"""Plan-shape checks: scans, aggregation strategy, no Python, no cartesian products."""

import re

from conftest import SF_SMALL

from wideloom.plans.registry import QUERIES


def _plan(df):
    df.write.format("noop").mode("overwrite").save()
    plan = df._jdf.queryExecution().executedPlan().toString()
    # the adaptive plan string lists the final plan, then the initial one
    return plan.split("== Initial Plan ==")[0]


def _scans(plan, table):
    return len(re.findall(rf"FileScan parquet [^\n]*/{table}\.parquet", plan))


def test_order_windows_one_scan_hash_aggregate(spark):
    plan = _plan(QUERIES["order_windows"](spark, SF_SMALL))
    assert _scans(plan, "lineitem") == 1 and _scans(plan, "orders") == 1
    assert "SortAggregate" not in plan
    assert "PushedFilters: [IsNotNull(l_linestatus), EqualTo(l_linestatus,F)" in plan
    assert "GreaterThanOrEqual(o_orderdate" in plan  # widest window bound reaches the orders scan


def test_wide_profile_one_pass_per_source(spark):
    plan = _plan(QUERIES["wide_profile"](spark, SF_SMALL))
    assert _scans(plan, "events") == 1
    assert _scans(plan, "customer") == 1
    assert _scans(plan, "lineitem") <= 2  # order pass + top-N items (different grain)
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
        assert bad not in plan


def test_no_python_or_cartesian_anywhere(spark):
    for name in ("typed_export", "doc_project", "doc_list_last", "date_dim_by_range", "cells_sorted"):
        plan = _plan(QUERIES[name](spark, SF_SMALL))
        for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin"):
            assert bad not in plan, (name, bad)
