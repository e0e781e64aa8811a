"""Plan checks: no cartesian products, no Python UDFs, filters reach the scan."""

import pytest

from handover.plans.queries import QUERIES
from conftest import SF_SMALL

FORBIDDEN = ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "PythonUDF")


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(n for n in QUERIES if n != "q_audit_stream"))
def test_no_cartesian_or_python(spark, name):
    plan = _plan(QUERIES[name](spark, SF_SMALL))
    for bad in FORBIDDEN:
        assert bad not in plan, f"{name}: {bad}"


def test_report_filter_pushed_to_scan(spark):
    plan = _plan(QUERIES["q_purchase_report_category"](spark, SF_SMALL))
    assert "PushedFilters: [IsNotNull(o_orderdate), GreaterThanOrEqual(o_orderdate" in plan


def test_column_pruning(spark):
    plan = _plan(QUERIES["q_loyal_customers"](spark, SF_SMALL))
    assert "ReadSchema: struct<l_orderkey:bigint,l_partkey:bigint>" in plan


@pytest.mark.parametrize("name", ["q_validate_transactions", "q_load_order_details", "q_loyal_customers", "q_audit_log", "q_error_report"])
def test_no_window_over_data_keys(spark, name):
    import re

    plan = _plan(QUERIES[name](spark, SF_SMALL))
    for spec in re.findall(r"Window \[.*?windowspecdefinition\(([^,]*)", plan):
        assert "__ho_pid" in spec, f"{name}: window over {spec}"


def test_line_cascade_does_not_shuffle_the_lines(spark):
    """With few duplicates and few invalid items (the usual case) the staged
    lines pass the whole cascade in one map-only stage."""
    df = QUERIES["q_validate_transactions"](spark, SF_SMALL)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString()
    assert "isFinalPlan=true" in final
    assert "hashpartitioning(item_ref" not in final
    assert "hashpartitioning(batch_ref" not in final
    assert final.count("BroadcastHashJoin") >= 2


def test_order_lines_aggregate_once(spark):
    plan = _plan(QUERIES["q_load_order_details"](spark, SF_SMALL))
    final_aggs = [l for l in plan.splitlines() if "HashAggregate(keys=[batch_ref" in l and "partial_" not in l]
    assert len(final_aggs) == 1, final_aggs


def test_category_reaches_part_scan(spark):
    plan = _plan(QUERIES["q_purchase_report_category"](spark, SF_SMALL))
    assert "EqualTo(p_type,PROMO)" in plan


def test_loyal_report_reads_lines_once(spark):
    df = QUERIES["q_loyal_customers"](spark, SF_SMALL)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
    assert final.count("FileScan parquet [l_orderkey") == 1
