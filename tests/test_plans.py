"""Physical plan properties that matter at scale."""

import pytest

from tidewater.plans.registry import QUERIES

from conftest import SF_SMALL

STREAMING = {"word_count_stream", "event_time_tumbling", "resumable_ingest", "running_max_stream",
             "count_sliding_stream", "order_timeout_stream", "retract_changelog_stream", "tumble_sql_stream",
             "sales_dashboard_stream", "order_timeout_drain_stream", "count_tumbling_stream",
             "split_even_odd_stream", "late_refires_stream", "late_side_output_stream", "sliding_sum_stream",
             "session_sum_stream", "json_status_stream"}


def _plan(spark, name):
    df = QUERIES[name](spark, SF_SMALL)
    return df._jdf.queryExecution().executedPlan().toString()


def test_filters_reach_both_union_scans(spark):
    plan = _plan(spark, "union_filtered")
    assert "PushedFilters: [IsNotNull(c_acctbal), GreaterThan(c_acctbal,2000.0)]" in plan
    assert "PushedFilters: [IsNotNull(s_acctbal), LessThan(s_acctbal,2000.0)]" in plan


def test_scans_read_only_needed_columns(spark):
    plan = _plan(spark, "word_count")
    assert "ReadSchema: struct<text:string>" in plan
    plan = _plan(spark, "running_sum")
    assert "ReadSchema: struct<event_id:bigint,user_id:bigint,value:double>" in plan


def test_lookup_is_a_checked_broadcast(spark):
    assert "BroadcastHashJoin" in _plan(spark, "broadcast_enrich")


def test_top3_limits_before_the_shuffle(spark):
    plan = _plan(spark, "top3_categories")
    assert "WindowGroupLimit" in plan and "Partial" in plan


def test_word_count_combines_on_the_map_side(spark):
    assert "partial_count(1)" in _plan(spark, "word_count")


@pytest.mark.parametrize("name", sorted(set(QUERIES) - STREAMING))
def test_no_cartesian_product_and_no_python_udf(spark, name):
    plan = _plan(spark, name)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan
