"""Physical-plan properties: no pair explosion, pruned and pushed-down scans."""

import pytest

import __spark_entry__ as entry
from small_tables import SF_SMALL

AT_RISK = ["m3_user_recs", "m5_similar_artists", "j6_similar_to_top_artist", "m4_mood_recs", "m2_evaluate_ranking",
           "m15_dispatch_requests", "m7_random_discovery", "a12_seed_overlap_top_users", "a10_retention"]


def _plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", AT_RISK)
def test_no_cross_join(spark, name):
    plan = _plan(entry.queries()[name](spark, SF_SMALL))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_charts_read_only_train_and_three_columns(spark):
    plan = _plan(entry.queries()["m6_top_charts"](spark, SF_SMALL))
    assert "NOT is_test" in plan  # partition filter on the written split
    assert "ReadSchema: struct<user_id:string,artist_name:string,play_count:bigint>" in plan


def test_error_metric_pushes_filter_into_scan(spark):
    df = entry.queries()["r4_errors_by_kind"](spark, SF_SMALL)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(event_type,error)" in plan
    assert "ReadSchema: struct<event_type:string>" in plan
