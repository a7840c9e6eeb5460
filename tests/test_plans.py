"""Shapes of the plans that have to hold at scale."""

import pytest

from tallymark.plans import catalog, views

SF_DIR = "/root/testdata/sf0.001"


def plan_of(spark, key):
    return catalog.queries()[key](spark, SF_DIR)._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("key", ["fold_state", "fold_state_wide", "state_upsert_wide", "fold_counters"])
def test_folds_are_hash_aggregates(spark, key):
    plan = plan_of(spark, key)
    assert "SortAggregate" not in plan and "ObjectHashAggregate" not in plan
    assert "partial_" in plan


def test_a_fold_shuffles_once(spark):
    assert plan_of(spark, "fold_state_wide").count("Exchange hashpartitioning") == 1


def test_checks_parse_each_text_once(spark):
    # The float pattern is in the generator only, not copied into the filter on its result.
    assert plan_of(spark, "fold_state").count("0[xX]") == 1


@pytest.mark.parametrize("key", ["report_cumulative", "report_overcount", "lookup_many", "batch_atomic", "rename_keys"])
def test_no_cross_joins(spark, key):
    plan = plan_of(spark, key)
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan


def test_scans_read_only_the_used_columns(spark):
    rows = views.samples(spark, SF_DIR).select("poll_id", "Alloc")
    assert "ReadSchema: struct<event_id:bigint,value:double>" in rows._jdf.queryExecution().executedPlan().toString()


def test_samples_need_no_shuffle(spark):
    assert "Exchange" not in plan_of(spark, "collect_samples")
