"""Shapes of physical plans that must hold whatever the data size."""

import pytest

import __spark_entry__ as entry

QUERIES = entry.queries()
CHECKED = [
    "clean_transactions",
    "profile_daily",
    "correlation_long",
    "without_outliers",
    "minmax_prev_day",
    "standard_scaled",
    "weighted_rows",
    "mannwhitney_stat",
    "psi",
    "evaluate_models",
    "bootstrap_ci",
    "multi_view_features",
    "asof_range_join",
    "online_latest",
]


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", CHECKED)
def test_no_cross_join_and_no_single_task_window(spark, sf_dir, name):
    plan = _plan(QUERIES[name](spark, sf_dir))
    assert "CartesianProduct" not in plan and "BroadcastNestedLoopJoin" not in plan
    lines = plan.splitlines()
    for i, line in enumerate(lines):
        if "Window [" in line:
            assert not any("SinglePartition" in below for below in lines[i + 1 : i + 4]), line


@pytest.mark.parametrize("name", ["clean_transactions", "profile_daily", "evaluate_models", "asof_features"])
def test_unused_columns_are_not_read(spark, sf_dir, name):
    assert "props" not in _plan(QUERIES[name](spark, sf_dir))


def test_filters_reach_the_scan(spark, sf_dir):
    plan = _plan(QUERIES["asof_features"](spark, sf_dir))
    assert "EqualTo(event_type,signup)" in plan
    assert "GreaterThanOrEqual(ts" in _plan(QUERIES["one_day_slice"](spark, sf_dir))


def test_day_samples_are_cut_before_the_shuffle(spark, sf_dir):
    for name in ("hash_sample_by_day", "data_summary"):
        assert _plan(QUERIES[name](spark, sf_dir)).count("WindowGroupLimit") == 2
