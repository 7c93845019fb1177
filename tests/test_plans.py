"""Physical plans: what is read, what is shuffled, and what must not occur."""

from __future__ import annotations

import re

import pytest

from riskloom.plans.catalog import QUERIES

# These run a whole job while they are built; the plans of their parts are checked elsewhere.
JOBS = {n for n in QUERIES if n.startswith(("model_", "jdbc_", "stream_", "live_"))} | {
    "csv_ingest", "partitioned_year", "ingest_report", "ingest_latest", "export_csv",
    "dashboard_from_summary",
}

# Shuffles per query, broadcasts not counted. A sort of the result counts as one.
SHUFFLES = {
    "risk_score": 0,
    "year_slice": 0,
    "drop_incomplete": 0,
    "category_labels": 0,
    "display_view": 0,
    "filtered_predictions": 0,
    "message_text": 0,
    "json_round_trip": 0,
    "json_decode_props": 0,
    "union_feeds": 0,
    "train_test_split": 0,
    "feature_rows": 0,
    "non_null_counts": 1,
    "risk_bucketize": 1,
    "ingest_partition_columns": 1,
    "quarantine_counts": 1,
    "quarantine_reasons": 1,
    "latest_reports": 1,
    "confusion_matrix": 2,
    "category_distribution": 2,
    "actual_vs_predicted": 2,
    "risk_over_time": 2,
    "mean_risk_by_state_nocode": 2,
    "top_high_risk_states": 1,
    "top_high_risk_states_distinct": 2,
    "high_risk_table": 1,
    "date_bounds": 1,
    "filtered_count": 1,
    "profile": 1,
    "quantiles": 1,
    "correlations": 1,
    "training_weights": 1,
}


@pytest.fixture(scope="module")
def plans(spark, sf_dir, plan_of):
    return {name: plan_of(QUERIES[name](spark, sf_dir)) for name in sorted(set(QUERIES) - JOBS)}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - JOBS))
def test_no_python_and_no_cross_join(plans, name):
    for operator in ("EvalPython", "MapInPandas", "CartesianProduct", "NestedLoopJoin"):
        assert operator not in plans[name]


@pytest.mark.parametrize("name", sorted(SHUFFLES))
def test_number_of_shuffles(plans, name):
    tree = plans[name].split("(1) ")[0]
    assert len(re.findall(r"[ -]Exchange \(", tree)) == SHUFFLES[name]


@pytest.mark.parametrize("name", sorted(set(QUERIES) - JOBS))
def test_reports_are_never_broadcast(plans, name):
    tree = plans[name].split("(1) ")[0]
    assert "BuildLeft" not in tree


@pytest.mark.parametrize(
    "name,columns",
    [
        ("date_bounds", 6),
        ("category_distribution", 6),
        ("top_high_risk_states", 6),
        ("ingest_partition_columns", 2),
        ("quarantine_counts", 6),
    ],
)
def test_only_needed_columns_are_read(plans, name, columns):
    schema = next(
        line for line in plans[name].splitlines() if "ReadSchema" in line and "l_suppkey" in line
    )
    assert len(re.findall(r"\w+:\w+", schema.split("struct<")[1])) == columns


def test_date_range_reaches_the_scan(plans):
    for name in ("year_slice", "filtered_predictions", "filtered_count"):
        assert "GreaterThanOrEqual(l_shipdate" in plans[name]


def test_state_reaches_the_scan(plans):
    assert "EqualTo(n_name,NATION_3)" in plans["filtered_predictions"]
