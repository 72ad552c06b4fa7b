"""The physical plans are those wanted: pushed filters, pruned columns, few shuffles."""

from __future__ import annotations

import re

import pytest

from millrace.plans import QUERIES
from millrace.plans.inputs import table

SF_DIR = "/root/testdata/sf0.001"


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def plan(spark, name: str) -> str:
    return plan_of(QUERIES[name](spark, SF_DIR))


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_no_cross_joins_and_no_python(spark, name):
    text = plan(spark, name)
    for bad in ("CartesianProduct", "NestedLoopJoin", "Python", "Pandas"):
        assert bad not in text


@pytest.mark.parametrize("name", ["scan_initial", "scan_middle", "scan_final"])
def test_key_ranges_reach_the_scan(spark, name):
    text = plan(spark, name)
    assert re.search(r"PushedFilters: \[.*(LessThan|GreaterThan)", text)
    assert "Exchange" not in text


@pytest.mark.parametrize("name, shuffles", [
    ("current_state", 1), ("latest_delta", 1), ("dedup_deliveries", 1), ("count_by_phase", 1),
    ("count_by_op", 1), ("high_water", 1), ("union_phases", 0), ("position_encode", 0),
    ("log_from_position", 0), ("split_key_updates", 0), ("changed_columns", 0),
])
def test_number_of_shuffles(spark, name, shuffles):
    assert plan(spark, name).count("Exchange hashpartitioning") == shuffles


def test_counts_read_only_what_they_count(spark):
    text = plan(spark, "count_by_op")
    assert "event_type" in text and "value" not in text.split("ReadSchema")[-1]
    assert "c_mktsegment" not in text


@pytest.mark.parametrize("name", ["join_table_map", "asof_table_map"])
def test_the_log_stays_in_place_for_a_small_map(spark, name):
    text = plan(spark, name)
    assert "BroadcastHashJoin" in text
    assert "Exchange hashpartitioning" not in text.split("BroadcastExchange")[0]


def test_only_slice_tables_go_to_one_task(spark):
    """A single-partition exchange is fed by one row per slice only."""
    for name in ("split_points", "position_rank", "image_breaks"):
        for below in plan(spark, name).split("Exchange SinglePartition")[1:]:
            fed_by = below.split("\n")[1]
            assert "Aggregate" in fed_by or "Project" in fed_by


def test_tables_have_rows(spark):
    assert table(spark, SF_DIR, "events").count() > 0
