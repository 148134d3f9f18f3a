"""The shape of physical plans: what is shuffled, joined and pushed down."""

from __future__ import annotations

import re

import pytest

import __spark_entry__ as driver
from tidemark.operators import recency, windows
from tidemark.plans import stores
from tidemark.plans.inputs import events

#: Queries that do their work while they are built; what they return is a plain read of a table.
EAGER = {"gap_reset_stream", "user_recency_stream", "batch_scores", "tree_importances", *stores.QUERIES}


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name", sorted(set(driver.queries()) - EAGER))
def test_no_query_pairs_rows_or_runs_python_row_by_row(name, spark, sf):
    text = plan(driver.queries()[name](spark, sf))
    assert "CartesianProduct" not in text and "NestedLoopJoin" not in text and "BatchEvalPython" not in text


@pytest.mark.parametrize("name", ["user_recency_trailing", "gap_reset_counters", "time_since_last_event", "sessionize", "training_set"])
def test_ordered_scans_shuffle_once(name, spark, sf):
    assert plan(driver.queries()[name](spark, sf)).count("Exchange hashpartitioning") == 1


def test_sliced_counters_shuffle_the_events_once(spark, sf):
    """With hot users, every join on (entity, slice) finds the event side already partitioned."""
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        text = plan(recency.gap_reset_counters(events(spark, sf), "user_id", "event_ts", tiebreak="event_id", rows_per_slice=20))
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)
    lines = text.split("\n")
    depth = [len(re.match(r"[ :+\-|]*", x).group()) for x in lines]
    joins = [i for i, x in enumerate(lines) if "SortMergeJoin" in x]
    assert len(joins) >= 3
    # Walk the left spine from the top join to the first exchange: no exchange between the joins.
    spine, level = [], -1
    for i in range(joins[0], len(lines)):
        if depth[i] > level:
            spine.append(lines[i])
            level = depth[i]
        if "Exchange" in lines[i]:
            break
    assert sum("SortMergeJoin" in x for x in spine) == 3
    assert sum("Exchange" in x for x in spine) == 1


def test_windows_combine_before_the_shuffle(spark, sf):
    text = plan(windows.rolling_count(events(spark, sf), "user_id", "event_ts"))
    assert "partial_count" in text


def test_filters_and_columns_reach_the_scan(spark, sf):
    df = windows.rolling_count(events(spark, sf).where("event_type = 'click'"), "user_id", "event_ts")
    text = plan(df)
    assert "EqualTo(event_type,click)" in text
    schema = re.search(r"ReadSchema: struct<([^>]*)>", text).group(1)
    assert {c.split(":")[0] for c in schema.split(",")} == {"ts", "user_id", "event_type"}


@pytest.mark.parametrize("name", ["alert_severity", "knn_cosine"])
def test_top_k_is_limited_before_the_shuffle(name, spark, sf):
    assert "WindowGroupLimit" in plan(driver.queries()[name](spark, sf))
