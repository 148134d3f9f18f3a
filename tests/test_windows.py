from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark.operators import recency, windows
from tidemark.operators.windows import Agg
from tidemark.plans.inputs import events

T0 = dt.datetime(2026, 4, 22, 10)


@pytest.fixture(scope="module")
def four(spark):
    rows = [("U1", 1.0, 0), ("U1", 2.0, 5), ("U1", 3.0, 30), ("U2", 5.0, 0)]
    return spark.createDataFrame(
        [(u, a, T0 + dt.timedelta(minutes=m)) for u, a, m in rows], "user_id string, amount double, event_time timestamp"
    )


def test_rolling_count(four):
    got = {r.user_id: r.rolling_count for r in windows.rolling_count(four, "user_id", "event_time").collect()}
    assert got == {"U1": 3, "U2": 1}


def test_rolling_sum_and_avg(four):
    got = {r.user_id: r.rolling_sum_amount for r in windows.rolling_sum(four, "user_id", "event_time", "amount").collect()}
    assert got == {"U1": 6.0, "U2": 5.0}
    assert {"window_start", "window_end"} <= set(windows.rolling_avg(four, "user_id", "event_time", "amount").columns)


def test_all_null_sum_is_null(spark):
    df = spark.createDataFrame([("a", None, T0)], "user_id string, amount double, event_time timestamp")
    assert windows.rolling_sum(df, "user_id", "event_time", "amount").first().rolling_sum_amount is None


def test_sliding_panes_equal_direct_windows(spark, sf):
    ev = events(spark, sf)
    aggs = {"n": Agg("count"), "s": Agg("sum", "amount"), "a": Agg("avg", "amount"), "hi": Agg("max", "amount")}
    panes = windows.rolling_agg(ev, "user_id", "event_ts", "1 hour", "10 minutes", aggs)
    direct = (
        ev.groupBy("user_id", F.window("event_ts", "1 hour", "10 minutes").alias("w"))
        .agg(F.count("*").alias("n"), F.sum("amount").alias("s"), F.avg("amount").alias("a"), F.max("amount").alias("hi"))
        .select("user_id", "n", "s", "a", "hi", F.col("w.start").alias("window_start"), F.col("w.end").alias("window_end"))
    )
    digits = {c: F.round(c, 6) for c in ("s", "a")}
    assert panes.withColumns(digits).exceptAll(direct.withColumns(digits)).isEmpty()
    assert panes.count() == direct.count()


def test_window_longer_than_slide_without_whole_panes(four):
    out = windows.rolling_count(four, "user_id", "event_time", "10 minutes", "4 minutes")
    assert out.agg(F.sum("rolling_count")).first()[0] > 4


def test_approximate_distinct_is_close(spark, sf):
    ev = events(spark, sf)
    a = windows.distinct_count_rolling(ev, "user_id", "event_ts", "product_id")
    b = windows.distinct_count_rolling(ev, "user_id", "event_ts", "product_id", exact=True, out="exact")
    worst = a.join(b, ["user_id", "window_start"]).agg(
        F.max(F.abs(F.col("distinct_product_id_count") - F.col("exact")) / F.col("exact"))
    )
    assert worst.first()[0] <= 0.1


def test_sketched_recency_is_close_to_exact(spark, sf):
    ev = events(spark, sf)
    a = windows.user_recency_sliding(ev)
    b = windows.user_recency_sliding(ev, exact_distinct=True)
    joined = a.alias("a").join(b.alias("b"), ["user_id", "event_time"])
    assert joined.count() == a.count() == b.count()
    assert joined.where("abs(a.distinct_products_last_1h - b.distinct_products_last_1h) > 1").isEmpty()


def test_ratio_zero_denominator(spark):
    df = spark.createDataFrame([("a", "purchase", T0)], "u string, k string, t timestamp")
    row = windows.ratio_feature(df, "u", "k", "t", "purchase", "view").first()
    assert (row.num_cnt, row.denom_cnt, row.event_ratio) == (1, 0, 0.0)


def _rounded(df):
    doubles = [c for c, t in df.dtypes if t == "double"]
    return df.withColumns({c: F.round(c, 6) for c in doubles})


@pytest.mark.parametrize("size", [3, 40])
@pytest.mark.parametrize(
    "build",
    [
        lambda ev, n: recency.time_since_last_event(ev, "user_id", "event_ts", "event_ts", tiebreak="event_id", rows_per_slice=n),
        lambda ev, n: recency.user_recency_trailing(ev, rows_per_slice=n),
        lambda ev, n: recency.gap_reset_counters(ev, "user_id", "event_ts", tiebreak="event_id", rows_per_slice=n),
        lambda ev, n: recency.gap_reset_counters(
            ev, "user_id", "event_ts", "1 hour", "10 hours", tiebreak="event_id", rows_per_slice=n
        ),
        lambda ev, n: recency.sessionize(ev, "user_id", "event_ts", "3 hours", rows_per_slice=n),
    ],
    ids=["since_last", "trailing", "gaps", "long_gaps", "sessions"],
)
def test_slicing_hot_users_changes_nothing(spark, sf, build, size):
    """One user owns half of the events; the slices must not show."""
    ev = events(spark, sf).withColumn("user_id", F.when(F.col("event_id") % 2 == 0, F.lit(7)).otherwise(F.col("user_id")))
    whole, sliced = _rounded(build(ev, 10**9)), _rounded(build(ev, size))
    assert whole.exceptAll(sliced).isEmpty() and sliced.exceptAll(whole).isEmpty()


def _gap_events(spark, seconds, types=None, amounts=None):
    n = len(seconds)
    rows = [
        (i, "u", (types or ["view"] * n)[i], f"p{i % 2}", (amounts or [None] * n)[i], T0 + dt.timedelta(seconds=s))
        for i, s in enumerate(seconds)
    ]
    return spark.createDataFrame(
        rows, "event_id long, user_id string, event_type string, product_id string, amount double, event_ts timestamp"
    )


@pytest.mark.parametrize("slice_rows", [10**9, 1])
def test_gap_boundaries(spark, slice_rows):
    """A gap of exactly 300 s or 3 600 s goes on; one second more restarts."""
    ev = _gap_events(spark, [0, 300, 601, 601 + 3600, 601 + 3600 + 3601])
    rows = recency.gap_reset_counters(
        ev, "user_id", "event_ts", tiebreak="event_id", rows_per_slice=slice_rows
    ).orderBy("event_id").collect()
    assert [r.events_last_5min for r in rows] == [1, 2, 1, 1, 1]
    assert [r.events_last_1h for r in rows] == [1, 2, 3, 4, 1]
    assert [r.distinct_products_last_1h for r in rows] == [1, 2, 2, 2, 1]
    assert [r.seconds_since_last_event for r in rows] == [0, 300, 301, 3600, 3601]


def test_missing_amounts_do_not_count(spark):
    ev = _gap_events(spark, [0, 10, 20], ["purchase"] * 3, [10.0, None, 20.0])
    last = recency.gap_reset_counters(ev, "user_id", "event_ts", tiebreak="event_id").orderBy("event_id").collect()[-1]
    assert (last.orders_last_1h, last.order_value_last_1h, last.avg_order_value_last_1h) == (2, 30.0, 15.0)


def test_trailing_frames_hold_infinities_and_ties(spark):
    inf = float("inf")
    ev = _gap_events(spark, [0, 0, 300, 301, 4000], ["purchase"] * 5, [inf, 1.0, 2.0, float("nan"), 3.0])
    rows = recency.user_recency_trailing(ev).orderBy("event_id").collect()
    assert [r.events_last_5min for r in rows] == [2, 2, 3, 2, 1]
    values = [r.avg_order_value_last_1h for r in rows]
    assert values[:3] == [inf, inf, inf] and values[3] != values[3] and values[4] == 3.0


def test_sessions_merge_at_the_gap(spark):
    ev = _gap_events(spark, [0, 300, 601])
    got = recency.sessionize(ev, "user_id", "event_ts", "5 minutes").orderBy("session_start").collect()
    assert [r.n_events for r in got] == [2, 1]


def test_salted_windows_have_narrow_keys_and_equal_the_plain_form(spark):
    """Rows without time have no window, times before 1970 have theirs; no struct of two times is shuffled."""
    rows = [(1, "1969-12-31 23:59:59.999999", 1.5), (1, "1970-01-01 00:00:00", 2.0), (1, None, 9.0), (2, "2024-02-29 10:59:59", None)]
    rows += [(2, f"2024-02-29 10:{m:02d}:00", float(m)) for m in range(0, 60, 7)]
    df = spark.createDataFrame(rows, "u long, at string, x double").withColumn("at", F.col("at").cast("timestamp"))
    aggs = {"n": windows.Agg("count"), "s": windows.Agg("sum", "x"), "m": windows.Agg("avg", "x")}
    for length in ("1 hour", "7 days"):
        salted = windows.salted_rolling_agg(df, "u", "at", length, aggs, salts=3)
        plain = windows.rolling_agg(df.where("at is not null"), "u", "at", length, None, aggs)
        assert [(f.name, f.dataType) for f in salted.schema] == [(f.name, f.dataType) for f in plain.schema]
        assert sorted(salted.collect()) == sorted(plain.collect())
    keyed = salted._jdf.queryExecution().optimizedPlan().toString()
    assert "named_struct(start" not in keyed
