"""Slices of busy entities, and sums that must come back to where they were."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from tidemark.functions.timecols import micros
from tidemark.operators.recency import Trailing, trailing_agg, user_recency_trailing
from tidemark.operators.skew import SLICE, add_slices, find_hot_keys

T0 = datetime(2024, 1, 1, tzinfo=timezone.utc)


def test_stray_times_and_bursts_do_not_fill_a_slice(spark):
    """One row at the epoch, half of the rows in one second, the others over a month."""
    burst = spark.range(50_000).selectExpr("'a' as u", "1700000000000000 + id * 20 as t")
    month = spark.range(50_000).selectExpr("'a' as u", "1700000000000000 + id * 50000000 as t")
    stray = spark.createDataFrame([("a", 0), ("b", 5), ("b", None), (None, 1)], "u string, t long")
    rows = burst.unionByName(month).unionByName(stray)
    hot = find_hot_keys(rows, ["u"], "t", 1000)
    assert hot.count == 1
    sliced = add_slices(rows, ["u"], "t", hot)
    sizes = [r["count"] for r in sliced.where("u = 'a'").groupBy(SLICE).count().collect()]
    assert max(sizes) <= 2000 and len(sizes) >= 90 and sum(sizes) == 100_001
    assert sliced.where(f"u = 'a' and {SLICE} < 0").isEmpty()
    assert sliced.where(f"coalesce(u, '') <> 'a' and {SLICE} >= 0").isEmpty()


def test_every_key_above_the_limit_is_hot(spark):
    rows = spark.range(3000).selectExpr("id % 300 as u", "id as t")
    assert find_hot_keys(rows, ["u"], "t", 9).count == 300
    assert find_hot_keys(rows, ["u"], "t", 10) is None
    one_instant = spark.range(100).selectExpr("1 as u", "7L as t")
    assert find_hot_keys(one_instant, ["u"], "t", 10) is None


def test_cuts_keep_their_distance(spark):
    rows = spark.range(1000).selectExpr("1 as u", "id as t")
    cuts = find_hot_keys(rows, ["u"], "t", 10, min_width=200).frame.first()["cuts"]
    assert cuts[0] == 0 and all(b - a >= 200 for a, b in zip(cuts, cuts[1:]))


def _events(spark, rows):
    full = [(i, "u", T0 + timedelta(minutes=m), "purchase", 1, float(a)) for i, (m, a) in enumerate(rows)]
    return spark.createDataFrame(full, "event_id long, user_id string, event_ts timestamp, event_type string, product_id int, amount double")


@pytest.mark.parametrize("size", [2, 1000])
def test_trailing_average_of_mixed_magnitudes(spark, size):
    ev = _events(spark, [(0, 1e17), (30, 1.0), (70, 2.0), (75, 0.1), (200, 1e17), (230, 0.25), (262, 0.5)])
    got = {r.event_id: r.avg_order_value_last_1h for r in user_recency_trailing(ev, rows_per_slice=size).collect()}
    assert got[2] == 1.5 and got[3] == pytest.approx(3.1 / 3, rel=1e-12) and got[6] == 0.375


def test_trailing_sums_equal_exact_sums(spark):
    import random
    from fractions import Fraction

    rng = random.Random(1)
    rows = [(m, rng.choice([1e-3, 1.0, 1e4, 1e9, 1e15]) * round(rng.uniform(-9, 9), 3)) for m in range(0, 600, 7)]
    spec = {"s": Trailing("sum", "1 hour", "amount")}
    got = {r.event_id: r.s for r in trailing_agg(_events(spark, rows), "user_id", "event_ts", spec, 10).collect()}
    for i, (m, _) in enumerate(rows):
        exact = sum(Fraction(repr(a)) for n, a in rows if m - 60 <= n <= m)
        assert got[i] == pytest.approx(float(exact), rel=1e-12, abs=1e-9)


def test_merge_takes_one_row_a_key(spark, tmp_path):
    from tidemark.sinks.tables import VersionedTable, write_features

    table = VersionedTable(spark, str(tmp_path / "t"), ["k"])
    schema = "k string, x int, event_time timestamp"
    write_features(spark.createDataFrame([("a", 1, T0), (None, 1, T0)], schema), table)
    batch = [("a", 2, T0 + timedelta(hours=1)), ("a", 3, T0 + timedelta(hours=2)), (None, 4, T0), ("b", 5, None)]
    write_features(spark.createDataFrame(batch, schema), table)
    assert sorted(((r.k or "", r.x) for r in table.read().collect())) == [("", 4), ("a", 3), ("b", 5)]


def test_neighbours_are_ranked_by_full_distances(spark):
    from tidemark.operators.embeddings import knn

    base = spark.createDataFrame([(1, [1.0, 0.0]), (2, [1.0 + 1e-11, 0.0]), (3, [0.0, 1.0])], "id long, v array<double>")
    asked = spark.createDataFrame([(7, [1.0, 0.5]), (None, [1.0, 0.0])], "q long, v array<double>")
    for limit in (4096, 0):
        got = knn(asked, base, "q", "v", "id", "v", 1, "ip", max_broadcast_queries=limit).collect()
        assert [(r.query_id, r.neighbor_id) for r in got] == [(7, 2)]
