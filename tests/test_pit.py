from __future__ import annotations

import datetime as dt

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.model import Entity, Feature, FeatureView, TrainingSpec, ValueType
from tidemark.functions.timecols import micros
from tidemark.operators.pit import AsOfSource, multi_pit_join, pit_join, pit_join_bucketed, training_set, training_set_for
from tidemark.operators.skew import find_hot_keys
from tidemark.plans.asof import training_inputs
from tidemark.plans.inputs import events, interest, purchases

BASE = dt.datetime(2026, 3, 1)
LABELS = "id long, user string, ts timestamp"
FEATURES = "user string, ft timestamp, made timestamp, x long"


def at(minutes):
    return None if minutes is None else BASE + dt.timedelta(minutes=minutes)


def brute(labels, features, ttl, strict=False, visible=False):
    out = {}
    for i, user, t in labels:
        ok = [
            f
            for f in features
            if user is not None
            and t is not None
            and f[0] == user
            and f[1] is not None
            and (f[1] < t if strict else f[1] <= t)
            and (ttl is None or f[1] > t - dt.timedelta(minutes=ttl))
            and (not visible or (f[2] is not None and f[2] <= t))
        ]
        out[i] = max(ok, key=lambda f: (f[1], f[2] or dt.datetime.min))[3] if ok else None
    return out


minute = st.one_of(st.none(), st.integers(0, 60))
label_rows = st.lists(st.tuples(st.sampled_from(["a", "b", None]), minute), min_size=1, max_size=12)
feature_rows = st.lists(
    st.tuples(st.sampled_from(["a", "b", None]), minute, st.integers(0, 90)), min_size=1, max_size=15, unique=True
)


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(label_rows, feature_rows, st.sampled_from([5, 20, None]), st.sampled_from([1, 4, 10**9]))
def test_all_strategies_match_brute_force(spark, raw_labels, raw_features, ttl, slice_rows):
    labels = [(i, u, at(m)) for i, (u, m) in enumerate(raw_labels)]
    # Rows of one (user, time, made) would be indistinguishable; x follows the row.
    features = [(u, at(m), at(made), i) for i, (u, m, made) in enumerate(raw_features)]
    ldf, fdf = spark.createDataFrame(labels, LABELS), spark.createDataFrame(features, FEATURES)
    limit = f"{ttl} minutes" if ttl else None
    common = dict(created="made", rows_per_slice=slice_rows)

    def got(df):
        return {r.id: r.x for r in df.collect()}

    assert got(pit_join(ldf, fdf, ["user"], "ts", "ft", limit, ["x"], **common)) == brute(labels, features, ttl)
    assert got(pit_join(ldf, fdf, ["user"], "ts", "ft", limit, ["x"], strict=True, **common)) == brute(
        labels, features, ttl, strict=True
    )
    seen = pit_join(ldf, fdf, ["user"], "ts", "ft", limit, ["x"], visible_by="made", **common)
    assert got(seen) == brute(labels, features, ttl, visible=True)
    if ttl:
        assert got(pit_join_bucketed(ldf, fdf, ["user"], "ts", "ft", limit, ["x"], created="made")) == brute(
            labels, features, ttl
        )


def test_documented_example(spark):
    """total_orders 8, 10, 12 at days 10, 15, 20; label at day 15."""
    day = 24 * 60
    f = spark.createDataFrame([("U1", at(d * day), None, v) for d, v in ((10, 8), (15, 10), (20, 12))], FEATURES)
    labels = spark.createDataFrame([(1, "U1", at(15 * day))], LABELS)
    assert pit_join(labels, f, ["user"], "ts", "ft", "30 days", ["x"]).first().x == 10
    assert pit_join(labels, f, ["user"], "ts", "ft", "30 days", ["x"], strict=True).first().x == 8


def test_ttl_boundary_is_exclusive_and_tombstones_hide(spark):
    f = spark.createDataFrame([("a", at(0), None, 1), ("b", at(0), None, 1), ("b", at(5), None, None)], FEATURES)
    labels = spark.createDataFrame([(1, "a", at(10)), (2, "a", at(9)), (3, "b", at(9))], LABELS)
    got = {r.id: r.x for r in pit_join(labels, f, ["user"], "ts", "ft", "10 minutes", ["x"]).collect()}
    assert got == {1: None, 2: 1, 3: None}


def test_inner_drops_unmatched(spark):
    f = spark.createDataFrame([("a", at(0), None, 1)], FEATURES)
    labels = spark.createDataFrame([(1, "a", at(1)), (2, "z", at(1))], LABELS)
    assert [r.id for r in pit_join(labels, f, ["user"], "ts", "ft", "1 hour", ["x"], how="inner").collect()] == [1]
    with pytest.raises(ValueError):
        pit_join(labels, f, ["user"], "ts", "ft", "1 hour", ["x"], how="outer")


def test_duplicate_labels_are_kept(spark):
    f = spark.createDataFrame([("a", at(0), None, 1)], FEATURES)
    labels = spark.createDataFrame([(1, "a", at(1))] * 3, LABELS)
    assert pit_join(labels, f, ["user"], "ts", "ft", "1 hour", ["x"]).count() == 3
    assert pit_join_bucketed(labels, f, ["user"], "ts", "ft", "1 hour", ["x"]).count() == 3


def test_hot_user_slices_on_events(spark, sf):
    hot = F.when(F.col("event_id") % 3 == 0, F.lit(1)).otherwise(F.col("user_id"))
    labels = purchases(spark, sf).withColumn("user_id", hot)
    feats = interest(spark, sf).withColumn("user_id", hot).withColumnRenamed("event_ts", "ft")
    cols = ["amount", "product_id"]
    whole = pit_join(labels, feats, ["user_id"], "event_ts", "ft", "6 hours", cols)
    for other in (
        pit_join(labels, feats, ["user_id"], "event_ts", "ft", "6 hours", cols, rows_per_slice=5),
        pit_join_bucketed(labels, feats, ["user_id"], "event_ts", "ft", "6 hours", cols),
    ):
        assert whole.exceptAll(other).isEmpty() and other.exceptAll(whole).isEmpty()


def test_hot_list_from_other_data(spark, sf):
    """A list whose times cover only the middle of the data slices it all the same."""
    labels, feats = purchases(spark, sf), interest(spark, sf).withColumnRenamed("event_ts", "ft")
    middle = labels.where("event_ts BETWEEN '2024-01-12' AND '2024-01-18'").select("user_id", micros("event_ts").alias("t"))
    hot = find_hot_keys(middle, ["user_id"], "t", 2)
    assert hot is not None and hot.count > 0
    source = [AsOfSource(feats, "ft", {"amount": "x"}, "3 days")]
    whole = multi_pit_join(labels, source, ["user_id"], "event_ts", hot=None)
    sliced = multi_pit_join(labels, source, ["user_id"], "event_ts", hot=hot)
    assert whole.exceptAll(sliced).isEmpty() and sliced.exceptAll(whole).isEmpty()
    assert not sliced.where("x IS NOT NULL AND event_ts < '2024-01-10'").isEmpty()


def test_training_set_selection(spark, sf):
    labels, views = training_inputs(spark, sf)
    out = training_set(labels, views, ["user_id"], "label_ts", ["interest:amount"], exclude=("user_id",))
    assert out.columns == ["event_id", "label_ts", "label", "interest__amount"]
    everything = training_set(labels, views, ["user_id"], "label_ts")
    assert {"interest__product_id", "trouble__event_type"} <= set(everything.columns)
    with pytest.raises(ValueError):
        training_set(labels, views, ["user_id"], "label_ts", ["nothing:amount"])
    with pytest.raises(ValueError):
        training_set(labels, views, ["user_id"], "label_ts", ["interest:nothing"])


def test_composite_keys(spark):
    view = FeatureView(
        "v", (Entity("ab", ("a", "b"), ValueType.INT64),), (Feature("x", ValueType.INT64),), ttl_seconds=3600
    )
    history = spark.createDataFrame([(1, 1, at(0), 5), (1, 2, at(0), 6)], "a long, b long, event_time timestamp, x long")
    labels = spark.createDataFrame([(1, 1, at(1)), (1, 2, at(1)), (2, 1, at(1))], "a long, b long, ts timestamp")
    got = {(r.a, r.b): r.v__x for r in training_set(labels, [(view, history)], ["a", "b"], "ts").collect()}
    assert got == {(1, 1): 5, (1, 2): 6, (2, 1): None}


def test_plan_has_no_join(spark, sf):
    plan = pit_join(
        purchases(spark, sf), events(spark, sf).withColumnRenamed("event_ts", "ft"), ["user_id"], "event_ts", "ft", "6 hours", ["amount"]
    )._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and "Cartesian" not in plan
    assert plan.count("Exchange hashpartitioning") == 1


def keyed_views(spark):
    user = FeatureView("u", (Entity("user", ("user_id",)),), (Feature("x", ValueType.INT32),), ttl_seconds=3600)
    item = FeatureView("i", (Entity("item", ("item_id",)),), (Feature("x", ValueType.INT32),), ttl_seconds=60)
    both = FeatureView("b", (Entity("pair", ("user_id", "item_id")),), (Feature("x", ValueType.INT32),), ttl_seconds=10**9)
    at = lambda s: dt.datetime(2026, 4, 22, 10) + dt.timedelta(seconds=s)
    labels = spark.createDataFrame(
        [(1, "a", "p", at(100)), (2, "a", None, at(100)), (3, None, "p", at(100)), (4, "b", "q", at(200)), (4, "b", "q", at(200)), (5, "c", "p", None)],
        "n int, user_id string, item_id string, ts timestamp",
    )
    stores = [
        (user, spark.createDataFrame([("a", at(0), 1), ("a", at(101), 2), (None, at(0), 3), ("b", at(200), 4)], "user_id string, event_time timestamp, x int")),
        (item, spark.createDataFrame([("p", at(50), 5), ("q", at(100), 6), (None, at(90), 7)], "item_id string, event_time timestamp, x int")),
        (both, spark.createDataFrame([("a", "p", at(-10**7), 8), ("b", "p", at(0), 9)], "user_id string, item_id string, event_time timestamp, x int")),
    ]
    return labels, stores


def test_views_with_their_own_keys(spark):
    labels, stores = keyed_views(spark)
    want = sorted([(1, 1, 5, 8), (2, 1, None, None), (3, None, 5, None), (4, 4, None, None), (4, 4, None, None), (5, None, None, None)], key=str)
    got = training_set(labels, stores, None, "ts").select("n", "u__x", "i__x", "b__x").collect()
    assert sorted(map(tuple, got), key=str) == want
    renamed = labels.withColumnRenamed("user_id", "buyer").withColumnRenamed("item_id", "thing")
    keys = {"u": ["buyer"], "i": ["thing"], "b": ["buyer", "thing"]}
    got = training_set(renamed, stores, keys, "ts").select("n", "u__x", "i__x", "b__x").collect()
    assert sorted(map(tuple, got), key=str) == want
    with pytest.raises(ValueError):
        training_set(renamed, stores, {**keys, "b": ["buyer"]}, "ts")


def test_a_training_set_by_its_specification(spark):
    labels, stores = keyed_views(spark)
    spec = TrainingSpec("labels", ("user_id", "item_id"), "ts", ("u", "i"), ("i:x", "u:x"))
    out = training_set_for(spec, labels, {v.name: (v, df) for v, df in stores}, exclude=("ts",))
    assert out.columns == ["n", "user_id", "item_id", "u__x", "i__x"]
    assert {(r.n, r.u__x, r.i__x) for r in out.collect()} == {(1, 1, 5), (2, 1, None), (3, None, 5), (4, 4, None), (5, None, None)}
    with pytest.raises(ValueError):
        training_set_for(TrainingSpec("labels", ("user_id",), "ts", ("u", "i")), labels, {v.name: (v, df) for v, df in stores})


def test_one_pass_for_each_key_list(spark):
    """Views of one key share a pass: as many exchanges by key as there are key lists, and no join."""
    labels, stores = keyed_views(spark)
    twin = FeatureView("u2", stores[0][0].entities, stores[0][0].features, ttl_seconds=60)
    plan = training_set(labels, [*stores[:2], (twin, stores[0][1])], None, "ts", hot=None)._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in plan and plan.count("Exchange hashpartitioning") == 2
