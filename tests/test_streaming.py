from __future__ import annotations

import datetime as dt
import json
import uuid

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tidemark.operators import quality
from tidemark.operators.recency import gap_reset_counters
from tidemark.operators.windows import rolling_count, user_recency_sliding
from tidemark.plans.inputs import events
from tidemark.sources import readers
from tidemark.streaming import recency as stream

T0 = dt.datetime(2026, 4, 22, 10)


COLUMNS = "event_id long, user_id string, event_type string, product_id string, amount double, event_ts timestamp"


def write_batches(spark, tmp_path, *batches):
    """One file per micro-batch."""
    path = str(tmp_path / "in")
    for rows in batches:
        data = [(i, u, k, p, a, T0 + dt.timedelta(seconds=s)) for i, u, k, p, a, s in rows]
        spark.createDataFrame(data, COLUMNS).coalesce(1).write.mode("append").parquet(path)
    schema = spark.read.parquet(path).schema
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(path)


def drain(spark, tmp_path, df, mode):
    name = f"m{uuid.uuid4().hex}"
    query = (
        df.writeStream.format("memory").queryName(name).outputMode(mode)
        .option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
    )
    query.awaitTermination()
    return spark.table(name)


def test_keyed_state_equals_the_batch_counters(spark, tmp_path, sf):
    """Split in three micro-batches, the last record per user equals the batch result's last row."""
    ev = events(spark, sf).withColumn("user_id", F.col("user_id").cast("string")).select(*[c.split()[0] for c in COLUMNS.split(", ")])
    path = str(tmp_path / "in")
    cuts = ["2024-01-01", "2024-01-11", "2024-01-21", "2024-02-28"]
    for a, b in zip(cuts, cuts[1:]):
        ev.where((F.col("event_ts") >= a) & (F.col("event_ts") < b)).coalesce(1).write.mode("append").parquet(path)
    src = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(path)
    got = {r.user_id: r for r in drain(spark, tmp_path, stream.gap_reset_stream(src), "update").orderBy("event_time").collect()}
    want = {
        r.user_id: r
        for r in gap_reset_counters(ev, "user_id", "event_ts", tiebreak="event_id").orderBy("event_ts").collect()
    }
    assert set(got) == set(want)
    for user, w in want.items():
        g = got[user]
        for c in ("events_last_5min", "events_last_1h", "distinct_products_last_1h", "orders_last_1h"):
            assert g[c] == w[c], (user, c)
        assert g.order_value_last_1h == pytest.approx(w.order_value_last_1h)
        assert g.event_time == w.event_ts


def test_state_goes_on_over_micro_batches(spark, tmp_path):
    src = write_batches(
        spark,
        tmp_path,
        [(1, "u", "purchase", "p1", 10.0, 0), (2, "u", "view", "p2", None, 100)],
        [(3, "u", "purchase", "p1", 20.0, 400), (4, "v", "view", None, None, 400)],
        [(5, "u", "view", "p3", None, 701)],
        [(6, "u", "view", "p3", None, 701 + 3601)],
    )
    rows = drain(spark, tmp_path, stream.gap_reset_stream(src), "update").where("user_id = 'u'").orderBy("event_time").collect()
    assert [r.events_last_5min for r in rows] == [2, 3, 1, 1]
    assert [r.events_last_1h for r in rows] == [2, 3, 4, 1]
    assert [r.distinct_products_last_1h for r in rows] == [2, 2, 3, 1]
    assert [r.avg_order_value_last_1h for r in rows] == [10.0, 15.0, 15.0, 0.0]
    assert [r.seconds_since_last_event for r in rows] == [100, 300, 301, 3601]


def test_one_hot_user_in_several_files_and_batches(spark, tmp_path):
    """Two thirds of all events are one user's; files overlap inside a batch, times repeat."""
    rng = np.random.default_rng(4)
    n = 30_000
    gaps = rng.choice([0, 0, 1, 5, 299, 300, 301, 3600, 3601], n, p=[0.4, 0.3, 0.2, 0.08, 0.005, 0.005, 0.005, 0.003, 0.002])
    at = np.cumsum(gaps)
    users = np.where(rng.random(n) < 0.67, "hot", np.char.add("u", rng.integers(0, 20, n).astype(str)))
    kinds, products = rng.choice(["view", "purchase"], n), rng.choice(["a", "b", "c", "d", None], n)
    pdf = pd.DataFrame(
        {"event_id": range(n), "user_id": users, "event_type": kinds, "product_id": products, "amount": rng.integers(0, 100, n) * 1.0, "event_ts": [T0 + dt.timedelta(seconds=int(s)) for s in at]}
    )
    path = str(tmp_path / "in")
    for k in range(3):  # three batches of four files; inside a batch rows are dealt out at random
        part = spark.createDataFrame(pdf.iloc[k * n // 3 : (k + 1) * n // 3], COLUMNS)
        part.repartition(4).write.mode("append").parquet(path)
    ev = spark.createDataFrame(pdf, COLUMNS)
    src = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 4).parquet(path)
    out = drain(spark, tmp_path, stream.gap_reset_stream(src), "update")
    got = {r.user_id: r for r in out.orderBy("event_time").collect()}
    counted = gap_reset_counters(ev, "user_id", "event_ts", tiebreak="event_id")
    want = {r.user_id: r for r in counted.orderBy("event_ts", "event_id").collect()}
    assert set(got) == set(want)
    for user, w in want.items():
        for c in ("events_last_5min", "events_last_1h", "distinct_products_last_1h", "orders_last_1h", "seconds_since_last_event"):
            assert got[user][c] == w[c], (user, c)
        assert got[user].event_time == w.event_ts and got[user].order_value_last_1h == pytest.approx(w.order_value_last_1h)
    assert out.where("user_id = 'hot'").count() == 3


def test_a_hot_user_reaches_its_state_as_few_rows():
    rows = pd.DataFrame(
        {"user_id": "hot", "event_type": "purchase", "product_id": ["a", None] * 5_000, "amount": 1.0,
         "event_ts": [T0 + dt.timedelta(milliseconds=50 * i) for i in range(10_000)]}
    )
    [sums] = list(stream._pane_batches(300_000_000)(iter([rows])))
    assert len(sums) <= 2 * 3 and sums["n"].sum() == 10_000 and sums["value"].sum() == 10_000.0


def test_state_expires_after_the_long_gap(spark, tmp_path):
    """The timer clears a user; a later event starts anew."""
    src = write_batches(
        spark,
        tmp_path,
        [(1, "u", "purchase", "p1", 10.0, 0), (2, "w", "view", "p9", None, 0)],
        [(3, "w", "view", "p9", None, 9000)],
        [(4, "w", "view", "p9", None, 9001)],
        [(5, "u", "view", "p1", None, 20_000)],
    )
    rows = drain(spark, tmp_path, stream.gap_reset_stream(src), "update").orderBy("event_time").collect()
    assert [(r.user_id, r.events_last_1h, r.distinct_products_last_1h, r.orders_last_1h) for r in rows if r.user_id == "u"] == [("u", 1, 1, 1), ("u", 1, 1, 0)]
    assert [(r.events_last_1h, r.seconds_since_last_event) for r in rows if r.user_id == "w"] == [(1, 0), (1, 9000), (2, 1)]


@pytest.mark.parametrize("buckets", [1, 7])
def test_users_that_share_a_state_are_counted_apart(spark, tmp_path, sf, buckets):
    ev = events(spark, sf).withColumn("user_id", F.col("user_id").cast("string")).select(*[c.split()[0] for c in COLUMNS.split(", ")])
    path = str(tmp_path / "in")
    for a, b in (("2024-01-01", "2024-01-15"), ("2024-01-15", "2024-02-28")):
        ev.where((F.col("event_ts") >= a) & (F.col("event_ts") < b)).coalesce(1).write.mode("append").parquet(path)
    src = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(path)
    out = drain(spark, tmp_path, stream.gap_reset_stream(src, buckets=buckets), "update")
    got = {r.user_id: r for r in out.orderBy("event_time").collect()}
    want = {r.user_id: r for r in gap_reset_counters(ev, "user_id", "event_ts", tiebreak="event_id").orderBy("event_ts", "event_id").collect()}
    assert set(got) == set(want) and len(got) > buckets
    for user, w in want.items():
        for c in ("events_last_5min", "events_last_1h", "distinct_products_last_1h", "orders_last_1h"):
            assert got[user][c] == w[c], (user, c)
        assert got[user].event_time == w.event_ts and got[user].order_value_last_1h == pytest.approx(w.order_value_last_1h)


def test_one_user_of_a_shared_state_expires(spark, tmp_path):
    """With one state for all: who expired starts anew, without a previous event; who came again goes on."""
    src = write_batches(
        spark,
        tmp_path,
        [(1, "u", "purchase", "p1", 10.0, 0), (2, "w", "view", "p9", None, 0)],
        [(3, "w", "view", "p9", None, 9000)],
        [(4, "w", "view", "p8", None, 9001)],
        [(5, "u", "view", "p1", None, 9002), (6, "w", "view", "p9", None, 9002)],
    )
    rows = drain(spark, tmp_path, stream.gap_reset_stream(src, buckets=1), "update").orderBy("event_time").collect()
    assert [(r.events_last_1h, r.orders_last_1h, r.seconds_since_last_event) for r in rows if r.user_id == "u"] == [(1, 1, 0), (1, 0, 0)]
    assert [(r.events_last_1h, r.distinct_products_last_1h, r.seconds_since_last_event) for r in rows if r.user_id == "w"] == [
        (1, 1, 0), (1, 1, 9000), (2, 2, 1), (3, 2, 1)
    ]


def test_sliding_stream_equals_batch_on_closed_windows(spark, tmp_path, sf):
    ev = events(spark, sf).withColumn("user_id", F.col("user_id").cast("string")).select(*[c.split()[0] for c in COLUMNS.split(", ")])
    path = str(tmp_path / "in")
    for part in ("< '2024-01-09'", "BETWEEN '2024-01-09' AND '2024-01-19'", "> '2024-01-19'"):
        ev.where(f"event_ts {part}").coalesce(1).write.mode("append").parquet(path)
    src = spark.readStream.schema(ev.schema).option("maxFilesPerTrigger", 1).parquet(path)
    rounded = F.round("avg_order_value_last_1h", 9)
    got = drain(spark, tmp_path, stream.gold(src), "append").withColumn("avg_order_value_last_1h", rounded)
    closed = ev.agg(F.max("event_ts")).first()[0] - dt.timedelta(minutes=10)
    want = stream.gold(ev).where(F.col("event_time") <= closed).withColumn("avg_order_value_last_1h", rounded)
    assert got.columns == want.columns and "distinct_products_last_1h" in got.columns and "ingestion_time" in got.columns
    assert got.count() == want.count() > 0
    assert got.exceptAll(want).isEmpty()
    exact = stream.gold(ev, exact_distinct=True).where(F.col("event_time") <= closed).withColumn("avg_order_value_last_1h", rounded)
    assert got.exceptAll(exact).isEmpty()  # few products: the sketch is exact
    with pytest.raises(ValueError):
        stream.gold(src, exact_distinct=True)


def test_ingestion_time_may_be_given(spark):
    ev = spark.createDataFrame([(1, "u", "view", "p", None, T0)], COLUMNS)
    at = F.lit(T0 + dt.timedelta(days=1))
    assert {r.ingestion_time for r in user_recency_sliding(ev, ingested=at).collect()} == {T0 + dt.timedelta(days=1)}
    assert all(r.ingestion_time == r.event_time for r in user_recency_sliding(ev).collect())


def test_tumbling_features_run_on_streams(spark, tmp_path):
    src = write_batches(spark, tmp_path, [(1, "u", "view", "p", None, 0), (2, "u", "view", "p", None, 60)])
    out = drain(spark, tmp_path, rolling_count(src.withWatermark("event_ts", "10 minutes"), "user_id", "event_ts"), "complete")
    assert [r.rolling_count for r in out.collect()] == [2]


def test_late_events_are_dropped(spark, tmp_path):
    src = write_batches(
        spark,
        tmp_path,
        [(1, "u", "view", "p", None, 0), (2, "u", "view", "p", None, 7200)],
        # Lateness is judged by the watermark of the batch before, so it takes one batch to apply.
        [(3, "u", "view", "p", None, 7300)],
        [(4, "u", "view", "p", None, 10)],
        [(5, "u", "view", "p", None, 30000)],
    )
    out = drain(spark, tmp_path, rolling_count(src.withWatermark("event_ts", "10 minutes"), "user_id", "event_ts"), "append")
    assert {r.window_start: r.rolling_count for r in out.collect()}[T0] == 1


def test_duplicate_deliveries(spark, tmp_path):
    src = write_batches(spark, tmp_path, [(1, "u", "view", "p", None, 0)] * 2, [(1, "u", "view", "p", None, 0), (2, "u", "view", "p", None, 5)])
    assert drain(spark, tmp_path, stream.deduplicated(src, "event_id", "event_ts"), "append").count() == 2
    batch = spark.createDataFrame([(1, T0), (1, T0)], "event_id long, event_ts timestamp")
    assert stream.deduplicated(batch, "event_id", "event_ts").count() == 1


def _raw(spark, payloads):
    return spark.createDataFrame([(p, T0) for p in payloads], "data string, arrival_ts timestamp").select(
        F.base64("data").alias("data"), "arrival_ts"
    )


def test_decoding_poison_records(spark):
    good = json.dumps({"user_id": "U1", "event_type": "view", "product_id": "P", "amount": 1.5, "event_ts": "2026-04-22T10:15:00Z"})
    raw = _raw(spark, [good, "{broken", json.dumps({"event_type": "view"}), "[]", ""]).unionByName(
        spark.createDataFrame([("***not base64", T0), (None, T0), ("//79", T0)], "data string, arrival_ts timestamp")
    )
    decoded = readers.decode_events(raw)
    rows = readers.valid_events(decoded).collect()
    assert [(r.user_id, r.amount, r.event_ts) for r in rows] == [("U1", 1.5, dt.datetime(2026, 4, 22, 10, 15))]
    assert readers.quarantined_events(decoded).count() == 7
    binary = spark.createDataFrame([(bytearray(good, "utf-8"), T0)], "data binary, arrival_ts timestamp")
    assert readers.valid_events(readers.decode_events(binary, base64=False)).count() == 1


def test_raw_stream_to_features(spark, tmp_path):
    payload = json.dumps({"user_id": "U1", "event_type": "view", "product_id": "P", "amount": 1.5, "event_ts": "2026-04-22T10:15:00Z"})
    path = str(tmp_path / "raw")
    _raw(spark, [payload, "{broken", payload]).coalesce(1).write.parquet(path)
    src = spark.readStream.schema(spark.read.parquet(path).schema).parquet(path)
    assert drain(spark, tmp_path, stream.valid_stream(src), "append").count() == 2
    clean, _ = stream.silver(stream.bronze(spark.read.parquet(path)))
    assert clean.count() == 2 and stream.recency_from_raw(spark.read.parquet(path)).count() == 12


def test_expectations_observe_and_quarantine(spark):
    df = spark.createDataFrame(
        [("u", "view", None), (None, "view", None), ("u", None, None), ("u", "purchase", -1.0), ("u", "signup", None)],
        "user_id string, event_type string, amount double",
    )
    seen = Observation("dq")
    kept, lost = quality.apply_expectations(df, quality.event_rules(), seen)
    assert kept.count() == 3
    assert seen.get["rows"] == 5 and seen.get["valid_event_type"] == 2 and seen.get["amount_positive_for_purchase"] == 2
    assert sorted(r.failed_rules for r in lost.collect()) == [["event_not_null"], ["user_id_not_null"]]
