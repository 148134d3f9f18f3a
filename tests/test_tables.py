from __future__ import annotations

import datetime as dt
import json
import os
from concurrent.futures import ThreadPoolExecutor

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.model import Entity, Feature, FeatureView, SchemaMismatch, ValueType
from tidemark.operators import baseline, lifetime, snapshot
from tidemark.sinks import history_index, tables
from tidemark.sinks.incremental import LifetimeState, fresh_rows, materialize
from tidemark.sources import readers

T0 = dt.datetime(2026, 4, 22, 10)
SCHEMA = "user_id string, event_time timestamp, ingestion_time timestamp, x int"
VIEW = FeatureView("v", (Entity("user", ("user_id",)),), (Feature("x", ValueType.INT32),), ttl_seconds=3600)


def rows(spark, *items):
    data = [(u, None if m is None else T0 + dt.timedelta(minutes=m), T0 + dt.timedelta(minutes=g), x) for u, m, g, x in items]
    return spark.createDataFrame(data, SCHEMA)


def values(df):
    return {r.user_id: r.x for r in df.collect()}


def test_latest_uses_ingestion_for_ties(spark):
    df = rows(spark, ("a", 1, 1, 1), ("a", 5, 5, 2), ("a", 5, 6, 3), ("a", 3, 9, 4), ("b", None, 0, 5), ("b", 0, 0, None))
    assert values(snapshot.latest_per_entity(df, ["user_id"])) == {"a": 3, "b": None}


def test_merge_overwrite_append(spark, tmp_path):
    t = tables.VersionedTable(spark, str(tmp_path / "t"), ["user_id"])
    assert t.read() is None
    r = tables.write_features(rows(spark, ("a", 0, 0, 1), ("b", 0, 0, 2)), t, "merge", VIEW)
    assert r.records_ingested == 2 and r.duration_ms >= 0
    assert tables.write_features(rows(spark, ("b", 1, 1, 20), ("c", 1, 1, 30)), t).records_ingested == 2
    assert values(t.read()) == {"a": 1, "b": 20, "c": 30}
    tables.write_features(rows(spark, ("d", 1, 1, 4)), t, "append")
    assert values(t.read()) == {"a": 1, "b": 20, "c": 30, "d": 4}
    tables.write_features(rows(spark, ("z", 1, 1, 9)), t, "overwrite")
    assert values(t.read()) == {"z": 9}
    with pytest.raises(ValueError):
        tables.write_features(rows(spark), t, "replace")
    with pytest.raises(SchemaMismatch):
        tables.write_features(rows(spark, ("a", 0, 0, 1)).withColumn("y", F.lit(1)), t, "merge", VIEW)


def many(spark, keys, x, minute=0):
    return rows(spark, *[(k, minute, minute, x) for k in keys])


def test_a_merge_rewrites_the_buckets_of_its_keys_only(spark, tmp_path):
    t = tables.VersionedTable(spark, str(tmp_path / "t"), ["user_id"], buckets=32)
    keys = [f"u{i}" for i in range(300)]
    tables.write_features(many(spark, keys, 1), t)
    before = t.manifest()
    tables.write_features(many(spark, keys[:3], 2, 1), t)  # 1 % of the keys
    after = t.manifest()
    changed = {b for b in after.files if after.files[b] != before.files[b]}
    buckets = {str(r[0]) for r in t._bucketed(many(spark, keys[:3], 0), 32).select("__bucket").collect()}
    assert changed == buckets and 1 <= len(changed) <= 3 < len(before.files)
    assert values(t.read()) == {k: 2 if i < 3 else 1 for i, k in enumerate(keys)}
    assert values(t.read(before.version)) == dict.fromkeys(keys, 1)
    tables.write_features(many(spark, keys[:1], 3, 2), t, "append")
    added = t.manifest()
    assert all(set(after.files[b]) <= set(added.files[b]) for b in after.files)
    assert sum(map(len, added.files.values())) == sum(map(len, after.files.values())) + 1


def test_null_keys_and_new_columns(spark, tmp_path):
    t = tables.VersionedTable(spark, str(tmp_path / "t"), ["user_id"], buckets=4)
    tables.write_features(rows(spark, (None, 0, 0, 1), ("a", 0, 0, 1)), t)
    tables.write_features(rows(spark, (None, 1, 1, 2)).withColumn("y", F.lit("new")), t)
    assert {(r.user_id, r.x, r.y) for r in t.read().collect()} == {(None, 2, "new"), ("a", 1, None)}
    for mode in ("merge", "append"):
        assert tables.write_features(rows(spark).where("x > 5"), t, mode).records_ingested == 0
    assert t.read().count() == 2
    assert tables.write_features(rows(spark), t, "overwrite").records_ingested == 0 and t.read().count() == 0


@pytest.mark.parametrize("mode", ["merge", "append"])
def test_two_writers_lose_nothing(spark, tmp_path, mode):
    """Writers that start from one version: the second finds it taken and starts from the first one's."""
    path, shared = str(tmp_path / "t"), [f"s{i}" for i in range(5)]
    tables.write_features(many(spark, [*shared, "old"], 0), tables.VersionedTable(spark, path, ["user_id"], buckets=4))

    def write(n):
        t = tables.VersionedTable(spark, path, ["user_id"], buckets=4)
        tables.write_features(many(spark, [*shared, f"own{n}"], n, n), t, mode)

    with ThreadPoolExecutor(4) as pool:
        list(pool.map(write, range(1, 5)))
    t = tables.VersionedTable(spark, path, ["user_id"])
    assert t.versions() == [0, 1, 2, 3, 4]
    got = t.read().collect()
    assert {r.user_id for r in got} == {*shared, "old", *(f"own{n}" for n in range(1, 5))}
    assert len(got) == (10 if mode == "merge" else 6 + 4 * 6)
    if mode == "merge":  # the last writer's rows, not a mixture of keys
        assert len({r.x for r in got if r.user_id in shared}) == 1


def test_a_stale_merge_is_done_again(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "t")
    one, two = (tables.VersionedTable(spark, path, ["user_id"], buckets=2) for _ in range(2))
    tables.write_features(rows(spark, ("a", 0, 0, 1)), one)
    calls = []

    def combine(old, new):
        calls.append(old.count())
        if len(calls) == 1:
            tables.write_features(many(spark, [f"k{i}" for i in range(20)], 5), two)
        return tables.upsert(old, new, ["user_id"])

    one.merge(rows(spark, ("a", 1, 1, 2)), combine)
    assert len(calls) == 2 and calls[1] > calls[0]
    assert values(one.read()) == {"a": 2, **{f"k{i}": 5 for i in range(20)}}


def test_retention(spark, tmp_path):
    t = tables.VersionedTable(spark, str(tmp_path / "t"), ["user_id"], buckets=2)
    for x in range(4):
        tables.write_features(many(spark, ["a", "b", "c"], x, x), t, "overwrite")
    assert t.retain(2) == 0  # all files are young
    removed = t.retain(2, grace_seconds=0)
    assert removed > 0 and t.versions() == [2, 3]
    assert values(t.read()) == dict.fromkeys("abc", 3) and values(t.read(2)) == dict.fromkeys("abc", 2)
    assert t.retain(2, grace_seconds=0) == 0


def test_an_unfinished_version_is_invisible(spark, tmp_path):
    t = tables.VersionedTable(spark, str(tmp_path / "t"), ["user_id"])
    tables.write_features(rows(spark, ("a", 0, 0, 1)), t)
    bad = rows(spark, ("a", 1, 1, 2)).withColumn("x", F.expr("assert_true(x > 5)").cast("int"))
    with pytest.raises(Exception):
        tables.write_features(bad, t, "overwrite")
    assert values(t.read()) == {"a": 1}


def test_idempotent_append(spark, tmp_path):
    path = str(tmp_path / "h")
    first = rows(spark, ("a", 0, 0, 1), ("a", 0, 5, 2), ("b", 0, 0, 3))
    assert tables.idempotent_append(first, path, ["user_id"]) == 2
    again = rows(spark, ("a", 0, 9, 7), ("a", 60 * 24, 0, 8))
    assert tables.idempotent_append(again, path, ["user_id"]) == 1
    stored = spark.read.parquet(path)
    assert sorted(r.x for r in stored.collect()) == [2, 3, 8]
    assert "event_date" in stored.columns


def test_a_redelivered_batch_reads_only_files_that_may_hold_it(spark, tmp_path):
    path = str(tmp_path / "h")
    for k in range(6):  # six files of one date
        assert tables.idempotent_append(rows(spark, *[(f"u{k}-{i}", i, 0, k) for i in range(40)]).coalesce(1), path, ["user_id"]) == 40
    again = rows(spark, *[(f"u3-{i}", i, 9, 99) for i in range(40)]).withColumn("event_date", F.to_date("event_time"))
    found, there = history_index.candidate_files(again, path, ["user_id"], "event_time")
    assert len(there) >= 6 and 1 <= len(found) <= 2
    assert tables.idempotent_append(again.drop("event_date"), path, ["user_id"]) == 0
    new = rows(spark, *[(f"n{i}", i, 9, 99) for i in range(40)]).withColumn("event_date", F.to_date("event_time"))
    assert len(history_index.candidate_files(new, path, ["user_id"], "event_time")[0]) <= 2
    # A file that no filter describes is read.
    rows(spark, ("loose", 1, 0, 7)).withColumn("event_date", F.to_date("event_time")).write.mode("append").partitionBy("event_date").parquet(path)
    assert tables.idempotent_append(rows(spark, ("loose", 1, 9, 8), ("u0-1", 1, 9, 8), ("late", 1, 9, 8)), path, ["user_id"]) == 1
    stored = spark.read.parquet(path)
    assert stored.count() == 242 and stored.groupBy("user_id", "event_time").count().where("count > 1").isEmpty()


def test_filters_miss_nothing():
    rng = np.random.default_rng(1)
    held, others = (rng.integers(-(2**63), 2**63 - 1, 5_000) for _ in range(2))
    bits = history_index.bloom(held)
    assert all(history_index.may_hold(bits, held[i : i + 1]) for i in range(0, 5_000, 7))
    assert sum(history_index.may_hold(bits, others[i : i + 1]) for i in range(2_000)) < 40


def test_ingest_writes_history_online_and_rejects(spark, tmp_path):
    online = tables.VersionedTable(spark, str(tmp_path / "online"), ["user_id"])
    where = str(tmp_path / "history"), online, str(tmp_path / "rejects")
    r = tables.ingest(rows(spark, ("a", 0, 0, 1), ("a", 5, 5, 2), (None, 0, 0, 3), ("b", None, 0, 4)), VIEW, *where)
    assert (r.records_ingested, r.records_failed) == (2, 2)
    assert sorted(r.failures) == ["null event_time: 1", "null key user_id: 1"]
    r = tables.ingest(rows(spark, ("a", 5, 5, 2), ("a", 3, 7, 9)), VIEW, *where)
    assert (r.records_ingested, r.records_failed) == (1, 0)
    assert values(online.read()) == {"a": 2}  # an older event does not replace the newest
    assert spark.read.parquet(where[0]).count() == 3
    assert spark.read.parquet(where[2]).count() == 2


def test_dual_write(spark):
    df = rows(spark, ("a", 0, 0, 1))

    def fine(d):
        return tables.WriteResult(d.count())

    def broken(d):
        raise RuntimeError("store is down")

    results, errors = tables.dual_write(df, {"one": fine, "two": broken})
    assert results["one"].records_ingested == 1 and errors == ["two: store is down"]
    with pytest.raises(RuntimeError):
        tables.dual_write(df, {"one": broken, "two": fine}, fail_on_either=True)


def test_stream_merge_needs_checkpoint_and_skips_replays(spark, tmp_path):
    t = tables.VersionedTable(spark, str(tmp_path / "t"), ["user_id"])
    src = str(tmp_path / "in")
    rows(spark, ("a", 0, 0, 1), ("a", 2, 2, 2), ("b", 0, 0, 3)).write.parquet(src)
    stream = spark.readStream.schema(spark.read.parquet(src).schema).parquet(src)
    with pytest.raises(ValueError):
        tables.write_features_stream(stream, t, None)

    def run(checkpoint):
        writer = tables.write_features_stream(stream, t, str(tmp_path / checkpoint))
        query = writer.trigger(availableNow=True).start()
        query.awaitTermination()

    run("c1")
    assert values(t.read()) == {"a": 2, "b": 3}
    version = t.state()["version"]
    assert t.state()["streams"] == {"features": 0}
    run("c2")  # a new checkpoint replays batch 0, which the table has seen
    assert t.state()["version"] == version


def test_mirror_embeddings(spark, tmp_path):
    t = tables.VersionedTable(spark, str(tmp_path / "vec"), tables.VECTOR_KEYS)
    schema = "entity_type string, entity_id string, feature_name string, embedding array<float>, metadata map<string,string>"
    one = spark.createDataFrame([("customer", "c-1", "embedding_v1", [0.1, 0.2], {"tenant": "acme"})], schema)
    two = spark.createDataFrame([("customer", "c-1", "embedding_v1", [0.5, 0.5], {"tenant": "b"})], schema)
    tables.mirror_embeddings(one, t)
    tables.mirror_embeddings(two, t)
    (row,) = t.read().collect()
    assert row.doc_id == "customer:c-1:embedding_v1" and row.embedding == [0.5, 0.5] and row.metadata == {"tenant": "b"}


def test_baseline_and_report_artefacts(spark, tmp_path):
    df = spark.createDataFrame([(float(i),) for i in range(20)], "x double")
    stats = baseline.baseline_statistics(df)
    paths = tables.write_baseline(
        df,
        str(tmp_path / "b"),
        baseline.statistics_document(stats, baseline.baseline_buckets(df)),
        baseline.constraints_document(baseline.baseline_constraints(stats)),
    )
    assert json.loads(spark.read.text(paths["stats_path"]).first()[0])["dataset"]["item_count"] == 20
    assert json.loads(spark.read.text(paths["constraints_path"]).first()[0])["features"][0]["name"] == "x"
    assert spark.read.parquet(paths["baseline_path"]).count() == 20
    report = spark.createDataFrame([("x", 0.3, 0.5, 0.0, True, "m")], "feature string, psi double, ks_stat double, ks_pvalue double, drift_detected boolean, message string")
    for _ in range(2):
        tables.append_drift_report(report, str(tmp_path / "d"), "ep", F.lit("2026-04-22 10:00:00").cast("timestamp"))
    assert spark.read.parquet(str(tmp_path / "d")).where("run_date = '2026-04-22'").count() == 2


def test_parity(spark):
    a = rows(spark, ("a", 0, 0, 1), ("b", 0, 0, None), ("c", 0, 0, 3), ("d", 0, 0, 4))
    b = rows(spark, ("a", 0, 0, 1), ("b", 0, 0, None), ("c", 0, 0, 5), ("e", 0, 0, 4))
    got = {(r.user_id, r.problem) for r in snapshot.parity_report(a, b, ["user_id"], ["x"]).collect()}
    assert got == {("c", "value_mismatch"), ("d", "missing_online"), ("e", "missing_offline")}
    assert snapshot.parity_report(a, b, ["user_id"], ["x"], tol=2).where("problem = 'value_mismatch'").isEmpty()


def test_lookup_staleness_and_names(spark):
    snap = rows(spark, ("a", 0, 0, 1), ("b", 50, 50, 2))
    req = spark.createDataFrame([("a",), ("b",), ("z",), ("a",)], "user_id string")
    now = F.lit(T0 + dt.timedelta(minutes=61))
    got = snapshot.snapshot_lookup(req, snap, VIEW, ["user_id"], ["x"], now, 3600)
    assert got.columns == ["user_id", "v__x", "is_stale"]
    assert sorted((r.user_id, r.v__x, r.is_stale) for r in got.na.fill(-1).collect()) == [
        ("a", 1, True), ("a", 1, True), ("b", 2, False), ("z", -1, False),
    ]
    assert "x" in snapshot.snapshot_lookup(req, snap, VIEW, ["user_id"], ["x"], now, 3600, full_names=False).columns


def test_delete_modes(spark):
    df = rows(spark, ("a", 0, 0, 1), ("b", 0, 0, 2))
    ids = spark.createDataFrame([("a",)], "user_id string")
    assert values(snapshot.delete_entities(df, ids, ["user_id"])) == {"b": 2}
    marked = snapshot.delete_entities(df, ids, ["user_id"], "tombstone", F.lit(T0 + dt.timedelta(days=1)), ["x"])
    assert values(snapshot.latest_per_entity(marked, ["user_id"])) == {"a": None, "b": 2}
    with pytest.raises(ValueError):
        snapshot.delete_entities(df, ids, ["user_id"], "soft")


def test_backfill_is_repeatable(spark):
    src = spark.createDataFrame([("a", T0 + dt.timedelta(days=d), 1) for d in range(5)], "user_id string, ts timestamp, n int")

    def daily(d):
        return d.groupBy("user_id", F.date_trunc("day", "ts").alias("event_time")).agg(F.sum("n").alias("n"))

    old = daily(src).withColumn("n", F.lit(0).cast("long"))
    start, end = (F.lit(dt.datetime(2026, 4, d)) for d in (23, 25))
    once = snapshot.backfill_range(daily, src, old, start, end, "ts")
    twice = snapshot.backfill_range(daily, src, once, start, end, "ts")
    assert sorted(r.n for r in once.collect()) == [0, 0, 0, 1, 1]
    assert once.exceptAll(twice).isEmpty()


def test_backfill_replaces_only_its_dates(spark, tmp_path):
    path = str(tmp_path / "daily")
    src = spark.createDataFrame([("a", T0 + dt.timedelta(days=d), 1) for d in range(4)], "user_id string, ts timestamp, n int")

    def daily(k):
        return lambda d: d.groupBy("user_id", F.date_trunc("day", "ts").alias("event_time")).agg((F.sum("n") * k).alias("n"))

    day = [F.lit(dt.datetime(2026, 4, 22 + d)) for d in range(5)]
    tables.backfill_dates(daily(1), src, path, day[0], day[4], "ts")
    tables.backfill_dates(daily(10), src, path, day[1], day[3], "ts")
    assert [r.n for r in spark.read.parquet(path).orderBy("event_time").collect()] == [1, 10, 10, 1]


def test_readers(spark, tmp_path):
    df = spark.createDataFrame([(1, "a", "2026-01-01"), (2, "b", "2026-01-02")], "n int, s string, d string")
    for fmt in ("parquet", "json", "csv", "orc"):
        path = str(tmp_path / fmt)
        df.write.partitionBy("d").format(fmt).option("header", True).save(path)
        opts = {"header": "true"} if fmt == "csv" else {}
        got = readers.read_table(spark, path, fmt, None, "d >= '2026-01-02'", **opts)
        assert [r.s for r in got.collect()] == ["b"]
    typed = readers.read_table(spark, str(tmp_path / "json"), "json", df.schema)
    assert dict(typed.dtypes)["n"] == "int"
    df.write.parquet(str(tmp_path / "train.parquet"))
    df.write.option("header", True).csv(str(tmp_path / "train.csv"))
    assert readers.load_training_data(spark, str(tmp_path / "train.parquet")).count() == 2
    assert readers.load_training_data(spark, str(tmp_path / "train.csv")).columns == ["n", "s", "d"]
    with pytest.raises(ValueError):
        readers.load_training_data(spark, "main.ml.labels")


def test_jdbc_checks_and_partitions(spark):
    url = "jdbc:derby:memory:tidemark;create=true"
    spark.range(100).withColumn("x", F.col("id") * 2).write.jdbc(url, "t", properties={"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"})
    opts = {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"}
    df = readers.read_jdbc(spark, url, "t", "id", 0, 100, 4, **opts)
    assert df.count() == 100 and df.rdd.getNumPartitions() == 4
    assert readers.read_jdbc(spark, url, "(SELECT \"id\" FROM t WHERE \"id\" < 10) q", **opts).count() == 10
    with pytest.raises(ValueError):
        readers.read_jdbc(spark, url, "t", "id", 0)


def test_stream_reader_arguments(spark, tmp_path):
    with pytest.raises(ValueError):
        readers.read_event_stream(spark, "kafka", "AT_TIMESTAMP")
    with pytest.raises(ValueError):
        readers.read_event_stream(spark, "kafka", "SOMEWHERE")
    assert readers.rate_options("kafka", 300, 30) == {"maxOffsetsPerTrigger": "9000"}
    assert readers.rate_options("kinesis", 300, 30) == {"kinesis.executor.maxFetchRecordsPerShard": "300"}
    s = readers.read_event_stream(spark, "json", schema=readers.EVENT_SCHEMA, path=str(tmp_path), maxFilesPerTrigger="1")
    assert s.isStreaming


def test_lookup_in_several_views(spark):
    user = FeatureView("u", (Entity("user", ("user_id",)),), (Feature("x", ValueType.INT32), Feature("y", ValueType.INT32)), ttl_seconds=3600)
    item = FeatureView("i", (Entity("item", ("item_id",)),), (Feature("x", ValueType.INT32),), ttl_seconds=10**9)
    users = spark.createDataFrame([("a", T0, 1, 10), ("b", T0 - dt.timedelta(hours=2), 2, None)], "user_id string, event_time timestamp, x int, y int")
    items = spark.createDataFrame([("p", T0 - dt.timedelta(days=900), 5)], "item_id string, event_time timestamp, x int")
    asked = spark.createDataFrame(
        [(1, "a", "p", T0, "ios"), (2, "b", None, T0, None), (3, None, "q", T0, "web"), (4, "z", "p", None, "web"), (1, "a", "p", T0, "ios")],
        "n int, user_id string, item_id string, at timestamp, device_type string",
    )
    stores = [(user, users), (item, items)]
    out = snapshot.lookup_many(asked, stores, ["u:x", "i:x"], F.lit(T0), request_ts="at")
    assert out.columns == [*asked.columns, "hour_of_day", "u__x", "u__is_stale", "i__x", "i__is_stale"]
    got = sorted((r.n, r.device_type, r.hour_of_day, r.u__x, r.u__is_stale, r.i__x, r.i__is_stale) for r in out.where("n <> 4").collect() if r.device_type)
    assert got == [(1, "ios", 10, 1, False, 5, False)] * 2 + [(3, "web", 10, None, False, None, False)]
    assert [(r.u__x, r.u__is_stale, r.i__x, r.hour_of_day) for r in out.where("n = 2").collect()] == [(2, True, None, 10)]
    assert [(r.u__x, r.i__x, r.hour_of_day) for r in out.where("n = 4").collect()] == [(None, 5, None)]
    short = snapshot.lookup_many(asked.withColumnRenamed("user_id", "who"), stores, ["u:y", "i:x"], F.lit(T0), {"u": ["who"]}, full_names=False)
    assert {(r.n, r.y, r.x) for r in short.collect()} == {(1, 10, 5), (2, None, None), (3, None, None), (4, None, 5)}
    for wrong in (["u:x", "i:x"], ["nothing:x"], ["u:nothing"]):
        with pytest.raises(ValueError):
            snapshot.lookup_many(asked, stores, wrong, F.lit(T0), full_names=False)


def test_equal_buckets_are_not_joined(spark):
    keys = [(f"u{i}", i * 1.5, None if i % 5 else "x") for i in range(500)] + [(None, 1.0, "n")]
    offline = spark.createDataFrame(keys, "k string, a double, b string")
    online = offline.withColumn("a", F.when(F.col("k") == "u7", 0.0).otherwise(F.col("a"))).where("k <> 'u9' OR k IS NULL")
    assert snapshot.differing_buckets(offline, offline.repartition(3), ["k"], ["a", "b"]).count() == 0
    assert snapshot.differing_buckets(offline, online, ["k"], ["a", "b"]).count() == 2
    report = snapshot.parity_report(offline, online, ["k"], ["a", "b"])
    got = sorted((r.k, r.feature, r.offline_value, r.online_value, r.problem) for r in report.collect())
    assert got == [("u7", "a", "10.5", "0.0", "value_mismatch"), ("u9", "a", "13.5", None, "missing_online"), ("u9", "b", None, None, "missing_online")]
    agreeing = snapshot.parity_report(offline, offline, ["k"], ["a", "b"])
    assert agreeing.count() == 0 and "Exchange hashpartitioning" not in agreeing._jdf.queryExecution().executedPlan().toString()
    near = snapshot.parity_report(offline, online, ["k"], ["a"], tol=20.0)
    assert [(r.k, r.problem) for r in near.collect()] == [("u9", "missing_online")]
    few = snapshot.parity_report(offline, online, ["k"], ["a", "b"], buckets=1)  # everything is compared
    assert few.exceptAll(report).isEmpty() and report.exceptAll(few).isEmpty()


ORDERS = "user string, id int, ts timestamp, amount double, made timestamp"


def orders(spark, *items):
    day = lambda d: None if d is None else T0 + dt.timedelta(days=d)
    return spark.createDataFrame([(u, i, day(d), a, day(m)) for u, i, d, a, m in items], ORDERS)


def test_increments_equal_a_full_recompute(spark, tmp_path):
    known = [("a", 1, 0, 10.0, 0), ("a", 2, 3, 5.0, 3), ("b", 3, 1, 7.0, 1), ("c", 4, 2, 1.0, 2)]
    late = [("a", 5, 1, 2.5, 8), ("b", 6, 9, 3.0, 9), (None, 7, 4, 4.0, 9), ("a", 8, -5, 1.0, 9)]
    items = spark.createDataFrame([(1, "p"), (1, "q"), (2, "p"), (3, "p"), (5, "r"), (6, "p"), (6, None), (8, "q")], "id int, product string")
    state = LifetimeState(spark, str(tmp_path / "s"), "user", "product", buckets=8)
    names = ("id", "ts", "amount", "id", "made")
    state.fold(orders(spark, *known), items, *names)
    first = state.days.manifest()
    state.fold(orders(spark, *known), items, *names)  # nothing new: no version
    assert state.days.manifest() == first
    everything = orders(spark, *known, *late)
    state.fold(everything, items, *names)
    for as_of in (T0 + dt.timedelta(days=2), T0 + dt.timedelta(days=50)):
        end = F.lit(dt.datetime.combine(as_of.date(), dt.time.max))
        want = lifetime.user_lifetime(everything, items, end, "user", "id", "ts", "amount", "id", "product")
        got = state.features(F.lit(as_of))
        assert sorted(map(tuple, got.collect()), key=str) == sorted(map(tuple, want.select(got.columns).collect()), key=str)
    after = state.days.manifest()
    untouched = str(state.days._bucketed(orders(spark, ("c", 0, 0, 0.0, 0)), 8).first()["__bucket"])
    touched = {str(r[0]) for r in state.days._bucketed(orders(spark, *late), 8).select("__bucket").collect()}
    assert {b for b in after.files if after.files[b] != first.files.get(b)} <= touched
    assert untouched in touched or after.files[untouched] == first.files[untouched]


def test_an_interrupted_fold_is_completed(spark, tmp_path, monkeypatch):
    state = LifetimeState(spark, str(tmp_path / "s"), "user", "product", buckets=2)
    data, items = orders(spark, ("a", 1, 0, 10.0, 0)), spark.createDataFrame([(1, "p")], "id int, product string")
    monkeypatch.setattr(state.products, "merge", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
    with pytest.raises(RuntimeError):
        state.fold(data, items, "id", "ts", "amount", "id", "made")
    monkeypatch.undo()
    state.fold(data, items, "id", "ts", "amount", "id", "made")
    assert [(r.total_orders, r.distinct_products_purchased) for r in state.features(F.lit(T0)).collect()] == [(1, 1)]


def test_only_new_rows_are_materialised(spark, tmp_path):
    path = str(tmp_path / "h")
    rows(spark, ("a", 0, 0, 1), ("b", 0, 0, 2)).write.parquet(path)
    online = tables.VersionedTable(spark, str(tmp_path / "t"), ["user_id"], buckets=4)
    first = materialize(spark.read.parquet(path), online)
    assert values(online.read()) == {"a": 1, "b": 2} and materialize(spark.read.parquet(path), online) is None
    rows(spark, ("a", 5, 9, 3), ("b", -5, 9, 4), ("c", 1, 9, 5)).write.mode("append").parquet(path)
    fresh, newest = fresh_rows(spark.read.parquet(path), online, "ingestion_time")
    assert newest > first and fresh.count() == 3
    assert "PushedFilters: [IsNotNull(ingestion_time), GreaterThan(ingestion_time" in fresh._jdf.queryExecution().executedPlan().toString()
    materialize(spark.read.parquet(path), online)
    assert values(online.read()) == {"a": 3, "b": 2, "c": 5}
    assert online.manifest().streams == {"ingested": newest}


def test_churn_risk_comes_from_a_view_of_scores(spark):
    base = spark.createDataFrame([("a", 1), ("b", 2)], "user string, total_orders int")
    scores = spark.createDataFrame([("a", T0, 0.1), ("a", T0 + dt.timedelta(1), 0.9), ("c", T0, 0.5)], "user string, event_time timestamp, prediction_score double")
    got = {r.user: r.churn_risk_score for r in lifetime.with_churn_risk(base, scores, "user", F.lit(T0)).collect()}
    assert got == {"a": pytest.approx(0.1), "b": None}


def test_file_streams_start_at_a_time_and_keep_a_rate(spark, tmp_path):
    path = str(tmp_path / "in")
    rows(spark, ("old", 0, 0, 1)).coalesce(1).write.mode("append").parquet(path)
    for f in (tmp_path / "in").glob("*.parquet"):
        os.utime(f, (1_000_000_000, 1_000_000_000))
    for k in range(4):
        rows(spark, (f"new{k}", 0, 0, 1)).coalesce(1).write.mode("append").parquet(path)

    def run(name, **options):
        stream = readers.read_event_stream(spark, "parquet", schema=rows(spark).schema, path=path, **options)
        batches = []
        query = (
            stream.writeStream.foreachBatch(lambda df, i: batches.append(sorted(r.user_id for r in df.collect())))
            .option("checkpointLocation", str(tmp_path / name)).trigger(availableNow=True).start()
        )
        query.awaitTermination()
        return [b for b in batches if b]

    assert sorted(sum(run("all"), [])) == ["new0", "new1", "new2", "new3", "old"]
    late = run("late", position="AT_TIMESTAMP", timestamp="2020-01-01 00:00:00")
    assert sorted(sum(late, [])) == ["new0", "new1", "new2", "new3"]
    slow = run("slow", records_per_second=1, trigger_seconds=1, record_bytes=1)
    assert len(slow) == 5  # one file a batch at least, no more under the rate
    assert len(run("two", maxFilesPerTrigger="2")) == 3


def test_repeated_cells_have_one_value(spark):
    from tidemark.operators.formats import feature_wide_format

    long = spark.createDataFrame([("u", T0, T0, "f", v) for v in (2.0, 5.0, 3.0)], "entity_id string, event_time timestamp, ingestion_time timestamp, feature_name string, value double")
    assert [r.f for r in feature_wide_format(long.repartition(3), ["f"]).collect()] == [5.0]
