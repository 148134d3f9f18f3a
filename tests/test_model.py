from __future__ import annotations

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tidemark import model
from tidemark.operators.formats import feature_long_format, feature_wide_format


def _view(**kw):
    user = model.Entity("user", ("user_id",))
    base = dict(name="v", entities=(user,), features=(model.Feature("x", model.ValueType.INT32),), ttl_seconds=60)
    return model.FeatureView(**{**base, **kw})


def test_value_types_have_spark_types():
    assert {t.value for t in model.ValueType} >= {
        "string", "int32", "int64", "float", "double", "bool", "bytes", "string_list", "int64_list", "float_list",
    }
    assert all(t.spark_type is not None for t in model.ValueType)


def test_offline_only_excludes_online():
    with pytest.raises(ValueError):
        _view(offline_only=True)
    assert _view(offline_only=True, online=False).offline_only


def test_bad_views():
    with pytest.raises(ValueError):
        _view(ttl_seconds=0)
    with pytest.raises(ValueError):
        _view(features=(model.Feature("user_id", model.ValueType.STRING),))


def test_shipped_views():
    by_name = {v.name: v for v in model.SHIPPED_VIEWS}
    assert by_name["user_recency"].ttl_seconds == 3600
    assert by_name["user_lifetime"].ttl_seconds == 2592000
    assert by_name["product_features"].ttl_seconds == 604800
    assert by_name["product_features"].features[-1].dim == 64
    assert [f.simpleString() for f in by_name["user_recency"].schema().fields][-1].endswith("int")


def test_schema_check_and_conform(spark):
    view = _view()
    raw = spark.createDataFrame([("u", dt.datetime(2026, 4, 22), dt.datetime(2026, 4, 22), 5)], "user_id string, event_time timestamp, ingestion_time timestamp, x long")
    with pytest.raises(model.SchemaMismatch, match="x is bigint"):
        model.check_schema(raw, view)
    good = model.conform(raw, view)
    model.check_schema(good, view)
    with pytest.raises(model.SchemaMismatch, match="unknown column y"):
        model.check_schema(good.withColumn("y", F.lit(1)), view)
    with pytest.raises(model.SchemaMismatch, match="missing column x"):
        model.check_schema(good.drop("x"), view)


def test_reject_rows(spark):
    user = model.Entity("user", ("user_id",))
    view = _view(entities=(user,), features=(model.Feature("e", model.ValueType.FLOAT_LIST, dim=2),))
    t = dt.datetime(2026, 1, 1)
    df = spark.createDataFrame(
        [("a", t, t, [1.0, 2.0]), (None, t, t, [1.0, 2.0]), ("b", None, t, [1.0, 2.0]), ("c", t, t, [1.0]), ("d", t, t, None)],
        "user_id string, event_time timestamp, ingestion_time timestamp, e array<float>",
    )
    good, bad = model.reject_rows(df, view)
    assert {r.user_id for r in good.collect()} == {"a", "d"}
    assert {r.reject_reason for r in bad.collect()} == {"null key user_id", "null event_time", "e is not of length 2"}


def test_long_format_of_one_record(spark):
    t = dt.datetime(2026, 4, 22, 10)
    df = spark.createDataFrame(
        [("U123", t, 3, 42.5, 120, None)], "entity string, t timestamp, a int, b double, c int, d int"
    )
    rows = feature_long_format(df, "entity", "t", ["a", "b", "c", "d"]).orderBy("position").collect()
    assert [(r.feature_name, r.value_as_string) for r in rows] == [
        ("entity_id", "U123"),
        ("event_time", "2026-04-22T10:00:00.000000+00:00"),
        ("a", "3"),
        ("b", "42.5"),
        ("c", "120"),
        ("d", ""),
    ]


def test_wide_format_keeps_ingestion_time(spark):
    t = dt.datetime(2026, 4, 22, 10)
    long = spark.createDataFrame(
        [("U1", t, t, "f1", "1"), ("U1", t, t, "f2", "hello")],
        "entity_id string, event_time timestamp, ingestion_time timestamp, feature_name string, value string",
    )
    row = feature_wide_format(long, ["f1", "f2", "f3"]).first()
    assert (row.f1, row.f2, row.f3) == ("1", "hello", None)
    assert "ingestion_time" in row.asDict()
