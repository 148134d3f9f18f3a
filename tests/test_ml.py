from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import ml, quality, reports


@pytest.fixture(scope="module")
def rows(spark):
    rng = np.random.default_rng(5)
    x = rng.normal(size=(600, 2))
    y = (x[:, 0] + 0.3 * rng.normal(size=600) > 0.5).astype(int)
    pdf = pd.DataFrame({"entity_id": range(600), "a": x[:, 0], "b": x[:, 1], "y": y, "event_time": pd.Timestamp("2026-01-01")})
    pdf.loc[::50, "b"] = np.nan
    return spark.createDataFrame(pdf)


def test_prepare_features(rows):
    assert ml.prepare_features(rows, "y").columns == ["a", "b", "y"]
    assert ml.feature_columns(rows, "y", ("b",)) == ["a"]


def test_split_is_exact_and_repeatable(rows):
    split = ml.stratified_split(rows, "y", "entity_id")
    counts = {(r.y, r.is_test): r["count"] for r in split.groupBy("y", "is_test").count().collect()}
    n1 = rows.where("y = 1").count()
    assert counts[(0, True)] + counts[(1, True)] == 120
    assert abs(counts[(1, True)] - 0.2 * n1) < 1
    again = ml.stratified_split(rows.repartition(7), "y", "entity_id")
    assert split.select("entity_id", "is_test").exceptAll(again.select("entity_id", "is_test")).isEmpty()
    other = ml.stratified_split(rows, "y", "entity_id", seed=1)
    assert not split.select("entity_id", "is_test").exceptAll(other.select("entity_id", "is_test")).isEmpty()


def sizes(spark, classes, share):
    rows = spark.createDataFrame(list(classes.items()), "y string, count long")
    return {r.y: r.test for r in ml.test_sizes(rows, "y", share).collect()}


def test_sizes_by_largest_remainder(spark):
    assert sizes(spark, {"a": 7, "b": 2, "c": 1}, 0.2) == {"a": 2, "b": 0, "c": 0}
    assert sizes(spark, {"a": 5, "b": 5, "c": 5}, 0.3) == {"a": 2, "b": 2, "c": 1}  # equal remainders: by name
    assert sizes(spark, {"a": 6 * 10**9, "b": 1}, 0.5) == {"a": 3 * 10**9, "b": 1}
    assert sizes(spark, {}, 0.5) == {}


def test_many_classes(spark):
    """Classes are rows: there is no bound on their number."""
    rows = spark.range(30_000).selectExpr("id", "concat('class', id % 12000) AS y")
    split = ml.stratified_split(rows, "y", "id", test_size=0.5).cache()
    assert split.where("is_test").count() == 15_000
    per_class = split.groupBy("y").agg(F.count_if("is_test").alias("t"), F.count("*").alias("n"))
    assert per_class.where("abs(t - n / 2) > 0.5").isEmpty()
    split.unpersist()


@pytest.mark.parametrize(
    "kind,settings",
    [("logreg", {"maxIter": 50}), ("random_forest", {"numTrees": 10, "maxDepth": 4}), ("boosted_trees", {"maxIter": 5, "maxDepth": 3})],
)
def test_models_learn(rows, kind, settings):
    split = ml.stratified_split(rows, "y", "entity_id")
    model = ml.train(split.where("NOT is_test"), "y", ["a", "b"], kind, **settings)
    scored = ml.score(split.where("is_test"), model, ["a", "b"])
    m = ml.classification_metrics(scored, "y", "prediction_score").first()
    assert m.n_rows == 120 and m.accuracy > 0.8 and m.roc_auc > 0.85
    weights = dict(ml.feature_importances(model, ["a", "b"]))
    assert weights == {} if kind == "logreg" else weights["a"] > weights["b"]


def test_scoring_nothing(rows):
    model = ml.train(rows, "y", ["a", "b"], "logreg", maxIter=5)
    assert ml.score(rows.where("y > 5"), model, ["a", "b"]).count() == 0
    with pytest.raises(ValueError):
        ml.train(rows, "y", ["a"], "svm")


def test_metrics_by_hand(spark):
    df = spark.createDataFrame([(1, 0.9), (1, 0.2), (0, 0.6), (0, 0.1)], "y int, s double")
    m = ml.classification_metrics(df, "y", "s").first()
    assert (m.accuracy, m.f1_weighted, m.roc_auc) == (0.5, 0.5, 0.75)


def test_alerts_show_the_first_and_count_the_rest(spark):
    drift = spark.createDataFrame([("e", f"f{i:02d}", i / 10) for i in range(15)], "endpoint_name string, feature_name string, psi double")
    limits = spark.createDataFrame([("e", 0.2, 1.0)], "endpoint_name string, psi_warning double, psi_critical double")
    got = quality.alert_severity(drift, limits, shown=4).orderBy("alert_rank").collect()
    assert [(r.feature_name, r.severity, r.n_more) for r in got] == [(f"f{i}", "critical", 9) for i in (14, 13, 12, 11)]
    assert got[0].channels == "topic,chat"


def test_sampling_is_by_request(spark):
    df = spark.range(5000).select(
        F.col("id").alias("rid"), F.current_timestamp().alias("ts"), F.lit(1.0).alias("lat"), F.lit(0.5).alias("score")
    )
    log = reports.inference_log(df, "ep", "rid", "ts", "lat", "score", 10)
    again = reports.inference_log(df, "ep", "rid", "ts", "lat", "score", 10)
    assert 300 < log.count() < 700
    assert log.select("request_id").exceptAll(again.select("request_id")).isEmpty()
    assert reports.inference_log(df, "ep", "rid", "ts", "lat", "score").count() == 5000
