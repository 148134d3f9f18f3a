"""Model queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.operators import ml
from tidemark.plans.asof import training_inputs
from tidemark.operators.pit import training_set as build_training_set
from tidemark.plans.inputs import events, table, utc


def _rows(spark, sf):
    """Labelled documents with simple numeric features and a fixed score."""
    docs = table(spark, sf, "documents").select("doc_id", "n_chars", F.length("text").alias("n_text"), "lang")
    return table(spark, sf, "labels").join(docs, "doc_id").withColumn(
        "event_time", utc("2024-01-01")
    )


def prepare_features(spark, sf):
    return ml.prepare_features(_rows(spark, sf), "quality", ("doc_id", "toxic", "lang"))


def stratified_split_counts(spark, sf):
    split = ml.stratified_split(_rows(spark, sf), "quality", "doc_id", 0.2, 42)
    return split.groupBy("quality", "is_test").agg(F.count(F.lit(1)).alias("n"))


def _score():
    return (F.col("n_chars") % 997) / 997.0


def classification_metrics(spark, sf):
    scored = _rows(spark, sf).withColumn("s", _score())
    out = ml.classification_metrics(scored, "quality", "s")
    return out.withColumns({c: F.round(c, 6) for c in ("accuracy", "f1_weighted", "f1_positive", "roc_auc")})


_FEATURES = ["interest__amount", "trouble__amount"]


def _trained(spark, sf):
    labels, views = training_inputs(spark, sf)
    rows = build_training_set(labels, views, ["user_id"], "label_ts", ["interest:amount", "trouble:amount"])
    return rows, ml.train(rows, "label", _FEATURES, "logreg", maxIter=20)


def batch_scores(spark, sf):
    """Logistic regression on the point-in-time training set, scored back on it."""
    rows, model = _trained(spark, sf)
    return ml.score(rows, model, _FEATURES).select("event_id", "label", "prediction_score")


def tree_importances(spark, sf):
    """Importances of a small boosted model on the same training set."""
    labels, views = training_inputs(spark, sf)
    rows = build_training_set(labels, views, ["user_id"], "label_ts", ["interest:amount", "trouble:amount"])
    model = ml.train(rows, "label", _FEATURES, "boosted_trees", maxIter=5, maxDepth=3)
    pairs = ml.feature_importances(model, _FEATURES)
    cells = F.array(*[F.struct(F.lit(n).alias("feature"), F.lit(v).alias("importance")) for n, v in pairs])
    return spark.range(1).select(F.explode(cells).alias("c")).select("c.*")


QUERIES = {
    f.__name__: f
    for f in (prepare_features, stratified_split_counts, classification_metrics, batch_scores, tree_importances)
}

_ROWS = """r AS (
  SELECT l.doc_id, quality, toxic, n_chars, length(text) AS n_text FROM labels l JOIN documents d ON d.doc_id = l.doc_id)"""

ORACLE = {
    "prepare_features": f"WITH {_ROWS} SELECT n_chars, CAST(n_text AS INTEGER) AS n_text, quality FROM r",
    "stratified_split_counts": f"""WITH {_ROWS},
c AS (SELECT quality, count(*) AS n, sum(count(*)) OVER () AS total FROM r WHERE quality IS NOT NULL GROUP BY quality),
s AS (SELECT *, ceil(0.2 * total) AS want, n * ceil(0.2 * total) / total AS share FROM c),
k AS (SELECT *, floor(share) + CASE WHEN row_number() OVER (ORDER BY share - floor(share) DESC, quality)
                                    <= want - sum(floor(share)) OVER () THEN 1 ELSE 0 END AS test FROM s)
SELECT quality, true AS is_test, CAST(test AS BIGINT) AS n FROM k WHERE test > 0
UNION ALL SELECT quality, false, CAST(n - test AS BIGINT) FROM k WHERE n > test""",
    "classification_metrics": f"""WITH {_ROWS},
s AS (SELECT quality AS y, (n_chars % 997) / 997.0::DOUBLE AS s FROM r),
c AS (SELECT count(*) AS n, count(*) FILTER (y = 1 AND s > 0.5) AS tp, count(*) FILTER (y <> 1 AND s > 0.5) AS fp,
             count(*) FILTER (y = 1 AND s <= 0.5) AS fn, count(*) FILTER (y <> 1 AND s <= 0.5) AS tn FROM s),
k AS (SELECT y, rank() OVER (ORDER BY s) + (count(*) OVER (PARTITION BY s) - 1) / 2 AS rk FROM s),
a AS (SELECT (sum(rk) FILTER (y = 1) - count(*) FILTER (y = 1) * (count(*) FILTER (y = 1) + 1) / 2)
             / (count(*) FILTER (y = 1) * count(*) FILTER (y <> 1)) AS auc FROM k)
SELECT n AS n_rows, round((tp + tn) / n, 6) AS accuracy,
       round(((tp + fn) * (2 * tp / (2 * tp + fp + fn)) + (tn + fp) * (2 * tn / (2 * tn + fp + fn))) / n, 6) AS f1_weighted,
       round(2 * tp / (2 * tp + fp + fn), 6) AS f1_positive, round(auc, 6) AS roc_auc
FROM c, a""",
}
