"""Training sets to models: split, train, evaluate, score."""

from __future__ import annotations

import math

from pyspark.ml import Model, Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import Imputer, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scratch import written_once
from tidemark.operators.ordering import in_order
from tidemark.operators.quantiles import order_statistics, score_counts

# Columns that are never features, and the models' settings.
STANDARD_EXCLUDES = ("entity_id", "event_time", "ingestion_time", "_row_id")
MODEL_SETTINGS = {
    "logreg": {"maxIter": 1000},
    "random_forest": {"numTrees": 200, "maxDepth": 10},
    "boosted_trees": {"maxIter": 200, "maxDepth": 6, "stepSize": 0.1},
}


def feature_columns(df: DataFrame, label: str, exclude: tuple[str, ...] = ()) -> list[str]:
    dropped = {label, *STANDARD_EXCLUDES, *exclude}
    return [c for c in df.columns if c not in dropped]


def prepare_features(df: DataFrame, label: str, exclude: tuple[str, ...] = ()) -> DataFrame:
    """Only the feature columns, and the label last."""
    return df.select(*feature_columns(df, label, exclude), label)


def test_sizes(class_sizes: DataFrame, label: str, test_size: float) -> DataFrame:
    """``label, count, test``: test rows of each class (``label, count``), ``ceil(test_size * n)`` in all, shared by largest remainder; equal
    remainders by the class's name.  Classes are rows, however many there are."""
    n = class_sizes.agg(F.sum("count")).first()[0] or 0
    wanted = math.ceil(test_size * n)
    product = F.col("count").cast("decimal(19,0)") * F.lit(wanted).cast("decimal(18,0)")
    shares = class_sizes.withColumn("__product", product).withColumn("__whole", F.expr(f"__product div {max(1, n)}BD"))
    shares = shares.withColumns({"__rest": F.col("__product") - F.col("__whole") * F.lit(max(1, n)).cast("decimal(19,0)"), "__one": F.lit(1).cast("long")})
    # Written by the sort: both uses see the same rows.
    placed = in_order(shares, [F.desc("__rest"), F.col(label).cast("string")], {"__place": "__one"})
    over = wanted - (shares.agg(F.sum("__whole")).first()[0] or 0)
    test = F.col("__whole") + (F.col("__place") < F.lit(over)).cast("long")
    return placed.select(label, "count", test.alias("test"))


test_sizes.__test__ = False  # not a test case, whatever its name suggests


def stratified_split(
    df: DataFrame, label: str, row_id: str, test_size: float = 0.2, seed: int = 42
) -> DataFrame:
    """``df`` with ``is_test``: exactly the wanted share of every class, reproducibly.

    Rows are ordered by a 52-bit hash of their id; the cut of each class is an exact order
    statistic of the hash, so no class is sorted or collected.  Rows without a class are no test rows.
    """
    hashed = df.withColumn("__h", F.shiftrightunsigned(F.xxhash64(F.col(row_id), F.lit(seed)), 12).cast("double"))
    known = hashed.where(F.col(label).isNotNull())
    sizes = written_once(test_sizes(known.groupBy(label).count(), label, test_size), "class-sizes")
    cut = known.select(label, "__h").join(sizes.select(label, "test"), label)
    limits = order_statistics(cut, [label, "test"], "__h", F.array(F.col("test") - 1))
    joined = hashed.join(limits.select(label, F.col("value").alias("__cut")), label, "left")
    return joined.withColumn("is_test", F.coalesce(F.col("__h") <= F.col("__cut"), F.lit(False))).drop("__h", "__cut")


def train(
    df: DataFrame, label: str, features: list[str], model_type: str = "boosted_trees", seed: int = 42, **settings
) -> PipelineModel:
    """Fit on the cluster.  Missing values become the column's mean."""
    if model_type not in MODEL_SETTINGS:
        raise ValueError(f"model_type must be one of {sorted(MODEL_SETTINGS)}")
    options = {**MODEL_SETTINGS[model_type], **settings}
    filled = [f"__f_{c}" for c in features]
    imputer = Imputer(inputCols=features, outputCols=filled, strategy="mean")
    assembler = VectorAssembler(inputCols=filled, outputCol="__features", handleInvalid="keep")
    common = {"featuresCol": "__features", "labelCol": "__label"}
    if model_type == "logreg":
        estimator = LogisticRegression(**common, **options)
    elif model_type == "random_forest":
        estimator = RandomForestClassifier(**common, seed=seed, **options)
    else:
        estimator = GBTClassifier(**common, seed=seed, **options)
    numeric = df.select(*[F.col(c).cast("double").alias(c) for c in features], F.col(label).cast("double").alias("__label"))
    # The imputer and every round of the estimator read the rows again: a training set is joined once.
    numeric = written_once(numeric, "training-rows")
    fitted = Pipeline(stages=[imputer, assembler, estimator]).fit(numeric)
    # A training summary holds the training DataFrame and its session, which must not be shipped
    # to the executors with the model.
    last = fitted.stages[-1]
    if getattr(last, "hasSummary", False):
        last._java_obj.setSummary(df.sparkSession.sparkContext._jvm.scala.Option.empty())
    return fitted


def score(df: DataFrame, model: PipelineModel, features: list[str], out: str = "prediction_score") -> DataFrame:
    """``df`` with the probability of class 1."""
    keep = df.columns
    numeric = df.withColumn("__row", F.struct("*")).select(
        "__row", *[F.col(c).cast("double").alias(c) for c in features]
    )
    scored = model.transform(numeric)
    return scored.select(
        *[F.col(f"__row.{c}").alias(c) for c in keep], vector_to_array("probability")[1].alias(out)
    )


def feature_importances(model: PipelineModel, features: list[str]) -> list[tuple[str, float]]:
    """(name, importance), for tree models; one number per feature, held by the model."""
    fitted: Model = model.stages[-1]
    if not hasattr(fitted, "featureImportances"):
        return []
    return list(zip(features, [float(x) for x in fitted.featureImportances.toArray()]))


def classification_metrics(df: DataFrame, label: str, score_col: str | Column, threshold: float = 0.5) -> DataFrame:
    """One row: ``n_rows, accuracy, f1_weighted, f1_positive, roc_auc``.

    A score above the threshold predicts class 1; F1 is 0 for a class that is never predicted.
    """
    scored = df.select(
        F.col(label).cast("int").alias("y"),
        (F.col(score_col) if isinstance(score_col, str) else score_col).cast("double").alias("s"),
    ).where("y IS NOT NULL AND s IS NOT NULL")
    cells = score_counts(scored, "s", F.col("y") == 1, threshold)
    tp, fp = F.col("pos_above").cast("double"), F.col("neg_above").cast("double")
    fn, tn = F.col("n_pos") - tp, F.col("n_neg") - fp
    n = tp + fp + fn + tn

    def f1(t: Column) -> Column:
        return F.when(2 * t + fp + fn > 0, 2 * t / (2 * t + fp + fn)).otherwise(0.0)

    safe = F.when(n > 0, n)
    return cells.select(
        n.cast("long").alias("n_rows"),
        ((tp + tn) / safe).alias("accuracy"),
        (((tp + fn) * f1(tp) + (tn + fp) * f1(tn)) / safe).alias("f1_weighted"),
        f1(tp).alias("f1_positive"),
        "roc_auc",
    )
