"""Distribution drift between a baseline and a current data set, all features in one job each."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.stats import ks_pvalue, psi_term
from tidemark.operators.quantiles import (
    all_ranks,
    interpolated,
    order_statistics,
    two_sample_distance,
    two_sample_marks,
)


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.NumericType, T.BooleanType))]


def shared_numeric_columns(a: DataFrame, b: DataFrame) -> list[str]:
    other = set(numeric_columns(b))
    return [c for c in numeric_columns(a) if c in other]


def long_form(df: DataFrame, cols: list[str]) -> DataFrame:
    """``feature, value``: every monitored column in one scan, values as double, NaN as null."""
    doubles = df.select(*[F.nanvl(F.col(c).cast("double"), F.lit(None).cast("double")).alias(c) for c in cols])
    return doubles.unpivot([], cols, "feature", "value")


def _both(baseline: DataFrame, current: DataFrame, cols: list[str]) -> DataFrame:
    return (
        long_form(baseline, cols)
        .withColumn("is_current", F.lit(False))
        .unionByName(long_form(current, cols).withColumn("is_current", F.lit(True)))
        .where("value IS NOT NULL")
    )


def _feature_list(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.sparkSession.range(1).select(F.explode(F.array(*[F.lit(c) for c in cols])).alias("feature"))


def _edges(stats: DataFrame, probs: list[float]) -> DataFrame:
    """``feature, edges``: the distinct quantiles in order, at most one per probability."""
    quantiles = interpolated(stats, ["feature"], probs)
    return quantiles.groupBy("feature").agg(F.array_sort(F.collect_set("quantile")).alias("edges"))


def edge_index(value: Column, edges: Column, max_edges: int) -> Column:
    """How many of the first ``max_edges`` entries of a sorted array are <= value (unrolled)."""
    total: Column = F.lit(0)
    for i in range(max_edges):
        total = total + F.when(value >= F.get(edges, F.lit(i)), 1).otherwise(0)
    return total


def psi(
    baseline: DataFrame,
    current: DataFrame,
    cols: list[str] | None = None,
    bins: int = 10,
    open_ended: bool = False,
) -> DataFrame:
    """``feature, psi``: population stability index over baseline-quantile bins.

    Values outside the baseline's range are dropped, so a current set entirely outside gives NaN;
    ``open_ended`` counts them in the outermost bins instead.  0.0 when a side is empty or the
    baseline has fewer than two distinct quantiles.
    """
    cols = cols or shared_numeric_columns(baseline, current)
    probs = [i / bins for i in range(bins + 1)]
    long = long_form(baseline, cols).where("value IS NOT NULL")
    ranked = order_statistics(long, ["feature"], "value", all_ranks(probs, F.col("__total")))
    edges = _edges(ranked, probs)
    return _psi(_both(baseline, current, cols), _feature_list(baseline, cols), edges, bins, open_ended)


def _psi(both: DataFrame, features: DataFrame, edges: DataFrame, bins: int, open_ended: bool) -> DataFrame:
    # One row per monitored column: bounded by the schema, not by the data.
    binned = both.join(F.broadcast(edges), "feature")
    n_edges = F.size("edges")
    index = edge_index(F.col("value"), F.col("edges"), bins + 1)
    last = F.element_at("edges", -1)
    place = F.when(F.col("value") == last, n_edges - 1).otherwise(index)
    if open_ended:
        place = F.least(F.greatest(index, F.lit(1)), n_edges - 1)
    binned = binned.select("feature", "is_current", n_edges.alias("n_edges"), place.alias("bin"), (F.col("value") > last).alias("above"))
    if not open_ended:
        binned = binned.withColumn("bin", F.when(F.col("above"), 0).otherwise(F.col("bin")))
    counts = binned.groupBy("feature", "n_edges", "bin").agg(
        F.count_if(~F.col("is_current")).alias("nb"), F.count_if(F.col("is_current")).alias("nc")
    )
    # bin 0 holds what fell outside the edges: counted as data, not as a fraction.
    inner = F.col("bin") > 0
    per_feature = counts.groupBy("feature", "n_edges").agg(
        F.sum("nb").alias("all_b"),
        F.sum("nc").alias("all_c"),
        F.sum(F.when(inner, F.col("nb")).otherwise(0)).alias("in_b"),
        F.sum(F.when(inner, F.col("nc")).otherwise(0)).alias("in_c"),
        F.collect_list(F.when(inner, F.struct("nb", "nc"))).alias("cells"),
    )
    in_b, in_c = F.col("in_b").cast("double"), F.col("in_c").cast("double")
    total = F.aggregate(
        F.array_sort("cells"), F.lit(0.0), lambda acc, x: acc + psi_term(x["nb"] / in_b, x["nc"] / in_c)
    )
    value = (
        F.when((F.col("all_b") == 0) | (F.col("all_c") == 0) | (F.col("n_edges") < 2), F.lit(0.0))
        .when((in_b == 0) | (in_c == 0), F.lit(float("nan")))
        .otherwise(total)
    )
    return features.join(per_feature.select("feature", value.alias("psi")), "feature", "left").select(
        "feature", F.coalesce("psi", F.lit(0.0)).alias("psi")
    )


def ks(
    baseline: DataFrame, current: DataFrame, cols: list[str] | None = None, pvalue: str = "asymptotic"
) -> DataFrame:
    """``feature, ks_stat, ks_pvalue``; (0, 1) when a side is empty.  ``pvalue``: ``asymptotic`` or ``exact``."""
    cols = cols or shared_numeric_columns(baseline, current)
    distance = two_sample_distance(_both(baseline, current, cols), ["feature"], "value", "is_current")
    return _ks(distance, _feature_list(baseline, cols), pvalue)


def _ks(distance: DataFrame, features: DataFrame, pvalue: str) -> DataFrame:
    p = ks_pvalue(F.col("ks_stat"), F.col("n_base"), F.col("n_cur"), pvalue)
    return features.join(distance.withColumn("ks_pvalue", p), "feature", "left").select(
        "feature",
        F.coalesce("ks_stat", F.lit(0.0)).alias("ks_stat"),
        F.coalesce("ks_pvalue", F.lit(1.0)).alias("ks_pvalue"),
    )


def detect_drift(
    baseline: DataFrame,
    current: DataFrame,
    cols: list[str] | None = None,
    psi_threshold: float = 0.25,
    ks_pvalue_threshold: float = 0.01,
    bins: int = 10,
    open_ended: bool = False,
    pvalue: str = "asymptotic",
) -> DataFrame:
    """``feature, psi, ks_stat, ks_pvalue, drift_detected, message`` per monitored column.

    A feature drifts when its PSI reaches the threshold or its KS p-value is below its own.  The
    default columns are the numeric ones both sides have.
    """
    cols = cols or shared_numeric_columns(baseline, current)
    features = _feature_list(baseline, cols)
    both = _both(baseline, current, cols)
    probs = [i / bins for i in range(bins + 1)]
    # One pair of passes finds the bin edges and the KS distances of all columns, a third counts.
    marks, _ = two_sample_marks(both, ["feature"], "value", "is_current", probs)
    edges = _edges(marks.where("rank IS NOT NULL"), probs)
    distance = (
        marks.groupBy("feature")
        .agg(F.max("n_base").alias("n_base"), F.max("n_cur").alias("n_cur"), F.max("d").alias("ks_stat"))
        .where("n_base > 0 AND n_cur > 0")
    )
    joined = _psi(both, features, edges, bins, open_ended).join(_ks(distance, features, pvalue), "feature")
    # NaN compares greater than any number in Spark; a NaN index is not a breach.
    psi_breach = (F.col("psi") >= psi_threshold) & ~F.isnan("psi")
    ks_breach = F.col("ks_pvalue") < ks_pvalue_threshold
    message = F.concat_ws(
        "; ",
        F.when(psi_breach, F.concat(F.lit("PSI="), F.format_string("%.3f", "psi"), F.lit(f" >= {psi_threshold}"))),
        F.when(
            ks_breach,
            F.concat(F.lit("KS p-value="), F.format_string("%.4f", "ks_pvalue"), F.lit(f" < {ks_pvalue_threshold}")),
        ),
    )
    return joined.select(
        "feature",
        "psi",
        "ks_stat",
        "ks_pvalue",
        (psi_breach | ks_breach).alias("drift_detected"),
        message.alias("message"),
    )


def drift_report(results: DataFrame) -> DataFrame:
    """One row: ``any_drift, drifted_features, results`` over a drift table."""
    return results.agg(
        F.coalesce(F.bool_or("drift_detected"), F.lit(False)).alias("any_drift"),
        F.array_sort(F.collect_list(F.when(F.col("drift_detected"), F.col("feature")))).alias("drifted_features"),
        F.array_sort(F.collect_list(F.struct("feature", "psi", "ks_stat", "ks_pvalue", "drift_detected", "message"))).alias(
            "results"
        ),
    )


def drift_report_json(results: DataFrame) -> DataFrame:
    """The report as one row of JSON text; at most one entry per monitored column."""
    return drift_report(results).select(F.to_json(F.struct("any_drift", "drifted_features", "results")).alias("value"))
