"""Baseline statistics of numeric columns, the constraints drawn from them, and their check."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.operators.drift import edge_index, long_form, numeric_columns
from tidemark.operators.quantiles import exact_quantiles

# Fixed values of the statistics and constraints documents.
COMPLETENESS_FLOOR = 0.95
COMPLETENESS_SLACK = 0.05
SKETCH_PARAMETERS = {"c": 0.64, "k": 2048.0}
COMPARISON_THRESHOLD = 0.1
COMPARISON_METHOD = "Robust"


def baseline_statistics(df: DataFrame, cols: list[str] | None = None) -> DataFrame:
    """Per column: type, present, missing, mean, sum, population deviation, min, max, row count.

    Columns without any value are left out.  NaN counts as missing.
    """
    cols = cols or numeric_columns(df)
    integral = [
        f.name for f in df.schema.fields if isinstance(f.dataType, (T.IntegralType, T.BooleanType)) and f.name in cols
    ]
    kind = F.when(F.col("name").isin(integral), "Integral").otherwise("Fractional")
    aggregates = {
        "num_present": F.count,
        "mean": F.avg,
        "sum": F.sum,
        "std_dev": F.stddev_pop,
        "min": F.min,
        "max": F.max,
    }
    rows = per_column(df, cols, aggregates).where("num_present > 0")
    return rows.select(
        "name",
        "num_present",
        (F.col("item_count") - F.col("num_present")).alias("num_missing"),
        *[c for c in aggregates if c != "num_present"],
        "item_count",
    ).withColumn("inferred_type", kind)


def per_column(df: DataFrame, cols: list[str], aggregates: dict[str, Callable[[Column], Column]]) -> DataFrame:
    """``name, <aggregates>, item_count``: aggregates of every column, as double and without NaN, and the number of rows.

    All columns are aggregated side by side in one pass, and only the single row of results is turned into one row a column.
    """
    values = {c: F.nanvl(F.col(f"`{c}`").cast("double"), F.lit(None).cast("double")) for c in cols}
    plain = df.select(*[v.alias(f"v{i}") for i, v in enumerate(values.values())])
    cells = [
        F.struct(F.lit(c).alias("name"), *[fn(F.col(f"v{i}")).alias(a) for a, fn in aggregates.items()], F.count(F.lit(1)).alias("item_count"))
        for i, c in enumerate(cols)
    ]
    if not cells:
        return df.sparkSession.createDataFrame([], ", ".join(["name string", *(f"{a} double" for a in aggregates), "item_count long"]))
    return plain.agg(F.array(*cells).alias("__cells")).select(F.inline("__cells"))


def baseline_buckets(
    df: DataFrame, cols: list[str] | None = None, n_buckets: int = 10, closed_last: bool = False
) -> DataFrame:
    """``name, lower_bound, upper_bound, count, global bounds``: counts between exact quantiles.

    Buckets are ``[lower, upper)``, those of zero width are left out, and the maximum is counted
    nowhere unless ``closed_last``.
    """
    cols = cols or numeric_columns(df)
    long = long_form(df, cols).where("value IS NOT NULL")
    probs = [i / n_buckets for i in range(n_buckets + 1)]
    edges = (
        exact_quantiles(long, ["feature"], "value", probs)
        .groupBy("feature")
        .agg(F.array_sort(F.collect_set("quantile")).alias("edges"))
    )
    # One row per column of the schema.
    edges = F.broadcast(edges)
    place = edge_index(F.col("value"), F.col("edges"), n_buckets + 1)
    if closed_last:
        place = F.least(place, F.size("edges") - 1)
    counts = long.join(edges, "feature").groupBy("feature", place.alias("slot")).agg(F.count(F.lit(1)).alias("count"))
    slots = edges.where(F.size("edges") > 1).select(
        "feature", "edges", F.explode(F.sequence(F.lit(1), F.size("edges") - 1)).alias("slot")
    )
    return slots.join(counts, ["feature", "slot"], "left").select(
        F.col("feature").alias("name"),
        F.element_at("edges", F.col("slot")).alias("lower_bound"),
        F.element_at("edges", F.col("slot") + 1).alias("upper_bound"),
        F.coalesce("count", F.lit(0)).alias("count"),
        F.element_at("edges", 1).alias("global_lower_bound"),
        F.element_at("edges", -1).alias("global_upper_bound"),
    )


def baseline_constraints(stats: DataFrame) -> DataFrame:
    """``name, inferred_type, completeness, is_non_negative`` from ``baseline_statistics``."""
    total = F.col("num_present") + F.col("num_missing")
    share = F.when(total > 0, F.col("num_present") / total).otherwise(1.0)
    return stats.select(
        "name",
        "inferred_type",
        F.greatest(F.lit(COMPLETENESS_FLOOR), share - COMPLETENESS_SLACK).alias("completeness"),
        (F.col("min") >= 0).alias("is_non_negative"),
    )


def check_constraints(current: DataFrame, constraints: DataFrame) -> DataFrame:
    """``feature_name, constraint_check_type, description`` for every violated constraint.

    One pass over ``current``; both joined tables have one row per column.
    """
    known = {c for c in current.columns}
    names = [c for c in numeric_columns(current) if c in known]
    seen = per_column(current, names, {"present": F.count, "negative": lambda v: F.count_if(v < 0)})
    seen = seen.withColumnRenamed("item_count", "total").where("total > 0")
    joined = constraints.join(seen, "name", "left")
    share = F.when(F.col("total") > 0, F.col("present") / F.col("total")).otherwise(1.0)
    missing = F.when(
        F.col("total").isNull(),
        F.struct(F.lit("missing_column_check").alias("check"), F.lit("column is absent").alias("text")),
    )
    incomplete = F.when(
        F.col("total").isNotNull() & (share < F.col("completeness")),
        F.struct(
            F.lit("completeness_check").alias("check"),
            F.format_string("completeness %.4f is below %.4f", share, "completeness").alias("text"),
        ),
    )
    negative = F.when(
        F.col("is_non_negative") & (F.col("negative") > 0),
        F.struct(
            F.lit("non_negative_check").alias("check"),
            F.format_string("%d negative values", "negative").alias("text"),
        ),
    )
    found = joined.select("name", F.explode(F.array_compact(F.array(missing, incomplete, negative))).alias("v"))
    return found.select(
        F.col("name").alias("feature_name"),
        F.col("v.check").alias("constraint_check_type"),
        F.col("v.text").alias("description"),
    )


def statistics_document(stats: DataFrame, buckets: DataFrame) -> DataFrame:
    """One row holding the nested statistics document as JSON text."""
    per_name = buckets.groupBy("name").agg(
        F.array_sort(
            F.collect_list(
                F.struct("lower_bound", "upper_bound", "count", "global_lower_bound", "global_upper_bound")
            )
        ).alias("buckets")
    )
    empty = F.array().cast(
        "array<struct<lower_bound:double,upper_bound:double,count:bigint,"
        "global_lower_bound:double,global_upper_bound:double>>"
    )
    sketch = F.struct(F.struct(*[F.lit(v).alias(k) for k, v in SKETCH_PARAMETERS.items()]).alias("parameters"))
    feature = F.struct(
        "name",
        "inferred_type",
        F.struct(
            F.struct("num_present", "num_missing").alias("common"),
            "mean",
            "sum",
            "std_dev",
            "min",
            "max",
            F.struct(
                F.struct(F.coalesce("buckets", empty).alias("buckets"), sketch.alias("sketch")).alias("kll")
            ).alias("distribution"),
        ).alias("numerical_statistics"),
    )
    doc = stats.join(per_name, "name", "left").agg(
        F.max("item_count").alias("items"), F.array_sort(F.collect_list(feature)).alias("features")
    )
    return doc.select(
        F.to_json(
            F.struct(
                F.lit(0.0).alias("version"),
                F.struct(F.coalesce("items", F.lit(0)).alias("item_count")).alias("dataset"),
                "features",
            )
        ).alias("value")
    )


def constraints_document(constraints: DataFrame) -> DataFrame:
    """One row holding the constraints document as JSON text."""
    feature = F.struct(
        "name",
        "inferred_type",
        "completeness",
        F.struct("is_non_negative").alias("num_constraints"),
    )
    monitoring = F.struct(
        F.lit("Enabled").alias("evaluate_constraints"),
        F.lit("Enabled").alias("emit_metrics"),
        F.struct(
            F.lit("Enabled").alias("perform_comparison"),
            F.lit(COMPARISON_THRESHOLD).alias("comparison_threshold"),
            F.lit(COMPARISON_METHOD).alias("comparison_method"),
        ).alias("distribution_constraints"),
    )
    return constraints.agg(F.array_sort(F.collect_list(feature)).alias("features")).select(
        F.to_json(
            F.struct(F.lit(0.0).alias("version"), "features", monitoring.alias("monitoring_config"))
        ).alias("value")
    )
