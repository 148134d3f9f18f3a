"""The supplied tables seen as feature-platform inputs, in Spark and in SQL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.functions.timecols import utc_timestamps


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return utc_timestamps(spark.read.parquet(f"{sf_dir}/{name}.parquet"))


def slice_rows(df: DataFrame) -> int:
    """Rows of a slice where the plans for hot entities are to be seen at work: few on small tables, a 5 000th of large ones, so
    that the number of slices is bounded."""
    return max(20, df.count() // 5_000)


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``event_id, user_id, event_type, product_id, amount, event_ts``."""
    return table(spark, sf_dir, "events").select(
        "event_id",
        "user_id",
        "event_type",
        F.get_json_object("props", "$.k").alias("product_id"),
        F.col("value").alias("amount"),
        F.col("ts").alias("event_ts"),
    )


EV = """ev AS (
  SELECT event_id, user_id, event_type, json_extract_string(props, '$.k') AS product_id,
         value AS amount, ts AS event_ts
  FROM events)"""


def utc(text: str) -> Column:
    return F.lit(text).cast("timestamp")


def interest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """View and click events as a feature history."""
    return events(spark, sf_dir).where("event_type IN ('view', 'click')")


def purchases(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Purchase events as labels."""
    return events(spark, sf_dir).where("event_type = 'purchase'").select("event_id", "user_id", "event_ts")


def drift_reports(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        F.col("event_type").alias("endpoint_name"),
        F.col("event_ts").alias("monitoring_run_ts"),
        F.col("product_id").alias("feature_name"),
        (F.col("amount") / 400).alias("psi"),
        (F.col("amount") / 500).alias("ks_stat"),
        (1 / (1 + F.col("amount"))).alias("ks_pvalue"),
        (F.col("amount") >= 100).alias("drift_detected"),
    )


REPORTS = """reports AS (
  SELECT event_type AS endpoint_name, ts AS monitoring_run_ts,
         json_extract_string(props, '$.k') AS feature_name,
         value / 400 AS psi, value / 500 AS ks_stat, 1 / (1 + value) AS ks_pvalue,
         value >= 100 AS drift_detected
  FROM events)"""


def inference_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events(spark, sf_dir).select(
        F.col("event_type").alias("endpoint_name"),
        F.col("event_id").alias("request_id"),
        F.col("event_ts").alias("request_ts"),
        F.col("amount").alias("latency_ms"),
        (F.col("amount") / 500).alias("prediction_score"),
    )


LOGS = """logs AS (
  SELECT event_type AS endpoint_name, event_id AS request_id, ts AS request_ts,
         value AS latency_ms, value / 500 AS prediction_score
  FROM events)"""


def with_lateness(df: DataFrame) -> DataFrame:
    """Ingestion between 0 and 4 hours after the event, from the event's id."""
    late = F.pmod(F.col("event_id") * 37, F.lit(240))
    return df.withColumn("ingestion_time", F.timestamp_micros(F.unix_micros("event_ts") + late * 60_000_000))


LATE = "event_ts + to_minutes(CAST((event_id * 37) % 240 AS INTEGER))"
