"""Monitoring reports over drift tables, inference logs and ingest logs.

Every report takes ``as_of`` instead of reading the clock, so that a rerun gives the same rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.quantiles import exact_quantiles


def _since(df: DataFrame, ts: str, as_of: Column, interval: str) -> DataFrame:
    return df.where(F.col(ts) > as_of - F.expr(f"INTERVAL {interval}"))


def drift_trend(reports: DataFrame, as_of: Column, interval: str = "7 DAYS") -> DataFrame:
    """``hour, feature_name, psi, ks_stat`` of the recent reports, newest first."""
    return (
        _since(reports, "monitoring_run_ts", as_of, interval)
        .select(F.date_trunc("hour", "monitoring_run_ts").alias("hour"), "feature_name", "psi", "ks_stat")
        .orderBy(F.desc("hour"), "feature_name")
    )


def top_drifting_features(reports: DataFrame, as_of: Column, interval: str = "24 HOURS") -> DataFrame:
    """Features that drifted at least once, most often first."""
    return (
        _since(reports, "monitoring_run_ts", as_of, interval)
        .groupBy("feature_name")
        .agg(
            F.count_if("drift_detected").alias("drift_hours_last_24h"),
            F.avg("psi").alias("avg_psi"),
            F.max("psi").alias("max_psi"),
            F.min("ks_pvalue").alias("min_ks_pvalue"),
        )
        .where("drift_hours_last_24h > 0")
        .orderBy(F.desc("drift_hours_last_24h"), F.desc("avg_psi"))
    )


def drift_hourly(reports: DataFrame, as_of: Column, interval: str = "7 DAYS") -> DataFrame:
    return (
        _since(reports, "monitoring_run_ts", as_of, interval)
        .groupBy("endpoint_name", F.date_trunc("hour", "monitoring_run_ts").alias("hour"))
        .agg(F.count_if("drift_detected").alias("drifted_features"), F.avg("psi").alias("avg_psi"))
    )


def endpoint_performance(logs: DataFrame, as_of: Column, interval: str = "7 DAYS") -> DataFrame:
    """Invocations, exact p99 latency and mean score per endpoint and hour."""
    recent = _since(logs, "request_ts", as_of, interval).select(
        "endpoint_name",
        F.date_trunc("hour", "request_ts").alias("hour"),
        "latency_ms",
        "prediction_score",
    )
    counts = recent.groupBy("endpoint_name", "hour").agg(
        F.count(F.lit(1)).alias("invocation_count"), F.avg("prediction_score").alias("avg_prediction_score")
    )
    p99 = exact_quantiles(recent, ["endpoint_name", "hour"], "latency_ms", [0.99])
    return counts.join(
        p99.select("endpoint_name", "hour", F.col("quantile").alias("p99_latency_ms")), ["endpoint_name", "hour"], "left"
    ).select("endpoint_name", "hour", "invocation_count", "p99_latency_ms", "avg_prediction_score")


def drift_vs_performance(
    reports: DataFrame, logs: DataFrame, as_of: Column, interval: str = "7 DAYS"
) -> DataFrame:
    """Hourly drift beside hourly performance, for hours that have both."""
    return (
        drift_hourly(reports, as_of, interval)
        .join(endpoint_performance(logs, as_of, interval), ["endpoint_name", "hour"])
        .orderBy(F.desc("hour"), "endpoint_name")
    )


def feature_freshness(registry: DataFrame, as_of: Column, factor: float = 1.0) -> DataFrame:
    """Newest ingestion per view and whether it is older than ``factor`` times its TTL."""
    age = F.unix_seconds(as_of) - F.unix_seconds(F.col("latest").cast("timestamp"))
    return (
        registry.groupBy("feature_view", "ttl_seconds")
        .agg(F.max("ingestion_time").alias("latest"))
        .select(
            "feature_view",
            F.col("latest").alias("latest_ingest"),
            age.alias("seconds_since_last_ingest"),
            "ttl_seconds",
            F.when(age > F.col("ttl_seconds") * F.lit(factor), "STALE").otherwise("FRESH").alias("status"),
        )
        .orderBy(F.desc("seconds_since_last_ingest"))
    )


def lookup_health(logs: DataFrame, alert_below: float = 0.95) -> DataFrame:
    """Per view: lookups, hits, hit rate, mean latency and whether the rate is alarming.

    ``logs`` has ``feature_view, is_hit, latency_ms``.
    """
    rate = F.col("lookups_hit") / F.col("lookups")
    return (
        logs.groupBy("feature_view")
        .agg(
            F.count(F.lit(1)).alias("lookups"),
            F.count_if("is_hit").alias("lookups_hit"),
            F.avg("latency_ms").alias("avg_latency_ms"),
        )
        .select(
            "feature_view",
            "lookups",
            "lookups_hit",
            "avg_latency_ms",
            rate.alias("hit_rate"),
            (rate < alert_below).alias("is_alert"),
        )
    )


def ingest_health(logs: DataFrame) -> DataFrame:
    """Per view: ingested and failed records and the total duration of the writes."""
    return logs.groupBy("feature_view").agg(
        F.sum("records_ingested").alias("records_ingested"),
        F.sum("records_failed").alias("records_failed"),
        F.sum("duration_ms").alias("duration_ms"),
    )


def inference_log(
    scored: DataFrame, endpoint: str | Column, request_id: str, request_ts: str, latency: str, score: str, percent: int = 100
) -> DataFrame:
    """Log rows of a scored batch; below 100 percent a request is kept or not by its id's hash."""
    name = F.lit(endpoint) if isinstance(endpoint, str) else endpoint
    kept = scored if percent >= 100 else scored.where(F.pmod(F.xxhash64(request_id), F.lit(100)) < percent)
    return kept.select(
        name.alias("endpoint_name"),
        F.col(request_id).alias("request_id"),
        F.col(request_ts).alias("request_ts"),
        F.col(latency).alias("latency_ms"),
        F.col(score).alias("prediction_score"),
    )

