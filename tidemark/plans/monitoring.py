"""Baseline, drift and report queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.timecols import naive_timestamps
from tidemark.operators import baseline, drift, quality, reports
from tidemark.plans.inputs import EV, LOGS, REPORTS, drift_reports, events, inference_logs, table, utc

_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
_SPLIT = "1998-06-01"
_AS_OF = "2024-01-31"


def _items(spark, sf):
    return table(spark, sf, "lineitem").select("l_shipdate", *_COLS)


def _sides(spark, sf):
    """Items shipped before and after a date; after it, prices are raised by a fifth."""
    items = _items(spark, sf)
    current = items.where(F.col("l_shipdate") >= utc(_SPLIT)).withColumn(
        "l_extendedprice", F.round(F.col("l_extendedprice") * 1.2, 2)
    )
    return items.where(F.col("l_shipdate") < utc(_SPLIT)), current


def _gaps(df):
    """Prices of the cheapest items are missing."""
    return df.withColumn("l_extendedprice", F.when(F.col("l_quantity") > 2, F.col("l_extendedprice")))


def baseline_statistics(spark, sf):
    out = baseline.baseline_statistics(_gaps(_items(spark, sf)), _COLS)
    return out.withColumns({"mean": F.round("mean", 5), "sum": F.round("sum", 1), "std_dev": F.round("std_dev", 5)})


def baseline_buckets(spark, sf):
    out = baseline.baseline_buckets(_gaps(_items(spark, sf)), _COLS)
    bounds = ("lower_bound", "upper_bound", "global_lower_bound", "global_upper_bound")
    return out.withColumns({c: F.round(c, 6) for c in bounds})


def baseline_constraints(spark, sf):
    out = baseline.baseline_constraints(baseline.baseline_statistics(_gaps(_items(spark, sf)), _COLS))
    return out.withColumn("completeness", F.round("completeness", 6))


def constraint_violations(spark, sf):
    """Constraints of the first years against later years with missing prices and shifted taxes."""
    base, current = _sides(spark, sf)
    constraints = baseline.baseline_constraints(baseline.baseline_statistics(base, _COLS))
    broken = current.withColumns(
        {
            "l_extendedprice": F.when(F.col("l_quantity") > 10, F.col("l_extendedprice")),
            "l_tax": F.col("l_tax") - 0.01,
        }
    )
    return baseline.check_constraints(broken.select(*_COLS), constraints)


def psi(spark, sf):
    base, current = _sides(spark, sf)
    return drift.psi(base, current, _COLS).withColumn("psi", F.round("psi", 6))


def ks_statistic(spark, sf):
    base, current = _sides(spark, sf)
    return drift.ks(base, current, _COLS).withColumns({c: F.round(c, 6) for c in ("ks_stat", "ks_pvalue")})


def detect_drift(spark, sf):
    base, current = _sides(spark, sf)
    out = drift.detect_drift(base, current, _COLS, psi_threshold=0.1)
    return out.withColumns({c: F.round(c, 6) for c in ("psi", "ks_stat", "ks_pvalue")})


def drift_trend(spark, sf):
    return naive_timestamps(reports.drift_trend(drift_reports(spark, sf), utc(_AS_OF)))


def top_drifting_features(spark, sf):
    out = reports.top_drifting_features(drift_reports(spark, sf), utc(_AS_OF))
    return out.withColumn("avg_psi", F.round("avg_psi", 12))


def endpoint_performance(spark, sf):
    out = reports.endpoint_performance(inference_logs(spark, sf), utc(_AS_OF))
    return naive_timestamps(
        out.withColumns(
            {"p99_latency_ms": F.round("p99_latency_ms", 5), "avg_prediction_score": F.round("avg_prediction_score", 12)}
        )
    )


def drift_vs_performance(spark, sf):
    out = reports.drift_vs_performance(drift_reports(spark, sf), inference_logs(spark, sf), utc(_AS_OF))
    return naive_timestamps(
        out.withColumns(
            {
                "p99_latency_ms": F.round("p99_latency_ms", 5),
                "avg_prediction_score": F.round("avg_prediction_score", 12),
                "avg_psi": F.round("avg_psi", 12),
            }
        )
    )


def feature_freshness(spark, sf):
    """Every event type as a view; purchases and views have short limits."""
    ttl = F.when(F.col("event_type").isin("purchase", "view"), 600).otherwise(86400)
    registry = events(spark, sf).select(
        F.col("event_type").alias("feature_view"), F.col("event_ts").alias("ingestion_time"), ttl.alias("ttl_seconds")
    )
    return naive_timestamps(reports.feature_freshness(registry, utc("2024-01-31 00:30:00")))


def alert_severity(spark, sf):
    """Thresholds are two and four times an endpoint's mean index."""
    found = drift_reports(spark, sf)
    thresholds = found.groupBy("endpoint_name").agg(
        (F.avg("psi") * 2).alias("psi_warning"), (F.avg("psi") * 4).alias("psi_critical")
    )
    return quality.alert_severity(found, thresholds)


def alert_topics(spark, sf):
    """The message for each endpoint's topic, with its 20 worst features."""
    found = drift_reports(spark, sf)
    thresholds = found.groupBy("endpoint_name").agg((F.avg("psi") * 2).alias("psi_warning"), (F.avg("psi") * 4).alias("psi_critical"))
    out = quality.topic_messages(found, thresholds)
    return out.withColumn("violations", F.array_join(F.transform("violations", lambda v: F.concat_ws("/", v["feature"], v["severity"])), ","))


def lookup_hit_rate(spark, sf):
    logs = events(spark, sf).select(
        F.col("event_type").alias("feature_view"), (F.col("amount") > 2.5).alias("is_hit"), F.col("amount").alias("latency_ms")
    )
    out = reports.lookup_health(logs)
    return out.withColumns({"avg_latency_ms": F.round("avg_latency_ms", 6), "hit_rate": F.round("hit_rate", 6)})


def ingest_health(spark, sf):
    logs = events(spark, sf).select(
        F.col("event_type").alias("feature_view"),
        F.floor("amount").alias("records_ingested"),
        F.when(F.col("amount") > 200, 1).otherwise(0).alias("records_failed"),
        F.ceil("amount").alias("duration_ms"),
    )
    return reports.ingest_health(logs)


def inference_log_sample(spark, sf):
    return naive_timestamps(
        reports.inference_log(
            inference_logs(spark, sf), F.col("endpoint_name"), "request_id", "request_ts", "latency_ms", "prediction_score", 10
        )
    )


QUERIES = {
    f.__name__: f
    for f in (
        baseline_statistics,
        baseline_buckets,
        baseline_constraints,
        constraint_violations,
        psi,
        ks_statistic,
        detect_drift,
        drift_trend,
        top_drifting_features,
        endpoint_performance,
        drift_vs_performance,
        feature_freshness,
        alert_severity,
        alert_topics,
        lookup_hit_rate,
        ingest_health,
        inference_log_sample,
    )
}

_PRICE = "CASE WHEN l_quantity > 2 THEN l_extendedprice END"
_LONG = f"""long AS (
  SELECT feature, value FROM (SELECT l_quantity, {_PRICE} AS l_extendedprice, l_discount, l_tax FROM lineitem)
  UNPIVOT INCLUDE NULLS (value FOR feature IN (l_quantity, l_extendedprice, l_discount, l_tax)))"""
_STATS = f"""WITH {_LONG}, stats AS (
  SELECT feature AS name, count(value) AS num_present, count(*) - count(value) AS num_missing,
         round(avg(value), 5) AS mean, round(sum(value), 1) AS sum, round(stddev_pop(value), 5) AS std_dev,
         min(value) AS min, max(value) AS max, count(*) AS item_count, 'Fractional' AS inferred_type
  FROM long GROUP BY feature)"""
_TENTHS = "[0, 0.1, 0.2, 0.3, 0.4, 0.5, 0.6, 0.7, 0.8, 0.9, 1]"
_TWO = f"""long AS (
  UNPIVOT (SELECT l_shipdate < TIMESTAMP '{_SPLIT}' AS base, l_quantity,
                  CASE WHEN l_shipdate < TIMESTAMP '{_SPLIT}' THEN l_extendedprice
                       ELSE round(l_extendedprice * 1.2, 2) END AS l_extendedprice, l_discount, l_tax FROM lineitem)
  ON l_quantity, l_extendedprice, l_discount, l_tax INTO NAME feature VALUE value)"""
_PSI = f"""edges AS (
  SELECT DISTINCT feature, q FROM (
    SELECT feature, unnest(quantile_cont(value, {_TENTHS})) AS q FROM long WHERE base GROUP BY feature)),
bins AS (
  SELECT feature, q AS lo, lead(q) OVER u AS hi, row_number() OVER (PARTITION BY feature ORDER BY q DESC) = 2 AS is_last
  FROM edges WINDOW u AS (PARTITION BY feature ORDER BY q)),
cnt AS (
  SELECT b.feature, b.lo, count(*) FILTER (base) AS nb, count(*) FILTER (NOT base) AS nc
  FROM bins b JOIN long l ON l.feature = b.feature AND l.value >= b.lo
                         AND (l.value < b.hi OR (b.is_last AND l.value = b.hi))
  WHERE b.hi IS NOT NULL GROUP BY b.feature, b.lo),
frac AS (
  SELECT feature, nb / sum(nb) OVER (PARTITION BY feature) + 1e-6 AS fb,
         nc / sum(nc) OVER (PARTITION BY feature) + 1e-6 AS fc FROM cnt),
psi AS (SELECT feature, sum((fc - fb) * ln(fc / fb)) AS psi FROM frac GROUP BY feature)"""
_KS = """ecdf AS (
  SELECT feature, abs(sum(CAST(base AS INTEGER)) OVER u / sum(CAST(base AS INTEGER)) OVER a
                      - sum(CAST(NOT base AS INTEGER)) OVER u / sum(CAST(NOT base AS INTEGER)) OVER a) AS d
  FROM long WINDOW u AS (PARTITION BY feature ORDER BY value), a AS (PARTITION BY feature)),
ks0 AS (SELECT feature, max(d) AS ks_stat FROM ecdf GROUP BY feature),
ks1 AS (SELECT feature, ks_stat, sqrt(n * m / (n + m)) AS root FROM ks0 JOIN (
  SELECT feature, CAST(count(*) FILTER (base) AS DOUBLE) AS n, CAST(count(*) FILTER (NOT base) AS DOUBLE) AS m
  FROM long WHERE value IS NOT NULL GROUP BY feature) USING (feature)),
ks2 AS (SELECT feature, ks_stat, (root + 0.12 + 0.11 / root) * ks_stat AS x FROM ks1),
ks AS (SELECT feature, ks_stat, CASE WHEN x < 0.2 THEN 1.0 ELSE least(1.0, greatest(0.0, (
  SELECT sum(CASE WHEN k % 2 = 1 THEN 2.0 ELSE -2.0 END * exp(-2.0 * k * k * x * x)) FROM range(1, 101) t(k)))) END AS ks_pvalue
  FROM ks2)"""
_WEEK = "TIMESTAMP '2024-01-31' - INTERVAL 7 DAYS"
_PERF = f"""perf AS (
  SELECT endpoint_name, date_trunc('hour', request_ts) AS hour, count(*) AS invocation_count,
         round(quantile_cont(latency_ms, 0.99), 5) AS p99_latency_ms,
         round(avg(prediction_score), 12) AS avg_prediction_score
  FROM logs WHERE request_ts > {_WEEK} GROUP BY 1, 2)"""

ORACLE = {
    "baseline_statistics": f"{_STATS} SELECT * FROM stats",
    "baseline_buckets": f"""WITH {_LONG},
q AS (SELECT feature, unnest(range(10)) AS i, quantile_cont(value, {_TENTHS}) AS e FROM long GROUP BY feature),
b AS (SELECT feature, e[i + 1] AS lo, e[i + 2] AS hi, e[1] AS glo, e[11] AS ghi FROM q)
SELECT b.feature AS name, round(lo, 6) AS lower_bound, round(hi, 6) AS upper_bound, count(l.value) AS count,
       round(glo, 6) AS global_lower_bound, round(ghi, 6) AS global_upper_bound
FROM b LEFT JOIN long l ON l.feature = b.feature AND l.value >= b.lo AND l.value < b.hi
WHERE hi > lo GROUP BY b.feature, lo, hi, glo, ghi""",
    "baseline_constraints": f"""{_STATS}
SELECT name, inferred_type, round(greatest(0.95, num_present / (num_present + num_missing) - 0.05), 6) AS completeness,
       min >= 0 AS is_non_negative FROM stats""",
    "constraint_violations": f"""
WITH c AS (SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '{_SPLIT}'),
n AS (SELECT count(*) FILTER (l_quantity > 10) / count(*) AS share, count(*) FILTER (l_tax - 0.01 < 0) AS neg FROM c)
SELECT 'l_extendedprice' AS feature_name, 'completeness_check' AS constraint_check_type,
       printf('completeness %.4f is below %.4f', share, 0.95::DOUBLE) AS description FROM n WHERE share < 0.95
UNION ALL SELECT 'l_tax', 'non_negative_check', printf('%d negative values', neg) FROM n WHERE neg > 0""",
    "psi": f"WITH {_TWO}, {_PSI} SELECT feature, round(psi, 6) AS psi FROM psi",
    "ks_statistic": f"WITH {_TWO}, {_KS} SELECT feature, round(ks_stat, 6) AS ks_stat, round(ks_pvalue, 6) AS ks_pvalue FROM ks",
    "detect_drift": f"""WITH {_TWO}, {_PSI}, {_KS}
SELECT feature, round(psi, 6) AS psi, round(ks_stat, 6) AS ks_stat, round(ks_pvalue, 6) AS ks_pvalue,
       psi >= 0.1 OR ks_pvalue < 0.01 AS drift_detected,
       concat_ws('; ', CASE WHEN psi >= 0.1 THEN printf('PSI=%.3f >= 0.1', psi) END,
                 CASE WHEN ks_pvalue < 0.01 THEN printf('KS p-value=%.4f < 0.01', ks_pvalue) END) AS message
FROM psi JOIN ks USING (feature)""",
    "drift_trend": f"""WITH {REPORTS}
SELECT date_trunc('hour', monitoring_run_ts) AS hour, feature_name, psi, ks_stat
FROM reports WHERE monitoring_run_ts > {_WEEK}""",
    "top_drifting_features": f"""WITH {REPORTS}
SELECT feature_name, count(*) FILTER (drift_detected) AS drift_hours_last_24h, round(avg(psi), 12) AS avg_psi,
       max(psi) AS max_psi, min(ks_pvalue) AS min_ks_pvalue
FROM reports WHERE monitoring_run_ts > TIMESTAMP '2024-01-31' - INTERVAL 24 HOURS
GROUP BY feature_name HAVING count(*) FILTER (drift_detected) > 0""",
    "endpoint_performance": f"WITH {LOGS}, {_PERF} SELECT * FROM perf",
    "drift_vs_performance": f"""WITH {REPORTS}, {LOGS}, {_PERF},
d AS (SELECT endpoint_name, date_trunc('hour', monitoring_run_ts) AS hour,
             count(*) FILTER (drift_detected) AS drifted_features, round(avg(psi), 12) AS avg_psi
      FROM reports WHERE monitoring_run_ts > {_WEEK} GROUP BY 1, 2)
SELECT endpoint_name, hour, drifted_features, avg_psi, invocation_count, p99_latency_ms, avg_prediction_score
FROM d JOIN perf USING (endpoint_name, hour)""",
    "feature_freshness": """
WITH r AS (SELECT event_type AS feature_view, ts, CASE WHEN event_type IN ('purchase', 'view') THEN 600 ELSE 86400 END AS ttl
           FROM events),
m AS (SELECT feature_view, ttl, max(ts) AS latest, CAST(epoch(TIMESTAMP '2024-01-31 00:30:00') - floor(epoch(max(ts))) AS BIGINT) AS age
      FROM r GROUP BY 1, 2)
SELECT feature_view, latest AS latest_ingest, age AS seconds_since_last_ingest, CAST(ttl AS INTEGER) AS ttl_seconds,
       CASE WHEN age > ttl THEN 'STALE' ELSE 'FRESH' END AS status FROM m""",
    "alert_severity": f"""WITH {REPORTS},
t AS (SELECT endpoint_name, avg(psi) * 2 AS warn, avg(psi) * 4 AS crit FROM reports GROUP BY 1),
a AS (
  SELECT r.endpoint_name, feature_name, psi, CASE WHEN psi >= crit THEN 'critical' ELSE 'warning' END AS severity,
         row_number() OVER (PARTITION BY r.endpoint_name ORDER BY psi DESC, feature_name) AS alert_rank,
         count(*) OVER (PARTITION BY r.endpoint_name) AS total
  FROM reports r JOIN t ON t.endpoint_name = r.endpoint_name WHERE psi >= warn)
SELECT endpoint_name, feature_name, psi, severity, CAST(alert_rank AS INTEGER) AS alert_rank,
       greatest(total - 10, 0) AS n_more,
       CASE WHEN severity = 'critical' THEN 'topic,chat' ELSE 'chat' END AS channels
FROM a WHERE alert_rank <= 10""",
    "alert_topics": f"""WITH {REPORTS},
t AS (SELECT endpoint_name, avg(psi) * 2 AS warn, avg(psi) * 4 AS crit FROM reports GROUP BY 1),
a AS (
  SELECT r.endpoint_name, feature_name, psi, CASE WHEN psi >= crit THEN 'critical' ELSE 'warning' END AS severity,
         row_number() OVER (PARTITION BY r.endpoint_name ORDER BY psi DESC, feature_name) AS place
  FROM reports r JOIN t ON t.endpoint_name = r.endpoint_name WHERE psi >= warn)
SELECT endpoint_name, left('[Drift] ' || endpoint_name || ': ' || count(*) || ' violation(s)', 99) AS subject, count(*) AS violation_count,
       string_agg(feature_name || '/' || severity, ',' ORDER BY place) FILTER (WHERE place <= 20) AS violations
FROM a GROUP BY endpoint_name HAVING bool_or(severity = 'critical')""",
    "lookup_hit_rate": """
SELECT event_type AS feature_view, count(*) AS lookups, count(*) FILTER (value > 2.5) AS lookups_hit,
       round(avg(value), 6) AS avg_latency_ms, round(count(*) FILTER (value > 2.5) / count(*), 6) AS hit_rate,
       count(*) FILTER (value > 2.5) / count(*) < 0.95 AS is_alert
FROM events GROUP BY event_type""",
    "ingest_health": """
SELECT event_type AS feature_view, CAST(sum(floor(value)) AS BIGINT) AS records_ingested,
       CAST(count(*) FILTER (value > 200) AS BIGINT) AS records_failed, CAST(sum(ceil(value)) AS BIGINT) AS duration_ms
FROM events GROUP BY event_type""",
}
