"""Decoding, data quality and stream queries."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timecols import naive_timestamps
from tidemark.operators import quality
from tidemark.operators.snapshot import latest_per_entity
from tidemark.plans.inputs import EV, events
from tidemark.plans.windows import GAPS
from tidemark.session import ensure_checkpoint_dir
from tidemark.sources import readers
from tidemark.streaming import recency as stream


#: Of the files that a stream reads: a file is what one task takes.
ROWS_PER_FILE = 100_000


def raw_records(spark, sf) -> DataFrame:
    """Events as base64 JSON payloads.  Errors arrive malformed, sign-ups without a user."""
    ev = events(spark, sf)
    payload = F.to_json(
        F.struct(
            F.when(F.col("event_type") != "signup", F.col("user_id").cast("string")).alias("user_id"),
            "event_type",
            "product_id",
            "amount",
            "event_ts",
        ),
        {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"},
    )
    text = F.when(F.col("event_type") == "error", F.concat(F.lit("{broken "), payload)).otherwise(payload)
    return ev.select(
        F.base64(F.encode(text, "utf-8")).alias("data"),
        (F.col("event_ts") + F.expr("INTERVAL 2 SECONDS")).alias("arrival_ts"),
    )


def decode_events(spark, sf):
    decoded = readers.decode_events(raw_records(spark, sf))
    kept = readers.valid_events(decoded).withColumn("status", F.lit("valid"))
    lost = readers.quarantined_events(decoded).select("arrival_ts", F.lit("quarantined").alias("status"))
    return naive_timestamps(kept.unionByName(lost, allowMissingColumns=True))


def _messy(spark, sf):
    """Events without type for errors, without user for sign-ups, and negative small purchases."""
    return events(spark, sf).withColumns(
        {
            "user_id": F.when(F.col("event_type") != "signup", F.col("user_id")),
            "amount": F.when(
                (F.col("event_type") == "purchase") & (F.col("amount") < 5), -F.col("amount")
            ).otherwise(F.col("amount")),
            "event_type": F.when(F.col("event_type") != "error", F.col("event_type")),
        }
    )


def dq_expectations(spark, sf):
    kept, _ = quality.apply_expectations(_messy(spark, sf), quality.event_rules())
    return naive_timestamps(kept)


def dq_quarantine(spark, sf):
    _, lost = quality.apply_expectations(_messy(spark, sf), quality.event_rules())
    return lost.select("event_id", F.concat_ws(",", "failed_rules").alias("failed_rules"))


def dq_expectation_counts(spark, sf):
    return quality.expectation_counts(_messy(spark, sf), quality.event_rules())


def recency_medallion(spark, sf):
    """Raw payloads to recency features in one plan."""
    out = stream.recency_from_raw(raw_records(spark, sf), exact_distinct=True)
    return naive_timestamps(out.withColumn("avg_order_value_last_1h", F.round("avg_order_value_last_1h", 6)))


def _run_stream(spark, build, sf, mode: str) -> DataFrame:
    """Let the events arrive in three parts by time, run the stream over each, and return what it appended."""
    root = f"{ensure_checkpoint_dir(spark)}/stream-{uuid.uuid4().hex}"
    stored = spark.read.parquet(f"{sf}/events.parquet")
    at = F.unix_micros(F.col("ts").cast("timestamp"))
    cuts, n = stored.agg(F.percentile_approx(at, [1 / 3, 2 / 3], 1000), F.count("*")).first()
    cuts, files = cuts or [0, 0], max(4, n // (3 * ROWS_PER_FILE))
    raw = spark.readStream.schema(stored.schema).parquet(f"{root}/in/*")
    ev = raw.select(
        "event_id",
        F.col("user_id").cast("string").alias("user_id"),
        "event_type",
        F.get_json_object("props", "$.k").alias("product_id"),
        F.col("value").alias("amount"),
        F.col("ts").cast("timestamp").alias("event_ts"),
    )
    result = build(ev)

    def store(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{root}/out/batch={batch_id}")

    for k, part in enumerate((at < cuts[0], at.between(cuts[0], cuts[1] - 1), at >= cuts[1])):
        stored.where(part).repartition(files).write.parquet(f"{root}/in/part={k}")
        query = (
            result.writeStream.foreachBatch(store)
            .outputMode(mode)
            .option("checkpointLocation", f"{root}/checkpoint")
            .trigger(availableNow=True)
            .start()
        )
        query.awaitTermination()
    return spark.read.parquet(f"{root}/out").select(*result.columns)


def gap_reset_stream(spark, sf):
    """The keyed-state stream over several micro-batches: the last record of every user."""
    out = _run_stream(spark, stream.gap_reset_stream, sf, "update")
    last = latest_per_entity(out, ["user_id"], created=None)
    return naive_timestamps(
        last.withColumns({c: F.round(c, 4) for c in ("order_value_last_1h", "avg_order_value_last_1h")})
    )


def user_recency_stream(spark, sf):
    """The sliding recency stream: windows the watermark has closed."""
    out = _run_stream(spark, stream.gold, sf, "append")
    return naive_timestamps(out.withColumn("avg_order_value_last_1h", F.round("avg_order_value_last_1h", 6)))


QUERIES = {
    f.__name__: f
    for f in (
        decode_events,
        dq_expectations,
        dq_quarantine,
        dq_expectation_counts,
        recency_medallion,
        gap_reset_stream,
        user_recency_stream,
    )
}

_MESSY = f"""WITH {EV}, m AS (
  SELECT event_id, CASE WHEN event_type <> 'signup' THEN user_id END AS user_id,
         CASE WHEN event_type <> 'error' THEN event_type END AS event_type, product_id,
         CASE WHEN event_type = 'purchase' AND amount < 5 THEN -amount ELSE amount END AS amount, event_ts
  FROM ev)"""
_WINDOWS = """w AS (
  SELECT e.*, time_bucket(INTERVAL 5 MINUTES, event_ts, TIMESTAMP '1970-01-01')
              + to_minutes(CAST(60 - 5 * s.i AS INTEGER)) AS event_time
  FROM e, range(12) AS s(i))"""

ORACLE = {
    "decode_events": f"""WITH {EV}
SELECT CASE WHEN ok THEN CAST(user_id AS VARCHAR) END AS user_id, CASE WHEN ok THEN event_type END AS event_type,
       CASE WHEN ok THEN product_id END AS product_id, CASE WHEN ok THEN amount END AS amount,
       CASE WHEN ok THEN event_ts END AS event_ts, event_ts + INTERVAL 2 SECONDS AS arrival_ts,
       CASE WHEN ok THEN 'valid' ELSE 'quarantined' END AS status
FROM (SELECT *, event_type NOT IN ('error', 'signup') AS ok FROM ev)""",
    "dq_expectations": f"{_MESSY} SELECT * FROM m WHERE event_type IS NOT NULL AND user_id IS NOT NULL",
    "dq_quarantine": f"""{_MESSY}
SELECT event_id, CASE WHEN event_type IS NULL THEN 'event_not_null' ELSE 'user_id_not_null' END AS failed_rules
FROM m WHERE event_type IS NULL OR user_id IS NULL""",
    "dq_expectation_counts": f"""{_MESSY}, c AS (
  SELECT count(*) AS n, count(*) FILTER (event_type IS NULL) AS f0, count(*) FILTER (user_id IS NULL) AS f1,
         count(*) FILTER (coalesce(event_type NOT IN ('view', 'click', 'purchase', 'cart_add'), true)) AS f2,
         count(*) FILTER (NOT coalesce(event_type <> 'purchase' OR amount > 0, false)) AS f3
  FROM m)
SELECT 'event_not_null' AS rule, 'drop' AS action, n - f0 AS passed, f0 AS failed FROM c
UNION ALL SELECT 'user_id_not_null', 'drop', n - f1, f1 FROM c
UNION ALL SELECT 'valid_event_type', 'warn', n - f2, f2 FROM c
UNION ALL SELECT 'amount_positive_for_purchase', 'warn', n - f3, f3 FROM c""",
    "recency_medallion": f"""WITH {EV}, e AS (SELECT * FROM ev WHERE event_type NOT IN ('error', 'signup')), {_WINDOWS}
SELECT CAST(user_id AS VARCHAR) AS user_id, event_time,
       CAST(count(*) FILTER (event_ts >= event_time - INTERVAL 5 MINUTES) AS INTEGER) AS events_last_5min,
       CAST(count(*) AS INTEGER) AS events_last_1h,
       CAST(count(DISTINCT product_id) AS INTEGER) AS distinct_products_last_1h,
       round(coalesce(avg(CASE WHEN event_type = 'purchase' THEN amount END), 0.0), 6) AS avg_order_value_last_1h,
       CAST(floor(epoch(event_time)) - floor(epoch(max(event_ts))) AS INTEGER) AS seconds_since_last_event,
       event_time AS ingestion_time
FROM w GROUP BY user_id, event_time""",
    "gap_reset_stream": f"""{GAPS}
SELECT CAST(user_id AS VARCHAR) AS user_id, event_ts AS event_time, events_last_5min, events_last_1h,
       distinct_products_last_1h, orders_last_1h, order_value_last_1h,
       round(CASE WHEN orders_last_1h > 0 THEN order_value_last_1h / orders_last_1h ELSE 0 END, 4) AS avg_order_value_last_1h,
       seconds_since_last_event
FROM g QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_ts DESC, event_id DESC) = 1""",
    "user_recency_stream": f"""WITH {EV}, e AS (SELECT * FROM ev), {_WINDOWS}
SELECT CAST(user_id AS VARCHAR) AS user_id, event_time,
       CAST(count(*) FILTER (event_ts >= event_time - INTERVAL 5 MINUTES) AS INTEGER) AS events_last_5min,
       CAST(count(*) AS INTEGER) AS events_last_1h, event_time AS ingestion_time,
       CAST(count(DISTINCT product_id) AS INTEGER) AS distinct_products_last_1h,
       round(coalesce(avg(CASE WHEN event_type = 'purchase' THEN amount END), 0.0), 6) AS avg_order_value_last_1h,
       CAST(floor(epoch(event_time)) - floor(epoch(max(event_ts))) AS INTEGER) AS seconds_since_last_event
FROM w WHERE event_time <= (SELECT max(ts) - INTERVAL 10 MINUTES FROM events) GROUP BY user_id, event_time""",
}
