"""Window and recency queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.timecols import naive_timestamps
from tidemark.operators import recency, windows
from tidemark.operators.windows import Agg
from tidemark.plans.inputs import EV, events, slice_rows


def _r(df, **digits):
    return naive_timestamps(df.withColumns({c: F.round(c, n) for c, n in digits.items()}))


def rolling_count(spark, sf):
    return _r(windows.rolling_count(events(spark, sf), "user_id", "event_ts"))


def rolling_count_sliding(spark, sf):
    return _r(windows.rolling_count(events(spark, sf), "user_id", "event_ts", "1 hour", "5 minutes"))


def rolling_sum(spark, sf):
    return _r(windows.rolling_sum(events(spark, sf), "user_id", "event_ts", "amount"), rolling_sum_amount=4)


def rolling_sum_sliding(spark, sf):
    out = windows.rolling_sum(events(spark, sf), "user_id", "event_ts", "amount", "1 hour", "5 minutes")
    return _r(out, rolling_sum_amount=4)


def rolling_avg(spark, sf):
    return _r(windows.rolling_avg(events(spark, sf), "user_id", "event_ts", "amount", "1 day"), rolling_avg_amount=6)


def ratio_feature(spark, sf):
    out = windows.ratio_feature(events(spark, sf), "user_id", "event_type", "event_ts", "purchase", "view")
    return _r(out, event_ratio=6)


def distinct_count_rolling(spark, sf):
    return _r(windows.distinct_count_rolling(events(spark, sf), "user_id", "event_ts", "product_id"))


def distinct_count_exact(spark, sf):
    return _r(windows.distinct_count_rolling(events(spark, sf), "user_id", "event_ts", "product_id", exact=True))


def salted_rolling_count(spark, sf):
    aggs = {"rolling_count": Agg("count"), "rolling_sum": Agg("sum", "amount")}
    out = windows.salted_rolling_agg(events(spark, sf), "user_id", "event_ts", "1 hour", aggs, 8, "event_id")
    return _r(out, rolling_sum=4)


def user_recency_sliding(spark, sf):
    out = windows.user_recency_sliding(events(spark, sf), exact_distinct=True)
    return _r(out, avg_order_value_last_1h=6)


def time_since_last_event(spark, sf):
    out = recency.time_since_last_event(
        events(spark, sf).select("event_id", "user_id", "event_ts"), "user_id", "event_ts", "event_ts", tiebreak="event_id"
    )
    return naive_timestamps(out)


def user_recency_trailing(spark, sf):
    return _r(recency.user_recency_trailing(events(spark, sf)), avg_order_value_last_1h=6)


def user_recency_trailing_sliced(spark, sf):
    """As ``user_recency_trailing``, with every user cut into slices."""
    out = recency.user_recency_trailing(events(spark, sf), rows_per_slice=slice_rows(events(spark, sf)))
    return _r(out, avg_order_value_last_1h=6)


def gap_reset_counters_sliced(spark, sf):
    """As ``gap_reset_counters``, with every user cut into slices."""
    return _gap_counters(spark, sf, rows_per_slice=slice_rows(events(spark, sf)))


def sessionize_sliced(spark, sf):
    """As ``sessionize``, with every user cut into slices."""
    return naive_timestamps(recency.sessionize(events(spark, sf), "user_id", "event_ts", "1 hour", rows_per_slice=slice_rows(events(spark, sf))))


def gap_reset_counters(spark, sf):
    return _gap_counters(spark, sf)


def _gap_counters(spark, sf, **options):
    out = recency.gap_reset_counters(events(spark, sf), "user_id", "event_ts", tiebreak="event_id", **options)
    return _r(out, order_value_last_1h=4, avg_order_value_last_1h=6)


def sessionize(spark, sf):
    return naive_timestamps(recency.sessionize(events(spark, sf), "user_id", "event_ts", "1 hour"))


QUERIES = {
    f.__name__: f
    for f in (
        rolling_count,
        rolling_count_sliding,
        rolling_sum,
        rolling_sum_sliding,
        rolling_avg,
        ratio_feature,
        distinct_count_rolling,
        distinct_count_exact,
        salted_rolling_count,
        user_recency_sliding,
        time_since_last_event,
        user_recency_trailing,
        user_recency_trailing_sliced,
        gap_reset_counters,
        gap_reset_counters_sliced,
        sessionize,
        sessionize_sliced,
    )
}


def _tumbling(aggs: str, interval: str) -> str:
    return f"""WITH {EV}, w AS (
  SELECT *, time_bucket(INTERVAL {interval}, event_ts, TIMESTAMP '1970-01-01') AS window_start FROM ev)
SELECT user_id, {aggs}, window_start, window_start + INTERVAL {interval} AS window_end
FROM w GROUP BY user_id, window_start"""


_SLIDES = f"""WITH {EV}, w AS (
  SELECT ev.*, time_bucket(INTERVAL 5 MINUTES, event_ts, TIMESTAMP '1970-01-01')
               - to_minutes(CAST(5 * s.i AS INTEGER)) AS window_start
  FROM ev, range(12) AS s(i))"""


def _sliding(aggs: str) -> str:
    return f"""{_SLIDES}
SELECT user_id, {aggs}, window_start, window_start + INTERVAL 1 HOUR AS window_end
FROM w GROUP BY user_id, window_start"""


GAPS = f"""WITH {EV}, p AS (
  SELECT *, lag(event_ts) OVER u AS prev FROM ev WINDOW u AS (PARTITION BY user_id ORDER BY event_ts, event_id)),
f AS (
  SELECT *, CASE WHEN prev IS NULL OR event_ts - prev > INTERVAL 5 MINUTES THEN 1 ELSE 0 END AS r5,
         CASE WHEN prev IS NULL OR event_ts - prev > INTERVAL 1 HOUR THEN 1 ELSE 0 END AS r60 FROM p),
i AS (
  SELECT *, sum(r5) OVER u AS i5, sum(r60) OVER u AS i60 FROM f
  WINDOW u AS (PARTITION BY user_id ORDER BY event_ts, event_id)),
c AS (
  SELECT *, row_number() OVER (PARTITION BY user_id, i5 ORDER BY event_ts, event_id) AS events_last_5min,
         row_number() OVER h AS events_last_1h, count(DISTINCT product_id) OVER h AS distinct_products_last_1h,
         count(CASE WHEN event_type = 'purchase' THEN amount END) OVER h AS orders_last_1h,
         coalesce(sum(CASE WHEN event_type = 'purchase' THEN amount END) OVER h, 0.0) AS order_value,
         first_value(event_ts) OVER (PARTITION BY user_id, i5 ORDER BY event_ts, event_id) AS session_start
  FROM i WINDOW h AS (PARTITION BY user_id, i60 ORDER BY event_ts, event_id
                      ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)),
g AS (
  SELECT event_id, user_id, event_type, product_id, amount, event_ts, events_last_5min, events_last_1h,
         distinct_products_last_1h, orders_last_1h, round(order_value, 4) AS order_value_last_1h,
         round(CASE WHEN orders_last_1h > 0 THEN order_value / orders_last_1h ELSE 0 END, 6) AS avg_order_value_last_1h,
         CAST(coalesce(floor(epoch(event_ts)) - floor(epoch(prev)), 0) AS BIGINT) AS seconds_since_last_event,
         session_start
  FROM c)"""

ORACLE = {
    "rolling_count": _tumbling("count(*) AS rolling_count", "1 HOUR"),
    "rolling_count_sliding": _sliding("count(*) AS rolling_count"),
    "rolling_sum": _tumbling("round(sum(amount), 4) AS rolling_sum_amount", "1 HOUR"),
    "rolling_sum_sliding": _sliding("round(sum(amount), 4) AS rolling_sum_amount"),
    "rolling_avg": _tumbling("round(avg(amount), 6) AS rolling_avg_amount", "1 DAY"),
    "ratio_feature": _tumbling(
        """count(*) FILTER (event_type = 'purchase') AS num_cnt, count(*) FILTER (event_type = 'view') AS denom_cnt,
       round(CASE WHEN count(*) FILTER (event_type = 'view') > 0 THEN count(*) FILTER (event_type = 'purchase')
             / count(*) FILTER (event_type = 'view') ELSE 0.0 END, 6) AS event_ratio""",
        "7 DAYS",
    ),
    "distinct_count_exact": _tumbling("count(DISTINCT product_id) AS distinct_product_id_count", "30 DAYS"),
    "salted_rolling_count": _tumbling("count(*) AS rolling_count, round(sum(amount), 4) AS rolling_sum", "1 HOUR"),
    "user_recency_sliding": f"""{_SLIDES}, e AS (SELECT *, window_start + INTERVAL 1 HOUR AS event_time FROM w)
SELECT user_id, event_time, event_time AS ingestion_time,
       CAST(count(*) FILTER (event_ts >= event_time - INTERVAL 5 MINUTES) AS INTEGER) AS events_last_5min,
       CAST(count(*) AS INTEGER) AS events_last_1h,
       CAST(count(DISTINCT product_id) AS INTEGER) AS distinct_products_last_1h,
       round(coalesce(avg(CASE WHEN event_type = 'purchase' THEN amount END), 0.0), 6) AS avg_order_value_last_1h,
       CAST(floor(epoch(event_time)) - floor(epoch(max(event_ts))) AS INTEGER) AS seconds_since_last_event
FROM e GROUP BY user_id, event_time""",
    "time_since_last_event": """
SELECT event_id, user_id, ts AS event_ts, lag(ts) OVER u AS prev_event_ts,
       CAST(floor(epoch(ts)) - floor(epoch(lag(ts) OVER u)) AS BIGINT) AS seconds_since_last_event
FROM events WINDOW u AS (PARTITION BY user_id ORDER BY ts, event_id)""",
    "user_recency_trailing": f"""WITH {EV}
SELECT ev.*, count(*) OVER m AS events_last_5min, count(*) OVER h AS events_last_1h,
       count(DISTINCT product_id) OVER h AS distinct_products_last_1h,
       round(coalesce(avg(CASE WHEN event_type = 'purchase' THEN amount END) OVER h, 0.0), 6) AS avg_order_value_last_1h
FROM ev
WINDOW m AS (PARTITION BY user_id ORDER BY event_ts RANGE BETWEEN INTERVAL 5 MINUTES PRECEDING AND CURRENT ROW),
       h AS (PARTITION BY user_id ORDER BY event_ts RANGE BETWEEN INTERVAL 1 HOUR PRECEDING AND CURRENT ROW)""",
    "gap_reset_counters": f"{GAPS} SELECT * FROM g",
    "sessionize": f"""WITH {EV}, p AS (
  SELECT *, lag(event_ts) OVER (PARTITION BY user_id ORDER BY event_ts) AS prev FROM ev),
i AS (
  SELECT *, sum(CASE WHEN prev IS NULL OR event_ts - prev > INTERVAL 1 HOUR THEN 1 ELSE 0 END)
            OVER (PARTITION BY user_id ORDER BY event_ts) AS island FROM p)
SELECT user_id, min(event_ts) AS session_start, max(event_ts) AS session_last, count(*) AS n_events
FROM i GROUP BY user_id, island""",
}
ORACLE |= {f"{name}_sliced": ORACLE[name] for name in ("user_recency_trailing", "gap_reset_counters", "sessionize")}
