"""Snapshot, maintenance and feature-form queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.timecols import naive_timestamps
from tidemark.operators import formats, lifetime, snapshot
from tidemark.plans.asof import INTEREST_VIEW, PRODUCT_VIEW, TROUBLE_VIEW
from tidemark.plans.inputs import EV, LATE, events, table, utc, with_lateness
from tidemark.sinks.tables import upsert


def _history(spark, sf):
    """Feature history: one row per event with its ingestion time."""
    return with_lateness(events(spark, sf)).select(
        "user_id", F.col("event_ts").alias("event_time"), "ingestion_time", "event_id", "event_type", "amount"
    )


def latest_per_entity(spark, sf):
    return naive_timestamps(snapshot.latest_per_entity(_history(spark, sf), ["user_id"]))


def materialize_snapshot(spark, sf):
    """Snapshot of everything ingested by the 20th, then brought up to date incrementally."""
    history = _history(spark, sf)
    old = snapshot.materialize_snapshot(history.where(F.col("ingestion_time") <= utc("2024-01-20")), ["user_id"])
    return naive_timestamps(snapshot.materialize_snapshot(history, ["user_id"], old, utc("2024-01-20")))


def push_backfill_union(spark, sf):
    """Pushed rows from the 15th on, with amounts doubled, over batch history until the 20th."""
    history = _history(spark, sf)
    pushed = history.where(F.col("event_time") >= utc("2024-01-15")).withColumns(
        {"amount": F.col("amount") * 2, "ingestion_time": F.col("ingestion_time") + F.expr("INTERVAL 1 DAY")}
    )
    batch = history.where(F.col("event_time") < utc("2024-01-20"))
    return naive_timestamps(snapshot.push_backfill_union(pushed, batch, ["user_id"]))


def idempotent_append(spark, sf):
    """Rows of a re-delivered batch (from the 10th) missing in a history that ends on the 20th."""
    history = _history(spark, sf).withColumn("event_date", F.to_date("event_time"))
    batch = history.where(F.col("event_time") >= utc("2024-01-10"))
    stored = history.where(F.col("event_time") < utc("2024-01-20"))
    fresh = snapshot.new_rows_only(batch.unionByName(batch), stored, ["user_id"], partition_col="event_date")
    return naive_timestamps(fresh.drop("event_date"))


def snapshot_lookup(spark, sf):
    """Every event asks for its user's newest purchase, stale after a day."""
    ev = events(spark, sf)
    bought = snapshot.latest_per_entity(
        ev.where("event_type = 'purchase'").withColumnRenamed("event_ts", "event_time"), ["user_id"], created="event_id"
    )
    return snapshot.snapshot_lookup(
        ev.select("event_id", "user_id"), bought, "orders", ["user_id"], ["amount", "product_id"], utc("2024-01-31"), "1 day"
    )


def lookup_many_views(spark, sf):
    """Every event asks for its user's interest and trouble and its product's state as of the 31st; device and latency come with the
    request, the hour is computed from it."""
    ev = events(spark, sf)
    history = ev.withColumnRenamed("event_ts", "event_time")
    stores = [
        (view, snapshot.latest_per_entity(history.where(kinds).where(F.col(view.keys[0]).isNotNull()), list(view.keys), created="event_id"))
        for view, kinds in (
            (INTEREST_VIEW, "event_type IN ('view', 'click') AND event_time < '2024-01-25'"),
            (TROUBLE_VIEW, "event_type IN ('error', 'signup')"),
            (PRODUCT_VIEW, "event_type = 'purchase' AND amount > 100"),
        )
    ]
    requests = ev.select(
        "event_id", F.col("user_id").alias("asked_user"), F.when(F.col("amount") > 10, F.col("product_id")).alias("product_id"),
        "event_ts", F.col("event_type").alias("device_type"), (F.col("amount") / 10).cast("float").alias("client_latency_ms"),
    )
    select = ["interest:amount", "interest:product_id", "trouble:event_type", "product:amount", "product:user_id"]
    keys = {"interest": ["asked_user"], "trouble": ["asked_user"]}
    out = snapshot.lookup_many(requests, stores, select, utc("2024-01-31"), keys, request_ts="event_ts")
    return naive_timestamps(out)


def request_features(spark, sf):
    ev = events(spark, sf).select("event_id", "user_id", "event_ts", F.col("event_type").alias("device_type"))
    return naive_timestamps(snapshot.request_features(ev, "event_ts"))


def parity_report(spark, sf):
    """Offline history against an online copy that lost its errors and changed its clicks."""
    offline = _history(spark, sf).select("user_id", "event_time", "amount", "event_id")
    online = (
        _history(spark, sf)
        .where("event_type <> 'error'")
        .select(
            "user_id",
            "event_time",
            F.when(F.col("event_type") != "click", F.col("amount")).alias("amount"),
            "event_id",
        )
    )
    out = snapshot.parity_report(offline, online, ["user_id", "event_time"], ["amount", "event_id"])
    return naive_timestamps(
        out.withColumns({c: F.round(F.col(c).cast("double"), 4) for c in ("offline_value", "online_value")})
    )


def _large_buyers(spark, sf):
    return events(spark, sf).where("event_type = 'purchase' AND amount > 250").select("user_id").distinct()


def delete_entities(spark, sf):
    return naive_timestamps(
        snapshot.delete_entities(_history(spark, sf), _large_buyers(spark, sf), ["user_id"], "hard")
    )


def delete_entities_tombstone(spark, sf):
    """The snapshot after tombstones: deleted users are there, with nulls."""
    marked = snapshot.delete_entities(
        _history(spark, sf),
        _large_buyers(spark, sf),
        ["user_id"],
        "tombstone",
        utc("2024-02-01"),
        ["event_id", "event_type", "amount"],
    )
    return naive_timestamps(snapshot.latest_per_entity(marked, ["user_id"]))


def _daily(df):
    return df.groupBy("user_id", F.date_trunc("day", "event_ts").alias("event_time")).agg(
        F.count(F.lit(1)).alias("n_events"), F.round(F.sum("amount"), 4).alias("total")
    )


def backfill_range(spark, sf):
    """A daily view whose first build missed clicks, recomputed for one week."""
    ev = events(spark, sf)
    first_build = _daily(ev.where("event_type <> 'click'"))
    out = snapshot.backfill_range(
        _daily, ev, first_build, utc("2024-01-08"), utc("2024-01-15"), "event_ts"
    )
    return naive_timestamps(out)


def feature_long_format(spark, sf):
    history = _history(spark, sf).withColumn("kind", F.when(F.col("event_type") != "error", F.col("event_type")))
    out = formats.feature_long_format(history, "user_id", "event_time", ["event_id", "kind"])
    return naive_timestamps(out)


def feature_wide_format(spark, sf):
    """Long rows (one per event type) back to one row per user and day."""
    long = (
        events(spark, sf)
        .groupBy("user_id", F.date_trunc("day", "event_ts").alias("event_time"), "event_type")
        .agg(F.round(F.sum("amount"), 4).alias("value"), F.count(F.lit(1)).alias("n"))
        .withColumn("ingestion_time", F.col("event_time") + F.expr("INTERVAL 1 DAY"))
    )
    out = formats.feature_wide_format(
        long, ["view", "click", "purchase"], entity="user_id", name="event_type"
    )
    return naive_timestamps(out)


def user_lifetime(spark, sf):
    out = lifetime.user_lifetime(
        table(spark, sf, "orders"),
        table(spark, sf, "lineitem"),
        utc("2000-01-01"),
        "o_custkey",
        "o_orderkey",
        "o_orderdate",
        "o_totalprice",
        "l_orderkey",
        "l_partkey",
    )
    return out.withColumns({"total_spend": F.round("total_spend", 2), "avg_order_value": F.round("avg_order_value", 6)})


def user_lifetime_history(spark, sf):
    out = lifetime.user_lifetime_history(
        table(spark, sf, "orders"),
        table(spark, sf, "lineitem"),
        "o_custkey",
        "o_orderkey",
        "o_orderdate",
        "o_totalprice",
        "l_orderkey",
        "l_partkey",
    )
    digits = {"total_spend": F.round("total_spend", 2), "avg_order_value": F.round("avg_order_value", 6)}
    return naive_timestamps(out.withColumns(digits))


def product_features(spark, sf):
    """Rating is stood in for by a tenth of the quantity."""
    orders = table(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("buyer"))
    bought = (
        table(spark, sf, "lineitem")
        .join(orders, "l_orderkey")
        .select(F.col("l_partkey").alias("product_id"), "buyer", F.col("l_shipdate").alias("ts"), "l_quantity")
    )
    parts = table(spark, sf, "part").withColumnRenamed("p_partkey", "product_id")
    out = lifetime.product_features(
        bought, parts, utc("2000-01-01"), "product_id", "buyer", "ts", F.col("l_quantity") / 10, "p_retailprice"
    )
    return out.withColumn("avg_rating", F.round("avg_rating", 6))


def embedding_upsert(spark, sf):
    """Vectors as of version 1, upserted with doubled vectors for label 0."""
    vectors = table(spark, sf, "embeddings").select(
        F.lit("item").alias("entity_type"),
        F.col("vec_id").cast("string").alias("entity_id"),
        F.lit("embedding_v1").alias("feature_name"),
        "embedding",
        "label",
    )
    new = vectors.where("label = 0").select(
        "entity_type", "entity_id", "feature_name", F.transform("embedding", lambda x: x * 2).alias("embedding"), "label"
    )
    merged = upsert(vectors, new, ["entity_type", "entity_id", "feature_name"])
    total = F.aggregate("embedding", F.lit(0.0), lambda a, x: a + x.cast("double"))
    return merged.select(
        F.concat_ws(":", "entity_type", "entity_id", "feature_name").alias("doc_id"),
        F.size("embedding").alias("dim"),
        F.round(total, 5).alias("total"),
        "label",
    )


QUERIES = {
    f.__name__: f
    for f in (
        latest_per_entity,
        materialize_snapshot,
        push_backfill_union,
        idempotent_append,
        snapshot_lookup,
        lookup_many_views,
        request_features,
        parity_report,
        delete_entities,
        delete_entities_tombstone,
        backfill_range,
        feature_long_format,
        feature_wide_format,
        user_lifetime,
        user_lifetime_history,
        product_features,
        embedding_upsert,
    )
}

_HIST = f"""{EV}, hist AS (
  SELECT user_id, event_ts AS event_time, {LATE} AS ingestion_time, event_id, event_type, amount FROM ev)"""
_LATEST = f"""WITH {_HIST}
SELECT * FROM hist QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_time DESC, ingestion_time DESC) = 1"""
_BOUGHT = """SELECT DISTINCT user_id FROM hist WHERE event_type = 'purchase' AND amount > 250"""
_DAILY = """SELECT user_id, date_trunc('day', event_ts) AS event_time, count(*) AS n_events,
       round(sum(amount), 4) AS total FROM ev"""

ORACLE = {
    "latest_per_entity": _LATEST,
    "materialize_snapshot": _LATEST,
    "push_backfill_union": f"""WITH {_HIST},
b AS (
  SELECT user_id, event_time, ingestion_time + INTERVAL 1 DAY AS ingestion_time, event_id, event_type, amount * 2 AS amount
  FROM hist WHERE event_time >= TIMESTAMP '2024-01-15'
  UNION ALL SELECT * FROM hist WHERE event_time < TIMESTAMP '2024-01-20')
SELECT * FROM b QUALIFY row_number() OVER (PARTITION BY user_id, event_time ORDER BY ingestion_time DESC) = 1""",
    "idempotent_append": f"WITH {_HIST} SELECT * FROM hist WHERE event_time >= TIMESTAMP '2024-01-20'",
    "snapshot_lookup": f"""WITH {EV},
s AS (SELECT * FROM ev WHERE event_type = 'purchase'
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_ts DESC, event_id DESC) = 1)
SELECT ev.event_id, ev.user_id, s.amount AS orders__amount, s.product_id AS orders__product_id,
       coalesce(s.event_ts < TIMESTAMP '2024-01-31' - INTERVAL 1 DAY, false) AS is_stale
FROM ev LEFT JOIN s ON s.user_id = ev.user_id""",
    "lookup_many_views": f"""WITH {EV},
a AS (SELECT * FROM ev WHERE event_type IN ('view', 'click') AND event_ts < '2024-01-25'
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_ts DESC, event_id DESC) = 1),
b AS (SELECT * FROM ev WHERE event_type IN ('error', 'signup')
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_ts DESC, event_id DESC) = 1),
c AS (SELECT * FROM ev WHERE event_type = 'purchase' AND amount > 100 AND product_id IS NOT NULL
      QUALIFY row_number() OVER (PARTITION BY product_id ORDER BY event_ts DESC, event_id DESC) = 1),
r AS (SELECT event_id, user_id AS asked_user, CASE WHEN amount > 10 THEN product_id END AS product_id, event_ts,
             event_type AS device_type, CAST(amount / 10 AS FLOAT) AS client_latency_ms, CAST(hour(event_ts) AS INTEGER) AS hour_of_day FROM ev)
SELECT r.*, a.amount AS interest__amount, a.product_id AS interest__product_id, b.event_type AS trouble__event_type,
       c.amount AS product__amount, c.user_id AS product__user_id,
       coalesce(a.event_ts < TIMESTAMP '2024-01-31' - INTERVAL 6 HOURS, false) AS interest__is_stale,
       coalesce(b.event_ts < TIMESTAMP '2024-01-31' - INTERVAL 24 HOURS, false) AS trouble__is_stale,
       coalesce(c.event_ts < TIMESTAMP '2024-01-31' - INTERVAL 12 HOURS, false) AS product__is_stale
FROM r LEFT JOIN a ON a.user_id = r.asked_user LEFT JOIN b ON b.user_id = r.asked_user LEFT JOIN c ON c.product_id = r.product_id""",
    "request_features": """
SELECT event_id, user_id, ts AS event_ts, event_type AS device_type, CAST(hour(ts) AS INTEGER) AS hour_of_day FROM events""",
    "parity_report": """
WITH a AS (SELECT user_id, ts AS event_time, value AS amount, event_id FROM events),
b AS (SELECT user_id, ts AS event_time, CASE WHEN event_type <> 'click' THEN value END AS amount, event_id
      FROM events WHERE event_type <> 'error'),
j AS (SELECT coalesce(a.user_id, b.user_id) AS user_id, coalesce(a.event_time, b.event_time) AS event_time,
             a.amount AS aa, b.amount AS ba, a.event_id AS ae, b.event_id AS be,
             CASE WHEN b.user_id IS NULL THEN 'missing_online' WHEN a.user_id IS NULL THEN 'missing_offline'
                  ELSE 'value_mismatch' END AS problem
      FROM a FULL JOIN b ON a.user_id = b.user_id AND a.event_time = b.event_time),
c AS (SELECT user_id, event_time, 'amount' AS feature, CAST(aa AS DOUBLE) AS x, CAST(ba AS DOUBLE) AS y, problem FROM j
      UNION ALL SELECT user_id, event_time, 'event_id', CAST(ae AS DOUBLE), CAST(be AS DOUBLE), problem FROM j)
SELECT user_id, event_time, feature, round(x, 4) AS offline_value, round(y, 4) AS online_value, problem
FROM c WHERE problem <> 'value_mismatch' OR x IS DISTINCT FROM y""",
    "delete_entities": f"""WITH {_HIST}
SELECT * FROM hist WHERE user_id NOT IN ({_BOUGHT})""",
    "delete_entities_tombstone": f"""WITH {_HIST}, gone AS ({_BOUGHT}),
n AS (SELECT * FROM hist
      QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_time DESC, ingestion_time DESC) = 1)
SELECT n.user_id, CASE WHEN g.user_id IS NULL THEN event_time ELSE TIMESTAMP '2024-02-01' END AS event_time,
       CASE WHEN g.user_id IS NULL THEN ingestion_time ELSE TIMESTAMP '2024-02-01' END AS ingestion_time,
       CASE WHEN g.user_id IS NULL THEN event_id END AS event_id,
       CASE WHEN g.user_id IS NULL THEN event_type END AS event_type,
       CASE WHEN g.user_id IS NULL THEN amount END AS amount
FROM n LEFT JOIN gone g ON g.user_id = n.user_id""",
    "backfill_range": f"""WITH {EV}
{_DAILY} WHERE event_type <> 'click' AND (event_ts < TIMESTAMP '2024-01-08' OR event_ts >= TIMESTAMP '2024-01-15') GROUP BY 1, 2
UNION ALL
{_DAILY} WHERE event_ts >= TIMESTAMP '2024-01-08' AND event_ts < TIMESTAMP '2024-01-15' GROUP BY 1, 2""",
    "feature_long_format": """
SELECT user_id AS entity_id, ts AS event_time, c.position, c.feature_name, c.value_as_string
FROM events, unnest([
  {'position': 0, 'feature_name': 'entity_id', 'value_as_string': CAST(user_id AS VARCHAR)},
  {'position': 1, 'feature_name': 'event_time', 'value_as_string': strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') || '+00:00'},
  {'position': 2, 'feature_name': 'event_id', 'value_as_string': CAST(event_id AS VARCHAR)},
  {'position': 3, 'feature_name': 'kind', 'value_as_string': CASE WHEN event_type <> 'error' THEN event_type ELSE '' END}
]) AS t(c)""",
    "feature_wide_format": """
SELECT user_id, date_trunc('day', ts) AS event_time, date_trunc('day', ts) + INTERVAL 1 DAY AS ingestion_time,
       round(sum(value) FILTER (event_type = 'view'), 4) AS view,
       round(sum(value) FILTER (event_type = 'click'), 4) AS click,
       round(sum(value) FILTER (event_type = 'purchase'), 4) AS purchase
FROM events GROUP BY user_id, date_trunc('day', ts)""",
    "user_lifetime": """
WITH o AS (SELECT * FROM orders WHERE o_orderdate <= TIMESTAMP '2000-01-01'),
m AS (SELECT o_custkey, min(o_orderdate) AS f, count(*) AS n, sum(o_totalprice) AS s FROM o GROUP BY 1),
p AS (SELECT o_custkey, count(DISTINCT l_partkey) AS d FROM lineitem JOIN o ON o_orderkey = l_orderkey GROUP BY 1)
SELECT m.o_custkey, CAST(date_diff('day', CAST(f AS DATE), DATE '2000-01-01') AS INTEGER) AS account_age_days,
       CAST(n AS INTEGER) AS total_orders, round(s, 2) AS total_spend, round(s / n, 6) AS avg_order_value,
       CAST(coalesce(d, 0) AS INTEGER) AS distinct_products_purchased
FROM m LEFT JOIN p ON p.o_custkey = m.o_custkey""",
    "user_lifetime_history": """
WITH first AS (
  SELECT o_custkey, l_partkey, min((o_orderdate, o_orderkey)) AS o FROM lineitem JOIN orders ON o_orderkey = l_orderkey
  GROUP BY ALL),
news AS (SELECT struct_extract_at(o, 2) AS o_orderkey, count(*) AS n FROM first GROUP BY 1)
SELECT o_custkey, o_orderkey, o_orderdate AS event_time,
       CAST(date_diff('day', CAST(min(o_orderdate) OVER u AS DATE), CAST(o_orderdate AS DATE)) AS INTEGER) AS account_age_days,
       CAST(count(*) OVER u AS INTEGER) AS total_orders, round(sum(o_totalprice) OVER u, 2) AS total_spend,
       round(sum(o_totalprice) OVER u / count(*) OVER u, 6) AS avg_order_value,
       CAST(sum(coalesce(n, 0)) OVER u AS INTEGER) AS distinct_products_purchased
FROM orders LEFT JOIN news USING (o_orderkey)
WINDOW u AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING)""",
    "product_features": """
WITH k AS (
  SELECT l_partkey, o_custkey, l_shipdate, l_quantity / 10 AS rating FROM lineitem JOIN orders ON o_orderkey = l_orderkey
  WHERE l_shipdate <= TIMESTAMP '2000-01-01'),
c AS (
  SELECT l_partkey, count(*) FILTER (l_shipdate > TIMESTAMP '2000-01-01' - INTERVAL 7 DAYS) AS d7,
         count(*) FILTER (l_shipdate > TIMESTAMP '2000-01-01' - INTERVAL 30 DAYS) AS d30,
         count(DISTINCT o_custkey) FILTER (l_shipdate > TIMESTAMP '2000-01-01' - INTERVAL 30 DAYS) AS b,
         avg(rating) AS r FROM k GROUP BY 1)
SELECT p_partkey AS product_id, CAST(coalesce(d7, 0) AS INTEGER) AS total_purchases_7d,
       CAST(coalesce(d30, 0) AS INTEGER) AS total_purchases_30d, CAST(coalesce(b, 0) AS INTEGER) AS unique_buyers_30d,
       round(r, 6) AS avg_rating, p_retailprice AS price_usd
FROM part LEFT JOIN c ON l_partkey = p_partkey""",
    "embedding_upsert": """
WITH v AS (
  SELECT 'item:' || vec_id || ':embedding_v1' AS doc_id, CAST(len(embedding) AS INTEGER) AS dim, label,
         list_sum(list_transform(embedding, lambda x: CAST(x AS DOUBLE))) * CASE WHEN label = 0 THEN 2 ELSE 1 END AS total
  FROM embeddings)
SELECT doc_id, dim, round(total, 5) AS total, label FROM v""",
}
