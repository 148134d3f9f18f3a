"""Point-in-time join and training set queries."""

from __future__ import annotations

from pyspark.sql import functions as F

from tidemark.functions.timecols import micros, naive_timestamps
from tidemark.model import Entity, Feature, FeatureView, ValueType
from tidemark.operators.lifetime import user_lifetime_history
from tidemark.operators.pit import pit_join as join_as_of
from tidemark.operators.pit import pit_join_bucketed as join_as_of_bucketed
from tidemark.operators.pit import training_set as build_training_set
from tidemark.operators.skew import find_hot_keys
from tidemark.plans.inputs import EV, LATE, events, interest, purchases, slice_rows, table, with_lateness

_COLS = {"amount": "feature_amount", "product_id": "feature_product", "event_type": "feature_type"}


def _features(spark, sf):
    return interest(spark, sf).withColumnRenamed("event_ts", "feature_ts")


def pit_join(spark, sf):
    out = join_as_of(
        purchases(spark, sf), _features(spark, sf), ["user_id"], "event_ts", "feature_ts", "6 hours", _COLS, match_ts="feature_ts"
    )
    return naive_timestamps(out)


def pit_join_sliced(spark, sf):
    """As ``pit_join``, with every busy user cut into slices of a few rows."""
    sides = purchases(spark, sf), _features(spark, sf)
    keys = (["user_id"], "event_ts", "feature_ts", "6 hours", _COLS)
    return naive_timestamps(join_as_of(*sides, *keys, match_ts="feature_ts", rows_per_slice=slice_rows(events(spark, sf))))


def pit_join_bucketed(spark, sf):
    out = join_as_of_bucketed(
        purchases(spark, sf), _features(spark, sf), ["user_id"], "event_ts", "feature_ts", "6 hours", _COLS, match_ts="feature_ts"
    )
    return naive_timestamps(out)


def pit_join_inner(spark, sf):
    out = join_as_of(
        purchases(spark, sf),
        _features(spark, sf),
        ["user_id"],
        "event_ts",
        "feature_ts",
        "6 hours",
        _COLS,
        how="inner",
        match_ts="feature_ts",
    )
    return naive_timestamps(out)


def pit_join_ties(spark, sf):
    """Feature times cut to the hour, so that many rows share one; the newest made wins."""
    feats = _features(spark, sf).withColumns(
        {"made": F.col("feature_ts"), "feature_ts": F.date_trunc("hour", "feature_ts")}
    )
    out = join_as_of(
        purchases(spark, sf), feats, ["user_id"], "event_ts", "feature_ts", "6 hours", _COLS, created="made", match_ts="feature_ts"
    )
    return naive_timestamps(out)


def pit_join_bitemporal(spark, sf):
    feats = with_lateness(interest(spark, sf)).withColumnRenamed("event_ts", "feature_ts")
    out = join_as_of(
        purchases(spark, sf),
        feats,
        ["user_id"],
        "event_ts",
        "feature_ts",
        "12 hours",
        _COLS,
        created="ingestion_time",
        visible_by="ingestion_time",
        match_ts="feature_ts",
    )
    return naive_timestamps(out)


def pit_join_tombstone(spark, sf):
    """Click rows carry nulls and hide what came before them."""
    feats = _features(spark, sf).withColumn("amount", F.when(F.col("event_type") == "view", F.col("amount")))
    out = join_as_of(
        purchases(spark, sf),
        feats,
        ["user_id"],
        "event_ts",
        "feature_ts",
        "6 hours",
        {"amount": "feature_amount"},
        match_ts="feature_ts",
    )
    return naive_timestamps(out)


_USER = Entity("user", ("user_id",), ValueType.INT64)
INTEREST_VIEW = FeatureView(
    "interest",
    (_USER,),
    (Feature("amount", ValueType.DOUBLE), Feature("product_id", ValueType.STRING)),
    ttl_seconds=6 * 3600,
)
TROUBLE_VIEW = FeatureView(
    "trouble",
    (_USER,),
    (Feature("amount", ValueType.DOUBLE), Feature("event_type", ValueType.STRING)),
    ttl_seconds=24 * 3600,
)


def training_inputs(spark, sf):
    """Labels (was the purchase large?) and two views of the same user with different TTLs."""
    ev = events(spark, sf)
    labels = ev.where("event_type = 'purchase'").select(
        "event_id", "user_id", F.col("event_ts").alias("label_ts"), (F.col("amount") >= 50).cast("int").alias("label")
    )
    history = ev.withColumnRenamed("event_ts", "event_time")
    return labels, [
        (INTEREST_VIEW, history.where("event_type IN ('view', 'click')")),
        (TROUBLE_VIEW, history.where("event_type IN ('error', 'signup')")),
    ]


def training_set(spark, sf):
    labels, views = training_inputs(spark, sf)
    select = ["interest:amount", "interest:product_id", "trouble:amount", "trouble:event_type"]
    return build_training_set(labels, views, ["user_id"], "label_ts", select, exclude=("user_id", "label_ts"))


def training_set_sliced(spark, sf):
    """As ``training_set``, with every busy user cut into slices of a few rows."""
    labels, views = training_inputs(spark, sf)
    select = ["interest:amount", "interest:product_id", "trouble:amount", "trouble:event_type"]
    return build_training_set(
        labels, views, ["user_id"], "label_ts", select, exclude=("user_id", "label_ts"), rows_per_slice=slice_rows(events(spark, sf))
    )


PRODUCT_VIEW = FeatureView(
    "product",
    (Entity("product", ("product_id",), ValueType.STRING),),
    (Feature("amount", ValueType.DOUBLE), Feature("user_id", ValueType.INT64)),
    ttl_seconds=12 * 3600,
)
BUYER_VIEW = FeatureView(
    "buyer",
    (Entity("user_product", ("user_id", "product_id")),),
    (Feature("amount", ValueType.DOUBLE),),
    ttl_seconds=20 * 86400,
)


def two_key_inputs(spark, sf):
    """Purchases, some without a product, and views of the user, the product and both; the label's user has another name."""
    labels, views = training_inputs(spark, sf)
    ev = events(spark, sf)
    product = F.when(F.col("amount") > 20, F.col("product_id")).alias("product_id")
    bought = ev.where("event_type = 'purchase'").select("event_id", F.col("user_id").alias("buyer_id"), product, F.col("event_ts").alias("label_ts"))
    history = ev.withColumnRenamed("event_ts", "event_time")
    seen = history.where("event_type IN ('view', 'error')")
    keys = {"interest": ["buyer_id"], "trouble": ["buyer_id"], "buyer": ["buyer_id", "product_id"]}
    return bought, [*views, (PRODUCT_VIEW, seen), (BUYER_VIEW, history.where("event_type = 'click'"))], keys


def training_set_two_keys(spark, sf):
    """Features of the buyer, of the product and of both together: one pass for each key list."""
    labels, views, keys = two_key_inputs(spark, sf)
    select = ["interest:amount", "trouble:event_type", "product:amount", "product:user_id", "buyer:amount"]
    return build_training_set(labels, views, keys, "label_ts", select, exclude=("label_ts",), created="event_id")


LIFETIME_VIEW = FeatureView(
    "lifetime",
    (Entity("customer", ("customer_id",), ValueType.INT64),),
    (
        Feature("total_orders", ValueType.INT32),
        Feature("total_spend", ValueType.DOUBLE),
        Feature("distinct_products_purchased", ValueType.INT32),
    ),
    ttl_seconds=90 * 86400,
)


def training_set_lifetime(spark, sf):
    """Every shipped item labelled with its customer's lifetime features at the ship date."""
    orders, items = table(spark, sf, "orders"), table(spark, sf, "lineitem")
    history = user_lifetime_history(
        orders, items, "o_custkey", "o_orderkey", "o_orderdate", "o_totalprice", "l_orderkey", "l_partkey"
    ).withColumnRenamed("o_custkey", "customer_id")
    labels = items.join(
        orders.select(F.col("o_orderkey").alias("l_orderkey"), F.col("o_custkey").alias("customer_id")), "l_orderkey"
    ).select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "customer_id",
        "l_shipdate",
        (F.col("l_returnflag") == "R").cast("int").alias("returned"),
    )
    # The history is derived here, so hot customers are looked for in the labels instead.
    keyed = labels.select("customer_id", micros("l_shipdate").alias("t"))
    hot = find_hot_keys(keyed, ["customer_id"], "t")
    out = build_training_set(
        labels, [(LIFETIME_VIEW, history)], ["customer_id"], "l_shipdate", created="o_orderkey", hot=hot
    )
    return naive_timestamps(out.withColumn("lifetime__total_spend", F.round("lifetime__total_spend", 2)))


QUERIES = {
    f.__name__: f
    for f in (
        pit_join,
        pit_join_sliced,
        pit_join_bucketed,
        pit_join_inner,
        pit_join_ties,
        pit_join_bitemporal,
        pit_join_tombstone,
        training_set,
        training_set_sliced,
        training_set_two_keys,
        training_set_lifetime,
    )
}


def _asof(features: str, ttl: str, cols: str, order: str, extra: str = "", keep: str = "true") -> str:
    return f"""WITH {EV},
l AS (SELECT event_id, user_id, event_ts FROM ev WHERE event_type = 'purchase'),
f AS ({features}),
m AS (
  SELECT l.event_id AS label_id, f.*, row_number() OVER (PARTITION BY l.event_id ORDER BY {order}) AS rn
  FROM l JOIN f ON f.user_id = l.user_id AND f.feature_ts <= l.event_ts
                AND f.feature_ts > l.event_ts - INTERVAL {ttl} {extra})
SELECT l.event_id, l.user_id, l.event_ts, {cols}, m.feature_ts
FROM l LEFT JOIN m ON m.label_id = l.event_id AND m.rn = 1 WHERE {keep}"""


_ALL = "m.amount AS feature_amount, m.product_id AS feature_product, m.event_type AS feature_type"
_INTEREST = """SELECT user_id, event_ts AS feature_ts, amount, product_id, event_type
      FROM ev WHERE event_type IN ('view', 'click')"""
_PLAIN = f"""WITH {EV},
l AS (SELECT event_id, user_id, event_ts FROM ev WHERE event_type = 'purchase'),
f AS ({_INTEREST}),
m AS (SELECT l.*, f.feature_ts AS fts, f.amount, f.product_id, f.event_type,
             coalesce(f.feature_ts > l.event_ts - INTERVAL 6 HOURS, false) AS ok
      FROM l ASOF LEFT JOIN f ON l.user_id = f.user_id AND l.event_ts >= f.feature_ts)
SELECT event_id, user_id, event_ts, CASE WHEN ok THEN amount END AS feature_amount,
       CASE WHEN ok THEN product_id END AS feature_product, CASE WHEN ok THEN event_type END AS feature_type,
       CASE WHEN ok THEN fts END AS feature_ts
FROM m"""

ORACLE = {
    "pit_join": _PLAIN,
    "pit_join_bucketed": _PLAIN,
    "pit_join_inner": _asof(_INTEREST, "6 HOURS", _ALL, "f.feature_ts DESC", keep="m.label_id IS NOT NULL"),
    "pit_join_ties": _asof(
        """SELECT user_id, date_trunc('hour', event_ts) AS feature_ts, event_ts AS made, amount, product_id, event_type
      FROM ev WHERE event_type IN ('view', 'click')""",
        "6 HOURS",
        _ALL,
        "f.feature_ts DESC, f.made DESC",
    ),
    "pit_join_bitemporal": _asof(
        f"""SELECT user_id, event_ts AS feature_ts, {LATE} AS seen, amount, product_id, event_type
      FROM ev WHERE event_type IN ('view', 'click')""",
        "12 HOURS",
        _ALL,
        "f.feature_ts DESC, f.seen DESC",
        "AND f.seen <= l.event_ts",
    ),
    "pit_join_tombstone": _asof(
        """SELECT user_id, event_ts AS feature_ts, CASE WHEN event_type = 'view' THEN amount END AS amount
      FROM ev WHERE event_type IN ('view', 'click')""",
        "6 HOURS",
        "m.amount AS feature_amount",
        "f.feature_ts DESC",
    ),
    "training_set": f"""WITH {EV},
l AS (SELECT event_id, user_id, event_ts, CAST(amount >= 50 AS INTEGER) AS label FROM ev WHERE event_type = 'purchase'),
a AS (SELECT l.event_id, f.event_ts > l.event_ts - INTERVAL 6 HOURS AS ok, f.amount, f.product_id
      FROM l ASOF JOIN (SELECT * FROM ev WHERE event_type IN ('view', 'click')) f
      ON l.user_id = f.user_id AND l.event_ts >= f.event_ts),
b AS (SELECT l.event_id, f.event_ts > l.event_ts - INTERVAL 24 HOURS AS ok, f.amount, f.event_type
      FROM l ASOF JOIN (SELECT * FROM ev WHERE event_type IN ('error', 'signup')) f
      ON l.user_id = f.user_id AND l.event_ts >= f.event_ts)
SELECT l.event_id, l.label, a.amount AS interest__amount, a.product_id AS interest__product_id,
       b.amount AS trouble__amount, b.event_type AS trouble__event_type
FROM l LEFT JOIN a ON a.event_id = l.event_id AND a.ok LEFT JOIN b ON b.event_id = l.event_id AND b.ok""",
    "training_set_two_keys": f"""WITH {EV},
l AS (SELECT event_id, user_id AS buyer_id, CASE WHEN amount > 20 THEN product_id END AS product_id, event_ts
      FROM ev WHERE event_type = 'purchase'),
a AS (SELECT l.event_id, f.event_ts > l.event_ts - INTERVAL 6 HOURS AS ok, f.amount
      FROM l ASOF JOIN (SELECT * FROM ev WHERE event_type IN ('view', 'click')) f
      ON l.buyer_id = f.user_id AND l.event_ts >= f.event_ts),
b AS (SELECT l.event_id, f.event_ts > l.event_ts - INTERVAL 24 HOURS AS ok, f.event_type
      FROM l ASOF JOIN (SELECT * FROM ev WHERE event_type IN ('error', 'signup')) f
      ON l.buyer_id = f.user_id AND l.event_ts >= f.event_ts),
c AS (SELECT l.event_id, f.event_ts > l.event_ts - INTERVAL 12 HOURS AS ok, f.amount, f.user_id
      FROM l ASOF JOIN (SELECT * FROM ev WHERE event_type IN ('view', 'error')) f
      ON l.product_id = f.product_id AND l.event_ts >= f.event_ts),
d AS (SELECT l.event_id, f.event_ts > l.event_ts - INTERVAL 20 DAYS AS ok, f.amount
      FROM l ASOF JOIN (SELECT * FROM ev WHERE event_type = 'click') f
      ON l.buyer_id = f.user_id AND l.product_id = f.product_id AND l.event_ts >= f.event_ts)
SELECT l.event_id, l.buyer_id, l.product_id, a.amount AS interest__amount, b.event_type AS trouble__event_type,
       c.amount AS product__amount, c.user_id AS product__user_id, d.amount AS buyer__amount
FROM l LEFT JOIN a ON a.event_id = l.event_id AND a.ok LEFT JOIN b ON b.event_id = l.event_id AND b.ok
LEFT JOIN c ON c.event_id = l.event_id AND c.ok LEFT JOIN d ON d.event_id = l.event_id AND d.ok""",
    "training_set_lifetime": """WITH first AS (
  SELECT o_custkey, l_partkey, min((o_orderdate, o_orderkey)) AS o FROM lineitem JOIN orders ON o_orderkey = l_orderkey
  GROUP BY ALL),
news AS (SELECT struct_extract_at(o, 2) AS o_orderkey, count(*) AS n FROM first GROUP BY 1),
h AS (
  SELECT o_custkey, o_orderkey, o_orderdate, count(*) OVER u AS n_orders, sum(o_totalprice) OVER u AS spend,
         sum(coalesce(n, 0)) OVER u AS products
  FROM orders LEFT JOIN news USING (o_orderkey)
  WINDOW u AS (PARTITION BY o_custkey ORDER BY o_orderdate, o_orderkey ROWS UNBOUNDED PRECEDING)),
d AS (
  SELECT * FROM h QUALIFY row_number() OVER (PARTITION BY o_custkey, o_orderdate ORDER BY o_orderkey DESC) = 1),
l AS (
  SELECT l_orderkey, l_linenumber, l_partkey, o_custkey AS customer_id, l_shipdate,
         CAST(l_returnflag = 'R' AS INTEGER) AS returned
  FROM lineitem JOIN orders ON o_orderkey = l_orderkey),
m AS (
  SELECT l.*, d.n_orders, d.spend, d.products, coalesce(d.o_orderdate > l.l_shipdate - INTERVAL 90 DAYS, false) AS ok
  FROM l ASOF LEFT JOIN d ON d.o_custkey = l.customer_id AND l.l_shipdate >= d.o_orderdate)
SELECT l_orderkey, l_linenumber, l_partkey, customer_id, l_shipdate, returned,
       CASE WHEN ok THEN CAST(n_orders AS INTEGER) END AS lifetime__total_orders,
       CASE WHEN ok THEN round(spend, 2) END AS lifetime__total_spend,
       CASE WHEN ok THEN CAST(products AS INTEGER) END AS lifetime__distinct_products_purchased
FROM m""",
}
ORACLE |= {f"{name}_sliced": ORACLE[name] for name in ("pit_join", "training_set")}
