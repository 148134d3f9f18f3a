"""Lifetime and product features from order tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.timecols import micros
from tidemark.operators.skew import ROWS_PER_SLICE, add_slices, carries, find_hot_keys, task_keys


def user_lifetime(
    orders: DataFrame,
    items: DataFrame,
    as_of: Column,
    user: str,
    order_id: str,
    order_ts: str,
    amount: str,
    item_order_id: str,
    product: str,
) -> DataFrame:
    """Per user, as of a date: account age (days since the first order), orders, spend, mean order
    value and distinct products bought.

    Orders combine map-side per user.  Products are first reduced to (user, product) pairs, so a
    hot user is counted over many tasks.
    """
    known = orders.where(F.col(order_ts) <= as_of)
    money = known.groupBy(user).agg(
        F.min(order_ts).alias("first_ts"), F.count(F.lit(1)).alias("total_orders"), F.sum(amount).alias("total_spend")
    )
    bought = (
        items.select(F.col(item_order_id).alias(order_id), product)
        .join(known.select(order_id, user), order_id)
        .groupBy(user)
        .agg(F.count_distinct(product).alias("distinct_products_purchased"))
    )
    return money.join(bought, user, "left").select(
        user,
        F.date_diff(as_of.cast("date"), F.col("first_ts").cast("date")).alias("account_age_days"),
        F.col("total_orders").cast("int").alias("total_orders"),
        "total_spend",
        (F.col("total_spend") / F.col("total_orders")).alias("avg_order_value"),
        F.coalesce("distinct_products_purchased", F.lit(0)).cast("int").alias("distinct_products_purchased"),
    )


def with_churn_risk(
    lifetime: DataFrame, scores: DataFrame, user: str, as_of: Column, score: str = "prediction_score", ts: str = "event_time"
) -> DataFrame:
    """Lifetime features with ``churn_risk_score`` (float): the user's newest model score by ``as_of``, null where there is none.

    Scores are a view of their own, written by batch scoring; reading them here keeps the model out of the feature's definition.
    """
    known = scores.where(F.col(ts) <= as_of).groupBy(user).agg(F.max_by(F.col(score), F.col(ts)).alias("__score"))
    return lifetime.join(known, user, "left").withColumn("churn_risk_score", F.col("__score").cast("float")).drop("__score")


def user_lifetime_history(
    orders: DataFrame,
    items: DataFrame,
    user: str,
    order_id: str,
    order_ts: str,
    amount: str,
    item_order_id: str,
    product: str,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """The lifetime features right after each order, ordered by time and order id.

    A product counts in the order it first appears in, found by one commutative aggregate per
    (user, product); the rest is a running sum per user, sliced for hot users.
    """
    first = (
        items.select(F.col(item_order_id).alias(order_id), product)
        .where(F.col(product).isNotNull())
        .join(orders.select(order_id, user, F.struct(order_ts, order_id).alias("__o")), order_id)
        .groupBy(user, product)
        .agg(F.min("__o").alias("__o"))
        .groupBy(F.col(f"__o.{order_id}").alias(order_id))
        .agg(F.count(F.lit(1)).alias("__new"))
    )
    rows = orders.join(first, order_id, "left").select(
        user,
        order_id,
        order_ts,
        micros(order_ts).alias("__t"),
        F.lit(1).alias("__n"),
        F.col(amount).alias("__a"),
        F.coalesce("__new", F.lit(0)).alias("__p"),
        F.lit(1).alias("__real"),
    )
    hot = find_hot_keys(orders.select(user, micros(order_ts).alias("__t")), [user], "__t", rows_per_slice)
    rows = add_slices(rows, [user], "__t", hot).withColumn("__first", F.col("__t"))
    if hot is not None:
        sums = ["__n", "__a", "__p"]
        carried = carries(
            rows,
            [user],
            {c: F.sum(c) for c in sums} | {"__first": F.min("__t")},
            {c: F.sum(c) for c in sums} | {"__first": F.min("__first")},
        )
        rows = rows.unionByName(carried.withColumn("__real", F.lit(0)), allowMissingColumns=True)
    w = (
        Window.partitionBy(*task_keys([user], hot))
        .orderBy("__real", "__t", order_id)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    seen = rows.select(
        user,
        order_id,
        order_ts,
        "__real",
        F.min("__first").over(w).alias("__first"),
        F.sum("__n").over(w).alias("total_orders"),
        F.sum("__a").over(w).alias("total_spend"),
        F.sum("__p").over(w).alias("distinct_products_purchased"),
    ).where("__real = 1")
    age = F.date_diff(F.col(order_ts).cast("date"), F.timestamp_micros("__first").cast("date"))
    return seen.select(
        user,
        order_id,
        F.col(order_ts).alias("event_time"),
        age.alias("account_age_days"),
        F.col("total_orders").cast("int").alias("total_orders"),
        "total_spend",
        (F.col("total_spend") / F.col("total_orders")).alias("avg_order_value"),
        F.col("distinct_products_purchased").cast("int").alias("distinct_products_purchased"),
    )


def product_features(
    purchases: DataFrame,
    products: DataFrame,
    as_of: Column,
    product: str,
    buyer: str,
    ts: str,
    rating: Column,
    price: str,
    vectors: DataFrame | None = None,
    vector_col: str = "embedding",
) -> DataFrame:
    """Per product of the catalogue, as of a date: purchases in 7 and 30 days, distinct buyers in
    30 days, mean rating of all purchases so far, price, and optionally its embedding.

    ``purchases`` has one row per purchase with ``product, buyer, ts``.
    """
    known = purchases.where(F.col(ts) <= as_of)
    in_7 = F.col(ts) > as_of - F.expr("INTERVAL 7 DAYS")
    in_30 = F.col(ts) > as_of - F.expr("INTERVAL 30 DAYS")
    counts = known.groupBy(product).agg(
        F.count_if(in_7).cast("int").alias("total_purchases_7d"),
        F.count_if(in_30).cast("int").alias("total_purchases_30d"),
        F.avg(rating).alias("avg_rating"),
    )
    buyers = known.where(in_30).groupBy(product).agg(F.count_distinct(buyer).cast("int").alias("unique_buyers_30d"))
    out = products.select(product, F.col(price).alias("price_usd"))
    out = out.join(counts, product, "left").join(buyers, product, "left")
    if vectors is not None:
        out = out.join(vectors.select(product, F.col(vector_col).alias("embedding")), product, "left")
    zeros = ["total_purchases_7d", "total_purchases_30d", "unique_buyers_30d"]
    filled = [F.coalesce(c, F.lit(0)).alias(c) for c in zeros]
    return out.select(product, *filled, "avg_rating", "price_usd", *(["embedding"] if vectors is not None else []))
