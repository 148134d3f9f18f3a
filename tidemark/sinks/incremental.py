"""State that grows with its input: stored partial results, brought up to date from what was ingested since."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timecols import micros
from tidemark.sinks.tables import VersionedTable, merge_latest

#: Under this name a table's manifest keeps how far it has read its source: microseconds of ingestion time.
WATERMARK = "ingested"


def fresh_rows(source: DataFrame, table: VersionedTable, created: str) -> tuple[DataFrame, int | None]:
    """The rows that were ingested after the table's watermark, and the watermark that they bring (nothing if there are none).

    The bounds are plain comparisons with the ingestion time, so files and row groups of older rows are not read.
    """
    since = table.manifest().streams.get(WATERMARK)
    rows = source if since is None else source.where(F.col(created) > F.timestamp_micros(F.lit(since)))
    newest = rows.agg(F.max(micros(created))).first()[0]
    if newest is None:
        return rows.limit(0), None
    return rows.where(F.col(created) <= F.timestamp_micros(F.lit(newest))), newest


def materialize(
    history: DataFrame, online: VersionedTable, event_time: str = "event_time", created: str = "ingestion_time"
) -> int | None:
    """Bring the online table of newest rows up to date; its watermark is part of the version that the rows are in, so a run that
    fails or is repeated neither loses nor doubles anything.  Returns the new watermark, or nothing if nothing is new."""
    rows, newest = fresh_rows(history, online, created)
    if newest is not None:
        merge_latest(rows, online, event_time, created, WATERMARK, newest)
    return newest


class LifetimeState:
    """Lifetime features from stored partials: per user and day the orders, their value and the first order's time, and per user
    and product the first time it was bought.

    Partials are sums and minima, so new orders are folded in in any order; a late order goes into its own day.  A fold reads
    the orders and items that were ingested since the last one, and rewrites the buckets of their users.
    """

    def __init__(self, spark, path: str, user: str, product: str, buckets: int = 64) -> None:
        self.user, self.product = user, product
        self.days = VersionedTable(spark, f"{path}/days", [user], buckets)
        self.products = VersionedTable(spark, f"{path}/products", [user], buckets)

    def _days(self, old: DataFrame | None, new: DataFrame) -> DataFrame:
        both = new if old is None else old.unionByName(new)
        sums = [F.min("first_ts").alias("first_ts"), F.sum("orders").alias("orders"), F.sum("spend").alias("spend")]
        return both.groupBy(self.user, "day").agg(*sums)

    def _products(self, old: DataFrame | None, new: DataFrame) -> DataFrame:
        both = new if old is None else old.unionByName(new)
        return both.groupBy(self.user, self.product).agg(F.min("bought").alias("bought"))

    def fold(
        self, orders: DataFrame, items: DataFrame, order_id: str, order_ts: str, amount: str, item_order_id: str, created: str
    ) -> None:
        """Take in the orders that were ingested since the last fold.  Both tables keep a watermark of their own: a fold that was
        interrupted between them is completed by the next."""
        rows, newest = fresh_rows(orders, self.days, created)
        if newest is not None:
            each = rows.select(
                self.user, F.to_date(order_ts).alias("day"), F.col(order_ts).alias("first_ts"),
                F.lit(1).cast("long").alias("orders"), F.col(amount).alias("spend"),
            )
            self.days.merge(self._days(None, each), self._days, WATERMARK, newest)
        rows, newest = fresh_rows(orders, self.products, created)
        if newest is not None:
            known = rows.select(F.col(order_id).alias("__order"), self.user, F.col(order_ts).alias("bought"))
            bought = items.select(F.col(item_order_id).alias("__order"), self.product).join(known, "__order")
            bought = bought.where(F.col(self.product).isNotNull()).select(self.user, self.product, "bought")
            self.products.merge(self._products(None, bought), self._products, WATERMARK, newest)

    def features(self, as_of: Column) -> DataFrame:
        """The columns of ``user_lifetime`` at the end of the day of ``as_of``."""
        until = F.to_date(as_of)
        money = self.days.read().where(F.col("day") <= until).groupBy(self.user).agg(
            F.min("first_ts").alias("first_ts"), F.sum("orders").alias("total_orders"), F.sum("spend").alias("total_spend")
        )
        bought = self.products.read().where(F.to_date("bought") <= until).groupBy(self.user).agg(F.count(F.lit(1)).alias("n"))
        return money.join(bought, self.user, "left").select(
            self.user,
            F.date_diff(until, F.to_date("first_ts")).alias("account_age_days"),
            F.col("total_orders").cast("int").alias("total_orders"),
            "total_spend",
            (F.col("total_spend") / F.col("total_orders")).alias("avg_order_value"),
            F.coalesce("n", F.lit(0)).cast("int").alias("distinct_products_purchased"),
        )
