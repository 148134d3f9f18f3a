"""Tumbling and sliding window features per entity; the same functions serve batch and streams.

Sliding windows are computed from *panes*: events are aggregated once per (entity, slide) and
only those partial results are copied into the windows that cover them.  A 1-hour window sliding
by 5 minutes so multiplies panes by twelve, not events.  Both steps combine map-side, so a hot
entity arrives as a few partial rows per task.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timecols import as_timestamp, duration_micros, micros


@dataclass(frozen=True)
class Agg:
    """A window aggregate that can be computed from panes.

    ``fn`` is one of count, sum, avg, min, max, approx_distinct; ``col`` None means rows (count).
    ``where`` restricts the rows that take part.
    """

    fn: str
    col: str | None = None
    where: Column | None = None

    def _input(self) -> Column:
        value = F.lit(1) if self.col is None else F.col(self.col)
        return value if self.where is None else F.when(self.where, value)

    def direct(self) -> Column:
        v = self._input()
        plain = {"count": F.count, "sum": F.sum, "avg": F.avg, "min": F.min, "max": F.max}
        if self.fn in plain:
            return plain[self.fn](v)
        if self.fn == "approx_distinct":
            return F.approx_count_distinct(v)
        raise ValueError(f"unknown window aggregate {self.fn!r}")

    def pane(self, name: str) -> list[Column]:
        v = self._input()
        if self.fn == "avg":
            return [F.sum(v).alias(f"{name}__s"), F.count(v).alias(f"{name}__n")]
        if self.fn == "approx_distinct":
            return [F.hll_sketch_agg(v, F.lit(12)).alias(f"{name}__p")]
        return [self.direct().alias(f"{name}__p")]

    def merge(self, name: str) -> Column:
        if self.fn == "avg":
            n = F.sum(f"{name}__n")
            return F.when(n > 0, F.sum(f"{name}__s") / n)
        p = f"{name}__p"
        if self.fn == "approx_distinct":
            return F.hll_sketch_estimate(F.hll_union_agg(p))
        return {"count": F.sum, "sum": F.sum, "min": F.min, "max": F.max}[self.fn](p)


def rolling_agg(
    df: DataFrame,
    entity: str | list[str],
    ts: str,
    window: str,
    slide: str | None,
    aggs: dict[str, Agg],
) -> DataFrame:
    """``entity, <outputs>, window_start, window_end``; tumbling unless ``slide`` is given."""
    keys = [entity] if isinstance(entity, str) else list(entity)
    w_len = duration_micros(window)
    s_len = duration_micros(slide) if slide else w_len
    panes_fit = s_len < w_len and w_len % s_len == 0 and not df.isStreaming
    df = df.withColumn("__ts", as_timestamp(df, ts))
    if not panes_fit:
        spec = F.window("__ts", window, slide) if slide else F.window("__ts", window)
        return (
            df.withColumn("__w", spec)
            .groupBy(*keys, "__w")
            .agg(*[a.direct().alias(n) for n, a in aggs.items()])
            .select(*keys, *aggs, F.col("__w.start").alias("window_start"), F.col("__w.end").alias("window_end"))
        )
    panes = (
        df.where(F.col("__ts").isNotNull())
        .withColumn("__pane", micros("__ts") - F.pmod(micros("__ts"), F.lit(s_len)))
        .groupBy(*keys, "__pane")
        .agg(*[c for n, a in aggs.items() for c in a.pane(n)])
    )
    steps = F.sequence(F.lit(0), F.lit(w_len // s_len - 1))
    return (
        panes.withColumn("__back", F.explode(steps))
        .withColumn("__start", F.col("__pane") - F.col("__back") * F.lit(s_len).cast("long"))
        .groupBy(*keys, "__start")
        .agg(*[a.merge(n).alias(n) for n, a in aggs.items()])
        .select(
            *keys,
            *aggs,
            F.timestamp_micros("__start").alias("window_start"),
            F.timestamp_micros(F.col("__start") + F.lit(w_len)).alias("window_end"),
        )
    )


def rolling_count(df, entity, ts, window="1 hour", slide=None, out="rolling_count") -> DataFrame:
    """Events per entity and window."""
    return rolling_agg(df, entity, ts, window, slide, {out: Agg("count")})


def rolling_sum(df, entity, ts, value_col, window="1 hour", slide=None, out=None) -> DataFrame:
    """Sum of ``value_col`` per entity and window; null when all values are."""
    return rolling_agg(df, entity, ts, window, slide, {out or f"rolling_sum_{value_col}": Agg("sum", value_col)})


def rolling_avg(df, entity, ts, value_col, window="1 hour", slide=None, out=None) -> DataFrame:
    """Mean of ``value_col`` per entity and window."""
    return rolling_agg(df, entity, ts, window, slide, {out or f"rolling_avg_{value_col}": Agg("avg", value_col)})


def ratio_feature(
    df, entity, event_type, ts, numerator_type, denominator_type, window="7 days", out="event_ratio"
) -> DataFrame:
    """Events of one type over events of another, 0.0 where there are none of the latter."""
    counted = rolling_agg(
        df,
        entity,
        ts,
        window,
        None,
        {
            "num_cnt": Agg("count", where=F.col(event_type) == numerator_type),
            "denom_cnt": Agg("count", where=F.col(event_type) == denominator_type),
        },
    )
    ratio = F.when(F.col("denom_cnt") > 0, F.col("num_cnt") / F.col("denom_cnt")).otherwise(F.lit(0.0))
    return counted.withColumn(out, ratio)


def distinct_count_rolling(df, entity, ts, distinct_col, window="30 days", out=None, exact=False) -> DataFrame:
    """Distinct values per entity and window: a HyperLogLog++ estimate, or exact on request.

    The exact form aggregates by (entity, window, value) before it counts, so a hot entity is
    spread over its values.
    """
    name = out or f"distinct_{distinct_col}_count"
    if not exact:
        return rolling_agg(df, entity, ts, window, None, {name: Agg("approx_distinct", distinct_col)})
    keys = [entity] if isinstance(entity, str) else list(entity)
    return (
        df.withColumn("__w", F.window(as_timestamp(df, ts), window))
        .groupBy(*keys, "__w")
        .agg(F.count_distinct(distinct_col).alias(name))
        .select(*keys, name, F.col("__w.start").alias("window_start"), F.col("__w.end").alias("window_end"))
    )


def user_recency_sliding(
    events: DataFrame,
    entity: str = "user_id",
    ts: str = "event_ts",
    event_type: str = "event_type",
    product: str = "product_id",
    amount: str = "amount",
    window: str = "1 hour",
    slide: str = "5 minutes",
    exact_distinct: bool = False,
    ingested: Column | None = None,
) -> DataFrame:
    """The recency table: per entity and sliding window, as of the window's end.

    ``events_last_5min`` counts the last slide of the window and ``seconds_since_last_event`` runs
    from the newest event to the window's end, so a rerun gives the same rows.  ``ingestion_time`` is ``ingested``, for instance
    the clock; by default the window's end, before which the row cannot be known.

    Batch and stream have one definition: panes of one slide with a mergeable sketch of the products, copied into the windows
    that cover them.  On a stream, set a watermark first: panes are a first aggregation, windows a second one on top of it, and a window is
    appended once it closes.  ``exact_distinct`` counts the products themselves, on batches only.
    """
    w_len, s_len = duration_micros(window), duration_micros(slide)
    if exact_distinct and events.isStreaming:
        raise ValueError("a stream counts distinct products by a sketch: exact_distinct is for batches")
    is_order = F.col(event_type) == "purchase"
    rows = events.select(
        entity,
        F.col(product).alias("__product"),
        F.col(ts).alias("__ts"),
        micros(ts).alias("__t"),
        F.when(is_order, F.col(amount)).alias("__amount"),
    ).where("__t IS NOT NULL")
    sketch = F.hll_sketch_agg("__product", F.lit(12)).alias("products")
    if events.isStreaming:
        panes = rows.groupBy(entity, F.window("__ts", slide).alias("__pane")).agg(*_recency_parts(), sketch)
        windows = panes.withColumn("__window", F.window(F.window_time("__pane"), window, slide))
        end, in_last = F.col("__window.end"), F.col("__pane.end") == F.col("__window.end")
        group = "__window"
    else:
        rows = rows.withColumn("__pane", F.col("__t") - F.pmod("__t", F.lit(s_len)))
        if exact_distinct:
            # One row per (entity, pane, product) carries the additive parts; products stay apart.
            panes = rows.groupBy(entity, "__pane", "__product").agg(*_recency_parts())
        else:
            panes = rows.groupBy(entity, "__pane").agg(*_recency_parts(), sketch)
        windows = panes.withColumn("__back", F.explode(F.sequence(F.lit(0), F.lit(w_len // s_len - 1)))).withColumn(
            "__end", F.col("__pane") + F.lit(w_len) - F.col("__back") * F.lit(s_len).cast("long")
        )
        end, in_last = F.timestamp_micros("__end"), F.col("__pane") == F.col("__end") - F.lit(s_len)
        group = "__end"
    parts = [
        F.sum("n").alias("n"),
        F.sum(F.when(in_last, F.col("n")).otherwise(0)).alias("n_last"),
        F.sum("orders").alias("orders"),
        F.sum("spend").alias("spend"),
        F.max("last_us").alias("last_us"),
    ]
    if exact_distinct:
        by_product = windows.groupBy(entity, group, "__product").agg(*parts)
        agged = by_product.groupBy(entity, group).agg(
            *[F.sum(c).alias(c) for c in ("n", "n_last", "orders", "spend")],
            F.max("last_us").alias("last_us"),
            F.count("__product").alias("distinct_products"),
        )
    else:
        agged = windows.groupBy(entity, group).agg(
            *parts, F.hll_sketch_estimate(F.hll_union_agg("products")).alias("distinct_products")
        )
    agged = agged.withColumn("event_time", end)
    seconds = F.unix_seconds("event_time") - F.expr("last_us div 1000000")
    mean = F.when(F.col("orders") > 0, F.col("spend") / F.col("orders"))
    return agged.select(
        entity,
        "event_time",
        (F.col("event_time") if ingested is None else ingested.cast("timestamp")).alias("ingestion_time"),
        F.col("n_last").cast("int").alias("events_last_5min"),
        F.col("n").cast("int").alias("events_last_1h"),
        F.col("distinct_products").cast("int").alias("distinct_products_last_1h"),
        F.coalesce(mean, F.lit(0.0)).alias("avg_order_value_last_1h"),
        seconds.cast("int").alias("seconds_since_last_event"),
    )


def _recency_parts() -> list[Column]:
    return [
        F.count(F.lit(1)).alias("n"),
        F.count("__amount").alias("orders"),
        F.sum("__amount").alias("spend"),
        F.max("__t").alias("last_us"),
    ]


def salted_rolling_agg(
    df: DataFrame,
    entity: str,
    ts: str,
    window: str,
    aggs: dict[str, Agg],
    salts: int = 8,
    salt_by: str | None = None,
) -> DataFrame:
    """Two-phase form of ``rolling_agg``: entities are sharded, shards are merged at read.

    Spark's map-side combining already shrinks a hot entity to one row per task; this form also
    splits the merge itself, which pays off for wide sketches.  ``salt_by`` is the column the
    shard is hashed from (default: the time).  On batches a window is known by its start alone, in microseconds: where nearly every
    event has a window of its own, the keys are what is hashed, sorted and shuffled, twice.
    """
    rows = df.where(F.col(ts).isNotNull()).withColumn("__salt", F.pmod(F.xxhash64(salt_by or ts), F.lit(salts)))
    if df.isStreaming:
        keyed = rows.withColumn("__w", F.window(as_timestamp(df, ts), window))
        start, end = F.col("__w.start"), F.col("__w.end")
    else:
        w_len, t = duration_micros(window), micros(as_timestamp(df, ts))
        keyed = rows.withColumn("__w", t - F.pmod(t, F.lit(w_len)))
        start, end = F.timestamp_micros("__w"), F.timestamp_micros(F.col("__w") + F.lit(w_len))
    shards = keyed.groupBy(entity, "__w", "__salt").agg(*[c for n, a in aggs.items() for c in a.pane(n)])
    merged = shards.groupBy(entity, "__w").agg(*[a.merge(n).alias(n) for n, a in aggs.items()])
    return merged.select(entity, *aggs, start.alias("window_start"), end.alias("window_end"))
