"""Per-event features that look back along an entity's own events.

All three are ordered scans; hot entities are cut into time slices (see ``skew``).
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.timecols import duration_micros, micros
from tidemark.operators.skew import (
    ROWS_PER_SLICE,
    SLICE,
    SLICE_END,
    SLICE_START,
    add_slices,
    carries,
    find_hot_keys,
    task_keys,
)

_T = "__t"
_ROW = "__row"
#: Sums below 1e20 with nine decimals are exact.
_EXACT = "decimal(38,9)"


def _packed(df: DataFrame, entity: str, ts: str, extra: dict[str, Column]) -> DataFrame:
    """Entity, time and helper columns beside the whole row as one struct."""
    return df.select(
        F.col(entity).alias("__k"),
        micros(ts).alias(_T),
        *[c.alias(n) for n, c in extra.items()],
        F.struct("*").alias(_ROW),
    )


def time_since_last_event(
    df: DataFrame,
    entity: str,
    ts: str,
    reference: str,
    out: str = "seconds_since_last_event",
    tiebreak: str | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Every row with ``prev_event_ts`` and whole seconds from it to ``reference``.

    Both times are truncated to seconds before the subtraction.  An entity's first row gets nulls.
    """
    order = F.col(tiebreak) if tiebreak else F.lit(0)
    rows = _packed(df, entity, ts, {"__tie": order})
    hot = find_hot_keys(rows.select("__k", _T), ["__k"], _T, rows_per_slice)
    rows = add_slices(rows, ["__k"], _T, hot).withColumn("__event", F.lit(1))
    if hot is not None:
        carried = carries(rows, ["__k"], {_T: F.max(_T)}, {_T: F.max(_T)}).withColumn("__event", F.lit(0))
        rows = rows.unionByName(carried, allowMissingColumns=True)
    w = Window.partitionBy(*task_keys(["__k"], hot)).orderBy("__event", _T, "__tie")
    prev = rows.select(_ROW, "__event", F.lag(_T).over(w).alias("__prev")).where("__event = 1")
    names = df.columns
    return prev.select(
        *[F.col(f"{_ROW}.{c}").alias(c) for c in names],
        F.timestamp_micros("__prev").alias("prev_event_ts"),
        (
            F.unix_seconds(F.col(f"{_ROW}.{reference}").cast("timestamp"))
            - F.unix_seconds(F.timestamp_micros("__prev"))
        ).alias(out),
    )


@dataclass(frozen=True)
class Trailing:
    """One trailing feature: ``fn`` in count, sum, avg, distinct over the last ``length``."""

    fn: str
    length: str
    col: str | None = None
    where: Column | None = None


def trailing_agg(
    df: DataFrame,
    entity: str,
    ts: str,
    specs: dict[str, Trailing],
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Per event, aggregates over ``[t - length, t]`` of the same entity (both ends included).

    A sliding frame re-reads its whole content for every row, which is quadratic for a busy
    entity.  Here each event adds its contribution at ``t`` and takes it back just after
    ``t + length``; a running sum over these marks gives every frame in one sorted pass.  A value
    counts as distinct until its last occurrence leaves the frame.  Hot entities are cut into
    slices at least as long as the longest frame, and only the events within one frame of a
    slice's end are copied to the next slice.
    """
    longest = max(duration_micros(s.length) for s in specs.values())
    inputs: dict[str, Column] = {}
    for name, s in specs.items():
        value = F.col(s.col) if s.col else F.lit(1)
        if s.where is not None:
            value = F.when(s.where, value)
        if s.fn in ("sum", "avg"):
            value = value.cast("double")
        elif s.fn not in ("count", "distinct"):
            raise ValueError(f"unknown trailing aggregate {s.fn!r}")
        inputs[f"__v_{name}"] = value
    rows = _packed(df.where(F.col(ts).isNotNull()), entity, ts, inputs)
    hot = find_hot_keys(rows.select("__k", _T), ["__k"], _T, rows_per_slice, min_width=longest)
    rows = add_slices(rows, ["__k"], _T, hot)
    if hot is None:
        rows = rows.withColumn("__own", F.lit(True))
    else:
        spills = (F.col(SLICE) >= 0) & (F.col(_T) + F.lit(longest) >= F.col(SLICE_END))
        halo = F.when(spills, F.array(F.lit(True), F.lit(False))).otherwise(F.array(F.lit(True)))
        rows = rows.withColumn("__own", F.explode(halo)).withColumn(
            SLICE, F.when(F.col("__own"), F.col(SLICE)).otherwise(F.col(SLICE) + 1)
        )
    rows = rows.drop(SLICE_START, SLICE_END)
    parts = task_keys(["__k"], hot)

    distinct = [n for n, s in specs.items() if s.fn == "distinct"]
    if distinct:
        # One shuffle by (entity, slice) serves the per-value windows and the final scan alike.
        rows = rows.repartition(*parts)
        for n in distinct:
            same = Window.partitionBy(*parts, f"__v_{n}").orderBy(_T)
            rows = rows.withColumns({f"__p_{n}": F.lag(_T).over(same), f"__n_{n}": F.lead(_T).over(same)})

    marks: list[Column] = []
    sums: dict[str, str] = {}

    def mark(length: int | None) -> Column:
        """The contributions at the event itself (None) or when a frame of ``length`` ends."""
        fields: list[Column] = []
        for n, s in specs.items():
            v = F.col(f"__v_{n}")
            w = duration_micros(s.length)
            mine = length is None or length == w
            sign = 1 if length is None else -1
            present = F.when(v.isNotNull(), sign).otherwise(0)
            if s.fn == "distinct":
                other = F.col(f"__p_{n}") if length is None else F.col(f"__n_{n}")
                apart = other.isNull() | (F.abs(other - F.col(_T)) > w)
                present = F.when(v.isNotNull() & apart, sign).otherwise(0)
            fields.append((present if mine else F.lit(0)).cast("long").alias(f"n_{n}"))
            sums[f"n_{n}"] = "long"
            if s.fn in ("sum", "avg"):
                inf = F.lit(float("inf"))
                up = v.isNotNull() & (F.isnan(v) | (v == inf))
                down = v.isNotNull() & (F.isnan(v) | (v == -inf))
                finite = F.when(v.isNotNull() & ~up & ~down, v * sign).otherwise(0.0)
                # What is added and taken back must cancel: decimals do; the double holds what they cannot.
                exact = F.when(F.abs(finite) < 1e20, finite).otherwise(0.0).cast(_EXACT)
                fields.append((exact if mine else F.lit(0).cast(_EXACT)).alias(f"e_{n}"))
                fields.append((finite - exact.cast("double") if mine else F.lit(0.0)).alias(f"s_{n}"))
                fields.append((F.when(up, sign).otherwise(0) if mine else F.lit(0)).cast("long").alias(f"u_{n}"))
                fields.append((F.when(down, sign).otherwise(0) if mine else F.lit(0)).cast("long").alias(f"d_{n}"))
                sums.update({f"e_{n}": _EXACT, f"s_{n}": "double", f"u_{n}": "long", f"d_{n}": "long"})
        at = F.col(_T) if length is None else F.col(_T) + F.lit(length + 1)
        return F.struct(at.alias("at"), F.lit(length is None).alias("event"), *fields)

    marks.append(mark(None))
    for length in sorted({duration_micros(s.length) for s in specs.values()}):
        marks.append(mark(length))
    exploded = rows.withColumn("__m", F.explode(F.array(*marks)))
    flat = exploded.select(
        *parts,
        F.col("__m.at").alias("__at"),
        (F.col("__m.event") & F.col("__own")).alias("__emit"),
        F.when(F.col("__m.event") & F.col("__own"), F.col(_ROW)).alias(_ROW),
        *[F.col(f"__m.{c}").alias(c) for c in sums],
    )
    frame = Window.partitionBy(*parts).orderBy("__at").rangeBetween(Window.unboundedPreceding, 0)
    scanned = flat.select("__emit", _ROW, *[F.sum(c).over(frame).alias(c) for c in sums]).where("__emit")
    outputs = []
    for n, s in specs.items():
        count = F.col(f"n_{n}")
        if s.fn in ("count", "distinct"):
            outputs.append(count.alias(n))
            continue
        total = (
            F.when((F.col(f"u_{n}") > 0) & (F.col(f"d_{n}") > 0), F.lit(float("nan")))
            .when(F.col(f"u_{n}") > 0, F.lit(float("inf")))
            .when(F.col(f"d_{n}") > 0, F.lit(float("-inf")))
            .otherwise(F.col(f"e_{n}").cast("double") + F.col(f"s_{n}"))
        )
        outputs.append(F.when(count > 0, total if s.fn == "sum" else total / count).alias(n))
    return scanned.select(*[F.col(f"{_ROW}.{c}").alias(c) for c in df.columns], *outputs)


def user_recency_trailing(
    events: DataFrame,
    entity: str = "user_id",
    ts: str = "event_ts",
    event_type: str = "event_type",
    product: str = "product_id",
    amount: str = "amount",
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """The recency features exactly as of each event; 0.0 where there was no purchase."""
    scanned = trailing_agg(
        events,
        entity,
        ts,
        {
            "events_last_5min": Trailing("count", "5 minutes"),
            "events_last_1h": Trailing("count", "1 hour"),
            "distinct_products_last_1h": Trailing("distinct", "1 hour", product),
            "avg_order_value_last_1h": Trailing("avg", "1 hour", amount, F.col(event_type) == "purchase"),
        },
        rows_per_slice,
    )
    return scanned.withColumn("avg_order_value_last_1h", F.coalesce("avg_order_value_last_1h", F.lit(0.0)))


def gap_reset_counters(
    df: DataFrame,
    entity: str,
    ts: str,
    short_gap: str = "5 minutes",
    long_gap: str = "1 hour",
    product: str = "product_id",
    event_type: str = "event_type",
    amount: str = "amount",
    tiebreak: str | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """Counters that restart when an entity pauses for longer than a gap (an equal gap continues).

    Per row: events since the last short gap, and since the last long gap events, distinct
    products, order count, order value and its mean.  Missing purchase amounts are left out of the
    mean.  Rows without entity or time are dropped, as the stream job drops them.
    """
    gaps = {"s": duration_micros(short_gap), "l": duration_micros(long_gap)}
    clean = df.where(F.col(entity).isNotNull() & F.col(ts).isNotNull())
    is_order = (F.col(event_type) == "purchase") & F.col(amount).isNotNull()
    rows = _packed(
        clean,
        entity,
        ts,
        {
            "__tie": F.col(tiebreak).cast("string") if tiebreak else F.lit(""),
            "__p": F.col(product).cast("string"),
            "__amount": F.when(is_order, F.col(amount).cast("double")),
        },
    )
    if tiebreak:
        rows = rows.withColumn("__tie", F.col(f"{_ROW}.{tiebreak}"))
    hot = find_hot_keys(rows.select("__k", _T), ["__k"], _T, rows_per_slice)
    rows = add_slices(rows, ["__k"], _T, hot).drop(SLICE_START, SLICE_END).withColumn("__kind", F.lit(2))
    if hot is not None:
        # kind 0: the entity's last event before the slice; kind 1: the same per product.
        last = carries(rows, ["__k"], {_T: F.max(_T)}, {_T: F.max(_T)}).withColumn("__kind", F.lit(0))
        seen = carries(
            rows.where(F.col("__p").isNotNull()), ["__k", "__p"], {_T: F.max(_T)}, {_T: F.max(_T)}
        ).withColumn("__kind", F.lit(1))
        rows = rows.unionByName(last.where(f"{_T} IS NOT NULL"), allowMissingColumns=True)
        rows = rows.unionByName(seen.where(f"{_T} IS NOT NULL"), allowMissingColumns=True)

    # One shuffle; every window below is partitioned by (entity, slice) or finer.
    parts = task_keys(["__k"], hot)
    rows = rows.repartition(*parts)
    same = Window.partitionBy(*parts, "__p").orderBy("__kind", _T, "__tie")
    rows = rows.withColumn("__seen", F.lag(_T).over(same)).where("__kind <> 1")
    path = Window.partitionBy(*parts).orderBy("__kind", _T, "__tie")
    rows = rows.withColumn("__prev", F.lag(_T).over(path)).where("__kind = 2")
    rows = _with_islands(rows, gaps, parts)
    # A product is new to an island when it was not seen since the island began.
    first = F.col("__p").isNotNull() & (F.col("__seen").isNull() | (F.col("__seen") < F.col("__i_l")))
    counted = {
        "s": {"n_s": F.lit(1)},
        "l": {
            "n_l": F.lit(1),
            "distinct": F.when(first, 1).otherwise(0),
            "orders": F.when(F.col("__amount").isNotNull(), 1).otherwise(0),
            "value": F.coalesce("__amount", F.lit(0.0)),
        },
    }
    for g, cols in counted.items():
        island = Window.partitionBy(*parts, f"__i_{g}").orderBy(_T, "__tie")
        island = island.rowsBetween(Window.unboundedPreceding, Window.currentRow)
        rows = rows.withColumns({f"__x_{n}": c for n, c in cols.items()})
        before = rows
        rows = rows.withColumns({f"__t_{n}": F.sum(f"__x_{n}").over(island) for n in cols})
        if hot is not None:
            rows = _join_slices(rows, _open_islands(before, g, list(cols)))
            carried = F.col("__open") == F.col(f"__i_{g}")
            rows = rows.withColumns(
                {f"__t_{n}": F.col(f"__t_{n}") + F.when(carried, F.col(f"__o_{n}")).otherwise(0) for n in cols}
            ).drop("__open", *[f"__o_{n}" for n in cols])
    mean = F.when(F.col("__t_orders") > 0, F.col("__t_value") / F.col("__t_orders")).otherwise(0.0)
    return rows.select(
        *[F.col(f"{_ROW}.{c}").alias(c) for c in df.columns],
        F.col("__t_n_s").cast("long").alias("events_last_5min"),
        F.col("__t_n_l").cast("long").alias("events_last_1h"),
        F.col("__t_distinct").cast("long").alias("distinct_products_last_1h"),
        F.col("__t_orders").cast("long").alias("orders_last_1h"),
        F.col("__t_value").alias("order_value_last_1h"),
        mean.alias("avg_order_value_last_1h"),
        F.coalesce(F.expr(f"({_T} div 1000000) - (__prev div 1000000)"), F.lit(0)).alias("seconds_since_last_event"),
        F.timestamp_micros("__i_s").alias("session_start"),
    )


def _with_islands(rows: DataFrame, gaps: dict[str, int], parts: list[str]) -> DataFrame:
    """Add ``__i_<gap>``, the time of the row that opened the current island, from ``__prev``."""
    running = (
        Window.partitionBy(*parts).orderBy(_T, "__tie").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    for g, length in gaps.items():
        restarts = F.col("__prev").isNull() | (F.col(_T) - F.col("__prev") > length)
        rows = rows.withColumn(f"__r_{g}", F.when(restarts, F.col(_T)))
    rows = rows.withColumns({f"__i_{g}": F.max(f"__r_{g}").over(running) for g in gaps})
    if SLICE not in parts:
        return rows
    latest = {f"__c_{g}": F.max(f"__r_{g}") for g in gaps}
    opened = carries(rows, ["__k"], latest, {f"__c_{g}": F.max(f"__c_{g}") for g in gaps})
    rows = _join_slices(rows, opened)
    rows = rows.withColumns({f"__i_{g}": F.coalesce(f"__i_{g}", f"__c_{g}") for g in gaps})
    return rows.drop(*[f"__c_{g}" for g in gaps])


def _join_slices(rows: DataFrame, per_slice: DataFrame) -> DataFrame:
    """Attach one row per (entity, slice); ``rows`` is already partitioned that way."""
    return rows.join(per_slice, ["__k", SLICE], "left")


def _open_islands(rows: DataFrame, gap: str, cols: list[str]) -> DataFrame:
    """Per (entity, slice): the island left open by the earlier slices and its totals so far."""
    island = f"__i_{gap}"
    totals = (
        rows.where(F.col(SLICE) >= 0)
        .groupBy("__k", SLICE, island)
        .agg(*[F.sum(f"__x_{n}").alias(f"__o_{n}") for n in cols])
    )
    so_far = (
        Window.partitionBy("__k", island).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    grown = totals.withColumns({f"__o_{n}": F.sum(f"__o_{n}").over(so_far) for n in cols})
    last = grown.groupBy("__k", SLICE).agg(
        F.max(island).alias("__open"), *[F.max_by(f"__o_{n}", island).alias(f"__o_{n}") for n in cols]
    )
    prior = Window.partitionBy("__k").orderBy(SLICE)
    return last.select("__k", SLICE, *[F.lag(c).over(prior).alias(c) for c in ["__open", *[f"__o_{n}" for n in cols]]])


def sessionize(
    df: DataFrame, entity: str, ts: str, gap: str = "5 minutes", rows_per_slice: int = ROWS_PER_SLICE
) -> DataFrame:
    """Sessions closed by a pause longer than ``gap``: start, last event and event count.

    ``session_window`` would merge all events of an entity in one task; here sessions are found by
    the sliced scan of the counters and then counted with map-side combining.
    """
    clean = df.where(F.col(entity).isNotNull() & F.col(ts).isNotNull())
    rows = clean.select(F.col(entity).alias("__k"), micros(ts).alias(_T), F.lit(0).alias("__tie"))
    hot = find_hot_keys(rows, ["__k"], _T, rows_per_slice)
    rows = add_slices(rows, ["__k"], _T, hot).drop(SLICE_START, SLICE_END).withColumn("__kind", F.lit(1))
    if hot is not None:
        last = carries(rows, ["__k"], {_T: F.max(_T)}, {_T: F.max(_T)}).withColumn("__kind", F.lit(0))
        rows = rows.unionByName(last.where(f"{_T} IS NOT NULL"), allowMissingColumns=True)
    parts = task_keys(["__k"], hot)
    path = Window.partitionBy(*parts).orderBy("__kind", _T)
    rows = rows.withColumn("__prev", F.lag(_T).over(path)).where("__kind = 1")
    rows = _with_islands(rows, {"s": duration_micros(gap)}, parts)
    return (
        rows.groupBy(F.col("__k").alias(entity), F.col("__i_s"))
        .agg(F.max(_T).alias("__last"), F.count(F.lit(1)).alias("n_events"))
        .select(
            entity,
            F.timestamp_micros("__i_s").alias("session_start"),
            F.timestamp_micros("__last").alias("session_last"),
            "n_events",
        )
    )
