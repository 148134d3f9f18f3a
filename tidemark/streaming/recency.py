"""Raw events to recency features, on streams and on batches alike."""

from __future__ import annotations

from collections.abc import Iterator

import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming.state import GroupState, GroupStateTimeout

from tidemark.functions.timecols import duration_micros
from tidemark.operators.quality import apply_expectations, event_rules
from tidemark.operators.windows import user_recency_sliding
from tidemark.sources.readers import decode_events, valid_events


def bronze(raw: DataFrame, base64: bool = True) -> DataFrame:
    """Decoded events beside their arrival time; undecodable rows are marked, not lost."""
    return decode_events(raw, base64=base64)


def silver(decoded: DataFrame, valid_types: tuple[str, ...] | None = None) -> tuple[DataFrame, DataFrame]:
    """(clean events, quarantined rows)."""
    flat = decoded.select("event.*", *[c for c in decoded.columns if c not in ("event", "is_valid")])
    rules = event_rules(valid_types=valid_types) if valid_types else event_rules()
    return apply_expectations(flat, rules)


def gold(events: DataFrame, watermark: str = "10 minutes", exact_distinct: bool = False) -> DataFrame:
    """Sliding recency features; on a stream, events later than the watermark are dropped."""
    if events.isStreaming:
        events = events.withWatermark("event_ts", watermark)
    return user_recency_sliding(events, exact_distinct=exact_distinct)


def recency_from_raw(raw: DataFrame, base64: bool = True, exact_distinct: bool = False) -> DataFrame:
    """The three steps in one plan."""
    clean, _ = silver(bronze(raw, base64))
    return gold(clean, exact_distinct=exact_distinct)


def deduplicated(events: DataFrame, event_id: str, ts: str, watermark: str = "10 minutes") -> DataFrame:
    """Drop re-delivered events; on a stream the memory of ids is bounded by the watermark."""
    if events.isStreaming:
        return events.withWatermark(ts, watermark).dropDuplicatesWithinWatermark([event_id])
    return events.dropDuplicates([event_id])


COUNTER_SCHEMA = (
    "user_id string, event_time timestamp, events_last_5min long, events_last_1h long, "
    "distinct_products_last_1h long, orders_last_1h long, order_value_last_1h double, "
    "avg_order_value_last_1h double, seconds_since_last_event long"
)
#: Of the users of a bucket, in one order.
STATE_SCHEMA = (
    "users array<string>, last_us array<long>, n_short array<long>, n_long array<long>, products array<array<string>>, "
    "orders array<long>, value array<double>"
)
BUCKETS = 4096
_PANES = "user_id string, pane long, product_id string, first long, last long, before long, n long, orders long, value double, event_ts timestamp"


def _pane_batches(width: int):
    """Rows of an Arrow batch summed by user, pane and product: a hot user is a few rows a batch, however many events it has."""

    def sums(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for rows in batches:
            t = rows["event_ts"].astype("datetime64[us]").astype("int64")
            amount = rows["amount"].where(rows["event_type"] == "purchase")
            rows = rows.assign(t=t, pane=t // width, amount=amount).sort_values("t")
            # Of a pane's events, whichever their product, the last two times are needed.
            by_pane = rows.groupby(["user_id", "pane"], sort=False)["t"]
            rows["rank"] = by_pane.cumcount(ascending=False)
            second = rows.loc[rows["rank"] == 1].set_index(["user_id", "pane"])["t"]
            out = rows.groupby(["user_id", "pane", "product_id"], dropna=False, sort=False).agg(
                first=("t", "min"), last=("t", "max"), n=("t", "size"), orders=("amount", "count"), value=("amount", "sum")
            )
            out = out.reset_index().join(second.rename("before"), on=["user_id", "pane"])
            out["before"] = out["before"].astype("Int64")
            out["event_ts"] = pd.to_datetime(out["last"], unit="us")
            yield out[[c.split()[0] for c in _PANES.split(", ")]]

    return sums


def _fold(users: dict[str, tuple[dict[int, list], dict[str, int]]], rows: pd.DataFrame) -> None:
    """Add a chunk of sums: per user and pane its first time, last two times, events, orders and value; per user and product its newest pane."""
    for user, pane, product, first, last, before, n, orders, value in zip(
        *(rows[c] for c in ("user_id", "pane", "product_id", "first", "last", "before", "n", "orders", "value")), strict=True
    ):
        panes, newest = users.setdefault(user, ({}, {}))
        at = panes.setdefault(pane, [first, [], 0, 0, 0.0])
        at[0] = min(at[0], first)
        at[1] = sorted([*at[1], last, *([] if pd.isna(before) else [before])], reverse=True)[:2]
        at[2] += int(n)
        at[3] += int(orders)
        at[4] += float(value)
        if isinstance(product, str):
            newest[product] = max(newest.get(product, pane), pane)


def _counted(panes: dict[int, list], newest: dict[str, int], held: tuple | None, short: int, long_: int) -> tuple[tuple, tuple]:
    """A user's state, and record, after the panes of a micro-batch."""
    last, n_short, n_long, products, orders, value = held or (None, 0, 0, [], 0, 0.0)
    since, start, event, before = 0, None, 0, last
    for pane in sorted(panes):
        first, tops, n, bought, spent = panes[pane]
        gap = None if before is None else first - before
        if gap is None or gap > long_:
            n_long, orders, value, start = 0, 0, 0.0, pane
        if gap is None or gap > short:
            n_short = 0
        n_short, n_long, orders, value = n_short + n, n_long + n, orders + bought, value + spent
        event, previous = tops[0], tops[1] if len(tops) > 1 else before
        since = 0 if previous is None else event // 1_000_000 - previous // 1_000_000
        before = event if before is None else max(before, event)
    seen = {p for p, pane in newest.items() if start is None or pane >= start} | (set(products) if start is None else set())
    state = int(before), int(n_short), int(n_long), sorted(seen), int(orders), float(value)
    mean = float(value) / orders if orders else 0.0
    return state, (int(event), int(n_short), int(n_long), len(seen), int(orders), float(value), mean, max(int(since), 0))


def gap_reset_stream(
    events: DataFrame,
    watermark: str = "10 minutes",
    short_gap: str = "5 minutes",
    long_gap: str = "1 hour",
    buckets: int = BUCKETS,
) -> DataFrame:
    """The streaming form of ``gap_reset_counters``: one record per user and micro-batch, of its newest event.

    Input columns: ``user_id, event_type, product_id, amount, event_ts``.  Events are summed by user, pane of one short gap, and product before they are
    shuffled, and the state takes these sums chunk by chunk: memory grows with the time that a batch spans, not with
    its events.  No two events of a pane are further apart than the short gap, so gaps lie between panes only.  A user's state is a
    few numbers and the products since the last long gap; it expires one long gap after the last event, when a new
    event would reset it anyway.

    State is kept by hash bucket of users, as Spark's call into Python for a key costs as much as some hundred users' sums.  ``buckets``
    belongs to a checkpoint; it has no part in the result.
    """
    short, long_ = duration_micros(short_gap), duration_micros(long_gap)
    clean = events.where("user_id IS NOT NULL AND event_ts IS NOT NULL").select(
        F.col("user_id").cast("string").alias("user_id"),
        "event_type",
        F.col("product_id").cast("string").alias("product_id"),
        F.col("amount").cast("double").alias("amount"),
        "event_ts",
    )

    def update(key, chunks: Iterator[pd.DataFrame], state: GroupState) -> Iterator[pd.DataFrame]:
        held = {user: tuple(rest) for user, *rest in zip(*state.get, strict=True)} if state.exists else {}
        folded: dict[str, tuple[dict[int, list], dict[str, int]]] = {}
        if not state.hasTimedOut:
            for chunk in chunks:
                _fold(folded, chunk)
        records = []
        for user, (panes, newest) in folded.items():
            held[user], record = _counted(panes, newest, held.get(user), short, long_)
            records.append((user, *record))
        now = state.getCurrentWatermarkMs()
        expires = {user: (kept[0] + long_) // 1000 + 1 for user, kept in held.items()}
        held = {user: kept for user, kept in held.items() if user in folded or expires[user] >= now}
        if held:
            state.update((list(held), *map(list, zip(*held.values(), strict=True))))
            state.setTimeoutTimestamp(max(min(expires[user] for user in held), now + 1))
        else:
            state.remove()
        if records:
            out = pd.DataFrame(records, columns=[c.split()[0] for c in COUNTER_SCHEMA.split(", ")])
            out["event_time"] = pd.to_datetime(out["event_time"], unit="us")
            yield out

    panes = clean.mapInPandas(_pane_batches(short), _PANES).withWatermark("event_ts", watermark)
    bucketed = panes.withColumn("bucket", F.pmod(F.xxhash64("user_id"), F.lit(buckets)))
    return bucketed.groupBy("bucket").applyInPandasWithState(
        update, COUNTER_SCHEMA, STATE_SCHEMA, "update", GroupStateTimeout.EventTimeTimeout
    )


def valid_stream(raw: DataFrame, base64: bool = True) -> DataFrame:
    """Decoded and valid events of a raw stream; poison records are skipped."""
    return valid_events(decode_events(raw, base64=base64))
