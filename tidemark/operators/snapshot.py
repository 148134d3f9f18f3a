"""Latest values per entity: online state, lookups, parity, maintenance of history tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.timecols import duration_micros, micros
from tidemark.model import FeatureView
from tidemark.operators.pit import by_key_list, chosen_features


def latest_per_entity(
    df: DataFrame, keys: list[str], event_time: str = "event_time", created: str | None = "ingestion_time"
) -> DataFrame:
    """The newest row of each entity, ties by ``created``.

    Rows combine map-side, so a hot entity crosses the network as one row per task.  Whole rows do not fit a hash aggregate's buffers:
    each task sorts its rows by entity to combine them, and may spill while it does.
    """
    rest = [c for c in df.columns if c not in keys]
    order = [event_time] + ([created] if created else [])
    return (
        df.where(F.col(event_time).isNotNull())
        .groupBy(*keys)
        .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("__r"))
        .select(*keys, *[F.col(f"__r.{c}").alias(c) for c in rest])
        .select(*df.columns)
    )


def push_backfill_union(
    stream_rows: DataFrame,
    batch_rows: DataFrame,
    keys: list[str],
    event_time: str = "event_time",
    created: str = "ingestion_time",
) -> DataFrame:
    """Pushed rows on top of batch history: one row per (entity, event time), newest ingestion."""
    both = stream_rows.unionByName(batch_rows, allowMissingColumns=True)
    return latest_per_entity(both, [*keys, event_time], event_time, created)


def snapshot_lookup(
    requests: DataFrame,
    snapshot: DataFrame,
    view: FeatureView | str,
    keys: list[str],
    select: list[str],
    as_of: Column,
    ttl: str | int,
    event_time: str = "event_time",
    full_names: bool = True,
) -> DataFrame:
    """Requests with the named features of the snapshot, nulls where absent, and ``is_stale``.

    Every request row is kept.  The snapshot has one row per entity, so the join never multiplies;
    hot request keys are split by adaptive execution (skew join), and Spark itself broadcasts a
    side only after measuring it.
    """
    name = view if isinstance(view, str) else view.name
    chosen = snapshot.select(
        *keys,
        F.col(event_time).alias("__et"),
        *[F.col(c).alias(f"{name}__{c}" if full_names else c) for c in select],
    )
    joined = requests.join(chosen, keys, "left")
    stale = F.col("__et").isNotNull() & (micros("__et") < micros(as_of) - F.lit(duration_micros(ttl)))
    return joined.withColumn("is_stale", stale).drop("__et")


def lookup_many(
    requests: DataFrame,
    stores: list[tuple[FeatureView, DataFrame]],
    select: list[str] | None,
    as_of: Column,
    keys: list[str] | dict[str, list[str]] | None = None,
    event_time: str = "event_time",
    full_names: bool = True,
    request_ts: str | None = None,
) -> DataFrame:
    """Requests with the ``view:feature`` names of ``select`` (None: all) from several snapshots, each found by its view's own key.

    ``keys`` names the requests' key columns as in ``training_set``.  All columns of the request stay, with what is computed from the
    request itself (``request_features``) where ``request_ts`` names its time.  Each view that is asked has ``<view>__is_stale``: its row is
    older than the view's TTL.  Absent rows and null keys give null features that are not stale.  Views of one key list
    follow each other, so the requests are dealt out once for each key list; a snapshot has one row per entity, so no
    join multiplies.
    """
    wanted = chosen_features([v for v, _ in stores], select)
    tables = {v.name: df for v, df in stores}
    names = [n if not full_names else f"{view}__{n}" for view, features in wanted.items() for n in features]
    twice = sorted({n for n in names if names.count(n) > 1 or n in requests.columns})
    if twice:
        raise ValueError(f"{twice} would stand for several columns; use full names")
    out = requests if request_ts is None else request_features(requests, request_ts)
    for own, members in by_key_list([v for v, _ in stores if v.name in wanted], keys).items():
        for view in members:
            theirs = list(own) if isinstance(keys, list) else list(view.keys)
            renamed = {n: f"{view.name}__{n}" if full_names else n for n in wanted[view.name]}
            chosen = tables[view.name].select(
                *[F.col(k).alias(f"__k{i}") for i, k in enumerate(theirs)],
                F.col(event_time).alias("__et"),
                *[F.col(c).alias(name) for c, name in renamed.items()],
            )
            same = F.lit(True)
            for i, k in enumerate(own):
                same = same & (out[k] == chosen[f"__k{i}"])
            joined = out.join(chosen, same, "left")
            stale = F.col("__et").isNotNull() & (micros("__et") < micros(as_of) - F.lit(duration_micros(view.ttl_seconds)))
            out = joined.withColumn(f"{view.name}__is_stale", stale).drop("__et", *[f"__k{i}" for i in range(len(theirs))])
    return out


def request_features(requests: DataFrame, ts: str) -> DataFrame:
    """Features computed from the request itself."""
    return requests.withColumn("hour_of_day", F.hour(ts).cast("int"))


PARITY_BUCKETS = 4_096


def differing_buckets(offline: DataFrame, online: DataFrame, keys: list[str], cols: list[str], buckets: int = PARITY_BUCKETS) -> DataFrame:
    """``__bucket``: the key buckets whose rows are not the same on both sides, by their number and two order-independent sums of
    row hashes.  Sums combine map-side: of each side, one row a bucket and task is shuffled."""

    def sums(df: DataFrame) -> DataFrame:
        row = df.select(F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int").alias("__bucket"), F.xxhash64(*keys, *cols).alias("__h"))
        return row.groupBy("__bucket").agg(
            F.count(F.lit(1)).alias("n"), F.bit_xor("__h").alias("x"), F.sum(F.col("__h").cast("decimal(20,0)")).alias("s")
        )

    a, b = sums(offline), sums(online).withColumnsRenamed({"n": "n2", "x": "x2", "s": "s2"})
    same = F.col("n").eqNullSafe(F.col("n2")) & F.col("x").eqNullSafe(F.col("x2")) & F.col("s").eqNullSafe(F.col("s2"))
    return a.join(b, "__bucket", "full_outer").where(~same).select("__bucket")


def parity_report(
    offline: DataFrame, online: DataFrame, keys: list[str], cols: list[str], tol: float = 0.0, buckets: int = PARITY_BUCKETS
) -> DataFrame:
    """``keys, feature, offline_value, online_value, problem``: every cell on which the stores differ.

    Rows missing on one side are reported once per column, two nulls agree, null keys are keys, and numbers may differ
    by ``tol``.  Each side has one row a key.

    Checksums of key buckets come first; only rows of buckets that differ are joined.  Stores that agree are read once
    and nothing of them is shuffled but sums.
    """
    # At most one row a bucket.
    found = differing_buckets(offline, online, keys, cols, buckets).toArrow()
    differing = offline.sparkSession.createDataFrame(found, "__bucket int")

    def tagged(df: DataFrame, side: str) -> DataFrame:
        inside = df.withColumn("__bucket", F.pmod(F.xxhash64(*keys), F.lit(buckets)).cast("int"))
        return inside.join(F.broadcast(differing), "__bucket", "left_semi").select(
            *[F.col(k).alias(f"__{side}k{i}") for i, k in enumerate(keys)],
            F.lit(True).alias(f"__in_{side}"),
            *[F.col(c).alias(f"__{side}_{c}") for c in cols],
        )

    same_key = F.lit(True)
    for i in range(len(keys)):
        same_key = same_key & F.col(f"__ak{i}").eqNullSafe(F.col(f"__bk{i}"))
    joined = tagged(offline, "a").join(tagged(online, "b"), same_key, "full_outer")
    joined = joined.withColumns({k: F.coalesce(f"__ak{i}", f"__bk{i}") for i, k in enumerate(keys)})
    both = F.col("__in_a").isNotNull() & F.col("__in_b").isNotNull()
    cells = []
    for c in cols:
        a, b = F.col(f"__a_{c}"), F.col(f"__b_{c}")
        equal = a.eqNullSafe(b)
        if tol > 0:
            equal = equal | F.coalesce(F.abs(a - b) <= tol, F.lit(False))
        problem = (
            F.when(F.col("__in_b").isNull(), "missing_online")
            .when(F.col("__in_a").isNull(), "missing_offline")
            .otherwise("value_mismatch")
        )
        cells.append(
            F.when(
                ~both | ~equal,
                F.struct(
                    F.lit(c).alias("feature"),
                    a.cast("string").alias("offline_value"),
                    b.cast("string").alias("online_value"),
                    problem.alias("problem"),
                ),
            )
        )
    return joined.select(*keys, F.explode(F.array_compact(F.array(*cells))).alias("__d")).select(*keys, "__d.*")


def new_rows_only(
    batch: DataFrame,
    history: DataFrame,
    keys: list[str],
    event_time: str = "event_time",
    created: str | None = "ingestion_time",
    partition_col: str | None = None,
) -> DataFrame:
    """The rows of ``batch`` whose (entity, event time) the history does not have, once each.

    With a ``partition_col`` (both sides) only the partitions the batch touches are read.
    """
    unique = latest_per_entity(batch, [*keys, event_time], event_time, created)
    known = history
    if partition_col:
        touched = batch.select(partition_col).distinct()
        known = known.join(touched, partition_col, "left_semi")
    return unique.join(known.select(*keys, event_time), [*keys, event_time], "left_anti")


def materialize_snapshot(
    history: DataFrame,
    keys: list[str],
    snapshot: DataFrame | None = None,
    since: Column | None = None,
    event_time: str = "event_time",
    created: str = "ingestion_time",
) -> DataFrame:
    """Latest row per entity; incremental when given the old snapshot and its ingestion watermark."""
    fresh = history if since is None else history.where(F.col(created) > since)
    if snapshot is not None:
        fresh = fresh.unionByName(snapshot)
    return latest_per_entity(fresh, keys, event_time, created)


def delete_entities(
    df: DataFrame,
    ids: DataFrame,
    keys: list[str],
    mode: str = "hard",
    at: Column | None = None,
    features: list[str] | None = None,
) -> DataFrame:
    """Remove entities (``hard``) or append one row of nulls for each (``tombstone``)."""
    gone = ids.select(*keys).distinct()
    if mode == "hard":
        return df.join(gone, keys, "left_anti")
    if mode != "tombstone":
        raise ValueError("mode must be 'hard' or 'tombstone'")
    if at is None or features is None:
        raise ValueError("a tombstone needs its time and the feature columns to hide")
    kept = [c for c in df.columns if c not in features and c not in keys]
    types = {f.name: f.dataType for f in df.schema.fields}
    marks = gone.select(
        *keys,
        *[at.cast(types[c]).alias(c) for c in kept if c in ("event_time", "ingestion_time")],
        *[F.lit(None).cast(types[c]).alias(c) for c in kept if c not in ("event_time", "ingestion_time")],
        *[F.lit(None).cast(types[c]).alias(c) for c in features],
    )
    return df.unionByName(marks)


def recomputed(
    compute: Callable[[DataFrame], DataFrame],
    source: DataFrame,
    start: Column,
    end: Column,
    source_time: str,
    event_time: str = "event_time",
    lookback: str | int = 0,
) -> DataFrame:
    """A view's rows with event times in ``[start, end)``.

    Only source rows that can matter are read: the range itself and ``lookback`` before it.
    """
    first = micros(start) - F.lit(duration_micros(lookback) if lookback else 0)
    needed = source.where((F.col(source_time) >= F.timestamp_micros(first)) & (F.col(source_time) < end))
    return compute(needed).where((F.col(event_time) >= start) & (F.col(event_time) < end))


def backfill_range(
    compute: Callable[[DataFrame], DataFrame],
    source: DataFrame,
    existing: DataFrame,
    start: Column,
    end: Column,
    source_time: str,
    event_time: str = "event_time",
    lookback: str | int = 0,
) -> DataFrame:
    """``existing`` with the view recomputed for event times in ``[start, end)``."""
    fresh = recomputed(compute, source, start, end, source_time, event_time, lookback)
    outside = existing.where((F.col(event_time) < start) | (F.col(event_time) >= end))
    return outside.unionByName(fresh)
