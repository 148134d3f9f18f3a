"""Point-in-time (backward as-of) joins and training sets.

Plan: labels and feature rows are *unioned*, sorted by time inside ``(entity, slice)`` and scanned
once with a running ``max_by``.  There is no join and no pair of rows is ever formed, so the cost
is one shuffle and one sort of labels + features, for any number of views that share the keys.

Every predicate of the join is monotone in the label time ``t``: a feature row becomes a
candidate at ``greatest(event time, visibility time)`` and stays one, and the newest candidate by
``(event time, created)`` is the answer.  If that one is older than the TTL, so are all others;
the TTL is therefore tested once, after the scan.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.timecols import duration_micros, micros
from tidemark.model import FeatureView, TrainingSpec
from tidemark.operators.skew import AUTO, ROWS_PER_SLICE, HotKeys, add_slices, carries, resolve_hot, task_keys

_T = "__t"
_SIDE = "__side"
_LABEL = "__label"


@dataclass
class AsOfSource:
    """One feature table of an as-of join."""

    df: DataFrame
    feature_ts: str
    cols: dict[str, str]
    """feature column -> output column."""
    ttl: str | int | None = None
    created: str | None = None
    """Tie-break between rows of one event time: the newest wins."""
    visible_by: str | None = None
    """Ingestion time; when given, a row counts only for labels at or after it."""
    match_ts: str | None = None
    """Output column for the event time of the matched row."""
    keys: list[str] | None = field(default=None)
    """Key columns in this table, when they are named differently from the labels'."""


def pit_join(
    labels: DataFrame,
    features: DataFrame,
    keys: list[str],
    label_ts: str,
    feature_ts: str,
    ttl: str | int | None,
    cols: list[str] | dict[str, str],
    created: str | None = None,
    strict: bool = False,
    how: str = "left",
    visible_by: str | None = None,
    match_ts: str | None = None,
    rows_per_slice: int = ROWS_PER_SLICE,
) -> DataFrame:
    """For each label the newest feature row with ``label - ttl < feature_ts <= label``.

    ``strict`` makes the upper bound exclusive.  Unmatched labels keep nulls (``how='left'``) or
    are dropped (``'inner'``).  The whole row is carried, so a newest row of nulls (a tombstone)
    hides older values.
    """
    mapping = cols if isinstance(cols, dict) else {c: c for c in cols}
    source = AsOfSource(features, feature_ts, mapping, ttl, created, visible_by, match_ts)
    return multi_pit_join(labels, [source], keys, label_ts, strict, how, rows_per_slice)


def multi_pit_join(
    labels: DataFrame,
    sources: list[AsOfSource],
    keys: list[str],
    label_ts: str,
    strict: bool = False,
    how: str = "left",
    rows_per_slice: int = ROWS_PER_SLICE,
    hot: HotKeys | None | str = AUTO,
) -> DataFrame:
    """As-of join of several feature tables with the same entity in one shuffle.

    Looking for hot keys reads the key and time columns of every side once more.  Pass ``hot`` when
    a feature table is not stored but costly to derive: None, or a list found elsewhere.
    """
    if how not in ("left", "inner"):
        raise ValueError(f"how must be 'left' or 'inner', not {how!r}")
    k = [f"__k{i}" for i in range(len(keys))]
    label_side, feature_side = (0, 1) if strict else (1, 0)

    def slots(own: int | None, value: Column | None, order: Column | None) -> list[Column]:
        """One (value, order) column pair per source; null except the row's own."""
        out = []
        for i, schema in enumerate(payload_types):
            out.append((value if i == own else F.lit(None).cast(schema)).alias(f"__f{i}"))
            out.append((order if i == own else F.lit(None).cast(order_type)).alias(f"__o{i}"))
        return out

    payloads = [F.struct(*[F.col(c) for c in s.cols]) for s in sources]
    payload_types = [s.df.select(p.alias("p")).schema["p"].dataType for s, p in zip(sources, payloads)]
    order_type = "struct<ft:bigint,created:bigint>"

    events = labels.select(
        *[F.col(c).alias(a) for c, a in zip(keys, k)],
        micros(label_ts).alias(_T),
        F.lit(label_side).alias(_SIDE),
        F.struct("*").alias(_LABEL),
        *slots(None, None, None),
    )
    for i, (s, payload) in enumerate(zip(sources, payloads)):
        own_keys = s.keys or keys
        ft = micros(s.feature_ts)
        seen = F.greatest(ft, micros(s.visible_by)) if s.visible_by else ft
        made = _tie(s.df, s.created)
        usable = F.col(s.feature_ts).isNotNull()
        for c in own_keys:
            usable = usable & F.col(c).isNotNull()
        if s.visible_by:
            usable = usable & F.col(s.visible_by).isNotNull()
        order = F.struct(ft.alias("ft"), made.alias("created"))
        rows = s.df.where(usable).select(
            *[F.col(c).alias(a) for c, a in zip(own_keys, k)],
            seen.alias(_T),
            F.lit(feature_side).alias(_SIDE),
            F.lit(None).cast(labels.schema).alias(_LABEL),
            *slots(i, payload, order),
        )
        events = events.unionByName(rows)

    hot = resolve_hot(hot, events.select(*k, _T), k, _T, rows_per_slice)
    if hot is not None:
        hot = hot.renamed(k)
    sliced = add_slices(events, k, _T, hot)
    if hot is not None:
        n = range(len(sources))
        totals = {f"__f{i}": F.max_by(f"__f{i}", f"__o{i}") for i in n} | {f"__o{i}": F.max(f"__o{i}") for i in n}
        scans = {f"__f{i}": F.max_by(f"__f{i}", f"__o{i}") for i in n} | {f"__o{i}": F.max(f"__o{i}") for i in n}
        # A carry row has no time, so it sorts before everything in its slice.
        carried = carries(sliced, k, totals, scans).withColumn(_SIDE, F.lit(-1))
        sliced = sliced.unionByName(carried, allowMissingColumns=True)

    w = (
        Window.partitionBy(*task_keys(k, hot))
        .orderBy(F.col(_T).asc_nulls_first(), _SIDE)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    newest = []
    for i in range(len(sources)):
        newest.append(F.max_by(f"__f{i}", f"__o{i}").over(w).alias(f"__m{i}"))
        newest.append(F.max(f"__o{i}").over(w)["ft"].alias(f"__ft{i}"))
    matched = sliced.select(_T, _LABEL, _SIDE, *newest).where((F.col(_SIDE) == label_side) & F.col(_LABEL).isNotNull())

    outputs: list[Column] = [F.col(f"{_LABEL}.{c}").alias(c) for c in labels.columns]
    hit_any: Column = F.lit(False)
    for i, s in enumerate(sources):
        fresh = F.col(f"__ft{i}").isNotNull() & F.col(_T).isNotNull()
        if s.ttl is not None:
            fresh = fresh & (F.col(f"__ft{i}") > F.col(_T) - F.lit(duration_micros(s.ttl)))
        hit_any = hit_any | fresh
        for c, name in s.cols.items():
            outputs.append(F.when(fresh, F.col(f"__m{i}.{c}")).alias(name))
        if s.match_ts:
            outputs.append(F.when(fresh, F.timestamp_micros(F.col(f"__ft{i}"))).alias(s.match_ts))
    if how == "inner":
        matched = matched.where(hit_any)
    return matched.select(*outputs)


def _tie(df: DataFrame, created: str | None) -> Column:
    """The tie-break as a long: a timestamp's microseconds, or a number such as a row id."""
    if created is None:
        return F.lit(None).cast("long")
    return F.col(created).cast("long") if isinstance(df.schema[created].dataType, T.NumericType) else micros(created)


def pit_join_bucketed(
    labels: DataFrame,
    features: DataFrame,
    keys: list[str],
    label_ts: str,
    feature_ts: str,
    ttl: str | int,
    cols: list[str] | dict[str, str],
    created: str | None = None,
    how: str = "left",
    match_ts: str | None = None,
) -> DataFrame:
    """The same join cut into TTL-long buckets for *every* entity.

    A label's match lies in its own bucket or the one before, and of the earlier bucket only the
    newest row can matter.  So each (entity, bucket) hands exactly one row to the next bucket and
    no row is paired with another.  Prefer this when most entities are dense and the TTL is short;
    it needs no look at the key sizes first.
    """
    mapping = cols if isinstance(cols, dict) else {c: c for c in cols}
    width = duration_micros(ttl)
    k = [f"__k{i}" for i in range(len(keys))]
    payload = F.struct(*[F.col(c) for c in mapping])
    payload_type = features.select(payload.alias("p")).schema["p"].dataType
    made = _tie(features, created)
    usable = F.col(feature_ts).isNotNull()
    for c in keys:
        usable = usable & F.col(c).isNotNull()
    feats = features.where(usable).select(
        *[F.col(c).alias(a) for c, a in zip(keys, k)],
        micros(feature_ts).alias(_T),
        F.struct(micros(feature_ts).alias("ft"), made.alias("created")).alias("__o"),
        payload.alias("__f"),
    ).withColumn("__b", F.expr(f"{_T} div {width}"))
    handed = (
        feats.groupBy(*k, "__b")
        .agg(F.max_by("__f", "__o").alias("__f"), F.max("__o").alias("__o"))
        .select(*k, (F.col("__b") + 1).alias("__b"), "__f", "__o")
    )
    # Null-key labels can match nothing; a random bucket keeps them from piling up in one task.
    keyless: Column = F.lit(False)
    for a in k:
        keyless = keyless | F.col(a).isNull()
    rows = (
        labels.select(
            *[F.col(c).alias(a) for c, a in zip(keys, k)],
            micros(label_ts).alias(_T),
            F.struct("*").alias(_LABEL),
        )
        .withColumn("__b", F.expr(f"{_T} div {width}"))
        .withColumn("__b", F.when(keyless, F.xxhash64(_T)).otherwise(F.col("__b")))
        .withColumn("__f", F.lit(None).cast(payload_type))
        .withColumn("__side", F.lit(1))
        .unionByName(feats.withColumn("__side", F.lit(0)), allowMissingColumns=True)
        .unionByName(handed.withColumn("__side", F.lit(-1)), allowMissingColumns=True)
    )
    w = (
        Window.partitionBy(*k, "__b")
        .orderBy(F.col(_T).asc_nulls_first(), _SIDE)
        .rowsBetween(Window.unboundedPreceding, Window.currentRow)
    )
    best = rows.select(
        _T, _SIDE, _LABEL, F.max_by("__f", "__o").over(w).alias("__m"), F.max("__o").over(w)["ft"].alias("__ft")
    ).where(F.col(_SIDE) == 1)
    fresh = F.coalesce(F.col("__ft") > F.col(_T) - F.lit(width), F.lit(False))
    if how == "inner":
        best = best.where(fresh)
    outputs = [F.col(f"{_LABEL}.{c}").alias(c) for c in labels.columns]
    outputs += [F.when(fresh, F.col(f"__m.{c}")).alias(name) for c, name in mapping.items()]
    if match_ts:
        outputs.append(F.when(fresh, F.timestamp_micros("__ft")).alias(match_ts))
    return best.select(*outputs)


def chosen_features(views: list[FeatureView], select: list[str] | None) -> dict[str, list[str]]:
    """View name -> its features among the ``view:feature`` names of ``select`` (None: all), in the order of the views."""
    wanted: dict[str, list[str]] = {v.name: [] if select is not None else list(v.feature_names) for v in views}
    for name in select or []:
        view_name, _, feature = name.partition(":")
        if view_name not in wanted:
            raise ValueError(f"no view {view_name!r} is given")
        wanted[view_name].append(feature)
    for view in views:
        missing = [n for n in wanted[view.name] if n not in view.feature_names]
        if missing:
            raise ValueError(f"{view.name} has no feature {missing}")
    return {name: features for name, features in wanted.items() if features}


def by_key_list(views: list[FeatureView], keys: list[str] | dict[str, list[str]] | None) -> dict[tuple[str, ...], list[FeatureView]]:
    """Views by the caller's columns that hold their key: ``keys`` for all views, or by view; else columns named like the view's own."""
    out: dict[tuple[str, ...], list[FeatureView]] = {}
    for view in views:
        own = keys.get(view.name, view.keys) if isinstance(keys, dict) else keys or view.keys
        if isinstance(keys, dict) and len(own) != len(view.keys):
            raise ValueError(f"{view.name} is keyed by {list(view.keys)}, not by {len(own)} columns")
        out.setdefault(tuple(own), []).append(view)
    return out


def training_set(
    labels: DataFrame,
    views: list[tuple[FeatureView, DataFrame]],
    keys: list[str] | dict[str, list[str]] | None,
    label_ts: str,
    select: list[str] | None = None,
    exclude: tuple[str, ...] = (),
    feature_ts: str = "event_time",
    created: str | None = "ingestion_time",
    strict: bool = False,
    rows_per_slice: int = ROWS_PER_SLICE,
    hot: HotKeys | None | str = AUTO,
) -> DataFrame:
    """Labels with the features of several views as known at each label, named ``view__feature``.

    ``select`` lists ``view:feature`` names (None = all).  ``keys`` names the labels' key columns: one list for all views, a list by view
    name, or None where labels name them as each view does.  Views of one key list share one pass, each with its own
    TTL; the labels, with what they have so far, go through one pass for every key list, so nothing is joined back.  A
    null key matches nothing.  ``exclude`` drops columns such as keys and times at the end.
    """
    wanted = chosen_features([v for v, _ in views], select)
    tables = {v.name: df for v, df in views}
    groups = by_key_list([v for v, _ in views if v.name in wanted], keys)
    if len(groups) > 1 and hot is not None and hot != AUTO:
        raise ValueError("a list of hot keys belongs to one key list")
    joined = labels
    for own, members in groups.items():
        sources = [
            AsOfSource(
                tables[v.name],
                feature_ts,
                {n: f"{v.name}__{n}" for n in wanted[v.name]},
                v.ttl_seconds,
                created if created and created in tables[v.name].columns else None,
                keys=list(own) if isinstance(keys, list) else list(v.keys),
            )
            for v in members
        ]
        joined = multi_pit_join(joined, sources, list(own), label_ts, strict, "left", rows_per_slice, hot)
    return joined.drop(*exclude) if exclude else joined


def training_set_for(spec: TrainingSpec, labels: DataFrame, stores: dict[str, tuple[FeatureView, DataFrame]], **options) -> DataFrame:
    """The training set that ``spec`` describes; ``stores`` has every view's history by the view's name."""
    views = [stores[name] for name in spec.views]
    strange = sorted({k for v, _ in views for k in v.keys} - set(spec.join_keys))
    if strange:
        raise ValueError(f"{strange} are no join keys of the training set")
    select = None if spec.features is None else list(spec.features)
    return training_set(labels, views, None, spec.event_time_column, select, **options)
