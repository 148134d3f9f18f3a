"""Exact quantiles, two-sample distances and rank sums without sorting the data.

Each works in two passes.  Pass one is a histogram over value buckets (map-side combined, at most
a few ten thousand rows per group whatever the data size).  It tells which buckets can hold the answer;
pass two reads the exact values of those buckets only.  Buckets that hold too many values for a task are cut further first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.bounded import fetch_small, hinted
from tidemark.functions.buckets import value_bucket
from tidemark.operators.ordering import in_order

_B = "__bucket"
#: Values of a cell that one task may order, and the parts that a larger one is cut into.
CELL, PARTS = 200_000, 1_024


def _running(groups: list[str], order: str, *partition: str):
    w = Window.partitionBy(*groups, *partition).orderBy(order)
    return w.rowsBetween(Window.unboundedPreceding, -1)


def _real(value: str) -> Column:
    return F.col(value).isNotNull() & ~F.isnan(F.col(value))


def order_statistics(df: DataFrame, groups: list[str], value: str, ranks: Column) -> DataFrame:
    """``groups, rank, value``: the values at the given 0-based ranks of each group.

    ``ranks`` is an array expression over the group columns and ``__total``, the group's number of
    non-null, non-NaN values.
    """
    data = df.select(*groups, F.col(value).cast("double").alias("__v"), F.lit(False).alias("__cur"))
    marks, _ = _marks(data, groups, ranks, False)
    return marks.select(*groups, "rank", "value").where("rank IS NOT NULL")


def exact_quantiles(df: DataFrame, groups: list[str], value: str, probs: list[float]) -> DataFrame:
    """``groups, prob, quantile`` with linear interpolation between order statistics.

    Agrees with ``percentile`` and with numpy's default, but no task holds a group's values.
    """
    ranks = all_ranks(probs, F.col("__total"))
    return interpolated(order_statistics(df, groups, value, ranks), groups, probs)


def interpolated(stats: DataFrame, groups: list[str], probs: list[float]) -> DataFrame:
    """``groups, prob, quantile`` from ``groups, rank, value``; the largest rank is the last value's."""
    per_group = stats.groupBy(*groups).agg(
        F.map_from_entries(F.collect_set(F.struct("rank", "value"))).alias("at"), F.max("rank").alias("top")
    )
    pos = F.col("prob") * F.col("top")
    low, high = F.floor(pos).cast("long"), F.ceil(pos).cast("long")
    a, b = F.col("at")[low], F.col("at")[high]
    lerp = F.when(a == b, a).otherwise(a + (b - a) * (pos - low))
    points = F.array(*[F.lit(float(p)) for p in probs])
    return per_group.withColumn("prob", F.explode(points)).select(*groups, "prob", lerp.alias("quantile"))


def two_sample_marks(
    long: DataFrame, groups: list[str], value: str, is_current: str, probs: list[float]
) -> tuple[DataFrame, bool]:
    """What is needed for base quantiles and the two-sample distance: ``(marks, is_small)``.

    ``marks`` has ``groups, n_base, n_cur, rank, value, d``: one row per needed order statistic of
    the base (``d`` null) and rows with candidate distances (``rank`` null).  Bucket ends bound
    the distance from below, bucket contents from above; only buckets whose upper bound exceeds
    the lower bound of the group, or which hold a wanted rank, are read a second time.
    """
    data = long.select(*groups, F.col(value).cast("double").alias("__v"), F.col(is_current).alias("__cur"))
    ranks = all_ranks(probs, F.col("__total")) if probs else F.array().cast("array<bigint>")
    return _marks(data, groups, ranks, True)


def _near(groups: list[str]) -> Column:
    """Whether a row lies in a cell: a cell is all of a group's values from its least to its largest."""
    near: Column = (F.col(_B) == F.col("__wb")) & F.col("__v").between(F.col("__lo"), F.col("__hi"))
    for i, g in enumerate(groups):
        near = near & F.col(g).eqNullSafe(F.col(f"__g_{i}"))
    return near


def _gap(b: Column, c: Column) -> Column:
    both = (F.col("n_base") > 0) & (F.col("n_cur") > 0)
    return F.when(both, F.abs(b / F.col("n_base") - c / F.col("n_cur"))).otherwise(0.0)


def _needed(cells: DataFrame, groups: list[str], distances: bool) -> DataFrame:
    """The cells that can matter: with a wanted rank, with a distance above all that are known, and one that tells the largest known.

    A cell has the counts of both samples before it (``__pb``, ``__pc``) and in it (``__nb``, ``__nc``), and its least and largest value.
    """
    every = Window.partitionBy(*groups)
    eb, ec = F.col("__pb") + F.col("__nb"), F.col("__pc") + F.col("__nc")
    cells = cells.withColumn(
        "__ranks", F.filter("__ranks", lambda r: (r >= F.col("__pb")) & (r < F.col("__pb") + F.col("__nb")))
    )
    if not distances:
        return cells.withColumns({"__known": F.lit(0.0), "__suspect": F.lit(False)}).where(F.size("__ranks") > 0)
    cells = cells.withColumn("__known", F.max(F.greatest("__known", _gap(eb, ec))).over(every))
    bound = F.greatest(_gap(eb, F.col("__pc")), _gap(F.col("__pb"), ec))
    cells = cells.withColumn("__suspect", (F.col("__lo") < F.col("__hi")) & (bound > F.col("__known")))
    # Of the cells that reach the known distance one is enough.
    cells = cells.withColumn("__first", F.min("__lo").over(every))
    return cells.where(F.col("__suspect") | (F.size("__ranks") > 0) | (F.col("__first") == F.col("__lo"))).drop("__first")


def _marks(data: DataFrame, groups: list[str], ranks: Column, distances: bool) -> tuple[DataFrame, bool]:
    """``marks`` of ``two_sample_marks`` for rows of ``groups, __v, __cur``.

    Cells start as value buckets.  A needed cell of more than ``CELL`` values is cut into ``PARTS`` of equal width between its least and largest
    value, pass after pass, until each holds at most ``CELL`` values or a single one: so values that crowd around a large mean are
    told apart like any others, and no task orders more than a cell.
    """
    data = data.where(_real("__v")).withColumn(_B, value_bucket("__v"))
    cur = F.count_if(F.col("__cur"))
    counts = [
        (F.count(F.lit(1)) - cur).alias("__nb"),
        cur.alias("__nc"),
        F.min("__v").alias("__lo"),
        F.max("__v").alias("__hi"),
    ]
    every = Window.partitionBy(*groups)
    hist = data.groupBy(*groups, _B).agg(*counts)
    hist = hist.withColumns(
        {
            "__pb": F.coalesce(F.sum("__nb").over(_running(groups, _B)), F.lit(0)),
            "__pc": F.coalesce(F.sum("__nc").over(_running(groups, _B)), F.lit(0)),
            "n_base": F.sum("__nb").over(every),
            "n_cur": F.sum("__nc").over(every),
            "__known": F.lit(0.0),
        }
    )
    hist = hist.withColumn("__total", F.col("n_base")).withColumn("__ranks", F.array_distinct(ranks)).drop("__total")
    names = [*groups, _B, "__lo", "__hi", "__pb", "__pc", "__nb", "__nc", "n_base", "n_cur", "__known", "__ranks"]
    kept, small = fetch_small(_needed(hist, groups, distances).select(*names, "__suspect"))
    mixed = F.col("__lo") < F.col("__hi")
    wanted = F.col("__suspect") | (mixed & (F.size("__ranks") > 0))

    def asked(cells: DataFrame) -> DataFrame:
        """Cells beside the data: their own columns under other names."""
        return cells.select(
            *[F.col(g).alias(f"__g_{i}") for i, g in enumerate(groups)], F.col(_B).alias("__wb"),
            *[c for c in names if c not in (*groups, _B)],
        ).drop("__nb", "__nc")

    while True:
        crowded = wanted & (F.col("__nb") + F.col("__nc") > CELL)
        if kept.where(crowded).isEmpty():
            break
        cells = asked(kept.where(crowded)).withColumnsRenamed({"__lo": "__clo", "__hi": "__chi"})
        inside = data.join(hinted(cells.withColumns({"__lo": F.col("__clo"), "__hi": F.col("__chi")}), small), _near(groups)).drop("__lo", "__hi")
        share = (F.col("__v") - F.col("__clo")) / (F.col("__chi") - F.col("__clo"))
        part = F.least(F.floor(share * PARTS), F.lit(PARTS - 1))
        own = [*groups, _B, "__clo", "__pb", "__pc", "n_base", "n_cur", "__known", "__ranks"]
        parts = inside.groupBy(*own, part.alias("__part")).agg(*counts)
        ahead = Window.partitionBy(*groups, _B, "__clo").orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
        before = {f"__p{x}": F.col(f"__p{x}") + F.coalesce(F.sum(f"__n{x}").over(ahead), F.lit(0)) for x in "bc"}
        cut = parts.withColumns(before).select(*names)
        kept, small = fetch_small(_needed(kept.where(~crowded).select(*names).unionByName(cut), groups, distances).select(*names, "__suspect"))

    head = [*groups, "n_base", "n_cur"]
    nothing = F.lit(None)
    coarse = kept.select(
        *head, nothing.cast("long").alias("rank"), nothing.cast("double").alias("value"), F.col("__known").alias("d")
    )
    flat = kept.where(~mixed).select(
        *head, F.explode("__ranks").alias("rank"), F.col("__lo").alias("value"), nothing.cast("double").alias("d")
    )
    upto = Window.partitionBy(*groups, _B, "__lo").orderBy("__v")
    values = (
        data.join(hinted(asked(kept.where(wanted)), small), _near(groups))
        .groupBy(*groups, _B, "__lo", "__v", "__pb", "__pc", "n_base", "n_cur", "__ranks")
        .agg((F.count(F.lit(1)) - cur).alias("__nb"), cur.alias("__nc"))
        .withColumns({"__sb": F.col("__pb") + F.sum("__nb").over(upto), "__sc": F.col("__pc") + F.sum("__nc").over(upto)})
    )
    here = F.filter("__ranks", lambda r: (r >= F.col("__sb") - F.col("__nb")) & (r < F.col("__sb")))
    fine = values.select(
        *head, F.explode_outer(here).alias("rank"), F.col("__v").alias("value"), _gap(F.col("__sb"), F.col("__sc")).alias("d")
    )
    # One row per wanted rank and group besides the largest distance; both combine map-side.
    marks = (
        coarse.unionByName(flat)
        .unionByName(fine)
        .groupBy(*head, "rank")
        .agg(F.max("value").alias("value"), F.max("d").alias("d"))
    )
    return fetch_small(marks) if small and distances else (marks, False)


def all_ranks(probs: list[float], total: Column) -> Column:
    """The 0-based ranks on both sides of each quantile, and the last rank, which tells the size."""
    points = F.array(*[F.lit(float(p)) for p in probs])
    top = total - 1
    pairs = F.transform(points, lambda p: F.array(F.floor(p * top).cast("long"), F.ceil(p * top).cast("long")))
    return F.array_append(F.flatten(pairs), top.cast("long"))


def two_sample_distance(long: DataFrame, groups: list[str], value: str, is_current: str) -> DataFrame:
    """``groups, n_base, n_cur, ks_stat``: the largest gap between the two empirical CDFs."""
    marks, _ = two_sample_marks(long, groups, value, is_current, [])
    return (
        marks.groupBy(*groups)
        .agg(F.max("n_base").alias("n_base"), F.max("n_cur").alias("n_cur"), F.max("d").alias("ks_stat"))
        .where("n_base > 0 AND n_cur > 0")
    )


def score_counts(df: DataFrame, score: str, positive: Column, threshold: float) -> DataFrame:
    """One row about a scored set: ``n_pos, n_neg, pos_above, neg_above, roc_auc``.

    The area is the share of (positive, negative) pairs in the right order, ties counted one half.
    Equal scores are combined first, then dealt out in order by a range sort.
    """
    counts = (
        df.select(F.col(score).cast("double").alias("__v"), positive.alias("__pos"))
        .where(_real("__v") & F.col("__pos").isNotNull())
        .groupBy("__v")
        .agg(F.count_if(F.col("__pos")).alias("p"), F.count_if(~F.col("__pos")).alias("n"))
    )
    ranked = in_order(counts, [F.col("__v")], {"below": "n"})
    wins = F.col("p") * (F.col("below") + F.col("n") / F.lit(2.0))
    above = F.col("__v") > threshold
    sums = ranked.agg(
        F.coalesce(F.sum("p"), F.lit(0)).alias("n_pos"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_neg"),
        F.coalesce(F.sum(F.when(above, F.col("p"))), F.lit(0)).alias("pos_above"),
        F.coalesce(F.sum(F.when(above, F.col("n"))), F.lit(0)).alias("neg_above"),
        F.sum(wins).alias("wins"),
    )
    pairs = F.col("n_pos").cast("double") * F.col("n_neg")
    return sums.withColumn("roc_auc", F.when(pairs > 0, F.col("wins") / pairs)).drop("wins")
