"""Splitting hot keys for work that is ordered inside a key.

A window partitioned by entity puts a whole entity into one task, and adaptive execution does not
split window partitions.  When one entity may own a third of all rows that task never ends.  The
ordered operators therefore partition by ``(entity, slice)``: a slice is a stretch of the entity's
time axis holding about ``rows_per_slice`` rows.  Only entities above that size are sliced; all
others stay in one piece and pay nothing.  What an earlier slice would have contributed to a later
one travels as one *carry row* per slice, built from commutative totals that combine map-side.

The slicing decides where rows are processed, never what is computed: any choice of slices gives
the same result.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.bounded import local_rows

ROWS_PER_SLICE = 4_000_000

SLICE = "__slice"
SLICE_START = "__slice_start"
SLICE_END = "__slice_end"


@dataclass(frozen=True)
class HotKeys:
    """Sliced entities: one row ``(keys..., cuts)`` each; ``cuts`` are the first times of its slices, ascending."""

    frame: DataFrame
    count: int

    def renamed(self, keys: list[str]) -> HotKeys:
        """The same list for tables that name the keys differently, in order."""
        return HotKeys(self.frame.toDF(*keys, "cuts"), self.count)


def find_hot_keys(
    df: DataFrame,
    keys: list[str],
    t: str,
    rows_per_slice: int = ROWS_PER_SLICE,
    min_width: int = 1,
) -> HotKeys | None:
    """Entities with more than ``rows_per_slice`` rows, cut at times that leave about so many rows between them.

    One column-pruned count per key finds them, map-side combined; a second pass over their rows alone finds the
    cuts as approximate quantiles of time, whose error is a tenth of a slice.  A stray early time or a burst
    moves cuts, not rows into one slice.  Cuts are at least ``min_width`` apart, and rows of one instant stay
    together.  Of N rows fewer than N / ``rows_per_slice`` keys are hot and they have fewer than twice as many
    cuts, which bounds what reaches the driver and is broadcast; no key is left out.
    """
    counted = (
        df.groupBy(*keys)
        .agg(F.count(F.lit(1)).alias("n"), F.min(t).alias("lo"), F.max(t).alias("hi"))
        .where((F.col("n") > rows_per_slice) & (F.col("hi") > F.col("lo")))
    )
    rows = counted.toArrow()
    if rows.num_rows == 0:
        return None
    grid = 4 * -(-max(rows.column("n").to_pylist()) // rows_per_slice)
    hot = local_rows(counted, rows).select(*[F.col(k).alias(f"__hot_{i}") for i, k in enumerate(keys)])
    same: Column = F.lit(True)
    for i, k in enumerate(keys):
        same = same & df[k].eqNullSafe(hot[f"__hot_{i}"])
    quantiles = (
        df.join(F.broadcast(hot), same, "left_semi")
        .groupBy(*keys)
        .agg(
            F.percentile_approx(t, [i / grid for i in range(grid)], 10 * grid).alias("grid"),
            F.min(t).alias("lo"),
            F.count(F.lit(1)).alias("n"),
        )
    )
    # Every key takes from the common grid the points nearest to its own slices.
    pieces = F.ceil(F.col("n") / F.lit(rows_per_slice)).cast("int")
    taken = F.transform(
        F.sequence(F.lit(1), pieces - 1),
        lambda i: F.element_at("grid", F.round(i * F.lit(grid) / pieces).cast("int") + 1).cast("long"),
    )
    spaced = F.aggregate(
        taken,
        F.array(F.col("lo").cast("long")),
        lambda kept, cut: F.when(cut >= F.element_at(kept, -1) + min_width, F.concat(kept, F.array(cut))).otherwise(kept),
    )
    cuts = quantiles.select(*keys, spaced.alias("cuts"))
    rows = cuts.toArrow()
    return HotKeys(local_rows(cuts, rows), rows.num_rows)


AUTO = "auto"


def resolve_hot(
    hot: HotKeys | None | str, df: DataFrame, keys: list[str], t: str, rows_per_slice: int, min_width: int = 1
) -> HotKeys | None:
    """``AUTO`` looks for hot keys; a caller who knows them, or that there are none, says so."""
    return find_hot_keys(df, keys, t, rows_per_slice, min_width) if hot == AUTO else hot


def add_slices(df: DataFrame, keys: list[str], t: str, hot: HotKeys | None) -> DataFrame:
    """Add ``__slice`` (-1 for entities kept whole) with the slice's bounds in microseconds; the first
    slice has all earlier times, the last has no end.

    The broadcast side is the list above, whose size is bounded by the row count.
    """
    if hot is None:
        return df.withColumns(
            {
                SLICE: F.lit(-1).cast("long"),
                SLICE_START: F.lit(None).cast("long"),
                SLICE_END: F.lit(None).cast("long"),
            }
        )
    renamed = hot.frame.select(
        *[F.col(k).alias(f"__hot_{i}") for i, k in enumerate(keys)], F.col("cuts").alias("__cuts")
    )
    cond: Column = F.lit(True)
    for i, k in enumerate(keys):
        cond = cond & df[k].eqNullSafe(renamed[f"__hot_{i}"])
    # The list may stem from other data: rows before its first time belong to the first slice.
    reached = F.size(F.filter("__cuts", lambda cut: cut <= F.col(t))).cast("long") - 1
    number = F.when(F.col("__cuts").isNotNull() & F.col(t).isNotNull(), F.greatest(reached, F.lit(0).cast("long")))
    bound = lambda i: F.try_element_at("__cuts", (F.col(SLICE) + i).cast("int"))
    return (
        df.join(F.broadcast(renamed), cond, "left")
        .withColumn(SLICE, F.coalesce(number, F.lit(-1).cast("long")))
        .withColumn(SLICE_START, F.when(F.col(SLICE) >= 0, bound(1)))
        .withColumn(SLICE_END, F.when(F.col(SLICE) >= 0, bound(2)))
        .drop("__cuts", *[f"__hot_{i}" for i in range(len(keys))])
    )


def task_keys(keys: list[str], hot: HotKeys | None) -> list[str]:
    """What ordered work is partitioned by: the entity, and its slice where there are hot ones."""
    return [*keys, SLICE] if hot is not None else list(keys)


def carries(
    sliced: DataFrame,
    keys: list[str],
    totals: dict[str, Column],
    scans: dict[str, Column],
) -> DataFrame:
    """Per (entity, slice): the ``scans`` over the totals of the entity's *earlier* slices.

    ``totals`` are commutative aggregates per slice, ``scans`` name how they combine (``sum`` of
    sums, ``max`` of maxima).  The window sees one row per slice, not one per event.
    """
    per_slice = sliced.where(F.col(SLICE) >= 0).groupBy(*keys, SLICE).agg(*[c.alias(n) for n, c in totals.items()])
    earlier = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    return per_slice.select(*keys, SLICE, *[c.over(earlier).alias(n) for n, c in scans.items()])
