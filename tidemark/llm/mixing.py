"""Mixing sources to target weights along a time-varying curriculum; DataFrame functions only."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import word_count

#: Buckets per level of the two-level running sum.
_DIGITS = 2
Schedule = Sequence[tuple[float, float]]

#: A source's weight over training time (0 to 1), straight between knots: one that fades, one steady, one that grows.
SCHEDULES: tuple[Schedule, ...] = (((0.0, 1.5), (1.0, 0.5)), ((0.0, 1.0), (1.0, 1.0)), ((0.0, 0.5), (1.0, 1.5)))


def demand_time(share: Column, schedule: Schedule) -> Column:
    """When a source's cumulative demand reaches ``share`` (0 to 1) of its total: the integral of the schedule,
    a parabola between knots, solved for time."""
    pieces, total = [], 0.0
    for (t0, w0), (t1, w1) in zip(schedule[:-1], schedule[1:], strict=True):
        area = (t1 - t0) * (w0 + w1) / 2
        pieces.append((t0, w0, (w1 - w0) / (t1 - t0), total, area))
        total += area
    out = F.lit(float(schedule[-1][0]))
    for t0, w0, slope, before, area in reversed(pieces):
        here = F.greatest(F.lit(0.0), share * total - before)
        root = w0 + F.sqrt(F.greatest(F.lit(0.0), w0 * w0 + 2 * slope * here))
        out = F.when(share * total <= before + area, t0 + F.when(root > 0, 2 * here / root).otherwise(0.0)).otherwise(out)
    return out


def source_targets(
    totals: DataFrame, weights: Sequence[float] | Mapping[str | None, float] = (1.0, 2.0, 3.0), epochs: int = 3
) -> DataFrame:
    """Adds ``rank``, ``weight`` and ``target`` to (``k``, ``source``, ``source_size``), one row per source.

    Targets share the total by weight, stop at ``epochs`` times the source's size, and what is over is shared again
    by weight until none is above: with sources in the order of ``epochs * size / weight``, all up to a point
    are at their stop and the others have ``weight * level``.  Windows here run over one row per source.
    """
    by_source = Window.orderBy("k")
    ranked = totals.withColumn("rank", F.row_number().over(by_source) - 1)
    if isinstance(weights, Mapping):
        named = F.lit(None).cast("double")
        for name, value in weights.items():
            named = F.when(F.col("source").eqNullSafe(F.lit(name)), F.lit(float(value))).otherwise(named)
        weight = F.coalesce(named, F.lit(0.0))
    else:
        weight = F.element_at(F.array(*[F.lit(float(w)) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int"))
    stop = F.col("source_size") * float(epochs)
    order = Window.orderBy("ratio", "k")
    before = order.rowsBetween(Window.unboundedPreceding, -1)
    rest = order.rowsBetween(Window.currentRow, Window.unboundedFollowing)
    everything = Window.partitionBy(F.lit(1))
    filled = (
        ranked.withColumn("weight", weight)
        .withColumn("ratio", F.when(F.col("weight") > 0, stop / F.col("weight")).otherwise(float("inf")))
        .withColumn("total", F.sum("source_size").over(everything))
        .withColumn("over", F.coalesce(F.sum(F.when(F.col("weight") > 0, stop)).over(before), F.lit(0.0)))
        .withColumn("level", (F.col("total") - F.col("over")) / F.nullif(F.sum("weight").over(rest), F.lit(0.0)))
        .withColumn("level", F.min(F.when(F.col("level") <= F.col("ratio"), F.struct("ratio", "k", "level"))).over(everything)["level"])
    )
    share = F.when(F.col("weight") > 0, F.least(stop, F.coalesce(F.col("weight") * F.col("level"), stop)))
    return filled.select("k", "source", "source_size", "rank", "weight", F.coalesce(share, F.lit(0.0)).alias("target"))


def mix_sources(
    docs: DataFrame,
    size: Column | None = None,
    id_col: str = "doc_id",
    source_col: str = "source",
    weights: Sequence[float] | Mapping[str | None, float] = (1.0, 2.0, 3.0),
    schedules: Sequence[Schedule] = SCHEDULES,
    epochs: int = 3,
    whole: bool = False,
    copies: bool = False,
) -> DataFrame:
    """The rows of ``docs`` with ``mix_size``, ``mix_source_size``, ``mix_target``, ``mix_taken`` (long) and
    ``mix_positions`` (array of double), in the order of the first position.

    A source is read in a fixed random order (MD5 of the id, of the row's content where it has none; rows of one id by size and content), again from the start when it ends, until its target:
    the document whose words reach the target is cut there, or, with ``whole``, taken if at least half of it lies
    before.  Copy e of a document starts at ``offset + e * source_size`` words of its source; its position is the
    training time at which the source's scheduled demand gets there.  Rows that are not taken have no positions and
    come last.  With ``copies`` the result has a row for each copy that is taken, in the order of ``mix_position``, in
    place of ``mix_positions``.

    ``size`` counts words of ``text`` unless given; null texts have size 0.  Sources are ordered by code point, null
    last; ids may be null and rows repeat (each row counts).  Columns of the names above are replaced.  An empty
    table gives none.

    Scale: sums per (source, two hash digits, two more) are formed map side; running sums run over at most 256 rows
    at two levels, and only the last runs over documents, a 65 536th of a source at a time.
    """
    size = word_count(F.col("text")) if size is None else size
    taken_names = ("mix_size", "mix_source_size", "mix_target", "mix_taken", "mix_positions", "mix_position")
    kept = [F.col(f"`{c}`") for c in docs.columns if c not in taken_names]
    # Rows without id, and rows that share one, are told apart by what they hold.
    tie = F.xxhash64(*[F.col(f"`{f.name}`") for f in docs.schema.fields if "map<" not in f.dataType.simpleString()])
    digest = F.md5(F.coalesce(F.col(id_col).cast("string"), F.concat(F.lit("row "), tie.cast("string"))))
    rows = docs.select(
        F.struct(*kept).alias("row"),
        tie.alias("tie"),
        size.cast("long").alias("size"),
        # Code point order, null after everything.
        F.coalesce(F.concat(F.lit("a"), F.col(source_col).cast("string")), F.lit("b")).alias("k"),
        F.col(source_col).cast("string").alias("source"),
        digest.alias("h"),
        F.substring(digest, 1, _DIGITS).alias("h1"),
        F.substring(digest, 1 + _DIGITS, _DIGITS).alias("h2"),
    )
    fine = rows.groupBy("k", "h1", "h2").agg(F.sum("size").alias("s"), F.first("source").alias("source"))
    coarse = fine.groupBy("k", "h1").agg(F.sum("s").alias("s1"), F.first("source").alias("source"))
    targets = source_targets(
        coarse.groupBy("k").agg(F.first("source").alias("source"), F.sum("s1").alias("source_size")), weights, epochs
    ).drop("source")
    earlier = (Window.unboundedPreceding, -1)
    started = coarse.select(
        "k", "h1", F.coalesce(F.sum("s1").over(Window.partitionBy("k").orderBy("h1").rowsBetween(*earlier)), F.lit(0)).alias("o1")
    )
    offsets = (
        fine.withColumn("o2", F.coalesce(F.sum("s").over(Window.partitionBy("k", "h1").orderBy("h2").rowsBetween(*earlier)), F.lit(0)))
        .join(started, ["k", "h1"])
        .join(targets, "k")
        .select("k", "h1", "h2", (F.col("o1") + F.col("o2")).alias("o"), "source_size", "rank", "target")
    )
    inside = Window.partitionBy("k", "h1", "h2").orderBy("h", "size", "tie").rowsBetween(*earlier)
    placed = rows.withColumn("inside", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(offsets, ["k", "h1", "h2"])
    start = F.col("o") + F.col("inside")
    room = lambda e: F.col("target") - (start + e * F.col("source_size"))
    if whole:
        part = lambda e: F.when(room(e) * 2 >= F.greatest(F.col("size"), F.lit(1)), F.col("size")).otherwise(F.lit(0))
        has = lambda e: room(e) * 2 >= F.greatest(F.col("size"), F.lit(1))
    else:
        part = lambda e: F.least(F.col("size"), F.greatest(F.lit(0), F.floor(room(e))))
        has = lambda e: part(e) > 0
    which = F.sequence(F.lit(0), F.lit(epochs - 1))

    def position(e: Column) -> Column:
        share = F.least(F.lit(1.0), (start + e * F.col("source_size")) / F.col("target"))
        out = demand_time(share, schedules[0])
        for i, schedule in enumerate(schedules[1:], 1):
            out = F.when(F.col("rank") % len(schedules) == i, demand_time(share, schedule)).otherwise(out)
        return out

    taken = placed.select(
        "row",
        "h",
        "tie",
        "size",
        "source_size",
        "target",
        F.aggregate(F.transform(which, part), F.lit(0).cast("long"), lambda a, x: a + x.cast("long")).alias("taken"),
        F.transform(F.filter(which, has), position).alias("positions"),
    )
    names = {"size": "mix_size", "source_size": "mix_source_size", "target": "mix_target", "taken": "mix_taken"}
    named = [F.col(c).alias(n) for c, n in names.items()]
    if copies:
        each = taken.withColumn("position", F.explode("positions"))
        return each.orderBy("position", "h", "tie").select("row.*", *named, F.col("position").alias("mix_position"))
    # Untaken rows get the places behind the end, spread by their hash, so that no range is full of them.
    behind = 1.0 + F.conv(F.substring("h", 1, 8), 16, 10).cast("double") / 2.0**32
    first = F.coalesce(F.try_element_at("positions", F.lit(1)), behind)
    return taken.orderBy(first, "h", "tie").select("row.*", *named, F.col("positions").alias("mix_positions"))
