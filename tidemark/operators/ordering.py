"""Positions in a total order without a window that one task would have to sort."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.functions.scratch import written_once


def in_order(df: DataFrame, order: list[Column], sums: dict[str, str]) -> DataFrame:
    """The rows with, for each ``sum: column`` of ``sums``, the total of the column over all rows before.

    A range sort deals the rows out by sampled bounds, so a narrow range of values is cut as evenly as a wide one; what lies in
    earlier partitions is added from one row a partition.  Rows that are equal in ``order`` share a partition; their order is any.
    """
    at = F.monotonically_increasing_id()
    placed = written_once(df.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("__at", at), "in-order")
    placed = placed.withColumn("__part", F.shiftright("__at", 33))
    parts = placed.groupBy("__part").agg(*[F.sum(c).alias(name) for name, c in sums.items()])
    # One row a partition.
    ahead = Window.orderBy("__part").rowsBetween(Window.unboundedPreceding, -1)
    parts = parts.select("__part", *[F.coalesce(F.sum(name).over(ahead), F.lit(0)).alias(f"__{name}") for name in sums])
    here = Window.partitionBy("__part").orderBy("__at").rowsBetween(Window.unboundedPreceding, -1)
    totals = {name: F.col(f"__{name}") + F.coalesce(F.sum(c).over(here), F.lit(0)) for name, c in sums.items()}
    return placed.join(parts, "__part").withColumns(totals).drop("__at", "__part", *[f"__{name}" for name in sums])
