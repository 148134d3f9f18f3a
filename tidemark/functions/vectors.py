"""Vector arithmetic as column expressions (no Python worker)."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    """Sum of products in double; null when a side is null or the lengths differ."""
    terms = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.when(F.size(a) == F.size(b), F.aggregate(terms, F.lit(0.0), lambda acc, x: acc + x))
