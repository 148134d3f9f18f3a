"""Order-preserving value buckets.

Exact order statistics need values in order, and a total sort or a per-group hash map of all
distinct values does not scale.  ``value_bucket`` maps a number to an integer that never falls
when the number grows: the floor of its scaled binary logarithm, mirrored for negative numbers.
(The logarithm is semi-monotonic by the JVM's contract, so rounding cannot swap two buckets.)
Buckets depend on the value alone, so two passes over the data, or a retried task, always agree on
them; a histogram over buckets is small, and an exact answer needs only the rows of the few
buckets that matter.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

PER_OCTAVE = 1024
_SHIFT = 1100.0  # above the negated logarithm of the smallest double
_INFINITE = 1 << 40


def value_bucket(value: Column | str, per_octave: int = PER_OCTAVE) -> Column:
    """``per_octave`` buckets between a number and its double."""
    x = (F.col(value) if isinstance(value, str) else value).cast("double")
    size = F.abs(x)
    magnitude = F.floor((F.log2(size) + F.lit(_SHIFT)) * F.lit(float(per_octave)))
    magnitude = F.when(size == F.lit(float("inf")), F.lit(_INFINITE)).otherwise(magnitude)
    return F.when(x == 0, F.lit(0)).when(x > 0, magnitude).otherwise(-magnitude).cast("long")
