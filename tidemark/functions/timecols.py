"""Time columns: everything is UTC, and ordered work uses microseconds since the epoch."""

from __future__ import annotations

import re
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Microseconds per unit.
UNIT_MICROS = {
    "microsecond": 1,
    "millisecond": 1_000,
    "second": 1_000_000,
    "minute": 60_000_000,
    "hour": 3_600_000_000,
    "day": 86_400_000_000,
    "week": 604_800_000_000,
}


def duration_micros(duration: str | int | float) -> int:
    """``'6 hours'``, ``'1.5 hours'``, ``'1 day 2 hours'`` -> microseconds; a bare number is seconds."""
    if isinstance(duration, (int, float)):
        return int(round(duration * 1_000_000))
    if not re.fullmatch(r"\s*(\d+(\.\d+)?\s*[a-zA-Z]+\s*)+", duration):
        raise ValueError(f"not a duration: {duration!r}")
    total = Decimal(0)
    for amount, unit in re.findall(r"([\d.]+)\s*([a-zA-Z]+)", duration):
        name = unit.lower().rstrip("s")
        if name not in UNIT_MICROS:
            raise ValueError(f"unknown time unit in {duration!r}")
        total += Decimal(amount) * UNIT_MICROS[name]
    if total <= 0 or total != int(total):
        raise ValueError(f"not a positive duration in whole microseconds: {duration!r}")
    return int(total)


def micros(ts: Column | str) -> Column:
    """Microseconds since the epoch of a TIMESTAMP or TIMESTAMP_NTZ column (NTZ is read as UTC)."""
    col = F.col(ts) if isinstance(ts, str) else ts
    return F.unix_micros(col.cast("timestamp"))


def from_micros(value: Column) -> Column:
    return F.timestamp_micros(value)


def as_timestamp(df: DataFrame, ts: str) -> Column:
    """The column as TIMESTAMP; one that is already is not cast, which would lose its watermark."""
    col = F.col(ts)
    return col if isinstance(df.schema[ts].dataType, T.TimestampType) else col.cast("timestamp")


def utc_timestamps(df: DataFrame) -> DataFrame:
    """Cast every TIMESTAMP_NTZ column to TIMESTAMP; watermarks and long casts need the latter."""
    ntz = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampNTZType)]
    return df.withColumns({c: F.col(c).cast("timestamp") for c in ntz}) if ntz else df


def naive_timestamps(df: DataFrame) -> DataFrame:
    """The opposite cast, for consumers that compare zone-less values."""
    zoned = [f.name for f in df.schema.fields if isinstance(f.dataType, T.TimestampType)]
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in zoned}) if zoned else df
