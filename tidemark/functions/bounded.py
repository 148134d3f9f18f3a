"""Broadcast only what has been counted."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.functions.scratch import written_once

MAX_BROADCAST_ROWS = 200_000


def fetch_small(df: DataFrame, max_rows: int = MAX_BROADCAST_ROWS) -> tuple[DataFrame, bool]:
    """Evaluate a derived table once when it is small: ``(local relation, True)``.

    At most ``max_rows + 1`` rows are looked at; a larger table comes back written to the checkpoint folder, with
    False, and must be joined without a broadcast hint.
    """
    rows = df.limit(max_rows + 1).toArrow()
    if rows.num_rows > max_rows:
        return written_once(df, "bounded"), False
    return local_rows(df, rows), True


def hinted(df: DataFrame, small: bool) -> DataFrame:
    """Broadcast ``df`` only when it was counted (or derives from a table that was)."""
    return F.broadcast(df) if small else df


def local_rows(df: DataFrame, rows) -> DataFrame:
    """Fetched Arrow rows of ``df`` as a local relation: no job, no Python worker."""
    return df.sparkSession.createDataFrame(rows, df.schema)
