"""Long (name, value) and wide forms of feature rows."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ISO_UTC = "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'+00:00'"


def text_value(col: Column) -> Column:
    """Spark's string form, nulls as ''.  Booleans read ``true``/``false``."""
    return F.coalesce(col.cast("string"), F.lit(""))


def feature_long_format(df: DataFrame, entity: str, event_time: str, features: list[str]) -> DataFrame:
    """``entity_id, event_time, position, feature_name, value_as_string``.

    The first two entries of each record are entity_id and event_time themselves (ISO 8601).
    """
    cells = [
        ("entity_id", text_value(F.col(entity))),
        ("event_time", F.date_format(F.col(event_time).cast("timestamp"), ISO_UTC)),
        *[(f, text_value(F.col(f))) for f in features],
    ]
    packed = F.array(
        *[
            F.struct(F.lit(i).alias("position"), F.lit(n).alias("feature_name"), v.alias("value_as_string"))
            for i, (n, v) in enumerate(cells)
        ]
    )
    return df.select(
        F.col(entity).alias("entity_id"), F.col(event_time).alias("event_time"), F.explode(packed).alias("c")
    ).select("entity_id", "event_time", "c.*")


def feature_wide_format(
    long: DataFrame,
    features: list[str],
    entity: str = "entity_id",
    event_time: str = "event_time",
    ingestion_time: str = "ingestion_time",
    name: str = "feature_name",
    value: str = "value",
) -> DataFrame:
    """One row per (entity, event_time, ingestion_time); the column list is given, not discovered.  Of values that one ingestion repeats
    for a cell, the largest stands."""
    picks = [F.max(F.when(F.col(name) == f, F.col(value))).alias(f) for f in features]
    return long.groupBy(entity, event_time, ingestion_time).agg(*picks)
