"""Tables that are evaluated once."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from tidemark.session import ensure_checkpoint_dir


def written_once(df: DataFrame, name: str) -> DataFrame:
    """The rows, in the shared checkpoint folder: evaluated once, and not lost with an executor."""
    path = f"{ensure_checkpoint_dir(df.sparkSession)}/tidemark/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
