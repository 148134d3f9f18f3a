"""Spark session defaults used by the tests, the bench and interactive work.

On a cluster the session normally exists already; every operator takes its settings from the
DataFrames it is given and sets nothing globally.
"""

from __future__ import annotations

import tempfile

from pyspark.sql import SparkSession

DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.execution.arrow.pyspark.enabled": "true",
    "spark.serializer": "org.apache.spark.serializer.KryoSerializer",
    # Call-site capture costs a driver round trip per column expression.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(master: str | None = None, app_name: str = "tidemark", **conf: str) -> SparkSession:
    """Session with the library's defaults; ``conf`` keys may use ``__`` for ``.``."""
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**DEFAULTS, **{k.replace("__", "."): v for k, v in conf.items()}}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """The shared checkpoint folder: the context's own, else ``spark.checkpoint.dir``.  Only a local session, whose
    executors are the driver, may fall back on a scratch folder."""
    context = spark.sparkContext
    named = context.getCheckpointDir() or spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        if not context.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="tidemark-checkpoint-")
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(named)
    return named
