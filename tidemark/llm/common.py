"""What the operators share: the cluster's shared folder, written intermediate tables, words, vectors."""

from __future__ import annotations

import gc
import tempfile
import uuid

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

#: White space between words: blank, tab, line feed, vertical tab, form feed, carriage return.
WORD = r"[^\x20\x09-\x0D]+"
GAP = r"[\x20\x09-\x0D]+"


def shared_dir(spark: SparkSession) -> str:
    """The folder that driver and executors share: ``spark.checkpoint.dir``, else the context's own.  Only a
    local session, whose executors are the driver, may fall back on a temporary folder."""
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getCheckpointDir()
    if named is None:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("set spark.checkpoint.dir to a folder that driver and executors share")
        named = tempfile.mkdtemp(prefix="tidemark-shared-")
        spark.sparkContext.setCheckpointDir(named)
    return named.rstrip("/")


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows, written to the shared folder and read back: later steps neither repeat the work nor lose it
    with an executor."""
    path = f"{shared_dir(df.sparkSession)}/tidemark-llm/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def discard(*tables: DataFrame) -> None:
    """Remove tables that ``written`` made and that nothing reads any more."""
    for table in tables:
        context = table.sparkSession.sparkContext
        for folder in {f.rsplit("/", 1)[0] for f in table.inputFiles()}:
            if "/tidemark-llm/" not in folder:
                raise ValueError(f"{folder} is no intermediate table")
            path = context._jvm.org.apache.hadoop.fs.Path(folder)
            path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def release(spark: SparkSession) -> None:
    """Let go of finished shuffles: Spark deletes their files once the driver's JVM has collected what refers to them,
    which a driver with free memory may put off for long."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def small_batches(spark: SparkSession, rows: int = 2_000) -> None:
    """Whole texts go to Python workers so many at a time: a batch lies in memory several times, in the JVM and in the worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    most = int(spark.conf.get(key))
    if most <= 0 or most > rows:
        spark.conf.set(key, str(rows))


def schema_with(rows: DataFrame, kept: list[str], added: str) -> StructType:
    """Schema of the columns ``kept`` of ``rows`` and those ``added`` (DDL)."""
    return StructType([*(rows.schema[c] for c in kept), *StructType.fromDDL(added).fields])


def free_name(names: list[str]) -> str:
    """A field name that differs from all ``names``."""
    return "_" * (1 + max(map(len, names), default=0))


def words(text: Column) -> Column:
    """The words of a text, in order; null texts have none."""
    return F.filter(F.split(F.coalesce(text, F.lit("")), GAP), lambda w: w != "")


def word_count(text: Column) -> Column:
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("long")


def matrix(column: pa.Array, dimension: int) -> np.ndarray:
    """Rows of a list column that are all ``dimension`` long, as doubles."""
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return flat.reshape(-1, dimension)


def usable_vectors(vectors: DataFrame, id_col: str, vector_col: str, nonzero: bool) -> DataFrame:
    """(``id`` long, ``v`` array<double>): one row per id whose vector can take part.

    Rows with a null id or vector, a null or non-finite component, no component or (``nonzero``) no component
    other than zero take no part.  Of rows that share an id, the smallest vector stands.
    """
    v = F.col(vector_col).cast("array<double>")
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    rows = vectors.select(F.col(id_col).cast("long").alias("id"), v.alias("v"), finite.alias("finite")).where(
        F.col("id").isNotNull() & (F.size("v") > 0) & F.col("finite")
    )
    if nonzero:
        rows = rows.where(F.exists("v", lambda x: x != 0))
    return rows.groupBy("id").agg(F.min("v").alias("v"))


def common_dimension(rows: DataFrame) -> int:
    """The commonest vector length, the smaller of equals; 0 without rows."""
    top = rows.groupBy(F.size("v").alias("d")).count().orderBy(F.desc("count"), "d").first()
    return int(top["d"]) if top else 0
