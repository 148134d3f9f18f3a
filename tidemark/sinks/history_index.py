"""Bloom filters of history files: which files can hold a re-delivered row.

Beside a date-partitioned history lies an index (``_blooms``, which readers of the history pass over): for every file, and each of ``PARTS`` parts of the
hashes of (entity, event time), a bit array.  A batch is matched with the filters of its dates part by part, and only files that may hold
one of its rows are read for the exact comparison.  A file without a filter is always read, so a lost index costs time only.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Parts of the hashes, bits for each hash, and bits set for each.
PARTS, BITS, PROBES = 16, 16, 8
INDEX = "_blooms"
_BLOOM = "event_date date, part int, file string, bits binary"
_HIT = "file string"


def _hashed(df: DataFrame, keys: list[str], event_time: str, *more: Column) -> DataFrame:
    """(``event_date``, ``part``, ``h``) of every row, and ``more``."""
    h = F.xxhash64(*keys, event_time)
    return df.select("event_date", F.pmod(h, F.lit(PARTS)).cast("int").alias("part"), h.alias("h"), *more)


def _places(hashes: np.ndarray, size: int) -> np.ndarray:
    """The bits of each hash, in rows."""
    h = hashes.view(np.uint64)
    with np.errstate(over="ignore"):
        step = (h * np.uint64(0x9E3779B97F4A7C15)) | np.uint64(1)
        return np.stack([(h + step * np.uint64(i)) >> np.uint64(7) for i in range(PROBES)], axis=1) % np.uint64(size)


def bloom(hashes: np.ndarray) -> bytes:
    size = max(256, -(-BITS * len(hashes) // 8) * 8)
    bits = np.zeros(size, bool)
    bits[_places(hashes, size).ravel().astype(np.int64)] = True
    return np.packbits(bits).tobytes()


def may_hold(bits: bytes, hashes: np.ndarray) -> bool:
    held = np.unpackbits(np.frombuffer(bits, np.uint8)).astype(bool)
    return bool(held[_places(hashes, len(held)).astype(np.int64)].all(axis=1).any())


def _path(spark: SparkSession, folder: str):
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    return path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), path


def files_of(spark: SparkSession, history: str, dates: list[str]) -> list[str]:
    """Files of the dates, by their paths below the history."""
    out = []
    for date in dates:
        fs, path = _path(spark, f"{history}/event_date={date}")
        for status in fs.listStatus(path) if fs.exists(path) else []:
            name = status.getPath().getName()
            if name.endswith(".parquet"):
                out.append(f"event_date={date}/{name}")
    return out


def add_files(spark: SparkSession, history: str, files: list[str], schema, keys: list[str], event_time: str) -> None:
    """Write the filters of some files of the history."""
    if not files:
        return
    rows = spark.read.schema(schema).option("basePath", history).parquet(*[f"{history}/{f}" for f in files])
    name = F.concat_ws("/", F.slice(F.split(F.input_file_name(), "/"), -2, 2))
    parts = _hashed(rows, keys, event_time, name.alias("file"))

    def build(key: tuple[pa.Scalar, ...], table: pa.Table) -> pa.Table:
        bits = bloom(table["h"].to_numpy())
        return pa.table({"event_date": [key[0].as_py()], "part": pa.array([key[1].as_py()], pa.int32()), "file": [key[2].as_py()], "bits": [bits]})

    parts.groupBy("event_date", "part", "file").applyInArrow(build, _BLOOM).write.mode("append").parquet(f"{history}/{INDEX}")


def candidate_files(batch: DataFrame, history: str, keys: list[str], event_time: str) -> tuple[list[str], list[str]]:
    """(files that may hold a row of ``batch``, all files of its dates).  ``batch`` has ``event_date``.

    Both lists have one entry a file of the touched dates.
    """
    spark = batch.sparkSession
    dates = sorted(str(r[0]) for r in batch.select("event_date").distinct().collect() if r[0] is not None)
    files = files_of(spark, history, dates)
    fs, path = _path(spark, f"{history}/{INDEX}")
    if not files or not fs.exists(path):
        return files, files
    blooms = spark.read.schema(_BLOOM).parquet(f"{history}/{INDEX}").where(F.col("event_date").isin([F.lit(d).cast("date") for d in dates]))

    def probe(key: tuple[pa.Scalar, ...], asked: pa.Table, filters: pa.Table) -> pa.Table:
        hashes = asked["h"].to_numpy()
        found = [f for f, bits in zip(filters["file"].to_pylist(), filters["bits"].to_pylist(), strict=True) if len(hashes) and may_hold(bits, hashes)]
        return pa.table({"file": pa.array(found, pa.string())})

    asked = _hashed(batch, keys, event_time).distinct()
    hits = asked.groupBy("event_date", "part").cogroup(blooms.groupBy("event_date", "part")).applyInArrow(probe, _HIT)
    wanted = {r[0] for r in hits.distinct().collect()}
    indexed = {r[0] for r in blooms.select("file").distinct().collect()}
    return [f for f in files if f in wanted or f not in indexed], files
