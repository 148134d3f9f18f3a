"""Embedding features and exact nearest neighbours."""

from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.functions.vectors import dot
from tidemark.operators.vector_index import METRICS, best, build_vector_index, by_length
from tidemark.session import ensure_checkpoint_dir

MAX_BROADCAST_QUERIES = 4_096


@F.arrow_udf(T.ArrayType(T.FloatType()))
def _normalized(vectors: pa.Array) -> pa.Array:
    there = vectors.is_valid().to_numpy(zero_copy_only=False)
    lengths = np.where(there, np.diff(vectors.offsets.to_numpy()), 0)
    row = np.repeat(np.arange(len(vectors)), lengths)
    flat = vectors.flatten()
    gaps = flat.is_null().to_numpy(zero_copy_only=False)
    values = flat.cast(pa.float64()).fill_null(0.0).to_numpy(zero_copy_only=False)
    norms = np.sqrt(np.bincount(row, values * values, len(vectors)))
    broken = np.bincount(row, gaps, len(vectors)) > 0  # a null component leaves no norm
    scale = np.where((norms > 0) & ~broken, norms, 1.0)
    unit = pa.array((values / scale[row]).astype(np.float32), mask=gaps)
    starts = np.concatenate([[0], np.cumsum(lengths)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(starts), unit, mask=pa.array(~there))


def normalize_embedding(df: DataFrame, col: str, out: str | None = None) -> DataFrame:
    """Divide by the L2 norm (float result).  Null, empty and zero vectors, and those with a null component, pass unchanged.

    Only the vectors travel to Python, as Arrow batches that are scaled as one array.
    """
    return df.withColumn(out or col, _normalized(F.col(col)))


def embedding_dot_product(df: DataFrame, a: str, b: str, out: str = "dot_product") -> DataFrame:
    """Dot product as float; 0.0 where a vector is null or the lengths differ."""
    return df.withColumn(out, F.coalesce(dot(F.col(a), F.col(b)), F.lit(0.0)).cast("float"))


def validate_embedding_dim(
    df: DataFrame, col: str, expected_dim: int, observation: Observation | None = None
) -> DataFrame:
    """Rows whose vector has the expected length.

    With an ``observation`` the number of dropped rows is counted while the result is computed.
    """
    fits = F.coalesce(F.size(col) == expected_dim, F.lit(False))
    if observation is not None and not df.isStreaming:
        df = df.observe(observation, F.count_if(~fits).alias("dropped"))
    return df.where(fits)


def knn(
    queries: DataFrame,
    base: DataFrame,
    query_id: str,
    query_vec: str,
    base_id: str,
    base_vec: str,
    k: int = 10,
    metric: str = "cosine",
    where: Column | None = None,
    min_score: float | None = None,
    digits: int | None = None,
    max_broadcast_queries: int = MAX_BROADCAST_QUERIES,
) -> DataFrame:
    """``query_id, neighbor_id, distance, rank``: the exact k nearest base rows per query.

    ``metric`` is cosine (1 - cosine), l2 or ip (negated inner product); ``where`` filters the
    base *before* ranking; ``min_score`` keeps neighbours whose score (1 - cosine distance,
    inner product, or 1 / (1 + l2)) is at least that.  Vectors of another length than the query
    are skipped, and so are queries without an id: nobody could be given the answer.  ``digits`` rounds distances before
    they are ranked.

    A request batch is small and the base is large, so the counted queries travel to the base:
    every Arrow batch is scored by one matrix product and keeps k rows per query, and no
    (query, base) pair ever becomes a row.  The base is neither shuffled nor sorted.  More queries than
    ``max_broadcast_queries`` are worth an index: the base is written as one and searched block by block, with
    the same result.  Keep such an index (``build_vector_index``) where the base is asked again.
    """
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    if where is not None:
        base = base.where(where)
    base = base.select(F.col(base_id).alias("id"), F.col(base_vec).alias("vec")).where("vec IS NOT NULL AND id IS NOT NULL")
    asked = queries.select(F.col(query_id).alias("id"), F.col(query_vec).alias("vec")).where("vec IS NOT NULL AND id IS NOT NULL")
    schema = T.StructType(
        [
            T.StructField("query_id", queries.schema[query_id].dataType),
            T.StructField("neighbor_id", base.schema["id"].dataType),
            T.StructField("distance", T.DoubleType()),
        ]
    )
    batch = asked.limit(max_broadcast_queries + 1).toArrow()
    if batch.num_rows <= max_broadcast_queries:
        found = _knn_broadcast(batch, base, schema, k, metric, digits)
    else:
        scratch = f"{ensure_checkpoint_dir(base.sparkSession)}/tidemark/vectors-{uuid.uuid4().hex}"
        index = build_vector_index(base, scratch, "id", "vec", metric)
        found = index.search(asked, "id", "vec", k, metric, digits=digits, block=max_broadcast_queries).drop("rank")
    if min_score is not None:
        score = {
            "cosine": 1 - F.col("distance"),
            "ip": -F.col("distance"),
            "l2": 1 / (1 + F.col("distance")),
        }[metric]
        found = found.where(score >= min_score)
    # The rank filter is applied before the shuffle as well (WindowGroupLimit).
    nearest = Window.partitionBy("query_id").orderBy("distance", "neighbor_id")
    return found.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)


def _knn_broadcast(batch: pa.Table, base: DataFrame, schema: T.StructType, k: int, metric: str, digits: int | None):
    packed: dict[int, tuple[np.ndarray, np.ndarray]] = {}
    for part in batch.combine_chunks().to_batches():
        packed |= {dim: (rows.column("id").to_numpy(zero_copy_only=False), matrix) for dim, rows, matrix in by_length(part)}
    shared = base.sparkSession.sparkContext.broadcast(packed)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, pd.DataFrame] = {}
        for batch in batches:
            for dim, rows, vectors in by_length(batch):
                if dim not in shared.value:
                    continue
                qids, matrix = shared.value[dim]
                both = best(qids, matrix, rows.column("id").to_numpy(zero_copy_only=False), vectors, k, metric, digits)
                if dim in held:
                    both = pd.concat([held[dim], both]).sort_values(["query_id", "distance", "neighbor_id"])
                    both = both.groupby("query_id", sort=False).head(k)
                held[dim] = both
        for found in held.values():
            yield pa.RecordBatch.from_pandas(found, preserve_index=False)

    return base.mapInArrow(scan, schema)


def embedding_document_id(entity_type: str, entity_id: str, feature_name: str) -> Column:
    """``type:entity:feature``."""
    return F.concat_ws(":", F.col(entity_type), F.col(entity_id), F.col(feature_name))
