"""Exact top-k by inner product: a Voronoi join of queries and data."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import common_dimension, matrix, usable_vectors, written

#: Bounds are computed in floating point; a difference this small decides nothing.
_SLACK = 1e-9
#: Steps of a cell's distances in the summaries.
_STEPS = 16


def _square_distances(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    return (a * a).sum(axis=1)[:, None] - 2 * a @ b.T + (b * b).sum(axis=1)


def _pivots(rows: DataFrame, most: int, dimension: int) -> np.ndarray:
    """Up to ``most`` vectors, in the order of their ids' hashes; equal ones count once."""
    found = rows.orderBy(F.xxhash64("id"), "id").limit(most).select("v").collect()
    return np.array(list(dict.fromkeys(tuple(r["v"]) for r in found)), dtype=np.float64).reshape(-1, dimension)


def _assign(pivots: np.ndarray):
    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Nearest pivot, the first of equals, and the distance to it."""
        for batch in batches:
            vectors = matrix(batch.column("v"), pivots.shape[1])
            near = _square_distances(vectors, pivots).argmin(axis=1)
            far = np.sqrt(((vectors - pivots[near]) ** 2).sum(axis=1))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(near.astype(np.int32)), pa.array(far)], names=[*batch.schema.names, "cell", "far"]
            )

    return assign


def _bounds(groups: np.ndarray, radius: np.ndarray, pivots: np.ndarray, summary: list, k: int) -> np.ndarray:
    """For each group of queries a product that at least k + 1 data vectors reach with each of its queries.

    A data vector at distance d of its pivot p has a product of at least <g, p> - |g| d - r |p| - r d with any query at
    distance r or less of the group's pivot g.
    """
    out = np.full(len(groups), -np.inf)
    cell, far, count = (np.array([row[x] for row in summary]) for x in ("cell", "far", "n"))
    norms = np.linalg.norm(pivots, axis=1)[cell]
    for g, r in enumerate(radius):
        low = pivots[cell] @ groups[g] - np.linalg.norm(groups[g]) * far - r * norms - r * far
        order = np.argsort(-low, kind="stable")
        enough = np.searchsorted(np.cumsum(count[order]), k + 1)
        if enough < len(order):
            out[g] = low[order[enough]]
    return out


def _pick(values: np.ndarray, at: Column) -> Column:
    return F.element_at(F.lit([int(x) for x in values]), at + 1)


def top_products(
    vectors: DataFrame,
    queries: DataFrame,
    k: int,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    pivots: int = 256,
    block: int = 8192,
    group: int = 1024,
) -> DataFrame:
    """(``query_id``, ``rank``, ``vec_id``, ``score``): for every query the ``k`` data vectors of the largest inner product, ties to the
    smaller id, the query's own id left out; all, where there are fewer.

    Data and queries are grouped by their nearest pivot: up to ``pivots`` vectors of the data, for queries the first so
    many of them that a group has about ``group``.  Counts of the data by cell and distance, at most 16 rows a cell,
    bound the k-th best product of each group of queries from below; a data vector goes only to the groups where its
    product with the pivot, and what the farthest query can add, reach that bound.  However rows are spread, a group
    is cut into parts of about ``group`` queries and blocks of about ``block`` vectors; a task holds one part and one
    block at a time, solves them by matrix products and keeps k rows a query, which are ranked at the end.

    ``queries`` and ``vectors`` have the same columns.  Null or non-finite vectors, null ids, and lengths other than
    the data's commonest take no part; of rows that share an id, the smallest vector stands; other columns are
    ignored; an empty table gives none.  Products are exact for whole-number components while they stay under 2^53.
    """
    nothing = vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    data = usable_vectors(vectors, id_col, vector_col, nonzero=False)
    dimension = common_dimension(data)
    asked = usable_vectors(queries, id_col, vector_col, nonzero=False).where(F.size("v") == dimension)
    asked = written(asked, "topk-asked")
    number = asked.count()
    if not dimension or not number:
        return nothing
    data = data.where(F.size("v") == dimension)
    centres = _pivots(data, pivots, dimension)
    middles = centres[: max(1, min(len(centres), -(-number // group)))]
    kind = "id long, v array<double>, cell int, far double"
    data = written(data.mapInArrow(_assign(centres), kind), "topk-data")
    asked = written(asked.mapInArrow(_assign(middles), kind), "topk-queries")

    # One row a group, and 16 a cell.
    reach = {r["cell"]: r for r in asked.groupBy("cell").agg(F.max("far").alias("far"), F.count("*").alias("n")).collect()}
    groups = np.array(sorted(reach))
    radius = np.array([reach[g]["far"] for g in groups])
    parts = np.array([-(-reach[g]["n"] // group) if g in reach else 1 for g in range(len(middles))])
    widest = data.agg(F.max("far")).first()[0]
    step = F.least(F.lit(_STEPS - 1), F.floor(F.col("far") / (widest / _STEPS or 1.0))).cast("int")
    summary = data.groupBy("cell", step.alias("step")).agg(F.max("far").alias("far"), F.count("*").alias("n")).collect()
    bounds = _bounds(middles[groups], radius, centres, summary, k)

    def replicate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                v = matrix(part.column("v"), dimension)
                best = v @ middles[groups].T + np.linalg.norm(v, axis=1)[:, None] * radius
                row, needed = np.nonzero(best + _SLACK * (1 + np.abs(best)) >= bounds)
                yield pa.RecordBatch.from_arrays(
                    [*(part.column(x).take(pa.array(row)) for x in ("id", "v")), pa.array(groups[needed].astype(np.int32))],
                    names=["id", "v", "cell"],
                )

    sent = written(data.select("id", "v").mapInArrow(replicate, "id long, v array<double>, cell int"), "topk-sent")
    held = {r["cell"]: r["n"] for r in sent.groupBy("cell").agg(F.count("*").alias("n")).collect()}
    blocks = np.array([max(1, -(-held.get(g, 0) // block)) for g in range(len(middles))])

    def side(rows: DataFrame, asks: bool) -> DataFrame:
        """A part of queries meets every block of its group, and a block every part."""
        parted, blocked = _pick(parts, F.col("cell")), _pick(blocks, F.col("cell"))
        own = F.pmod(F.xxhash64("id", F.lit(asks)), parted if asks else blocked).cast("int")
        others = F.explode(F.sequence(F.lit(0), (blocked if asks else parted) - 1))
        return rows.select("id", "v", "cell", own.alias("own"), others.alias("other"), F.lit(asks).alias("asks")).select(
            "id", "v", "cell", F.col("own" if asks else "other").alias("part"), F.col("other" if asks else "own").alias("block"), "asks"
        )

    def solve(table: pa.Table) -> pa.Table:
        asks = table.column("asks").to_numpy()
        ids, v = table.column("id").to_numpy(), matrix(table.column("v").combine_chunks(), dimension)
        base = np.flatnonzero(~asks)
        base = base[np.argsort(ids[base], kind="stable")]
        found: list[tuple[list, list, list]] = []
        asking = np.flatnonzero(asks)
        for at in range(0, len(asking), 64):
            q = asking[at : at + 64]
            score = v[q] @ v[base].T
            score[ids[q][:, None] == ids[base][None, :]] = -np.inf
            found += [_best(i, ids[base], row, k) for i, row in zip(ids[q].tolist(), score, strict=True)]
        q, i, s = ([x for part in found for x in part[n]] for n in range(3))
        return pa.table({"query_id": pa.array(q, pa.int64()), "vec_id": pa.array(i, pa.int64()), "score": pa.array(s, pa.float64())})

    solved = (
        side(asked, True)
        .unionByName(side(sent, False))
        .groupBy("cell", "part", "block")
        .applyInArrow(solve, "query_id long, vec_id long, score double")
    )
    place = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return solved.withColumn("rank", place).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _best(query: int, ids: np.ndarray, score: np.ndarray, k: int) -> tuple[list, list, list]:
    """The k best of one query; ids ascend, so a stable order breaks ties by id."""
    can = np.flatnonzero(score > -np.inf)
    if len(can) > k:
        can = can[score[can] >= np.partition(score[can], len(can) - k)[len(can) - k]]
    top = can[np.argsort(-score[can], kind="stable")][:k]
    return [query] * len(top), ids[top].tolist(), score[top].tolist()
