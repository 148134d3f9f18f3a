"""A stored index for exact nearest neighbours: vectors lie in cells, and cells that provably hold no neighbour are not read.

A cell is a pivot with the vectors nearest to it.  Its centre, radius and number of vectors bound what it can hold: by
the triangle inequality no vector of it is nearer to a query than the distance to the centre less the radius.  A search reads the
cells nearest to each query first; the k-th distance found there rules out all cells whose bound is larger, whatever the vectors
are.  Only the files of the cells that remain are read then.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidemark.session import ensure_checkpoint_dir

METRICS = ("cosine", "l2", "ip")
#: Vectors of a cell on average, and the most cells of an entity type: its summaries are held by the driver.
CELL_ROWS, MOST_CELLS = 4_096, 4_096
#: Queries that are searched at a time.
BLOCK = 4_096
#: Vectors, and bytes of them, that pivots are chosen from.
SAMPLE_PER_CELL, SAMPLE_BYTES = 32, 1 << 27


def distances(queries: np.ndarray, base: np.ndarray, metric: str) -> np.ndarray:
    """Queries in rows, base vectors in columns; smaller is nearer.  ``ip`` is the negated product."""
    products = queries @ base.T
    if metric == "ip":
        return -products
    q2 = np.einsum("ij,ij->i", queries, queries)[:, None]
    b2 = np.einsum("ij,ij->i", base, base)[None, :]
    if metric == "l2":
        return np.sqrt(np.maximum(q2 + b2 - 2.0 * products, 0.0))
    with np.errstate(divide="ignore", invalid="ignore"):
        return 1.0 - products / np.sqrt(q2 * b2)


def best(
    qids: np.ndarray, queries: np.ndarray, ids: np.ndarray, base: np.ndarray, k: int, metric: str, digits: int | None
) -> pd.DataFrame:
    """The k nearest of one batch per query, by full distances; equal ones are ordered by id."""
    d = distances(queries, base, metric)
    if digits is not None:
        d = np.round(d, digits)
    qi, bi, dist = [np.zeros(0, np.int64)], [np.zeros(0, np.int64)], [np.zeros(0)]
    for q in range(len(qids)):
        usable = np.flatnonzero(~np.isnan(d[q]))
        if len(usable) > k:
            limit = np.partition(d[q][usable], k - 1)[k - 1]
            usable = usable[d[q][usable] <= limit]
        order = usable[np.lexsort((ids[usable], d[q][usable]))[:k]]
        qi.append(np.repeat(q, len(order)))
        bi.append(order)
        dist.append(d[q][order])
    qi, bi = np.concatenate(qi), np.concatenate(bi)
    return pd.DataFrame({"query_id": qids[qi], "neighbor_id": ids[bi], "distance": np.concatenate(dist)})


def by_length(batch: pa.RecordBatch) -> Iterator[tuple[int, pa.RecordBatch, np.ndarray]]:
    """(length, rows, matrix of ``vec``) of an Arrow batch, without a Python object per component."""
    lengths = pc.list_value_length(batch.column("vec"))
    for dim in pc.unique(lengths).to_pylist():
        part = batch.filter(pc.equal(lengths, dim))
        flat = part.column("vec").flatten().to_numpy(zero_copy_only=False)
        yield dim, part, flat.astype(np.float64, copy=False).reshape(part.num_rows, dim)


def _unit(vectors: np.ndarray) -> np.ndarray:
    with np.errstate(divide="ignore", invalid="ignore"):
        return vectors / np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None]


def _pivots(sample: np.ndarray, cells: int) -> np.ndarray:
    """Centres of the sample by a few rounds of k-means.  Any points would do: they decide only how much is skipped."""
    rng = np.random.default_rng(11)
    centres = sample[rng.choice(len(sample), min(cells, len(sample)), replace=False)]
    for _ in range(6):
        nearest = np.concatenate([distances(sample[i : i + 4096], centres, "l2").argmin(axis=1) for i in range(0, len(sample), 4096)])
        sums = np.zeros_like(centres)
        np.add.at(sums, nearest, sample)
        counts = np.bincount(nearest, minlength=len(centres))
        centres = np.where(counts[:, None] > 0, sums / np.maximum(counts, 1)[:, None], centres)
    return centres


def _assign(pivots: dict[int, np.ndarray], first: dict[int, int], unit: bool):
    """Cell and distance to its pivot of every vector; vectors that have no distance to anything are left out."""

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for dim, part, vectors in by_length(batch):
                if unit:
                    vectors = _unit(vectors)
                usable = np.isfinite(vectors).all(axis=1)
                if dim not in pivots or not usable.any():
                    continue
                part, vectors = part.filter(pa.array(usable)), vectors[usable]
                centres = pivots[dim]
                cell = np.concatenate([distances(vectors[i : i + 1024], centres, "l2").argmin(axis=1) for i in range(0, len(vectors), 1024)])
                away = np.sqrt(((vectors - centres[cell]) ** 2).sum(axis=1))
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(cell + first[dim], pa.int32()), pa.array(away)], names=[*part.schema.names, "cell", "away"]
                )

    return assign


def build_vector_index(
    base: DataFrame,
    path: str,
    id_col: str,
    vec_col: str,
    metric: str = "cosine",
    kind_col: str | None = None,
    cell_rows: int = CELL_ROWS,
) -> VectorIndex:
    """Write the vectors of ``base`` by entity type (``kind_col``) and cell under ``path``, with a summary of each cell.

    ``cosine`` cells are cut among unit vectors; ``l2`` and ``ip`` share an index over the vectors as they are.  Rows without id, type or vector, or
    with null or non-finite components, are in no index, and zero vectors in none for cosine: they have no distance.
    Lengths may differ; a search meets vectors of its own length.  A dense cell is written by several tasks.
    """
    if metric not in METRICS:
        raise ValueError(f"metric must be one of {METRICS}")
    spark, unit = base.sparkSession, metric == "cosine"
    kind = F.col(kind_col).cast("string") if kind_col else F.lit("all")
    rows = base.select(kind.alias("kind"), F.col(id_col).alias("id"), F.col(vec_col).alias("vec")).where(
        "kind IS NOT NULL AND id IS NOT NULL AND size(vec) > 0"
    )
    counts = {r["dim"]: r["count"] for r in rows.groupBy(F.size("vec").alias("dim")).count().collect()}
    pivots, first, at = {}, {}, 0
    for dim, n in sorted(counts.items()):
        cells = max(1, min(MOST_CELLS, n // cell_rows))
        most = max(cells, min(cells * SAMPLE_PER_CELL, SAMPLE_BYTES // (8 * dim)))
        chance = F.pmod(F.xxhash64("id"), F.lit(1 << 20)) < (min(1 << 20, (most << 20) // n + 1))
        found = rows.where((F.size("vec") == dim) & chance).select("vec").limit(2 * most).toArrow()
        sample = [m for part in found.combine_chunks().to_batches() for _, _, m in by_length(part)]
        sample = _unit(np.concatenate(sample)) if sample and unit else np.concatenate(sample) if sample else np.zeros((0, dim))
        sample = sample[np.isfinite(sample).all(axis=1)]
        pivots[dim] = _pivots(sample, cells) if len(sample) else np.zeros((1, dim))
        first[dim], at = at, at + len(pivots[dim])
    placed = rows.mapInArrow(_assign(pivots, first, unit), T.StructType([*rows.schema, T.StructField("cell", T.IntegerType()), T.StructField("away", T.DoubleType())]))
    placed.hint("rebalance", "kind", "cell").write.mode("overwrite").partitionBy("kind", "cell").parquet(f"{path}/vectors")
    stored = placed.select("id", "vec", "away", "kind", "cell").schema
    vectors = spark.read.schema(stored).parquet(f"{path}/vectors")
    centres = [(first[d] + i, d, c.tolist()) for d, p in pivots.items() for i, c in enumerate(p)]
    summary = vectors.groupBy("kind", "cell").agg(F.count("*").alias("n"), F.max("away").alias("radius"))
    named = spark.createDataFrame(centres, "cell int, dim int, centre array<double>")
    summary.join(named, "cell").write.mode("overwrite").parquet(f"{path}/cells")
    spark.createDataFrame([(unit, stored.json())], "unit boolean, stored string").write.mode("overwrite").parquet(f"{path}/about")
    return VectorIndex(spark, path, unit, stored)


def open_vector_index(spark: SparkSession, path: str) -> VectorIndex:
    """An index that was written before."""
    about = spark.read.parquet(f"{path}/about").first()
    return VectorIndex(spark, path, about["unit"], T.StructType.fromJson(json.loads(about["stored"])))


@dataclass
class VectorIndex:
    """A written index; ``unit`` where its cells are cut among unit vectors."""

    spark: SparkSession
    path: str
    unit: bool
    stored: T.StructType
    scanned: list[tuple[int, int]] = field(default_factory=list)
    """For each block of queries that was searched: pairs of a query and a cell that were read, and all there are."""

    def _vectors(self) -> DataFrame:
        return self.spark.read.schema(self.stored).parquet(f"{self.path}/vectors")

    def cells(self, kinds: list[str] | None = None) -> DataFrame:
        cells = self.spark.read.parquet(f"{self.path}/cells")
        return cells if kinds is None else cells.where(F.col("kind").isin([str(x) for x in kinds]))

    def search(
        self,
        queries: DataFrame,
        query_id: str,
        query_vec: str,
        k: int = 10,
        metric: str = "cosine",
        kinds: list[str] | None = None,
        digits: int | None = None,
        block: int = BLOCK,
    ) -> DataFrame:
        """``query_id, neighbor_id, distance, rank``: the exact k nearest vectors of every query, of the entity types ``kinds`` (all).

        Queries are searched in blocks of about ``block``; a block and its k results a query are all that the driver holds.  Queries
        without id or vector have no answer.  ``digits`` rounds distances before they are ranked.
        """
        if metric not in METRICS or self.unit != (metric == "cosine"):
            raise ValueError(f"an index of {'unit' if self.unit else 'plain'} vectors does not serve {metric!r}")
        asked = queries.select(F.col(query_id).alias("id"), F.col(query_vec).alias("vec")).where("id IS NOT NULL AND vec IS NOT NULL")
        out_schema = T.StructType(
            [
                T.StructField("query_id", queries.schema[query_id].dataType),
                T.StructField("neighbor_id", self.stored["id"].dataType),
                T.StructField("distance", T.DoubleType()),
            ]
        )
        cells = self.cells(kinds).toPandas()
        block = max(1, block)  # a limit of no queries at all still searches them, one at a time
        head = asked.limit(block + 1).toArrow()
        if head.num_rows <= block:
            return self._search_block(head, cells, k, metric, digits, out_schema)
        # Many queries: written once, cut into blocks by their hash, and every block's answers written before the next.
        scratch = f"{ensure_checkpoint_dir(self.spark)}/tidemark/search-{uuid.uuid4().hex}"
        asked.write.parquet(f"{scratch}/queries")
        asked = self.spark.read.parquet(f"{scratch}/queries")
        blocks = -(-asked.count() // block)
        for number in range(blocks):
            part = asked.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == number).toArrow()
            self._search_block(part, cells, k, metric, digits, out_schema).write.mode("append").parquet(f"{scratch}/found")
        return self.spark.read.parquet(f"{scratch}/found")

    def _search_block(self, asked: pa.Table, cells: pd.DataFrame, k: int, metric: str, digits: int | None, schema: T.StructType) -> DataFrame:
        nearest = Window.partitionBy("query_id").orderBy("distance", "neighbor_id")

        def ranked(found: DataFrame) -> DataFrame:
            # The rank filter is applied before the shuffle as well (WindowGroupLimit).
            return found.withColumn("rank", F.row_number().over(nearest)).where(F.col("rank") <= k)

        near, bounds = [], []
        for batch in asked.combine_chunks().to_batches():
            for dim, part, vectors in by_length(batch):
                own = cells[cells["dim"] == dim]
                usable = np.isfinite(_unit(vectors) if self.unit else vectors).all(axis=1)
                if not len(own) or not usable.any():
                    continue
                vectors, ids = vectors[usable], part.column("id").to_numpy(zero_copy_only=False)[usable]
                away, lower = self._bounds(vectors, own, metric)
                order = np.argsort(away, axis=1, kind="stable")
                held = np.cumsum(own["n"].to_numpy()[order], axis=1)
                # The nearest cells until k vectors lie in them.
                first = np.zeros_like(away, dtype=bool)
                np.put_along_axis(first, order, np.concatenate([np.zeros((len(ids), 1), np.int64), held[:, :-1]], axis=1) < k, axis=1)
                near.append((dim, ids, vectors, own, first))
                bounds.append(lower)
        found = ranked(self._scan(near, k, metric, digits, schema)).drop("rank").toArrow()
        kth = found.group_by("query_id").aggregate([("distance", "max"), ("distance", "count")]).to_pydict()
        limit = {q: d for q, d, n in zip(kth["query_id"], kth["distance_max"], kth["distance_count"], strict=True) if n >= k}
        rest, pairs = [], [0, 0]
        for (dim, ids, vectors, own, first), lower in zip(near, bounds, strict=True):
            least = np.array([limit.get(q, np.inf) for q in ids.tolist()])
            # Distances are rounded, by arithmetic and by ``digits``: a bound must be clearly larger to rule a cell out.
            slack = 1e-9 * (1 + np.where(np.isfinite(least), np.abs(least), 0)) + (0 if digits is None else 10.0**-digits)
            open_ = (lower <= (least + slack)[:, None]) & ~first
            rest.append((dim, ids, vectors, own, open_))
            pairs[0] += int(first.sum() + open_.sum())
            pairs[1] += first.size
        self.scanned.append((pairs[0], pairs[1]))
        local = self.spark.createDataFrame(found, schema)
        return ranked(local.unionByName(self._scan(rest, k, metric, digits, schema)))

    def _bounds(self, vectors: np.ndarray, cells: pd.DataFrame, metric: str) -> tuple[np.ndarray, np.ndarray]:
        """For queries in rows and cells in columns: how far the centre is, and what no vector of the cell is nearer than."""
        centres, radius = np.array(cells["centre"].to_list(), np.float64), cells["radius"].to_numpy()[None, :]
        if metric == "ip":
            products = distances(vectors, centres, "ip")
            reach = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))[:, None] * radius
            least = products - reach - 1e-9 * (1 + np.abs(products) + reach)
            return least, least
        away = distances(_unit(vectors) if self.unit else vectors, centres, "l2")
        # The expanded square root is good to about 1e-7 where vectors nearly meet.
        least = np.maximum(away - radius - 1e-6 * (1 + away), 0.0)
        return away, least**2 / 2 if metric == "cosine" else least

    def _scan(self, blocks: list, k: int, metric: str, digits: int | None, schema: T.StructType) -> DataFrame:
        """The k nearest of each query in the cells that it asks for, task by task; no other cell's files are read."""
        wanted: dict[tuple[str, int], tuple[np.ndarray, np.ndarray]] = {}
        for _, ids, vectors, own, asks in blocks:
            for column, (kind, cell) in enumerate(zip(own["kind"], own["cell"], strict=True)):
                who = np.flatnonzero(asks[:, column])
                if len(who):
                    wanted[kind, int(cell)] = ids[who], vectors[who]
        kinds: dict[str, list[int]] = {}
        for kind, cell in wanted:
            kinds.setdefault(kind, []).append(cell)
        chosen = F.lit(False)
        for kind, numbers in kinds.items():
            chosen = chosen | ((F.col("kind") == kind) & F.col("cell").isin(numbers))
        shared = self.spark.sparkContext.broadcast(wanted)

        def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held: pd.DataFrame | None = None
            for batch in batches:
                keys = list(zip(batch.column("kind").to_pylist(), batch.column("cell").to_pylist(), strict=True))
                starts = [i for i in range(len(keys)) if i == 0 or keys[i] != keys[i - 1]]
                for a, b in zip(starts, [*starts[1:], len(keys)], strict=True):
                    qids, queries = shared.value[keys[a]]
                    for _, part, vectors in by_length(batch.slice(a, b - a)):
                        found = best(qids, queries, part.column("id").to_numpy(zero_copy_only=False), vectors, k, metric, digits)
                        if held is not None:
                            found = pd.concat([held, found]).sort_values(["query_id", "distance", "neighbor_id"])
                            found = found.groupby("query_id", sort=False).head(k)
                        held = found
            if held is not None:
                yield pa.RecordBatch.from_pandas(held, preserve_index=False)

        return self._vectors().where(chosen).select("kind", "cell", "id", "vec").mapInArrow(scan, schema)
