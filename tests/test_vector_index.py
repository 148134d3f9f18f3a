from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from tidemark.operators import embeddings as emb
from tidemark.operators.vector_index import build_vector_index, open_vector_index


def frame(spark, ids, vectors, **columns):
    return spark.createDataFrame(pd.DataFrame({"id": ids, "v": list(vectors), **columns}))


def answers(df):
    return sorted((r.query_id, r["rank"], r.neighbor_id, round(r.distance, 9)) for r in df.collect())


@pytest.mark.parametrize("metric", ["cosine", "l2", "ip"])
def test_equal_to_the_full_scan_on_arbitrary_vectors(spark, tmp_path, metric):
    rng = np.random.default_rng(1)
    vectors = rng.normal(size=(700, 6)) * rng.exponential(size=(700, 1))
    vectors[50:80] = vectors[50]  # ties, and a cell without extent
    base = frame(spark, range(700), vectors).repartition(4).unionByName(
        spark.createDataFrame([(900, None), (901, [1.0, 2.0]), (902, [0.0] * 6), (903, [float("nan")] * 6), (None, [1.0] * 6)], "id long, v array<double>")
    )
    asked = frame(spark, range(40), np.concatenate([rng.normal(size=(38, 6)), vectors[50:51], np.zeros((1, 6))])).unionByName(
        spark.createDataFrame([(100, [3.0, 1.0]), (101, None), (102, [1.0])], "id long, v array<double>")
    )
    index = build_vector_index(base, str(tmp_path / "i"), "id", "v", metric, cell_rows=40)
    want = answers(emb.knn(asked, base, "id", "v", "id", "v", 7, metric, digits=9))
    assert answers(index.search(asked, "id", "v", 7, metric, digits=9)) == want
    assert answers(open_vector_index(spark, str(tmp_path / "i")).search(asked, "id", "v", 7, metric, digits=9, block=9)) == want
    with pytest.raises(ValueError):
        index.search(asked, "id", "v", 7, "l2" if metric == "cosine" else "cosine")


@pytest.mark.parametrize("metric", ["cosine", "l2"])
def test_clustered_vectors_read_few_cells(spark, tmp_path, metric):
    rng = np.random.default_rng(2)
    middles = rng.normal(size=(30, 16)) * 10
    vectors = np.concatenate([m + rng.normal(size=(60, 16)) * 0.1 for m in middles])
    base = frame(spark, range(len(vectors)), vectors)
    asked = frame(spark, range(30), middles + 0.05)
    index = build_vector_index(base, str(tmp_path / "i"), "id", "v", metric, cell_rows=40)
    found = index.search(asked, "id", "v", 5, metric, digits=9)
    assert answers(found) == answers(emb.knn(asked, base, "id", "v", "id", "v", 5, metric, digits=9))
    [(read, there)] = index.scanned
    assert there == 30 * index.cells().count() and read < there / 3


def test_only_wanted_types_and_cells_are_read(spark, tmp_path):
    """Files of other entity types and of cells that no query needs are no part of the scan."""
    rng = np.random.default_rng(3)
    kinds = ["01", "2024-01-01", "b"]
    vectors = np.concatenate([rng.normal(size=(40, 4)) + 100 * i for i in range(6)])
    base = frame(spark, range(240), vectors, kind=[kinds[i % 3] for i in range(240)])
    index = build_vector_index(base, str(tmp_path / "i"), "id", "v", "l2", "kind", cell_rows=30)
    asked = frame(spark, [1], vectors[:1])
    found = index.search(asked, "id", "v", 3, "l2", kinds=["01"])
    assert {r.neighbor_id % 3 for r in found.collect()} == {0}
    want = emb.knn(asked, base, "id", "v", "id", "v", 3, "l2", where=F.col("kind") == "01")
    assert answers(found) == answers(want)
    [(read, there)] = index.scanned
    assert there == index.cells(["01"]).count() < index.cells().count() and read < there


def test_bounds_hold_every_vector(spark, tmp_path):
    """A cell's summary: its count, and a radius that no vector of it exceeds."""
    rng = np.random.default_rng(4)
    base = frame(spark, range(300), rng.normal(size=(300, 5)))
    index = build_vector_index(base, str(tmp_path / "i"), "id", "v", "l2", cell_rows=50)
    cells = {r.cell: r for r in index.cells().collect()}
    stored = spark.read.parquet(str(tmp_path / "i" / "vectors")).collect()
    assert sum(c.n for c in cells.values()) == len(stored) == 300
    for r in stored:
        away = np.linalg.norm(np.array(r.vec) - np.array(cells[r.cell].centre))
        assert away <= cells[r.cell].radius + 1e-9


def test_empty_base(spark, tmp_path):
    base = spark.createDataFrame([], "id long, v array<float>")
    index = build_vector_index(base, str(tmp_path / "i"), "id", "v")
    asked = spark.createDataFrame([(1, [1.0])], "id long, v array<float>")
    assert index.search(asked, "id", "v").count() == 0
