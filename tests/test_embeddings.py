from __future__ import annotations

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import Observation
from pyspark.sql import functions as F

from tidemark.operators import embeddings as emb


def test_normalize_edge_vectors(spark):
    df = spark.createDataFrame([(1, [3.0, 4.0]), (2, None), (3, []), (4, [0.0, 0.0])], "id int, v array<float>")
    got = {r.id: r.v for r in emb.normalize_embedding(df, "v").collect()}
    assert got[1] == pytest.approx([0.6, 0.8]) and got[2] is None and got[3] == [] and got[4] == [0.0, 0.0]
    assert emb.normalize_embedding(df, "v", "u").columns == ["id", "v", "u"]


def test_dot_product_edges(spark):
    df = spark.createDataFrame(
        [([1.0, 2.0], [3.0, 4.0]), ([1.0], [1.0, 2.0]), (None, [1.0])], "a array<float>, b array<float>"
    )
    assert [r.dot_product for r in emb.embedding_dot_product(df, "a", "b").collect()] == [11.0, 0.0, 0.0]
    assert dict(emb.embedding_dot_product(df, "a", "b").dtypes)["dot_product"] == "float"


def test_dimension_filter_counts_drops(spark):
    df = spark.createDataFrame([([1.0, 2.0],), ([1.0],), (None,)], "v array<float>")
    seen = Observation("dims")
    assert emb.validate_embedding_dim(df, "v", 2, seen).count() == 1
    assert seen.get["dropped"] == 2


def test_no_row_by_row_python_in_vector_functions(spark):
    df = spark.createDataFrame([([1.0, 2.0], [1.0, 2.0])], "a array<float>, b array<float>")
    plan = emb.embedding_dot_product(df, "a", "b")._jdf.queryExecution().toString()
    assert "Python" not in plan.replace("PythonRDD", "")
    plan = emb.normalize_embedding(df, "a")._jdf.queryExecution().executedPlan().toString()
    assert "ArrowEvalPython" in plan and "BatchEvalPython" not in plan


def test_normalize_many_vectors(spark):
    rng = np.random.default_rng(1)
    rows = [(i, None if i % 7 == 0 else [float(x) for x in rng.normal(size=i % 5)]) for i in range(300)] + [(999, [3.0, None, 4.0])]
    df = spark.createDataFrame(rows, "id int, v array<double>").repartition(3)
    for r, (_, v) in zip(emb.normalize_embedding(df, "v", "u").orderBy("id").collect(), rows):
        if not v or None in v:
            assert r.u == v
        else:
            assert r.u == pytest.approx(np.array(v) / np.linalg.norm(v), rel=1e-6)


@pytest.fixture(scope="module")
def vectors():
    rng = np.random.default_rng(3)
    return rng.normal(size=(60, 8)), rng.normal(size=(7, 8))


def brute(base, queries, metric, k):
    out = {}
    for qi, q in enumerate(queries):
        if metric == "ip":
            d = -(base @ q)
        elif metric == "l2":
            d = np.linalg.norm(base - q, axis=1)
        else:
            d = 1 - (base @ q) / (np.linalg.norm(base, axis=1) * np.linalg.norm(q))
        out[qi] = list(np.lexsort((np.arange(len(base)), np.round(d, 9)))[:k])
    return out


@pytest.mark.parametrize("metric", ["cosine", "l2", "ip"])
@pytest.mark.parametrize("limit", [4096, 3], ids=["broadcast", "index"])
def test_knn_matches_brute_force(spark, vectors, metric, limit):
    base, queries = vectors
    b = spark.createDataFrame(pd.DataFrame({"id": range(len(base)), "v": list(base)})).repartition(5)
    b = b.unionByName(spark.createDataFrame([(900, None), (901, [1.0])], "id long, v array<double>"))
    q = spark.createDataFrame(pd.DataFrame({"qid": range(len(queries)), "v": list(queries)}))
    found = emb.knn(q, b, "qid", "v", "id", "v", 5, metric, max_broadcast_queries=limit)
    got = {}
    for r in found.orderBy("query_id", "rank").collect():
        got.setdefault(r.query_id, []).append(r.neighbor_id)
    assert got == brute(base, queries, metric, 5)


def test_knn_filter_and_min_score(spark, vectors):
    base, queries = vectors
    b = spark.createDataFrame(pd.DataFrame({"id": range(len(base)), "v": list(base), "kind": ["a", "b"] * 30}))
    q = spark.createDataFrame(pd.DataFrame({"qid": [0], "v": [queries[0]]}))
    rows = emb.knn(q, b, "qid", "v", "id", "v", 3, where=F.col("kind") == "a").collect()
    assert len(rows) == 3 and all(r.neighbor_id % 2 == 0 for r in rows)
    rows = emb.knn(q, b, "qid", "v", "id", "v", 60, min_score=0.2).collect()
    assert rows and all(1 - r.distance >= 0.2 for r in rows)
    with pytest.raises(ValueError):
        emb.knn(q, b, "qid", "v", "id", "v", metric="dice")


def test_zero_vectors_have_no_cosine(spark):
    b = spark.createDataFrame([(1, [0.0, 0.0]), (2, [1.0, 0.0])], "id long, v array<double>")
    q = spark.createDataFrame([(0, [1.0, 0.0])], "qid long, v array<double>")
    assert [r.neighbor_id for r in emb.knn(q, b, "qid", "v", "id", "v", 5).collect()] == [2]
