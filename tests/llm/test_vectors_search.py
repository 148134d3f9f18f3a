from __future__ import annotations

import numpy as np
import pytest

from tidemark.llm.ann import build_index, kmeans, nearest
from tidemark.llm.topk import top_products


def table(spark, rows):
    return spark.createDataFrame(rows, "vec_id long, embedding array<float>").selectExpr("*", "1 as id", "2 as cell", "'v' as v")


def brute(rows, asks, k, score, descending):
    usable = {}
    for i, v in rows:
        if i is not None and v and all(x is not None and np.isfinite(x) for x in v):
            usable[i] = min(usable.get(i, v), v)
    out = []
    for q in sorted(usable):
        if asks(q):
            found = [(score(usable[q], usable[c]), c) for c in usable if c != q]
            found.sort(key=lambda x: (-x[0] if descending else x[0], x[1]))
            out += [(q, n, c, s) for n, (s, c) in enumerate(found[:k], 1)]
    return out


def whole_rows(rng, n):
    rows = [(i, [float(x) for x in rng.integers(-40, 40, 12)]) for i in range(n)]
    same = [3.0, -2.0] * 6
    rows += [(i, same) for i in range(n, n + n // 2)]  # a third of the rows are one vector
    rows += [(n * 2 + i, [0.0] * 12) for i in range(3)]
    rows += [(900001, None), (900002, [1.0, None] * 6), (900003, [float("nan")] * 12), (900004, [float("inf")] * 12), (None, same), (900005, [])]
    return rows + [rows[5], (rows[6][0], [9.0] * 12)]


@pytest.mark.parametrize("shape", [{}, {"pivots": 9, "block": 37, "group": 8}])
def test_top_products_against_brute_force(spark, shape):
    rows = whole_rows(np.random.default_rng(1), 200)
    vectors = table(spark, rows)
    got = top_products(vectors, vectors.where("vec_id % 5 = 0"), 7, **shape).collect()
    want = brute(rows, lambda q: q % 5 == 0, 7, lambda a, b: float(np.dot(a, b)), True)
    assert sorted(tuple(r) for r in got) == want


def test_far_cells_are_not_sent(spark, monkeypatch):
    """Clusters far apart: a group's vectors are replicated to the groups that need them only."""
    from tidemark.llm import topk

    seen = {}
    keep = topk.written
    monkeypatch.setattr(topk, "written", lambda df, name: seen.setdefault(name, keep(df, name)))
    rng = np.random.default_rng(2)
    centres = 1000 * np.eye(8)
    rows = [(i, [float(x) for x in np.round(centres[i % 8] + rng.normal(0, 5, 8))]) for i in range(800)]
    vectors = table(spark, rows)
    got = top_products(vectors, vectors.where("vec_id % 20 = 0"), 3, pivots=64, group=1).collect()
    assert sorted(tuple(r) for r in got) == brute(rows, lambda q: q % 20 == 0, 3, lambda a, b: float(np.dot(a, b)), True)
    groups = seen["topk-queries"].select("cell").distinct().count()
    assert seen["topk-sent"].count() < 0.6 * 800 * groups


def test_few_or_no_candidates(spark):
    assert top_products(table(spark, []), table(spark, []), 5).count() == 0
    one = table(spark, [(0, [1.0])])
    assert top_products(one, one, 5).count() == 0
    three = table(spark, [(0, [1.0]), (1, [2.0]), (2, [2.0])])
    assert [tuple(r) for r in top_products(three, three.where("vec_id = 0"), 5).collect()] == [(0, 1, 1, 2.0), (0, 2, 2, 2.0)]


def test_index_with_all_entries_is_exact(spark):
    rows = [r for r in whole_rows(np.random.default_rng(3), 150) if not (r[1] and r[1] == [0.0] * 12)]
    vectors = table(spark, rows).unionByName(table(spark, [(70, [0.0] * 12), (999, [0.0] * 12)]))
    index = build_index(vectors, centroids=6)
    got = nearest(index, vectors.where("vec_id % 5 = 0"), 6, share=1.0, block=40, part=9).collect()
    want = brute(rows, lambda q: q % 5 == 0, 6, lambda a, b: float(np.sqrt(((np.array(a) - np.array(b)) ** 2).sum())), False)
    assert sorted(tuple(r) for r in got) == want


def test_traversal_is_by_ascending_sums(spark):
    rng = np.random.default_rng(4)
    vectors = table(spark, [(i, [float(x) for x in rng.normal(size=6)]) for i in range(300)])
    index = build_index(vectors, centroids=5)
    query = rng.normal(size=6)
    pairs = index.traverse(query, 10**9)
    d = lambda a, b: ((query[:3] - index.first[a]) ** 2).sum() + ((query[3:] - index.second[b]) ** 2).sum()
    sums = [d(a, b) for a, b in pairs]
    assert sums == sorted(sums) and sum(index.counts[a, b] for a, b in pairs) == 300 == index.counts.sum()
    few = index.traverse(query, 50)
    assert few == pairs[: len(few)] and sum(index.counts[a, b] for a, b in few[:-1]) < 50


def test_recall_on_the_given_vectors(spark):
    vectors = spark.read.parquet("/root/testdata/sf0.1/embeddings.parquet")
    asks = vectors.where("vec_id % 100 = 0")
    index = build_index(vectors)
    found = {(r.query_id, r.vec_id) for r in nearest(index, asks, 10).collect()}
    rows = {r.vec_id: np.array(r.embedding) for r in vectors.collect()}
    ids = np.array(sorted(rows))
    base = np.stack([rows[i] for i in ids])
    hit = total = 0
    for q in ids[ids % 100 == 0]:
        far = ((base - rows[q]) ** 2).sum(axis=1)
        far[ids == q] = np.inf
        best = ids[np.lexsort((ids, far))[:10]]
        hit += sum((q, b) in found for b in best)
        total += 10
    assert hit / total >= 0.95, hit / total


def test_empty_index(spark):
    empty = table(spark, [])
    assert build_index(empty) is None
    assert nearest(build_index(empty), empty, 3).count() == 0
    assert len(kmeans(np.ones((5, 2)), 3)) == 1
