from __future__ import annotations

import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import shared_search
from tidemark.llm.shared_search import SharingDag, search, terms

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def cut(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def brute(docs, items, k):
    counted = [(i, Counter(cut(t))) for i, t in docs]
    counted = [(i, c) for i, c in counted if c]
    total, length = len(counted), sum(c.total() for _, c in counted)
    df = Counter(t for _, c in counted for t in c)
    out = []
    for item, text in set(items):
        found = []
        for i, c in counted:
            m = 25 + (75 * c.total() * total) // length
            score = sum(
                math.floor(1000 * math.log((2 * total + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m)) for t in cut(text) if t in c
            )
            if score > 0:
                found.append((score, i))
        found.sort(key=lambda x: (-x[0], x[1] is None, x[1] or 0))
        out += [(item, r, i, s) for r, (s, i) in enumerate(found[:k], 1)]
    return out


def order(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is not None, x if x is not None else 0) for x in r))


def corpus(seed, n, vocabulary=60):
    rng = random.Random(seed)
    words = [f"w{i}" for i in range(vocabulary)] + ["É", "é", "naïve", "X9", "日本", "K"]
    return [(i, " ".join(rng.choices(words, k=rng.choice([0, 1, 5, 40, 400]))) + rng.choice(["", ".", "\n", " z"])) for i in range(n)]


@pytest.mark.parametrize("blocks", [1000, 4])
def test_against_brute_force(spark, docs_of, blocks):
    docs = corpus(1, 300) + [(None, "w1 w2 w3"), (7, "w1 w2"), (7, "w1 w2"), (900, None), (901, "  ..,, \0 "), (902, "W1-w2\tw3'É" * 40_000)]
    items = [(i, t) for i, t in corpus(2, 12)] + [(50, None), (51, ""), (52, "nowhere"), (None, "w1 É"), (53, "w1 w1 w1 w2"), (53, "w1 w1 w1 w2"), (53, "w5")]
    table = spark.createDataFrame(items, "item_id long, text string").selectExpr("*", "1 as item", "2 as rank", "3 as score", "4 as doc_id")
    got = search(docs_of(docs).selectExpr("*", "0 as n", "1 as id", "2 as terms"), table, k=10, block_items=blocks)
    assert order(got.collect()) == order(brute(docs, items, 10))


def test_ties_and_empty_tables(spark, docs_of):
    docs = [(i, "same text here") for i in range(100, 0, -1)] + [(i, "other") for i in range(200, 230)]
    items = spark.createDataFrame([(1, "Same HERE")], "item_id long, text string")
    assert order(search(docs_of(docs), items, k=3).collect()) == order(brute(docs, [(1, "Same HERE")], 3))
    assert [r.doc_id for r in search(docs_of(docs), items, k=3).orderBy("rank").collect()] == [1, 2, 3]
    assert search(docs_of([]), items).count() == 0
    assert search(docs_of(docs), items.limit(0)).count() == 0


def test_sums_are_shared():
    rng = random.Random(4)
    common = [Counter(rng.sample(range(40), 12)) for _ in range(3)]
    items = [common[i % 3] + Counter(rng.sample(range(40, 200), 5)) for i in range(30)] + [Counter(), Counter({3: 2}), Counter({3: 2, 4: 1})]
    dag = SharingDag(items)
    columns = [np.array([t, t * t, 1], np.int64) for t in range(200)]
    found = dict(dag.evaluate(columns))
    for i, item in enumerate(items):
        if item:
            assert found[i].tolist() == sum(columns[t] * n for t, n in item.items()).tolist()
    assert set(found) == {i for i, item in enumerate(items) if item}
    plain = sum(max(0, len(i) - 1) for i in items)
    assert dag.additions < 0.5 * plain
    assert all(a < len(dag.leaves) + k and b < len(dag.leaves) + k for k, (a, b) in enumerate(dag.pairs))


def test_long_texts_come_in_pieces(monkeypatch):
    monkeypatch.setattr(shared_search, "_PIECE", 7)
    text = "Ab1 cd-éF  " * 50 + "end"
    assert [t.decode() for piece in terms(text) for t in piece] == cut(text)
    assert not any(piece for piece in terms(None)) and not any(piece for piece in terms("  .. "))
