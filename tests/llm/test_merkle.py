from __future__ import annotations

import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from tidemark.llm import merkle


def h(parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row):
    return h(["-" if v is None else f"{len(str(v).encode())}:{v}" for v in row])


def tree(digests):
    """All levels, leaves first."""
    levels = [digests]
    while len(levels[-1]) > 1:
        now = levels[-1]
        levels.append([h(now[i : i + 3]) for i in range(0, len(now), 3)])
    return levels


def proof(levels, i):
    out = []
    for now in levels[:-1]:
        first = i // 3 * 3
        out.append((now[first:i], now[i + 1 : first + 3]))
        i //= 3
    return out


def cut(row):
    even = row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0
    return (*row[:4], row[4].replace("\n", "")) if even and row[4] is not None else row


def brute(rows):
    sources = {}
    for r in rows:
        sources.setdefault(r[1], []).append(r)
    if not rows:
        return []
    names = sorted(sources, key=lambda s: (s is not None, (s or "").encode()))
    for s in names:
        sources[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
    trees = {s: tree([leaf(r) for r in sources[s]]) for s in names}
    top = tree([trees[s][-1][0] for s in names])
    root, out = top[-1][0], []
    for k, s in enumerate(names):
        for i, r in enumerate(sources[s]):
            steps = proof(trees[s], i) + proof(top, k)
            folded = leaf(cut(r))
            for left, right in steps:
                folded = h([*left, folded, *right])
            out.append((r[0], leaf(r), trees[s][-1][0], root, h([d for a, b in steps for d in a + b]), folded, folded == root))
    return out


def run(spark, rows, partitions=3):
    docs = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars int, text string")
    docs = docs.repartition(partitions).selectExpr("*", "1 as tree", "2 as idx", "3 as digest", "4 as row", "5 as n", "6 as path", "7 as id")
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    return merkle.manifest(docs, tampered, F.replace("text", F.lit("\n"), F.lit("")))


def order(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is not None, x if x is not None else 0) for x in r))


def test_against_brute_force(spark):
    """Trees of one, two, three and four levels, and one of two segments."""
    rng = random.Random(5)
    sizes = {"a": 1, "B": 2, "é": 3, "": 4, None: 28, "hot": 800, "z z": 10, "q": 9}
    rows = [
        (i * 10 + k, s, rng.choice(["en", None]), rng.choice([None, i]), rng.choice([None, "", "x\ny", "ü\n\n", "plain", f"{i}\n"]))
        for k, (s, n) in enumerate(sizes.items()) for i in range(n)
    ]
    rows += [(None, "a", None, None, None), (None, "hot", "en", 1, "x\n"), (30, "é", "en", 1, "x\n" * 100_000)]
    rng.shuffle(rows)
    got = run(spark, rows).collect()
    assert order(got) == order(brute(rows))
    assert {r.verified for r in got} == {True, False}


def test_repeated_rows_are_leaves_of_their_own(spark):
    rows = [(1, "s", "en", 1, "a\nb")] * 5 + [(2, "s", "en", 1, "c")] * 2
    assert order(run(spark, rows).collect()) == order(brute(rows))


@pytest.mark.parametrize("n", [0, 1, 2])
def test_few_rows(spark, n):
    rows = [(i, f"s{i}", "en", 1, "t\n") for i in range(n)]
    assert order(run(spark, rows).collect()) == order(brute(rows))


def test_reruns_agree(spark):
    rows = [(i % 40, f"s{i % 3}", "en", i % 2, f"t{i % 5}\n") for i in range(200)]
    assert order(run(spark, rows, 2).collect()) == order(run(spark, rows, 7).collect())


def test_leaves_are_numbered_over_partitions(spark, monkeypatch):
    monkeypatch.setattr(merkle, "RANGE", 16)
    rows = [(i, f"s{i % 11}" if i % 4 else "hot", "en", i, f"t{i}\n") for i in range(150)]
    leaves = spark.createDataFrame(rows, "doc_id long, source string, lang string, n_chars int, text string")
    numbered = merkle.numbered(leaves.selectExpr("source as tree", "doc_id as id"), ["id"])
    for r in numbered.groupBy("tree").agg(F.sort_array(F.collect_list("idx")).alias("idx"), F.max("n").alias("n")).collect():
        assert r.idx == list(range(r.n))
    ordered = [r.id for r in numbered.where("tree = 'hot'").orderBy("idx").collect()]
    assert ordered == sorted(ordered)


def test_records_are_addressed_by_content(spark):
    rows = [(t, i, 27, f"{i:064x}") for t in ("x", "y") for i in range(27)]
    leaves = spark.createDataFrame(rows, "tree string, idx long, n long, digest string")
    roots, records = merkle.build(leaves, 27)
    assert len(records) == 1 and records[0].count() == 1
    want = tree([f"{i:064x}" for i in range(27)])[-1][0]
    assert {(r.tree, r.digest) for r in roots.collect()} == {("x", want), ("y", want)}
    [record] = records[0].collect()
    assert record.levels == 3 and all(h(c.parts) == c.digest for c in record.children)


def test_two_rounds_of_segments(spark):
    """Over 729 segments: requests descend through two tables of records."""
    n = 729 * 3 + 5
    rows = [(i, "s", None, None, "a\n" if i % 7 else None) for i in range(n)]
    assert order(run(spark, rows).collect()) == order(brute(rows))
