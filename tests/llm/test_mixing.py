from __future__ import annotations

import hashlib
import random
import re
from collections import defaultdict

from pyspark.sql import functions as F

from tidemark.llm.mixing import SCHEDULES, mix_sources


def targets(sizes, epochs=3):
    """Share, stop, share the excess again, until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode()))
    weight = {s: i % 3 + 1 for i, s in enumerate(names)}
    total, fixed = sum(sizes.values()), {}
    while True:
        open_ = [s for s in names if s not in fixed]
        if not open_:
            return fixed
        rest = total - sum(fixed.values())
        share = {s: rest * weight[s] / sum(weight[x] for x in open_) for s in open_}
        over = [s for s in open_ if share[s] > epochs * sizes[s]]
        if not over:
            return fixed | share
        fixed |= {s: float(epochs * sizes[s]) for s in over}


def brute(rows):
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    sizes = defaultdict(int)
    for n, (_, _, s) in zip(size, rows):
        sizes[s] += n
    goal, out = targets(sizes), []
    for source in sizes:
        mine = [i for i, r in enumerate(rows) if r[2] == source]
        mine.sort(key=lambda i: (hashlib.md5(("" if rows[i][0] is None else str(rows[i][0])).encode()).hexdigest(), size[i]))
        at = 0
        for i in mine:
            room = [int(goal[source] - at - e * sizes[source]) for e in range(3)]
            out.append((rows[i][0], size[i], sizes[source], goal[source], sum(min(size[i], max(0, r)) for r in room)))
            at += size[i]
    return out


def rows_of(df):
    return [tuple(r) for r in df.select("doc_id", "mix_size", "mix_source_size", "mix_target", "mix_taken").collect()]


def order(rows):
    return sorted(rows, key=lambda r: tuple((x is None, x or 0) for x in r))


def test_against_brute_force(docs_of):
    rng = random.Random(1)
    rows = [
        (i, " ".join("w" for _ in range(rng.choice([0, 1, 5, 60, 900]))) or None, rng.choice(["a", "a", "a", "b", "é", "Z", None, ""]))
        for i in range(300)
    ] + [(7, "x y", "a")] * 3 + [(None, "p q r", "tiny"), (None, None, "empty")]
    mixed = mix_sources(docs_of([(i, t, "en", s) for i, t, s in rows]))
    got, want = order(rows_of(mixed)), order(brute(rows))
    assert [g[:3] for g in got] == [w[:3] for w in want]
    assert all(abs(g[3] - w[3]) < 1e-6 for g, w in zip(got, want))
    assert sum(abs(g[4] - w[4]) for g, w in zip(got, want)) <= 8
    assert all(g[4] <= 3 * g[1] for g in got)
    for one in mixed.groupBy("source").agg(F.sum("mix_taken").alias("n"), F.max("mix_target").alias("t")).collect():
        assert abs(one.n - one.t) <= 1
    first = [r.mix_positions[0] for r in mixed.collect() if r.mix_positions]
    assert first == sorted(first) and 0 <= first[0] and first[-1] <= 1


def test_positions_follow_the_schedules(spark):
    docs = spark.range(6000).selectExpr("id as doc_id", "'w' as text", "concat('s', id % 3) as source")
    mixed = mix_sources(docs).select("source", F.explode("mix_positions").alias("at"))
    early = {r.source: r.n for r in mixed.where("at < 0.5").groupBy("source").agg(F.count("*").alias("n")).collect()}
    total = {r.source: r.n for r in mixed.groupBy("source").agg(F.count("*").alias("n")).collect()}
    assert len(SCHEDULES) == 3
    for source, share in (("s0", 0.625), ("s1", 0.5), ("s2", 0.375)):
        assert abs(early[source] / total[source] - share) < 0.01


def test_whole_documents(docs_of):
    docs = docs_of([(i, "w " * (i % 7 + 1), "en", "ab"[i % 2]) for i in range(200)])
    for r in mix_sources(docs, whole=True).collect():
        assert r.mix_taken == r.mix_size * len(r.mix_positions)
    sums = mix_sources(docs, whole=True).groupBy("source").agg(F.sum("mix_taken").alias("n"), F.max("mix_target").alias("t"))
    assert all(abs(r.n - r.t) <= 7 for r in sums.collect())


def test_reruns_agree_and_empty(docs_of):
    docs = docs_of([(i, "w " * (i % 7), "en", "abc"[i % 3]) for i in range(100)])
    assert mix_sources(docs).collect() == mix_sources(docs.repartition(7)).collect()
    assert mix_sources(docs_of([])).count() == 0
    assert mix_sources(docs_of([(1, None), (2, "")])).select("mix_taken", "mix_positions").collect() == [(0, []), (0, [])]


def test_copies(docs_of):
    docs = docs_of([(i, "w " * (i % 7 + 1), "en", "ab"[i % 2]) for i in range(200)])
    rows = {r.doc_id: r.mix_positions for r in mix_sources(docs, whole=True).collect()}
    copies = mix_sources(docs, whole=True, copies=True).select("doc_id", "mix_position").collect()
    assert sorted((i, p) for i, ps in rows.items() for p in ps) == sorted(tuple(r) for r in copies)
    assert [r.mix_position for r in copies] == sorted(r.mix_position for r in copies)


def test_rows_without_id_are_spread_and_ordered(docs_of):
    """Null and repeated ids: reruns agree on the texts that are taken, and the hash digits differ."""
    rows = [(None, f"w{i} " * (i % 5 + 1), "en", "a") for i in range(200)] + [(7, f"v{i} x", "en", "a") for i in range(50)] + [(i, "z " * 9, "en", "b") for i in range(300)]
    docs = docs_of(rows)
    one = sorted((r.text, r.mix_taken) for r in mix_sources(docs).select("text", "mix_taken").collect())
    two = sorted((r.text, r.mix_taken) for r in mix_sources(docs.repartition(5)).select("text", "mix_taken").collect())
    assert one == two
    early = [r.text for r in mix_sources(docs).where("source = 'a' AND doc_id IS NULL AND size(mix_positions) > 0").select("text").collect()]
    assert early != sorted(early, key=lambda t: (len(t), t))
