from __future__ import annotations

import hashlib
import random

import numpy as np
import pytest

from tidemark.llm.perfect_hash import PerfectHash, absorb, build_index, digest_groups, exact_duplicates, text_digests


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")


def brute(rows):
    groups: dict[str, list] = {}
    for i, t in rows:
        groups.setdefault(lower(t), []).append(i)
    out = []
    for text, ids in groups.items():
        best = max((i for i in ids if i is not None), default=None)
        free = True
        for i in ids:
            kept = free and i == best
            free = free and not kept
            out.append((i, best, len(ids), kept, hashlib.sha256(text.encode()).hexdigest()))
    return out


def order(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is not None, x if x is not None else 0) for x in r))


@pytest.mark.parametrize("n", [0, 1, 2, 63, 5000])
def test_perfect_hash_is_minimal(n):
    digests = np.random.default_rng(n).integers(0, 256, (n, 32), dtype=np.uint8)
    hashed = PerfectHash.of(digests)
    assert sorted(hashed.slots(digests).tolist()) == list(range(n))
    again = PerfectHash(hashed.sizes, hashed.bits.tobytes())
    assert (again.slots(digests) == hashed.slots(digests)).all()
    others = np.random.default_rng(n + 1).integers(0, 256, (100, 32), dtype=np.uint8)
    found = again.slots(others)
    assert ((found >= -1) & (found < max(n, 1))).all()


def test_equal_digests_are_refused():
    with pytest.raises(ValueError):
        PerfectHash.of(np.zeros((2, 32), np.uint8))


def test_against_brute_force(docs_of):
    rng = random.Random(3)
    texts = ["", None, "Abc", "aBC", "ÄB", "äb", "Äb", "x" * 300_000, "X" * 300_000, "a\0b", "İ", "i̇", "K", "k"] + [f"t{i}" for i in range(40)]
    rows = [(i, rng.choice(texts)) for i in range(400)] + [(7, "Abc"), (7, "Abc"), (None, "abc"), (None, "only null"), (None, "ONLY null")]
    docs = docs_of(rows).withColumnRenamed("hashes", "digest").selectExpr("*", "0 as id", "1 as row", "true as member", "5 as group_size")
    got = exact_duplicates(docs, shard=8).select("doc_id", "keep_id", "group_size", "kept", "text_sha256").collect()
    assert order(got) == order(brute(rows))


def test_a_common_text_and_empty_tables(docs_of):
    rows = [(i, "Same" if i % 3 else f"own {i}") for i in range(600)]
    assert order(exact_duplicates(docs_of(rows)).drop("in_history").collect()) == order(brute(rows))
    assert exact_duplicates(docs_of([])).count() == 0
    assert order(exact_duplicates(docs_of([(None, "a"), (None, None)])).drop("in_history").collect()) == order(brute([(None, "a"), (None, None)]))


def test_history_and_new_batch(docs_of):
    """Members fold into their slot, digests that history does not have stay groups of their own."""
    old = digest_groups(text_digests(docs_of([(1, "a"), (9, "A"), (3, "b"), (None, "c")])))
    new = digest_groups(text_digests(docs_of([(4, "a"), (12, "b"), (5, "B"), (6, "new"), (2, "c")])))
    shards = 3
    index = build_index(old, shards)
    assert index.count() <= shards
    names = {hashlib.sha256(t.encode()).digest(): t for t in ("a", "b", "c", "new")}
    found = {names[bytes(r.digest)]: (r.id, r.size, r.member) for r in absorb(index, new, shards).collect()}
    assert found == {"a": (9, 3, True), "b": (12, 3, True), "c": (2, 2, True), "new": (6, 1, False)}


def test_lookups_compare_whole_digests(spark, docs_of):
    """Whatever slot a digest that is no member comes to, its bytes differ."""
    old = digest_groups(text_digests(docs_of([(i, f"old {i}") for i in range(50)])))
    new = digest_groups(text_digests(docs_of([(i, f"new {i}") for i in range(2000)])))
    found = absorb(build_index(old, 2), new, 2)
    assert found.where("member").count() == 50 and found.where("not member").count() == 2000
    assert found.agg({"size": "max"}).first()[0] == 1


def test_reruns_agree(docs_of):
    rows = [(i % 50, f"T{i % 17}") for i in range(200)]
    one, two = exact_duplicates(docs_of(rows)), exact_duplicates(docs_of(rows).repartition(5))
    assert order(one.drop("in_history").collect()) == order(two.drop("in_history").collect())
