from __future__ import annotations

import random
import re

import numpy as np
import xxhash

from tidemark.llm.simhash import near_links, simhash_components
from tidemark.llm.components import connected_components


def fingerprint(text, width=3):
    text = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    w = re.findall(r"[^\x20\x09-\x0D]+", text)
    shingles = [" ".join(w[i : i + width]) for i in range(max(1, len(w) - width + 1))] if w else []
    hashes = np.array([xxhash.xxh64_intdigest(s, 42) for s in shingles], dtype=np.uint64)
    return sum(1 << b for b in range(64) if 2 * int((hashes >> np.uint64(b) & np.uint64(1)).sum()) > len(hashes))


def components(prints, bits):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                root[find(i)] = find(j)
    return [find(i) for i in range(len(prints))]


def same_partition(a, b):
    return len(set(zip(a, b))) == len(set(a)) == len(set(b))


def test_documents_against_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = docs.select("doc_id", "text").collect()
    prints = {r.doc_id: fingerprint(r.text) for r in rows}
    got = {r.doc_id: r for r in simhash_components(docs).collect()}
    ids = sorted(prints)
    assert {i: int(got[i].fingerprint, 16) for i in ids} == prints
    roots = components([prints[i] for i in ids], 2)
    least = {r: min(i for i, q in zip(ids, roots) if q == r) for r in set(roots)}
    assert [got[i].component_id for i in ids] == [least[r] for r in roots]


def test_odd_rows(docs_of):
    rows = [(5, None), (3, ""), (4, " \t\n"), (None, "a b c d"), (7, "A B C D"), (7, "A B C D"), (None, "lone words here now")]
    got = [tuple(r) for r in simhash_components(docs_of(rows)).select("doc_id", "fingerprint", "component_id").collect()]
    zero = "0" * 16
    assert sorted(x for x in got if x[1] == zero) == [(3, zero, 3), (4, zero, 3), (5, zero, 3)]
    assert [x[2] for x in got if x[1] == f"{fingerprint('lone words here now'):016x}"] == [None]
    same = [x for x in got if x[1] == f"{fingerprint('a b c d'):016x}"]
    assert len(same) == 3 and {x[2] for x in same} == {7}
    assert simhash_components(docs_of([])).count() == 0


def test_links_of_dense_lists_reach_what_all_pairs_reach(spark):
    rng = random.Random(5)
    base = [rng.getrandbits(64) for _ in range(6)]
    prints = set(base)
    for b in base[:3]:  # chains and clouds around a few fingerprints
        for _ in range(150):
            b ^= (1 << rng.randrange(64)) | (1 << rng.randrange(16))
            prints.add(b)
    prints |= {base[4] ^ x for x in rng.sample(range(1 << 16), 900)}
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    for bits in (2, 3):
        df = spark.createDataFrame([(s,) for s in signed], "fp long")
        found = {r.node: r.root for r in connected_components(near_links(df, bits)).collect()}
        assert same_partition([found.get(s, s) for s in signed], components(prints, bits))


def test_long_chain_of_links(spark):
    chain = spark.range(300).selectExpr("id as a", "id + 1 as b").unionByName(spark.createDataFrame([(900, 800)], "a long, b long"))
    got = {r.node: r.root for r in connected_components(chain).collect()}
    assert got == {**{i: 0 for i in range(1, 301)}, 900: 800}
