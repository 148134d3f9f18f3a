"""Each stage against a brute-force version of what it should keep."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest
from tokenizers import Tokenizer

import corpus_pipeline
from tidemark.llm.queries import tokenizer_path

COLUMNS = ["doc_id", "text", "lang", "source", "n_chars"]


@pytest.fixture(scope="module")
def stages(spark, sf, tmp_path_factory):
    """Input and output of each stage on the smallest tables."""
    top = str(tmp_path_factory.mktemp("pipeline"))
    docs, out = spark.read.parquet(f"{sf}/documents.parquet"), {}
    for name, stage in corpus_pipeline.STAGES:
        stage(spark, docs, sf).write.parquet(f"{top}/{name}")
        out[name] = docs, spark.read.parquet(f"{top}/{name}")
        docs = out[name][1]
    return out


def test_columns(stages):
    names = [n for n, _ in corpus_pipeline.STAGES]
    assert names == ["quality_filter", "near_duplicates", "repeated_passages", "source_mix", "token_ids"]
    for name in names[:-1]:
        assert stages[name][1].columns == COLUMNS


def test_quality_keeps_what_is_labelled_good(spark, sf, stages):
    before, after = stages["quality_filter"]
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    kept = {r.doc_id for r in after.collect()}
    good = [i for i in labels if labels[i] == 1]
    assert sum(i in kept for i in good) >= 0.97 * len(good)
    assert after.join(before, COLUMNS, "left_semi").count() == after.count() > 0


def shingles(text):
    w = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    return {tuple(w[i : i + 5]) for i in range(max(1, len(w) - 4))}


def test_near_duplicates(stages):
    """Just the smallest id of each component of links at 0.8 or more stays."""
    before, after = stages["near_duplicates"]
    sets = {r.doc_id: shingles(r.text) for r in before.collect()}
    root = {i: i for i in sets}
    for i, a in sets.items():
        for j, b in sets.items():
            if j < i and root[i] != root[j] and len(a & b) >= 0.8 * len(a | b) - 1e-9:
                old, new = max(root[i], root[j]), min(root[i], root[j])
                root = {k: new if r == old else r for k, r in root.items()}
    kept = [r.doc_id for r in after.collect()]
    assert len(kept) == len(set(kept)) and set(kept) == set(root.values())
    assert len(kept) < len(sets)


def test_near_copies_are_caught(docs_of, spark, sf):
    rng = random.Random(8)
    word = lambda: "".join(rng.choice("aeiornst") for _ in range(rng.randint(2, 8)))
    texts = []
    for _ in range(40):
        base = [word() for _ in range(rng.randint(60, 400))]
        texts.append(" ".join(base))
        for _ in range(3):
            copy = list(base)
            for at in rng.sample(range(len(copy)), max(1, len(copy) // 100)):
                copy[at] = word()
            texts.append(" ".join(copy))
    docs = docs_of([(i, t) for i, t in enumerate(texts)] + [(None, "no id"), (None, None), (900, None), (901, "")], extra=False)
    kept = corpus_pipeline.near_duplicates(spark, docs, sf).collect()
    ids = [r.doc_id for r in kept if r.doc_id is not None]
    assert {i for i in ids if i < 900 and i % 4 == 0} == set(range(0, 160, 4))
    assert sum(1 for i in ids if i < 900 and i % 4) <= 3
    assert 900 in ids and 901 not in ids and len(kept) - len(ids) == 2


def test_repeated_passages(stages):
    """Every text is what a plain scan for repeated 200-byte strings leaves of it."""
    before, after = stages["repeated_passages"]
    old, new = {r.doc_id: r for r in before.collect()}, {r.doc_id: r for r in after.collect()}
    assert old.keys() == new.keys()
    data = {i: (r.text or "").encode() for i, r in old.items()}
    seen = Counter(d[k : k + 200] for d in data.values() for k in range(len(d) - 199))
    cut = 0
    for i, d in data.items():
        gone = bytearray(len(d))
        for k in range(len(d) - 199):
            if seen[d[k : k + 200]] > 1:
                gone[k : k + 200] = b"\1" * 200
        want = bytes(c for c, g in zip(d, gone) if not g).decode("utf-8", "ignore")
        assert new[i].text == want and new[i].n_chars == len(want)
        assert (new[i].lang, new[i].source) == (old[i].lang, old[i].source)
        cut += any(gone)
    assert cut > 0


def test_mix_takes_whole_copies(stages):
    before, after = stages["source_mix"]
    old = {r.doc_id: r for r in before.collect()}
    rows = after.collect()
    assert all(old[r.doc_id] == r for r in rows)
    assert max(sum(1 for r in rows if r.doc_id == i) for i in old) <= 3


def test_tokens(stages):
    before, after = stages["token_ids"]
    library = Tokenizer.from_file(tokenizer_path("word_bpe_49k.json"))
    want = sorted((r.doc_id, library.encode(r.text or "", add_special_tokens=False).ids) for r in before.collect())
    assert sorted((r.doc_id, r.ids) for r in after.collect()) == want


def test_odd_tables_pass_through_all_stages(spark, sf, docs_of):
    rows = [(1, None), (2, ""), (2, ""), (None, "a b c"), (3, "w " * 100_000), (4, "the end is near. " * 30), (5, "the end is near. " * 30)]
    for docs in (docs_of(rows), docs_of([])):
        for _, stage in corpus_pipeline.STAGES:
            docs = spark.createDataFrame(stage(spark, docs, sf).collect(), stage(spark, docs, sf).schema)
        docs.collect()
