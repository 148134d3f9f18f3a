from __future__ import annotations

import hashlib
import random
from collections import Counter

from tidemark.llm.suffix import digests, remove_repeats, without_repeats


def brute(texts, length):
    data = [(t or "").encode() for t in texts]
    seen = Counter(d[i : i + length] for d in data for i in range(len(d) - length + 1))
    out = []
    for d in data:
        gone = bytearray(len(d))
        for i in range(len(d) - length + 1):
            if seen[d[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(d, gone) if not g)
        spans = sum(1 for i, g in enumerate(gone) if g and (i == 0 or not gone[i - 1]))
        out.append((len(d), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return out


def check(docs_of, texts, length=200):
    rows = digests(remove_repeats(docs_of(list(enumerate(texts))), length=length)).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in rows] == brute(texts, length)


def test_against_brute_force(docs_of):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 9)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage, other = text(80), text(50)
    texts = [text(rng.randint(0, 200)) for _ in range(20)]
    texts += [text(30) + passage + text(20), text(5) + passage, passage + text(40), passage[10:], other + passage[:260] + other]
    texts += [texts[3], texts[3], texts[4] + "x", None, None, "", "a" * 1000, "a" * 199, "b" * 200, "b" * 200, "c" * 201]
    texts += ["ab" * 300 + passage + "ab" * 150, "=-" * 40 + passage[50:300], text(3000) + passage[:201] + text(1000)]
    check(docs_of, texts)


def test_repeats_within_one_text_and_across_slices(docs_of, monkeypatch):
    rng = random.Random(4)
    block = "".join(rng.choice("abcdefgh ") for _ in range(700))
    noise = "".join(rng.choice("abcdefgh ") for _ in range(5000))
    texts = [block + noise + block[100:600], noise[:250] + "z" * 300, noise[:199]]
    monkeypatch.setattr("tidemark.llm.phrases.SLICE", 512)
    check(docs_of, texts)


def test_documents_of_the_smallest_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet").orderBy("doc_id")
    texts = [r.text for r in docs.collect()]
    got = digests(remove_repeats(docs)).orderBy("doc_id").collect()
    assert [tuple(r)[1:] for r in got] == brute(texts, 200)


def test_empty_table(docs_of):
    assert digests(remove_repeats(docs_of([]))).count() == 0


def test_clashing_names(docs_of):
    docs = docs_of([(1, "x" * 500), (2, None)]).selectExpr("*", "'u' AS `no text`", "'v' AS _", "7 AS row", "8 AS removed")
    got = without_repeats(docs, "text", 200).orderBy("doc_id").collect()
    assert [(r["no text"], r["_"], r.row, r.removed) for r in got] == [("u", "v", 7, 8)] * 2 and got[1].text is None


def test_places_found_one_by_one_stay_beside_phrases_that_stand_once(docs_of):
    """Texts of one window that begins with its trigger: their phrase stands once, its window stands in another text too."""
    from tidemark.llm.phrases import phrases

    rng = random.Random(5)
    long = "".join(rng.choice("abcdefgh ") for _ in range(6000))
    last = [int(p) for starts, counts, places, _ in phrases(long.encode(), 200) for a, n, p in zip(starts, counts, places) if p == a + n - 1]
    assert len(last) > 5
    check(docs_of, [long, *(long[p : p + 200] for p in last)])


def test_occurrences_of_a_common_passage_are_not_joined_with_its_phrases(docs_of, monkeypatch):
    from tidemark.llm import suffix

    rng = random.Random(6)
    word = lambda: "".join(rng.choice("abcde") for _ in range(rng.randint(1, 9)))
    line = " ".join(word() for _ in range(150))
    texts = [" ".join(word() for _ in range(60)) + line + " ".join(word() for _ in range(60)) for _ in range(40)]
    plans, write = {}, suffix.written
    monkeypatch.setattr(suffix, "written", lambda df, name: (plans.update({name: df._jdf.queryExecution().analyzed().toString()}), write(df, name))[1])
    check(docs_of, texts)
    assert plans["spans"].count("Join ") == 1  # of open phrases with what was found in them
