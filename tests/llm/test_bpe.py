from __future__ import annotations

import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm.bpe import WordBpe, encode_decode, word_counts
from tidemark.llm.lexicon import Lexicon, compile_lexicon

PATH = public_tokenizers.path("word_bpe_49k.json")
ODD = [
    "", " ", "Hello, World's don't I'LL x'd", "<|endoftext|>", "a<|startoftext|>b <|endoftext|", "ΣΑΣ ὈΔΥΣΣΕΎΣ Σ", "İstanbul DŽ ǅ ß ẞ",
    "é ́x Å ﬁ Ⅷ ²½ ٣४ 12345", "a\x1cb\x1dc\x1fd e\x85f\xa0g h　i​j﻿k", "日本語テキスト 한국어 ไทย हिन्दी",
    "👩‍👩‍👧 🇩🇪 ☃️", "x" * 5000, "ab" * 3000 + "!" * 700, "don’t ''' '' '''s 'S", "\t\n\x0b\x0c\r", "\x00\x01 \x7f", "q̈ͅΩᾼ",
]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def test_equals_the_library(spark, sf, docs_of, library):
    rng = random.Random(2)
    texts = ODD + [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").select("text").collect()]
    letters = "aeinrst'’.,-́ÉßΣ 0１² <|>"
    texts += ["".join(rng.choice(letters) for _ in range(rng.randint(1, 60))) for _ in range(300)]
    docs = docs_of([*enumerate(texts), (None, None), (3, "a b"), (3, "a b")])
    for size in (1 << 16, 5):  # most words known, nearly all merged
        got = encode_decode(docs, PATH, lexicon_size=size).where("doc_id is not null").select("doc_id", "ids", "decoded", "kept").collect()
        assert len(got) == len(texts) + 2
        for r in got:
            text = texts[r.doc_id] if not (r.doc_id == 3 and r.decoded == "a</w> b</w>") else "a b"
            ids = library.encode(text, add_special_tokens=False).ids
            assert (r.ids, r.decoded) == (ids, library.decode(ids, skip_special_tokens=False)), text[:80]
    null = encode_decode(docs, PATH).where("doc_id is null").collect()
    assert [(r.ids, r.decoded) for r in null] == [([], "")]


def test_digests_and_empty(docs_of, library):
    row = encode_decode(docs_of([(1, "Some words, here")]), PATH, digests_only=True).first()
    ids = library.encode("Some words, here", add_special_tokens=False).ids
    decoded = library.decode(ids, skip_special_tokens=False)
    assert row.n_tokens == len(ids)
    assert row.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
    assert row.decoded_sha256 == hashlib.sha256(decoded.encode()).hexdigest()
    assert encode_decode(docs_of([]), PATH).count() == 0


def test_word_counts(docs_of):
    got = {r.word: r.n for r in word_counts(docs_of([(1, "a b's a"), (2, "A<|endoftext|>c"), (3, None)]), "text", PATH).collect()}
    assert got == {"a": 3, "b": 1, "'s": 1, "c": 1}


def test_lexicon_is_exact_and_minimal(tmp_path):
    rng = random.Random(1)
    words = sorted({"".join(rng.choice("abc") for _ in range(rng.randint(1, 7))).encode() + rng.choice([b"", b"ing", b"ed"]) for _ in range(800)})
    entries = [(w, tuple(rng.choice([[1], [1, 2], [1, 2, 3], [4]]))) for w in words]
    path = tmp_path / "x"
    path.write_bytes(compile_lexicon(entries))
    lexicon = Lexicon(str(path))
    assert all(lexicon.get(w) == list(ids) for w, ids in entries)
    known = set(words)
    assert all(lexicon.get(w[:i]) is None for w in words for i in range(len(w)) if w[:i] not in known)
    assert lexicon.get(b"zz") is None and lexicon.get(b"") is None
    # Equal endings with equal ids are one state: one way of states for a whole family of words.
    path.write_bytes(compile_lexicon(sorted((bytes([a, b]) + b"tail", (7,)) for a in b"abcdef" for b in b"ghijkl")))
    assert Lexicon(str(path)).states == 7
    path.write_bytes(compile_lexicon([]))
    assert Lexicon(str(path)).get(b"a") is None


def test_merge_against_rescanning():
    bpe = WordBpe(PATH)

    def plain(word):
        s = [bpe.letters[b] for b in word.encode()]
        s[-1] += bpe.end
        while True:
            ranked = [(bpe.ranks[p], i) for i, p in enumerate(zip(s[:-1], s[1:])) if p in bpe.ranks]
            if not ranked:
                return [bpe.vocabulary[x] for x in s]
            i = min(ranked)[1]
            s[i : i + 2] = [s[i] + s[i + 1]]

    rng = random.Random(6)
    for _ in range(500):
        word = "".join(rng.choice("theinganore") for _ in range(rng.randint(1, 40)))
        assert bpe.merge(word) == plain(word)


def test_many_words_at_once_are_merged_like_one(docs_of):
    bpe = WordBpe(PATH)
    rng = random.Random(7)
    words = {"".join(rng.choice("theinganoreéß日x'") for _ in range(rng.randint(1, 70))) for _ in range(2_000)}
    assert bpe.merge_all(words) == {w: bpe.merge(w) for w in words}
    assert bpe.merge_all([]) == {} and bpe.merge_all([""]) == {"": []}


def test_lookups_of_many_words(tmp_path):
    rng = random.Random(8)
    words = sorted({"".join(rng.choice("abé") for _ in range(rng.randint(1, 6))).encode() for _ in range(400)})
    path = tmp_path / "x"
    path.write_bytes(compile_lexicon([(w, tuple(rng.choice([[1], [1, 2], [4, 1, 1]]))) for w in words]))
    lexicon = Lexicon(str(path))
    asked = [*words, b"", b"zz", *(w + b"q" for w in words), *(w[:2] for w in words)]
    assert lexicon.get_all(asked) == [lexicon.get(w) for w in asked]
    path.write_bytes(compile_lexicon([]))
    assert Lexicon(str(path)).get_all([b"a", b""]) == [None, None]
    assert Lexicon(str(path)).get_all([]) == []


def test_little_memory_changes_nothing(library):
    from tidemark.llm import bpe as module

    coder = module._Encoder.__new__(module._Encoder)
    coder.bpe, coder.words, coder.chunks = WordBpe(PATH), module._Recent(3), module._Recent(2)
    coder.lexicon = type("Empty", (), {"get_all": lambda self, words: [None] * len(words)})()
    texts = [f"{a} {b} don't <|endoftext|> {a}" for a in ("one", "two", "three") for b in ("x,", "y", "z!")] * 2
    for text, (ids, decoded) in zip(texts, [r for t in texts for r in coder.encode([t])]):
        want = library.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == want and decoded == library.decode(want, skip_special_tokens=False)


def test_clashing_names(docs_of):
    docs = docs_of([(1, "the cat")]).selectExpr("*", "'u' AS _", "'v' AS __", "7 AS row", "8 AS ids", "9 AS decoded")
    [r] = encode_decode(docs, PATH).collect()
    assert (r["_"], r["__"], r.row, r.decoded) == ("u", "v", 7, "the</w> cat</w>")


def test_ids_without_decoded_texts(docs_of):
    """The same ids; no decoded text is made or remembered."""
    from tidemark.llm import bpe as module

    docs = docs_of([(1, "Some words, here <|endoftext|> again"), (2, None), (3, "\u00e9tudes x1 " * 50), (3, "")])
    [lean, full] = [encode_decode(docs, PATH, decoding=d) for d in (False, True)]
    assert lean.columns == [c for c in full.columns if c != "decoded"]
    assert sorted(lean.collect()) == sorted(full.drop("decoded").collect())
    coder = module._Encoder.__new__(module._Encoder)
    coder.decoding = False
    coder.bpe = WordBpe(PATH)
    assert coder._value(coder.bpe.merge("here"))[1] == ""
