"""Token counts, language and quality."""

from __future__ import annotations

import math
import random

import numpy as np
import public_tokenizers
from pyspark.sql import functions as F
from tokenizers import Tokenizer, models

from tidemark.llm import langid, quality
from tidemark.llm.token_counts import MARK, Trie, token_counts, unigram_scores

PIECES = public_tokenizers.path("piece_bpe_32k.model")


def test_token_counts_equal_a_unigram_library(docs_of, spark, sf):
    scores = unigram_scores(PIECES)
    vocabulary = [("<unk>", 0.0)] + list(scores.items()) + [(f"<0x{b:02X}>", -100.0) for b in range(256)]
    library = Tokenizer(models.Unigram(vocabulary, 0, True))
    texts = ["", " ", None, "a b  c", "naïve 日本語 ☃ 🇩🇪 ꙮ", "x" * 300, "Hello, world!", "퟿z"]
    texts += [r.text for r in spark.read.parquet(f"{sf}/documents.parquet").limit(60).collect()]
    rows = [*enumerate(texts), (3, "a b  c")]
    got = token_counts(docs_of(rows), PIECES).select("doc_id", "n_pretokens", "n_tokens").collect()
    assert len(got) == len(rows)
    for r in got:
        words = [w for w in (texts[r.doc_id] or "").replace("\n", " ").replace("\t", " ").split(" ") if w]
        assert (r.n_pretokens, r.n_tokens) == (len(words), sum(len(library.encode(MARK + w).ids) for w in words)), words[:5]
    assert token_counts(docs_of([]), PIECES).count() == 0


def test_trie_against_all_segmentations():
    rng = random.Random(1)
    scores = {"".join(rng.choice("ab") for _ in range(rng.randint(1, 4))): -rng.random() * 9 for _ in range(25)}
    scores |= {"a": -8.0, "b": -8.0}

    def best(word):
        if not word:
            return 0.0, 0
        found = []
        for n in range(1, len(word) + 1):
            s, t = best(word[n:])
            if word[:n] in scores:
                found.append((s + scores[word[:n]], t - 1))
            elif n == 1:
                found.append((s + min(scores.values()) - 10, t - len(word[0].encode())))
        return max(found)

    for nodes in (10**6, 8):
        trie = Trie(scores, nodes)
        for _ in range(200):
            word = "".join(rng.choice("aabbé") for _ in range(rng.randint(1, 9)))
            assert trie[word] == -best(word)[1]
    trie = Trie(scores)
    trie["aab"], trie["aaba"], trie["aabb"]
    assert len(trie.forward) == 1 + 3 + 2  # shared prefixes once


def test_language_on_held_out_documents(spark):
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet").where("length(text) > 40")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2
    model = langid.train(docs.where(~held))
    assert {a for m in model.members.values() for a in m} == {"en", "de", "fr", "es"}
    assert model.members["germanic"] == ("de", "en") and model.members["romance"] == ("es", "fr")
    got = langid.identify(docs.where(held), model)
    right, n = got.agg(F.avg((F.col("lang") == F.col("lang_pred")).cast("int")), F.count("*")).first()
    assert right > 0.97 and n > 2000
    assert got.where("lang_score < 0 or lang_score > 1").count() == 0


def test_language_of_odd_rows(docs_of):
    train = docs_of([(i, t * 3, lang) for i, (t, lang) in enumerate([("the and of", "en"), ("der und die", "de"), ("le et la", "fr"), ("xyzzy", "qq"), ("lost", None)] * 4)])
    model = langid.train(train)
    assert model.members["own:qq"] == ("qq",)
    odd = docs_of([(1, None), (2, ""), (3, "123 !?"), (4, "the and"), (4, "the and"), (None, "der die und"), (5, "a" * 3_000_000)])
    got = {(r.doc_id, r.lang_pred) for r in langid.identify(odd.withColumn("lang_score", F.lit("x")), model).collect()}
    assert {(1, "und"), (2, "und"), (3, "und"), (4, "en"), (None, "de")} <= got and len(got) == 6
    assert {r.lang_pred for r in langid.identify(odd, langid.train(docs_of([]))).collect()} == {"und"}
    assert langid.identify(docs_of([]), model).count() == 0


def test_slices_do_not_change_features(monkeypatch):
    text = "Über den Wolken  , muß -- die Freiheit " * 40
    whole = langid.features(text)
    monkeypatch.setattr(langid, "_SLICE", 7)
    assert np.allclose(whole, langid.features(text))


def test_svm_separates():
    rng = np.random.default_rng(1)
    x = rng.normal(size=(300, 5))
    y = np.sign(x @ [1, -2, 0.5, 0, 1] + 0.2)
    w = langid.linear_svm(x, y)
    assert (np.sign(np.hstack([x, np.ones((300, 1))]) @ w) == y).mean() > 0.98


def test_tree_paths():
    debug = """DecisionTreeClassificationModel: uid=dtc, depth=2, numNodes=5, numClasses=2, numFeatures=3
  If (feature 1 <= 0.5)
   If (feature 0 <= -1.5E-4)
    Predict: 0.0
   Else (feature 0 > -1.5E-4)
    Predict: 1.0
  Else (feature 1 > 0.5)
   Predict: 1.0
"""
    a, b, c = (1, "<=", 0.5), (0, "<=", -1.5e-4), (0, ">", -1.5e-4)
    assert quality.tree_paths(debug) == [(a,), (b, a), (c, a), ((1, ">", 0.5),)]


def test_quality_on_held_out_labels(spark):
    sf = "/root/testdata/sf0.1"
    docs, labels = spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet")
    held = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    model = quality.train(docs, labels.where(~held))
    assert 0 < len(model.rules) < 400
    rows = quality.score(docs, model).join(labels.where(held), "doc_id").select("quality_score", "quality").collect()
    ones = np.array([r.quality_score for r in rows if r.quality == 1])
    zeros = np.array([r.quality_score for r in rows if r.quality == 0])
    auc = np.mean((ones[:, None] > zeros[None, :]) + 0.5 * (ones[:, None] == zeros[None, :]))
    print("auc", auc, "kept", (ones >= 0.5).mean(), "dropped", (zeros < 0.5).mean())
    assert auc > 0.9 and (ones >= 0.5).mean() > 0.98
    stats = docs.select(quality.statistics(F.col("text")).alias("s")).where(F.exists("s", lambda x: x.isNull() | F.isnan(x)))
    assert stats.count() == 0


def test_quality_without_labels_and_odd_rows(docs_of, spark):
    docs = docs_of([(1, None), (2, ""), (2, ""), (None, "a b"), (3, "w " * 200_000)])
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert quality.train(docs, none).score(F.lit(None)) is not None
    got = quality.score(docs, quality.train(docs, none)).collect()
    assert [r.quality_score for r in got] == [0.5] * 5 and [r.quality_label for r in got] == [1] * 5
    one = spark.createDataFrame([(1, 1, None), (2, 1, 0), (7, None, 0), (None, 1, 1), (3, 5, 0)], "doc_id long, quality int, toxic int")
    model = quality.train(docs, one)
    assert not model.rules and math.isclose(model.intercept, math.log(4))
    assert quality.score(docs_of([]), model).count() == 0
    both = spark.createDataFrame([(i, i % 2) for i in range(60)], "doc_id long, quality int")
    texts = docs_of([(i, "good words here." if i % 2 else "### $$$ %%%") for i in range(60)])
    scored = quality.score(texts, quality.train(texts, both)).collect()
    assert all(r.quality_label == r.doc_id % 2 for r in scored)


def test_long_pretokens_are_scored_without_nodes():
    scores = unigram_scores(PIECES)
    rng = random.Random(9)
    for n in (1_001, 5_000):
        word = "".join(rng.choice("abcdefghij日☃") for _ in range(n))
        short, long_ = Trie(scores, nodes=100_000), Trie(scores)
        by_nodes = dict.__getitem__(short, word) if word in short else None
        short_path = [0]
        for depth, letter in enumerate(word, 1):  # the same word by the nodes' own rule
            node = short.children.get((short_path[-1], letter)) or short._add(word, depth, short_path)
            short.children[short_path[-1], letter] = node
            short_path.append(node)
        assert by_nodes is None and long_[word] == short.tokens[short_path[-1]]
        assert len(long_.forward) == 1  # no node was made


def test_more_languages_than_any_list_holds(spark):
    """Every label value is learnt: texts are bounded by value only."""
    rng = random.Random(2)
    alphabets = ["".join(rng.sample("abcdefghijklmnopqrstuvwxyz", 4)) for _ in range(230)]
    rows = [(i, " ".join("".join(rng.choice(alphabets[i % 230]) for _ in range(5)) for _ in range(40)), f"x{i % 230}") for i in range(230 * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    sample = docs.groupBy("lang").count()
    assert sample.count() == 230
    seen = []
    fit, langid.fit = langid.fit, lambda langs, x: seen.extend(langs)
    try:
        langid.train(docs, per_language=2)
        langid.train(docs.unionByName(docs).unionByName(docs.withColumn("doc_id", F.lit(None).cast("long"))), per_language=50)
    finally:
        langid.fit = fit
    assert len({*seen}) >= 200 and seen.count("x7") >= 3
    assert len(seen) <= 230 * 3 + 230 * 3  # copies of a text are one text


def test_the_sample_is_repeatable_without_ids(spark):
    rows = [(None, f"some text number {i} of words", "en" if i % 3 else "de") for i in range(300)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    kept, fit = [], langid.fit
    langid.fit = lambda langs, x: kept.append(sorted((a, v.tobytes()) for a, v in zip(langs, x)))
    try:
        langid.train(docs, per_language=20)
        langid.train(docs.repartition(7), per_language=20)
    finally:
        langid.fit = fit
    assert kept[0] == kept[1] and 10 < len(kept[0]) < 90


def test_clashing_names(docs_of):
    """Columns named like the operators' helpers and results."""
    docs = docs_of([(1, "the cat and the dog"), (2, None)]).selectExpr("*", "'u' AS _", "'v' AS __", "7 AS row", "8 AS n_tokens", "9 AS lang_pred", "1 AS lang_score")
    counted = token_counts(docs, PIECES)
    assert {c: counted.columns.count(c) for c in counted.columns if c in ("_", "__", "row", "n_tokens")} == {"_": 1, "__": 1, "row": 1, "n_tokens": 1}
    assert [(r["_"], r["__"], r["row"], r.n_tokens > 0) for r in counted.orderBy("doc_id").collect()] == [("u", "v", 7, True), ("u", "v", 7, False)]
    found = langid.identify(docs, None)
    assert [(r["_"], r.row, r.lang_pred, r.text) for r in found.orderBy("doc_id").collect()] == [("u", 7, "und", "the cat and the dog"), ("u", 7, "und", None)]
