"""Language identification in two steps: language family, then linear machines between the family's languages."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import free_name, schema_with, written

#: Language codes by family.  A code that is not listed is a family of its own.
FAMILIES = {
    "germanic": "af da de en fo fy is lb nb nl nn no sv yi",
    "romance": "an ast ca es fr gl it la lmo oc pt ro sc scn vec wa",
    "slavic": "be bg bs cs hr mk pl ru sh sk sl sr uk",
    "baltic": "lt lv",
    "celtic": "br cy ga gd gv",
    "finnic": "et fi",
    "indic": "as bn gu hi mr ne or pa sa sd si ur",
    "iranian": "fa ku ps tg",
    "turkic": "az ba kk ky tk tr tt ug uz",
    "semitic": "am ar he mt",
    "dravidian": "kn ml ta te",
    "sinitic": "zh yue wuu",
    "malayo": "id jv ms su tl",
}
_FAMILY = {code: family for family, codes in FAMILIES.items() for code in codes.split()}
UNKNOWN = "und"
DIMENSIONS = 2048
#: Languages whose counts are sent to all tasks.
MOST_BROADCAST = 100_000
#: Letters of a text taken at a time.
_SLICE = 1 << 20


def family(lang: str) -> str:
    return _FAMILY.get(lang.lower().split("-")[0].split("_")[0], f"own:{lang}")


_LETTERS = np.zeros(0x110000, dtype=bool)


def _letters() -> np.ndarray:
    if not _LETTERS[ord("a")]:
        _LETTERS[:] = [chr(c).isalpha() for c in range(0x110000)]
    return _LETTERS


def features(text: str | None) -> np.ndarray | None:
    """Square roots of the shares of letter strings of length 1 to 3, hashed; nothing for a text without letters.  What
    is no letter is one gap; the whole text counts."""
    if not text:
        return None
    counts = np.zeros(DIMENSIONS, dtype=np.int64)
    carry = np.array([32, 32], dtype=np.uint32)
    letters, any_letter = _letters(), False
    for at in range(0, len(text), _SLICE):
        codes = np.frombuffer(text[at : at + _SLICE].lower().encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
        is_letter = letters[codes]
        any_letter |= bool(is_letter.any())
        codes = np.concatenate([carry, np.where(is_letter, codes, np.uint32(32))])
        codes = codes[np.concatenate(([True, True], (codes[2:] != 32) | (codes[1:-1] != 32)))]
        carry = codes[-2:]
        hashed = np.zeros(len(codes) - 2, dtype=np.uint32)
        with np.errstate(over="ignore"):
            for back in range(3):
                hashed = (hashed ^ codes[2 - back : len(codes) - back]) * np.uint32(0x01000193 + 2 * back)
                mixed = (hashed ^ (hashed >> np.uint32(15))) * np.uint32(0x85EBCA6B)
                counts += np.bincount((mixed >> np.uint32(21)).astype(np.int64), minlength=DIMENSIONS)
    if not any_letter:
        return None
    root = np.sqrt(counts.astype(np.float64))
    return root / np.linalg.norm(root)


def linear_svm(x: np.ndarray, y: np.ndarray, cost: float = 10.0, rounds: int = 30, seed: int = 1) -> np.ndarray:
    """Weights, the bias last, of a linear machine with squared hinge loss, by dual coordinate descent (Hsieh and others,
    2008); ``y`` is -1 or 1."""
    x = np.hstack([x, np.ones((len(x), 1))])
    norm, alpha, w = (x * x).sum(axis=1) + 0.5 / cost, np.zeros(len(x)), np.zeros(x.shape[1])
    rng = np.random.default_rng(seed)
    for _ in range(rounds):
        for i in rng.permutation(len(x)):
            gradient = y[i] * (x[i] @ w) - 1 + alpha[i] * 0.5 / cost
            new = max(alpha[i] - gradient / norm[i], 0.0)
            if new != alpha[i]:
                w += (new - alpha[i]) * y[i] * x[i]
                alpha[i] = new
    return w


@dataclass(frozen=True)
class LanguageModel:
    """Families and their machines (one against the rest), and for each family its languages with one machine for each
    two of them."""

    families: tuple[str, ...]
    family_weights: np.ndarray
    members: dict[str, tuple[str, ...]]
    pair_weights: dict[tuple[str, str], np.ndarray]

    def predict(self, x: np.ndarray) -> tuple[str, float]:
        """Language, and the logistic function of the narrowest margin on the way to it."""
        x = np.append(x, 1.0)
        margins = self.family_weights @ x
        best = int(margins.argmax())
        narrow = float(margins[best] - np.delete(margins, best).max()) / 2 if len(margins) > 1 else np.inf
        languages = self.members[self.families[best]]
        votes = {a: [0, 0.0] for a in languages}
        decided: dict[tuple[str, str], float] = {}
        for a, b in combinations(languages, 2):
            m = float(self.pair_weights[a, b] @ x)
            decided[a, b] = m
            votes[a if m >= 0 else b][0] += 1
            votes[a][1] += m
            votes[b][1] -= m
        winner = max(languages, key=lambda a: (*votes[a], a))
        for (a, b), m in decided.items():
            if winner in (a, b):
                narrow = min(narrow, m if winner == a else -m)
        return winner, 1.0 if narrow == np.inf else float(1 / (1 + np.exp(-2 * np.clip(narrow, -50, 50))))


def _feature_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for at in range(0, batch.num_rows, 256):
            part = batch.slice(at, 256)
            found = [features(t) for t in part.column("text").to_pylist()]
            some = [i for i, f in enumerate(found) if f is not None]
            packed = [found[i].astype(np.float32).tobytes() for i in some]
            yield pa.RecordBatch.from_arrays(
                [part.column("lang").take(pa.array(some, pa.int64())), pa.array(packed, pa.binary())], names=["lang", "x"]
            )


def train(docs: DataFrame, text_col: str = "text", lang_col: str = "lang", per_language: int = 400) -> LanguageModel | None:
    """Fit on about ``per_language`` different texts of each value of ``lang_col``, chosen by the hash of the text (a documented bound
    on fitting; all values are learnt).  Null languages and texts without letters teach nothing; nothing is
    returned where nothing is learnt."""
    texts = docs.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang"))
    rows = texts.where(F.col("lang").isNotNull() & F.col("text").isNotNull()).withColumn("h", F.xxhash64("text"))
    known = rows.select("lang", "h").distinct().groupBy("lang").agg(F.count("*").alias("n"))
    known = written(known, "languages")
    # One row a language: counted before it is sent to the texts; with a label for nearly every text it is joined like any table.
    known = F.broadcast(known) if known.count() <= MOST_BROADCAST else known
    chosen = F.pmod("h", F.lit(1 << 30)) * F.col("n") < F.lit(per_language << 30)
    sample = rows.join(known, "lang").where(chosen).dropDuplicates(["lang", "h"])
    seen = sample.select("text", "lang").mapInArrow(_feature_batches, "lang string, x binary").collect()
    return fit([r["lang"] for r in seen], np.array([np.frombuffer(r["x"], np.float32) for r in seen]))


def fit(langs: list[str], x: np.ndarray) -> LanguageModel | None:
    if not langs:
        return None
    order = sorted(range(len(langs)), key=lambda i: (langs[i], x[i].tobytes()))  # the order of rows decides nothing
    langs, x = [langs[i] for i in order], x[order].astype(np.float64)
    code, group = np.array(langs), np.array([family(a) for a in langs])
    families = tuple(sorted(set(group)))
    against = [linear_svm(x, np.where(group == f, 1.0, -1.0)) for f in families]
    members = {f: tuple(sorted({str(a) for a in code[group == f]})) for f in families}
    pairs = {}
    for languages in members.values():
        for a, b in combinations(languages, 2):
            both = (code == a) | (code == b)
            pairs[a, b] = linear_svm(x[both], np.where(code[both] == a, 1.0, -1.0))
    return LanguageModel(families, np.array(against), members, pairs)


def identify(docs: DataFrame, model: LanguageModel | None, text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` with ``lang_pred`` and ``lang_score`` (0 to 1): from the text alone.

    Null texts, texts without a letter, and all texts where there is no model are ``und`` with score 0.  Columns of
    these names are replaced; repeated rows get a row each; an empty table gives none.
    """
    names = [c for c in docs.columns if c not in ("lang_pred", "lang_score")]
    rows = docs.select(
        F.struct(F.lit(True).alias(free_name(names)), *[F.col(f"`{c}`") for c in names if c != text_col]).alias("row"), F.col(text_col).cast("string").alias("text")
    )

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 1024):
                part = batch.slice(at, 1024)
                found = []
                for text in part.column("text"):
                    x = features(text.as_py()) if model else None
                    found.append((UNKNOWN, 0.0) if x is None else model.predict(x))
                langs, scores = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays(
                    [*part.columns, pa.array(langs, pa.string()), pa.array(scores, pa.float64())],
                    names=[*part.schema.names, "lang_pred", "lang_score"],
                )

    result = rows.mapInArrow(predict, schema_with(rows, ["row", "text"], "lang_pred string, lang_score double"))
    back: list[Column] = [F.col("text").alias(c) if c == text_col else F.col(f"row.`{c}`") for c in names]
    return result.select(*back, "lang_pred", "lang_score")
