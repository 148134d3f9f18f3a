"""Byte-pair encoding with a transducer lexicon for frequent words and exact merges for all others."""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import os
import struct
import tempfile
import unicodedata
import uuid
from collections import Counter, defaultdict
from collections.abc import Collection, Iterable, Iterator

import numpy as np
import pyarrow as pa
import regex
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import free_name, schema_with, written
from tidemark.llm.lexicon import Lexicon, compile_lexicon

#: Words, and as many chunks, that a task remembers: beyond the common ones hardly any comes again.
MEMORY = 100_000
#: Letters of the texts that are cut into words before the unseen ones are coded together.
LETTERS = 1 << 21
#: Bytes from which on a word is merged on its own, and rows of a matrix of words.
LONG, ROWS = 48, 1 << 13


def _byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte: printable ones as they are, others from 256 on."""
    plain = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    others = (b for b in range(256) if b not in plain)
    moved = {b: 256 + i for i, b in enumerate(others)}
    return [chr(moved.get(b, b)) for b in range(256)]


class WordBpe:
    """A tokenizer file of words with ends: NFC, white space to blanks, lower case, a pattern that picks words, bytes as
    letters, merges by rank.  Special tokens are found in the raw text."""

    def __init__(self, path: str) -> None:
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.vocabulary: dict[str, int] = model["vocab"]
        self.end: str = model["end_of_word_suffix"]
        self.ranks = {tuple(m.split(" ") if isinstance(m, str) else m): i for i, m in enumerate(model["merges"])}
        self.specials = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.pieces = {i: p for p, i in self.vocabulary.items()} | {i: p for p, i in self.specials.items()}
        split = next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.pattern = regex.compile(split["pattern"]["Regex"])
        self.special = regex.compile("|".join(map(regex.escape, sorted(self.specials, key=len, reverse=True))))
        self.letters = _byte_letters()

    def normal(self, text: str) -> str:
        """NFC and letter-wise lower case: a final sigma is a sigma."""
        text = unicodedata.normalize("NFC", text)
        return text.lower() if "Σ" not in text else "".join(c.lower() for c in text)

    def words(self, chunk: str) -> list[str]:
        """Words of a chunk without special tokens."""
        if chunk.isascii() and chunk.isalpha():
            return [chunk.lower()]
        return self.pattern.findall(self.normal(chunk))

    def parts(self, chunk: str) -> list[str]:
        """Words and special tokens of a chunk, in order."""
        if "<" not in chunk:
            return self.words(chunk)
        out, at = [], 0
        for found in [*self.special.finditer(chunk), None]:
            out += self.words(chunk[at : found.start() if found else len(chunk)])
            if found:
                out.append(found[0])
                at = found.end()
        return out

    def merge(self, word: str) -> list[int]:
        """Ids of one word by its merges: lowest rank first, leftmost of equals."""
        symbols = [self.letters[b] for b in word.encode("utf-8")]
        symbols[-1] += self.end
        symbols = self._merge_long(symbols)
        return [self.vocabulary[s] for s in symbols if s in self.vocabulary]

    @functools.cached_property
    def _table(self) -> tuple[np.ndarray, ...]:
        """Merges in numbers: numbers of a byte inside a word and at its end; pairs (left * symbols + right), ascending, with
        the rank of each and the number of what it becomes; the id of each number, or -1."""
        first = [*self.letters, *(x + self.end for x in self.letters)]
        number = {s: i for i, s in enumerate(dict.fromkeys([*first, *(x for a, b in self.ranks for x in (a, b, a + b))]))}
        keys = np.array([number[a] * len(number) + number[b] for a, b in self.ranks], np.int64)
        order = np.argsort(keys)
        ranks = np.array(list(self.ranks.values()), np.int64)[order]
        made = np.array([number[a + b] for a, b in self.ranks], np.int64)[order]
        ids = np.array([self.vocabulary.get(s, -1) for s in number], np.int64)
        return np.array([number[s] for s in first], np.int64), keys[order], ranks, made, ids

    def merge_all(self, words: Collection[str]) -> dict[str, list[int]]:
        """``merge`` of many words: those of one length are rows of a matrix, of which each step merges the best pair of every row."""
        out: dict[str, list[int]] = {}
        lengths: dict[int, list[tuple[str, bytes]]] = defaultdict(list)
        for word in words:
            data = word.encode("utf-8")
            if 0 < len(data) < LONG:
                lengths[len(data)].append((word, data))
            else:
                out[word] = self.merge(word) if data else []
        for length, group in lengths.items():
            for at in range(0, len(group), ROWS):
                part = group[at : at + ROWS]
                raw = np.frombuffer(b"".join([d for _, d in part]), np.uint8).reshape(-1, length).astype(np.int64)
                raw[:, -1] += 256
                for rows, ids in self._merge_matrix(self._table[0][raw]):
                    for row, found in zip(rows.tolist(), ids.tolist(), strict=True):
                        out[part[row][0]] = found if min(found) >= 0 else [i for i in found if i >= 0]
        return out

    def _merge_matrix(self, symbols: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """(rows, ids of their symbols) as soon as nothing in them can be merged; every open row loses one symbol a step."""
        _, keys, ranks, made, ids = self._table
        none, size = np.int64(1 << 60), len(ids)
        if not len(keys):
            yield np.arange(len(symbols)), ids[symbols]
            return

        def look(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            pair = a * size + b
            at = np.minimum(np.searchsorted(keys, pair), len(keys) - 1)
            return np.where(keys[at] == pair, ranks[at], none), made[at]

        rows = np.arange(len(symbols))
        rank, become = look(symbols[:, :-1], symbols[:, 1:])
        while len(rows):
            if symbols.shape[1] == 1:
                yield rows, ids[symbols]
                return
            best = rank.argmin(axis=1)
            open_ = rank[np.arange(len(rows)), best] < none
            if not open_.all():
                yield rows[~open_], ids[symbols[~open_]]
                rows, symbols, rank, become, best = (x[open_] for x in (rows, symbols, rank, become, best))
            n, width = symbols.shape
            every, columns = np.arange(n), np.arange(width - 1)
            new = become[every, best]
            symbols = symbols[every[:, None], columns + (columns > best[:, None])]
            symbols[every, best] = new
            # Pair i + 1 becomes pair i behind the merged one; the pairs on both sides of the new symbol are looked up.
            pairs = columns[:-1]
            moved = pairs + (pairs >= best[:, None])
            rank, become = rank[every[:, None], moved], become[every[:, None], moved]
            for side in (best - 1, best):
                at = np.flatnonzero((side >= 0) & (side < width - 2))
                i = side[at]
                rank[at, i], become[at, i] = look(symbols[at, i], symbols[at, i + 1])

    def _merge_long(self, symbols: list[str]) -> list[str]:
        """From a heap of neighbours, in n log n."""
        n = len(symbols)
        after, before, alive = list(range(1, n + 1)), list(range(-1, n - 1)), [True] * n
        heap = [(r, i, symbols[i], symbols[i + 1]) for i in range(n - 1) if (r := self.ranks.get((symbols[i], symbols[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = after[i] if alive[i] else n
            if j >= n or symbols[i] != a or symbols[j] != b:
                continue
            symbols[i], alive[j], after[i] = a + b, False, after[j]
            if after[j] < n:
                before[after[j]] = i
            for left in (before[i], i):
                right = after[left] if left >= 0 else n
                if right < n and (r := self.ranks.get((symbols[left], symbols[right]))) is not None:
                    heapq.heappush(heap, (r, left, symbols[left], symbols[right]))
        return [symbols[i] for i in range(n) if alive[i]]

    def decode(self, ids: list[int]) -> str:
        """Pieces with blanks between them: the file names no decoder."""
        return " ".join(self.pieces[i] for i in ids if i in self.pieces)


#: What the normaliser takes for white space: Unicode's property, which lacks the separators U+001C to U+001F.
GAPS = regex.compile(r"[^\p{White_Space}]+", regex.V1)
_ODD_GAPS = regex.compile("[\x1c-\x1f]")


def chunks(text: str) -> list[str]:
    """Stretches without white space; no word and no special token crosses their edges."""
    return GAPS.findall(text) if _ODD_GAPS.search(text) else text.split()


def _pieces(texts: Iterable[pa.Scalar]) -> Iterator[list[str]]:
    """Texts, a few of them or one long one at a time; null ones are empty."""
    held, size = [], 0
    for text in texts:
        held.append(text.as_py() or "")
        size += len(held[-1])
        if size >= LETTERS:
            yield held
            held, size = [], 0
    if held:
        yield held


@functools.lru_cache(maxsize=1)
def _word_bpe(path: str) -> WordBpe:
    """One for all tasks of a Python worker."""
    return WordBpe(path)


def _count_batches(path: str):
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _word_bpe(path)
        seen: Counter[str] = Counter()

        def flush() -> pa.RecordBatch:
            words: Counter[str] = Counter()
            for chunk, n in seen.items():
                for word in bpe.parts(chunk):
                    words[word] += n
            for special in bpe.specials:
                words.pop(special, None)
            seen.clear()
            return pa.RecordBatch.from_arrays(
                [pa.array(list(words), pa.string()), pa.array(list(words.values()), pa.int64())], names=["word", "n"]
            )

        for batch in batches:
            for text in batch.column(0):
                if text.is_valid:
                    seen.update(chunks(text.as_py()))
                if len(seen) > MEMORY:
                    yield flush()
        yield flush()

    return count


def word_counts(docs: DataFrame, text_col: str, tokenizer: str) -> DataFrame:
    """(``word``, ``n``): how often each word of the tokenizer stands in all texts; summed in tasks before the shuffle."""
    texts = docs.select(F.col(text_col).cast("string").alias("text"))
    return texts.mapInArrow(_count_batches(tokenizer), "word string, n long").groupBy("word").agg(F.sum("n").alias("n"))


def frequent_lexicon(counts: DataFrame, tokenizer: str, size: int, name: str) -> str:
    """Write the lexicon of the most frequent words, at most ``size`` and no part of those with equal counts, beside the
    driver, and hand the file out to all executors; gives its name there.  ``size`` bounds the file and what reaches
    the driver: the words are not sorted, a table of how many have which count tells the least count to take."""
    spark = counts.sparkSession
    counts = written(counts, "word-counts")
    taken, least = 0, None
    for row in counts.groupBy("n").agg(F.count("*").alias("words")).orderBy(F.desc("n")).limit(size).collect():
        taken += row["words"]
        if taken > size:
            break
        least = row["n"]
    ranked = counts.where(F.col("n") >= least if least is not None else F.lit(False)).select("word")

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = _word_bpe(tokenizer)
        for batch in batches:
            coded = bpe.merge_all([w for w in batch.column(0).to_pylist() if w not in bpe.specials])
            yield pa.RecordBatch.from_arrays(
                [pa.array([w.encode() for w in coded], pa.binary()), pa.array(list(coded.values()), pa.list_(pa.int32()))], names=["word", "ids"]
            )

    rows = ranked.mapInArrow(encode, "word binary, ids array<int>").collect()
    data = compile_lexicon(sorted((bytes(r["word"]), tuple(r["ids"])) for r in rows))
    path = os.path.join(tempfile.mkdtemp(prefix="tidemark-lexicon-"), name)
    with open(path, "wb") as file:
        file.write(data)
    spark.sparkContext.addFile(path)
    return name


class _Recent:
    """What was looked up lately: two generations, so that what comes again and again stays and memory is bounded."""

    def __init__(self, most: int = MEMORY) -> None:
        self.most, self.now, self.before = most, {}, {}

    def unseen(self, keys: set[str]) -> list[str]:
        """Those of ``keys`` that must be learnt; all others are in ``now`` then."""
        if len(self.now) > self.most:
            self.now, self.before = {}, self.now
        new = []
        for key in keys:
            if key not in self.now:
                value = self.before.get(key)
                if value is None:
                    new.append(key)
                else:
                    self.now[key] = value
        return new


class _Encoder:
    """Words, and chunks of them, to (ids as bytes, decoded text): from the lexicon, or merged.  Without ``decoding``, decoded texts are
    neither made nor remembered: they are empty."""

    decoding = True

    def __init__(self, tokenizer: str, lexicon: str, decoding: bool = True) -> None:
        self.bpe, self.lexicon, self.decoding = _word_bpe(tokenizer), Lexicon(lexicon), decoding
        self.words, self.chunks = _Recent(), _Recent()

    def _value(self, ids: list[int]) -> tuple[bytes, str]:
        pieces, packed = self.bpe.pieces, struct.pack(f"<{len(ids)}I", *ids)
        if not self.decoding:
            return packed, ""
        return packed, pieces[ids[0]] if len(ids) == 1 else " ".join([pieces[i] for i in ids])

    def _learn_words(self, words: list[str]) -> None:
        """Unseen words, together: those of the lexicon by its transitions, all others by their merges."""
        specials = self.bpe.specials
        plain = [w for w in words if w not in specials]
        found = dict(zip(plain, self.lexicon.get_all([w.encode("utf-8") for w in plain]), strict=True))
        found.update(self.bpe.merge_all([w for w in plain if found[w] is None]))
        found.update((w, [specials[w]]) for w in words if w in specials)
        self.words.now.update((w, self._value(ids)) for w, ids in found.items())

    def _learn(self, chunks: set[str]) -> None:
        parts = {c: self.bpe.parts(c) for c in self.chunks.unseen(chunks)}
        self._learn_words(self.words.unseen({w for words in parts.values() for w in words}))
        known, out = self.words.now, self.chunks.now
        for chunk, words in parts.items():
            if len(words) == 1:
                out[chunk] = known[words[0]]
            else:
                pieces = [known[w] for w in words]
                out[chunk] = self._joined(pieces)

    def _joined(self, pieces: list[tuple[bytes, str]]) -> tuple[bytes, str]:
        return b"".join([p[0] for p in pieces]), " ".join([p[1] for p in pieces if p[0]]) if self.decoding else ""

    def encode(self, texts: list[str]) -> Iterator[tuple[bytes, str]]:
        """(ids as bytes, decoded text) of each text."""
        cut = [chunks(t) for t in texts]
        self._learn(set().union(*cut))
        known = self.chunks.now
        for own in cut:
            yield self._joined([known[c] for c in own])


def encode_decode(
    docs: DataFrame,
    tokenizer: str,
    text_col: str = "text",
    lexicon_size: int = 1 << 16,
    keep: list[str] | None = None,
    digests_only: bool = False,
    decoding: bool = True,
) -> DataFrame:
    """The rows of ``docs`` (columns ``keep``, all but the text by default) with ``ids`` (array<int>) and ``decoded``, or
    with ``digests_only`` with ``n_tokens``, ``ids_sha256`` (ids as little-endian unsigned 32-bit) and ``decoded_sha256``.
    Who needs no decoded texts says so by ``decoding``: their column is not made then, which spares half of a task's memory.

    Ids are those of the tokenizer file; null texts are empty, an empty text has no ids.  Special tokens' strings in
    a text are special tokens.  Words are counted over all texts; the ``lexicon_size`` most frequent ones are
    compiled into a transducer, all others merged where they occur, with the same result: the bound costs time
    only.  Repeated rows get a row each; columns of ``docs`` with names of the result are replaced; an empty
    table gives none.
    """
    counts = word_counts(docs, text_col, tokenizer)
    lexicon = frequent_lexicon(counts, tokenizer, lexicon_size, f"lexicon-{uuid.uuid4().hex}")
    added = {"n_tokens": "long", "ids_sha256": "string", "decoded_sha256": "string"} if digests_only else {
        "ids": "array<int>", "decoded": "string"
    }
    if not decoding:
        added = {c: kind for c, kind in added.items() if not c.startswith("decoded")}
    names = [c for c in (docs.columns if keep is None else keep) if c != text_col and c not in added]
    rows = docs.select(
        F.struct(F.lit(True).alias(free_name(names)), *[F.col(f"`{c}`") for c in names]).alias("row"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"),
    )

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = _Encoder(tokenizer, SparkFiles.get(lexicon), decoding)
        for batch in batches:
            at = 0
            for texts in _pieces(batch.column("text")):
                part = batch.slice(at, len(texts))
                at += len(texts)
                coded, decoded = zip(*coder.encode(texts), strict=True)
                if digests_only:
                    columns = [
                        pa.array([len(c) // 4 for c in coded], pa.int64()),
                        pa.array([hashlib.sha256(c).hexdigest() for c in coded]),
                        pa.array([hashlib.sha256(d.encode("utf-8")).hexdigest() for d in decoded]),
                    ]
                else:
                    ends = np.cumsum([0, *(len(c) // 4 for c in coded)], dtype=np.int32)
                    ids = pa.array(np.frombuffer(b"".join(coded), "<u4").astype(np.int32))
                    columns = [pa.ListArray.from_arrays(pa.array(ends), ids), pa.array(decoded, pa.string())]
                yield pa.RecordBatch.from_arrays([part.column("row"), *columns[: len(added)]], names=["row", *added])

    result = rows.mapInArrow(encode, schema_with(rows, ["row"], ", ".join(f"{n} {t}" for n, t in added.items())))
    return result.select(*[F.col(f"row.`{c}`") for c in names], *added)
