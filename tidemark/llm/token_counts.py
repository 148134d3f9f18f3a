"""Token counts of a unigram model, by dynamic programming over a trie of pre-tokens."""

from __future__ import annotations

import functools
import math
import re
from collections.abc import Iterator, Mapping

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import free_name, schema_with

#: The mark at the start of a pre-token, and how far below the rarest piece an unknown letter scores.
MARK = "▁"
UNKNOWN_PENALTY = 10.0
#: Trie nodes that a task holds before it starts anew.
NODES = 1_000_000
#: Letters from which on a pre-token is scored without nodes.
LONG = 1_000
_WORD = re.compile("[^\x20\x09-\x0d]+")


def unigram_scores(model_file: str) -> dict[str, float]:
    """Log-probabilities of the pieces of a public vocabulary: Zipf's law over their rank in the file, since a
    merge vocabulary states ranks and no probabilities.  Control, unknown and byte pieces match no text."""
    from sentencepiece import SentencePieceProcessor

    model = SentencePieceProcessor(model_file=model_file)
    pieces = [
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i) or model.is_unused(i))
    ]
    total = math.log(sum(1 / r for r in range(1, len(pieces) + 1)))
    return {p: -math.log(r) - total for r, p in enumerate(pieces, 1)}


class Trie(dict):
    """pre-token -> number of tokens.  A missing pre-token is inserted: nodes that it shares with earlier ones keep the
    forward score (best log-probability of any segmentation up to there) and token count that they have."""

    def __init__(self, scores: Mapping[str, float], nodes: int = NODES) -> None:
        super().__init__()
        self.scores, self.most = scores, nodes
        self.longest = max(map(len, scores), default=1)
        self.unknown = min(scores.values(), default=0.0) - UNKNOWN_PENALTY
        self.reset()

    def reset(self) -> None:
        self.clear()
        self.children: dict[tuple[int, str], int] = {}
        self.forward, self.tokens = [0.0], [0]

    def __missing__(self, word: str) -> int:
        if len(word) > LONG:
            return self._rolling(word)
        if len(self.forward) + len(word) > self.most:
            self.reset()
        path = [0]
        for depth, letter in enumerate(word, 1):
            node = self.children.get((path[-1], letter))
            if node is None:
                node = self._add(word, depth, path)
                self.children[path[-1], letter] = node
            path.append(node)
        self[word] = count = self.tokens[path[-1]]
        return count

    def _rolling(self, word: str) -> int:
        """The same for a word that shares nothing worth keeping: only as many prefixes as a piece is long are held."""
        held = [(0.0, 0)]
        for depth in range(1, len(word) + 1):
            base, best = depth - len(held), None
            for start in range(depth - 1, base - 1, -1):
                score, (forward, tokens) = self.scores.get(word[start:depth]), held[start - base]
                if score is not None:
                    found = (forward + score, -tokens - 1)
                elif start == depth - 1:
                    found = (forward + self.unknown, -tokens - len(word[start].encode("utf-8", "surrogatepass")))
                else:
                    continue
                if best is None or found > best:
                    best = found
            held.append((best[0], -best[1]))
            if len(held) > self.longest:
                del held[0]
        return held[-1][1]

    def _add(self, word: str, depth: int, path: list[int]) -> int:
        """The best last piece of the prefix; of equal scores the one with fewer tokens."""
        forward, tokens = self.forward, self.tokens
        best = None
        for start in range(depth - 1, max(0, depth - self.longest) - 1, -1):
            score = self.scores.get(word[start:depth])
            if score is not None:
                found = (forward[path[start]] + score, -tokens[path[start]] - 1)
            elif start == depth - 1:  # a letter without a piece becomes its bytes
                found = (forward[path[start]] + self.unknown, -tokens[path[start]] - len(word[start].encode("utf-8", "surrogatepass")))
            else:
                continue
            if best is None or found > best:
                best = found
        forward.append(best[0])
        tokens.append(-best[1])
        return len(forward) - 1


@functools.lru_cache(maxsize=1)
def _trie(model_file: str) -> Trie:
    """One for all tasks of a Python worker."""
    return Trie(unigram_scores(model_file))


def token_counts(docs: DataFrame, model_file: str, text_col: str = "text", scores: Mapping[str, float] | None = None) -> DataFrame:
    """The rows of ``docs`` without the text, with ``n_pretokens`` and ``n_tokens`` (long): tokens of the likeliest segmentation
    of each blank-separated pre-token into pieces; a letter that no piece is counts as its bytes.

    Every task inserts the distinct pre-tokens of its texts into one trie, so the model runs once for each shared
    prefix, and adds up the counts stored at their ends; nothing is shuffled.  A trie that outgrows ``NODES``
    starts anew, which costs time only; very long pre-tokens are scored without nodes, in the memory of one piece.  ``scores`` replaces the model file's.  Null, empty and blank texts
    have none of both; repeated rows get a row each; columns of these names are replaced; an empty table gives none.
    """
    names = [c for c in docs.columns if c not in (text_col, "n_pretokens", "n_tokens")]
    rows = docs.select(
        F.struct(F.lit(True).alias(free_name(names)), *[F.col(f"`{c}`") for c in names]).alias("row"), F.col(text_col).cast("string").alias("text")
    )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie = _trie(model_file) if scores is None else Trie(scores)
        for batch in batches:
            words, tokens = [], []
            for text in batch.column("text"):
                found = _WORD.findall(text.as_py() or "")
                words.append(len(found))
                tokens.append(sum([trie[MARK + w] for w in found]))
            yield pa.RecordBatch.from_arrays(
                [batch.column("row"), pa.array(words, pa.int64()), pa.array(tokens, pa.int64())], names=["row", "n_pretokens", "n_tokens"]
            )

    result = rows.mapInArrow(count, schema_with(rows, ["row"], "n_pretokens long, n_tokens long"))
    return result.select(*[F.col(f"row.`{c}`") for c in names], "n_pretokens", "n_tokens")
