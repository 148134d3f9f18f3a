"""Ranked lexical search of many items at once: what items have in common is scored once."""

from __future__ import annotations

import math
from collections import Counter, defaultdict
from collections.abc import Iterable, Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import written

#: Items, and about as many bytes of their texts, that are searched in one pass over the documents.
ITEMS, ITEM_BYTES = 1_024, 1 << 22
#: Cells (documents x terms) that a task scores at a time.
CELLS = 1 << 21
#: Neighbours in an item's list of nodes between which pairs are counted.
NEIGHBOURS = 48
#: Letters A-Z become small ones; ASCII that is neither a letter nor a digit becomes a blank.
_TERMS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 128 or chr(b).isalnum() else 32 for b in range(256))
_PIECE = 1 << 20


def terms(text: str | bytes | None) -> Iterator[list[bytes]]:
    """The terms of a text, in lists: runs of ASCII letters, digits and letters beyond ASCII.  Long texts come piece by piece."""
    data = (text.encode() if isinstance(text, str) else text or b"").translate(_TERMS)
    at = 0
    while at < len(data):
        end = data.find(b" ", at + _PIECE)
        end = len(data) if end < 0 else end
        yield data[at:end].split()
        at = end


class SharingDag:
    """Sums of terms for many items, in which every sum that two items share is formed once.

    ``leaves`` are (term, times in the item).  ``pairs`` are nodes that add two earlier ones: they follow the leaves, in the order in
    which they can be evaluated.  ``wanted`` lists, for each item, the nodes that add up to its score.
    """

    def __init__(self, items: Iterable[Counter]) -> None:
        counts = [sorted(c.items()) for c in items]
        self.leaves = sorted({leaf for item in counts for leaf in item})
        number = {leaf: i for i, leaf in enumerate(self.leaves)}
        self.pairs: list[tuple[int, int]] = []
        self.wanted = [{number[leaf] for leaf in item} for item in counts]
        while self._mine():
            pass

    def _mine(self) -> bool:
        """Pairs of nodes that stand together in most items become nodes of their own, commonest first."""
        holders: dict[int, set[int]] = defaultdict(set)
        for i, nodes in enumerate(self.wanted):
            for node in nodes:
                holders[node].add(i)
        times: Counter[tuple[int, int]] = Counter()
        for nodes in self.wanted:
            # Common nodes first: what two items share lies close together in both lists.
            shared = sorted((n for n in nodes if len(holders[n]) > 1), key=lambda n: (-len(holders[n]), n))
            for at in range(0, len(shared), NEIGHBOURS):
                times.update(combinations(sorted(shared[at : at + NEIGHBOURS]), 2))
        grown = False
        for (a, b), n in sorted(times.items(), key=lambda x: (-x[1], x[0])):
            if n < 2:
                break
            both = holders[a] & holders[b]
            if len(both) < 2:
                continue
            node = len(self.leaves) + len(self.pairs)
            self.pairs.append((a, b))
            holders[a] -= both
            holders[b] -= both
            for i in both:
                self.wanted[i] -= {a, b}
                self.wanted[i].add(node)
            grown = True
        return grown

    @property
    def additions(self) -> int:
        return len(self.pairs) + sum(max(0, len(nodes) - 1) for nodes in self.wanted)

    def evaluate(self, columns: list[np.ndarray]) -> Iterator[tuple[int, np.ndarray]]:
        """(item, its score for each document), for items with terms; ``columns`` holds each term's scores.  An accumulator
        goes when nothing that is still to come needs it."""
        uses = Counter(n for pair in self.pairs for n in pair)
        uses.update(n for nodes in self.wanted for n in nodes)
        held: dict[int, np.ndarray] = {}

        def take(node: int) -> np.ndarray:
            if node < len(self.leaves):
                term, times = self.leaves[node]
                return columns[term] if times == 1 else columns[term] * times
            uses[node] -= 1
            return held[node] if uses[node] else held.pop(node)

        # Items as soon as their last node is there.
        ready = defaultdict(list)
        for i, nodes in enumerate(self.wanted):
            if nodes:
                ready[max(nodes)].append(i)
        first = len(self.leaves)
        for last in sorted(n for n in ready if n < first):
            for i in ready[last]:
                yield i, sum((take(n) for n in sorted(self.wanted[i])[1:]), take(min(self.wanted[i])))
        for k, (a, b) in enumerate(self.pairs):
            held[first + k] = take(a) + take(b)
            for i in ready[first + k]:
                nodes = sorted(self.wanted[i])
                yield i, sum((take(n) for n in nodes[1:]), take(nodes[0]))


def _postings(docs: DataFrame, text_col: str, id_col: str, vocabulary: dict[bytes, int]) -> DataFrame:
    """(``id``, ``n``, ``terms``, ``tfs``): of every document with a term their number, and those of the vocabulary with their counts."""
    rows = docs.select(F.col(id_col).cast("long").alias("id"), F.col(text_col).cast("string").cast("binary").alias("text"))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = vocabulary.keys()
        for batch in batches:
            ids, sizes, found, tfs, ends = [], [], [], [], [0]
            for doc, text in zip(batch.column("id").to_pylist(), batch.column("text"), strict=True):
                times, n = Counter(), 0
                for piece in terms(text.as_py()):
                    times.update(piece)
                    n += len(piece)
                if n:
                    here = times.keys() & known
                    ids.append(doc)
                    sizes.append(n)
                    found += [vocabulary[t] for t in here]
                    tfs += [times[t] for t in here]
                    ends.append(len(found))
            offsets = pa.array(ends, pa.int32())
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array(ids, pa.int64()), pa.array(sizes, pa.int64()),
                    pa.ListArray.from_arrays(offsets, pa.array(found, pa.int32())), pa.ListArray.from_arrays(offsets, pa.array(tfs, pa.int32())),
                ],
                names=["id", "n", "terms", "tfs"],
            )

    return rows.mapInArrow(count, "id long, n long, terms array<int>, tfs array<int>")


def _document_counts(postings: DataFrame, size: int) -> np.ndarray:
    """In how many documents each term of the vocabulary stands: one vector a task, added up by term."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            total += np.bincount(batch.column("terms").flatten().to_numpy(), minlength=size)
        there = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(there), pa.array(total[there])], names=["term", "n"])

    df = np.zeros(size, np.int64)
    for row in postings.select("terms").mapInArrow(count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).collect():
        df[row["term"]] = row["n"]
    return df


def _impacts(batch: pa.RecordBatch, weights: np.ndarray, documents: int, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(term, document in the batch, its score) of the postings, in 64-bit integers."""
    tf, ends = batch.column("tfs"), batch.column("tfs").offsets.to_numpy()
    term, tf = batch.column("terms").flatten().to_numpy(), tf.flatten().to_numpy().astype(np.int64)
    n = batch.column("n").to_numpy()
    m = 25 + (75 * n * documents) // length
    doc = np.repeat(np.arange(len(n)), np.diff(ends))
    return term, doc, weights[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))


def _best(ids: np.ndarray, scores: np.ndarray, k: int) -> np.ndarray:
    """Places of the ``k`` highest scores above 0, smaller ids first among equals."""
    at = np.flatnonzero(scores > 0)
    if len(at) > k:
        least = np.partition(scores[at], len(at) - k)[len(at) - k]
        at = at[scores[at] >= least]
    return at[np.lexsort((ids[at], -scores[at]))][:k]


def _rank_block(postings: DataFrame, keys: list, dag: SharingDag, weights: np.ndarray, documents: int, length: int, k: int) -> DataFrame:
    """(``item``, ``id``, ``score``): each task's ``k`` best documents of every item."""
    step = max(1, CELLS // max(1, len(weights)))
    last = np.iinfo(np.int64).max

    def rank(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        best: dict[int, tuple[np.ndarray, np.ndarray]] = {}
        for whole in batches:
            for start in range(0, whole.num_rows, step):
                batch = whole.slice(start, step)
                term, doc, score = _impacts(batch, weights, documents, length)
                columns = np.zeros((len(weights), batch.num_rows), np.int64)
                columns[term, doc] = score
                ids = batch.column("id").fill_null(last).to_numpy()
                for item, scores in dag.evaluate(columns):
                    least = best[item][1][-1] if item in best and len(best[item][1]) == k else 0
                    at = np.flatnonzero(scores >= max(1, least))
                    if len(at):
                        at = at[_best(ids[at], scores[at], k)]
                        both = [np.concatenate(x) for x in zip(best.get(item, (ids[:0], scores[:0])), (ids[at], scores[at]), strict=True)]
                        keep = _best(*both, k)
                        best[item] = both[0][keep], both[1][keep]
        for item, (ids, scores) in best.items():
            found = pa.array(ids, pa.int64(), mask=ids == last)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.full(len(ids), item, np.int64)), found, pa.array(scores)], names=["item", "id", "score"]
            )

    return postings.mapInArrow(rank, "item long, id long, score long")


def search(
    docs: DataFrame,
    items: DataFrame,
    k: int = 10,
    text_col: str = "text",
    id_col: str = "doc_id",
    item_col: str = "item_id",
    item_text_col: str = "text",
    block_items: int = ITEMS,
) -> DataFrame:
    """(``item_id``, ``rank`` int, ``doc_id`` long, ``score`` long): the ``k`` documents with the highest scores above 0 of every item.

    A term of weight w = floor(1000 ln((2N + 2) / (2df + 1))), tf times in a document, adds w ((10^9 tf) div (1000 tf + 8m)), as often as
    it stands in the item; m = 25 + (75 n N) div L.  Equal scores are ranked by ascending id, null ids last.

    Items are searched in blocks.  For a block, the terms that its items share are mined on the driver (``SharingDag``), every
    document is cut into terms once, and tasks score documents by blocks: each shared sum once, then the items along the
    graph.  Only a task's ``k`` best of each item are shuffled.  Null, empty and term-less texts match nothing; long ones
    are read whole; rows of documents are documents of their own, repeated ids included; rows that agree in item
    id and text are one item, others of that id are items of their own; other columns are ignored; either table may
    be empty.
    """
    spark = docs.sparkSession
    asked = written(items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).cast("string").alias("text")).distinct(), "items")
    size = asked.agg(F.count("*").alias("n"), F.sum(F.octet_length("text")).alias("bytes")).first()
    blocks = max(1, -(-size["n"] // block_items), -(-(size["bytes"] or 0) // ITEM_BYTES))
    found: DataFrame | None = None
    for number in range(blocks):
        rows = asked.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == number).orderBy("item_id", "text").collect()
        counted = [Counter(t for piece in terms(r["text"]) for t in piece) for r in rows]
        vocabulary = {t: i for i, t in enumerate(sorted({t for c in counted for t in c}))}
        postings = written(_postings(docs, text_col, id_col, vocabulary), "item-postings")
        total = postings.agg(F.count("*").alias("documents"), F.sum("n").alias("length")).first()
        documents, length = total["documents"], total["length"] or 1
        df = _document_counts(postings, len(vocabulary))
        weights = np.array([math.floor(1000 * math.log((2 * documents + 2) / (2 * n + 1))) for n in df.tolist()], np.int64)
        dag = SharingDag(Counter({vocabulary[t]: n for t, n in c.items()}) for c in counted)
        best = _rank_block(postings, rows, dag, weights, documents, length, k)
        ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("item").orderBy(F.desc("score"), F.asc_nulls_last("id"))))
        names = spark.createDataFrame(
            [(i, r["item_id"]) for i, r in enumerate(rows)], f"item long, item_id {asked.schema['item_id'].dataType.simpleString()}"
        )
        part = ranked.where(F.col("rank") <= k).join(F.broadcast(names), "item").select("item_id", "rank", F.col("id").alias("doc_id"), "score")
        found = part if found is None else found.unionByName(part)
    return found
