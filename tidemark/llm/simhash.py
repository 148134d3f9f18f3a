"""SimHash near-duplicates through an inverted index over fingerprint bytes."""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import release, schema_with, words, written
from tidemark.llm.components import connected_components

BYTES = 8
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def shingle_hashes(text: Column, width: int) -> Column:
    """XXH64 (seed 42) of every run of ``width`` words, repeats included; of all words where there are fewer."""
    def hashed(w: Column) -> Column:
        few = F.when(F.size(w) > 0, F.array(F.xxhash64(F.array_join(w, " ")))).otherwise(F.array().cast("array<bigint>"))
        starts = F.sequence(F.lit(1), F.size(w) - (width - 1))
        return F.when(
            F.size(w) > width,
            F.transform(starts, lambda i: F.xxhash64(F.array_join(F.slice(w, i, F.lit(width)), " "))),
        ).otherwise(few)

    # Bound to a variable, the words are split once a text, not once a shingle.
    return F.transform(F.array(words(F.translate(text, _UPPER, _LOWER))), hashed)[0]


def _majority(hashes: np.ndarray) -> int:
    """Bits set in over half of the hashes."""
    if not len(hashes):
        return 0
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        octets = hashes[at : at + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(octets, axis=1, bitorder="little").sum(axis=0, dtype=np.uint32)
    return int(np.packbits(ones * 2 > len(hashes), bitorder="little").view(np.int64)[0])


def _remixed(hashes: np.ndarray, number: int) -> np.ndarray:
    """Hashes of the same shingles for print ``number``; those of print 0 are the shingles' own."""
    if not number:
        return hashes
    with np.errstate(over="ignore"):
        z = hashes.view(np.uint64) + np.uint64(0x9E3779B97F4A7C15) * np.uint64(number)
        z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
        return (z ^ (z >> np.uint64(31))).view(np.int64)


def _fingerprint_batches(prints: int):
    def fingerprint(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lists = batch.column("hashes")
            flat, ends = lists.flatten().to_numpy(), lists.offsets.to_numpy()
            ends = ends - ends[0]
            found = [
                pa.array([_majority(_remixed(flat[a:b], r)) for a, b in zip(ends[:-1], ends[1:], strict=True)], pa.int64())
                for r in range(prints)
            ]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *found], names=["doc_id", *_names(prints)])

    return fingerprint


def _names(prints: int) -> list[str]:
    return ["fp", *(f"fp{r}" for r in range(1, prints))]


def fingerprints(
    docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", shingle: int = 3, prints: int = 1
) -> DataFrame:
    """(``doc_id`` as it is, ``fp`` long, and ``fp1``... for more prints): a row for every row.  A text without words has
    fingerprints of zero.  Further prints are of the same shingles, hashed anew."""
    hashed = docs.select(F.col(id_col).alias("doc_id"), shingle_hashes(F.col(text_col), shingle).alias("hashes"))
    return hashed.mapInArrow(
        _fingerprint_batches(prints), schema_with(hashed, ["doc_id"], ", ".join(f"{n} long" for n in _names(prints)))
    )


def _flips(bits: int, most: int) -> np.ndarray:
    """All masks of 1 to ``most`` set bits out of ``bits``."""
    out = [sum(1 << i for i in c) for n in range(1, most + 1) for c in combinations(range(bits), n)]
    return np.array(out, dtype=np.uint64)


def _spread(masks: np.ndarray, free: tuple[int, ...]) -> np.ndarray:
    """Masks over the free bytes, moved to their places in the fingerprint."""
    out = np.zeros(len(masks), dtype=np.uint64)
    for k, position in enumerate(free):
        out |= ((masks >> np.uint64(8 * k)) & np.uint64(255)) << np.uint64(8 * position)
    return out


def _forest(members: np.ndarray, masks: np.ndarray, most: int) -> tuple[np.ndarray, np.ndarray]:
    """Links of a forest that connects just what links of at most ``most`` bits connect, within one list."""
    members = np.sort(members)
    n = len(members)
    pairs: list[np.ndarray] = []
    if n <= len(masks):
        for i in range(n - 1):  # verify against all later members
            near = np.flatnonzero(np.bitwise_count(members[i + 1 :] ^ members[i]) <= most) + i + 1
            pairs.append(np.stack([np.full(len(near), i), near]))
    else:
        for mask in masks:  # verify by looking up every fingerprint within the distance
            other = members ^ mask
            at = np.minimum(np.searchsorted(members, other), n - 1)
            hit = np.flatnonzero((members[at] == other) & (at > np.arange(n)))
            pairs.append(np.stack([hit, at[hit]]))
    low, high = np.concatenate(pairs, axis=1) if pairs else np.zeros((2, 0), dtype=np.int64)
    root = np.arange(n)
    while len(low):
        a, b = root[low], root[high]
        differ = a != b
        low, high, a, b = low[differ], high[differ], a[differ], b[differ]
        np.minimum.at(root, np.maximum(a, b), np.minimum(a, b))
        while not np.array_equal(root, root[root]):
            root = root[root]
    moved = np.flatnonzero(root != np.arange(n))
    return members[moved], members[root[moved]]


def near_links(prints: DataFrame, max_bits: int) -> DataFrame:
    """Links (``a``, ``b``) between distinct fingerprints (``fp``) that connect the same fingerprints as all pairs
    at ``max_bits`` or fewer differing bits.

    Such a pair differs in at most ``max_bits`` of the eight bytes, so it shares at least ``need = 8 - max_bits``
    positional bytes.  An index of single bytes would put 1/256 of all fingerprints into each list; each list here
    stands for ``need`` positional bytes at once, C(8, need) lists a fingerprint, so that just the pairs whose tally
    reaches the guaranteed minimum meet.  Members of a list differ only in the other ``max_bits`` bytes: a list
    holds at most 2^(8 max_bits) fingerprints, however many documents there are (65 536 at 2 bits).  Inside a list
    pairs are verified by their differing bits, and the list answers with a forest: fewer links than members.
    """
    need = BYTES - max_bits
    if need < 1:
        raise ValueError("eight bytes guarantee a shared one for at most 7 bits")
    shared = list(combinations(range(BYTES), need))
    # As signed longs, as the column is.
    keep = [int(np.uint64(sum(255 << (8 * p) for p in c)).astype(np.int64)) for c in shared]
    postings = prints.select(
        "fp", F.posexplode(F.array(*[F.col("fp").bitwiseAND(F.lit(k)) for k in keep])).alias("which", "octets")
    )
    lists = postings.groupBy("which", "octets").agg(F.collect_list("fp").alias("members")).where(F.size("members") > 1)
    flips = _flips(8 * max_bits, max_bits)
    masks = [_spread(flips, tuple(p for p in range(BYTES) if p not in c)) for c in shared]

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            which, members = batch.column("which").to_numpy(), batch.column("members")
            flat, ends = members.flatten().to_numpy().view(np.uint64), members.offsets.to_numpy()
            ends = ends - ends[0]
            found = [_forest(flat[a:b], masks[w], max_bits) for w, a, b in zip(which, ends[:-1], ends[1:], strict=True)]
            a, b = (np.concatenate([x[i] for x in found] or [np.zeros(0, np.uint64)]).view(np.int64) for i in (0, 1))
            yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], names=["a", "b"])

    return lists.mapInArrow(verify, "a long, b long")


def simhash_components(
    docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", shingle: int = 3, max_bits: int = 2
) -> DataFrame:
    """(``doc_id``, ``fp`` long, ``fingerprint`` 16 hex digits, ``component_id``) for every row of ``docs``.

    ``component_id`` is the smallest id reached over links of at most ``max_bits`` differing bits, the row's own
    included.  Null, empty and blank texts have fingerprint zero and link like others; rows of a null id take part,
    and have a null component only where no id is reached; repeated rows get a row each; an empty table gives none.
    Other columns are ignored.  Equal fingerprints are reduced to one, map side first, before the index is built.
    """
    prints = written(fingerprints(docs, text_col, id_col, shingle), "fingerprints")
    distinct = written(prints.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "distinct-prints")
    return components(prints, distinct, near_links(distinct.select("fp"), max_bits)).select(
        "doc_id", "fp", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def components(prints: DataFrame, distinct: DataFrame, links: DataFrame) -> DataFrame:
    """``prints`` with the smallest id that each row reaches over the links of fingerprints."""
    roots = connected_components(links, "print-links")
    release(prints.sparkSession)
    # Written before the joins: both sides of these are then plain exchanges, of which a hot key's can be split.
    rooted = written(
        distinct.join(roots, distinct["fp"] == roots["node"], "left").select(
            "fp", "least_id", F.coalesce("root", "fp").alias("root")
        ),
        "rooted-prints",
    )
    least = written(rooted.groupBy("root").agg(F.min("least_id").alias("component_id")), "least-ids")
    named = written(rooted.join(least, "root").select("fp", "component_id"), "named-prints")
    return prints.join(named, "fp")
