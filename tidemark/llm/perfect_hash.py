"""Exact duplicates by a minimal perfect hash over the digests of history."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import written

#: Digests of a shard, on average: a shard is built, and looked into, by one task.
SHARD = 8_192
#: Bits that a level has for each digest it tries to place.
BITS = 2
_WIDTH = 32
_INDEX = "shard long, sizes array<int>, bits binary, digests binary, ids binary, known binary, rows binary, counts binary"
_GROUPS = "digest binary, id long, row long, size long, member boolean"


def _mixed(words: np.ndarray, level: int) -> np.ndarray:
    """A hash of each digest (a row of four words) for a level; all 256 bits take part."""
    with np.errstate(over="ignore"):
        z = np.full(len(words), (0x9E3779B97F4A7C15 * (level + 1)) % (1 << 64), np.uint64)
        for k in range(4):
            z = (z ^ words[:, k]) * np.uint64(0xBF58476D1CE4E5B9)
            z ^= z >> np.uint64(29)
        return z


def _words(digests: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(digests).view("<u8").reshape(-1, 4)


class PerfectHash:
    """Distinct digests -> 0 to n - 1, each once.

    A level hashes what is left into twice as many bits; digests alone on their bit are placed there, the others go to the
    next level (Limasset and others, 2017).  The slot is the number of set bits before the digest's own.
    """

    def __init__(self, sizes: list[int], bits: bytes) -> None:
        self.sizes, self.bits = sizes, np.frombuffer(bits, "<u8")
        self._before = np.concatenate([[0], np.cumsum(np.bitwise_count(self.bits), dtype=np.int64)])

    @classmethod
    def of(cls, digests: np.ndarray) -> PerfectHash:
        left, sizes, parts = _words(digests), [], []
        while len(left):
            if len(sizes) == 200:
                raise ValueError("the digests are not distinct")
            size = -(-BITS * len(left) // 64) * 64
            at = (_mixed(left, len(sizes)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(at, minlength=size) == 1
            sizes.append(size)
            parts.append(np.packbits(alone, bitorder="little").tobytes())
            left = left[~alone[at]]
        return cls(sizes, b"".join(parts))

    def slots(self, digests: np.ndarray) -> np.ndarray:
        """The slot of each digest; of those that were not placed some slot or -1."""
        words = _words(digests)
        out, open_, first = np.full(len(words), -1, np.int64), np.arange(len(words)), 0
        for level, size in enumerate(self.sizes):
            at = (_mixed(words[open_], level) % np.uint64(size)).astype(np.int64) + first
            word, bit = self.bits[at >> 6], (at & 63).astype(np.uint64)
            here = (word >> bit) & np.uint64(1) == 1
            below = np.bitwise_count(word & ((np.uint64(1) << bit) - np.uint64(1)))
            out[open_[here]] = (self._before[at >> 6] + below)[here]
            open_, first = open_[~here], first + size
        return out


def _array(digests: pa.ChunkedArray) -> np.ndarray:
    return np.frombuffer(b"".join(digests.to_pylist()), np.uint8).reshape(-1, _WIDTH)


def text_digests(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id") -> DataFrame:
    """(``id``, ``row``, ``digest``): SHA-256 of every whole text with A-Z in lower case (null: empty), the row's id, and a number of
    its own, its locator.  Written, so that the locators stay as they are."""
    rows = docs.select(
        F.col(id_col).cast("long").alias("id"),
        F.monotonically_increasing_id().alias("row"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("text"),
    )

    def digest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            # bytes.lower() changes A-Z only; no byte of a longer UTF-8 letter is one of them.
            found = [hashlib.sha256(t.as_py().lower()).digest() for t in batch.column("text")]
            yield pa.RecordBatch.from_arrays(
                [batch.column("id"), batch.column("row"), pa.array(found, pa.binary())], names=["id", "row", "digest"]
            )

    return written(rows.mapInArrow(digest, "id long, row long, digest binary"), "text-digests")


def digest_groups(digests: DataFrame) -> DataFrame:
    """(``digest``, ``id``, ``row``, ``size``): a row for each distinct digest, with the largest id (nulls least; of equal ids the
    largest locator) and the number of its rows.  Summed in tasks before the shuffle, so no group is gathered."""
    best = digests.groupBy("digest").agg(F.max(F.struct("id", "row")).alias("best"), F.count("*").alias("size"))
    return best.select("digest", "best.id", "best.row", "size")


def _sharded(groups: DataFrame, shards: int) -> DataFrame:
    return groups.select(F.pmod(F.xxhash64("digest"), F.lit(shards)).alias("shard"), "*")


def _pack(values: list, kind: str) -> bytes:
    return np.array([0 if v is None else v for v in values], kind).tobytes()


def build_index(groups: DataFrame, shards: int) -> DataFrame:
    """The index of historical groups, written: a row for each shard with its perfect hash and, slot by slot, the full
    digest, the winner's id and locator, and the number of rows.  Digests spread evenly, so a shard holds about
    ``SHARD`` of them whatever the texts are."""

    def build(table: pa.Table) -> pa.Table:
        digests = _array(table["digest"])
        hashed = PerfectHash.of(digests)
        table = table.take(pa.array(np.argsort(hashed.slots(digests))))
        ids = table["id"].to_pylist()
        row = {
            "shard": table["shard"][0].as_py(),
            "sizes": hashed.sizes,
            "bits": hashed.bits.tobytes(),
            "digests": b"".join(table["digest"].to_pylist()),
            "ids": _pack(ids, "<i8"),
            "known": _pack([i is not None for i in ids], "u1"),
            "rows": _pack(table["row"].to_pylist(), "<i8"),
            "counts": _pack(table["size"].to_pylist(), "<i8"),
        }
        return pa.Table.from_pylist([row], schema=_INDEX_ARROW)

    return written(_sharded(groups, shards).groupBy("shard").applyInArrow(build, _INDEX), "perfect-hash")


_INDEX_ARROW = pa.schema(
    [("shard", pa.int64()), ("sizes", pa.list_(pa.int32())), *((n, pa.binary()) for n in ("bits", "digests", "ids", "known", "rows", "counts"))]
)
_GROUPS_ARROW = pa.schema(
    [("digest", pa.binary()), ("id", pa.int64()), ("row", pa.int64()), ("size", pa.int64()), ("member", pa.bool_())]
)


def absorb(index: DataFrame, groups: DataFrame, shards: int) -> DataFrame:
    """All groups of history and of a new batch (``digest``, ``id``, ``row``, ``size``, ``member``: of history).

    Each digest of the batch is looked up in its shard.  Where its slot holds the same 32 bytes it repeats history: the slot
    keeps the larger of both winners and the sum of both sizes.  All others are no members and stay groups of their own.
    """

    def fold(kept: pa.Table, batch: pa.Table) -> pa.Table:
        ids, rows, sizes = (batch[c].to_pylist() for c in ("id", "row", "size"))
        new = batch["digest"].to_pylist()
        if not kept.num_rows:
            return pa.Table.from_arrays(
                [pa.array(x, t) for x, t in zip((new, ids, rows, sizes, [False] * len(new)), _GROUPS_ARROW.types)], schema=_GROUPS_ARROW
            )
        slot = {c: kept[c][0].as_py() for c in kept.column_names if c != "shard"}
        held = np.frombuffer(slot["digests"], np.uint8).reshape(-1, _WIDTH)
        known = np.frombuffer(slot["known"], "u1")
        old_ids = [i if k else None for i, k in zip(np.frombuffer(slot["ids"], "<i8").tolist(), known, strict=True)]
        old_rows = np.frombuffer(slot["rows"], "<i8").tolist()
        old_sizes = np.frombuffer(slot["counts"], "<i8").tolist()
        digests = [slot["digests"][i : i + _WIDTH] for i in range(0, len(slot["digests"]), _WIDTH)]
        member = [True] * len(digests)
        if new:
            asked = _array(batch["digest"])
            at = PerfectHash(slot["sizes"], slot["bits"]).slots(asked)
            same = (at >= 0) & (held[at] == asked).all(axis=1)
            for i in range(len(new)):
                if same[i]:
                    s = int(at[i])
                    if (ids[i] is not None, ids[i] or 0, rows[i]) > (old_ids[s] is not None, old_ids[s] or 0, old_rows[s]):
                        old_ids[s], old_rows[s] = ids[i], rows[i]
                    old_sizes[s] += sizes[i]
                else:
                    for column, value in zip((digests, old_ids, old_rows, old_sizes, member), (new[i], ids[i], rows[i], sizes[i], False), strict=True):
                        column.append(value)
        columns = (digests, old_ids, old_rows, old_sizes, member)
        return pa.Table.from_arrays([pa.array(x, t) for x, t in zip(columns, _GROUPS_ARROW.types, strict=True)], schema=_GROUPS_ARROW)

    both = index.groupBy("shard").cogroup(_sharded(groups, shards).groupBy("shard"))
    return both.applyInArrow(fold, _GROUPS)


def exact_duplicates(docs: DataFrame, text_col: str = "text", id_col: str = "doc_id", shard: int = SHARD) -> DataFrame:
    """(``doc_id`` long, ``keep_id``, ``group_size`` long, ``kept``, ``text_sha256``, ``in_history``): a row for every row of ``docs``.

    Texts are equal when they are identical with A-Z in lower case; null counts as empty.  Of equal texts the row with the
    largest id stays (a null id is least, and of rows that share the id just one stays).  The older half of the documents, up to
    the median id, is history and is compiled into the index; the others are looked up in it (``absorb``), so ``in_history``
    tells whether the text was known before.  How the halves are cut changes nothing else.  Repeated rows get a row
    each; very long texts are digested whole; other columns are ignored; an empty table gives none.
    """
    digests = text_digests(docs, text_col, id_col)
    middle = digests.agg(F.percentile_approx("id", 0.5, 1000)).first()[0]
    old = F.coalesce(F.col("id") <= F.lit(middle).cast("long"), F.lit(False))
    history = written(digest_groups(digests.where(old)), "history-groups")
    shards = max(1, -(-history.count() // shard))
    groups = absorb(build_index(history, shards), digest_groups(digests.where(~old)), shards)
    # Texts that stand once need no winner's name: every row that finds none is alone.  Written, so that both sides of the join
    # are plain exchanges, of which a hot digest's can be split.
    repeated = written(groups, "digest-winners").where((F.col("size") > 1) | F.col("member"))
    named = repeated.select("digest", F.col("id").alias("keep_id"), F.col("row").alias("winner"), "size", "member")
    alone = F.col("winner").isNull()
    return digests.join(named, "digest", "left").select(
        F.col("id").alias("doc_id"),
        F.when(alone, F.col("id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("size", F.lit(1).cast("long")).alias("group_size"),
        (alone | (F.col("row") == F.col("winner"))).alias("kept"),
        F.lower(F.hex("digest")).alias("text_sha256"),
        F.coalesce("member", F.lit(False)).alias("in_history"),
    )
