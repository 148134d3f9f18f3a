"""Exact removal of byte strings that repeat anywhere in a corpus, by prefix-free parsing.

Rolling-hash triggers cut every text into phrases (``phrases``).  The *parse* is the table of phrase occurrences, the
*dictionary* the table of distinct phrases with their multiplicities.  Where all occurrences of a trigger lie in
one and the same phrase, that phrase's suffixes are equal wherever it stands and the parse settles them; only
suffixes of phrases that differ around a shared trigger are compared.  Neighbouring suffixes, counted from the
trigger, share a core; a core that no other phrase has settles them, and the rest are compared one by one, as 128-bit
names of their first ``length`` bytes.  Names stand for ranks in suffix order: which suffixes agree on ``length`` bytes is all that removal asks, and
names can be summed map side, whereas a sorted run of equal suffixes would lie in one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import free_name, release, schema_with, written
from tidemark.llm.phrases import TRIGGER, phrases

#: A run of window starts in one long: first start * 2^32 + offset of the trigger * 2^16 + number of starts - 1.
PLACE, _ANCHOR = 32, 16
_FEW = (1 << _ANCHOR) - 1
#: Suffixes with a common core.
BLOCK = 16
#: Rows that a task gathers before it hands them on.
_ROWS = 100_000


def _signed(value: int) -> int:
    return value - (1 << 64) if value >> 63 else value


def _key(data: bytes) -> tuple[int, int]:
    digest = xxhash.xxh3_128_intdigest(data)
    return _signed(digest >> 64), _signed(digest & (1 << 64) - 1)


def _longs(columns: dict[str, list]) -> pa.RecordBatch:
    arrays = [pa.array(np.concatenate([np.zeros(0, np.int64), *map(np.atleast_1d, c)])) for c in columns.values()]
    return pa.RecordBatch.from_arrays(arrays, names=list(columns))


def _parse(length: int):
    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Every phrase occurrence: trigger, hash of the phrase, key of the text, place."""
        name = xxhash.xxh3_64_intdigest
        out: dict[str, list] = {x: [] for x in "fctup"}
        rows = 0
        for batch in batches:
            for data in batch.column(0):
                data = data.as_py()
                t, u = _key(data)
                for starts, counts, places, triggers in phrases(data, length):
                    stops = (starts + counts + (length - 1)).tolist()
                    content = [name(data[a:b]) for a, b in zip(starts.tolist(), stops, strict=True)]
                    out["f"].append(triggers.view(np.int64))
                    out["c"].append(np.array(content, dtype=np.uint64).view(np.int64))
                    out["t"].append(np.full(len(starts), t))
                    out["u"].append(np.full(len(starts), u))
                    out["p"].append((starts << PLACE) + (places - starts << _ANCHOR) + counts - 1)
                    rows += len(starts)
                if rows >= _ROWS:
                    yield _longs(out)
                    out, rows = {x: [] for x in "fctup"}, 0
        yield _longs(out)

    return parse


def _keyed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Texts packed beside their key; other columns stay."""
    pack = zstandard.ZstdCompressor(level=3)
    for batch in batches:
        at = batch.schema.names.index("bytes")
        texts = batch.column(at).to_pylist()
        keys = np.array([_key(x) for x in texts], dtype=np.int64).reshape(-1, 2)
        rest = [i for i in range(batch.num_columns) if i != at]
        yield pa.RecordBatch.from_arrays(
            [
                *(batch.column(i) for i in rest),
                pa.array(keys[:, 0]),
                pa.array(keys[:, 1]),
                pa.array([pack.compress(x) for x in texts], pa.binary()),
            ],
            names=[*(batch.schema.names[i] for i in rest), "t", "u", "packed"],
        )


def _show(length: int):
    def show(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The bytes of the dictionary's phrases, cut out of the texts that show them."""
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            columns: dict[str, list] = {x: [] for x in ("f", "c", "n", "t", "u", "p", "bytes")}
            for packed, t, u, shown in zip(
                *(batch.column(x).to_pylist() for x in ("packed", "t", "u", "shown")), strict=True
            ):
                data = unpack.decompress(packed)
                for x in shown:
                    start = x["p"] >> PLACE
                    row = (x["f"], x["c"], x["n"], t, u, x["p"], data[start : start + (x["p"] & _FEW) + length])
                    for column, value in zip(columns.values(), row, strict=True):
                        column.append(value)
            kinds = [pa.int64()] * 6 + [pa.binary()]
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, k) for c, k in zip(columns.values(), kinds, strict=True)], names=list(columns)
            )

    return show


def _cores(length: int):
    def cores(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The phrases' suffixes by blocks of distance to the trigger: (trigger, hash of the bytes that all suffixes of
        the block have, phrase, number of the block, multiplicity)."""
        name = xxhash.xxh3_64_intdigest
        for batch in batches:
            out: dict[str, list] = {x: [] for x in ("f", "k", "c", "b", "n")}
            f, c, n, p = (batch.column(x).to_pylist() for x in "fcnp")
            for i, data in enumerate(batch.column("bytes").to_pylist()):
                anchor = (p[i] >> _ANCHOR) & _FEW
                blocks = range((anchor - (p[i] & _FEW)) // BLOCK, anchor // BLOCK + 1)
                last = [anchor - b * BLOCK for b in blocks]
                core = [name(data[max(0, s) : s - BLOCK + 1 + length], b) for s, b in zip(last, blocks, strict=True)]
                out["k"].append(np.array(core, dtype=np.uint64).view(np.int64))
                out["b"].append(np.array(blocks, dtype=np.int64))
                for x, value in (("f", f[i]), ("c", c[i]), ("n", n[i])):
                    out[x].append(np.full(len(core), value))
            yield _longs(out)

    return cores


def _suffixes(length: int, placed: bool):
    names = ("f", "w", *(("c", "p") if placed else ("n",)))

    def suffixes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """The suffixes in the phrases' open blocks by name (trigger, hash of ``length`` bytes), with the multiplicity or
        (``placed``) with phrase and place in it."""
        name = xxhash.xxh3_64_intdigest
        for batch in batches:
            out: dict[str, list] = {x: [] for x in names}
            rows = 0
            f, c, n, p = (batch.column(x).to_pylist() for x in "fcnp")
            opened = batch.column("open").to_pylist()
            for i, data in enumerate(batch.column("bytes").to_pylist()):
                anchor = (p[i] >> _ANCHOR) & _FEW
                starts = [s for b in opened[i] for s in range(anchor - b * BLOCK - BLOCK + 1, anchor - b * BLOCK + 1)]
                starts = [s for s in starts if 0 <= s <= p[i] & _FEW]
                hashed = [name(data[s : s + length], 1) for s in starts]
                out["w"].append(np.array(hashed, dtype=np.uint64).view(np.int64))
                for x, value in (("f", f[i]), ("c", c[i]), ("n", n[i])):
                    if x in out:
                        out[x].append(np.full(len(starts), value))
                if placed:
                    out["p"].append(np.array(starts, dtype=np.int64))
                rows += len(starts)
                if rows >= _ROWS:
                    yield _longs(out)
                    out, rows = {x: [] for x in names}, 0
            yield _longs(out)

    return suffixes


def repeated_places(docs: DataFrame, text_col: str, length: int) -> DataFrame:
    """(``t``, ``u``, ``spans``): by text key, the runs of starts (see ``PLACE``) whose ``length`` bytes also start elsewhere.
    Texts without any have no row."""
    spark = docs.sparkSession
    data = docs.select(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("bytes"))
    parse = data.mapInArrow(_parse(length), "f long, c long, t long, u long, p long")

    triggers = parse.groupBy("f").agg(F.count("*").alias("n"), F.min("c").alias("c0"), F.max("c").alias("c1"))
    triggers = written(triggers.where("n > 1").select("f", F.expr("c0 <> c1").alias("differ")), "triggers")
    release(spark)
    # A window whose trigger occurs once occurs once; the rest of the parse is kept.
    parse = written(parse.join(triggers, "f"), "parse")
    release(spark)

    counted = written(
        parse.where("differ").groupBy("f", "c").agg(F.count("*").alias("n"), *[F.first(x).alias(x) for x in "tup"]),
        "counted-phrases",
    )
    # Where every phrase around a trigger occurs again, all of its suffixes do.
    unsure = written(counted.groupBy("f").agg(F.min("n").alias("least")).where("least = 1").select("f"), "unsure")
    wanted = counted.join(unsure, "f").groupBy("t", "u").agg(F.collect_list(F.struct("f", "c", "n", "p")).alias("shown"))
    dictionary = (
        data.mapInArrow(_keyed, "t long, u long, packed binary")
        .join(written(wanted, "wanted"), ["t", "u"])
        .mapInArrow(_show(length), "f long, c long, n long, t long, u long, p long, bytes binary")
        .dropDuplicates(["f", "c"])
    )
    dictionary = written(dictionary, "dictionary")
    release(spark)
    cores = dictionary.mapInArrow(_cores(length), "f long, k long, c long, b long, n long")
    shared = cores.groupBy("f", "k").agg(F.count("*").alias("phrases"), F.min("n").alias("least"))
    shared = written(shared.where("phrases > 1 and least = 1").select("f", "k"), "cores")
    opened = written(cores.join(shared, ["f", "k"]).groupBy("f", "c").agg(F.collect_list("b").alias("open")), "open-blocks")
    release(spark)
    dictionary = written(dictionary.join(opened, ["f", "c"]), "open-phrases")
    release(spark)
    named = dictionary.mapInArrow(_suffixes(length, False), "f long, w long, n long")
    again = written(named.groupBy("f", "w").agg(F.sum("n").alias("n")).where("n > 1").select("f", "w"), "suffixes")
    release(spark)
    alone = dictionary.where("n = 1").mapInArrow(_suffixes(length, True), "f long, w long, c long, p long")
    # At most one start for each window of a phrase.
    found = written(alone.join(again, ["f", "w"]).groupBy("f", "c").agg(F.collect_set("p").alias("starts")), "found")
    release(spark)
    first = F.shiftright("p", PLACE)
    shown = (
        dictionary.where("n = 1").select("f", "c", "t", "u", first.alias("first")).join(found, ["f", "c"])
        .select("t", "u", F.explode("starts").alias("s"), "first")
        .select("t", "u", F.shiftleft(F.col("first") + F.col("s"), PLACE).alias("p"))
    )
    # A phrase settles its windows wherever it stands, unless it stands once: that place is taken out again beside its text.  So no
    # occurrence is joined with its phrase.  Starts found one by one are apart: one may be written like a place that is taken out.
    kinds = {"settled": parse, "single": counted.where("n = 1"), "found": shown}
    places = None
    for kind, rows in kinds.items():
        rows = rows.select("t", "u", *[(F.col("p") if k == kind else F.lit(None).cast("long")).alias(k) for k in kinds])
        places = rows if places is None else places.unionByName(rows)
    gathered = places.groupBy("t", "u").agg(*[F.collect_set(k).alias(k) for k in kinds])
    spans = gathered.select("t", "u", F.array_union(F.array_except("settled", "single"), "found").alias("spans"))
    spans = written(spans.where(F.size("spans") > 0), "spans")
    release(spark)
    return spans


def _cut_runs(spans: np.ndarray | None, length: int) -> list[tuple[int, int]]:
    """Maximal covered byte runs."""
    if spans is None or not len(spans):
        return []
    spans = np.sort(spans)
    starts, reach = spans >> PLACE, np.maximum.accumulate((spans >> PLACE) + (spans & _FEW) + length)
    new = np.flatnonzero(np.concatenate(([True], starts[1:] > reach[:-1])))
    return list(zip(starts[new].tolist(), reach[np.append(new[1:] - 1, len(starts) - 1)].tolist(), strict=True))


def _cut(length: int):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor()
        for batch in batches:
            kept, removed = [], []
            for packed, spans in zip(batch.column("packed").to_pylist(), batch.column("spans"), strict=True):
                data = unpack.decompress(packed)
                runs = _cut_runs(spans.values.to_numpy() if spans.is_valid else None, length)
                edges = [0, *(x for run in runs for x in run), len(data)]
                kept.append(b"".join(data[a:b] for a, b in zip(edges[::2], edges[1::2], strict=True)))
                removed.append([{"start": a, "stop": b} for a, b in runs])
            names = [n for n in batch.schema.names if n not in ("packed", "spans")]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(n) for n in names),
                    pa.array(kept, pa.binary()),
                    pa.array(removed, pa.list_(pa.struct([("start", pa.int64()), ("stop", pa.int64())]))),
                ],
                names=[*names, "kept", "removed"],
            )

    return cut


def remove_repeats(docs: DataFrame, text_col: str = "text", length: int = 200, keep: list[str] | None = None) -> DataFrame:
    """The rows of ``docs`` (columns ``keep``, all but the text by default) with ``kept`` (binary: the bytes that stay, in
    order) and ``removed`` (array of (``start``, ``stop``) byte runs, maximal, in order).

    A byte goes if it lies in a ``length``-byte string that starts at another place too, in the same text or another;
    overlapping occurrences count, no string crosses texts, and all strings are judged on the input.  Null texts
    are empty; texts under ``length`` bytes stay; repeated rows are occurrences of their own.  Columns of ``docs``
    called ``kept`` or ``removed`` are replaced.  An empty table gives none.  ``length`` must be at least 65.
    """
    if length <= TRIGGER:
        raise ValueError(f"strings must be longer than {TRIGGER} bytes")
    spans = repeated_places(docs, text_col, length)
    names = [c for c in docs.columns if c != text_col] if keep is None else keep
    names = [c for c in names if c not in ("kept", "removed")]
    rows = docs.select(
        F.struct(*[F.col(f"`{c}`") for c in names]).alias("row"),
        F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary").alias("bytes"),
    )
    keyed = rows.mapInArrow(_keyed, schema_with(rows, ["row"], "t long, u long, packed binary"))
    return (
        keyed.join(spans, ["t", "u"], "left")
        .select("row", "packed", "spans")
        .mapInArrow(_cut(length), schema_with(rows, ["row"], "kept binary, removed array<struct<start: bigint, stop: bigint>>"))
        .select("row.*", "kept", "removed")
    )


def digests(cut: DataFrame) -> DataFrame:
    """Counts and the SHA-256 of what stays, for a result of ``remove_repeats`` that has ``doc_id``."""
    gone = F.aggregate("removed", F.lit(0).cast("long"), lambda a, x: a + x["stop"] - x["start"])
    return cut.select(
        "doc_id",
        (F.octet_length("kept") + gone).alias("n_bytes"),
        gone.alias("n_removed"),
        F.size("removed").cast("long").alias("n_spans"),
        F.sha2("kept", 256).alias("kept_sha256"),
    )


def without_repeats(docs: DataFrame, text_col: str = "text", length: int = 200) -> DataFrame:
    """The rows and columns of ``docs`` with the bytes that stay as their text; texts that lose nothing, null ones included,
    are as they were.  A cut may split a letter; what is left of it is no text and goes."""
    rest = [c for c in docs.columns if c != text_col]
    missing = free_name(rest)
    rows = docs.select(F.struct(*[F.col(f"`{c}`") for c in rest], F.col(text_col).isNull().alias(missing)).alias("row"), F.col(text_col).alias("text"))
    cut = remove_repeats(rows, "text", length)

    def decode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept = pa.array([x.decode("utf-8", "ignore") for x in batch.column("kept").to_pylist()], pa.string())
            yield pa.RecordBatch.from_arrays([batch.column("row"), kept], names=["row", "text"])

    new = cut.select("row", "kept").mapInArrow(decode, rows.schema)
    text = F.when(~F.col(f"row.`{missing}`"), F.col("text")).alias(text_col)
    return new.select(*[text if c == text_col else F.col(f"row.`{c}`") for c in docs.columns])
