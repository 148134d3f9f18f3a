"""A Merkle manifest of a dataset: content-addressed segments of the tree, and proofs by descent from the root."""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import written

FAN = 3
#: Levels of a stored segment: a task builds, or walks, at most 3^6 = 729 leaves of one at a time.
LEVELS = 6
SEGMENT = FAN**LEVELS
#: Rows of a range partition while leaves are numbered, and the most partitions.
RANGE, RANGES = 1 << 16, 8_192

_CHILDREN = "children array<struct<digest: string, parts: array<string>>>"
_PATH = "path array<struct<l: string, r: string>>"
_HASHED = pa.struct([("digest", pa.string()), ("parts", pa.list_(pa.string()))])
_STEP = pa.struct([("l", pa.string()), ("r", pa.string())])


def hashed(parts: list[str]) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def height(n: int) -> int:
    """Levels above ``n`` nodes until one is left."""
    levels = 0
    while n > 1:
        n, levels = -(-n // FAN), levels + 1
    return levels


def leaf_digest(*fields: Column) -> Column:
    """Digest of the fields, each ``-`` if null, else its UTF-8 length, a colon and its value."""
    texts = [f.cast("string") for f in fields]
    return F.sha2(F.concat(*[F.coalesce(F.concat(F.octet_length(t).cast("string"), F.lit(":"), t), F.lit("-")) for t in texts]), 256)


def numbered(rows: DataFrame, order: list[str]) -> DataFrame:
    """The rows with ``idx`` (from 0 in each ``tree``, by the columns of ``order``, which tell all rows apart) and ``n``, the tree's
    number of rows.  A range sort deals them out; positions within a partition need only the counts of earlier partitions, so
    a tree that holds a third of all rows lies in many tasks."""
    parts = min(RANGES, -(-rows.count() // RANGE)) or 1
    placed = rows.repartitionByRange(parts, "tree", *order).sortWithinPartitions("tree", *order)
    at = F.monotonically_increasing_id()
    placed = written(placed.withColumn("at", at), "placed-leaves").withColumn("part", F.shiftright("at", 33))
    counts = placed.groupBy("tree", "part").agg(F.min("at").alias("first"), F.count("*").alias("here"))
    ahead = Window.partitionBy("tree").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(
        "tree", "part", (F.coalesce(F.sum("here").over(ahead), F.lit(0)) - F.col("first")).alias("shift"),
        F.sum("here").over(Window.partitionBy("tree")).alias("n"),
    )
    return placed.join(starts, ["tree", "part"]).withColumn("idx", F.col("at") + F.col("shift")).drop("at", "part", "shift")


def _lifted(table: pa.Table) -> pa.Table:
    """A segment's nodes, in order, up to its top: one node, all with their children."""
    idx, digests = table["idx"].to_pylist(), table["digest"].to_pylist()
    now = [d for _, d in sorted(zip(idx, digests, strict=True))]
    n, tree, children = table["n"][0].as_py(), table["tree"][0].as_py(), []
    levels = min(LEVELS, height(n))
    for _ in range(levels):
        runs = [now[i : i + FAN] for i in range(0, len(now), FAN)]
        now = [hashed(run) for run in runs]
        children += [{"digest": d, "parts": run} for d, run in zip(now, runs, strict=True)]
    row = {"tree": tree, "idx": idx[0] // SEGMENT, "n": -(-n // FAN**levels), "digest": now[0], "levels": levels, "children": children}
    return pa.Table.from_pylist([row], schema=_SEGMENT)


_SEGMENT = pa.schema(
    [("tree", pa.string()), ("idx", pa.int64()), ("n", pa.int64()), ("digest", pa.string()), ("levels", pa.int32()),
     ("children", pa.list_(_HASHED))]
)


def build(leaves: DataFrame, most: int) -> tuple[DataFrame, list[DataFrame]]:
    """The roots (``tree``, ``digest``) of all trees over ``leaves`` (``tree``, ``idx``, ``n``, ``digest``), of which the largest has ``most``,
    and their records, a table for every ``LEVELS`` levels from the leaves up: ``digest`` of a segment's top, its
    ``levels``, and each node's digest with its children's.  Records are addressed by content: equal segments are stored once.
    """
    nodes, records = leaves.select("tree", "idx", "n", "digest"), []
    for number in range(-(-height(most) // LEVELS)):
        segment = F.expr(f"idx div {SEGMENT}").alias("segment")
        lifted = nodes.groupBy("tree", segment).applyInArrow(
            _lifted, f"tree string, idx long, n long, digest string, levels int, {_CHILDREN}"
        )
        made = written(lifted, f"merkle-{number}")
        records.append(made.where("levels > 0").select("digest", "levels", "children").dropDuplicates(["digest"]))
        nodes = made.select("tree", "idx", "n", "digest")
    return nodes.select("tree", "digest"), records


def _walk(top: str, children: dict[str, list[str]], digits: list[int]) -> tuple[str, list[tuple[str, str]]]:
    """The node that the digits lead to, and what is not selected on the way: digests before and after."""
    node, path = top, []
    for digit in digits:
        parts = children[node]
        path.append(("".join(parts[:digit]), "".join(parts[digit + 1 :])))
        node = parts[digit]
    return node, path


def _one_by_one(batch: pa.RecordBatch) -> Iterator[dict]:
    """A row holds a whole segment: of a batch, one at a time becomes Python objects."""
    for i in range(batch.num_rows):
        yield batch.slice(i, 1).to_pylist()[0]


def _digits(number: int, levels: int) -> list[int]:
    return [number // FAN**k % FAN for k in range(levels - 1, -1, -1)]


def _below(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for row in _one_by_one(batch):
            if row["levels"] is None:  # the tree is lower: nothing to descend here
                out = [{k: row[k] for k in ("tree", "subroot", "idx", "digest", "path")}]
            else:
                children = {c["digest"]: c["parts"] for c in row["children"]}
                level, out = [row["digest"]], []
                for _ in range(row["levels"]):
                    level = [p for node in level for p in children[node]]
                for i in range(len(level)):
                    node, path = _walk(row["digest"], children, _digits(i, row["levels"]))
                    steps = row["path"] + [{"l": a, "r": b} for a, b in path]
                    out.append(
                        {"tree": row["tree"], "subroot": row["subroot"], "idx": row["idx"] * FAN ** row["levels"] + i, "digest": node, "path": steps}
                    )
            yield pa.RecordBatch.from_pylist(out, schema=_FRONT)


_FRONT = pa.schema(
    [("tree", pa.string()), ("subroot", pa.string()), ("idx", pa.int64()), ("digest", pa.string()), ("path", pa.list_(_STEP))]
)
_FRONT_DDL = f"tree string, subroot string, idx long, digest string, {_PATH}"


def descend(front: DataFrame, records: list[DataFrame]) -> DataFrame:
    """From nodes (``tree``, ``subroot``, ``idx``, ``digest``, ``path``) down through the records, the topmost table first, to the nodes on which
    its lowest segments stand; every request below a node shares the node's row, and so its path."""
    for table in reversed(records):
        front = written(front.join(table, "digest", "left").mapInArrow(_below, _FRONT_DDL), "merkle-front")
    return front


def _proofs(root: str):
    def prove(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in _one_by_one(batch):
                children = {c["digest"]: c["parts"] for c in row["children"] or []}
                above = [(s["l"], s["r"]) for s in row["path"]]
                out = []
                for request in row["requests"]:
                    digits = _digits(request["idx"] % SEGMENT, row["levels"] or 0)
                    node, path = _walk(row["digest"], children, digits)
                    if node != request["leaf"]:
                        raise ValueError(f"the descent for leaf {request['idx']} of {row['tree']!r} ends elsewhere")
                    up = [*reversed(path), *reversed(above)]
                    folded = request["given"]
                    for left, right in up:
                        folded = hashed([left, folded, right])
                    out.append(
                        {
                            "doc_id": request["id"], "leaf": node, "subroot": row["subroot"], "root": root,
                            "proof_sha256": hashed([s for step in up for s in step]), "folded_root": folded, "verified": folded == root,
                        }
                    )
                yield pa.RecordBatch.from_pylist(out, schema=_PROOF)

    return prove


_PROOF = pa.schema([*((n, pa.string()) for n in ("leaf", "subroot", "root", "proof_sha256", "folded_root")), ("verified", pa.bool_())])
_PROOF = _PROOF.insert(0, pa.field("doc_id", pa.int64()))


def manifest(docs: DataFrame, tampered: Column | None = None, given: Column | None = None) -> DataFrame:
    """(``doc_id`` long, ``leaf``, ``subroot``, ``root``, ``proof_sha256``, ``folded_root``, ``verified``): a row for every row of ``docs`` (``doc_id``, ``source``, ``lang``,
    ``n_chars``, ``text``; other columns are ignored).

    Leaves are digests of rows; each source's, by ascending id, are hashed in runs of three until its subroot is left, and
    the subroots, by source (null first, bytewise), until the root is.  A leaf's proof are the other nodes of its runs up
    to the root, left to right.  Where ``tampered`` holds, a leaf of the text ``given`` in place of the row's own is folded with that
    proof; ``verified`` tells whether the root comes out.  A null id sorts first; rows that share source and id are
    ordered by their leaves, repeated rows are leaves of their own.  Null values are part of a leaf; empty and very long texts
    are hashed whole; an empty table gives no row.
    """
    kind = {"doc_id": "long", "source": "string", "lang": "string", "n_chars": "long", "text": "string"}
    fields = [F.col(c).cast(t) for c, t in kind.items()]
    own = leaf_digest(*fields)
    other = own if tampered is None else F.when(tampered, leaf_digest(*fields[:-1], given.cast("string"))).otherwise(own)
    # "" stands for the null source, "=" and its name for any other: never null, and in the order of the sources.
    tree = F.coalesce(F.concat(F.lit("="), fields[1]), F.lit(""))
    rows = docs.select(tree.alias("tree"), fields[0].alias("id"), own.alias("digest"), other.alias("given"))
    rows = written(rows.withColumn("row", F.monotonically_increasing_id()), "merkle-leaves")
    leaves = written(numbered(rows, ["id", "digest", "row"]).drop("row"), "numbered-leaves")
    most = leaves.agg(F.max("n")).first()[0] or 0
    subroots, records = build(leaves, most)

    tops = subroots.select(F.lit("").alias("tree"), F.col("tree").alias("name"), "digest")
    tops = written(numbered(written(tops, "subroots"), ["name"]), "numbered-subroots")
    roots, upper = build(tops, tops.count())
    root = next((r["digest"] for r in roots.take(1)), "")
    start = roots.select("tree", F.lit("").alias("subroot"), F.lit(0).cast("long").alias("idx"), "digest", F.expr(f"cast(array() as {_PATH[5:]})").alias("path"))
    names = tops.select("idx", F.col("name").alias("tree"))
    front = descend(start, upper).join(names, "idx").select(
        names["tree"], F.col("digest").alias("subroot"), F.lit(0).cast("long").alias("idx"), "digest", "path"
    )

    requests = leaves.groupBy("tree", F.expr(f"idx div {SEGMENT}").alias("idx")).agg(
        F.collect_list(F.struct("idx", "id", F.col("digest").alias("leaf"), "given")).alias("requests")
    )
    met = descend(front, records[1:]).join(requests, ["tree", "idx"])
    low = records[0] if records else front.select("digest", F.lit(None).cast("int").alias("levels"), F.lit(None).cast(_CHILDREN[9:]).alias("children")).limit(0)
    proofs = met.join(low, "digest", "left").select("tree", "subroot", "digest", "path", "levels", "children", "requests")
    return proofs.mapInArrow(
        _proofs(root),
        "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean",
    )
