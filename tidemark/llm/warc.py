"""WARC archives in seekable Zstandard bundles."""

from __future__ import annotations

import base64
import hashlib
import struct
import uuid
from collections.abc import Iterator

import pyarrow as pa
import zstandard
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm.common import shared_dir, written

#: Fixed values of the seekable format: skippable frame, footer magic.
SKIPPABLE = 0x184D2A5E
SEEKABLE = 0x8F92EAB1
VERSION = "WARC/1.1"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
_DATE = "2000-01-01T00:00:00Z"


def payload_digest(payload: bytes) -> str:
    return base64.b32encode(hashlib.sha1(payload).digest()).decode()


def base32(digest: str) -> str:
    """A digest in hex, as WARC states it."""
    return base64.b32encode(bytes.fromhex(digest)).decode()


def _urn(page_id: int | None) -> str:
    return f"<urn:page:{'' if page_id is None else page_id}>"


def _page(urn: str) -> int | None:
    number = urn.removeprefix("<urn:page:").removesuffix(">")
    return int(number) if number else None


def record(page_id: int | None, url: str | None, payload: bytes, digest: str, refers_to: int | None, revisit: bool) -> bytes:
    """One WARC record.  A revisit has no payload, but its digest and its length in an extension field."""
    body = b"" if revisit else payload
    clean = "".join(c for c in url or "" if c > " ")  # a field is one line
    fields = [
        VERSION,
        f"WARC-Type: {'revisit' if revisit else 'response'}",
        f"WARC-Record-ID: {_urn(page_id)}",
        f"WARC-Date: {_DATE}",
        *([f"WARC-Target-URI: {clean}"] if clean else []),
        f"WARC-Payload-Digest: sha1:{digest}",
        f"X-Payload-Length: {len(payload)}",
        *([f"WARC-Profile: {PROFILE}", f"WARC-Refers-To: {_urn(refers_to)}"] if revisit else []),
        "Content-Type: text/html; charset=utf-8",
        f"Content-Length: {len(body)}",
    ]
    return "\r\n".join(fields).encode("utf-8") + b"\r\n\r\n" + body + b"\r\n\r\n"


def parse_records(data: bytes) -> Iterator[tuple[int, dict[str, str], bytes]]:
    """(offset in ``data``, fields, body) of each record."""
    at = 0
    while at < len(data):
        end = data.index(b"\r\n\r\n", at)
        lines = data[at:end].decode("utf-8").split("\r\n")
        if lines[0] != VERSION:
            raise ValueError(f"no record at {at}")
        fields = dict(line.split(": ", 1) for line in lines[1:])
        stop = end + 4 + int(fields["Content-Length"])
        if data[stop : stop + 4] != b"\r\n\r\n":
            raise ValueError(f"record at {at} has another length than it states")
        yield at, fields, data[end + 4 : stop]
        at = stop + 4


class BundleWriter:
    """Frames of about ``frame_bytes`` of records, one after the other, and the seek table as the last frame."""

    def __init__(self, out, frame_bytes: int) -> None:
        self._out, self._limit = out, frame_bytes
        self._open: list[bytes] = []
        self._size = 0
        self.frames: list[tuple[int, int]] = []

    def add(self, data: bytes) -> tuple[int, int]:
        """(frame, offset inside it once unpacked) of the record."""
        if self._open and self._size + len(data) > self._limit:
            self._flush()
        place = len(self.frames), self._size
        self._open.append(data)
        self._size += len(data)
        return place

    def _flush(self) -> None:
        packed = zstandard.ZstdCompressor(level=3, write_checksum=True).compress(b"".join(self._open))
        self._out.write(packed)
        self.frames.append((len(packed), self._size))
        self._open, self._size = [], 0

    def close(self) -> None:
        if self._open:
            self._flush()
        table = b"".join(struct.pack("<II", *f) for f in self.frames)
        footer = struct.pack("<IBI", len(self.frames), 0, SEEKABLE)
        self._out.write(struct.pack("<II", SKIPPABLE, len(table) + len(footer)) + table + footer)


def seek_table(file) -> list[tuple[int, int, int]]:
    """(start in the file, packed bytes, unpacked bytes) of each frame, from the end of the file."""
    size = file.size()
    count, _, magic = struct.unpack("<IBI", file.read_at(9, size - 9))
    if magic != SEEKABLE:
        raise ValueError("no seek table")
    head = size - 9 - 8 * count - 8
    if struct.unpack("<II", file.read_at(8, head)) != (SKIPPABLE, 8 * count + 9):
        raise ValueError("the seek table is no skippable frame")
    out, at = [], 0
    for packed, unpacked in struct.iter_unpack("<II", file.read_at(8 * count, head + 8)):
        out.append((at, packed, unpacked))
        at += packed
    return out


def read_record(uri: str, frame: int, offset: int) -> tuple[dict[str, str], bytes]:
    """One record, by its entry in the index: the seek table and one frame are read, nothing else."""
    store, path = fs.FileSystem.from_uri(uri)
    with store.open_input_file(path) as file:
        start, packed, unpacked = seek_table(file)[frame]
        data = zstandard.ZstdDecompressor().decompress(file.read_at(packed, start), max_output_size=unpacked)
    _, fields, body = next(parse_records(data[offset:]))
    return fields, body


def with_roles(pages: DataFrame, smallest: int = 0) -> DataFrame:
    """(``page_id``, ``url``, ``payload``, ``digest`` (hex), ``revisit``, ``refers_to``): of records with equal payloads of at least ``smallest``
    bytes, that with the largest id is the response."""
    payload = F.coalesce(F.col("html").cast("string"), F.lit("")).cast("binary")
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), payload.alias("payload"))
    digested = rows.withColumns({"digest": F.sha1("payload"), "bytes": F.octet_length("payload")})
    # Written: the join then has plain exchanges on both sides, of which a hot payload's can be split.
    last = written(digested.groupBy("digest", "bytes").agg(F.max("page_id").alias("last")), "responses")
    joined = digested.join(last, ["digest", "bytes"])
    revisit = (F.col("bytes") >= smallest) & ~F.col("page_id").eqNullSafe(F.col("last"))
    return joined.select(
        "page_id", "url", "payload", "digest", revisit.alias("revisit"), F.when(revisit, F.col("last")).alias("refers_to")
    )


def write_bundles(pages: DataFrame, folder: str, smallest: int = 0, bundle_bytes: int = 1 << 26, frame_bytes: int = 1 << 18) -> DataFrame:
    """Write the pages (``page_id``, ``url``, ``html``) as bundles under ``folder`` (a URI that all machines reach) and return the index:
    (``page_id``, ``bundle``, ``frame``, ``offset``), written beside them.

    A task writes a bundle of up to ``bundle_bytes`` of records under a name of its own and reports it only when it is
    complete; files of lost or repeated attempts are in no index.  Frames are independent.  Null html is an
    empty payload; null ids and urls are written as none; repeated rows are records of their own (all rows with the
    largest id of a payload are responses); other columns are ignored; an empty table writes no bundle.
    """
    roles = with_roles(pages, smallest)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, top = fs.FileSystem.from_uri(folder)
        store.create_dir(top, recursive=True)
        writer, file, name, size = None, None, "", 0
        index: list[dict] = []

        def done() -> pa.RecordBatch:
            writer.close()
            file.close()
            return pa.RecordBatch.from_pylist(index, schema=_INDEX)

        for batch in batches:
            for row in zip(*(batch.column(n).to_pylist() for n in ("page_id", "url", "payload", "digest", "refers_to", "revisit")), strict=True):
                if writer is None:
                    name = f"{uuid.uuid4().hex}.warc.zst"
                    file = store.open_output_stream(f"{top}/{name}", compression=None)
                    writer, size, index = BundleWriter(file, frame_bytes), 0, []
                data = record(*row[:3], base32(row[3]), *row[4:])
                frame, offset = writer.add(data)
                index.append({"page_id": row[0], "bundle": f"{folder}/{name}", "frame": frame, "offset": offset})
                size += len(data)
                if size >= bundle_bytes:
                    yield done()
                    writer = None
        if writer is not None:
            yield done()

    return written(roles.mapInArrow(write, "page_id long, bundle string, frame int, offset long"), "warc-index")


_INDEX = pa.schema([("page_id", pa.int64()), ("bundle", pa.string()), ("frame", pa.int32()), ("offset", pa.int64())])


def read_bundles(bundles: DataFrame) -> DataFrame:
    """All records of the bundles (``bundle``), frame by frame: ``page_id``, ``record_type``, ``payload_digest``, ``payload_bytes``,
    ``refers_to``, ``url``, ``body``.  Digest and length of a response are those of its body; where its fields differ, it fails."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for uri in batch.column("bundle").to_pylist():
                store, path = fs.FileSystem.from_uri(uri)
                with store.open_input_file(path) as file:
                    for start, packed, unpacked in seek_table(file):
                        data = zstandard.ZstdDecompressor().decompress(file.read_at(packed, start), max_output_size=unpacked)
                        yield _rows(data)

    spark = bundles.sparkSession
    # Names are so small that adaptive execution would give them all to one task: their number says how many tasks read.
    tasks = max(1, min(bundles.count(), 4 * spark.sparkContext.defaultParallelism))
    return bundles.select("bundle").repartition(tasks).mapInArrow(
        read,
        "page_id long, record_type string, payload_digest string, payload_bytes long, refers_to long, url string, body binary",
    )


def _rows(data: bytes) -> pa.RecordBatch:
    out: list[dict] = []
    for _, fields, body in parse_records(data):
        revisit = fields["WARC-Type"] == "revisit"
        digest, length = fields["WARC-Payload-Digest"].removeprefix("sha1:"), int(fields["X-Payload-Length"])
        if not revisit and (digest, length) != (payload_digest(body), len(body)):
            raise ValueError(f"{fields['WARC-Record-ID']} has another payload than it states")
        out.append(
            {
                "page_id": _page(fields["WARC-Record-ID"]),
                "record_type": fields["WARC-Type"],
                "payload_digest": digest,
                "payload_bytes": length,
                "refers_to": _page(fields["WARC-Refers-To"]) if revisit else None,
                "url": fields.get("WARC-Target-URI"),
                "body": body,
            }
        )
    return pa.RecordBatch.from_pylist(out, schema=_RECORDS)


_RECORDS = pa.schema(
    [("page_id", pa.int64()), ("record_type", pa.string()), ("payload_digest", pa.string()), ("payload_bytes", pa.int64()),
     ("refers_to", pa.int64()), ("url", pa.string()), ("body", pa.binary())]
)


def archive_folder(spark: SparkSession) -> str:
    """A new folder for bundles in the cluster's shared folder, as a URI."""
    top = shared_dir(spark)
    return f"{top if ':' in top.split('/')[0] else 'file://' + top}/tidemark-llm/warc-{uuid.uuid4().hex}"


def round_trip(pages: DataFrame, smallest: int = 0) -> DataFrame:
    """Write the pages, then read all bundles of the index back."""
    index = write_bundles(pages, archive_folder(pages.sparkSession), smallest)
    return read_bundles(index.select("bundle").distinct())
