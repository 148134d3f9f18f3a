from __future__ import annotations

import base64
import hashlib
from collections import defaultdict

import pytest

from tidemark.llm import warc


def pages_of(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "1 as digest", "'x' as payload")


def brute(rows, smallest=0):
    groups = defaultdict(list)
    for i, _, html in rows:
        groups[(html or "").encode()].append(i)
    out = []
    for i, _, html in rows:
        data = (html or "").encode()
        last = max((x for x in groups[data] if x is not None), default=None)
        revisit = len(data) >= smallest and i != last
        digest = base64.b32encode(hashlib.sha1(data).digest()).decode()
        out.append((i, len(data), digest, "revisit" if revisit else "response", last if revisit else None))
    return sorted(out, key=str)


def rows_of(df):
    return sorted((tuple(r) for r in df.select("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to").collect()), key=str)


ROWS = [
    (1, "http://a/1", "<p>one</p>"), (2, None, "<p>one</p>"), (3, "http://a/ 3\r\nX: y", "zwei ü ☃ \r\n\r\nWARC/1.1"), (4, "u", None), (5, "u", ""),
    (6, "u", "x" * 600_000), (7, "u", "x" * 600_000), (8, "u", "<p>one</p>"), (8, "u", "<p>one</p>"), (None, "u", "lone"), (None, "u", "<p>one</p>"),
]


@pytest.mark.parametrize("smallest", [0, 11])
def test_round_trip(spark, smallest):
    assert rows_of(warc.round_trip(pages_of(spark, ROWS), smallest)) == brute(ROWS, smallest)


def test_given_pages(spark, sf):
    pages = spark.read.parquet(f"{sf}/pages.parquet")
    assert rows_of(warc.round_trip(pages)) == brute([(r.page_id, r.url, r.html) for r in pages.collect()])


def test_index_finds_single_records(spark):
    pages = pages_of(spark, [(i, f"http://h/{i}", f"page {i} " * 50) for i in range(300)])
    index = warc.write_bundles(pages, warc.archive_folder(spark), bundle_bytes=40_000, frame_bytes=4_000).collect()
    assert len({r.bundle for r in index}) > 2 and len({(r.bundle, r.frame) for r in index}) > 20
    for r in index[::37]:
        fields, body = warc.read_record(r.bundle, r.frame, r.offset)
        assert fields["WARC-Record-ID"] == f"<urn:page:{r.page_id}>" and body.decode() == f"page {r.page_id} " * 50


def test_bundle_is_plain_zstandard(spark, tmp_path):
    """Any reader of the format skips the seek table."""
    import zstandard

    index = warc.write_bundles(pages_of(spark, ROWS), warc.archive_folder(spark), frame_bytes=100)
    records = 0
    for r in index.select("bundle").distinct().collect():
        data = open(r.bundle.removeprefix("file://"), "rb").read()
        whole = zstandard.ZstdDecompressor().stream_reader(data, read_across_frames=True).read()
        records += len(list(warc.parse_records(whole)))
    assert records == len(ROWS)


def test_damage_is_noticed(spark):
    data = warc.record(1, "u", b"body", warc.payload_digest(b"other"), None, False)
    with pytest.raises(ValueError):
        warc._rows(data)


def test_empty(spark):
    assert warc.round_trip(pages_of(spark, [])).count() == 0


def test_bundles_are_read_by_many_tasks(spark, tmp_path):
    """Adaptive execution would give a handful of names to one task."""
    pages = pages_of(spark, [(i, "u", "<p>%d</p>" % i * 50) for i in range(200)]).repartition(8)
    index = warc.write_bundles(pages, f"file://{tmp_path}/w", bundle_bytes=1_000)
    names = index.select("bundle").distinct()
    assert names.count() > 40
    back = warc.read_bundles(names)
    tasks = back.rdd.getNumPartitions()
    assert min(names.count(), 4 * spark.sparkContext.defaultParallelism) == tasks > 1
    assert back.count() == 200
