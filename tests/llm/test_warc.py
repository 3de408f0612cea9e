"""Operator 1: archives read back by the library and by plain zstandard."""

import hashlib
import io

import pytest
import zstandard
from pyspark.sql import functions as F

from forecourt.llm import warc
from forecourt.llm.common import open_input, scratch_path

BIG = "<p>" + "payload " * 200
PAGES = [
    (1, "http://a/é x", BIG),
    (2, None, BIG),
    (3, "http://c/", BIG),
    (3, "http://c/", BIG),
    (4, "http://d/", "small"),
    (5, "http://e/", "small"),
    (6, "http://f/", None),
    (None, "http://g/", BIG),
    (None, "http://h/", BIG + "only without id"),
    (None, "http://i/", BIG + "only without id"),
    (7, "http://j/\r\nX: y", "é" * 3_000_000),
    (8, "http://k/", ""),
]


@pytest.fixture
def pages(spark):
    rows = [(*r, "x") for r in PAGES]
    return spark.createDataFrame(rows, "page_id long, url string, html string, refers_to string")


def expected():
    found = []
    for page_id, _, html in PAGES:
        payload = (html or "").encode()
        same = [p for p, _, h in PAGES if (h or "") == (html or "") and p is not None]
        first = max(same, default=None)
        again = len(payload) >= 1000 and first is not None and page_id != first
        found.append(
            (
                page_id,
                len(payload),
                hashlib.sha1(payload).hexdigest(),
                "revisit" if again else "response",
                first if again else None,
            )
        )
    return found


def test_round_trip(spark, pages):
    found = warc.archive_round_trip(spark, pages)
    names = ["page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    rows = [tuple(r) for r in found.select(*names).collect()]
    assert sorted(rows, key=repr) == sorted(expected(), key=repr)


def test_records_are_frames_of_their_own(spark, pages):
    more = pages.unionByName(
        spark.range(100, 400).selectExpr(
            "id AS page_id",
            "concat('http://x/', id) AS url",
            "concat('<html><body>the same words on all pages ', id, '</body></html>') AS html",
            "'' AS refers_to",
        )
    )
    listed = warc.write_archives(more.coalesce(1), scratch_path(spark, "one")).collect()
    assert sum(r["n_records"] for r in listed) == more.count()
    seen = 0
    for row in listed:
        with open_input(row["path"]) as file:
            data = file.read()
        assert len(data) == row["n_bytes"]
        assert int.from_bytes(data[:4], "little") == warc.SKIPPABLE_MAGIC
        size = int.from_bytes(data[4:8], "little")
        dictionary = zstandard.ZstdDecompressor().decompress(data[8 : 8 + size])
        known = zstandard.ZstdCompressionDict(dictionary)
        rest = data[8 + size :]
        while rest:
            one = zstandard.ZstdDecompressor(dict_data=known).decompressobj()
            record = one.decompress(rest)
            assert record.startswith(b"WARC/1.1\r\n") and record.endswith(b"\r\n\r\n")
            rest, seen = one.unused_data, seen + 1
        records = list(warc.read_archive(io.BytesIO(data)))
        assert len(records) == row["n_records"]
    assert seen == more.count()


def test_a_damaged_payload_is_noticed():
    record = warc.Record(1, "response", "u", 3, "0" * 40, None, b"abc")
    out = io.BytesIO()
    writer = warc.WarcWriter(out, b"")
    writer.add(warc.build_record(record))
    with pytest.raises(ValueError, match="damaged"):
        list(warc.read_archive(io.BytesIO(out.getvalue())))


def test_no_pages(spark, pages):
    assert warc.archive_round_trip(spark, pages.limit(0)).collect() == []


def test_large_pages_have_a_dictionary_and_readers_of_their_own(spark):
    rows = [(i, f"http://x/{i}", "".join(f"<li>{i * k % 997} entry</li>" for k in range(6000))) for i in range(12)]
    docs = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    manifest = warc.write_archives(docs, scratch_path(spark, "large"), file_bytes=20_000)
    paths = [r["path"] for r in manifest.collect()]
    assert len(paths) >= 3
    for path in paths:
        with open_input(path) as file:
            assert int.from_bytes(file.read(4), "little") == warc.SKIPPABLE_MAGIC
    found = warc.read_archives(manifest)
    assert found.select(F.spark_partition_id()).distinct().count() == len(paths)
    assert {r["page_id"] for r in found.collect()} == set(range(12))


def test_a_few_records_are_a_dictionary_of_their_own():
    assert warc.train_dictionary([b"only one record"]) == b"only one record"
    assert warc.train_dictionary([]) == b""
