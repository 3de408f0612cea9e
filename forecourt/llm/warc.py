"""Dictionary-compressed WARC archives (operator 1).

An archive starts with a skippable frame that holds a Zstandard dictionary,
trained on archived records; then each record is a Zstandard frame of its own,
compressed with that dictionary. Any record can be read with the dictionary and
the record's frame alone.
"""

from __future__ import annotations

import hashlib
import io
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from urllib.parse import quote

import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.llm.common import (
    cut_lineage,
    open_input,
    open_output,
    row_slices,
    scratch_path,
    spread_files,
)

# Fixed values of the formats.
SKIPPABLE_MAGIC = 0x184D2A5D
ZSTD_MAGIC = b"\x28\xb5\x2f\xfd"
VERSION = "WARC/1.1"
SAME_PAYLOAD = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
HTTP_TYPE = "application/http; msgtype=response"

MIN_REVISIT_BYTES = 1000
SAMPLE_RECORDS = 400
SAMPLE_BYTES = 16_384
DICTIONARY_BYTES = 65_536
FILE_BYTES = 256_000_000
LEVEL = 3
ARCHIVED_AT = "2026-01-01T00:00:00Z"
MANIFEST = "path string, n_records bigint, n_bytes bigint"
READ_BACK = (
    "page_id bigint, payload_bytes bigint, payload_digest string, record_type string, "
    "refers_to bigint, target_uri string, archive string"
)


@dataclass
class Record:
    """What a record says; ``payload`` is None for a revisit."""

    page_id: int | None
    record_type: str
    target_uri: str | None
    payload_bytes: int
    payload_digest: str
    refers_to: int | None = None
    payload: bytes | None = None


def record_id(page_id: int | None, digest: str) -> str:
    return f"<urn:uuid:{uuid.uuid5(uuid.NAMESPACE_URL, f'page:{page_id}:{digest}')}>"


def build_record(record: Record, archived_at: str = ARCHIVED_AT) -> bytes:
    """The record's bytes: WARC headers, then an HTTP header and, for a response, the payload."""
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {record.payload_bytes}\r\n\r\n"
    ).encode()
    block = http + (record.payload or b"")
    headers = [
        ("WARC-Type", record.record_type),
        ("WARC-Record-ID", record_id(record.page_id, record.payload_digest)),
        ("WARC-Date", archived_at),
        ("WARC-Payload-Digest", f"sha1:{record.payload_digest}"),
        ("Content-Type", HTTP_TYPE),
        ("Content-Length", str(len(block))),
    ]
    if record.page_id is not None:
        headers.append(("X-Page-ID", str(record.page_id)))
    if record.target_uri is not None:
        headers.append(("WARC-Target-URI", quote(record.target_uri, safe="%/:?#[]@!$&'()*+,;=~")))
    if record.record_type == "revisit":
        headers += [
            ("WARC-Profile", SAME_PAYLOAD),
            ("WARC-Refers-To", record_id(record.refers_to, record.payload_digest)),
            ("X-Refers-To-Page-ID", str(record.refers_to)),
        ]
    head = "".join(f"{name}: {value}\r\n" for name, value in headers)
    return f"{VERSION}\r\n{head}\r\n".encode() + block + b"\r\n\r\n"


def train_dictionary(records: list[bytes], size: int = DICTIONARY_BYTES) -> bytes:
    """A dictionary from sample records; where they are too few to train one, their last bytes."""
    try:
        return zstandard.train_dictionary(size, records).as_bytes()
    except zstandard.ZstdError:
        return b"".join(records)[-size:]


class WarcWriter:
    """One archive: the dictionary's frame, then a frame for each record."""

    def __init__(self, stream, dictionary: bytes, level: int = LEVEL):
        self.stream, self.n_records, self.n_bytes = stream, 0, 0
        known = zstandard.ZstdCompressionDict(dictionary) if dictionary else None
        self.zip = zstandard.ZstdCompressor(level=level, dict_data=known)
        if dictionary:
            packed = zstandard.ZstdCompressor(level=level).compress(dictionary)
            self._write(SKIPPABLE_MAGIC.to_bytes(4, "little"))
            self._write(len(packed).to_bytes(4, "little"))
            self._write(packed)

    def _write(self, data: bytes) -> None:
        self.stream.write(data)
        self.n_bytes += len(data)

    def add(self, record: bytes) -> None:
        self._write(self.zip.compress(record))
        self.n_records += 1

    def close(self) -> None:
        self.stream.close()


def read_archive(file) -> Iterator[Record]:
    """The records of one archive, one at a time; payload digests are computed from the payload."""
    head = file.read(8)
    known = None
    if len(head) == 8 and int.from_bytes(head[:4], "little") == SKIPPABLE_MAGIC:
        data = file.read(int.from_bytes(head[4:], "little"))
        if data[:4] == ZSTD_MAGIC:
            data = zstandard.ZstdDecompressor().decompress(data)
        known = zstandard.ZstdCompressionDict(data)
    else:
        file.seek(0)
    unzip = zstandard.ZstdDecompressor(dict_data=known)
    with unzip.stream_reader(file, read_across_frames=True, closefd=False) as plain:
        stream = io.BufferedReader(plain, 1 << 20)
        while (line := stream.readline()) != b"":
            if line.strip() != VERSION.encode():
                raise ValueError(f"not a record: {line[:40]!r}")
            headers = _headers(stream)
            block = stream.read(int(headers["content-length"]))
            stream.read(4)
            yield _record(headers, block)


def _headers(stream) -> dict[str, str]:
    found = {}
    while (line := stream.readline().decode()).strip():
        name, _, value = line.partition(":")
        found[name.strip().lower()] = value.strip()
    return found


def _record(headers: dict[str, str], block: bytes) -> Record:
    at = block.index(b"\r\n\r\n") + 4
    http = _headers(io.BytesIO(block[:at].partition(b"\r\n")[2]))
    revisit = headers["warc-type"] == "revisit"
    payload = None if revisit else block[at:]
    digest = headers["warc-payload-digest"].removeprefix("sha1:")
    if payload is not None:
        found = hashlib.sha1(payload, usedforsecurity=False).hexdigest()
        if found != digest or len(payload) != int(http["content-length"]):
            raise ValueError(f"damaged payload of {headers['warc-record-id']}")
    number = headers.get("x-page-id")
    first = headers.get("x-refers-to-page-id")
    return Record(
        page_id=None if number is None else int(number),
        record_type=headers["warc-type"],
        target_uri=headers.get("warc-target-uri"),
        payload_bytes=int(http["content-length"]),
        payload_digest=digest,
        refers_to=None if first is None else int(first),
        payload=payload,
    )


def plan_records(pages: DataFrame, min_revisit_bytes: int = MIN_REVISIT_BYTES) -> DataFrame:
    """``page_id, url, html, payload_bytes, payload_digest, refers_to`` of every page.

    ``refers_to`` is set for revisits: pages whose payload, of at least
    ``min_revisit_bytes``, another page with a larger id has too; it names the
    largest such id. Repeated rows of the largest id are all responses. A page
    without an id counts as smaller than any; if no page of a payload has an id,
    all are responses. A null html is an empty payload.

    Only digests that occur twice enter the join, from a written table, so that
    the pages of one very common payload can be split over tasks.
    """
    payload = F.encode(F.coalesce("html", F.lit("")), "UTF-8")
    digested = pages.select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.col("html").alias("html"),
        F.octet_length(payload).cast("bigint").alias("payload_bytes"),
        F.sha1(payload).alias("payload_digest"),
    )
    repeated = cut_lineage(
        digested.filter(F.col("payload_bytes") >= min_revisit_bytes)
        .groupBy(F.col("payload_digest").alias("__digest"))
        .agg(F.max("page_id").alias("__largest"), F.count(F.lit(1)).alias("__n"))
        .filter("__n > 1 and __largest is not null")
        .select("__digest", "__largest")
    )
    same = digested["payload_digest"] == repeated["__digest"]
    is_largest = F.col("page_id").eqNullSafe(F.col("__largest"))
    return digested.join(repeated, same, "left").select(
        *digested.columns, F.when(~is_largest, F.col("__largest")).alias("refers_to")
    )


def _record_of(row: dict) -> Record:
    return Record(
        page_id=row["page_id"],
        record_type="response" if row["refers_to"] is None else "revisit",
        target_uri=row["url"],
        payload_bytes=row["payload_bytes"],
        payload_digest=row["payload_digest"],
        refers_to=row["refers_to"],
        payload=(row["html"] or "").encode() if row["refers_to"] is None else None,
    )


def sample_dictionary(
    pages: DataFrame,
    records: int = SAMPLE_RECORDS,
    max_bytes: int = SAMPLE_BYTES,
    size: int = DICTIONARY_BYTES,
) -> bytes:
    """A dictionary from a bounded sample: the first ``max_bytes`` of up to ``records`` pages.

    Pages are taken by the least hashes of their ids, so reruns take the same
    ones; of rows with one id, one. The ids are chosen first, so that only the
    chosen pages (6.5 MB by default at most) reach the driver.
    """
    short = pages.filter(F.octet_length("html") > 0).select(
        F.col("page_id").cast("bigint").alias("page_id"),
        F.col("url").cast("string").alias("url"),
        F.left("html", F.lit(max_bytes)).alias("html"),
    )
    ids = short.filter("page_id is not null").select("page_id").distinct()
    chosen = cut_lineage(ids.orderBy(F.xxhash64("page_id"), "page_id").limit(records))
    rows = short.join(F.broadcast(chosen), "page_id").dropDuplicates(["page_id"]).collect()
    rows.sort(key=lambda row: row["page_id"])
    samples = []
    for row in rows:
        payload = row["html"].encode()[:max_bytes]
        digest = hashlib.sha1(payload, usedforsecurity=False).hexdigest()
        record = Record(row["page_id"], "response", row["url"], len(payload), digest, None, payload)
        samples.append(build_record(record))
    return train_dictionary(samples, size)


def write_archives(
    pages: DataFrame,
    folder: str,
    min_revisit_bytes: int = MIN_REVISIT_BYTES,
    file_bytes: int = FILE_BYTES,
    level: int = LEVEL,
    archived_at: str = ARCHIVED_AT,
) -> DataFrame:
    """Archive every page; returns the list of archives ``path, n_records, n_bytes``.

    A task starts a new archive when one has ``file_bytes``. Archives carry names
    of the attempt that wrote them, and only those that a finished task reports
    enter the list that Spark commits to ``folder/manifest``. No pages: no archive.
    """
    spark = pages.sparkSession
    shared = spark.sparkContext.broadcast(sample_dictionary(pages))

    def write(batches):
        dictionary, out, path = shared.value, None, ""
        part, run = TaskContext.get().partitionId(), uuid.uuid4().hex
        number = 0

        def done():
            out.close()
            return pa.record_batch(
                {"path": [path], "n_records": [out.n_records], "n_bytes": [out.n_bytes]}
            )

        for batch in batches:
            for rows in row_slices(batch, "html"):
                for row in rows.to_pylist():
                    if out is not None and out.n_bytes >= file_bytes:
                        yield done()
                        out = None
                    if out is None:
                        path = f"{folder}/archives/{part:08d}-{number:05d}-{run}.warc.zst"
                        out, number = WarcWriter(open_output(path), dictionary, level), number + 1
                    out.add(build_record(_record_of(row), archived_at))
        if out is not None:
            yield done()

    planned = plan_records(pages, min_revisit_bytes)
    planned.mapInArrow(write, MANIFEST).write.parquet(f"{folder}/manifest")
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def read_archives(manifest: DataFrame) -> DataFrame:
    """One row per record of the listed archives, read in parallel and checked."""
    names = [field.split()[0] for field in READ_BACK.split(", ")]
    types = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.int64(), pa.string(), pa.string()]

    def read(batches):
        for batch in batches:
            for path in batch.column("path").to_pylist():
                with open_input(path) as file:
                    rows: list[tuple] = []
                    for r in read_archive(file):
                        rows.append(
                            (
                                r.page_id,
                                r.payload_bytes,
                                r.payload_digest,
                                r.record_type,
                                r.refers_to,
                                r.target_uri,
                                path.rsplit("/", 1)[-1],
                            )
                        )
                        if len(rows) == 10_000:
                            yield _batch(rows, names, types)
                            rows = []
                    if rows:
                        yield _batch(rows, names, types)

    return spread_files(manifest.select("path")).mapInArrow(read, READ_BACK)


def _batch(rows: list[tuple], names: list[str], types: list[pa.DataType]) -> pa.RecordBatch:
    columns = zip(*rows, strict=True)
    return pa.record_batch(
        [pa.array(c, t) for c, t in zip(columns, types, strict=True)], names=names
    )


def archive_round_trip(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Write to a new folder of the shared root and read every archive back."""
    return read_archives(write_archives(pages, scratch_path(spark, "warc")))
