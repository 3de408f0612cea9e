"""Token-id files: id blocks as compressed bit or byte planes with a chunk index (operator 4).

A file is ``BPLANES1``, the chunks, a footer and the footer's length as eight
bytes. A chunk holds a fixed number of ids (the last of a file fewer), written
as planes: plane k has byte k, or bit k, of every id of the block, and is a
zstandard frame of its own. The footer is JSON: for each chunk its offset, its
ids and the sizes of its planes, then the places of the document index (ids and
lengths, in file order).
"""

from __future__ import annotations

import json
import uuid
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from forecourt.llm.common import open_input, open_output, row_slices, scratch_path, spread_files
from forecourt.llm.tokenizing import encoder

# Fixed values of the file format.
MAGIC = b"BPLANES1"
END_ID = 2

CHUNK_IDS = 65_536
FILE_IDS = 16_000_000
LEVEL = 3
MANIFEST = "part int, seq int, path string, n_ids bigint, n_docs bigint"
READ_BACK = "doc_id bigint, start bigint, n_tokens bigint, ids_crc32 bigint"


def to_planes(ids: np.ndarray, kind: str = "byte") -> list[bytes]:
    """The planes of one block of unsigned 32-bit ids, lowest first."""
    octets = np.ascontiguousarray(ids, dtype="<u4").view(np.uint8).reshape(-1, 4)
    if kind == "byte":
        return [np.ascontiguousarray(octets[:, k]).tobytes() for k in range(4)]
    bits = np.unpackbits(octets, axis=1, bitorder="little")
    return [row.tobytes() for row in np.packbits(bits.T, axis=1, bitorder="little")]


def from_planes(planes: list[bytes], n_ids: int, kind: str = "byte") -> np.ndarray:
    if kind == "byte":
        octets = np.stack([np.frombuffer(plane, np.uint8) for plane in planes], axis=1)
    else:
        rows = np.stack([np.frombuffer(plane, np.uint8) for plane in planes])
        bits = np.unpackbits(rows, axis=1, count=n_ids, bitorder="little")
        octets = np.packbits(bits.T, axis=1, bitorder="little")
    return np.ascontiguousarray(octets).view("<u4").reshape(-1)


class PlaneWriter:
    """Writes documents to one file; holds at most one chunk of ids and the document index."""

    def __init__(self, stream, kind: str = "byte", chunk_ids: int = CHUNK_IDS, level: int = LEVEL):
        self.stream, self.kind, self.chunk_bytes = stream, kind, 4 * chunk_ids
        self.zip = zstandard.ZstdCompressor(level=level)
        self.held = bytearray()
        self.chunks: list[list] = []
        self.doc_ids: list[int | None] = []
        self.lengths: list[int] = []
        self.n_ids, self.offset = 0, 0
        self._write(MAGIC)

    def _write(self, data: bytes) -> int:
        self.stream.write(data)
        self.offset += len(data)
        return len(data)

    def add(self, doc_id: int | None, ids: bytes) -> None:
        self.doc_ids.append(doc_id)
        self.lengths.append(len(ids) // 4)
        self.n_ids += len(ids) // 4
        self.held += ids
        if len(self.held) >= self.chunk_bytes:
            full = len(self.held) // self.chunk_bytes * self.chunk_bytes
            for at in range(0, full, self.chunk_bytes):
                self._chunk(bytes(self.held[at : at + self.chunk_bytes]))
            del self.held[:full]

    def _chunk(self, ids: bytes) -> None:
        offset = self.offset
        planes = to_planes(np.frombuffer(ids, "<u4"), self.kind)
        sizes = [self._write(self.zip.compress(plane)) for plane in planes]
        self.chunks.append([offset, len(ids) // 4, sizes])

    def close(self) -> None:
        if self.held:
            self._chunk(bytes(self.held))
        known = np.array([doc is not None for doc in self.doc_ids], np.uint8)
        ids = np.array([doc or 0 for doc in self.doc_ids], "<i8")
        lengths = np.array(self.lengths, "<u4")
        index = []
        for part in (known, ids, lengths):
            index.append([self.offset, self._write(self.zip.compress(part.tobytes()))])
        footer = json.dumps(
            {
                "kind": self.kind,
                "chunks": self.chunks,
                "n_docs": len(self.lengths),
                "docs": index,
            }
        ).encode()
        self._write(footer)
        self._write(len(footer).to_bytes(8, "little"))
        self.stream.close()


class PlaneReader:
    """Reads a file by its chunk index."""

    def __init__(self, file):
        self.file = file
        self.unzip = zstandard.ZstdDecompressor()
        size = file.size()
        length = int.from_bytes(self._at(size - 8, 8), "little")
        if self._at(0, len(MAGIC)) != MAGIC:
            raise ValueError("not a plane file")
        self.footer = json.loads(self._at(size - 8 - length, length))

    def _at(self, offset: int, size: int) -> bytes:
        self.file.seek(offset)
        return self.file.read(size)

    def chunk(self, number: int) -> np.ndarray:
        offset, n_ids, sizes = self.footer["chunks"][number]
        data, planes = self._at(offset, sum(sizes)), []
        for size in sizes:
            planes.append(self.unzip.decompress(data[:size]))
            data = data[size:]
        return from_planes(planes, n_ids, self.footer["kind"])

    def index(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Which documents have an id, their ids, their lengths."""
        parts = [self.unzip.decompress(self._at(*place)) for place in self.footer["docs"]]
        return tuple(
            np.frombuffer(part, kind)
            for part, kind in zip(parts, (np.uint8, "<i8", "<u4"), strict=True)
        )

    def documents(self) -> Iterator[tuple[int | None, list[np.ndarray]]]:
        """Each document's id and its ids, in pieces of at most one chunk."""
        known, ids, lengths = self.index()
        number, block, at = 0, np.empty(0, "<u4"), 0
        for has_id, doc_id, left in zip(known, ids.tolist(), lengths.tolist(), strict=True):
            pieces = []
            while left:
                if at == len(block):
                    block, number, at = self.chunk(number), number + 1, 0
                pieces.append(block[at : at + left])
                at += len(pieces[-1])
                left -= len(pieces[-1])
            yield (doc_id if has_id else None), pieces


def write_planes(
    docs: DataFrame,
    tokenizer_path: str,
    folder: str,
    kind: str = "byte",
    chunk_ids: int = CHUNK_IDS,
    file_ids: int = FILE_IDS,
    end_id: int = END_ID,
) -> DataFrame:
    """Encode whole texts and write them in ascending ``doc_id`` order; returns the file list.

    Rows are dealt into ranges of ``doc_id`` and sorted there, rows of equal id
    by text; ids that are null come first. Each task writes files of about
    ``file_ids`` ids under names of its own attempt, and only what a finished
    task reports enters the list that Spark commits to ``folder/manifest``: a
    repeated task leaves an unlisted file and no repeated rows. A null or empty
    text is one end id. No rows: an empty list.
    """
    spark = docs.sparkSession

    def write(batches):
        ids_of = encoder(tokenizer_path)
        end = int(end_id).to_bytes(4, "little")
        part, seq, out, path = TaskContext.get().partitionId(), 0, None, ""
        run = uuid.uuid4().hex

        def done():
            out.close()
            return pa.record_batch(
                {
                    "part": pa.array([part], pa.int32()),
                    "seq": pa.array([seq], pa.int32()),
                    "path": [path],
                    "n_ids": [out.n_ids],
                    "n_docs": [len(out.lengths)],
                }
            )

        for batch in batches:
            for rows in row_slices(batch, "__text"):
                texts = ids_of.encode(rows.column("__text").to_pylist())
                for doc_id, ids in zip(rows.column("__id").to_pylist(), texts, strict=True):
                    if out is not None and out.n_ids >= file_ids:
                        yield done()
                        out, seq = None, seq + 1
                    if out is None:
                        path = f"{folder}/ids/{part:08d}-{seq:05d}-{run}.bpl"
                        out = PlaneWriter(open_output(path), kind, chunk_ids)
                    out.add(doc_id, ids + end)
        if out is not None:
            yield done()

    (
        docs.select(F.col("doc_id").cast("bigint").alias("__id"), F.col("text").alias("__text"))
        .repartitionByRange(F.col("__id").asc_nulls_first())
        .sortWithinPartitions(F.col("__id").asc_nulls_first(), "__text")
        .mapInArrow(write, MANIFEST)
        .write.parquet(f"{folder}/manifest")
    )
    return spark.read.schema(MANIFEST).parquet(f"{folder}/manifest")


def read_planes(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, n_tokens, ids_crc32`` of every document, from the files of a list.

    ``start`` counts the ids of all documents before it. One row per file meets
    in a single task to add up the sizes; the files are dealt to a task each, which
    reads one chunk at a time.
    """
    before = Window.orderBy("part", "seq").rowsBetween(Window.unboundedPreceding, -1)
    placed = manifest.select(
        "path", F.coalesce(F.sum("n_ids").over(before), F.lit(0)).alias("start")
    )

    def read(batches):
        for batch in batches:
            for path, start in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                with open_input(path) as file:
                    rows: list[tuple] = []
                    for doc_id, pieces in PlaneReader(file).documents():
                        crc, n_tokens = 0, 0
                        for piece in pieces:
                            crc = zlib.crc32(piece.tobytes(), crc)
                            n_tokens += len(piece)
                        rows.append((doc_id, start, n_tokens, crc))
                        start += n_tokens
                        if len(rows) == 10_000:
                            yield _rows(rows)
                            rows = []
                    if rows:
                        yield _rows(rows)

    return spread_files(placed).mapInArrow(read, READ_BACK)


def _rows(rows: list[tuple]) -> pa.RecordBatch:
    names = [field.split()[0] for field in READ_BACK.split(", ")]
    return pa.record_batch(
        [pa.array(column, pa.int64()) for column in zip(*rows, strict=True)], names=names
    )


def token_files(spark: SparkSession, docs: DataFrame, tokenizer_path: str) -> DataFrame:
    """Write to a new folder of the shared root and read back."""
    return read_planes(write_planes(docs, tokenizer_path, scratch_path(spark, "token-planes")))
