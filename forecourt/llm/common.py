"""Small helpers shared by the corpus operators."""

from __future__ import annotations

import os
from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession

from forecourt.functions.workspace import cut_lineage, scratch_path

__all__ = ["corpus_table", "cut_lineage", "helper_prefix", "list_files", "open_input", "open_output", "row_slices", "scratch_path", "share_code", "spread_files"]

SLICE_CHARS = 2_000_000


def share_code(spark: SparkSession) -> None:
    """Let Python workers import this package where it is not installed (runs from a checkout)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    known = spark.sparkContext.environment.get("PYTHONPATH", "")
    if root not in known.split(os.pathsep):
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join(filter(None, (known, root)))


def corpus_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    share_code(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def helper_prefix(columns: Iterable[str]) -> str:
    """A prefix that no column has, for helper columns beside those of the caller."""
    prefix = "__"
    while any(name.lower().startswith(prefix) for name in columns):
        prefix += "_"
    return prefix


def row_slices(
    batch: pa.RecordBatch, column: str, chars: int = SLICE_CHARS
) -> Iterator[pa.RecordBatch]:
    """Zero-copy slices of a batch, each with about ``chars`` bytes of text or a single row.

    Python objects are made for one slice at a time, so a batch of very long
    texts costs no more memory than its own bytes.
    """
    sizes = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
    start, held = 0, 0
    for row, size in enumerate(sizes):
        if row > start and held + size > chars:
            yield batch.slice(start, row - start)
            start, held = row, 0
        held += size
    if start < batch.num_rows:
        yield batch.slice(start)


def spread_files(listed: DataFrame, most: int = 10_000) -> DataFrame:
    """A list of files dealt evenly to a task each (to ``most`` tasks, if there are more).

    The number is given, so that adaptive execution does not gather the few small
    rows, behind each of which stands a large file, in one task again.
    """
    return listed.repartition(max(1, min(listed.count(), most)))


def _place(uri: str) -> tuple[pafs.FileSystem, str]:
    return pafs.FileSystem.from_uri(uri)


def open_output(uri: str):
    """A binary stream to a new file in a local, S3, GCS or HDFS folder."""
    system, path = _place(uri)
    system.create_dir(path.rsplit("/", 1)[0], recursive=True)
    return system.open_output_stream(path, compression=None)


def open_input(uri: str):
    """A seekable binary file of a local, S3, GCS or HDFS folder."""
    system, path = _place(uri)
    return system.open_input_file(path)


def list_files(uri: str) -> list[str]:
    """Uris of the data files in a folder, in order of their names; none if there is no folder."""
    system, path = _place(uri)
    found = system.get_file_info(pafs.FileSelector(path, allow_not_found=True))
    return [f"{uri}/{f.base_name}" for f in sorted(found, key=lambda f: f.path) if f.is_file and f.base_name[0] not in "._"]
