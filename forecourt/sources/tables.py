"""Curated tables as Parquet folders.

Two layouts, both safe against a job that dies half way:

* unpartitioned tables keep whole versions side by side (``version=N``); a version
  counts once Spark's committer has put ``_SUCCESS`` into it, so readers see the
  old one until the new one is complete;
* partitioned tables write the partitions they replace into a folder of the commit
  (``commit=N/part=…``) and then publish, by one rename, a small file that names
  the folder of every partition; readers open exactly the folders it names. It also
  names the folders of a key index (``keys/commit=N/bucket=…``): the partition and
  change time of every key, by which a batch finds the rows it replaces.

On a catalog with row-level operations (Iceberg, Delta) use
``operators.upsert.merge_into_catalog`` instead.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable, Mapping, Sequence
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import IntegerType, StructType

from forecourt.schemas import schema_of

PARTITION = "part"
BUCKET = "bucket"
KEY_BUCKETS = 64
KEY_LAYERS = 8


def _fs(spark: SparkSession, path: str):
    """Hadoop file system of a path, for listing and removing folders."""
    jpath = spark._jvm.org.apache.hadoop.fs.Path(path)
    return jpath.getFileSystem(spark._jsc.hadoopConfiguration()), jpath


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, jpath = _fs(spark, path)
    return fs.exists(jpath)


def child_folders(spark: SparkSession, path: str) -> list[str]:
    fs, jpath = _fs(spark, path)
    if not fs.exists(jpath):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(jpath) if s.isDirectory())


def data_files(spark: SparkSession, path: str) -> list[str]:
    """Names of the files in a folder that Spark reads."""
    fs, jpath = _fs(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(jpath) if s.isFile()]
    return sorted(n for n in names if n[0] not in "._")


def move_folder(spark: SparkSession, path: str, target: str) -> None:
    """Rename a folder; one that is there already stays as it is."""
    fs, jpath = _fs(spark, path)
    if not path_exists(spark, target):
        fs.rename(jpath, spark._jvm.org.apache.hadoop.fs.Path(target))


def remove_folder(spark: SparkSession, path: str) -> None:
    fs, jpath = _fs(spark, path)
    fs.delete(jpath, True)


def complete_versions(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the versions whose write was committed, oldest first."""
    names = [n for n in child_folders(spark, root) if n.startswith("version=")]
    numbers = sorted(int(n.split("=", 1)[1]) for n in names)
    return [n for n in numbers if path_exists(spark, f"{root}/version={n}/_SUCCESS")]


def read_version(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    """Newest complete version of a table; None before the first one."""
    versions = complete_versions(spark, root)
    if not versions:
        return None
    return spark.read.schema(schema_of(table)).parquet(f"{root}/version={versions[-1]}")


def write_version(df: DataFrame, root: str, keep: int = 2) -> int:
    """Write the next version; versions older than the last ``keep`` are removed."""
    spark = df.sparkSession
    versions = complete_versions(spark, root)
    number = versions[-1] + 1 if versions else 1
    writer = df.write.mode("overwrite").option("compression", "zstd")
    writer.parquet(f"{root}/version={number}")
    for old in (versions + [number])[:-keep]:
        remove_folder(spark, f"{root}/version={old}")
    return number


def partition_value(column: str, by_month: bool) -> Column:
    """Partition text of a row: its day, or the first day of its month, or ``none``."""
    value = F.trunc(F.col(column), "month") if by_month else F.col(column)
    return F.coalesce(value.cast("string"), F.lit("none"))


def _manifests(spark: SparkSession, root: str) -> list[int]:
    """Numbers of the published commits of a partitioned table, oldest first."""
    fs, jpath = _fs(spark, f"{root}/_commits")
    if not fs.exists(jpath):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(jpath)]
    return sorted(int(n.removesuffix(".json")) for n in names if n[0] not in "._")


def _manifest(spark: SparkSession, root: str, number: int) -> dict:
    fs, jpath = _fs(spark, f"{root}/_commits/{number:012d}.json")
    stream = fs.open(jpath)
    try:
        return json.loads(spark._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
    finally:
        stream.close()


def read_manifest(spark: SparkSession, root: str) -> dict | None:
    """The newest published commit: ``parts`` (partition to commit number) and ``mark``."""
    numbers = _manifests(spark, root)
    return {"number": numbers[-1], **_manifest(spark, root, numbers[-1])} if numbers else None


def publish(
    spark: SparkSession,
    root: str,
    number: int,
    parts: Mapping[str, int],
    mark: str | None,
    keys: Mapping | None = None,
) -> None:
    """Make a commit visible by one rename of a small file; fails if its number is taken."""
    fs, target = _fs(spark, f"{root}/_commits/{number:012d}.json")
    aside = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/_commits/.{number:012d}.{uuid4().hex}")
    content = {"parts": dict(parts), "mark": mark}
    if keys is not None:
        content["keys"] = dict(keys)
    text = json.dumps(content, sort_keys=True)
    stream = fs.create(aside, False)
    try:
        stream.write(bytearray(text.encode()))
    finally:
        stream.close()
    if fs.exists(target) or not fs.rename(aside, target):
        fs.delete(aside, False)
        raise RuntimeError(f"commit {number} of {root} was published by another run")


def write_partitions(
    df: DataFrame,
    root: str,
    value: Column,
    replace: Iterable[str] | None = None,
    mark: str | None = None,
    keys: DataFrame | Callable[[DataFrame], DataFrame] | None = None,
    finish: Callable[[DataFrame], DataFrame] | None = None,
) -> None:
    """Replace partitions in one commit: all those in ``replace``, or those with new rows.

    Rows go to a folder of their own (``commit=N/part=…``), which no reader knows
    until the commit is published; before that the table is as it was, and a
    write that died leaves a folder that is never read. A partition in ``replace``
    that gets no rows is gone. ``mark`` is kept with the commit (the last one
    stays if it is None), so that a resume rule can't run ahead of the data.
    ``keys`` are the new entries of the key index (``key_entries``), part of the same
    commit; a table written without them has no index any more. As a function they are
    made from the rows as they were written, so that ``df`` is computed once.

    The rebalance hint gathers the rows of a partition and lets AQE cut a
    partition that holds much of the data into several tasks and files. ``finish``
    makes of the rows what is stored once they are gathered: columns that follow from
    others need not be moved.
    """
    spark = df.sparkSession
    last = read_manifest(spark, root) or {"number": 0, "parts": {}, "mark": None}
    tried = [int(n.split("=", 1)[1]) for n in child_folders(spark, root) if n.startswith("commit=")]
    number = max([last["number"], *tried]) + 1
    folder = f"{root}/commit={number}"
    rows = df.withColumn(PARTITION, value).hint("rebalance", PARTITION)
    if finish is not None:
        rows = finish(rows.drop(PARTITION)).withColumn(PARTITION, value)
    stored = rows.drop(PARTITION).schema
    # Hashed keys are hexadecimal text, which snappy leaves as long as it is.
    rows.write.option("compression", "zstd").partitionBy(PARTITION).parquet(folder)
    written = [
        n.split("=", 1)[1]
        for n in child_folders(spark, folder)
        if n.startswith(f"{PARTITION}=")
    ]
    gone = set(written if replace is None else replace)
    parts = {p: c for p, c in last["parts"].items() if p not in gone}
    parts |= dict.fromkeys(written, number)
    if callable(keys):
        folders = [f"{folder}/{PARTITION}={p}" for p in written]
        read = spark.read.schema(stored)
        keys = keys(read.parquet(*folders) if folders else spark.createDataFrame([], stored))
    index = None if keys is None else _write_keys(keys, root, number, last.get("keys"))
    publish(spark, root, number, parts, last["mark"] if mark is None else mark, index)
    _remove_unread(spark, root)


def key_bucket(key: str) -> Column:
    """Bucket of the key index that a key belongs to."""
    return F.pmod(F.xxhash64(key), F.lit(KEY_BUCKETS)).cast("string")


def key_entries(rows: DataFrame, key: str, value: Column, guard: Sequence[str]) -> DataFrame:
    """What the index says of rows: key, partition, and the columns by which they are newer."""
    return rows.select(F.col(key), value.alias(PARTITION), *guard, key_bucket(key).alias(BUCKET))


def _newest(entries: DataFrame, key: str) -> DataFrame:
    """The entry of the last commit for each key."""
    rest = [c for c in entries.columns if c not in (key, "commit")]
    last = entries.groupBy(key).agg(F.max_by(F.struct(*rest), "commit").alias("last"))
    return last.select(key, *[F.col(f"last.{c}").alias(c) for c in rest])


def read_keys(
    spark: SparkSession, root: str, rows: StructType, layers: Mapping[str, list[int]]
) -> DataFrame:
    """The newest index entries in the named buckets (bucket to commits); no others are opened.

    ``rows`` has the key first, then the columns of ``key_entries`` but the bucket.
    """
    schema = StructType([*rows.fields]).add("commit", IntegerType()).add(BUCKET, "string")
    folders = [f"{root}/keys/commit={c}/{BUCKET}={b}" for b, cs in layers.items() for c in cs]
    if not folders:
        return spark.createDataFrame([], rows)
    read = spark.read.schema(schema).option("basePath", f"{root}/keys")
    return _newest(read.parquet(*folders).drop(BUCKET), rows.fields[0].name)


def _write_keys(keys: DataFrame, root: str, number: int, last: Mapping | None) -> dict:
    """Add a layer of entries to their buckets: ``layers`` (bucket to commits, oldest first).

    A bucket of ``KEY_LAYERS`` layers is written anew as one, so that a look-up
    opens a bounded number of files, and a batch mostly writes its own keys only.
    Entries with other ``guard`` columns than before begin a new index.
    """
    spark, folder = keys.sparkSession, f"{root}/keys/commit={number}"
    guard = [c for c in keys.columns[1:] if c not in (PARTITION, BUCKET)]
    layers = last["layers"] if last and last["guard"] == guard else {}
    full = {b: cs for b, cs in layers.items() if len(cs) >= KEY_LAYERS}
    rows = keys
    if full:
        columns = StructType([f for f in keys.schema.fields if f.name != BUCKET])
        old = read_keys(spark, root, columns, full)
        old = old.withColumns({BUCKET: key_bucket(keys.columns[0]), "commit": F.lit(0)})
        both = old.unionByName(keys.withColumn("commit", F.lit(1)))
        rows = _newest(both, keys.columns[0]).select(*keys.columns)
    key = keys.columns[0]
    rows.repartition(F.col(BUCKET)).sortWithinPartitions(BUCKET, key).write.partitionBy(
        BUCKET
    ).parquet(folder)
    found = {b: list(cs) for b, cs in layers.items()}
    for name in child_folders(spark, folder):
        bucket = name.split("=", 1)[1]
        found[bucket] = [*([] if bucket in full else found.get(bucket, [])), number]
    return {"guard": guard, "layers": found}


def _remove_unread(spark: SparkSession, root: str, keep: int = 2) -> None:
    """Remove partitions that only commits before the last ``keep`` refer to, and those commits."""
    numbers = _manifests(spark, root)
    used = {folder for n in numbers[-keep:] for folder in _folders(_manifest(spark, root, n))}
    for n in numbers[:-keep]:
        for folder in _folders(_manifest(spark, root, n)):
            if folder not in used:
                remove_folder(spark, f"{root}/{folder}")
        remove_folder(spark, f"{root}/_commits/{n:012d}.json")


def _folders(manifest: Mapping) -> list[str]:
    """Every folder that a commit refers to, below the table's."""
    layers = (manifest.get("keys") or {"layers": {}})["layers"]
    return [f"commit={c}/{PARTITION}={p}" for p, c in manifest["parts"].items()] + [
        f"keys/commit={c}/{BUCKET}={b}" for b, commits in layers.items() for c in commits
    ]


def partition_folders(spark: SparkSession, root: str) -> dict[str, str]:
    """Folder of each partition in the newest commit."""
    found = read_manifest(spark, root)
    return {
        part: f"{root}/commit={commit}/{PARTITION}={part}"
        for part, commit in (found["parts"] if found else {}).items()
    }


def read_parts(
    spark: SparkSession,
    root: str,
    columns: StructType,
    wanted: Callable[[str], bool] = lambda part: True,
) -> DataFrame:
    """Rows of the newest commit with their partition; only wanted partitions are opened."""
    schema = StructType([*columns.fields]).add(PARTITION, "string").add("commit", IntegerType())
    folders = [f for part, f in partition_folders(spark, root).items() if wanted(part)]
    if not folders:
        return spark.createDataFrame([], schema).drop("commit")
    read = spark.read.schema(schema).option("basePath", root)
    return read.parquet(*folders).drop("commit")


def read_partitions(spark: SparkSession, root: str, table: str) -> DataFrame | None:
    """A partitioned table with its partition column; None before the first rows.

    Only folders named by the newest commit are opened.
    """
    if not partition_folders(spark, root):
        return None
    return read_parts(spark, root, schema_of(table))
