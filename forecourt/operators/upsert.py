"""Keyed upsert: rows of a batch replace rows with the same key, other rows stay."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructType

from forecourt.functions.workspace import cut_lineage
from forecourt.operators.aggregates import repeated_keys
from forecourt.operators.joins import spread_null_key
from forecourt.schemas import KEYS, schema_of
from forecourt.sources.tables import (
    PARTITION,
    key_bucket,
    key_entries,
    partition_value,
    read_keys,
    read_manifest,
    read_partitions,
    read_version,
    write_partitions,
    write_version,
)


def require_unique_keys(source: DataFrame, key: str) -> None:
    """Fail if two rows of a batch claim the same key. This reads the batch once more."""
    repeated = repeated_keys(source.filter(F.col(key).isNotNull()), [key]).limit(3).collect()
    if repeated:
        raise ValueError(f"several batch rows for one {key}, e.g. {repeated[0][key]!r}")


def drop_stale(
    source: DataFrame, target: DataFrame, key: str, guard: Sequence[str]
) -> DataFrame:
    """Batch rows that are not older than the row they would replace.

    ``guard`` columns are compared in order, a NULL counting as oldest. Only key
    and guard columns of the target are read, and a small batch is broadcast.
    """
    # Structs compare field by field and take NULL as smallest.
    seen = target.select(F.col(key).alias("__key"), F.struct(*guard).alias("__have"))
    offered = source.select(F.col(key), F.struct(*guard).alias("__offer"))
    newer_there = seen.join(offered, F.col("__key") == F.col(key)).filter(
        F.col("__have") > F.col("__offer")
    )
    stale = newer_there.select(F.col("__key"))
    return source.join(stale, F.col(key) == F.col("__key"), "left_anti")


def without_keys(target: DataFrame, source: DataFrame, key: str) -> DataFrame:
    """Target rows whose key is not in the batch; rows without a key stay."""
    replaced = source.select(F.col(key).alias("__key"))
    if not isinstance(target.schema[key].dataType, StringType):
        return target.join(replaced, F.col(key) == F.col("__key"), "left_anti")
    spread = target.withColumn("__spread", spread_null_key(target, key))
    matched = (F.col("__spread") == F.col("__key")) & F.col(key).isNotNull()
    return spread.join(replaced, matched, "left_anti").drop("__spread")


def merge_rows(
    target: DataFrame,
    source: DataFrame,
    key: str,
    guard: Sequence[str] = (),
    drop_null_keys: bool = True,
) -> DataFrame:
    """The target after the upsert of a batch, as a frame.

    A NULL key matches nothing, so such batch rows would be added again by every
    run; they are dropped unless ``drop_null_keys`` is off.
    """
    batch = source.filter(F.col(key).isNotNull()) if drop_null_keys else source
    if guard:
        batch = drop_stale(batch, target, key, guard)
    return without_keys(target, batch, key).unionByName(batch.select(*target.columns))


def upsert_version(
    spark: SparkSession,
    root: str,
    table: str,
    source: DataFrame,
    guard: Sequence[str] = (),
    verify_keys: bool = True,
) -> None:
    """Upsert into an unpartitioned table: the result is written as its next version.

    The batch is written once to the shared folder, as it is used several times.
    """
    key = KEYS[table]
    target = read_version(spark, root, table)
    batch = source.filter(F.col(key).isNotNull())
    if target is None and not verify_keys:
        write_version(batch, root)
        return
    batch = cut_lineage(batch, "zstd")
    if verify_keys:
        require_unique_keys(batch, key)
    write_version(batch if target is None else merge_rows(target, batch, key, guard), root)


def replaced_rows(known: DataFrame, batch: DataFrame, key: str) -> dict[str, int]:
    """How many rows the batch replaces, by partition (their dates may differ from its own).

    ``known`` has keys and their partitions: the target, or what its index says.
    """
    keys = batch.select(F.col(key).alias("__key"))
    old = known.join(keys, F.col(key) == F.col("__key"), "left_semi")
    return {r[0]: r[1] for r in old.groupBy(PARTITION).count().collect()}


def rows_left(target: DataFrame, replaced: Mapping[str, int], touched: Sequence[str]) -> list[str]:
    """Partitions among the touched ones that hold more rows than are replaced.

    The others go whole, so their rows need not be read. Rows that the index does not
    know apart, as their key repeats, count as left.
    """
    held = target.filter(F.col(PARTITION).isin(list(touched))).groupBy(PARTITION).count().collect()
    return sorted(r[0] for r in held if r[1] > replaced.get(r[0], 0))


def known_entries(
    spark: SparkSession, root: str, table: str, batch: DataFrame, guard: Sequence[str]
) -> DataFrame | None:
    """Index entries of a table in the buckets of the batch's keys; None without an index.

    Only those buckets are opened; their numbers are all that meets in the driver.
    An index made for other ``guard`` columns is not used.
    """
    index = read_manifest(spark, root).get("keys")
    if not index or index["guard"] != list(guard):
        return None
    key, schema, layers = KEYS[table], schema_of(table), index["layers"]
    asked = {r[0] for r in batch.select(key_bucket(key)).distinct().collect()}
    fields = StructType([schema[key]]).add(PARTITION, "string")
    for column in guard:
        fields = fields.add(schema[column])
    return read_keys(spark, root, fields, {b: cs for b, cs in layers.items() if b in asked})


def upsert_partitions(
    spark: SparkSession,
    root: str,
    table: str,
    source: DataFrame,
    column: str,
    by_month: bool,
    guard: Sequence[str] = (),
    verify_keys: bool = True,
    mark: str | None = None,
) -> list[str]:
    """Upsert into a partitioned table, rewriting touched partitions only.

    Returns the touched partitions. A row whose date moved leaves its old
    partition, and a partition left without rows is gone. All of it becomes
    visible in one commit, with ``mark`` for what has been read; a run that dies
    before changes nothing and can be repeated.

    Which rows the batch replaces, and whether they are newer, is looked up in the
    key index of the table, in the buckets of the batch's keys; of the table itself
    only the touched partitions are read. A table without an index (or one for
    other ``guard`` columns) is scanned once for its keys and has one from then on.
    """
    key = KEYS[table]
    value = partition_value(column, by_month)
    target = read_partitions(spark, root, table)
    batch = source.filter(F.col(key).isNotNull())
    if target is None:

        def first_entries(rows: DataFrame) -> DataFrame:
            # The rows are written and not published yet.
            if verify_keys:
                require_unique_keys(rows, key)
            return key_entries(rows, key, value, guard)

        write_partitions(batch, root, value, mark=mark, keys=first_entries)
        return []
    # Written once: the batch is used several times.
    batch = cut_lineage(batch, "zstd")
    if verify_keys:
        require_unique_keys(batch, key)
    known = known_entries(spark, root, table, batch, guard)
    indexed = known is not None
    known = known if indexed else target
    if guard:
        batch = cut_lineage(drop_stale(batch, known, key, guard), "zstd")
    # One value per month or day: as many as there are folders, never per row.
    replaced = replaced_rows(known, batch, key)
    touched = sorted(replaced.keys() | {r[0] for r in batch.select(value).distinct().collect()})
    if not touched and mark is None:
        return []
    entries = key_entries(batch, key, value, guard)
    if not indexed:
        others = without_keys(target, batch, key)
        entries = key_entries(others, key, F.col(PARTITION), guard).unionByName(entries)
    kept = rows_left(target, replaced, touched)
    rows = batch
    if kept:
        inside = target.filter(F.col(PARTITION).isin(kept)).drop(PARTITION)
        rows = merge_rows(inside, batch, key)
    write_partitions(rows, root, value, touched, mark, entries)
    return touched


def merge_into_catalog(
    source: DataFrame,
    table: str,
    key: str,
    guard: Sequence[str] = (),
    drop_null_keys: bool = True,
) -> None:
    """The same upsert on a catalog that supports MERGE.

    As with ``merge_rows``, rows with a NULL key are dropped unless
    ``drop_null_keys`` is off, and a row older by ``guard`` does not replace a
    newer one, a NULL counting as oldest.
    """
    batch = source.filter(F.col(key).isNotNull()) if drop_null_keys else source
    merge = batch.alias("source").mergeInto(table, F.col(f"{table}.{key}") == F.col(f"source.{key}"))
    if guard:
        have = F.struct(*[F.col(f"{table}.{c}") for c in guard])
        offer = F.struct(*[F.col(f"source.{c}") for c in guard])
        matched = merge.whenMatched(have <= offer)
    else:
        matched = merge.whenMatched()
    matched.updateAll().whenNotMatched().insertAll().merge()
