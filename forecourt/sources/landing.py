"""Landing: source rows to raw files, each run under its own folder.

Order of commits: data, then the manifest row, then the watermark. A run that
dies before its manifest row is repeated from the same watermark and writes the
same folders again. A run that has its row is finished: a repetition returns its
folder, touches no file, and only commits its watermark if that is missing.
"""

from __future__ import annotations

from collections.abc import Iterable, Sequence
from datetime import datetime
from functools import reduce
from operator import and_
from uuid import uuid4

from pyspark.sql import Column, DataFrame, Observation, Row, SparkSession
from pyspark.sql import functions as F

from forecourt.functions.keys import path_safe_run_id
from forecourt.operators.incremental import (
    CONTROL_SCHEMA,
    changed_between,
    changed_since,
    commit_watermark,
    high_watermark,
    read_watermark,
    utc_now,
)
from forecourt.operators.paging import paged_envelopes
from forecourt.sources.raw import LINES_FILES, partition_values
from forecourt.sources.tables import (
    child_folders,
    data_files,
    move_folder,
    path_exists,
    remove_folder,
)

# Batch and page sizes of the sources, and the form of a day folder.
ROWS_PER_FILE = 10_000
COMMERCIAL_PAGE = 1_000
PRICING_PAGE = 500
DAY_FORM = r"^\d{4}-\d{2}-\d{2}$"

MANIFEST_SCHEMA = (
    "dataset string, mode string, extract_date string, run_id string, "
    "previous_watermark string, new_watermark string, records bigint, parts bigint, "
    "sha256 string"
)


def json_value(df: DataFrame, name: str) -> Column:
    """A column as the sources write it: ISO dates and times, numbers as numbers."""
    kind = df.schema[name].dataType.simpleString()
    if kind in ("timestamp", "timestamp_ntz"):
        return F.replace(F.col(name).cast("string"), F.lit(" "), F.lit("T")).alias(name)
    if kind == "date":
        return F.col(name).cast("string").alias(name)
    return F.col(name)


def json_encode_rows(df: DataFrame, name: str = "line") -> DataFrame:
    """Each row as one JSON text; NULL fields are written, other scripts are not escaped."""
    record = F.struct(*[json_value(df, c) for c in df.columns])
    return df.select(F.to_json(record, {"ignoreNullFields": "false"}).alias(name))


def safe_run_id(spark: SparkSession, run_id: str) -> str:
    return spark.range(1).select(path_safe_run_id(F.lit(run_id))).first()[0]


def run_folder(spark: SparkSession, root: str, extract_date: str, run_id: str) -> str:
    return f"{root}/extract_date={extract_date}/run_id={safe_run_id(spark, run_id)}"


def land_json_lines(
    df: DataFrame, folder: str, rows_per_file: int = ROWS_PER_FILE
) -> tuple[int, int]:
    """Gzip JSON lines, at most ``rows_per_file`` rows per file; the rows and files written.

    Rows are counted as they are written, files by their folder's listing.
    """
    counted = Observation()
    encoded = df.select(*[json_value(df, c) for c in df.columns])
    (
        encoded.observe(counted, F.count(F.lit(1)).alias("rows"))
        .write.mode("overwrite")
        .option("compression", "gzip")
        .option("maxRecordsPerFile", rows_per_file)
        .option("ignoreNullFields", "false")
        .json(folder)
    )
    return counted.get.get("rows", 0), len(data_files(df.sparkSession, folder))


def write_manifest(spark: SparkSession, path: str, **values: object) -> None:
    """Append one row that says what a run landed."""
    names = [part.split()[0] for part in MANIFEST_SCHEMA.split(", ")]
    row = [tuple(values.get(n) for n in names)]
    spark.createDataFrame(row, MANIFEST_SCHEMA).coalesce(1).write.mode("append").parquet(path)


def finished_run(
    spark: SparkSession, path: str, dataset: str, extract_date: str, run_id: str
) -> Row | None:
    """The manifest row of a run that has landed; None if it has not."""
    if not path_exists(spark, path):
        return None
    rows = spark.read.schema(MANIFEST_SCHEMA).parquet(path)
    found = rows.filter(
        (F.col("dataset") == dataset)
        & (F.col("extract_date") == extract_date)
        & (F.col("run_id") == safe_run_id(spark, run_id))
    )
    return found.first()


def _finish_again(spark: SparkSession, control: str, run: Row) -> None:
    """Commit the mark of a run that died between its manifest row and its mark."""
    marks = spark.createDataFrame([], CONTROL_SCHEMA)
    if path_exists(spark, control):
        marks = spark.read.schema(CONTROL_SCHEMA).parquet(control)
    known = (F.col("dataset") == run["dataset"]) & (F.col("watermark") == run["new_watermark"])
    if marks.filter(known).isEmpty():
        commit_watermark(spark, control, run["dataset"], run["new_watermark"])


def snapshot_extract(
    df: DataFrame, root: str, dataset: str, extract_date: str, run_id: str, manifests: str
) -> str:
    """Land a whole source table; returns the run's folder."""
    spark = df.sparkSession
    folder = run_folder(spark, root, extract_date, run_id)
    if finished_run(spark, manifests, dataset, extract_date, run_id) is not None:
        return folder
    records, parts = land_json_lines(df, folder)
    write_manifest(
        spark,
        manifests,
        dataset=dataset,
        mode="full_snapshot",
        extract_date=extract_date,
        run_id=safe_run_id(spark, run_id),
        records=records,
        parts=parts,
    )
    return folder


def incremental_extract(
    df: DataFrame,
    root: str,
    dataset: str,
    extract_date: str,
    run_id: str,
    manifests: str,
    control: str,
    changed: str = "updated_at",
) -> str | None:
    """Land the rows changed since the last run; None if the source is empty.

    ``df`` may be any reader's frame: the window of change times is a plain
    comparison, so a relational source gets it with its query.
    """
    spark = df.sparkSession
    done = finished_run(spark, manifests, dataset, extract_date, run_id)
    if done is not None:
        _finish_again(spark, control, done)
        return run_folder(spark, root, extract_date, run_id)
    low = read_watermark(spark, control, dataset)
    high = high_watermark(df, changed)
    if high is None:
        return None
    folder = run_folder(spark, root, extract_date, run_id)
    # Sorting inside tasks keeps rows of a file in change order without a global sort.
    rows = changed_between(df, changed, low, high).sortWithinPartitions(changed)
    records, parts = land_json_lines(rows, folder)
    write_manifest(
        spark,
        manifests,
        dataset=dataset,
        mode="full" if low is None else "incremental",
        extract_date=extract_date,
        run_id=safe_run_id(spark, run_id),
        previous_watermark=low,
        new_watermark=high,
        records=records,
        parts=parts,
    )
    commit_watermark(spark, control, dataset, high)
    return folder


def land_pages(
    df: DataFrame,
    root: str,
    dataset: str,
    extract_date: str,
    run_id: str,
    manifests: str,
    control: str,
    order: Sequence[str],
    page_size: int = COMMERCIAL_PAGE,
    changed: str = "updated_at",
    started_at: datetime | None = None,
) -> str:
    """Land a source as JSON pages, one page per line.

    The mark is the time (UTC) at which the run began, taken before the source is read.
    """
    spark = df.sparkSession
    started_at = started_at or utc_now()
    folder = run_folder(spark, root, extract_date, run_id)
    done = finished_run(spark, manifests, dataset, extract_date, run_id)
    if done is not None:
        _finish_again(spark, control, done)
        return folder
    low = read_watermark(spark, control, dataset)
    rows = changed_since(df, changed, low)
    encoded = rows.select(*[json_value(rows, c) for c in rows.columns])
    counted = Observation()
    pages = paged_envelopes(encoded, order, page_size).observe(
        counted,
        F.coalesce(F.sum("n_records"), F.lit(0)).alias("records"),
        F.count(F.lit(1)).alias("pages"),
    )
    pages.select("raw_json").write.mode("overwrite").option("compression", "gzip").text(folder)
    write_manifest(
        spark,
        manifests,
        dataset=dataset,
        mode="full" if low is None else "incremental",
        extract_date=extract_date,
        run_id=safe_run_id(spark, run_id),
        previous_watermark=low,
        new_watermark=started_at.isoformat(),
        records=counted.get.get("records", 0),
        parts=counted.get.get("pages", 0),
    )
    commit_watermark(spark, control, dataset, started_at.isoformat(), started_at)
    return folder


def new_days(spark: SparkSession, source: str, landed: str) -> list[str]:
    """Well-formed day folders of the source, with files of lines, that no run has landed.

    The files are those that would be copied, so a day that so far has none of
    them stays open.
    """
    days = partition_values(spark, source, "event_date", LINES_FILES)
    days = days.filter(F.col("event_date").rlike(DAY_FORM))
    if path_exists(spark, landed):
        done = spark.read.schema("event_date string").parquet(landed)
        days = days.join(done, "event_date", "left_anti")
    # As many as there are day folders.
    return sorted(r[0] for r in days.collect())


def land_new_days(
    spark: SparkSession,
    source: str,
    target: str,
    landed: str,
    manifests: str | None = None,
    run_id: str = "",
) -> list[str]:
    """Copy event days not landed yet, line by line as they are.

    A day counts as landed once its row stands in the ledger, which is written
    last; a half-copied day is overwritten by the next run. Days landed before
    stay as they are, even if their source changed. With ``manifests``, each day
    folder gets a row there, after the copy and before the ledger: copied, with its
    lines and files, skipped (landed before) or invalid (its name is no day, or it
    has no file of lines). A run repeated after it died has its rows once.
    """
    days = new_days(spark, source, landed)
    if not days:
        if manifests is not None:
            _note_days(spark, source, target, landed, days, manifests, run_id)
        return []
    lines = (
        spark.read.schema("value string, event_date string")
        .option("pathGlobFilter", LINES_FILES)
        .text(source)
        .filter(F.col("event_date").isin(days))
    )
    (
        lines.hint("rebalance", "event_date")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .option("compression", "gzip")
        .partitionBy("event_date")
        .text(target)
    )
    if manifests is not None:
        _note_days(spark, source, target, landed, days, manifests, run_id)
    ledger = spark.createDataFrame([(d,) for d in days], "event_date string")
    ledger.coalesce(1).write.mode("append").parquet(landed)
    return days


def _note_days(
    spark: SparkSession,
    source: str,
    target: str,
    landed: str,
    days: list[str],
    manifests: str,
    run_id: str,
) -> None:
    everything = partition_values(spark, source, "event_date")
    copied = F.col("event_date").isin(days)
    known = spark.createDataFrame([], "event_date string")
    if path_exists(spark, landed):
        known = spark.read.schema("event_date string").parquet(landed)
    before = known.select(F.col("event_date").alias("known")).distinct()
    modes = everything.join(before, F.col("event_date") == F.col("known"), "left").select(
        F.lit("engagement_events").alias("dataset"),
        F.when(copied, "copied")
        .when(F.col("known").isNotNull(), "skipped")
        .otherwise("invalid")
        .alias("mode"),
        F.col("event_date").alias("extract_date"),
        F.lit(run_id).alias("run_id"),
    )
    if days:
        lines = spark.read.schema("value string, event_date string").text(
            [f"{target}/event_date={d}" for d in days]
        )
        day = F.regexp_extract(F.col("_metadata.file_path"), "event_date=([^/]*)/", 1)
        copies = lines.groupBy(day.alias("day")).agg(
            F.count(F.lit(1)).alias("records"),
            F.count_distinct("_metadata.file_path").alias("parts"),
        )
        modes = modes.join(copies, F.col("extract_date") == F.col("day"), "left").drop("day")
    _append_manifests(modes, manifests)


def _append_manifests(rows: DataFrame, path: str) -> None:
    """Manifest rows from a frame that has some of their columns, less those noted before."""
    typed = [part.split() for part in MANIFEST_SCHEMA.split(", ")]
    new = rows.select(
        *[
            (F.col(name) if name in rows.columns else F.lit(None)).cast(kind).alias(name)
            for name, kind in typed
        ]
    )
    if path_exists(spark := rows.sparkSession, path):
        noted = spark.read.schema(MANIFEST_SCHEMA).parquet(path).alias("noted")
        same = [
            F.col(f"new.{c}").eqNullSafe(F.col(f"noted.{c}"))
            for c in ("dataset", "run_id", "extract_date", "sha256", "mode")
        ]
        new = new.alias("new").join(noted, reduce(and_, same), "left_anti")
    new.coalesce(1).write.mode("append").parquet(path)


def file_digests(spark: SparkSession, path: str) -> DataFrame:
    """Whole files with the SHA-256 of their bytes (small files only)."""
    files = spark.read.format("binaryFile").load(path)
    return files.select("path", "content", F.sha2("content", 256).alias("sha256"))


def land_by_content(
    spark: SparkSession, path: str, target: str, manifests: str | None = None, run_id: str = ""
) -> DataFrame:
    """Land files under their digest; content landed before is not written again.

    Returns the digests found at ``path``, one row per different content. With
    ``manifests``, each of them gets a row there: copied, or skipped.

    Files are written aside, and each digest's folder is moved to its place whole,
    so a folder that is there is complete; a run that dies leaves the rest to the
    next one. The manifest comes last.
    """
    found = file_digests(spark, path).dropDuplicates(["sha256"])
    fresh = found
    if path_exists(spark, target):
        known = partition_values(spark, target, "sha256")
        fresh = found.join(known, "sha256", "left_anti")
    aside = f"{target}/_aside-{uuid4().hex}"
    (
        fresh.select(F.decode("content", "UTF-8").alias("value"), "sha256")
        .write.partitionBy("sha256")
        .text(aside)
    )
    # As many folders as there are new planning files.
    copied = [n for n in child_folders(spark, aside) if n.startswith("sha256=")]
    for name in copied:
        move_folder(spark, f"{aside}/{name}", f"{target}/{name}")
    remove_folder(spark, aside)
    if manifests is not None:
        new = F.col("sha256").isin([name.split("=", 1)[1] for name in copied])
        noted = found.select(
            F.lit("sales_targets").alias("dataset"),
            F.when(new, "copied").otherwise("skipped").alias("mode"),
            F.lit(run_id).alias("run_id"),
            "sha256",
        )
        _append_manifests(noted, manifests)
    return found.select("sha256")


def require_columns(df: DataFrame, expected: Iterable[str]) -> DataFrame:
    """The frame itself, if it has the expected columns and at least one row."""
    missing = sorted(set(expected) - set(df.columns))
    if missing:
        raise ValueError(f"required columns are missing: {missing}")
    if df.isEmpty():
        raise ValueError("the input has no rows")
    return df
