"""What part of the raw data a run has to read."""

from __future__ import annotations

from collections.abc import Iterator
from datetime import date, datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.sources.tables import path_exists

CONTROL_SCHEMA = "dataset string, watermark string, committed_at timestamp_ntz"


def high_watermark(df: DataFrame, column: str) -> str | None:
    """Greatest change time at the source, as text; None if the source is empty."""
    return df.agg(F.max(column).cast("string")).first()[0]


def changed_between(df: DataFrame, column: str, low: str | None, high: str) -> DataFrame:
    """Rows changed after ``low`` and not after ``high``; all up to ``high`` on a first run."""
    kind = df.schema[column].dataType
    changed = F.col(column)
    rows = df.filter(changed <= F.lit(high).cast(kind))
    return rows if low is None else rows.filter(changed > F.lit(low).cast(kind))


def changed_since(df: DataFrame, column: str, since: str | date | None) -> DataFrame:
    """Rows changed on or after the day of ``since``, compared as dates."""
    if since is None:
        return df
    day = F.to_date(F.substring(F.lit(str(since)), 1, 10))
    return df.filter(F.col(column).cast("date") >= day)


def read_watermark(spark: SparkSession, control: str, dataset: str) -> str | None:
    """The mark last committed for a dataset."""
    if not path_exists(spark, control):
        return None
    marks = spark.read.schema(CONTROL_SCHEMA).parquet(control)
    found = marks.filter(F.col("dataset") == dataset).agg(F.max_by("watermark", "committed_at"))
    return found.first()[0]


def utc_now() -> datetime:
    """The time in UTC without a zone, as marks carry it; local clocks go back once a year."""
    return datetime.now(timezone.utc).replace(tzinfo=None)


def commit_watermark(
    spark: SparkSession, control: str, dataset: str, watermark: str, at: datetime | None = None
) -> None:
    """Persist a mark; call it only when data and manifest of the run are written."""
    row = [(dataset, watermark, at or utc_now())]
    spark.createDataFrame(row, CONTROL_SCHEMA).coalesce(1).write.mode("append").parquet(control)


def source_filter(
    column: str | None, run_day: date, first_run: bool, lookback_days: int = 0
) -> Column:
    """Raw partitions to read: all on a first run or without a filter column, else the
    run's day, with the days before it when there is a look-back."""
    if first_run or column is None:
        return F.lit(True)
    if lookback_days:
        earliest = run_day - timedelta(days=lookback_days)
        return F.col(column).between(earliest.isoformat(), run_day.isoformat())
    return F.col(column) == run_day.isoformat()


def resume_range(
    raw_first: date | None, raw_last: date | None, staged_last: date | None, lookback_days: int
) -> tuple[date, date] | None:
    """Days of events to stage: from the look-back before the last staged day to the end.

    None when there is nothing to read, or the target is ahead of the source.
    """
    if raw_first is None or raw_last is None:
        return None
    start = raw_first
    if staged_last is not None:
        start = max(raw_first, staged_last - timedelta(days=lookback_days))
    return None if start > raw_last else (start, raw_last)


def month_windows(first: date, last: date) -> Iterator[tuple[date, date]]:
    """Half-open windows, at most a calendar month each, that cover both days."""
    end = last + timedelta(days=1)
    start = first
    while start < end:
        following = (start.replace(day=1) + timedelta(days=32)).replace(day=1)
        yield start, min(following, end)
        start = following


def in_window(column: str, start: date, end: date) -> Column:
    """Half-open window on a textual day partition."""
    day = F.col(column)
    return (day >= start.isoformat()) & (day < end.isoformat())


def month_window_of(day: Column) -> Column:
    """First day of the calendar-month window that a day is processed in."""
    return F.trunc(day, "month")
