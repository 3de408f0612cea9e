"""Surrogate keys and the calendar attributes."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def hash_key(*parts: Column | str) -> Column:
    """Upper-case MD5 hex of the parts joined by ``|``; NULL if any part is NULL."""
    pieces: list[Column] = []
    for i, part in enumerate(parts):
        if i:
            pieces.append(F.lit("|"))
        pieces.append((F.col(part) if isinstance(part, str) else part).cast("string"))
    return F.upper(F.md5(F.concat(*pieces)))


def date_key(day: Column) -> Column:
    """Calendar day as the integer yyyymmdd."""
    return (F.year(day) * 10000 + F.month(day) * 100 + F.dayofmonth(day)).cast("int")


def month_start(day: Column) -> Column:
    return F.trunc(day, "month")


def iso_day_of_week(day: Column) -> Column:
    """Monday is 1, Sunday is 7."""
    return F.weekday(day) + 1


def path_safe_run_id(run_id: Column) -> Column:
    return F.translate(run_id, ":+", "-_")
