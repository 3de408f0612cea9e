"""Tolerant casts from raw text: a bad value becomes NULL, never an error.

Spark's own ``try_cast`` accepts more text than the marketplace contract does
(``2026-01`` as a date, ``yes`` as a boolean), so each cast is preceded by a
check of the text form.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted text forms.
DATE_FORM = r"^\s*\d{4}-\d{1,2}-\d{1,2}\s*$"
MONTH_FORM = r"^\s*\d{4}-\d{2}\s*$"
TIMESTAMP_FORM = r"^\s*\d{4}-\d{1,2}-\d{1,2}([ T]\d{1,2}:\d{1,2}(:\d{1,2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})?)?\s*$"
TRUE_WORDS = ("true", "t", "1")
FALSE_WORDS = ("false", "f", "0")


def text_to_date(value: Column) -> Column:
    """``yyyy-MM-dd`` text to DATE, anything else to NULL."""
    text = value.cast("string")
    return F.when(text.rlike(DATE_FORM), text.try_cast("date"))


def text_to_month(value: Column, strict: bool = False) -> Column:
    """First day of a month from ``yyyy-MM`` or ``yyyy-MM-dd`` text.

    ``strict`` accepts full dates only and leaves the day as it is.
    """
    if strict:
        return text_to_date(value)
    text = value.cast("string")
    month = F.when(
        text.rlike(MONTH_FORM), F.concat(F.trim(text), F.lit("-01")).try_cast("date")
    )
    return F.coalesce(month, F.trunc(text_to_date(text), "month"))


def text_to_timestamp(value: Column, strict: bool = False) -> Column:
    """ISO text (blank or ``T`` between date and time) to a zone-free timestamp.

    ``strict`` refuses the ``T`` form.
    """
    text = value.cast("string")
    ok = text.rlike(TIMESTAMP_FORM)
    if strict:
        ok = ok & ~text.contains("T")
    return F.when(ok, text.try_cast("timestamp_ntz"))


def text_to_boolean(value: Column) -> Column:
    word = F.lower(F.trim(value.cast("string")))
    return F.when(word.isin(*TRUE_WORDS), F.lit(True)).when(
        word.isin(*FALSE_WORDS), F.lit(False)
    )


def text_to_number(value: Column, spark_type: str) -> Column:
    """Integer or decimal; overflow and malformed text give NULL."""
    return value.try_cast(spark_type)


def to_type(value: Column, spark_type: str, strict: bool = False) -> Column:
    """Tolerant cast chosen by target type."""
    if spark_type == "string":
        return value.cast("string")
    if spark_type == "date":
        return text_to_date(value)
    if spark_type == "month":
        return text_to_month(value, strict)
    if spark_type == "timestamp":
        return text_to_timestamp(value, strict)
    if spark_type == "boolean":
        return text_to_boolean(value)
    return text_to_number(value, spark_type)


def run_stamp(at: Column | str | None = None) -> Column:
    """Audit time of a run: the given one, else the time the query starts."""
    if at is None:
        return F.current_timestamp().cast("timestamp_ntz")
    if isinstance(at, str):
        return F.lit(at).cast("timestamp_ntz")
    return at.cast("timestamp_ntz")
