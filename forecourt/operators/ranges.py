"""Joins of dated rows with validity periods."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.operators.catalogue import END_OF_TIME

LONGEST_STRETCH = 12


def stretch_months(mean: float | None) -> int:
    """Months of a stretch for periods that last ``mean`` months."""
    return min(LONGEST_STRETCH, max(1, int((mean or 1) // 2)))


def month_number(day: Column) -> Column:
    """Months since the year 0."""
    return F.year(day) * 12 + F.month(day) - 1


def join_valid(
    rows: DataFrame,
    periods: DataFrame,
    day: str,
    on: Mapping[str, str],
    take: Mapping[str, str],
    start: str = "effective_from",
    end: str = "effective_to",
    how: str = "inner",
    days: DataFrame | None = None,
) -> DataFrame:
    """Rows with columns of the periods that hold on their ``day``, both ends included.

    ``on`` maps columns of the rows to key columns of the periods, ``take`` new
    names to columns taken. A missing end is open; a row without a day or key, or a
    period without a start, matches nothing; a row in several periods is repeated.
    ``how`` is ``inner`` or ``left``.

    A period is listed under every stretch of months it touches between the first and
    the last day of the rows, and a row meets the periods of its stretch: an equi join on
    keys and stretch, which hashes or merges and can be split where a key is frequent, in
    place of a nested loop over all days of a key. First and last day are read from
    ``days``, a cheaper frame with the same days (or more), if it is given. A stretch is
    a month; where periods last long, it is half their mean length, a year at most, so that
    few are listed more than a few times.
    """
    if how not in ("inner", "left"):
        raise ValueError("how must be inner or left")
    spanned = rows if days is None else days
    first, last = spanned.agg(F.min(F.col(day).cast("date")), F.max(F.col(day).cast("date"))).first()
    opens, closes = F.col("__start"), F.coalesce("__end", F.lit(END_OF_TIME))
    kept = periods.select(
        *[F.col(theirs).alias(f"__on_{ours}") for ours, theirs in on.items()],
        *[F.col(column).alias(f"__take_{name}") for name, column in take.items()],
        F.col(start).cast("date").alias("__start"),
        F.col(end).cast("date").alias("__end"),
    )
    inside = kept.filter((opens <= F.lit(last)) & (closes >= F.lit(first)) & (opens <= closes))
    start_no = month_number(F.greatest(opens, F.lit(first)))
    end_no = month_number(F.least(closes, F.lit(last)))
    width = stretch_months(inside.agg(F.avg(end_no - start_no + 1)).first()[0])

    def stretch(months: Column) -> Column:
        return F.floor(months / width).cast("int")

    numbers = F.sequence(stretch(start_no), stretch(end_no))
    listed = inside.withColumn("__stretch", F.explode(numbers))
    own = stretch(month_number(F.col(day).cast("date")))
    same = (own == F.col("__stretch")) & F.col(day).cast("date").between(opens, closes)
    for ours in on:
        same &= F.col(ours) == F.col(f"__on_{ours}")
    return rows.join(listed, same, how).select(
        *rows.columns, *[F.col(f"__take_{name}").alias(name) for name in take]
    )
