"""Filters of the price catalogue."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Fixed value: stands for an open end.
END_OF_TIME = date(9999, 12, 31)

CATALOGUE_ORDER = ("product_id", "market", "dealer_segment", "effective_from")


def in_catalogue(
    df: DataFrame,
    market: str | None = None,
    product_id: str | None = None,
    dealer_segment: str | None = None,
) -> DataFrame:
    """Equality on each argument given and not empty; arguments are upper-cased, columns are not."""
    wanted = {"market": market, "product_id": product_id, "dealer_segment": dealer_segment}
    for column, value in wanted.items():
        if value:
            df = df.filter(F.col(column) == F.upper(F.lit(value)))
    return df


def valid_on(day: Column | date, start: str = "effective_from", end: str = "effective_to") -> Column:
    """Validity on a day, both ends included; a missing end is open."""
    at = day if isinstance(day, Column) else F.lit(day)
    return (F.col(start) <= at) & (F.coalesce(F.col(end), F.lit(END_OF_TIME)) >= at)


def effective_on(df: DataFrame, day: date) -> DataFrame:
    return df.filter(valid_on(day))
