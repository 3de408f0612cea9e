"""Aggregate expressions and duplicate-key counts."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def sum_money(value: Column, spark_type: str = "decimal(18,2)") -> Column:
    return F.sum(value).cast(spark_type)


def mean_decimal(value: Column, spark_type: str, scale: int = 4) -> Column:
    """Decimal mean, rounded half-up once.

    ``avg`` rounds to four extra digits first, and a second rounding on the cast
    can then move a value that lies just below a tie.
    """
    total = F.sum(value).cast(f"decimal(26,{scale})")
    return (total / F.count(value).cast("decimal(12,0)")).cast(spark_type)


def repeated_keys(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keys held by more than one row, with their row counts; NULL is one key."""
    return (
        df.groupBy(*keys).agg(F.count(F.lit(1)).alias("row_count")).filter(F.col("row_count") > 1)
    )


def row_count(df: DataFrame, name: str) -> DataFrame:
    """The number of rows, as a frame of one row."""
    return df.agg(F.count(F.lit(1)).alias(name))
