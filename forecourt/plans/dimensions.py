"""Dimensions: hashed surrogate keys over the staged masters, and the calendar."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.functions.casts import run_stamp
from forecourt.functions.keys import date_key, hash_key, iso_day_of_week
from forecourt.schemas import conform

Stamp = Column | str | None

# The calendar range covered unless another is asked for.
FIRST_DAY = date(2024, 1, 1)
LAST_DAY = date(2028, 12, 31)


def _dimension(rows: DataFrame, table: str, key: str, business_key: str, at: Stamp) -> DataFrame:
    keyed = rows.withColumn(key, hash_key(business_key)).withColumn("loaded_at", run_stamp(at))
    return conform(keyed, table)


def dim_dealer(accounts: DataFrame, at: Stamp = None) -> DataFrame:
    return _dimension(accounts, "dim_dealer", "dealer_key", "dealer_id", at)


def dim_product(products: DataFrame, at: Stamp = None) -> DataFrame:
    return _dimension(products, "dim_product", "product_key", "product_id", at)


def dim_vehicle(vehicles: DataFrame, at: Stamp = None) -> DataFrame:
    return _dimension(vehicles, "dim_vehicle", "vehicle_key", "vehicle_id", at)


def days_between(spark: SparkSession, first: date, last: date) -> DataFrame:
    """One row per calendar day, both ends included."""
    every_day = F.sequence(F.lit(first), F.lit(last), F.expr("interval 1 day"))
    return spark.range(1).select(F.explode(every_day).alias("calendar_date"))


def calendar(days: DataFrame, at: Stamp = None) -> DataFrame:
    """Calendar attributes of a frame of days (column ``calendar_date``)."""
    day = F.col("calendar_date")
    rows = days.select(
        day,
        date_key(day).alias("date_key"),
        F.year(day).alias("year_number"),
        F.quarter(day).alias("quarter_number"),
        F.month(day).alias("month_number"),
        F.date_format(day, "MMMM").alias("month_name"),
        F.date_format(day, "yyyy-MM").alias("year_month"),
        F.weekofyear(day).alias("week_of_year"),
        F.dayofmonth(day).alias("day_of_month"),
        iso_day_of_week(day).alias("day_of_week"),
        F.date_format(day, "EEEE").alias("day_name"),
        iso_day_of_week(day).isin(6, 7).alias("is_weekend"),
        run_stamp(at).alias("loaded_at"),
    )
    return conform(rows, "dim_date")


def dim_date(
    spark: SparkSession, first: date = FIRST_DAY, last: date = LAST_DAY, at: Stamp = None
) -> DataFrame:
    return calendar(days_between(spark, first, last), at)
