"""Distinct counts from merged bitmaps."""

from datetime import date

import pytest
from conftest import plan_of, rows
from pyspark.sql import functions as F

from forecourt.operators.distinct import bitmaps, distinct_values, merge_bitmaps, new_numbers
from forecourt.plans import funnel
from forecourt.plans.marts import mart_marketplace_funnel_monthly
from forecourt.sources import tables

EVENT = "event_date date, event_type string, session_id string, listing_id string, dealer_id string"
AT = "2024-03-01 00:00:00"


@pytest.fixture
def accounts(spark):
    return spark.createDataFrame([("d1", "North"), ("d2", "South"), ("d3", None)], "dealer_id string, market string")


def events(spark, day, first, last):
    """Events whose sessions, listings and dealers repeat; some have none."""
    kinds = ("view", "CLICK", "lead", "other")
    return spark.createDataFrame(
        [
            (day, kinds[i % 4], None if i % 7 == 0 else f"s{i % 50}", f"l{i % 13}", f"d{i % 5}" if i % 11 else None)
            for i in range(first, last)
        ],
        EVENT,
    )


def test_late_days_merge_into_the_mart(spark, folder, accounts):
    jan, late, feb = date(2024, 1, 30), date(2024, 1, 31), date(2024, 2, 1)
    whole = {jan: events(spark, jan, 0, 40), late: events(spark, late, 20, 90), feb: events(spark, feb, 0, 30)}

    def agree(*days):
        given = events(spark, None, 0, 5)
        for day in days:
            given = given.unionAll(whole[day])
        expected = mart_marketplace_funnel_monthly(given, accounts, AT)
        assert rows(funnel.recorded_funnel(spark, folder, at=AT)) == rows(expected)

    first = whole[jan].unionAll(events(spark, late, 20, 30)).unionAll(whole[feb])
    funnel.record_days(folder, first.unionAll(events(spark, None, 0, 5)), accounts)
    before = tables.partition_folders(spark, f"{folder}/days")
    numbered = tables.partition_folders(spark, f"{folder}/numbers")
    # The last of January arrives whole: its day is replaced, numbers are only added.
    funnel.record_days(folder, whole[late], accounts)
    agree(*whole)
    after = tables.partition_folders(spark, f"{folder}/days")
    assert {d for d in after if after[d] != before[d]} == {"2024-01-31"}
    added = tables.partition_folders(spark, f"{folder}/numbers")
    assert numbered.items() < added.items() and set(added) - set(numbered) == {"2024-01-01.2"}
    # The same batch again changes no row; no value is numbered twice, no number is left out.
    funnel.record_days(folder, whole[late], accounts)
    agree(*whole)
    numbers = tables.read_parts(spark, f"{folder}/numbers", funnel._NUMBERS)
    dense = numbers.groupBy("month", "measure").agg(
        (F.count("*") == F.max("number")) & (F.countDistinct("value") == F.count("*"))
    )
    assert all(r[2] for r in dense.collect())
    # A day without events any more, and a month on its own.
    funnel.record_days(folder, whole[feb].limit(0), accounts, days=["2024-02-01"])
    agree(jan, late)
    only = funnel.recorded_funnel(spark, folder, ["2024-02-01"], AT)
    assert rows(only) == []
    assert "2024-01-30" not in plan_of(only)


def test_nothing_recorded(spark, folder, accounts):
    assert rows(funnel.recorded_funnel(spark, folder)) == []
    funnel.record_days(folder, events(spark, date(2024, 1, 1), 0, 0), accounts)
    assert rows(funnel.recorded_funnel(spark, folder)) == []


def test_more_values_than_a_bitmap_holds(spark):
    seen = spark.range(100_000).select(
        F.date_add(F.lit(date(2024, 1, 1)), (F.col("id") % 3).cast("int")).alias("day"),
        (F.col("id") % 70_001).cast("string").alias("v"),
        (F.col("id") % 2).alias("k"),
    )
    values = distinct_values(seen, "day", ["k"], ["v"])
    none = spark.createDataFrame([], "month string, measure string, value string, number bigint")
    numbers = new_numbers(values, none)
    assert numbers.agg(F.min("number"), F.max("number"), F.countDistinct("number")).first()[:] == (1, 70_001, 70_001)
    merged = merge_bitmaps(bitmaps(values, numbers, ["k", "day"]), ["k"])
    expected = seen.groupBy("k").agg(F.countDistinct("v")).collect()
    assert rows(merged, "k", "n_distinct") == sorted(tuple(r) for r in expected)
