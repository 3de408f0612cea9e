"""Exact distinct counts that can be merged: bitmaps over dense numbers.

The values of a month are numbered from 1 without gaps, in the order of the day on
which they first come up, so that the bitmap of a day has its bits close together.
Bitmaps of days are merged by OR; the bits that are set are the distinct values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SLICES = 256
NUMBER_KEYS = ["month", "measure", "value"]


def distinct_values(rows: DataFrame, day: str, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """``month, day, keys…, measure, value``: every value of each measure once per day and key.

    Values are compared as text; NULL values and rows without a day do not count.
    """
    pairs = F.array(
        *[F.struct(F.lit(c).alias("measure"), F.col(c).cast("string").alias("value")) for c in measures]
    )
    return (
        rows.filter(F.col(day).isNotNull())
        .select(
            F.trunc(day, "month").cast("string").alias("month"),
            F.col(day).alias("day"),
            *keys,
            F.inline(pairs),
        )
        .filter(F.col("value").isNotNull())
        .distinct()
    )


def new_numbers(values: DataFrame, known: DataFrame) -> DataFrame:
    """``month, measure, value, number`` of the values that have no number yet.

    Numbers go on from the highest known one of a month and measure. Places are
    counted inside slices of a first day, and slices (at most 256 a day) are laid end
    to end by their sizes: no window holds more than a slice.
    """
    first = values.groupBy(*NUMBER_KEYS).agg(F.min("day").alias("first_day"))
    fresh = first.join(known, NUMBER_KEYS, "left_anti").withColumn(
        "slice", F.pmod(F.xxhash64("value"), F.lit(SLICES))
    )
    piece = ["month", "measure", "first_day", "slice"]
    before = (
        Window.partitionBy("month", "measure")
        .orderBy("first_day", "slice")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    sizes = fresh.groupBy(*piece).agg(F.count(F.lit(1)).alias("size"))
    starts = sizes.select(*piece, F.coalesce(F.sum("size").over(before), F.lit(0)).alias("start"))
    highest = known.groupBy("month", "measure").agg(F.max("number").alias("highest"))
    place = F.row_number().over(Window.partitionBy(*piece).orderBy("value"))
    return (
        fresh.withColumn("place", place)
        .join(starts, piece)
        .join(highest, ["month", "measure"], "left")
        .select(
            *NUMBER_KEYS,
            (F.coalesce("highest", F.lit(0)) + F.col("start") + F.col("place")).alias("number"),
        )
    )


def bitmaps(values: DataFrame, numbers: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys…, measure, bucket, bits``: a bitmap of 4 KB for each 32,768 numbers in use."""
    return (
        values.join(numbers, NUMBER_KEYS)
        .groupBy(*keys, "measure", F.bitmap_bucket_number("number").alias("bucket"))
        .agg(F.bitmap_construct_agg(F.bitmap_bit_position("number")).alias("bits"))
    )


def merge_bitmaps(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """``keys…, measure, n_distinct``: bitmaps of one month under the same keys as one."""
    merged = rows.groupBy(*keys, "measure", "bucket").agg(F.bitmap_or_agg("bits").alias("bits"))
    return merged.groupBy(*keys, "measure").agg(F.sum(F.bitmap_count("bits")).alias("n_distinct"))
