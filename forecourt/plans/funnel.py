"""The marketplace funnel kept by day, so that late days are merged and no month is recomputed.

Two partitioned tables below one root: ``numbers`` gives each session, listing
and dealer of a month its number and only ever gains partitions, one per month and batch;
``days`` holds the stage counts and bitmaps of each day and market. A batch reads
the events of its days, writes those days and new numbers, and the mart is
merged from the days. A batch that dies between the two commits leaves numbers that no
bitmap uses yet, which its repetition finds and uses.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType, DateType, LongType, StringType, StructField, StructType

from forecourt.functions.keys import month_start
from forecourt.functions.workspace import cut_lineage
from forecourt.operators.distinct import bitmaps, distinct_values, merge_bitmaps, new_numbers
from forecourt.operators.joins import stack
from forecourt.plans.intermediate import PLAIN_STAGES, StageMap, stage_counts
from forecourt.plans.marts import Stamp, funnel_events, funnel_rates
from forecourt.sources.tables import read_manifest, read_parts, write_partitions

MEASURES = {
    "session_id": "unique_sessions",
    "listing_id": "listings_with_activity",
    "dealer_id": "dealers_with_activity",
}
EVENTS = "events"
_NUMBERS = StructType(
    [
        StructField("month", StringType()),
        StructField("measure", StringType()),
        StructField("value", StringType()),
        StructField("number", LongType()),
    ]
)
_DAYS = StructType(
    [
        StructField("day", DateType()),
        StructField("market", StringType()),
        StructField("measure", StringType()),
        StructField("bucket", LongType()),
        StructField("bits", BinaryType()),
        StructField("views", LongType()),
        StructField("clicks", LongType()),
        StructField("leads", LongType()),
    ]
)


def record_days(
    root: str,
    events: DataFrame,
    accounts: DataFrame,
    days: Iterable[str] = (),
    stages: StageMap = PLAIN_STAGES,
) -> None:
    """Put the days of these events in place of what was recorded for them.

    ``events`` holds all events of its days (as a look-back reads them); ``days`` names
    days (ISO text) to replace even if no event is left in them. Markets are those
    the accounts have now; days recorded earlier keep theirs. Events without a
    day are left out, as in the mart.
    """
    spark = events.sparkSession
    dated = events.filter(F.col("event_date").isNotNull())
    rows = cut_lineage(funnel_events(dated, accounts))
    values = distinct_values(rows, "event_date", ["market"], tuple(MEASURES))
    months = {r[0] for r in rows.select(F.trunc("event_date", "month").cast("string")).distinct().collect()}
    of_months = lambda part: part.split(".")[0] in months
    known = read_parts(spark, f"{root}/numbers", _NUMBERS, of_months).drop("part")
    last = read_manifest(spark, f"{root}/numbers") or {"number": 0}
    batch = F.concat("month", F.lit(f".{last['number'] + 1}"))
    write_partitions(new_numbers(values, known), f"{root}/numbers", batch)
    numbers = read_parts(spark, f"{root}/numbers", _NUMBERS, of_months).drop("part")
    counts = rows.groupBy(F.col("event_date").alias("day"), "market").agg(*stage_counts(stages))
    daily = stack(
        [counts.withColumn("measure", F.lit(EVENTS)), bitmaps(values, numbers, ["day", "market"])]
    )
    written = [r[0] for r in rows.select(F.col("event_date").cast("string")).distinct().collect()]
    columns = [F.col(f.name).cast(f.dataType).alias(f.name) for f in _DAYS]
    write_partitions(
        daily.select(*columns), f"{root}/days", F.col("day").cast("string"), {*days, *written}
    )


def recorded_funnel(
    spark: SparkSession, root: str, months: Iterable[str] | None = None, at: Stamp = None
) -> DataFrame:
    """Rows of ``mart_marketplace_funnel_monthly`` from the recorded days.

    ``months`` (first days, ISO text) restricts the days that are opened to theirs.
    """
    wanted = None if months is None else {m[:7] for m in months}
    days = read_parts(
        spark, f"{root}/days", _DAYS, lambda part: wanted is None or part[:7] in wanted
    ).withColumn("month_start", month_start(F.col("day")))
    keys = ["month_start", "market"]
    counts = days.filter(F.col("measure") == EVENTS).groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in ("views", "clicks", "leads")]
    )
    merged = merge_bitmaps(days.filter(F.col("measure") != EVENTS), keys)
    grouped = stack([counts, merged]).groupBy(*keys).agg(
        *[F.sum(c).alias(c) for c in ("views", "clicks", "leads")],
        *[
            F.coalesce(F.sum(F.when(F.col("measure") == m, F.col("n_distinct"))), F.lit(0)).alias(name)
            for m, name in MEASURES.items()
        ],
    )
    return funnel_rates(grouped, at)
