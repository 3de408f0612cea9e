"""Checked queries: upserts, watermarks, look-back, batches and the event stream."""

from __future__ import annotations

from datetime import date, datetime
from functools import partial

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.checks.cases import Cases
from forecourt.checks.compare import plain
from forecourt.checks.duck import table_output
from forecourt.checks.frames import LensModels
from forecourt.checks.rawrows import (
    event_versions,
    line_versions,
    single_record_pages,
    versions,
    write_event_days,
)
from forecourt.checks.staging import LINEAGE
from forecourt.functions.keys import month_start
from forecourt.functions.workspace import cut_lineage, scratch_path
from forecourt.operators import incremental, upsert
from forecourt.plans import facts, funnel, refresh
from forecourt.plans.layers import Lake, stage_events
from forecourt.plans.staging import STAGES, stage
from forecourt.sources import tables
from forecourt.sources.raw import RAW_FOLDERS
from forecourt.sources.tables import read_partitions, read_version
from forecourt.streaming.events import append_once, read_event_stream, stage_event_stream

cases = Cases()
case = cases.case

EVENTS = "stg_engagement_events"
CONTRACTS = "stg_commercial_contracts"
INVOICES = "stg_commercial_invoices"
FUNNEL = "mart_marketplace_funnel_monthly"


def staged_contracts(m: LensModels) -> DataFrame:
    """Contracts in the form of their staging table."""
    return lineage(m.contracts)


def lineage(rows: DataFrame, day: str = "2024-01-01") -> DataFrame:
    return rows.select(
        "*",
        F.lit(day).cast("date").alias("source_extract_date"),
        F.lit("run").alias("source_run_id"),
        F.lit("file").alias("source_file"),
        F.lit("2024-01-01 02:00:00").cast("timestamp_ntz").alias("staged_at"),
    )


# Watermarks


@case(
    "source_watermark",
    """SELECT 'contracts' AS dataset, CAST(max(updated_at) AS VARCHAR) AS watermark FROM contracts
       UNION ALL SELECT 'prices', CAST(max(updated_at) AS VARCHAR) FROM prices
       UNION ALL SELECT 'events', NULL""",
    "contracts", "prices",
)
def _(m: LensModels) -> DataFrame:
    # Two runs each for contracts and prices; a run over events died before its commit.
    control = scratch_path(m.spark, "marks")
    for rows, dataset in ((m.contracts, "contracts"), (m.prices, "prices")):
        early = rows.filter(F.col("updated_at") < "1996-01-01")
        for turn, part in enumerate((early, rows), start=1):
            mark = incremental.high_watermark(part, "updated_at")
            incremental.commit_watermark(m.spark, control, dataset, mark, datetime(2024, 1, turn))
    marks = [
        (d, incremental.read_watermark(m.spark, control, d)) for d in ("contracts", "prices", "events")
    ]
    return m.spark.createDataFrame(marks, "dataset string, watermark string")


@case(
    "bootstrap_or_incremental",
    table_output("stg_commercial_accounts", "accounts", skip=LINEAGE),
)
def _(m: LensModels) -> DataFrame:
    # Three daily runs: the first reads all there is, the next ones their own partition.
    spec = STAGES["stg_commercial_accounts"]
    pages = cut_lineage(single_record_pages(versions(m.accounts, "accounts")))
    root = scratch_path(m.spark, "accounts")
    for day in (date(2024, 1, 1), date(2024, 1, 2), date(2024, 1, 3)):
        first_run = read_version(m.spark, root, spec.table) is None
        arrived = pages.filter(F.col("extract_date") <= day.isoformat())
        where = incremental.source_filter(spec.filter_column, day, first_run)
        rows = stage(spec, arrived, where)
        upsert.upsert_version(m.spark, root, spec.table, rows, spec.newest_first)
    return plain(read_version(m.spark, root, spec.table), *LINEAGE)


# Events by look-back, month and stream


def event_lake(m: LensModels) -> Lake:
    return Lake(m.spark, scratch_path(m.spark, "raw"), scratch_path(m.spark, "tables"))


def deliver(lake: Lake, rows: DataFrame) -> None:
    write_event_days(rows, f"{lake.raw_root}/{RAW_FOLDERS[EVENTS]}", mode="append")


def staged_events(lake: Lake) -> DataFrame:
    return plain(lake.table(EVENTS), *LINEAGE)


_EVENT_COLUMNS = table_output(EVENTS, "events_view", skip=LINEAGE)


@case(
    "lookback_resume",
    _EVENT_COLUMNS + " WHERE event_date >= DATE '2024-01-13' OR device <> 'TABLET'",
)
def _(m: LensModels) -> DataFrame:
    # Tablet events of the first half arrive late: those two days back at most are still
    # taken, older ones are not.
    lake, rows = event_lake(m), m.events.withColumn("event_timestamp", F.col("event_timestamp").cast("string"))
    early = F.col("event_date") <= "2024-01-15"
    on_time = F.col("device") != "TABLET"
    deliver(lake, rows.filter(early & on_time))
    stage_events(lake)
    deliver(lake, rows.filter(~(early & on_time)))
    stage_events(lake)
    return staged_events(lake)


@case(
    "monthly_batches",
    """SELECT CAST(greatest(month_start, first_day) AS VARCHAR) AS batch_start,
              CAST(least(CAST(month_start + INTERVAL 1 MONTH AS DATE), last_day + 1) AS VARCHAR)
                  AS batch_end,
              count(*) AS contracts
       FROM (SELECT make_date(year(contract_start_date), month(contract_start_date), 1)
                        AS month_start,
                    min(contract_start_date) OVER () AS first_day,
                    max(contract_start_date) OVER () AS last_day FROM contracts)
       GROUP BY month_start, first_day, last_day""",
    "contracts",
)
def _(m: LensModels) -> DataFrame:
    days = m.contracts.agg(F.min("contract_start_date"), F.max("contract_start_date")).first()
    windows = list(incremental.month_windows(days[0], days[1]))
    batches = m.spark.createDataFrame(windows, "batch_start date, batch_end date")
    batches = batches.withColumn("month", month_start(F.col("batch_start")))
    per_month = m.contracts.groupBy(month_start(F.col("contract_start_date")).alias("month")).agg(
        F.count(F.lit(1)).alias("contracts")
    )
    return batches.join(per_month, "month").drop("month")


@case("idempotent_reprocess", table_output(INVOICES, "invoices", skip=LINEAGE))
def _(m: LensModels) -> DataFrame:
    # The same pages are staged and upserted twice.
    spec = STAGES[INVOICES]
    pages = cut_lineage(single_record_pages(line_versions(m, "invoices")), "zstd")
    root = scratch_path(m.spark, "invoices")
    for _run in range(2):
        upsert.upsert_partitions(
            m.spark, root, INVOICES, stage(spec, pages), spec.partition_column, True
        )
    return plain(read_partitions(m.spark, root, INVOICES), *LINEAGE, "part")


@case("event_dedup", _EVENT_COLUMNS)
def _(m: LensModels) -> DataFrame:
    # Events repeat inside a delivery and across deliveries.
    lake, rows = event_lake(m), cut_lineage(event_versions(m))
    deliver(lake, rows.filter(F.col("event_date") <= "2024-01-16"))
    stage_events(lake, by_month=True)
    deliver(lake, rows.filter(F.col("event_date") >= "2024-01-15"))
    stage_events(lake, by_month=True)
    return staged_events(lake)


@case("interrupted_write", _EVENT_COLUMNS)
def _(m: LensModels) -> DataFrame:
    # The first staging run dies after its rows are written and before they are published;
    # the second one dies on late days. Each is repeated, and no day is missing.
    lake, rows = event_lake(m), cut_lineage(event_versions(m))
    deliver(lake, rows.filter(F.col("event_date") <= "2024-01-16"))
    dying_run(lake)
    stage_events(lake)
    deliver(lake, rows.filter(F.col("event_date") >= "2024-01-15"))
    dying_run(lake)
    stage_events(lake)
    return staged_events(lake)


def dying_run(lake: Lake) -> None:
    """A staging run that is lost just before its commit."""

    def lost(*_: object) -> None:
        raise InterruptedError("planted")

    published, tables.publish = tables.publish, lost
    try:
        stage_events(lake)
    except InterruptedError:
        pass
    finally:
        tables.publish = published


@case("stream_event_staging", _EVENT_COLUMNS)
def _(m: LensModels) -> DataFrame:
    # The landed files are taken as a stream, in several micro-batches.
    lake = event_lake(m)
    deliver(lake, event_versions(m))
    stream = read_event_stream(m.spark, lake.raw_path(EVENTS), files_per_batch=40)
    checkpoint = scratch_path(m.spark, "progress")
    query = stage_event_stream(stream, lake.path(EVENTS), checkpoint)
    query.awaitTermination()
    return staged_events(lake)


@case(
    "stream_drop_repeats",
    "SELECT event_id, device FROM events_view",
    "events_view",
)
def _(m: LensModels) -> DataFrame:
    # Every event is delivered twice, the second time in an order that makes most of the
    # days late by far more than a watermark would wait; one of each passes.
    root, out = scratch_path(m.spark, "twice"), scratch_path(m.spark, "once")
    progress = scratch_path(m.spark, "progress")
    rows = m.events.withColumn("event_timestamp", F.col("event_timestamp").cast("string"))
    early = F.col("event_date") <= "2024-01-10"
    for part in (rows.filter(~early), rows, rows.filter(early)):
        write_event_days(part, root, mode="append")
        stream = read_event_stream(m.spark, root, files_per_batch=20)
        wanted = stream.select("event_id", "event_timestamp", "device")
        append_once(wanted, out, progress).awaitTermination()
    return m.spark.read.schema("event_id string, device string, batch int").parquet(out).drop("batch")


@case(
    "month_bucket_agg",
    """SELECT strftime(event_date, '%Y-%m-01') AS month_start, event_type, count(*) AS events,
              count(DISTINCT session_id) AS sessions
       FROM events_view GROUP BY ALL""",
    "events_view",
)
def _(m: LensModels) -> DataFrame:
    return m.events.groupBy(month_start(F.col("event_date")).alias("month_start"), "event_type").agg(
        F.count(F.lit(1)).alias("events"), F.countDistinct("session_id").alias("sessions")
    )


# Upserts


def marked(rows: DataFrame, status: str) -> DataFrame:
    return rows.withColumn("contract_status", F.lit(status))


@case(
    "merge_upsert",
    """SELECT contract_id, CASE WHEN contract_start_date < DATE '1997-01-01' THEN 'OLD'
                                ELSE contract_status END AS contract_status
       FROM contracts""",
    "contracts",
)
def _(m: LensModels) -> DataFrame:
    # Old rows up to 1998 meet a batch from 1997 on.
    rows = staged_contracts(m)
    root = scratch_path(m.spark, "contracts")
    target = marked(rows.filter(F.col("contract_start_date") < "1998-01-01"), "OLD")
    batch = rows.filter(F.col("contract_start_date") >= "1997-01-01")
    for part in (target, batch):
        upsert.upsert_version(m.spark, root, CONTRACTS, part)
    return read_version(m.spark, root, CONTRACTS).select("contract_id", "contract_status")


@case(
    "merge_guarded",
    """SELECT contract_id, CASE WHEN contract_start_date < DATE '1997-01-01'
                                THEN contract_status ELSE 'NEW' END AS contract_status
       FROM contracts""",
    "contracts",
)
def _(m: LensModels) -> DataFrame:
    # A replayed batch is older than the target before 1997 and newer from then on.
    target = staged_contracts(m)
    days = F.when(F.col("contract_start_date") < "1997-01-01", -10).otherwise(10)
    batch = marked(target, "NEW").withColumn("updated_at", F.date_add("updated_at", days))
    merged = upsert.merge_rows(target, batch, "contract_id", guard=["updated_at"])
    return merged.select("contract_id", "contract_status")


@case(
    "merge_cardinality_guard",
    "SELECT contract_id, contract_status FROM contracts",
    "contracts",
)
def _(m: LensModels) -> DataFrame:
    # A batch with two rows for a key is refused and the table stays as it was.
    rows = staged_contracts(m)
    root = scratch_path(m.spark, "contracts")
    upsert.upsert_version(m.spark, root, CONTRACTS, rows)
    refused = False
    try:
        upsert.upsert_version(m.spark, root, CONTRACTS, marked(rows.unionAll(rows), "TWICE"))
    except ValueError:
        refused = True
    left = read_version(m.spark, root, CONTRACTS).select("contract_id", "contract_status")
    return left if refused else left.limit(0)


@case(
    "null_key_insert",
    """SELECT vehicle_id, count(*) * CASE WHEN vehicle_id IS NULL THEN 3 ELSE 1 END AS rows
       FROM listings GROUP BY vehicle_id""",
    "listings",
)
def _(m: LensModels) -> DataFrame:
    # Rows without a key match nothing, so each of two runs adds them again.
    rows = m.listings.select("vehicle_id", "listing_status")
    merged = rows
    for _run in range(2):
        merged = upsert.merge_rows(merged, rows, "vehicle_id", drop_null_keys=False)
    return merged.groupBy("vehicle_id").agg(F.count(F.lit(1)).alias("rows"))


@case(
    "partitioned_rewrite",
    """SELECT invoice_id, CAST(moved AS VARCHAR) AS invoice_date,
              strftime(moved, '%Y-%m-01') AS part
       FROM (SELECT invoice_id, CASE WHEN invoice_date < DATE '1995-03-01'
                                     THEN CAST(invoice_date + INTERVAL 1 YEAR AS DATE)
                                     ELSE invoice_date END AS moved FROM invoices)""",
    "invoices",
)
def _(m: LensModels) -> DataFrame:
    # All invoices of the first months move by a year: their old partitions end up empty.
    root = scratch_path(m.spark, "invoices")
    rows = cut_lineage(lineage(m.invoices))
    moved = rows.filter(F.col("invoice_date") < "1995-03-01").withColumn(
        "invoice_date", F.add_months("invoice_date", 12)
    )
    for part in (rows, moved):
        upsert.upsert_partitions(m.spark, root, INVOICES, part, "invoice_date", True)
    return read_partitions(m.spark, root, INVOICES).select("invoice_id", "invoice_date", "part")


@case(
    "revenue_by_touched_month",
    """SELECT invoice_id, CAST(invoice_date AS VARCHAR) AS invoice_date, dealer_key, product_key,
              CAST(contract_price AS DOUBLE) AS contract_price
       FROM fact_revenue""",
    "fact_revenue",
)
def _(m: LensModels) -> DataFrame:
    """The fact of all but the last two days, with old prices, brought up to date by month."""
    root, table = scratch_path(m.spark, "revenue"), "fact_revenue"
    last = m.staged_invoices.agg(F.date_sub(F.max("invoice_date"), 2)).first()[0]
    new = F.col("invoice_date") > F.lit(last)
    repriced = F.col("subscription_start_date") > F.date_sub(F.lit(last), 60)

    def build(subscriptions: DataFrame, few: bool, rows: DataFrame) -> DataFrame:
        return facts.moved_revenue(
            rows, subscriptions, m.known_contracts, m.accounts, m.known_products,
            m.dim_date, m.dim_dealer, m.known_dim_product, few=few,
        )

    current = m.staged_subscriptions
    stale = current.withColumn("contract_price", F.when(~repriced, F.col("contract_price")))
    nothing = {"invoice_id": m.staged_invoices.select("invoice_id").limit(0)}
    before = m.staged_invoices.filter(~new | F.col("invoice_date").isNull())
    refresh.refresh_months(
        root, table, "invoice_id", "invoice_date", before, partial(build, stale, False), nothing,
        facts.named_revenue,
    )
    changed = {
        "invoice_id": cut_lineage(m.staged_invoices.filter(new).select("invoice_id")),
        "subscription_id": cut_lineage(current.filter(repriced).select("subscription_id")),
    }
    refresh.refresh_months(
        root, table, "invoice_id", "invoice_date", m.staged_invoices,
        partial(build, current, True), changed, facts.named_revenue,
    )
    return read_partitions(m.spark, root, table).select(
        "invoice_id", "invoice_date", "dealer_key", "product_key", "contract_price"
    )


@case("funnel_by_day", table_output(FUNNEL, FUNNEL))
def _(m: LensModels) -> DataFrame:
    """The funnel from merged bitmaps: ten days come incomplete and are recorded again."""
    root = scratch_path(m.spark, "funnel")
    last = m.events.agg(F.date_sub(F.max("event_date"), 10)).first()[0]
    recent = F.col("event_date") > F.lit(last)
    late = recent & (F.pmod(F.xxhash64("event_id"), F.lit(3)) == 0)
    funnel.record_days(root, m.events.filter(~late), m.accounts)
    funnel.record_days(root, m.events.filter(recent), m.accounts)
    return funnel.recorded_funnel(m.spark, root)


QUERIES, ORACLES = cases.queries, cases.oracles
