"""The layers in their order: raw gates, staging, gates, intermediate, dimensions, facts,
marts, gates. Each model is read from the tables of the layer before and upserted."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping
from concurrent.futures import ThreadPoolExecutor
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.operators.incremental import in_window, month_windows, resume_range, source_filter
from forecourt.operators.upsert import upsert_partitions, upsert_version
from forecourt.plans import dimensions, facts, intermediate, marts, quality
from forecourt.plans.staging import STAGES, StageSpec, stage
from forecourt.schemas import TABLES, schema_of
from forecourt.sources.raw import LINES_FILES, RAW_FOLDERS, RAW_READERS, partition_values
from forecourt.sources.tables import read_manifest, read_partitions, read_version

RAW_NAMES = {
    "raw_marketplace_vehicles": "stg_marketplace_vehicles",
    "raw_marketplace_listings": "stg_marketplace_listings",
    "raw_engagement_events": "stg_engagement_events",
    "raw_sales_targets": "stg_sales_targets",
}


FACT_DAYS = {
    "fact_revenue": "invoice_date",
    "fact_subscription": "subscription_start_date",
    "fact_listing_performance": "listing_start_date",
}


class Lake:
    """Locations of the raw files and of the curated tables."""

    def __init__(self, spark: SparkSession, raw_root: str, table_root: str):
        self.spark = spark
        self.raw_root = raw_root
        self.table_root = table_root

    def raw_path(self, staging_table: str) -> str:
        return f"{self.raw_root}/{RAW_FOLDERS[staging_table]}"

    def raw(self, staging_table: str) -> DataFrame:
        return RAW_READERS[staging_table](self.spark, self.raw_path(staging_table))

    def path(self, table: str) -> str:
        return f"{self.table_root}/{table}"

    def found(self, table: str) -> DataFrame | None:
        if self.partition_column(table):
            rows = read_partitions(self.spark, self.path(table), table)
        else:
            rows = read_version(self.spark, self.path(table), table)
        return None if rows is None else rows.select(*schema_of(table).names)

    def partition_column(self, table: str) -> str | None:
        """The day by which a table is partitioned: of a fact, once it has been refreshed by month."""
        if table in FACT_DAYS:
            return FACT_DAYS[table] if read_manifest(self.spark, self.path(table)) else None
        return STAGES[table].partition_column if table in STAGES else None

    def table(self, name: str) -> DataFrame:
        rows = self.found(name)
        return self.spark.createDataFrame([], schema_of(name)) if rows is None else rows

    def tables(self, prefix: str) -> dict[str, DataFrame]:
        return {t: self.table(t) for t in TABLES if t.startswith(prefix)}

    def upsert(
        self,
        table: str,
        rows: DataFrame,
        guard: tuple[str, ...] = (),
        mark: str | None = None,
    ) -> None:
        """Upsert rows that are unique by construction: staged rows are the latest of their
        key, later tables hang on keys that the staging gate has found unique."""
        column = self.partition_column(table)
        if column:
            by_month = table != "stg_engagement_events"
            upsert_partitions(
                self.spark,
                self.path(table),
                table,
                rows,
                column,
                by_month,
                guard,
                verify_keys=False,
                mark=mark,
            )
        else:
            upsert_version(
                self.spark, self.path(table), table, rows, guard, verify_keys=False
            )


def _guard(spec: StageSpec) -> tuple[str, ...]:
    """Columns by which an older extract must not replace newer rows."""
    return tuple(c for c in spec.newest_first if c != "source_file")


def stage_table(
    lake: Lake, table: str, run_day: date, at: str | None = None, guarded: bool = True
) -> None:
    """Stage one dataset: everything on the first run, the run's partition later."""
    spec = STAGES[table]
    if table == "stg_engagement_events":
        stage_events(lake, at, guarded)
        return
    first_run = lake.table(table).isEmpty()
    where = source_filter(spec.filter_column, run_day, first_run, spec.lookback_days)
    rows = stage(spec, lake.raw(table), where, at)
    lake.upsert(table, rows, _guard(spec) if guarded else ())


def event_range(lake: Lake, lookback_days: int) -> tuple[date, date] | None:
    """Days of events to stage, from folder names and the day up to which the last commit read."""
    table = "stg_engagement_events"
    days = partition_values(lake.spark, lake.raw_path(table), "event_date", LINES_FILES)
    as_day = F.col("event_date").try_cast("date")
    first, last = days.agg(F.min(as_day), F.max(as_day)).first()
    committed = read_manifest(lake.spark, lake.path(table))
    mark = committed["mark"] if committed else None
    staged_last = date.fromisoformat(mark) if mark else None
    return resume_range(first, last, staged_last, lookback_days)


def stage_events(
    lake: Lake, at: str | None = None, guarded: bool = True, by_month: bool = False
) -> None:
    """Stage events from the look-back on.

    One upsert covers the range; ``by_month`` runs one per calendar month, so
    that a long history can be resumed after each.
    """
    spec = STAGES["stg_engagement_events"]
    span = event_range(lake, spec.lookback_days)
    if span is None:
        return
    first, last = span
    windows = list(month_windows(first, last))
    if not by_month:
        windows = [(windows[0][0], windows[-1][1])]
    for start, end in windows:
        rows = stage(spec, lake.raw(spec.table), in_window("event_date", start, end), at)
        read_to = (end - timedelta(days=1)).isoformat()
        lake.upsert(spec.table, rows, _guard(spec) if guarded else (), read_to)


def intermediate_models(t: Callable[[str], DataFrame], at: str | None) -> Mapping[str, Callable]:
    return {
        "int_dealer_subscription_snapshot": lambda: intermediate.int_dealer_subscription_snapshot(
            t("stg_commercial_subscriptions"),
            t("stg_commercial_contracts"),
            t("stg_commercial_accounts"),
            t("stg_pricing_products"),
            at,
        ),
        "int_invoice_enriched": lambda: intermediate.int_invoice_enriched(
            t("stg_commercial_invoices"),
            t("stg_commercial_subscriptions"),
            t("stg_commercial_contracts"),
            t("stg_commercial_accounts"),
            t("stg_pricing_products"),
            at,
        ),
        "int_listing_engagement": lambda: intermediate.int_listing_engagement(
            t("stg_marketplace_listings"),
            t("stg_marketplace_vehicles"),
            t("stg_engagement_events"),
            at,
        ),
        "int_price_book": lambda: intermediate.int_price_book(
            t("stg_pricing_prices"), t("stg_pricing_products"), at
        ),
        "int_sales_targets": lambda: intermediate.int_sales_targets(t("stg_sales_targets"), at),
    }


def dimension_models(
    t: Callable[[str], DataFrame], spark: SparkSession, days: tuple[date, date], at: str | None
) -> Mapping[str, Callable]:
    return {
        "dim_dealer": lambda: dimensions.dim_dealer(t("stg_commercial_accounts"), at),
        "dim_product": lambda: dimensions.dim_product(t("stg_pricing_products"), at),
        "dim_vehicle": lambda: dimensions.dim_vehicle(t("stg_marketplace_vehicles"), at),
        "dim_date": lambda: dimensions.dim_date(spark, *days, at),
    }


def fact_models(t: Callable[[str], DataFrame], at: str | None) -> Mapping[str, Callable]:
    return {
        "fact_revenue": lambda: facts.fact_revenue(
            t("int_invoice_enriched"), t("dim_date"), t("dim_dealer"), t("dim_product"), at
        ),
        "fact_subscription": lambda: facts.fact_subscription(
            t("int_dealer_subscription_snapshot"),
            t("dim_date"),
            t("dim_dealer"),
            t("dim_product"),
            at,
        ),
        "fact_listing_performance": lambda: facts.fact_listing_performance(
            t("int_listing_engagement"), t("dim_date"), t("dim_dealer"), t("dim_vehicle"), at
        ),
        "fact_sales_target": lambda: facts.fact_sales_target(
            t("int_sales_targets"), t("dim_date"), at
        ),
    }


def mart_models(t: Callable[[str], DataFrame], at: str | None) -> Mapping[str, Callable]:
    return {
        "mart_sales_performance_monthly": lambda: marts.mart_sales_performance_monthly(
            t("fact_revenue"), t("fact_sales_target"), t("fact_subscription"), at
        ),
        "mart_dealer_360": lambda: marts.mart_dealer_360(
            t("dim_dealer"),
            t("fact_revenue"),
            t("fact_subscription"),
            t("fact_listing_performance"),
            at,
        ),
        "mart_product_performance_monthly": lambda: marts.mart_product_performance_monthly(
            t("fact_revenue"), t("fact_subscription"), t("int_price_book"), t("dim_product"), at
        ),
        "mart_marketplace_funnel_monthly": lambda: marts.mart_marketplace_funnel_monthly(
            t("stg_engagement_events"), t("stg_commercial_accounts"), at
        ),
    }


def together(tasks: Iterable[Callable[[], object]], parallel: int) -> None:
    """Submit independent jobs side by side, so that small ones fill the cluster; the first
    failure is raised after the others have ended."""
    with ThreadPoolExecutor(max_workers=parallel) as pool:
        futures = [pool.submit(task) for task in tasks]
    for future in futures:
        future.result()


def run_layer(
    lake: Lake, models: Mapping[str, Callable[[], DataFrame]], parallel: int = 4
) -> None:
    """Upsert the models of one layer; they do not depend on each other."""
    together(
        [lambda t=table, m=model: lake.upsert(t, m()) for table, model in models.items()], parallel
    )


def run_all(
    lake: Lake,
    run_day: date,
    days: tuple[date, date] = (dimensions.FIRST_DAY, dimensions.LAST_DAY),
    at: str | None = None,
    parallel: int = 4,
) -> None:
    """One daily run. A gate that finds bad rows stops it before the next layer."""
    quality.assert_clean(
        quality.raw_checks({name: lake.raw(table) for name, table in RAW_NAMES.items()})
    )
    together([lambda t=table: stage_table(lake, t, run_day, at) for table in STAGES], parallel)
    quality.assert_clean(quality.staging_checks(lake.tables("stg_")))
    run_layer(lake, intermediate_models(lake.table, at), parallel)
    run_layer(lake, dimension_models(lake.table, lake.spark, days, at), parallel)
    run_layer(lake, fact_models(lake.table, at), parallel)
    run_layer(lake, mart_models(lake.table, at), parallel)
    built = {**lake.tables("dim_"), **lake.tables("fact_"), **lake.tables("mart_")}
    quality.assert_clean(quality.analytics_checks(built))
