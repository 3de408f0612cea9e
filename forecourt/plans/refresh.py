"""Facts brought up to date by touched month, in proportion to what has changed.

A fact row hangs on one base row (invoice, subscription, listing) and on the parents
that base row looks up. A fact has to be recomputed for the months in which a
base row or one of its parents has changed, and for the months that a changed
base row has left; all other partitions stay as they are.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from functools import partial, reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.functions.workspace import cut_lineage
from forecourt.plans import facts, intermediate
from forecourt.plans.layers import FACT_DAYS, Lake
from forecourt.sources.tables import PARTITION, partition_value, read_partitions, write_partitions


def touched_months(rows: DataFrame, day: str, changed: Mapping[str, DataFrame]) -> DataFrame:
    """Months of the rows whose key in some column is among the changed keys of that column.

    ``changed`` has one frame of one key column for each column of the rows. Only
    the day and that column are read in each pass.
    """
    months = []
    for column, keys in changed.items():
        wanted = keys.select(F.col(keys.columns[0]).alias("__key")).distinct()
        found = rows.join(wanted, F.col(column) == F.col("__key"), "left_semi")
        months.append(found.select(partition_value(day, True).alias(PARTITION)))
    return reduce(DataFrame.unionAll, months).distinct()


def in_months(day: str, months: Sequence[str]) -> Column:
    """Whether a row falls in one of the months, as ranges of days that a scan can use."""
    ranges = [
        (F.col(day) >= F.lit(m).cast("date")) & (F.col(day) < F.add_months(F.lit(m).cast("date"), 1))
        for m in months
        if m != "none"
    ]
    if "none" in months:
        ranges.append(F.col(day).isNull())
    return reduce(Column.__or__, ranges, F.lit(False))


def refresh_months(
    root: str,
    table: str,
    key: str,
    day: str,
    base: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    changed: Mapping[str, DataFrame],
    finish: Callable[[DataFrame], DataFrame] | None = None,
) -> list[str]:
    """Recompute a fact for its touched months only, in one commit; the months, sorted.

    ``build`` makes fact rows from base rows; it is given those of the touched months.
    ``changed`` is as for ``touched_months`` and has the ``key`` of the base. Where the
    fact has not been written before, all months are. ``finish`` is as for
    ``write_partitions``: what follows from other columns is added after the last move.
    """
    spark = base.sparkSession
    stored = read_partitions(spark, root, table)
    value = partition_value(day, True)
    if stored is None:
        write_partitions(build(base), root, value, finish=finish)
        return sorted(r[0] for r in base.select(value).distinct().collect())
    left = touched_months(stored, day, {key: changed[key]})
    # As many as there are months, never rows.
    months = sorted(r[0] for r in touched_months(base, day, changed).union(left).distinct().collect())
    if months:
        rows = build(base.filter(in_months(day, months)))
        write_partitions(rows, root, value, months, finish=finish)
    return months


def refresh_facts(lake: Lake, since: str, at: str | None = None) -> dict[str, list[str]]:
    """Bring the three large facts up to date with the rows staged at ``since`` or later.

    Staging and dimensions must be up to date. Returns the months rewritten of each.
    """
    t = lake.table

    def fresh(table: str, key: str) -> DataFrame:
        stamped = t(table).filter(F.col("staged_at") >= F.lit(since).cast("timestamp_ntz"))
        return cut_lineage(stamped.select(key).distinct())

    accounts = fresh("stg_commercial_accounts", "dealer_id")
    products = fresh("stg_pricing_products", "product_id")
    contracts = fresh("stg_commercial_contracts", "contract_id")
    subscriptions = t("stg_commercial_subscriptions")
    hanging = [
        subscriptions.join(contracts, "contract_id", "left_semi"),
        subscriptions.join(products, "product_id", "left_semi"),
    ]
    own = fresh("stg_commercial_subscriptions", "subscription_id")
    moved = reduce(DataFrame.unionAll, [s.select("subscription_id") for s in hanging], own)

    def revenue(rows: DataFrame) -> DataFrame:
        return facts.moved_revenue(
            rows, subscriptions, t("stg_commercial_contracts"), t("stg_commercial_accounts"),
            t("stg_pricing_products"), t("dim_date"), t("dim_dealer"), t("dim_product"), few=True,
        )

    def subscribed(rows: DataFrame) -> DataFrame:
        return facts.subscription_from_staging(
            rows, t("stg_commercial_contracts"), t("stg_commercial_accounts"),
            t("stg_pricing_products"), t("dim_date"), t("dim_dealer"), t("dim_product"), at,
        )

    def listed(rows: DataFrame) -> DataFrame:
        shown = t("stg_engagement_events").join(rows.select("listing_id"), "listing_id", "left_semi")
        engaged = intermediate.int_listing_engagement(rows, t("stg_marketplace_vehicles"), shown, at)
        return facts.fact_listing_performance(
            engaged, t("dim_date"), t("dim_dealer"), t("dim_vehicle"), at
        )

    listings = fresh("stg_marketplace_listings", "listing_id")
    viewed = fresh("stg_engagement_events", "listing_id")
    jobs = {
        "fact_revenue": (
            "invoice_id", t("stg_commercial_invoices"), revenue,
            {
                "invoice_id": fresh("stg_commercial_invoices", "invoice_id"),
                "subscription_id": moved,
                "dealer_id": accounts,
            },
            partial(facts.named_revenue, at=at),
        ),
        "fact_subscription": (
            "subscription_id", subscriptions, subscribed,
            {"subscription_id": moved, "dealer_id": accounts},
        ),
        "fact_listing_performance": (
            "listing_id", t("stg_marketplace_listings"), listed,
            {
                "listing_id": listings.unionAll(viewed),
                "dealer_id": accounts,
                "vehicle_id": fresh("stg_marketplace_vehicles", "vehicle_id"),
            },
        ),
    }
    return {
        table: refresh_months(lake.path(table), table, key, FACT_DAYS[table], *rest)
        for table, (key, *rest) in jobs.items()
    }
