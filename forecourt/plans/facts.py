"""Facts: intermediate rows with the surrogate keys of their dimensions.

``fact_revenue`` and ``fact_subscription`` are made of intermediate rows that have been
written. ``revenue_from_staging`` and ``subscription_from_staging`` give the same rows from
staged tables in one go, where each id is looked up in parent and dimension at once.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame

from forecourt.functions.casts import run_stamp
from forecourt.operators.joins import lookup
from forecourt.plans.intermediate import find_key, invoice_rows, named_keys, snapshot_rows
from forecourt.schemas import column_types, conform

Stamp = Column | str | None


def with_date_keys(rows: DataFrame, dim_date: DataFrame, keys: Mapping[str, str]) -> DataFrame:
    """Add a date key per date column (new name: date column); the calendar plays each role."""
    for new, day in keys.items():
        rows = lookup(rows, dim_date, on={day: "calendar_date"}, take={new: "date_key"})
    return rows


def _keyed(rows: DataFrame, **dims: DataFrame) -> DataFrame:
    """Rows with the surrogate key of each dimension (name: dimension)."""
    for name, dim in dims.items():
        rows = find_key(rows, dim, name)
    return named_keys(rows, *dims)


_REVENUE_DAYS = {"date_key": "invoice_date"}
_SUBSCRIPTION_DAYS = {
    "start_date_key": "subscription_start_date",
    "end_date_key": "subscription_end_date",
}


def fact_revenue(
    invoices: DataFrame,
    dim_date: DataFrame,
    dim_dealer: DataFrame,
    dim_product: DataFrame,
    at: Stamp = None,
) -> DataFrame:
    rows = with_date_keys(invoices, dim_date, _REVENUE_DAYS)
    rows = _keyed(rows, dealer=dim_dealer, product=dim_product)
    return conform(rows.withColumn("loaded_at", run_stamp(at)), "fact_revenue")


def revenue_from_staging(
    invoices: DataFrame,
    subscriptions: DataFrame,
    contracts: DataFrame,
    accounts: DataFrame,
    products: DataFrame,
    dim_date: DataFrame,
    dim_dealer: DataFrame,
    dim_product: DataFrame,
    at: Stamp = None,
    few: bool = False,
) -> DataFrame:
    """``few`` is as for ``invoice_rows``."""
    rows = moved_revenue(
        invoices, subscriptions, contracts, accounts, products, dim_date, dim_dealer, dim_product, few
    )
    return named_revenue(rows, at)


def moved_revenue(
    invoices: DataFrame,
    subscriptions: DataFrame,
    contracts: DataFrame,
    accounts: DataFrame,
    products: DataFrame,
    dim_date: DataFrame,
    dim_dealer: DataFrame,
    dim_product: DataFrame,
    few: bool = False,
) -> DataFrame:
    """Revenue rows in the form in which they are moved, without hashed keys."""
    rows = invoice_rows(
        invoices, subscriptions, contracts, accounts, products, dim_dealer, dim_product, few,
        moved=True,
    )
    rows = with_date_keys(rows, dim_date, _REVENUE_DAYS)
    asked = [c for c in rows.columns if c in column_types("fact_revenue") or c.startswith("__")]
    return rows.select(*asked)


def named_revenue(rows: DataFrame, at: Stamp = None) -> DataFrame:
    """``moved_revenue`` rows as the fact has them, where they are."""
    named = named_keys(rows, "product", "dealer").withColumn("loaded_at", run_stamp(at))
    return conform(named, "fact_revenue")


def fact_subscription(
    snapshot: DataFrame,
    dim_date: DataFrame,
    dim_dealer: DataFrame,
    dim_product: DataFrame,
    at: Stamp = None,
) -> DataFrame:
    rows = with_date_keys(snapshot, dim_date, _SUBSCRIPTION_DAYS)
    rows = _keyed(rows, dealer=dim_dealer, product=dim_product)
    return conform(rows.withColumn("loaded_at", run_stamp(at)), "fact_subscription")


def subscription_from_staging(
    subscriptions: DataFrame,
    contracts: DataFrame,
    accounts: DataFrame,
    products: DataFrame,
    dim_date: DataFrame,
    dim_dealer: DataFrame,
    dim_product: DataFrame,
    at: Stamp = None,
) -> DataFrame:
    rows = snapshot_rows(subscriptions, contracts, accounts, products, dim_dealer, dim_product)
    rows = with_date_keys(rows, dim_date, _SUBSCRIPTION_DAYS)
    return conform(rows.withColumn("loaded_at", run_stamp(at)), "fact_subscription")


def fact_listing_performance(
    listings: DataFrame,
    dim_date: DataFrame,
    dim_dealer: DataFrame,
    dim_vehicle: DataFrame,
    at: Stamp = None,
) -> DataFrame:
    rows = with_date_keys(
        listings,
        dim_date,
        {"start_date_key": "listing_start_date", "end_date_key": "listing_end_date"},
    )
    rows = _keyed(rows, dealer=dim_dealer, vehicle=dim_vehicle)
    return conform(rows.withColumn("loaded_at", run_stamp(at)), "fact_listing_performance")


def fact_sales_target(targets: DataFrame, dim_date: DataFrame, at: Stamp = None) -> DataFrame:
    rows = with_date_keys(targets, dim_date, {"date_key": "target_month"})
    return conform(rows.withColumn("loaded_at", run_stamp(at)), "fact_sales_target")
