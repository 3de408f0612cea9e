"""Intermediate tables: staging rows enriched by their parents."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.functions.casts import run_stamp
from forecourt.functions.keys import hash_key
from forecourt.functions.measures import count_where, one_of, or_zero
from forecourt.operators.joins import lookup
from forecourt.schemas import conform

StageMap = Mapping[str, Sequence[str]]

# Which event types count as which funnel stage.
PLAIN_STAGES: StageMap = {"views": ["view"], "clicks": ["click"], "leads": ["lead"]}
MARKETPLACE_STAGES: StageMap = {
    "views": ["LISTING_VIEW"],
    "clicks": ["DEALER_WEBSITE_CLICK"],
    "leads": ["EMAIL_LEAD", "PHONE_LEAD"],
}

_ACCOUNT = {"dealer_name": "dealer_name", "market": "market", "segment": "segment", "sales_rep": "sales_rep"}
_PRODUCT = {"product_name": "product_name", "product_family": "product_family"}

Stamp = Column | str | None


def stage_counts(stages: StageMap = PLAIN_STAGES) -> list[Column]:
    """One count per funnel stage."""
    return [
        count_where(one_of(F.col("event_type"), words)).alias(stage)
        for stage, words in stages.items()
    ]


def snapshot_rows(
    subscriptions: DataFrame,
    contracts: DataFrame,
    accounts: DataFrame,
    products: DataFrame,
    dim_dealer: DataFrame | None = None,
    dim_product: DataFrame | None = None,
) -> DataFrame:
    """Subscriptions with what their parents say and, where dimensions are given, their keys.

    A dimension is looked up right after the parent with the same id, where the rows
    lie by that id already. NULL ids are spread by other ids, so that the key of a
    subscription is moved only where it is asked for.
    """
    rows = subscriptions.withColumnRenamed("updated_at", "subscription_updated_at")
    rows = lookup(
        rows,
        contracts,
        on={"contract_id": "contract_id"},
        take={
            "contract_start_date": "contract_start_date",
            "contract_end_date": "contract_end_date",
            "contract_status": "contract_status",
            "auto_renew": "auto_renew",
            "contract_updated_at": "updated_at",
        },
        spread_by=("dealer_id", "product_id", "subscription_start_date"),
    )
    product = {**_PRODUCT, "product_updated_at": "updated_at"}
    other = ("dealer_id", "subscription_start_date")
    rows = _with_parent(rows, products, "product", product, dim_product, other)
    account = {**_ACCOUNT, "account_status": "account_status", "account_updated_at": "updated_at"}
    other = ("product_id", "subscription_start_date")
    rows = _with_parent(rows, accounts, "dealer", account, dim_dealer, other)
    return named_keys(rows, "product", "dealer")


def int_dealer_subscription_snapshot(
    subscriptions: DataFrame,
    contracts: DataFrame,
    accounts: DataFrame,
    products: DataFrame,
    at: Stamp = None,
) -> DataFrame:
    rows = snapshot_rows(subscriptions, contracts, accounts, products)
    rows = rows.withColumn("transformed_at", run_stamp(at))
    return conform(rows, "int_dealer_subscription_snapshot")


def _with_parent(
    rows: DataFrame,
    parent: DataFrame,
    name: str,
    take: Mapping[str, str],
    dim: DataFrame | None,
    spread_by: Sequence[str] | None = None,
) -> DataFrame:
    rows = lookup(rows, parent, {f"{name}_id": f"{name}_id"}, take, spread_by)
    return rows if dim is None else find_key(rows, dim, name, spread_by)


def find_key(
    rows: DataFrame, dim: DataFrame, name: str, spread_by: Sequence[str] | None = None
) -> DataFrame:
    """Look a surrogate key up, in the form in which it is moved: see ``named_keys``.

    A hashed key is as long as a row's other ids together and does not compress. Where the
    dimension's key is the hash of its id, only that fact goes on with the row.
    """
    key, business_key = F.col(f"{name}_key"), f"{name}_id"
    hashed = F.coalesce(key == hash_key(business_key), F.lit(False))
    told = dim.select(
        business_key, hashed.alias("hashed"), F.when(~hashed, key).alias("other")
    )
    take = {f"__{name}_hashed": "hashed", f"__{name}_other": "other"}
    return lookup(rows, told, {business_key: business_key}, take, spread_by)


def named_keys(rows: DataFrame, *names: str) -> DataFrame:
    """The surrogate keys that ``find_key`` has found, after the last join."""
    for name in names:
        hashed, other = f"__{name}_hashed", f"__{name}_other"
        if hashed in rows.columns:
            key = F.when(F.col(hashed), hash_key(f"{name}_id")).otherwise(F.col(other))
            rows = rows.withColumn(f"{name}_key", key).drop(hashed, other)
    return rows


def invoice_rows(
    invoices: DataFrame,
    subscriptions: DataFrame,
    contracts: DataFrame,
    accounts: DataFrame,
    products: DataFrame,
    dim_dealer: DataFrame | None = None,
    dim_product: DataFrame | None = None,
    few: bool = False,
    moved: bool = False,
) -> DataFrame:
    """Invoices with what their parents say and, where dimensions are given, their keys.

    Contract and product hang on the subscription found; the dealer is the invoice's own.
    Either side meets its own parents while it is narrow, then both meet once. With
    ``few`` invoices beside many subscriptions, those found go on to their parents instead.
    ``moved`` rows are to be moved again: they leave the keys as ``find_key`` gives them.
    """
    own = {
        "contract_id": "contract_id",
        "product_id": "product_id",
        "billing_frequency": "billing_frequency",
        "contract_price": "contract_price",
        "discount_pct": "discount_pct",
        "subscription_status": "subscription_status",
    }
    by_subscription = {"subscription_id": "subscription_id"}

    def with_contract_and_product(rows: DataFrame) -> DataFrame:
        rows = lookup(
            rows,
            contracts,
            on={"contract_id": "contract_id"},
            take={"contract_status": "contract_status"},
        )
        return _with_parent(rows, products, "product", _PRODUCT, dim_product)

    if few:
        rows = with_contract_and_product(lookup(invoices, subscriptions, by_subscription, own))
        rows = _with_parent(rows, accounts, "dealer", _ACCOUNT, dim_dealer)
        return rows if moved else named_keys(rows, "product", "dealer")
    known = with_contract_and_product(subscriptions.select("subscription_id", *own.values()))
    other = ("subscription_id", "invoice_date")
    rows = _with_parent(invoices, accounts, "dealer", _ACCOUNT, dim_dealer, other)
    found = {c: c for c in known.columns if c != "subscription_id"}
    rows = lookup(rows, known, by_subscription, found, ("dealer_id", "invoice_date"))
    return rows if moved else named_keys(rows, "product", "dealer")


def int_invoice_enriched(
    invoices: DataFrame,
    subscriptions: DataFrame,
    contracts: DataFrame,
    accounts: DataFrame,
    products: DataFrame,
    at: Stamp = None,
) -> DataFrame:
    rows = invoice_rows(invoices, subscriptions, contracts, accounts, products)
    rows = rows.withColumn("transformed_at", run_stamp(at))
    return conform(rows, "int_invoice_enriched")


def listing_engagement(events: DataFrame, stages: StageMap = PLAIN_STAGES) -> DataFrame:
    """Events per listing, grouped before any join so that nothing fans out."""
    return (
        events.filter(F.col("listing_id").isNotNull())
        .groupBy("listing_id")
        .agg(
            F.min("event_timestamp").alias("first_event_at"),
            F.max("event_timestamp").alias("last_event_at"),
            *stage_counts(stages),
            F.count(F.lit(1)).alias("engagement_events"),
            F.countDistinct("session_id").alias("unique_sessions"),
        )
    )


def int_listing_engagement(
    listings: DataFrame,
    vehicles: DataFrame,
    events: DataFrame,
    at: Stamp = None,
    stages: StageMap = PLAIN_STAGES,
) -> DataFrame:
    counts = ["views", "clicks", "leads", "engagement_events", "unique_sessions"]
    vehicle = ["make", "model", "model_year", "fuel_type", "body_type", "mileage_km"]
    rows = lookup(
        listings, vehicles, on={"vehicle_id": "vehicle_id"}, take={c: c for c in vehicle}
    )
    rows = lookup(
        rows,
        listing_engagement(events, stages),
        on={"listing_id": "listing_id"},
        take={c: c for c in ("first_event_at", "last_event_at", *counts)},
    )
    rows = rows.withColumns({c: or_zero(F.col(c)) for c in counts})
    rows = rows.withColumn("transformed_at", run_stamp(at))
    return conform(rows, "int_listing_engagement")


def int_price_book(prices: DataFrame, products: DataFrame, at: Stamp = None) -> DataFrame:
    rows = lookup(
        prices,
        products,
        on={"product_id": "product_id"},
        take={**_PRODUCT, "product_active": "active"},
    )
    return conform(rows.withColumn("transformed_at", run_stamp(at)), "int_price_book")


def int_sales_targets(targets: DataFrame, at: Stamp = None) -> DataFrame:
    return conform(targets.withColumn("transformed_at", run_stamp(at)), "int_sales_targets")
