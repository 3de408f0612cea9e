"""Monthly and per-dealer marts.

Where several facts meet on the same keys, their rows are stacked and grouped
once instead of being grouped apart and joined on a spine of keys.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.functions.casts import run_stamp
from forecourt.functions.keys import hash_key, month_start
from forecourt.functions.measures import (
    count_where,
    is_active,
    or_unknown,
    or_zero,
    per_entity,
    ratio_pct,
)
from forecourt.operators.aggregates import mean_decimal, sum_money
from forecourt.operators.joins import lookup, stack
from forecourt.plans.intermediate import PLAIN_STAGES, StageMap, stage_counts
from forecourt.schemas import conform

Stamp = Column | str | None

SALES_KEYS = ["month_start", "market", "sales_rep", "product_group"]
PRODUCT_KEYS = ["month_start", "market", "product_id"]


def _sales_keys(day: str, group: str) -> list[Column]:
    return [
        month_start(F.col(day)).alias("month_start"),
        or_unknown(F.col("market")).alias("market"),
        or_unknown(F.col("sales_rep")).alias("sales_rep"),
        or_unknown(F.col(group)).alias("product_group"),
    ]


def revenue_rows(fact_revenue: DataFrame) -> DataFrame:
    return fact_revenue.filter(F.col("invoice_date").isNotNull()).select(
        *_sales_keys("invoice_date", "product_family"),
        F.lit("revenue").alias("kind"),
        F.col("invoice_amount").alias("amount"),
        F.col("dealer_id").alias("revenue_dealer"),
    )


def target_rows(fact_sales_target: DataFrame) -> DataFrame:
    return fact_sales_target.filter(F.col("target_month").isNotNull()).select(
        *_sales_keys("target_month", "product_group"),
        F.lit("target").alias("kind"),
        "revenue_target_eur",
        "upsell_target_eur",
        F.col("new_dealer_target").cast("bigint").alias("new_dealer_target"),
        "retention_target_pct",
    )


def started_active_rows(fact_subscription: DataFrame) -> DataFrame:
    """Active subscriptions, by the month they started in."""
    started = F.col("subscription_start_date").isNotNull()
    return fact_subscription.filter(started & is_active(F.col("subscription_status"))).select(
        *_sales_keys("subscription_start_date", "product_family"),
        F.lit("subscription").alias("kind"),
    )


def mart_sales_performance_monthly(
    fact_revenue: DataFrame,
    fact_sales_target: DataFrame,
    fact_subscription: DataFrame,
    at: Stamp = None,
    first_round: int | None = None,
) -> DataFrame:
    """Revenue against target per month, market, sales rep and product group."""
    stacked = stack(
        [
            revenue_rows(fact_revenue),
            target_rows(fact_sales_target),
            started_active_rows(fact_subscription),
        ]
    )
    kind = F.col("kind")
    grouped = stacked.groupBy(*SALES_KEYS).agg(
        or_zero(sum_money(F.col("amount")), "decimal(18,2)").alias("revenue_eur"),
        or_zero(sum_money(F.col("revenue_target_eur")), "decimal(18,2)").alias(
            "revenue_target_eur"
        ),
        or_zero(sum_money(F.col("upsell_target_eur")), "decimal(18,2)").alias(
            "upsell_target_eur"
        ),
        or_zero(F.sum("new_dealer_target")).alias("new_dealer_target"),
        or_zero(
            mean_decimal(F.col("retention_target_pct"), "decimal(7,4)"), "decimal(7,4)"
        ).alias("retention_target_pct"),
        count_where(kind == "revenue").alias("invoice_count"),
        F.countDistinct("revenue_dealer").alias("revenue_dealer_count"),
        count_where(kind == "subscription").alias("active_subscriptions"),
    )
    rows = grouped.select(
        "*",
        hash_key(*SALES_KEYS).alias("performance_key"),
        ratio_pct(
            F.col("revenue_eur"), F.col("revenue_target_eur"), first_round=first_round
        ).alias("attainment_pct"),
        run_stamp(at).alias("refreshed_at"),
    )
    return conform(rows, "mart_sales_performance_monthly")


def mart_product_performance_monthly(
    fact_revenue: DataFrame,
    fact_subscription: DataFrame,
    price_book: DataFrame,
    dim_product: DataFrame,
    at: Stamp = None,
    keep_null_months: bool = False,
) -> DataFrame:
    """Revenue, subscriptions and list prices per month, market and product."""

    def keys(day: str) -> list[Column]:
        return [
            month_start(F.col(day)).alias("month_start"),
            or_unknown(F.col("market")).alias("market"),
            F.col("product_id"),
        ]

    def rows_of(fact: DataFrame, day: str, *columns: Column | str) -> DataFrame:
        rows = fact.filter(F.col("product_id").isNotNull()).select(*keys(day), *columns)
        return rows if keep_null_months else rows.filter(F.col("month_start").isNotNull())

    amount, dealer = F.col("invoice_amount"), F.col("dealer_id").alias("revenue_dealer")
    # Only revenue counts dealers, so only its rows are moved by dealer, before the others join.
    by_dealer = (
        rows_of(fact_revenue, "invoice_date", amount, dealer)
        .groupBy(*PRODUCT_KEYS, "revenue_dealer")
        .agg(F.sum("invoice_amount").alias("amount"), F.count(F.lit(1)).alias("invoices"))
    )
    stacked = stack(
        [
            by_dealer,
            rows_of(
                fact_subscription,
                "subscription_start_date",
                is_active(F.col("subscription_status")).alias("active"),
                "contract_price",
                "discount_pct",
            ),
            rows_of(price_book, "effective_from", "list_price"),
        ]
    )
    grouped = stacked.groupBy(*PRODUCT_KEYS).agg(
        or_zero(sum_money(F.col("amount")), "decimal(18,2)").alias("revenue_eur"),
        or_zero(F.sum("invoices")).alias("invoice_count"),
        F.count("revenue_dealer").alias("dealer_count"),
        count_where(F.col("active")).alias("active_subscriptions"),
        mean_decimal(F.col("contract_price"), "decimal(14,2)", 2).alias("avg_contract_price"),
        mean_decimal(F.col("discount_pct"), "decimal(12,4)").alias("avg_discount_pct"),
        mean_decimal(F.col("list_price"), "decimal(14,2)", 2).alias("avg_list_price"),
    )
    rows = lookup(
        grouped,
        dim_product,
        on={"product_id": "product_id"},
        take={"product_name": "product_name", "product_family": "product_family"},
    ).select(
        "*",
        hash_key(*PRODUCT_KEYS).alias("product_month_key"),
        per_entity(F.col("revenue_eur"), F.col("dealer_count")).alias("revenue_per_dealer"),
        run_stamp(at).alias("refreshed_at"),
    )
    return conform(rows, "mart_product_performance_monthly")


def mart_dealer_360(
    dim_dealer: DataFrame,
    fact_revenue: DataFrame,
    fact_subscription: DataFrame,
    fact_listing_performance: DataFrame,
    at: Stamp = None,
    first_round: int | None = None,
) -> DataFrame:
    """Each dealer with lifetime revenue, subscriptions and listing engagement."""
    invoice, listing = F.lit("invoice"), F.lit("listing")
    stacked = [
        fact_revenue.select(
            "dealer_id", invoice.alias("kind"), "invoice_amount", "invoice_date"
        ),
        fact_subscription.select("dealer_id", "subscription_status", "product_id", "discount_pct"),
        fact_listing_performance.select(
            "dealer_id", listing.alias("kind"), "listing_status", "views", "clicks", "leads",
            "last_event_at",
        ),
    ]
    # A measure is NULL in the rows of the other facts, which all its aggregates pass over.
    measures = (
        stack(stacked)
        .filter(F.col("dealer_id").isNotNull())
        .groupBy("dealer_id")
        .agg(
            sum_money(F.col("invoice_amount")).alias("lifetime_revenue_eur"),
            count_where(F.col("kind") == invoice).alias("invoice_count"),
            F.max("invoice_date").alias("last_invoice_date"),
            count_where(is_active(F.col("subscription_status"))).alias("active_subscriptions"),
            F.countDistinct("product_id").alias("product_count"),
            mean_decimal(F.col("discount_pct"), "decimal(12,4)").alias("avg_discount_pct"),
            count_where(F.col("kind") == listing).alias("total_listings"),
            count_where(is_active(F.col("listing_status"))).alias("active_listings"),
            *[F.sum(c).alias(c) for c in ("views", "clicks", "leads")],
            F.max("last_event_at").alias("last_engagement_at"),
        )
    )
    rows = dim_dealer.join(measures, "dealer_id", "left")
    zero = {
        "lifetime_revenue_eur": "decimal(18,2)",
        "avg_discount_pct": "decimal(12,4)",
        "invoice_count": "bigint",
        "active_subscriptions": "bigint",
        "product_count": "bigint",
        "total_listings": "bigint",
        "active_listings": "bigint",
        "views": "bigint",
        "clicks": "bigint",
        "leads": "bigint",
    }
    rows = rows.withColumns({c: or_zero(F.col(c), kind) for c, kind in zero.items()})
    rows = rows.select(
        "*",
        ratio_pct(F.col("leads"), F.col("views"), first_round=first_round).alias("lead_rate_pct"),
        run_stamp(at).alias("refreshed_at"),
    )
    return conform(rows, "mart_dealer_360")


def funnel_events(events: DataFrame, accounts: DataFrame) -> DataFrame:
    """What the funnel counts of each event, with the market of its dealer."""
    rows = lookup(
        events.select("event_date", "event_type", "session_id", "listing_id", "dealer_id"),
        accounts,
        on={"dealer_id": "dealer_id"},
        take={"market": "market"},
    )
    return rows.withColumn("market", or_unknown(F.col("market")))


def funnel_rates(grouped: DataFrame, at: Stamp = None, first_round: int | None = None) -> DataFrame:
    """Counts per month and market as rows of the funnel mart."""
    rows = grouped.select(
        "*",
        hash_key("month_start", "market").alias("funnel_key"),
        ratio_pct(F.col("clicks"), F.col("views"), first_round=first_round).alias("click_rate_pct"),
        ratio_pct(F.col("leads"), F.col("views"), first_round=first_round).alias("lead_rate_pct"),
        run_stamp(at).alias("refreshed_at"),
    )
    return conform(rows, "mart_marketplace_funnel_monthly")


def mart_marketplace_funnel_monthly(
    events: DataFrame,
    accounts: DataFrame,
    at: Stamp = None,
    stages: StageMap = PLAIN_STAGES,
    keep_null_months: bool = False,
    first_round: int | None = None,
) -> DataFrame:
    """Views, clicks and leads per month and market, with what they touched."""
    rows = events if keep_null_months else events.filter(F.col("event_date").isNotNull())
    grouped = (
        funnel_events(rows, accounts)
        .groupBy(month_start(F.col("event_date")).alias("month_start"), "market")
        .agg(
            *stage_counts(stages),
            F.countDistinct("session_id").alias("unique_sessions"),
            F.countDistinct("listing_id").alias("listings_with_activity"),
            F.countDistinct("dealer_id").alias("dealers_with_activity"),
        )
    )
    return funnel_rates(grouped, at, first_round)
