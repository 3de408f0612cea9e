"""Table shapes, as DDL text, for the raw, staging and later layers.

Fixed values: names, types and order are the data contract of the marketplace.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

RUN_PARTITIONS = "extract_date string, run_id string"

RAW_LISTINGS = (
    "listing_id string, vehicle_id string, dealer_id string, listing_start_date string, "
    "listing_end_date string, asking_price_eur double, listing_status string, "
    "visibility_package string, created_at string, updated_at string"
)
RAW_VEHICLES = (
    "vehicle_id string, make string, model string, model_year int, fuel_type string, "
    "body_type string, mileage_km int, created_at string, updated_at string"
)
RAW_EVENTS = (
    "event_id string, event_timestamp string, listing_id string, dealer_id string, "
    "session_id string, event_type string, device string"
)
RAW_TARGETS = (
    "target_id string, target_month string, market string, sales_rep string, "
    "product_group string, revenue_target_eur string, upsell_target_eur string, "
    "new_dealer_target string, retention_target_pct string, planning_version string, "
    "created_at string"
)
RAW_ENVELOPE = "raw_json string"

TARGET_COLUMNS = tuple(part.split()[0] for part in RAW_TARGETS.split(", "))

RUN_LINEAGE = (
    "source_extract_date date, source_run_id string, source_file string, staged_at timestamp_ntz"
)

TABLES = {
    "stg_marketplace_listings": (
        "listing_id string, vehicle_id string, dealer_id string, listing_start_date date, "
        "listing_end_date date, asking_price_eur decimal(12,2), listing_status string, "
        "visibility_package string, created_at timestamp_ntz, updated_at timestamp_ntz, "
        + RUN_LINEAGE
    ),
    "stg_marketplace_vehicles": (
        "vehicle_id string, make string, model string, model_year int, fuel_type string, "
        "body_type string, mileage_km int, created_at timestamp_ntz, "
        "updated_at timestamp_ntz, " + RUN_LINEAGE
    ),
    "stg_commercial_accounts": (
        "dealer_id string, dealer_name string, market string, segment string, "
        "sales_rep string, account_status string, created_date date, updated_at date, "
        + RUN_LINEAGE
    ),
    "stg_commercial_contracts": (
        "contract_id string, dealer_id string, contract_start_date date, "
        "contract_end_date date, contract_status string, auto_renew boolean, "
        "updated_at date, " + RUN_LINEAGE
    ),
    "stg_commercial_subscriptions": (
        "subscription_id string, contract_id string, dealer_id string, product_id string, "
        "subscription_start_date date, subscription_end_date date, "
        "contract_price decimal(12,2), discount_pct decimal(7,4), billing_frequency string, "
        "subscription_status string, updated_at date, " + RUN_LINEAGE
    ),
    "stg_commercial_invoices": (
        "invoice_id string, subscription_id string, dealer_id string, invoice_date date, "
        "invoice_amount decimal(14,2), currency string, payment_status string, "
        "updated_at date, " + RUN_LINEAGE
    ),
    "stg_pricing_products": (
        "product_id string, product_name string, product_family string, "
        "billing_frequency string, active boolean, updated_at date, " + RUN_LINEAGE
    ),
    "stg_pricing_prices": (
        "price_id string, product_id string, market string, dealer_segment string, "
        "currency string, list_price decimal(12,2), effective_from date, "
        "effective_to date, pricing_version string, updated_at date, " + RUN_LINEAGE
    ),
    "stg_engagement_events": (
        "event_id string, event_timestamp timestamp_ntz, event_date date, "
        "listing_id string, dealer_id string, session_id string, event_type string, "
        "device string, source_file string, staged_at timestamp_ntz"
    ),
    "stg_sales_targets": (
        "target_id string, target_month date, market string, sales_rep string, "
        "product_group string, revenue_target_eur decimal(14,2), "
        "upsell_target_eur decimal(14,2), new_dealer_target int, "
        "retention_target_pct decimal(7,4), planning_version string, "
        "created_at timestamp_ntz, source_sha256 string, source_file string, "
        "staged_at timestamp_ntz"
    ),
    "int_dealer_subscription_snapshot": (
        "subscription_id string, contract_id string, dealer_id string, dealer_name string, "
        "market string, segment string, sales_rep string, account_status string, "
        "product_id string, product_name string, product_family string, "
        "billing_frequency string, subscription_start_date date, "
        "subscription_end_date date, contract_start_date date, contract_end_date date, "
        "contract_price decimal(12,2), discount_pct decimal(7,4), "
        "subscription_status string, contract_status string, auto_renew boolean, "
        "account_updated_at date, subscription_updated_at date, contract_updated_at date, "
        "product_updated_at date, transformed_at timestamp_ntz"
    ),
    "int_invoice_enriched": (
        "invoice_id string, invoice_date date, invoice_amount decimal(14,2), "
        "currency string, payment_status string, subscription_id string, "
        "contract_id string, dealer_id string, dealer_name string, market string, "
        "segment string, sales_rep string, product_id string, product_name string, "
        "product_family string, billing_frequency string, contract_price decimal(12,2), "
        "discount_pct decimal(7,4), subscription_status string, contract_status string, "
        "transformed_at timestamp_ntz"
    ),
    "int_listing_engagement": (
        "listing_id string, vehicle_id string, dealer_id string, listing_start_date date, "
        "listing_end_date date, asking_price_eur decimal(12,2), listing_status string, "
        "visibility_package string, make string, model string, model_year int, "
        "fuel_type string, body_type string, mileage_km int, "
        "first_event_at timestamp_ntz, last_event_at timestamp_ntz, views bigint, "
        "clicks bigint, leads bigint, engagement_events bigint, unique_sessions bigint, "
        "transformed_at timestamp_ntz"
    ),
    "int_price_book": (
        "price_id string, product_id string, product_name string, product_family string, "
        "market string, dealer_segment string, currency string, list_price decimal(12,2), "
        "effective_from date, effective_to date, pricing_version string, "
        "product_active boolean, transformed_at timestamp_ntz"
    ),
    "int_sales_targets": (
        "target_id string, target_month date, market string, sales_rep string, "
        "product_group string, revenue_target_eur decimal(14,2), "
        "upsell_target_eur decimal(14,2), new_dealer_target int, "
        "retention_target_pct decimal(7,4), planning_version string, "
        "created_at timestamp_ntz, transformed_at timestamp_ntz"
    ),
    "dim_dealer": (
        "dealer_key string, dealer_id string, dealer_name string, market string, "
        "segment string, sales_rep string, account_status string, created_date date, "
        "updated_at date, loaded_at timestamp_ntz"
    ),
    "dim_product": (
        "product_key string, product_id string, product_name string, "
        "product_family string, billing_frequency string, active boolean, "
        "updated_at date, loaded_at timestamp_ntz"
    ),
    "dim_vehicle": (
        "vehicle_key string, vehicle_id string, make string, model string, "
        "model_year int, fuel_type string, body_type string, mileage_km int, "
        "created_at timestamp_ntz, updated_at timestamp_ntz, loaded_at timestamp_ntz"
    ),
    "dim_date": (
        "date_key int, calendar_date date, year_number int, quarter_number int, "
        "month_number int, month_name string, year_month string, week_of_year int, "
        "day_of_month int, day_of_week int, day_name string, is_weekend boolean, "
        "loaded_at timestamp_ntz"
    ),
    "fact_revenue": (
        "invoice_id string, invoice_date date, date_key int, dealer_key string, "
        "product_key string, dealer_id string, product_id string, subscription_id string, "
        "contract_id string, market string, segment string, sales_rep string, "
        "product_family string, invoice_amount decimal(14,2), currency string, "
        "payment_status string, contract_price decimal(12,2), discount_pct decimal(7,4), "
        "loaded_at timestamp_ntz"
    ),
    "fact_subscription": (
        "subscription_id string, dealer_key string, product_key string, dealer_id string, "
        "product_id string, contract_id string, market string, segment string, "
        "sales_rep string, product_family string, contract_price decimal(12,2), "
        "discount_pct decimal(7,4), billing_frequency string, subscription_status string, "
        "contract_status string, auto_renew boolean, subscription_start_date date, "
        "subscription_end_date date, start_date_key int, end_date_key int, "
        "loaded_at timestamp_ntz"
    ),
    "fact_listing_performance": (
        "listing_id string, dealer_key string, vehicle_key string, dealer_id string, "
        "vehicle_id string, listing_start_date date, listing_end_date date, "
        "start_date_key int, end_date_key int, asking_price_eur decimal(12,2), "
        "listing_status string, visibility_package string, views bigint, clicks bigint, "
        "leads bigint, engagement_events bigint, unique_sessions bigint, "
        "first_event_at timestamp_ntz, last_event_at timestamp_ntz, loaded_at timestamp_ntz"
    ),
    "fact_sales_target": (
        "target_id string, target_month date, date_key int, market string, "
        "sales_rep string, product_group string, revenue_target_eur decimal(14,2), "
        "upsell_target_eur decimal(14,2), new_dealer_target int, "
        "retention_target_pct decimal(7,4), planning_version string, loaded_at timestamp_ntz"
    ),
    "mart_sales_performance_monthly": (
        "performance_key string, month_start date, market string, sales_rep string, "
        "product_group string, revenue_eur decimal(18,2), "
        "revenue_target_eur decimal(18,2), upsell_target_eur decimal(18,2), "
        "new_dealer_target bigint, retention_target_pct decimal(7,4), "
        "attainment_pct decimal(12,4), invoice_count bigint, revenue_dealer_count bigint, "
        "active_subscriptions bigint, refreshed_at timestamp_ntz"
    ),
    "mart_dealer_360": (
        "dealer_id string, dealer_key string, dealer_name string, market string, "
        "segment string, sales_rep string, account_status string, "
        "lifetime_revenue_eur decimal(18,2), invoice_count bigint, "
        "active_subscriptions bigint, product_count bigint, "
        "avg_discount_pct decimal(12,4), total_listings bigint, active_listings bigint, "
        "views bigint, clicks bigint, leads bigint, lead_rate_pct decimal(12,4), "
        "last_invoice_date date, last_engagement_at timestamp_ntz, "
        "refreshed_at timestamp_ntz"
    ),
    "mart_product_performance_monthly": (
        "product_month_key string, month_start date, market string, product_id string, "
        "product_name string, product_family string, revenue_eur decimal(18,2), "
        "invoice_count bigint, dealer_count bigint, active_subscriptions bigint, "
        "avg_contract_price decimal(14,2), avg_discount_pct decimal(12,4), "
        "avg_list_price decimal(14,2), revenue_per_dealer decimal(18,2), "
        "refreshed_at timestamp_ntz"
    ),
    "mart_marketplace_funnel_monthly": (
        "funnel_key string, month_start date, market string, views bigint, clicks bigint, "
        "leads bigint, unique_sessions bigint, listings_with_activity bigint, "
        "dealers_with_activity bigint, click_rate_pct decimal(12,4), "
        "lead_rate_pct decimal(12,4), refreshed_at timestamp_ntz"
    ),
}

# Business key of every table.
KEYS = {
    "stg_marketplace_vehicles": "vehicle_id",
    "stg_marketplace_listings": "listing_id",
    "stg_commercial_accounts": "dealer_id",
    "stg_commercial_contracts": "contract_id",
    "stg_commercial_subscriptions": "subscription_id",
    "stg_commercial_invoices": "invoice_id",
    "stg_pricing_products": "product_id",
    "stg_pricing_prices": "price_id",
    "stg_engagement_events": "event_id",
    "stg_sales_targets": "target_id",
    "int_dealer_subscription_snapshot": "subscription_id",
    "int_invoice_enriched": "invoice_id",
    "int_listing_engagement": "listing_id",
    "int_price_book": "price_id",
    "int_sales_targets": "target_id",
    "dim_dealer": "dealer_id",
    "dim_product": "product_id",
    "dim_vehicle": "vehicle_id",
    "dim_date": "date_key",
    "fact_revenue": "invoice_id",
    "fact_subscription": "subscription_id",
    "fact_listing_performance": "listing_id",
    "fact_sales_target": "target_id",
    "mart_sales_performance_monthly": "performance_key",
    "mart_dealer_360": "dealer_id",
    "mart_product_performance_monthly": "product_month_key",
    "mart_marketplace_funnel_monthly": "funnel_key",
}

AUDIT_COLUMNS = ("staged_at", "transformed_at", "loaded_at", "refreshed_at")


def column_types(table: str) -> dict[str, str]:
    """Column name to type text, in table order."""
    return dict(part.split(" ", 1) for part in TABLES[table].split(", "))


def schema_of(table: str) -> StructType:
    """Needs a running session, since Spark parses the text."""
    return StructType.fromDDL(TABLES[table])


def conform(df: DataFrame, table: str) -> DataFrame:
    """Select the table's columns, in order and type."""
    return df.select(
        *[F.col(name).cast(kind).alias(name) for name, kind in column_types(table).items()]
    )
