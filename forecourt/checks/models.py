"""Checked queries: the intermediate, dimension, fact and mart tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from forecourt.checks.compare import plain
from forecourt.checks.duck import SQL_VIEWS, half_up, table_output
from forecourt.checks.frames import LensModels

TABLES = (
    "int_dealer_subscription_snapshot",
    "int_invoice_enriched",
    "int_listing_engagement",
    "int_price_book",
    "int_sales_targets",
    "dim_dealer",
    "dim_product",
    "dim_vehicle",
    "fact_revenue",
    "fact_subscription",
    "fact_listing_performance",
    "fact_sales_target",
    "mart_sales_performance_monthly",
    "mart_dealer_360",
    "mart_product_performance_monthly",
    "mart_marketplace_funnel_monthly",
)


def _stage_sums(*stages: str) -> str:
    names = {"view": "views", "click": "clicks", "lead": "leads"}
    return ", ".join(
        f"count(*) FILTER (lower(event_type) = '{s}') AS {names[s]}" for s in stages
    )


_STAGES = _stage_sums("view", "click", "lead")
_SALES_KEYS = "month_start, market, sales_rep, product_group"
_MONTH = "make_date(year({0}), month({0}), 1)"


def _cents(column: str, scale: int = 2) -> str:
    return f"sum(CAST({column} * {10**scale} AS HUGEINT))"


SQL_VIEWS.update(
    {
        "int_dealer_subscription_snapshot": (
            ["subscriptions", "contracts", "accounts", "products"],
            """SELECT sub.* EXCLUDE (updated_at), sub.updated_at AS subscription_updated_at,
                   con.contract_start_date, con.contract_end_date, con.contract_status,
                   con.auto_renew, con.updated_at AS contract_updated_at,
                   acc.dealer_name, acc.market, acc.segment, acc.sales_rep,
                   acc.account_status, acc.updated_at AS account_updated_at,
                   pro.product_name, pro.product_family, pro.updated_at AS product_updated_at
            FROM subscriptions sub
            LEFT JOIN contracts con USING (contract_id)
            LEFT JOIN accounts acc ON acc.dealer_id = sub.dealer_id
            LEFT JOIN products pro ON pro.product_id = sub.product_id""",
        ),
        "int_invoice_enriched": (
            ["invoices", "subscriptions", "contracts", "accounts", "products"],
            """SELECT inv.* EXCLUDE (updated_at), sub.contract_id, sub.product_id,
                   sub.billing_frequency, sub.contract_price, sub.discount_pct,
                   sub.subscription_status, contract_status, acc.dealer_name, acc.market,
                   acc.segment, acc.sales_rep, pro.product_name, pro.product_family
            FROM invoices inv
            LEFT JOIN subscriptions sub USING (subscription_id)
            LEFT JOIN contracts con ON con.contract_id = sub.contract_id
            LEFT JOIN accounts acc ON acc.dealer_id = inv.dealer_id
            LEFT JOIN products pro ON pro.product_id = sub.product_id""",
        ),
        "listing_counts": (
            ["events_view"],
            f"""SELECT listing_id, min(event_timestamp) AS first_event_at,
                   max(event_timestamp) AS last_event_at, {_STAGES},
                   count(*) AS engagement_events,
                   count(DISTINCT session_id) AS unique_sessions
            FROM events_view WHERE listing_id IS NOT NULL GROUP BY ALL""",
        ),
        "int_listing_engagement": (
            ["listings", "vehicles", "listing_counts"],
            """SELECT lis.* EXCLUDE (created_at, updated_at),
                   make, model, model_year, fuel_type, body_type, mileage_km,
                   first_event_at, last_event_at, ifnull(views, 0) AS views,
                   ifnull(clicks, 0) AS clicks, ifnull(leads, 0) AS leads,
                   ifnull(engagement_events, 0) AS engagement_events,
                   ifnull(unique_sessions, 0) AS unique_sessions
            FROM listings lis
            LEFT JOIN vehicles USING (vehicle_id)
            LEFT JOIN listing_counts USING (listing_id)""",
        ),
        "int_price_book": (
            ["prices", "products"],
            """SELECT prices.*, product_name, product_family, active AS product_active
            FROM prices LEFT JOIN products USING (product_id)""",
        ),
        "int_sales_targets": (["targets"], "SELECT * FROM targets"),
        "dim_dealer": (
            ["accounts"],
            "SELECT upper(md5(dealer_id)) AS dealer_key, * FROM accounts",
        ),
        "dim_product": (
            ["products"],
            "SELECT upper(md5(product_id)) AS product_key, * FROM products",
        ),
        "dim_vehicle": (
            ["vehicles"],
            "SELECT upper(md5(vehicle_id)) AS vehicle_key, * FROM vehicles",
        ),
        "calendar_days": (
            [],
            """SELECT CAST(d AS DATE) AS calendar_date,
                   CAST(strftime(d, '%Y%m%d') AS INT) AS date_key
            FROM generate_series(TIMESTAMP '1995-01-01', TIMESTAMP '2024-12-31',
                                 INTERVAL 1 DAY) AS days(d)""",
        ),
        "fact_revenue": (
            ["int_invoice_enriched", "calendar_days", "dim_dealer", "dim_product"],
            """SELECT inv.*, date_key, dealer_key, product_key
            FROM int_invoice_enriched inv
            LEFT JOIN calendar_days ON calendar_date = invoice_date
            LEFT JOIN dim_dealer dea ON dea.dealer_id = inv.dealer_id
            LEFT JOIN dim_product pro ON pro.product_id = inv.product_id""",
        ),
        "fact_subscription": (
            ["int_dealer_subscription_snapshot", "calendar_days", "dim_dealer", "dim_product"],
            """SELECT sub.*, first_day.date_key AS start_date_key,
                   last_day.date_key AS end_date_key, dealer_key, product_key
            FROM int_dealer_subscription_snapshot sub
            LEFT JOIN calendar_days first_day
                   ON first_day.calendar_date = subscription_start_date
            LEFT JOIN calendar_days last_day
                   ON last_day.calendar_date = subscription_end_date
            LEFT JOIN dim_dealer dea ON dea.dealer_id = sub.dealer_id
            LEFT JOIN dim_product pro ON pro.product_id = sub.product_id""",
        ),
        "fact_listing_performance": (
            ["int_listing_engagement", "calendar_days", "dim_dealer", "dim_vehicle"],
            """SELECT lis.*, first_day.date_key AS start_date_key,
                   last_day.date_key AS end_date_key, dealer_key, vehicle_key
            FROM int_listing_engagement lis
            LEFT JOIN calendar_days first_day ON first_day.calendar_date = listing_start_date
            LEFT JOIN calendar_days last_day ON last_day.calendar_date = listing_end_date
            LEFT JOIN dim_dealer dea ON dea.dealer_id = lis.dealer_id
            LEFT JOIN dim_vehicle veh ON veh.vehicle_id = lis.vehicle_id""",
        ),
        "fact_sales_target": (
            ["int_sales_targets", "calendar_days"],
            """SELECT tar.*, date_key FROM int_sales_targets tar
            LEFT JOIN calendar_days ON calendar_date = target_month""",
        ),
        "sales_revenue": (
            ["fact_revenue"],
            f"""SELECT {_MONTH.format("invoice_date")} AS month_start,
                   ifnull(market, 'UNKNOWN') AS market,
                   ifnull(sales_rep, 'UNKNOWN') AS sales_rep,
                   ifnull(product_family, 'UNKNOWN') AS product_group,
                   {_cents("invoice_amount")} AS cents, count(*) AS invoice_count,
                   count(DISTINCT dealer_id) AS revenue_dealer_count
            FROM fact_revenue WHERE invoice_date IS NOT NULL GROUP BY ALL""",
        ),
        "sales_targets": (
            ["fact_sales_target"],
            f"""SELECT {_MONTH.format("target_month")} AS month_start,
                   ifnull(market, 'UNKNOWN') AS market,
                   ifnull(sales_rep, 'UNKNOWN') AS sales_rep,
                   ifnull(product_group, 'UNKNOWN') AS product_group,
                   {_cents("revenue_target_eur")} AS target_cents,
                   {_cents("upsell_target_eur")} AS upsell_cents,
                   CAST(sum(new_dealer_target) AS BIGINT) AS new_dealer_target,
                   {half_up(_cents("retention_target_pct", 4), "10000 * count(retention_target_pct)", 4)}
                       AS retention_target_pct
            FROM fact_sales_target WHERE target_month IS NOT NULL GROUP BY ALL""",
        ),
        "sales_subscriptions": (
            ["fact_subscription"],
            f"""SELECT {_MONTH.format("subscription_start_date")} AS month_start,
                   ifnull(market, 'UNKNOWN') AS market,
                   ifnull(sales_rep, 'UNKNOWN') AS sales_rep,
                   ifnull(product_family, 'UNKNOWN') AS product_group,
                   count(*) AS active_subscriptions
            FROM fact_subscription
            WHERE subscription_start_date IS NOT NULL AND subscription_status ILIKE 'active'
            GROUP BY ALL""",
        ),
        "mart_sales_performance_monthly": (
            ["sales_revenue", "sales_targets", "sales_subscriptions"],
            f"""SELECT upper(md5(CAST(month_start AS VARCHAR) || '|' || market || '|'
                         || sales_rep || '|' || product_group)) AS performance_key,
                   {_SALES_KEYS},
                   ifnull(cents, 0) / 100 AS revenue_eur,
                   ifnull(target_cents, 0) / 100 AS revenue_target_eur,
                   ifnull(upsell_cents, 0) / 100 AS upsell_target_eur,
                   ifnull(new_dealer_target, 0) AS new_dealer_target,
                   ifnull(retention_target_pct, 0) AS retention_target_pct,
                   {half_up("100 * ifnull(cents, 0)", "ifnull(target_cents, 0)", 4)}
                       AS attainment_pct,
                   ifnull(invoice_count, 0) AS invoice_count,
                   ifnull(revenue_dealer_count, 0) AS revenue_dealer_count,
                   ifnull(active_subscriptions, 0) AS active_subscriptions
            FROM sales_revenue
            FULL JOIN sales_targets USING ({_SALES_KEYS})
            FULL JOIN sales_subscriptions USING ({_SALES_KEYS})""",
        ),
        "mart_dealer_360": (
            ["dim_dealer", "fact_revenue", "fact_subscription", "fact_listing_performance"],
            f"""SELECT dea.*,
                   ifnull(cents, 0) / 100 AS lifetime_revenue_eur,
                   ifnull(invoice_count, 0) AS invoice_count,
                   ifnull(active_subscriptions, 0) AS active_subscriptions,
                   ifnull(product_count, 0) AS product_count,
                   ifnull(avg_discount_pct, 0) AS avg_discount_pct,
                   ifnull(total_listings, 0) AS total_listings,
                   ifnull(active_listings, 0) AS active_listings,
                   CAST(ifnull(views, 0) AS BIGINT) AS views,
                   CAST(ifnull(clicks, 0) AS BIGINT) AS clicks,
                   CAST(ifnull(leads, 0) AS BIGINT) AS leads,
                   {half_up("100 * ifnull(leads, 0)", "ifnull(views, 0)", 4)} AS lead_rate_pct,
                   last_invoice_date, last_engagement_at
            FROM dim_dealer dea
            LEFT JOIN (SELECT dealer_id, {_cents("invoice_amount")} AS cents,
                              count(*) AS invoice_count,
                              max(invoice_date) AS last_invoice_date
                       FROM fact_revenue GROUP BY ALL) USING (dealer_id)
            LEFT JOIN (SELECT dealer_id,
                              count(*) FILTER (subscription_status ILIKE 'active')
                                  AS active_subscriptions,
                              count(DISTINCT product_id) AS product_count,
                              {half_up(_cents("discount_pct", 4), "10000 * count(discount_pct)", 4)}
                                  AS avg_discount_pct
                       FROM fact_subscription GROUP BY ALL) USING (dealer_id)
            LEFT JOIN (SELECT dealer_id, count(*) AS total_listings,
                              count(*) FILTER (listing_status ILIKE 'active')
                                  AS active_listings,
                              sum(views) AS views, sum(clicks) AS clicks,
                              sum(leads) AS leads, max(last_event_at) AS last_engagement_at
                       FROM fact_listing_performance GROUP BY ALL) USING (dealer_id)""",
        ),
        "product_measures": (
            ["fact_revenue", "fact_subscription", "int_price_book"],
            f"""SELECT {_MONTH.format("invoice_date")} AS month_start,
                   ifnull(market, 'UNKNOWN') AS market, product_id, 'revenue' AS kind,
                   invoice_amount, dealer_id, NULL AS status, NULL AS price,
                   NULL AS discount, NULL AS list_price
            FROM fact_revenue
            UNION ALL
            SELECT {_MONTH.format("subscription_start_date")},
                   ifnull(market, 'UNKNOWN'), product_id, 'subscription', NULL, NULL,
                   subscription_status, contract_price, discount_pct, NULL
            FROM fact_subscription
            UNION ALL
            SELECT {_MONTH.format("effective_from")}, ifnull(market, 'UNKNOWN'), product_id,
                   'price', NULL, NULL, NULL, NULL, NULL, list_price
            FROM int_price_book""",
        ),
        "mart_product_performance_monthly": (
            ["product_measures", "dim_product"],
            f"""SELECT upper(md5(CAST(month_start AS VARCHAR) || '|' || market || '|'
                         || mea.product_id)) AS product_month_key,
                   month_start, market, mea.product_id,
                   any_value(product_name) AS product_name,
                   any_value(product_family) AS product_family,
                   ifnull({_cents("invoice_amount")}, 0) / 100 AS revenue_eur,
                   count(*) FILTER (kind = 'revenue') AS invoice_count,
                   count(DISTINCT dealer_id) AS dealer_count,
                   count(*) FILTER (status ILIKE 'active') AS active_subscriptions,
                   {half_up(_cents("price"), "100 * count(price)", 2)} AS avg_contract_price,
                   {half_up(_cents("discount", 4), "10000 * count(discount)", 4)}
                       AS avg_discount_pct,
                   {half_up(_cents("list_price"), "100 * count(list_price)", 2)}
                       AS avg_list_price,
                   {half_up(_cents("invoice_amount"), "100 * count(DISTINCT dealer_id)", 2)}
                       AS revenue_per_dealer
            FROM product_measures mea
            LEFT JOIN dim_product pro ON pro.product_id = mea.product_id
            WHERE mea.product_id IS NOT NULL AND month_start IS NOT NULL
            GROUP BY month_start, market, mea.product_id""",
        ),
        "mart_marketplace_funnel_monthly": (
            ["events_view", "accounts"],
            f"""SELECT upper(md5(CAST(month_start AS VARCHAR) || '|' || market))
                       AS funnel_key, *,
                   {half_up("100 * clicks", "views", 4)} AS click_rate_pct,
                   {half_up("100 * leads", "views", 4)} AS lead_rate_pct
            FROM (SELECT {_MONTH.format("event_date")} AS month_start,
                         ifnull(accounts.market, 'UNKNOWN') AS market, {_STAGES},
                         count(DISTINCT session_id) AS unique_sessions,
                         count(DISTINCT listing_id) AS listings_with_activity,
                         count(DISTINCT events_view.dealer_id) AS dealers_with_activity
                  FROM events_view LEFT JOIN accounts USING (dealer_id)
                  WHERE event_date IS NOT NULL
                  GROUP BY ALL)""",
        ),
    }
)


def _table(name: str) -> Callable[[SparkSession, str], DataFrame]:
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        return plain(getattr(LensModels(spark, sf_dir), name))

    query.__name__ = name
    return query


QUERIES = {name: _table(name) for name in TABLES}
ORACLES = {name: table_output(name, name) for name in TABLES}
