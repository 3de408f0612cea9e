"""Checked queries: the quality gates, over clean rows and over rows with planted defects."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.checks.cases import Cases
from forecourt.checks.frames import LensModels
from forecourt.functions.workspace import cut_lineage
from forecourt.lens import STAGED_AS
from forecourt.plans import dimensions, quality
from forecourt.plans.marts import SALES_KEYS, revenue_rows
from forecourt.schemas import KEYS

cases = Cases()
case = cases.case

VIEW_OF = {table: view for view, table in STAGED_AS.items()}
LINE_ID = "l_orderkey || '-' || l_linenumber"


def staged_frames(m: LensModels) -> dict[str, DataFrame]:
    names = {
        "events_view": "events",
        "subscriptions": "staged_subscriptions",
        "invoices": "staged_invoices",
    }
    return {t: getattr(m, names.get(v, v)) for t, v in VIEW_OF.items()}


def undeduplicated(m: LensModels) -> dict[str, DataFrame]:
    """Staging frames in which subscriptions and invoices still hold every version, the
    events some unknown listings, and the listings rows without identity."""
    frames = staged_frames(m)
    frames["stg_commercial_subscriptions"] = m.all_versions("subscriptions")
    frames["stg_commercial_invoices"] = m.all_versions("invoices").withColumn(
        "dealer_id",
        F.when(F.col("currency") == "CHF", F.concat(F.lit("X"), "dealer_id")).otherwise(
            F.col("dealer_id")
        ),
    )
    unknown = F.when(F.col("device") == "TABLET", F.lit("L-unknown"))
    frames["stg_engagement_events"] = m.events.withColumn(
        "listing_id", F.coalesce(unknown, F.col("listing_id"))
    )
    identity = F.when(F.col("vehicle_id").isNotNull(), F.col("listing_id"))
    frames["stg_marketplace_listings"] = m.listings.withColumn("listing_id", identity)
    return frames


_CLEAN = ", ".join(
    f"('{n}', 0)" for n in ("null_primary_keys", "duplicate_primary_keys", *quality.FOREIGN_KEYS)
)


@case(
    "dq_staging",
    f"""SELECT check_name, CAST(ifnull(found, bad_rows) AS BIGINT) AS bad_rows
        FROM (VALUES {_CLEAN}) AS checks(check_name, bad_rows)
        LEFT JOIN (SELECT 'listing_vehicle' AS check_name, count(*) AS found FROM listings
                   WHERE vehicle_id NOT IN (SELECT vehicle_id FROM vehicles)
                   UNION ALL SELECT 'event_listing', count(*) FROM events_view
                   WHERE listing_id NOT IN (SELECT listing_id FROM listings)
                   UNION ALL SELECT 'price_product', count(*) FROM prices
                   WHERE product_id NOT IN (SELECT product_id FROM products)
                   UNION ALL SELECT 'invoice_subscription', count(*) FROM invoices
                   WHERE subscription_id NOT IN (SELECT subscription_id FROM subscriptions))
             USING (check_name)""",
    "listings", "vehicles", "events_view", "prices", "products", "invoices", "subscriptions",
)
def _(m: LensModels) -> DataFrame:
    return quality.staging_checks(staged_frames(m))


@case(
    "dq_planted",
    f"""SELECT 'null_primary_keys' AS check_name, count(*) AS bad_rows
        FROM listings WHERE vehicle_id IS NULL
        UNION ALL
        SELECT 'duplicate_primary_keys', 2 * count(*) + 1
        FROM (SELECT {LINE_ID} FROM lineitem GROUP BY ALL HAVING count(*) > 1)
        UNION ALL
        SELECT 'listing_vehicle', 0
        UNION ALL
        SELECT 'contract_account', 0 UNION ALL SELECT 'subscription_contract', 0
        UNION ALL
        SELECT 'subscription_account', 0 UNION ALL SELECT 'invoice_subscription', 0
        UNION ALL
        SELECT 'invoice_account', count(*) FROM lineitem WHERE l_suppkey % 10 = 0
        UNION ALL
        SELECT 'price_product', 0
        UNION ALL
        SELECT 'event_listing', count(*) FROM events_view
        WHERE device = 'TABLET'
           OR listing_id IN (SELECT listing_id FROM listings WHERE vehicle_id IS NULL)""",
    "listings", "events_view",
)
def _(m: LensModels) -> DataFrame:
    return quality.staging_checks(undeduplicated(m))


@case(
    "null_primary_keys",
    """SELECT 'null_primary_keys' AS check_name,
              (SELECT count(*) FROM listings WHERE vehicle_id IS NULL)
              + (SELECT count(*) FROM accounts WHERE sales_rep IS NULL) AS bad_rows""",
    "listings", "accounts",
)
def _(m: LensModels) -> DataFrame:
    parts = [
        quality.null_keys(m.listings, "vehicle_id", "listings"),
        quality.null_keys(m.accounts, "sales_rep", "accounts"),
        quality.null_keys(m.vehicles, "vehicle_id", "vehicles"),
    ]
    return quality.total("null_primary_keys", quality.stack_all(parts))


@case(
    "duplicate_primary_keys",
    f"""SELECT 'duplicate_primary_keys' AS check_name, count(*) AS bad_rows
        FROM (SELECT {LINE_ID} FROM lineitem GROUP BY ALL HAVING count(*) > 1)""",
)
def _(m: LensModels) -> DataFrame:
    return quality.duplicate_keys(
        m.all_versions("invoices"), "invoice_id", "duplicate_primary_keys"
    )


def _foreign_key(name: str) -> None:
    """Orphans of one relation when a part of the parents is missing."""
    child, key, parent = quality.FOREIGN_KEYS[name]
    child_view, parent_view = VIEW_OF[child], VIEW_OF[parent]
    parent_key = KEYS[parent]
    # Parents whose key ends in 7 are taken away.
    sql = f"""SELECT '{name}' AS check_name, count(*) AS bad_rows FROM {child_view}
              WHERE {key} IS NOT NULL AND {key} NOT IN (
                  SELECT {parent_key} FROM {parent_view} WHERE right({parent_key}, 1) <> '7')"""

    def build(m: LensModels) -> DataFrame:
        frames = staged_frames(m)
        parents = frames[parent].filter(F.substring(parent_key, -1, 1) != "7")
        return quality.orphan_rows(frames[child], key, parents, parent_key, name)

    cases.add(f"orphans_{name}", build, sql, child_view, parent_view)


for _name in quality.FOREIGN_KEYS:
    _foreign_key(_name)


def _raw_frames(m: LensModels) -> dict[str, DataFrame]:
    """Raw rows of which some lack their key."""
    rep = F.when(F.col("sales_rep") != "REP_3", F.col("target_id"))
    identity = F.when(F.col("vehicle_id").isNotNull(), F.col("listing_id"))
    return {
        "raw_marketplace_vehicles": m.vehicles.filter(F.col("mileage_km") < 0),
        "raw_marketplace_listings": m.listings.withColumn("listing_id", identity),
        "raw_engagement_events": m.events,
        "raw_sales_targets": m.targets.withColumn("target_id", rep),
    }


@case(
    "dq_raw",
    """SELECT 'raw_marketplace_vehicles_empty' AS check_name, 1 AS bad_rows
       UNION ALL SELECT 'raw_marketplace_vehicles_null_key', 0
       UNION ALL SELECT 'raw_marketplace_listings_empty', 0
       UNION ALL SELECT 'raw_marketplace_listings_null_key', count(*) FROM listings
                 WHERE vehicle_id IS NULL
       UNION ALL SELECT 'raw_engagement_events_empty', 0
       UNION ALL SELECT 'raw_engagement_events_null_key', 0
       UNION ALL SELECT 'raw_sales_targets_empty', 0
       UNION ALL SELECT 'raw_sales_targets_null_key', count(*) FROM targets
                 WHERE sales_rep = 'REP_3'""",
    "listings", "targets",
)
def _(m: LensModels) -> DataFrame:
    return quality.raw_checks(_raw_frames(m))


@case(
    "count_exact",
    """SELECT 'invoices' AS check_name,
              (SELECT count(*) FROM lineitem) - (SELECT count(*) FROM invoices) AS bad_rows
       UNION ALL SELECT 'markets', 0""",
    "invoices",
)
def _(m: LensModels) -> DataFrame:
    expected = m.table("lineitem").count()
    return quality.wrong_count(m.invoices, expected, "invoices").unionAll(
        quality.wrong_count(m.table("region"), 5, "markets")
    )


def short_calendar(m: LensModels) -> DataFrame:
    """A calendar that begins too late for the first years."""
    return m.dim_date.filter(F.col("year_number") >= 1997)


# Columns of the facts that the gates and the marts over them read.
READ_OF_FACTS = {
    "fact_revenue": [
        "invoice_id", "dealer_id", "dealer_key", "product_id", "product_key", "invoice_date",
        "date_key", "market", "sales_rep", "product_family", "invoice_amount",
    ],
    "fact_subscription": [
        "subscription_id", "dealer_id", "dealer_key", "product_id", "product_key",
        "subscription_start_date", "start_date_key", "market", "sales_rep", "product_family",
        "subscription_status", "contract_price", "discount_pct",
    ],
}


@case(
    "dq_analytics",
    """SELECT 'dimension_duplicate_keys' AS check_name, 0 AS bad_rows
       UNION ALL SELECT 'fact_duplicate_keys', 0
       UNION ALL SELECT 'fact_revenue_unresolved_keys', count(*) FROM fact_revenue
                 WHERE (dealer_key IS NULL OR product_key IS NULL OR date_key IS NULL)
       UNION ALL SELECT 'fact_subscription_unresolved_keys', count(*) FROM fact_subscription
                 WHERE (dealer_key IS NULL OR product_key IS NULL OR start_date_key IS NULL)
       UNION ALL SELECT 'fact_listing_performance_unresolved_keys', count(*)
                 FROM fact_listing_performance
                 WHERE (dealer_key IS NULL OR start_date_key IS NULL
                        OR (vehicle_id IS NOT NULL AND vehicle_key IS NULL))
       UNION ALL SELECT 'sales_mart_duplicate_keys', 0
       UNION ALL SELECT 'product_mart_duplicate_keys', 0
       UNION ALL SELECT 'funnel_mart_duplicate_keys', 0""",
    "fact_revenue", "fact_subscription", "fact_listing_performance",
)
def _(m: LensModels) -> DataFrame:
    # As in a daily run, a fact is written once; the gates and the marts read what was written.
    m.fact_revenue, m.fact_subscription = (
        cut_lineage(getattr(m, fact).select(*columns), "zstd") for fact, columns in READ_OF_FACTS.items()
    )
    names = [t for t in KEYS if t.startswith(("dim_", "fact_", "mart_"))]
    return quality.analytics_checks({t: getattr(m, t) for t in names})


@case(
    "unresolved_date_keys",
    """SELECT 'revenue' AS check_name, count(*) AS bad_rows FROM invoices
       WHERE invoice_date < DATE '1997-01-01'
       UNION ALL SELECT 'subscription', count(*) FROM subscriptions
       WHERE subscription_start_date < DATE '1997-01-01'""",
    "invoices", "subscriptions",
)
def _(m: LensModels) -> DataFrame:
    days = short_calendar(m)
    revenue, started = m.revenue_on(days), m.subscriptions_on(days)
    return quality.unresolved_keys(
        revenue, quality.FACT_KEYS["fact_revenue"], "revenue"
    ).unionAll(
        quality.unresolved_keys(started, quality.FACT_KEYS["fact_subscription"], "subscription")
    )


@case(
    "dimension_duplicate_keys",
    """SELECT 'dimension_duplicate_keys' AS check_name, count(*) AS bad_rows
       FROM accounts WHERE segment = 'MACHINERY'""",
    "accounts",
)
def _(m: LensModels) -> DataFrame:
    again = m.accounts.unionAll(m.accounts.filter(F.col("segment") == "MACHINERY"))
    parts = [
        quality.duplicate_keys(dimensions.dim_dealer(again), "dealer_id", "dim_dealer"),
        quality.duplicate_keys(m.dim_product, "product_id", "dim_product"),
        quality.duplicate_keys(m.dim_vehicle, "vehicle_id", "dim_vehicle"),
    ]
    return quality.total("dimension_duplicate_keys", quality.stack_all(parts))


@case(
    "mart_duplicate_keys",
    """SELECT 'sales_mart_duplicate_keys' AS check_name, count(*) AS bad_rows FROM (
           SELECT month(invoice_date), year(invoice_date), market, sales_rep, product_family
           FROM int_invoice_enriched GROUP BY ALL HAVING count(*) > 1)""",
    "int_invoice_enriched",
)
def _(m: LensModels) -> DataFrame:
    # Revenue rows that were not grouped yet.
    rows = revenue_rows(m.int_invoice_enriched)
    repeated = rows.groupBy(*SALES_KEYS).count().filter("count > 1")
    return quality.check("sales_mart_duplicate_keys", repeated, F.count(F.lit(1)))


@case(
    "other_currency",
    """SELECT 'revenue_other_currency' AS check_name, count(*) AS bad_rows
       FROM invoices WHERE currency <> 'EUR'""",
    "invoices",
)
def _(m: LensModels) -> DataFrame:
    return quality.other_currency(m.invoices)


QUERIES, ORACLES = cases.queries, cases.oracles
