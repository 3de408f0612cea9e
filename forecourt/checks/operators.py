"""Checked queries: filters, joins, aggregates, windows, paging and set operations."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.checks.cases import Cases
from forecourt.checks.duck import half_up
from forecourt.checks.frames import LensModels
from forecourt.checks.rawrows import as_text, event_versions, line_versions, single_record_pages, target_text, versions
from forecourt.functions.keys import month_start
from forecourt.functions.measures import (
    count_where,
    is_active,
    or_unknown,
    or_zero,
    per_entity,
    ratio_pct,
)
from forecourt.functions.workspace import cut_lineage
from forecourt.operators import aggregates, catalogue, incremental, joins, paging, ranges
from forecourt.operators.latest import latest_record_wins
from forecourt.plans.dimensions import calendar
from forecourt.plans.facts import with_date_keys
from forecourt.plans.intermediate import listing_engagement
from forecourt.plans.marts import SALES_KEYS, revenue_rows, started_active_rows, target_rows
from forecourt.plans.staging import STAGES, typed_rows
from forecourt.plans.quality import orphan_rows

cases = Cases()
case = cases.case


def count_by(df: DataFrame, *keys: str | Column) -> DataFrame:
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"))


# Projections and filters


@case(
    "project_rename",
    """SELECT invoice_id, acc.dealer_name AS customer, acc.market AS sales_market,
              CAST(invoice_amount AS DOUBLE) AS amount
       FROM invoices LEFT JOIN accounts acc USING (dealer_id)""",
    "invoices", "accounts",
)
def _(m: LensModels) -> DataFrame:
    rows = joins.lookup(
        m.invoices,
        m.accounts,
        on={"dealer_id": "dealer_id"},
        take={"customer": "dealer_name", "sales_market": "market"},
    )
    return rows.select(
        "invoice_id", "customer", "sales_market", F.col("invoice_amount").alias("amount")
    )


@case(
    "typed_projection",
    """SELECT contract_id, CAST(contract_start_date AS VARCHAR) AS contract_start_date,
              CAST(contract_end_date AS VARCHAR) AS contract_end_date,
              CAST(auto_renew AS VARCHAR) AS auto_renew, status AS contract_status,
              run_id AS source_run_id
       FROM (SELECT *, contract_status AS status, 'run-1' AS run_id FROM contracts
             UNION ALL SELECT *, 'DRAFT', 'run-0' FROM contracts)""",
    "contracts",
)
def _(m: LensModels) -> DataFrame:
    # Two versions of every contract and one without key. Malformed dates and booleans
    # become NULL and the row stays; a row without key goes.
    text = m.contracts.select(*[as_text(m.contracts, c).alias(c) for c in m.contracts.columns])
    runs = {
        "run-0": text.withColumn("contract_status", F.lit("DRAFT")),
        "run-1": text,
        "run-2": text.withColumn("contract_id", F.lit(None).cast("string")),
    }
    day = F.lit("2024-01-01").alias("extract_date")
    raw = joins.stack([rows.select("*", day, F.lit(run).alias("run_id")) for run, rows in runs.items()])
    typed = typed_rows(STAGES["stg_commercial_contracts"], single_record_pages(raw))
    return typed.select(
        "contract_id", "contract_start_date", "contract_end_date", "auto_renew",
        "contract_status", "source_run_id",
    )


@case(
    "key_not_null",
    "SELECT count(*) AS n FROM listings WHERE vehicle_id IS NOT NULL",
    "listings",
)
def _(m: LensModels) -> DataFrame:
    return m.listings.filter(F.col("vehicle_id").isNotNull()).agg(F.count(F.lit(1)).alias("n"))


@case(
    "pattern_filter",
    "SELECT product_id, product_name FROM products WHERE contains(product_name, 'ring')",
    "products",
)
def _(m: LensModels) -> DataFrame:
    return m.products.filter(F.col("product_name").like("%ring%")).select(
        "product_id", "product_name"
    )


@case(
    "partition_equality",
    """SELECT event_type, count(*) AS n FROM events_view
       WHERE event_date = DATE '2024-01-15' GROUP BY ALL""",
    "events_view",
)
def _(m: LensModels) -> DataFrame:
    day = date(2024, 1, 15)
    rows = m.events.withColumn("event_date", F.col("event_date").cast("string"))
    return count_by(rows.filter(incremental.source_filter("event_date", day, False)), "event_type")


@case(
    "date_window_filter",
    """SELECT 'half open' AS form, count(*) AS n FROM events_view
       WHERE event_date >= DATE '2024-01-05' AND event_date < DATE '2024-01-20'
       UNION ALL
       SELECT 'look back', count(*) FROM events_view
       WHERE event_date BETWEEN DATE '2024-01-13' AND DATE '2024-01-15'""",
    "events_view",
)
def _(m: LensModels) -> DataFrame:
    rows = m.events.withColumn("event_date", F.col("event_date").cast("string"))
    half_open = rows.filter(
        incremental.in_window("event_date", date(2024, 1, 5), date(2024, 1, 20))
    )
    back = rows.filter(incremental.source_filter("event_date", date(2024, 1, 15), False, 2))
    return count_by(half_open, F.lit("half open").alias("form")).unionAll(
        count_by(back, F.lit("look back").alias("form"))
    )


@case("match_all", "SELECT count(*) AS n FROM events_view", "events_view")
def _(m: LensModels) -> DataFrame:
    everything = incremental.source_filter("event_date", date(2024, 1, 15), first_run=True)
    return m.events.filter(everything).agg(F.count(F.lit(1)).alias("n"))


@case(
    "mixed_and_or",
    """SELECT invoice_id FROM invoices
       WHERE (currency = 'CHF' AND payment_status = 'OPEN')
          OR (currency = 'EUR' AND payment_status = 'OVERDUE' AND invoice_amount > 90000)""",
    "invoices",
)
def _(m: LensModels) -> DataFrame:
    swiss_open = (F.col("currency") == "CHF") & (F.col("payment_status") == "OPEN")
    big_overdue = (
        (F.col("currency") == "EUR")
        & (F.col("payment_status") == "OVERDUE")
        & (F.col("invoice_amount") > 90000)
    )
    return m.invoices.filter(swiss_open | big_overdue).select("invoice_id")


@case(
    "in_list",
    """SELECT market, count(*) AS n FROM accounts
       WHERE segment = 'MACHINERY' OR segment = 'BUILDING' GROUP BY ALL""",
    "accounts",
)
def _(m: LensModels) -> DataFrame:
    return count_by(m.accounts.filter(F.col("segment").isin("MACHINERY", "BUILDING")), "market")


@case(
    "case_insensitive_equality",
    """SELECT visibility_package, count(*) AS n FROM listings
       WHERE upper(listing_status) = 'ACTIVE' GROUP BY ALL""",
    "listings",
)
def _(m: LensModels) -> DataFrame:
    return count_by(m.listings.filter(is_active(F.col("listing_status"))), "visibility_package")


@case(
    "catalogue_filter",
    """SELECT price_id, CAST(list_price AS DOUBLE) AS list_price FROM prices
       WHERE market = 'EUROPE' AND dealer_segment = 'BUILDING'""",
    "prices",
)
def _(m: LensModels) -> DataFrame:
    rows = catalogue.in_catalogue(m.prices, market="europe", dealer_segment="Building")
    return rows.select("price_id", "list_price")


@case(
    "effective_on",
    """SELECT price_id FROM prices
       WHERE DATE '1996-06-01' BETWEEN effective_from
                                   AND ifnull(effective_to, DATE '9999-12-31')""",
    "prices",
)
def _(m: LensModels) -> DataFrame:
    return catalogue.effective_on(m.prices, date(1996, 6, 1)).select("price_id")


@case(
    "effective_price_at_event",
    """SELECT invoice_id, price_id, CAST(list_price AS DOUBLE) AS list_price,
              CAST(invoice_amount AS DOUBLE) AS invoice_amount
       FROM int_invoice_enriched AS i LEFT JOIN prices AS p
         ON i.product_id = p.product_id AND i.market = p.market AND i.segment = p.dealer_segment
        AND i.invoice_date BETWEEN p.effective_from AND ifnull(p.effective_to, DATE '9999-12-31')""",
    "int_invoice_enriched",
    "prices",
)
def _(m: LensModels) -> DataFrame:
    """Each invoice with the list price in force on its day."""
    return ranges.join_valid(
        m.int_invoice_enriched,
        m.int_price_book,
        "invoice_date",
        on={"product_id": "product_id", "market": "market", "segment": "dealer_segment"},
        take={"price_id": "price_id", "list_price": "list_price"},
        how="left",
        days=m.staged_invoices,
    ).select("invoice_id", "price_id", "list_price", "invoice_amount")


@case(
    "updated_since",
    "SELECT price_id FROM prices WHERE updated_at >= DATE '1996-03-01'",
    "prices",
)
def _(m: LensModels) -> DataFrame:
    # The mark is a point in time; the day it falls on is read again.
    return incremental.changed_since(m.prices, "updated_at", "1996-03-01T09:30:00").select(
        "price_id"
    )


@case(
    "month_not_null",
    """SELECT month(created_date) AS month_no, count(*) AS n FROM accounts
       WHERE created_date IS NOT NULL GROUP BY ALL""",
    "accounts",
)
def _(m: LensModels) -> DataFrame:
    dated = m.accounts.filter(month_start(F.col("created_date")).isNotNull())
    return count_by(dated, F.month("created_date").alias("month_no"))


# Joins


@case(
    "left_equi_join",
    """SELECT event_id, market FROM events_view LEFT JOIN accounts USING (dealer_id)""",
    "events_view", "accounts",
)
def _(m: LensModels) -> DataFrame:
    rows = joins.lookup(
        m.events, m.accounts, on={"dealer_id": "dealer_id"}, take={"market": "market"}
    )
    return rows.select("event_id", "market")


_REVENUE_GROUPS = """
    SELECT make_date(year(invoice_date), month(invoice_date), 1) AS month_start,
           market, ifnull(sales_rep, 'UNKNOWN') AS sales_rep, product_family AS product_group,
           CAST(sum(invoice_amount) AS DOUBLE) AS revenue
    FROM int_invoice_enriched GROUP BY ALL"""


@case(
    "left_composite_join",
    f"""SELECT CAST(r.month_start AS VARCHAR) AS month_start, r.market, r.sales_rep,
               r.product_group, r.revenue, t.target_id
        FROM ({_REVENUE_GROUPS}) r
        LEFT JOIN targets t ON t.target_month = r.month_start AND t.market = r.market
             AND t.sales_rep = r.sales_rep AND t.product_group = r.product_group""",
    "int_invoice_enriched", "targets",
)
def _(m: LensModels) -> DataFrame:
    grouped = revenue_rows(m.int_invoice_enriched).groupBy(*SALES_KEYS).agg(
        aggregates.sum_money(F.col("amount")).alias("revenue")
    )
    keys = {k: k for k in SALES_KEYS} | {"month_start": "target_month"}
    return joins.lookup(grouped, m.targets, on=keys, take={"target_id": "target_id"})


@case(
    "role_playing_join",
    """SELECT contract_id, CAST(strftime(contract_start_date, '%Y%m%d') AS BIGINT) AS start_key,
              CAST(strftime(contract_end_date, '%Y%m%d') AS DOUBLE) AS end_key
       FROM contracts""",
    "contracts",
)
def _(m: LensModels) -> DataFrame:
    roles = {"start_key": "contract_start_date", "end_key": "contract_end_date"}
    return with_date_keys(m.contracts, m.dim_date, roles).select(
        "contract_id", "start_key", "end_key"
    )


@case(
    "transitive_lookup",
    """SELECT invoice_id, sub.contract_id, con.contract_status
       FROM (SELECT *, CASE WHEN currency = 'EUR' THEN subscription_id END AS euro_subscription
             FROM invoices)
       LEFT JOIN subscriptions sub ON sub.subscription_id = euro_subscription
       LEFT JOIN contracts con ON con.contract_id = sub.contract_id""",
    "invoices", "subscriptions", "contracts",
)
def _(m: LensModels) -> DataFrame:
    # An invoice without its subscription has no contract either.
    known = F.when(F.col("currency") == "EUR", F.col("subscription_id"))
    rows = joins.lookup(
        m.invoices.withColumn("subscription_id", known),
        m.subscriptions,
        on={"subscription_id": "subscription_id"},
        take={"contract_id": "contract_id"},
    )
    rows = joins.lookup(
        rows,
        m.contracts,
        on={"contract_id": "contract_id"},
        take={"contract_status": "contract_status"},
    )
    return rows.select("invoice_id", "contract_id", "contract_status")


@case(
    "orphan_anti_join",
    """SELECT 'event_account' AS check_name, count(*) AS bad_rows FROM events_view
       WHERE dealer_id NOT IN (SELECT dealer_id FROM accounts)""",
    "events_view", "accounts",
)
def _(m: LensModels) -> DataFrame:
    return orphan_rows(m.events, "dealer_id", m.accounts, "dealer_id", "event_account")


@case(
    "unnest_source",
    """SELECT CAST(d AS VARCHAR) AS calendar_date
       FROM (SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate),
                                                INTERVAL 1 DAY)) AS DATE) AS d FROM orders)""",
)
def _(m: LensModels) -> DataFrame:
    return order_days(m)


def order_days(m: LensModels) -> DataFrame:
    """Every day between the first and the last order."""
    ends = m.table("orders").agg(
        F.min(F.to_date("o_orderdate")).alias("first"), F.max(F.to_date("o_orderdate")).alias("last")
    )
    days = F.sequence("first", "last", F.expr("interval 1 day"))
    return ends.select(F.explode(days).alias("calendar_date"))


@case(
    "dim_date",
    """SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key,
              CAST(d AS VARCHAR) AS calendar_date, year(d) AS year_number,
              quarter(d) AS quarter_number, month(d) AS month_number,
              monthname(d) AS month_name, strftime(d, '%Y-%m') AS year_month,
              week(d) AS week_of_year, day(d) AS day_of_month, isodow(d) AS day_of_week,
              dayname(d) AS day_name, CAST(isodow(d) >= 6 AS VARCHAR) AS is_weekend
       FROM (SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate),
                                                INTERVAL 1 DAY)) AS DATE) AS d FROM orders)""",
)
def _(m: LensModels) -> DataFrame:
    return calendar(order_days(m))


@case(
    "key_spine_join",
    """SELECT CAST(month_start AS VARCHAR) AS month_start, market, sales_rep, product_group,
              CAST(cents AS DOUBLE) AS revenue_cents, CAST(target_cents AS DOUBLE) AS target_cents,
              CAST(active_subscriptions AS DOUBLE) AS started_subscriptions
       FROM sales_revenue
       FULL JOIN sales_targets USING (month_start, market, sales_rep, product_group)
       FULL JOIN sales_subscriptions USING (month_start, market, sales_rep, product_group)""",
    "sales_revenue", "sales_targets", "sales_subscriptions",
)
def _(m: LensModels) -> DataFrame:
    # The long form: distinct keys of three aggregates, each joined back.
    def cents(column: str) -> Column:
        return (F.sum(column) * 100).cast("bigint")

    parts = [
        revenue_rows(m.fact_revenue).groupBy(*SALES_KEYS).agg(cents("amount").alias("revenue_cents")),
        target_rows(m.fact_sales_target)
        .groupBy(*SALES_KEYS)
        .agg(cents("revenue_target_eur").alias("target_cents")),
        started_active_rows(m.fact_subscription)
        .groupBy(*SALES_KEYS)
        .agg(F.count(F.lit(1)).alias("started_subscriptions")),
    ]
    rows = joins.key_spine(parts, SALES_KEYS)
    for part in parts:
        rows = rows.join(part, SALES_KEYS, "left")
    return rows


@case(
    "pre_aggregated_join",
    """SELECT listing_id, CAST(engagement_events AS DOUBLE) AS events_found,
              CAST(unique_sessions AS DOUBLE) AS sessions_found
       FROM listings LEFT JOIN listing_counts USING (listing_id)""",
    "listings", "listing_counts",
)
def _(m: LensModels) -> DataFrame:
    counts = {"events_found": "engagement_events", "sessions_found": "unique_sessions"}
    rows = joins.lookup(
        m.listings,
        listing_engagement(m.events),
        on={"listing_id": "listing_id"},
        take=counts,
    )
    return rows.select("listing_id", *counts)


# Aggregations


@case(
    "sum_decimal",
    """SELECT currency, CAST(sum(invoice_amount) AS DOUBLE) AS amount
       FROM invoices GROUP BY ALL""",
    "invoices",
)
def _(m: LensModels) -> DataFrame:
    total = aggregates.sum_money(F.col("invoice_amount"))
    return m.invoices.groupBy("currency").agg(total.alias("amount"))


@case(
    "count_rows",
    "SELECT dealer_id, count(*) AS n FROM invoices GROUP BY ALL",
    "invoices",
)
def _(m: LensModels) -> DataFrame:
    return count_by(m.invoices, "dealer_id")


@case(
    "count_distinct",
    """SELECT event_type, count(DISTINCT session_id) AS sessions,
              count(DISTINCT listing_id) AS listings, count(DISTINCT dealer_id) AS dealers
       FROM events_view GROUP BY ALL""",
    "events_view",
)
def _(m: LensModels) -> DataFrame:
    return m.events.groupBy("event_type").agg(
        F.countDistinct("session_id").alias("sessions"),
        F.countDistinct("listing_id").alias("listings"),
        F.countDistinct("dealer_id").alias("dealers"),
    )


@case(
    "min_max",
    """SELECT listing_id, strftime(min(event_timestamp), '%Y-%m-%d %H:%M:%S.%f') AS first_at,
              strftime(max(event_timestamp), '%Y-%m-%d %H:%M:%S.%f') AS last_at,
              CAST(max(event_date) AS VARCHAR) AS last_day, max(device) AS any_device
       FROM events_view GROUP BY ALL""",
    "events_view",
)
def _(m: LensModels) -> DataFrame:
    return m.events.groupBy("listing_id").agg(
        F.min("event_timestamp").alias("first_at"),
        F.max("event_timestamp").alias("last_at"),
        F.max("event_date").alias("last_day"),
        F.max("device").alias("any_device"),
    )


@case(
    "avg_decimal",
    f"""SELECT product_id,
               {half_up("sum(CAST(discount_pct * 10000 AS HUGEINT))",
                        "10000 * count(discount_pct)", 4)} AS avg_discount,
               {half_up("sum(CAST(contract_price * 100 AS HUGEINT))",
                        "100 * count(contract_price)", 2)} AS avg_price
        FROM subscriptions GROUP BY ALL""",
    "subscriptions",
)
def _(m: LensModels) -> DataFrame:
    return m.subscriptions.groupBy("product_id").agg(
        aggregates.mean_decimal(F.col("discount_pct"), "decimal(12,4)").alias("avg_discount"),
        aggregates.mean_decimal(F.col("contract_price"), "decimal(14,2)", 2).alias("avg_price"),
    )


@case(
    "conditional_count",
    """SELECT dealer_id, count(*) FILTER (payment_status = 'OPEN') AS open_invoices,
              count(*) FILTER (payment_status = 'OVERDUE') AS overdue_invoices
       FROM invoices GROUP BY ALL""",
    "invoices",
)
def _(m: LensModels) -> DataFrame:
    status = F.col("payment_status")
    return m.invoices.groupBy("dealer_id").agg(
        count_where(status == "OPEN").alias("open_invoices"),
        count_where(status == "OVERDUE").alias("overdue_invoices"),
    )


@case(
    "group_by_expression",
    """SELECT strftime(invoice_date, '%Y-%m-01') AS month_start,
              ifnull(sales_rep, 'UNKNOWN') AS sales_rep,
              CAST(sum(invoice_amount) AS DOUBLE) AS amount
       FROM int_invoice_enriched GROUP BY ALL""",
    "int_invoice_enriched",
)
def _(m: LensModels) -> DataFrame:
    return m.int_invoice_enriched.groupBy(
        month_start(F.col("invoice_date")).alias("month_start"),
        or_unknown(F.col("sales_rep")).alias("sales_rep"),
    ).agg(aggregates.sum_money(F.col("invoice_amount")).alias("amount"))


@case(
    "having_filter",
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, count(*) AS row_count
       FROM lineitem GROUP BY ALL HAVING count(*) > 1""",
)
def _(m: LensModels) -> DataFrame:
    return aggregates.repeated_keys(m.table("lineitem"), ["l_orderkey", "l_linenumber"])


@case("scalar_count", "SELECT count(*) AS n FROM lineitem")
def _(m: LensModels) -> DataFrame:
    return aggregates.row_count(m.table("lineitem"), "n")


@case(
    "sum_of_counts",
    """SELECT CAST((SELECT count(*) FROM accounts WHERE sales_rep IS NULL)
                 + (SELECT count(*) FROM listings WHERE vehicle_id IS NULL)
                 + (SELECT count(*) FROM prices WHERE effective_to IS NULL) AS BIGINT) AS n""",
    "accounts", "listings", "prices",
)
def _(m: LensModels) -> DataFrame:
    parts = [(m.accounts, "sales_rep"), (m.listings, "vehicle_id"), (m.prices, "effective_to")]
    counts = [df.agg(F.count_if(F.col(c).isNull()).alias("n")) for df, c in parts]
    return joins.stack(counts).agg(F.sum("n").alias("n"))


@case(
    "safe_ratio_pct",
    f"""SELECT dealer_id,
               {half_up("100 * count(*) FILTER (payment_status = 'OVERDUE')",
                        "count(*) FILTER (payment_status <> 'PAID')", 4)} AS overdue_pct
        FROM invoices GROUP BY ALL""",
    "invoices",
)
def _(m: LensModels) -> DataFrame:
    status = F.col("payment_status")
    grouped = m.invoices.groupBy("dealer_id").agg(
        count_where(status == "OVERDUE").alias("overdue"),
        count_where(status != "PAID").alias("unpaid"),
    )
    return grouped.select(
        "dealer_id", ratio_pct(F.col("overdue"), F.col("unpaid")).alias("overdue_pct")
    )


@case(
    "revenue_per_entity",
    f"""SELECT market,
               {half_up("sum(CAST(invoice_amount * 100 AS HUGEINT))",
                        "100 * count(DISTINCT CASE WHEN currency = 'CHF' THEN dealer_id END)",
                        2)} AS revenue_per_dealer
        FROM int_invoice_enriched GROUP BY market""",
    "int_invoice_enriched",
)
def _(m: LensModels) -> DataFrame:
    swiss = F.when(F.col("currency") == "CHF", F.col("dealer_id"))
    grouped = m.int_invoice_enriched.groupBy("market").agg(
        F.sum("invoice_amount").alias("revenue"), F.countDistinct(swiss).alias("dealers")
    )
    return grouped.select(
        "market", per_entity(F.col("revenue"), F.col("dealers")).alias("revenue_per_dealer")
    )


@case(
    "fill_defaults",
    """SELECT listing_id, ifnull(views, 0) AS views, ifnull(leads, 0) AS leads
       FROM listings LEFT JOIN listing_counts USING (listing_id)""",
    "listings", "listing_counts",
)
def _(m: LensModels) -> DataFrame:
    rows = joins.lookup(
        m.listings,
        listing_engagement(m.events),
        on={"listing_id": "listing_id"},
        take={"views": "views", "leads": "leads"},
    )
    return rows.select(
        "listing_id", or_zero(F.col("views")).alias("views"), or_zero(F.col("leads")).alias("leads")
    )


@case(
    "unknown_member",
    """SELECT CASE WHEN sales_rep IS NULL THEN 'UNKNOWN' ELSE sales_rep END AS sales_rep,
              count(*) AS n FROM accounts GROUP BY ALL""",
    "accounts",
)
def _(m: LensModels) -> DataFrame:
    return count_by(m.accounts, or_unknown(F.col("sales_rep")).alias("sales_rep"))


# Latest record per key


@case(
    "latest_record_wins",
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber, l_partkey, l_suppkey,
              CAST(CAST(l_shipdate AS DATE) AS VARCHAR) AS l_shipdate, l_extendedprice
       FROM lines""",
    "lines",
)
def _(m: LensModels) -> DataFrame:
    return m.lines().select(
        "l_orderkey",
        "l_linenumber",
        "l_partkey",
        "l_suppkey",
        F.to_date("l_shipdate").alias("l_shipdate"),
        "l_extendedprice",
    )


@case("latest_event", "SELECT event_id, device FROM events_view", "events_view")
def _(m: LensModels) -> DataFrame:
    rows = event_versions(m).filter(F.col("event_id").isNotNull())
    return latest_record_wins(rows, ["event_id"], ["event_timestamp", "event_date"]).select(
        "event_id", "device"
    )


@case("latest_plan_version", "SELECT target_id, product_group FROM targets", "targets")
def _(m: LensModels) -> DataFrame:
    rows = target_text(m).filter(F.col("target_id").isNotNull())
    return latest_record_wins(rows, ["target_id"], ["created_at", "planning_version"]).select(
        "target_id", "product_group"
    )


@case(
    "top_1_per_key",
    """SELECT dealer_id, arg_max(invoice_id, (invoice_amount, invoice_id)) AS invoice_id
       FROM invoices GROUP BY ALL""",
    "invoices",
)
def _(m: LensModels) -> DataFrame:
    return latest_record_wins(m.invoices, ["dealer_id"], ["invoice_amount", "invoice_id"]).select(
        "dealer_id", "invoice_id"
    )


# Order and pages


@case(
    "order_by_update",
    """SELECT subscription_id, run_no FROM (
           SELECT subscription_id,
                  row_number() OVER (ORDER BY updated_at, subscription_id) AS run_no
           FROM subscriptions)""",
    "subscriptions",
)
def _(m: LensModels) -> DataFrame:
    rows = m.subscriptions.select("subscription_id", "updated_at")
    numbered = paging.with_row_number(rows, ["updated_at", "subscription_id"])
    return numbered.select("subscription_id", F.col("row_no").alias("run_no"))


@case(
    "multi_key_sort",
    """SELECT price_id, row_number() OVER (ORDER BY product_id, market, dealer_segment,
                                                   effective_from, price_id) AS place
       FROM prices""",
    "prices",
)
def _(m: LensModels) -> DataFrame:
    order = [*catalogue.CATALOGUE_ORDER, "price_id"]
    numbered = paging.with_row_number(m.prices.select(*order), order)
    return numbered.select("price_id", F.col("row_no").alias("place"))


@case(
    "page_slice",
    """SELECT dealer_id, total AS total_records,
              CAST(ceil(total / 50) AS BIGINT) AS total_pages
       FROM (SELECT dealer_id, row_number() OVER (ORDER BY dealer_id) AS place,
                    count(*) OVER () AS total FROM accounts)
       WHERE place BETWEEN 101 AND 150""",
    "accounts",
)
def _(m: LensModels) -> DataFrame:
    return paging.page_slice(m.accounts.select("dealer_id"), ["dealer_id"], page=3, size=50)


@case(
    "page_slices_deep",
    """SELECT page, subscription_id, total AS total_records, (total + 99) // 100 AS total_pages
       FROM (SELECT subscription_id, count(*) OVER () AS total,
                    (row_number() OVER (ORDER BY updated_at, subscription_id) - 1) // 100 + 1
                        AS page
             FROM subscriptions)
       WHERE page IN (1, (total + 99) // 100 // 2, (total + 99) // 100)""",
    "subscriptions",
)
def _(m: LensModels) -> DataFrame:
    # The first, a middle, the last and a missing page, each found by narrowing.
    rows, order = m.staged_subscriptions, ["updated_at", "subscription_id"]
    rows = cut_lineage(rows.select("subscription_id", "updated_at"))
    pages = -(-rows.count() // 100)

    def one(page: int) -> DataFrame:
        found = paging.page_slice(rows, order, page, 100, sort_at_most=1_000)
        return found.drop("updated_at").withColumn("page", F.lit(page).cast("bigint"))

    return joins.stack([one(page) for page in (1, pages // 2, pages, pages + 1)])


# Set operations


@case(
    "union_distinct",
    """SELECT DISTINCT dealer_id FROM (SELECT dealer_id FROM listings
           UNION ALL SELECT dealer_id FROM contracts UNION ALL SELECT dealer_id FROM events_view)""",
    "listings", "contracts", "events_view",
)
def _(m: LensModels) -> DataFrame:
    return joins.key_spine([m.listings, m.contracts, m.events], ["dealer_id"])


@case(
    "union_all",
    """SELECT source, count(*) AS n FROM (SELECT 'contract' AS source FROM contracts
           UNION ALL SELECT 'invoice' FROM invoices) GROUP BY ALL""",
    "contracts", "invoices",
)
def _(m: LensModels) -> DataFrame:
    named = [
        m.contracts.select(F.lit("contract").alias("source")),
        m.invoices.select(F.lit("invoice").alias("source")),
    ]
    return count_by(joins.stack(named), "source")


@case(
    "set_difference",
    "SELECT dealer_id FROM accounts EXCEPT SELECT dealer_id FROM events_view",
    "accounts", "events_view",
)
def _(m: LensModels) -> DataFrame:
    return m.accounts.select("dealer_id").subtract(m.events.select("dealer_id"))


# Upsert match


@case(
    "merge_match_join",
    """SELECT subscription_id, CAST(count(*) AS BIGINT) AS versions
       FROM (SELECT 'S' || l_orderkey || '-' || l_linenumber AS subscription_id FROM lineitem)
       WHERE subscription_id IN (SELECT subscription_id FROM subscriptions
                                 WHERE subscription_status = 'ACTIVE')
       GROUP BY ALL""",
    "subscriptions",
)
def _(m: LensModels) -> DataFrame:
    # Deliveries that meet a stored row under the same key.
    active = m.subscriptions.filter(is_active(F.col("subscription_status")))
    matched = line_versions(m, "subscriptions").join(
        active.select("subscription_id"), "subscription_id", "left_semi"
    )
    return matched.groupBy("subscription_id").agg(F.count(F.lit(1)).alias("versions"))


QUERIES, ORACLES = cases.queries, cases.oracles
