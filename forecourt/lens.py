"""The given benchmark tables seen as a vehicle marketplace.

Each view is one SELECT that reads the same in Spark SQL and in DuckDB, so that
an oracle can be built on the very same data; ``{name}`` stands for an input
table or view and ``{listing_no}`` for the one JSON access, which differs.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.operators.latest import latest_record_wins

SOURCE_TABLES = ("region", "nation", "customer", "part", "orders", "lineitem", "events")

# lineitem repeats (l_orderkey, l_linenumber); the repeats are the versions of one record.
LINE_KEYS = ("l_orderkey", "l_linenumber")
LINE_NEWEST_FIRST = ("l_shipdate", "l_partkey", "l_suppkey", "l_extendedprice", "l_quantity")

VIEWS: dict[str, str] = {
    "accounts": """
        SELECT 'D' || CAST(c_custkey AS STRING) AS dealer_id,
               c_name AS dealer_name,
               r_name AS market,
               c_mktsegment AS segment,
               CASE WHEN c_custkey % 11 <> 0
                    THEN 'REP_' || CAST(c_custkey % 7 AS STRING) END AS sales_rep,
               CASE WHEN c_acctbal < 0 THEN 'SUSPENDED' ELSE 'ACTIVE' END AS account_status,
               CASE WHEN c_custkey % 13 <> 0
                    THEN DATE '1994-01-01' + CAST(c_custkey % 365 AS INT) END AS created_date,
               DATE '1996-01-01' + CAST(c_custkey % 700 AS INT) AS updated_at
        FROM {customer}
        LEFT JOIN {nation} ON c_nationkey = n_nationkey
        LEFT JOIN {region} ON n_regionkey = r_regionkey""",
    "products": """
        SELECT 'P' || CAST(p_partkey AS STRING) AS product_id,
               p_name AS product_name,
               p_type AS product_family,
               CASE WHEN p_size % 2 = 0 THEN 'MONTHLY' ELSE 'ANNUAL' END AS billing_frequency,
               CASE WHEN p_partkey % 17 <> 0 THEN p_size <= 25 END AS active,
               DATE '1995-06-01' + CAST(p_partkey % 300 AS INT) AS updated_at
        FROM {part}""",
    "vehicles": """
        SELECT 'V' || CAST(p_partkey AS STRING) AS vehicle_id,
               p_brand AS make,
               p_name AS model,
               CAST(1990 + p_size % 30 AS INT) AS model_year,
               CASE p_size % 3 WHEN 0 THEN 'PETROL' WHEN 1 THEN 'DIESEL' ELSE 'ELECTRIC' END
                   AS fuel_type,
               p_type AS body_type,
               CAST(p_partkey % 200000 AS INT) AS mileage_km,
               CAST(DATE '2020-01-01' + CAST(p_size AS INT) AS TIMESTAMP_NTZ) AS created_at,
               CAST(DATE '2022-01-01' + CAST(p_partkey % 300 AS INT) AS TIMESTAMP_NTZ)
                   AS updated_at
        FROM {part}""",
    "listings": """
        SELECT 'L' || CAST(p_partkey AS STRING) AS listing_id,
               CASE WHEN p_partkey % 23 <> 0
                    THEN 'V' || CAST(p_partkey AS STRING) END AS vehicle_id,
               'D' || CAST(CAST(floor(p_partkey * 3 / 4.0) AS BIGINT) AS STRING) AS dealer_id,
               DATE '2023-01-01' + CAST(p_partkey % 365 AS INT) AS listing_start_date,
               CASE WHEN p_size <= 15
                    THEN DATE '2023-03-01' + CAST(p_partkey % 365 AS INT) END
                   AS listing_end_date,
               CAST(CAST(p_retailprice AS DECIMAL(10,2)) * 10 AS DECIMAL(12,2))
                   AS asking_price_eur,
               CASE WHEN p_size <= 10 THEN 'SOLD' WHEN p_size <= 15 THEN 'EXPIRED'
                    WHEN p_size % 2 = 0 THEN 'ACTIVE' ELSE 'Active' END AS listing_status,
               CASE WHEN p_size % 5 = 0 THEN 'PREMIUM' ELSE 'STANDARD' END
                   AS visibility_package,
               CAST(DATE '2023-01-01' + CAST(p_partkey % 365 AS INT) AS TIMESTAMP_NTZ)
                   AS created_at,
               CAST(DATE '2023-06-01' + CAST(p_partkey % 300 AS INT) AS TIMESTAMP_NTZ)
                   AS updated_at
        FROM {part}""",
    "contracts": """
        SELECT 'C' || CAST(o_orderkey AS STRING) AS contract_id,
               'D' || CAST(o_custkey AS STRING) AS dealer_id,
               CAST(o_orderdate AS DATE) AS contract_start_date,
               CASE WHEN o_orderstatus <> 'O' THEN CAST(o_orderdate AS DATE) + 365 END
                   AS contract_end_date,
               CASE o_orderstatus WHEN 'O' THEN 'ACTIVE' WHEN 'P' THEN 'CANCELLED'
                    ELSE 'EXPIRED' END AS contract_status,
               CASE WHEN o_orderkey % 17 <> 0
                    THEN o_orderpriority IN ('1-URGENT', '2-HIGH') END AS auto_renew,
               CAST(o_orderdate AS DATE) AS updated_at
        FROM {orders}""",
    "line_records": """
        SELECT l.*, o_custkey, o_orderdate
        FROM {lines} l LEFT JOIN {orders} ON l_orderkey = o_orderkey""",
    "subscriptions": """
        SELECT 'S' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)
                   AS subscription_id,
               'C' || CAST(l_orderkey AS STRING) AS contract_id,
               'D' || CAST(o_custkey AS STRING) AS dealer_id,
               'P' || CAST(l_partkey AS STRING) AS product_id,
               CAST(o_orderdate AS DATE) AS subscription_start_date,
               CASE WHEN l_linestatus = 'F' THEN CAST(l_shipdate AS DATE) END
                   AS subscription_end_date,
               CAST(l_extendedprice AS DECIMAL(12,2)) AS contract_price,
               CASE WHEN l_suppkey % 29 <> 0
                    THEN CAST(abs(CAST(l_discount AS DECIMAL(5,2))) * 100 AS DECIMAL(7,4)) END
                   AS discount_pct,
               CASE WHEN l_linenumber % 2 = 0 THEN 'MONTHLY' ELSE 'ANNUAL' END
                   AS billing_frequency,
               CASE WHEN l_linestatus = 'O' THEN 'ACTIVE' ELSE 'CANCELLED' END
                   AS subscription_status,
               CAST(l_shipdate AS DATE) AS updated_at
        FROM {line_records}""",
    "invoices": """
        SELECT 'I' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)
                   AS invoice_id,
               'S' || CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)
                   AS subscription_id,
               'D' || CAST(o_custkey AS STRING) AS dealer_id,
               CAST(l_shipdate AS DATE) AS invoice_date,
               CAST(CAST(l_extendedprice AS DECIMAL(12,2))
                    * (CAST(1 AS DECIMAL(3,2)) - CAST(l_discount AS DECIMAL(3,2)))
                    AS DECIMAL(14,2)) AS invoice_amount,
               CASE WHEN l_suppkey % 10 = 0 THEN 'CHF' ELSE 'EUR' END AS currency,
               CASE l_returnflag WHEN 'N' THEN 'PAID' WHEN 'A' THEN 'OPEN' ELSE 'OVERDUE' END
                   AS payment_status,
               CAST(l_shipdate AS DATE) AS updated_at
        FROM {line_records}""",
    "prices": """
        SELECT 'PR' || CAST(p_partkey AS STRING) || '-' || CAST(r_regionkey AS STRING)
                   AS price_id,
               'P' || CAST(p_partkey AS STRING) AS product_id,
               r_name AS market,
               CASE (p_partkey + r_regionkey) % 3 WHEN 0 THEN 'AUTOMOBILE'
                    WHEN 1 THEN 'BUILDING' ELSE 'MACHINERY' END AS dealer_segment,
               'EUR' AS currency,
               CAST(CAST(p_retailprice AS DECIMAL(10,2))
                    * CAST(1 + r_regionkey * 0.05 AS DECIMAL(4,2)) AS DECIMAL(12,2))
                   AS list_price,
               make_date(CAST(1995 + floor((p_partkey % 24) / 12.0) AS INT),
                         CAST(p_partkey % 12 + 1 AS INT), 1) AS effective_from,
               CASE WHEN p_size % 3 <> 0
                    THEN make_date(CAST(1996 + floor((p_partkey % 24) / 12.0) AS INT),
                                   CAST(p_partkey % 12 + 1 AS INT), 28) END AS effective_to,
               CAST(1995 + CAST(floor((p_partkey % 24) / 12.0) AS INT) AS STRING) || 'Q'
                   || CAST(CAST(floor((p_partkey % 12) / 3.0) + 1 AS INT) AS STRING)
                   AS pricing_version,
               make_date(CAST(1995 + floor((p_partkey % 24) / 12.0) AS INT),
                         CAST(p_partkey % 12 + 1 AS INT), 1) AS updated_at
        FROM {part_regions}
        LEFT JOIN {region} ON region_no = r_regionkey""",
    "events_view": """
        SELECT 'E' || CAST(event_id AS STRING) AS event_id,
               ts AS event_timestamp,
               CAST(ts AS DATE) AS event_date,
               'L' || {listing_no} AS listing_id,
               CASE WHEN user_id % 19 <> 0 THEN 'D' || CAST(user_id AS STRING)
                    ELSE 'X' || CAST(user_id AS STRING) END AS dealer_id,
               CAST(user_id AS STRING) || '-' || CAST(CAST(ts AS DATE) AS STRING)
                   AS session_id,
               CASE event_type WHEN 'purchase' THEN 'lead' WHEN 'click' THEN 'CLICK'
                    ELSE event_type END AS event_type,
               CASE event_id % 3 WHEN 0 THEN 'MOBILE' WHEN 1 THEN 'DESKTOP' ELSE 'TABLET' END
                   AS device
        FROM {events}""",
    "order_groups": """
        SELECT make_date(year(o_orderdate) + CAST(floor(month(o_orderdate) / 12.0) AS INT),
                         month(o_orderdate) % 12 + 1, 1) AS target_month,
               market, sales_rep,
               CASE o_orderkey % 6 WHEN 0 THEN 'ECONOMY' WHEN 1 THEN 'LARGE'
                    WHEN 2 THEN 'MEDIUM' WHEN 3 THEN 'PROMO' WHEN 4 THEN 'SMALL'
                    ELSE 'STANDARD' END AS product_group,
               CAST(o_totalprice AS DECIMAL(12,2)) AS order_value
        FROM {orders} JOIN {accounts}
             ON dealer_id = 'D' || CAST(o_custkey AS STRING)
        WHERE sales_rep < 'REP_5'""",
    "targets": """
        SELECT 'T' || CAST(target_month AS STRING) || '/' || market || '/' || sales_rep
                   || '/' || product_group AS target_id,
               target_month, market, sales_rep, product_group,
               CAST(CAST(sum(order_value) AS DECIMAL(18,2)) * CAST(0.1 AS DECIMAL(3,2))
                    AS DECIMAL(14,2)) AS revenue_target_eur,
               CAST(CAST(sum(order_value) AS DECIMAL(18,2)) * CAST(0.01 AS DECIMAL(3,2))
                    AS DECIMAL(14,2)) AS upsell_target_eur,
               CAST(count(*) AS INT) AS new_dealer_target,
               CAST(90 + CAST(count(*) % 10 AS DECIMAL(3,0)) AS DECIMAL(7,4))
                   AS retention_target_pct,
               'BUDGET_' || CAST(year(target_month) AS STRING) AS planning_version,
               CAST(target_month AS TIMESTAMP_NTZ) AS created_at
        FROM {order_groups}
        GROUP BY target_month, market, sales_rep, product_group""",
}

ROWS_A_TASK = 25_000

# View name to the staging table it plays.
STAGED_AS = {
    "vehicles": "stg_marketplace_vehicles",
    "listings": "stg_marketplace_listings",
    "accounts": "stg_commercial_accounts",
    "contracts": "stg_commercial_contracts",
    "subscriptions": "stg_commercial_subscriptions",
    "invoices": "stg_commercial_invoices",
    "products": "stg_pricing_products",
    "prices": "stg_pricing_prices",
    "events_view": "stg_engagement_events",
    "targets": "stg_sales_targets",
}


class Lens:
    """Views over one data folder; every view is built on demand and lazily."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark = spark
        self.folder = folder

    def table(self, name: str) -> DataFrame:
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def lines(self) -> DataFrame:
        """Latest version of each order line."""
        return latest_record_wins(self.table("lineitem"), LINE_KEYS, LINE_NEWEST_FIRST)

    def lines_by_order(self) -> DataFrame:
        """The same rows brought together by order, so that they meet their order where they are."""
        rows = self.table("lineitem").repartition("l_orderkey")
        return latest_record_wins(rows, LINE_KEYS, LINE_NEWEST_FIRST)

    def part_regions(self) -> DataFrame:
        """Each part once per region number."""
        numbers = F.sequence(F.lit(0), F.lit(4))
        return spread_rows(self.table("part")).select("*", F.explode(numbers).alias("region_no"))

    def view(self, name: str, **given: DataFrame) -> DataFrame:
        """A view, its inputs taken from ``given`` or made from the source tables."""
        if name == "lines":
            return self.lines()
        if name == "part_regions":
            return self.part_regions()
        if name in SOURCE_TABLES:
            return self.table(name)
        if name == "line_records":
            given = {"lines": self.lines_by_order(), **given}
        inputs = {i: given[i] if i in given else self.view(i) for i in view_inputs(name)}
        text = VIEWS[name].replace("{listing_no}", "get_json_object(props, '$.k')")
        return self.spark.sql(text, **inputs)

    def all_versions(self, name: str) -> DataFrame:
        """Subscriptions or invoices before the latest version is chosen.

        ``run_key`` is text that orders versions of the same day as the lens does.
        """
        digits = [
            F.lpad(F.col(c).cast("string"), 20, "0") for c in ("l_partkey", "l_suppkey")
        ] + [
            F.lpad((F.col(c) * 100).cast("decimal(18,0)").cast("string"), 20, "0")
            for c in ("l_extendedprice", "l_quantity")
        ]
        records = self.view("line_records", lines=self.table("lineitem"))
        records = records.withColumn("run_key", F.concat(*digits))
        text = VIEWS[name].replace("FROM {line_records}", ", run_key FROM {line_records}")
        return self.spark.sql(text, line_records=records)


def spread_rows(rows: DataFrame, per_task: int = ROWS_A_TASK) -> DataFrame:
    """The rows dealt to tasks of about ``per_task`` each, before every row becomes many.

    A table of few bytes is read by few tasks, however many rows are made of it there.
    """
    tasks = -(-rows.count() // per_task)
    return rows.repartition(tasks, rows.columns[0]) if tasks > 1 else rows


def view_inputs(name: str) -> list[str]:
    """Names in braces, in order of appearance."""
    names: list[str] = []
    for piece in VIEWS[name].split("{")[1:]:
        found = piece.split("}")[0]
        if found != "listing_no" and found not in names:
            names.append(found)
    return names
