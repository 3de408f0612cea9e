"""Checked queries: scalar functions, each over a whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.checks.cases import Cases
from forecourt.checks.frames import LensModels
from forecourt.checks.operators import order_days
from forecourt.functions import casts, keys
from forecourt.functions.measures import one_of
from forecourt.operators.catalogue import END_OF_TIME
from forecourt.operators.unnest import page_records, unnest_records
from forecourt.sources.landing import DAY_FORM, json_value

cases = Cases()
case = cases.case


@case(
    "fn_cast",
    """SELECT o_orderkey, CAST(o_orderkey AS VARCHAR) AS as_text,
              CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS as_day,
              CAST(CAST(o_totalprice AS DECIMAL(12,2)) AS DOUBLE) AS as_money,
              CAST(substr(o_orderpriority, 1, 1) AS BIGINT) AS priority_no
       FROM orders""",
)
def _(m: LensModels) -> DataFrame:
    return m.table("orders").select(
        "o_orderkey",
        F.col("o_orderkey").cast("string").alias("as_text"),
        F.col("o_orderdate").cast("date").alias("as_day"),
        F.col("o_totalprice").cast("decimal(12,2)").alias("as_money"),
        F.substring("o_orderpriority", 1, 1).cast("int").alias("priority_no"),
    )


@case(
    "fn_try_cast",
    """SELECT l_orderkey, CAST(l_linenumber AS BIGINT) AS l_linenumber,
              CAST(TRY_CAST(word AS INTEGER) AS DOUBLE) AS as_number,
              CAST(TRY_CAST(word AS DECIMAL(12,2)) AS DOUBLE) AS as_money
       FROM (SELECT *, CASE l_linenumber WHEN 1 THEN '' WHEN 2 THEN 'n/a'
                            WHEN 3 THEN l_orderkey || '00000000000'
                            ELSE CAST(l_orderkey AS VARCHAR) END AS word FROM lines)""",
    "lines",
)
def _(m: LensModels) -> DataFrame:
    # Empty text, words and numbers out of range become NULL.
    line, number = F.col("l_linenumber"), F.col("l_orderkey").cast("string")
    word = (
        F.when(line == 1, "")
        .when(line == 2, "n/a")
        .when(line == 3, F.concat(number, F.lit("00000000000")))
        .otherwise(number)
    )
    return m.lines().select(
        "l_orderkey",
        "l_linenumber",
        casts.to_type(word, "int").alias("as_number"),
        casts.to_type(word, "decimal(12,2)").alias("as_money"),
    )


@case(
    "fn_coalesce",
    "SELECT dealer_id, ifnull(sales_rep, segment) AS contact FROM accounts",
    "accounts",
)
def _(m: LensModels) -> DataFrame:
    return m.accounts.select("dealer_id", F.coalesce("sales_rep", "segment").alias("contact"))


@case(
    "fn_case_when",
    """SELECT listing_id, if(asking_price_eur >= 12000, 'high',
                              if(asking_price_eur >= 10000, 'mid', 'low')) AS price_class
       FROM listings""",
    "listings",
)
def _(m: LensModels) -> DataFrame:
    price = F.col("asking_price_eur")
    price_class = F.when(price >= 12000, "high").when(price >= 10000, "mid").otherwise("low")
    return m.listings.select("listing_id", price_class.alias("price_class"))


@case("fn_lower", "SELECT event_id, lower(event_type) AS kind FROM events_view", "events_view")
def _(m: LensModels) -> DataFrame:
    return m.events.select("event_id", F.lower("event_type").alias("kind"))


@case(
    "fn_concat",
    "SELECT dealer_id, market || '|' || sales_rep AS label FROM accounts",
    "accounts",
)
def _(m: LensModels) -> DataFrame:
    # NULL if any part is NULL.
    return m.accounts.select(
        "dealer_id", F.concat("market", F.lit("|"), "sales_rep").alias("label")
    )


@case(
    "fn_md5_key",
    """SELECT dealer_id, upper(md5(dealer_id)) AS dealer_key,
              upper(md5(market || '|' || sales_rep)) AS team_key FROM accounts""",
    "accounts",
)
def _(m: LensModels) -> DataFrame:
    return m.accounts.select(
        "dealer_id",
        keys.hash_key("dealer_id").alias("dealer_key"),
        keys.hash_key("market", "sales_rep").alias("team_key"),
    )


@case(
    "fn_date_trunc_month",
    "SELECT invoice_id, strftime(invoice_date, '%Y-%m-01') AS month_start FROM invoices",
    "invoices",
)
def _(m: LensModels) -> DataFrame:
    return m.invoices.select(
        "invoice_id", keys.month_start(F.col("invoice_date")).alias("month_start")
    )


@case(
    "fn_date_parts",
    """SELECT o_orderkey, year(o_orderdate) AS y, quarter(o_orderdate) AS q,
              month(o_orderdate) AS m, day(o_orderdate) AS d FROM orders""",
)
def _(m: LensModels) -> DataFrame:
    day = F.to_date("o_orderdate")
    return m.table("orders").select(
        "o_orderkey",
        F.year(day).alias("y"),
        F.quarter(day).alias("q"),
        F.month(day).alias("m"),
        F.dayofmonth(day).alias("d"),
    )


@case("fn_iso_week", "SELECT o_orderkey, week(o_orderdate) AS iso_week FROM orders")
def _(m: LensModels) -> DataFrame:
    return m.table("orders").select("o_orderkey", F.weekofyear("o_orderdate").alias("iso_week"))


@case("fn_iso_day_of_week", "SELECT o_orderkey, isodow(o_orderdate) AS iso_day FROM orders")
def _(m: LensModels) -> DataFrame:
    return m.table("orders").select(
        "o_orderkey", keys.iso_day_of_week(F.col("o_orderdate")).alias("iso_day")
    )


@case(
    "fn_date_format",
    """SELECT o_orderkey, monthname(o_orderdate) AS month_name,
              strftime(o_orderdate, '%Y-%m') AS year_month, dayname(o_orderdate) AS day_name
       FROM orders""",
)
def _(m: LensModels) -> DataFrame:
    return m.table("orders").select(
        "o_orderkey",
        F.date_format("o_orderdate", "MMMM").alias("month_name"),
        F.date_format("o_orderdate", "yyyy-MM").alias("year_month"),
        F.date_format("o_orderdate", "EEEE").alias("day_name"),
    )


@case(
    "fn_date_key",
    "SELECT invoice_id, CAST(strftime(invoice_date, '%Y%m%d') AS BIGINT) AS date_key FROM invoices",
    "invoices",
)
def _(m: LensModels) -> DataFrame:
    return m.invoices.select("invoice_id", keys.date_key(F.col("invoice_date")).alias("date_key"))


@case(
    "fn_date_sequence",
    """SELECT contract_id, CAST(count(d) AS BIGINT) AS days, CAST(max(d) AS VARCHAR) AS last_day
       FROM (SELECT contract_id,
                    CAST(unnest(generate_series(contract_start_date,
                                                contract_start_date + INTERVAL 30 DAY,
                                                INTERVAL 1 DAY)) AS DATE) AS d FROM contracts)
       GROUP BY ALL""",
    "contracts",
)
def _(m: LensModels) -> DataFrame:
    start = F.col("contract_start_date")
    days = F.sequence(start, F.date_add(start, 30), F.expr("interval 1 day"))
    return m.contracts.select(
        "contract_id", F.size(days).alias("days"), F.array_max(days).alias("last_day")
    )


def _page(m: LensModels) -> DataFrame:
    """One page per product, with a NULL, a number, a nested and a bracketed text field."""
    rows = m.products
    record = F.struct(
        "product_id",
        F.lit(None).cast("string").alias("nothing"),
        F.length("product_name").alias("size"),
        F.struct("product_name").alias("nested"),
        F.concat(F.lit("{"), "product_name", F.lit("}")).alias("bracketed"),
        json_value(rows, "updated_at"),
    )
    page = F.struct(F.array(record, record).alias("data"))
    return rows.select(
        "product_id", F.to_json(page, {"ignoreNullFields": "false"}).alias("raw_json")
    )


@case("fn_json_array", "SELECT product_id, CAST(2 AS BIGINT) AS records FROM products", "products")
def _(m: LensModels) -> DataFrame:
    return _page(m).select(
        "product_id", F.size(page_records(F.col("raw_json"))).alias("records")
    )


@case(
    "fn_json_scalar",
    """SELECT product_id, CAST(NULL AS VARCHAR) AS nothing,
              CAST(length(product_name) AS VARCHAR) AS size,
              CAST(NULL AS VARCHAR) AS nested, '{' || product_name || '}' AS bracketed,
              CAST(updated_at AS VARCHAR) AS updated_at
       FROM products, range(2)""",
    "products",
)
def _(m: LensModels) -> DataFrame:
    fields = ["product_id", "nothing", "size", "nested", "bracketed", "updated_at"]
    return unnest_records(_page(m).select("raw_json"), fields)


@case(
    "fn_run_stamp",
    """SELECT product_id, '2024-03-01 02:00:00.000000' AS stamped FROM products""",
    "products",
)
def _(m: LensModels) -> DataFrame:
    return m.products.select("product_id", casts.run_stamp("2024-03-01 02:00:00").alias("stamped"))


@case(
    "fn_decimal_arithmetic",
    """SELECT subscription_id,
              CAST(contract_price * (CAST(100 AS DECIMAL(7,4)) - discount_pct) AS DOUBLE) AS scaled
       FROM subscriptions""",
    "subscriptions",
)
def _(m: LensModels) -> DataFrame:
    rest = F.lit(100).cast("decimal(7,4)") - F.col("discount_pct")
    return m.subscriptions.select(
        "subscription_id", (F.col("contract_price") * rest).alias("scaled")
    )


@case(
    "fn_comparisons",
    """SELECT count(*) AS n FROM subscriptions
       WHERE discount_pct IS NOT NULL AND NOT discount_pct < 5
         AND (subscription_end_date IS NULL OR subscription_end_date <> updated_at)""",
    "subscriptions",
)
def _(m: LensModels) -> DataFrame:
    end = F.col("subscription_end_date")
    kept = (
        F.col("discount_pct").isNotNull()
        & ~(F.col("discount_pct") < 5)
        & (end.isNull() | (end != F.col("updated_at")))
    )
    return m.subscriptions.filter(kept).agg(F.count(F.lit(1)).alias("n"))


@case(
    "fn_typed_literals",
    """SELECT invoice_id, CAST(0.00 AS DOUBLE) AS zero, '2024-01-01' AS day, 'true' AS flag
       FROM invoices""",
    "invoices",
)
def _(m: LensModels) -> DataFrame:
    return m.invoices.select(
        "invoice_id",
        F.lit("0.00").cast("decimal(18,2)").alias("zero"),
        F.to_date(F.lit("2024-01-01")).alias("day"),
        F.lit(True).alias("flag"),
    )


@case(
    "fn_regex_match",
    r"""SELECT event_id FROM (
           SELECT event_id, CASE WHEN event_id % 7 = 0 THEN strftime(ts, '%Y-%m')
                                 ELSE strftime(ts, '%Y-%m-%d') END AS folder FROM events)
       WHERE regexp_full_match(folder, '[0-9]{4}-[0-9]{2}-[0-9]{2}')""",
)
def _(m: LensModels) -> DataFrame:
    # Folder names without a day are not taken for partitions.
    folder = F.when(F.col("event_id") % 7 == 0, F.date_format("ts", "yyyy-MM")).otherwise(
        F.date_format("ts", "yyyy-MM-dd")
    )
    return m.table("events").filter(folder.rlike(DAY_FORM)).select("event_id")


@case("fn_upper", "SELECT product_id, upper(product_name) AS label FROM products", "products")
def _(m: LensModels) -> DataFrame:
    return m.products.select("product_id", F.upper("product_name").alias("label"))


@case(
    "fn_open_end",
    """SELECT price_id, CAST(ifnull(effective_to, DATE '9999-12-31') AS VARCHAR) AS valid_to
       FROM prices""",
    "prices",
)
def _(m: LensModels) -> DataFrame:
    end = F.coalesce("effective_to", F.lit(END_OF_TIME))
    return m.prices.select("price_id", end.alias("valid_to"))


@case("fn_sha256", "SELECT page_id, sha256(html) AS digest FROM pages")
def _(m: LensModels) -> DataFrame:
    return m.table("pages").select("page_id", F.sha2("html", 256).alias("digest"))


@case(
    "fn_stage_match",
    """SELECT event_id, CAST(event_type ILIKE 'click' OR event_type ILIKE 'lead' AS VARCHAR)
                  AS counted FROM events_view""",
    "events_view",
)
def _(m: LensModels) -> DataFrame:
    return m.events.select(
        "event_id", one_of(F.col("event_type"), ["CLICK", "lead"]).alias("counted")
    )


@case(
    "fn_month_text",
    """SELECT CAST(d AS VARCHAR) AS calendar_date, strftime(d, '%Y-%m-01') AS from_month,
              CAST(NULL AS VARCHAR) AS strict_month
       FROM (SELECT CAST(unnest(generate_series(min(o_orderdate), max(o_orderdate),
                                                INTERVAL 1 DAY)) AS DATE) AS d FROM orders)""",
)
def _(m: LensModels) -> DataFrame:
    text = F.date_format("calendar_date", "yyyy-MM")
    return order_days(m).select(
        "calendar_date",
        casts.text_to_month(text).alias("from_month"),
        casts.text_to_month(text, strict=True).alias("strict_month"),
    )


@case(
    "fn_iso_timestamp",
    """SELECT event_id, strftime(event_timestamp, '%Y-%m-%d %H:%M:%S.%f') AS parsed
       FROM events_view""",
    "events_view",
)
def _(m: LensModels) -> DataFrame:
    text = m.events.select("event_id", json_value(m.events, "event_timestamp").alias("text"))
    return text.select("event_id", casts.text_to_timestamp(F.col("text")).alias("parsed"))


QUERIES, ORACLES = cases.queries, cases.oracles
