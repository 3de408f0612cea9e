"""Data-quality gates. Each check is a row ``(check_name, bad_rows)``; 0 is good."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from forecourt.operators.aggregates import repeated_keys
from forecourt.operators.joins import orphans
from forecourt.schemas import KEYS

Frames = Mapping[str, DataFrame]

# Child table, its key, parent table, parent key.
FOREIGN_KEYS = {
    "listing_vehicle": ("stg_marketplace_listings", "vehicle_id", "stg_marketplace_vehicles"),
    "contract_account": ("stg_commercial_contracts", "dealer_id", "stg_commercial_accounts"),
    "subscription_contract": (
        "stg_commercial_subscriptions",
        "contract_id",
        "stg_commercial_contracts",
    ),
    "subscription_account": (
        "stg_commercial_subscriptions",
        "dealer_id",
        "stg_commercial_accounts",
    ),
    "invoice_subscription": (
        "stg_commercial_invoices",
        "subscription_id",
        "stg_commercial_subscriptions",
    ),
    "invoice_account": ("stg_commercial_invoices", "dealer_id", "stg_commercial_accounts"),
    "price_product": ("stg_pricing_prices", "product_id", "stg_pricing_products"),
    "event_listing": ("stg_engagement_events", "listing_id", "stg_marketplace_listings"),
}
RAW_CHECKED = {
    "raw_marketplace_vehicles": "vehicle_id",
    "raw_marketplace_listings": "listing_id",
    "raw_engagement_events": "event_id",
    "raw_sales_targets": "target_id",
}
FACT_KEYS = {
    "fact_revenue": {
        "dealer_id": "dealer_key",
        "product_id": "product_key",
        "invoice_date": "date_key",
    },
    "fact_subscription": {
        "dealer_id": "dealer_key",
        "product_id": "product_key",
        "subscription_start_date": "start_date_key",
    },
    "fact_listing_performance": {
        "dealer_id": "dealer_key",
        "vehicle_id": "vehicle_key",
        "listing_start_date": "start_date_key",
    },
}
DIMENSIONS = ("dim_dealer", "dim_product", "dim_vehicle", "dim_date")
FACTS = ("fact_revenue", "fact_subscription", "fact_listing_performance", "fact_sales_target")
CHECKED_MARTS = {
    "mart_sales_performance_monthly": "sales_mart_duplicate_keys",
    "mart_product_performance_monthly": "product_mart_duplicate_keys",
    "mart_marketplace_funnel_monthly": "funnel_mart_duplicate_keys",
}


def stack_all(parts: list[DataFrame]) -> DataFrame:
    return reduce(DataFrame.unionAll, parts)


def check(name: str, df: DataFrame, bad_rows: Column) -> DataFrame:
    """One check as a one-row frame."""
    return df.agg(F.coalesce(bad_rows, F.lit(0)).cast("bigint").alias("bad_rows")).select(
        F.lit(name).alias("check_name"), "bad_rows"
    )


def total(name: str, checks: DataFrame) -> DataFrame:
    """Several one-row checks added up under one name."""
    return check(name, checks, F.sum("bad_rows"))


def no_rows(df: DataFrame, name: str) -> DataFrame:
    """1 if the table is empty; reads no more than one row."""
    return check(name, df.limit(1), F.when(F.count(F.lit(1)) == 0, 1).otherwise(0))


def null_keys(df: DataFrame, key: str, name: str) -> DataFrame:
    return check(name, df, F.count_if(F.col(key).isNull()))


def duplicate_keys(df: DataFrame, key: str, name: str) -> DataFrame:
    """Number of keys held by several rows."""
    return check(name, repeated_keys(df, [key]), F.count(F.lit(1)))


def orphan_rows(
    child: DataFrame, child_key: str, parent: DataFrame, parent_key: str, name: str
) -> DataFrame:
    """Rows that point at a missing parent.

    Rows are counted per key first, so a key that fills a third of the child
    table reaches the join as one row per task.
    """
    per_key = child.groupBy(child_key).agg(F.count(F.lit(1)).alias("rows"))
    return check(name, orphans(per_key, child_key, parent, parent_key), F.sum("rows"))


def wrong_count(df: DataFrame, expected: int, name: str) -> DataFrame:
    """Difference from an expected number of rows."""
    return check(name, df, F.abs(F.count(F.lit(1)) - F.lit(expected)))


def unresolved(keys: Mapping[str, str]) -> Column:
    """Whether a row has a business key or date but lacks its surrogate."""
    missing = F.lit(False)
    for natural, surrogate in keys.items():
        missing = missing | (F.col(natural).isNotNull() & F.col(surrogate).isNull())
    return missing


def unresolved_keys(df: DataFrame, keys: Mapping[str, str], name: str) -> DataFrame:
    """Fact rows with a business key or date but without its surrogate."""
    return check(name, df, F.count_if(unresolved(keys)))


def other_currency(df: DataFrame, name: str = "revenue_other_currency") -> DataFrame:
    """Rows whose amount is summed as euro without being euro."""
    return check(name, df, F.count_if(F.col("currency") != "EUR"))


def raw_checks(raw: Frames) -> DataFrame:
    parts = []
    for table, key in RAW_CHECKED.items():
        parts.append(no_rows(raw[table], f"{table}_empty"))
        parts.append(null_keys(raw[table], key, f"{table}_null_key"))
    return stack_all(parts)


def one_row_per_check(sums: DataFrame, names: list[str]) -> DataFrame:
    """One row with a number per check, turned into rows of checks."""
    checks = [
        F.struct(
            F.lit(name).alias("check_name"),
            F.coalesce(F.col(name), F.lit(0)).cast("bigint").alias("bad_rows"),
        )
        for name in names
    ]
    return sums.select(F.inline(F.array(*checks)))


def key_uses(staged: Frames) -> tuple[DataFrame, dict[str, tuple[int, int]]]:
    """Every key value of every staging table, with its use, and the use of each foreign key.

    A domain is the number of a table, as map tasks hold a row for every key. Use 0 is the key itself; uses 1, 2, … are the
    columns that point to it, numbered within the domain. A table is scanned
    once, whatever the number of its key columns.
    """
    tables = {t: key for t, key in KEYS.items() if t.startswith("stg_")}
    number = {table: n for n, table in enumerate(tables)}
    uses: dict[str, tuple[int, int]] = {}
    for name, (_, _, parent) in FOREIGN_KEYS.items():
        own = number[parent]
        uses[name] = (own, 1 + sum(domain == own for domain, _ in uses.values()))
    parts = []
    for table, key in tables.items():
        columns = [(number[table], 0, key)]
        columns += [(*uses[n], c) for n, (child, c, _) in FOREIGN_KEYS.items() if child == table]
        marked = [
            F.struct(
                F.lit(domain).alias("domain"),
                F.lit(use).alias("use"),
                F.col(column).cast("string").alias("key"),
            )
            for domain, use, column in columns
        ]
        parts.append(staged[table].select(F.inline(F.array(*marked))))
    return stack_all(parts), uses


def staging_checks(staged: Frames) -> DataFrame:
    """Missing keys, repeated keys and orphans of all staging tables from one grouping.

    The rows of a key are counted by use, combined map-side, so a key that fills
    a third of a table meets its parent as one row per task. A key without a row
    of use 0 has no parent, and all its other rows are orphans. Rows without a
    key point to nothing and are no orphans.
    """
    stacked, uses = key_uses(staged)
    slots = range(max(use for _, use in uses.values()) + 1)
    per_key = stacked.groupBy("domain", "key").agg(
        *[F.count_if(F.col("use") == use).alias(f"use_{use}") for use in slots]
    )
    own, no_key = F.col("use_0"), F.col("key").isNull()
    orphaned = ~no_key & (own == 0)
    sums = per_key.agg(
        F.sum(F.when(no_key, own)).alias("null_primary_keys"),
        F.count_if(own > 1).alias("duplicate_primary_keys"),
        *[
            F.sum(F.when(orphaned & (F.col("domain") == domain), F.col(f"use_{use}"))).alias(name)
            for name, (domain, use) in uses.items()
        ],
    )
    return one_row_per_check(sums, ["null_primary_keys", "duplicate_primary_keys", *uses])


def short_key(df: DataFrame, key: str) -> list[Column]:
    """Columns that are equal where the key is: hexadecimal text as half as many bytes."""
    if not isinstance(df.schema[key].dataType, StringType):
        return [F.col(key)]
    packed = F.unhex(key)
    whole = F.coalesce(F.hex(packed) == F.col(key), F.lit(False))
    return [F.when(whole, packed).alias("packed"), F.when(~whole, F.col(key)).alias("plain")]


def analytics_checks(tables: Frames) -> DataFrame:
    """Repeated keys and unresolved references of dimensions, facts and marts.

    Both numbers of a fact come from one count per key, so each table is scanned once.
    """
    parts = []
    for table in (*DIMENSIONS, *FACTS, *CHECKED_MARTS):
        df = tables[table].select("*", unresolved(FACT_KEYS.get(table, {})).alias("__unresolved"))
        per_key = df.groupBy(*short_key(df, KEYS[table])).agg(
            F.count(F.lit(1)).alias("rows"), F.count_if("__unresolved").alias("unresolved")
        )
        parts.append(
            per_key.agg(
                F.count_if(F.col("rows") > 1).alias("repeats"),
                F.sum("unresolved").alias("unresolved"),
            ).select(F.lit(table).alias("table"), "repeats", "unresolved")
        )
    of = F.col("table")
    repeats = {
        "dimension_duplicate_keys": of.isin(*DIMENSIONS),
        "fact_duplicate_keys": of.isin(*FACTS),
        **{name: of == mart for mart, name in CHECKED_MARTS.items()},
    }
    lost = {f"{fact}_unresolved_keys": of == fact for fact in FACT_KEYS}
    sums = stack_all(parts).agg(
        *[F.sum(F.when(where, F.col("repeats"))).alias(n) for n, where in repeats.items()],
        *[F.sum(F.when(where, F.col("unresolved"))).alias(n) for n, where in lost.items()],
    )
    return one_row_per_check(sums, [*repeats, *lost])


class QualityError(RuntimeError):
    """A gate found bad rows."""


def assert_clean(checks: DataFrame) -> None:
    """Raise if any check counted bad rows (one row per check reaches the driver)."""
    failed = checks.filter((F.col("bad_rows") != 0) | F.col("bad_rows").isNull()).collect()
    if failed:
        raise QualityError(", ".join(f"{r.check_name}: {r.bad_rows}" for r in failed))
