"""Readers for the raw files: JSON lines, JSON pages, CSV and Parquet, with their lineage.

Partition values come from folder names and stay text. File name patterns are
applied while files are listed, so manifests beside the data are never opened.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from forecourt.schemas import (
    RAW_ENVELOPE,
    RAW_EVENTS,
    RAW_LISTINGS,
    RAW_TARGETS,
    RAW_VEHICLES,
    RUN_PARTITIONS,
    TARGET_COLUMNS,
)

# Names of the files that hold business rows.
LINES_FILES = "*.{jsonl,json,txt}.gz"
PAGE_FILES = "{page=*.json,part-*.txt*}"
TARGET_FILES = "{*sales_targets.csv,part-*.txt*}"


def with_source_file(df: DataFrame) -> DataFrame:
    """Add the path of the file each row was read from."""
    return df.withColumn("source_file", F.col("_metadata.file_path"))


def read_json_lines(
    spark: SparkSession,
    path: str,
    schema: str,
    partitions: str = RUN_PARTITIONS,
    files: str = LINES_FILES,
) -> DataFrame:
    """One JSON object per line; a value of the wrong type is NULL, its row stays."""
    reader = spark.read.schema(f"{schema}, {partitions}" if partitions else schema)
    return with_source_file(reader.option("pathGlobFilter", files).json(path))


def read_vehicles(spark: SparkSession, path: str) -> DataFrame:
    return read_json_lines(spark, path, RAW_VEHICLES)


def read_listings(spark: SparkSession, path: str) -> DataFrame:
    return read_json_lines(spark, path, RAW_LISTINGS)


def either_name(df: DataFrame, wanted: str, other: str) -> DataFrame:
    """Take ``wanted`` from ``other`` where present, else from its own field."""
    return df.withColumn(wanted, F.coalesce(F.col(other), F.col(wanted))).drop(other)


def read_events(spark: SparkSession, path: str, files: str = LINES_FILES) -> DataFrame:
    """Events by day folder; the time stands in ``timestamp`` or in ``event_timestamp``."""
    fields = f"{RAW_EVENTS}, `timestamp` string"
    rows = read_json_lines(spark, path, fields, "event_date string", files)
    return either_name(rows, "event_timestamp", "timestamp")


def read_json_pages(spark: SparkSession, path: str, files: str = PAGE_FILES) -> DataFrame:
    """One JSON document per line, kept whole in ``raw_json``."""
    rows = (
        spark.read.schema(f"{RAW_ENVELOPE}, {RUN_PARTITIONS}")
        .option("pathGlobFilter", files)
        .text(path)
    )
    return with_source_file(rows)


def read_sales_targets(
    spark: SparkSession, path: str, files: str = TARGET_FILES, keep_empty: bool = False
) -> DataFrame:
    """CSV with a header, all columns text, by content digest.

    Empty fields are NULL; ``keep_empty`` leaves them as empty text.
    """
    reader = (
        spark.read.schema(f"{RAW_TARGETS}, sha256 string")
        .option("header", True)
        .option("quote", '"')
        .option("escape", '"')
        .option("pathGlobFilter", files)
    )
    rows = reader.csv(path)
    if keep_empty:
        rows = rows.fillna("", list(TARGET_COLUMNS))
    return rows.withColumn("source_file", F.col("_metadata.file_path"))


def read_parquet(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.parquet(path)


def read_relational(
    spark: SparkSession,
    url: str,
    table: str,
    split_on: str,
    low: int,
    high: int,
    parts: int,
    **options: str,
) -> DataFrame:
    """A database table, read by ``parts`` tasks that each take a range of ``split_on``."""
    return spark.read.jdbc(
        url,
        table,
        column=split_on,
        lowerBound=low,
        upperBound=high,
        numPartitions=parts,
        properties={"fetchsize": "10000", **options},
    )


def partition_values(
    spark: SparkSession, path: str, column: str, files: str = "*"
) -> DataFrame:
    """Values a path partition takes, from the listing of matching files, none of which is read."""
    # The schema is given so that values are not taken for dates or numbers.
    listed = "path string, modificationTime timestamp, length bigint, content binary"
    reader = spark.read.format("binaryFile").option("pathGlobFilter", files)
    return reader.schema(f"{listed}, `{column}` string").load(path).select(column).distinct()


RAW_READERS = {
    "stg_marketplace_vehicles": read_vehicles,
    "stg_marketplace_listings": read_listings,
    "stg_commercial_accounts": read_json_pages,
    "stg_commercial_contracts": read_json_pages,
    "stg_commercial_subscriptions": read_json_pages,
    "stg_commercial_invoices": read_json_pages,
    "stg_pricing_products": read_json_pages,
    "stg_pricing_prices": read_json_pages,
    "stg_engagement_events": read_events,
    "stg_sales_targets": read_sales_targets,
}

# Folder of each raw dataset below the raw root.
RAW_FOLDERS = {
    "stg_marketplace_vehicles": "marketplace/vehicles",
    "stg_marketplace_listings": "marketplace/listings",
    "stg_commercial_accounts": "commercial/accounts",
    "stg_commercial_contracts": "commercial/contracts",
    "stg_commercial_subscriptions": "commercial/subscriptions",
    "stg_commercial_invoices": "commercial/invoices",
    "stg_pricing_products": "pricing/products",
    "stg_pricing_prices": "pricing/prices",
    "stg_engagement_events": "engagement",
    "stg_sales_targets": "sales_targets/files",
}
