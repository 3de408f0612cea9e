"""Raw rows made from the lens views, as the sources would deliver them.

Every record comes in one to three versions over several runs; only the last one
equals the view. Missing values of typed columns arrive as malformed text.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.checks.frames import LensModels
from forecourt.functions.workspace import scratch_path
from forecourt.lens import STAGED_AS
from forecourt.schemas import KEYS, RAW_LISTINGS, RAW_VEHICLES
from forecourt.sources.landing import json_value, land_by_content
from forecourt.sources.raw import read_events, read_json_lines, read_sales_targets

# Text column that earlier versions get wrong.
STALE_COLUMN = {
    "vehicles": "model",
    "listings": "listing_status",
    "accounts": "dealer_name",
    "contracts": "contract_status",
    "products": "product_name",
    "prices": "currency",
    "events_view": "device",
    "targets": "product_group",
}
MALFORMED = {"date": "2024-13-45", "boolean": "maybe", "decimal(7,4)": "n/a"}


def as_text(df: DataFrame, name: str) -> Column:
    """ISO text of a value; malformed text in place of a missing one."""
    kind = df.schema[name].dataType.simpleString()
    text = json_value(df, name).cast("string")
    return F.coalesce(text, F.lit(MALFORMED[kind])) if kind in MALFORMED else text


def versions(
    rows: DataFrame, view: str, changed: str = "updated_at", ties: bool = True
) -> DataFrame:
    """Versions of every record, oldest first, as text with ``extract_date`` and ``run_id``.

    With ``ties`` the last two of three versions share their change time, and the
    run decides between them.
    """
    key, stale = KEYS[STAGED_AS[view]], STALE_COLUMN[view]
    last = F.pmod(F.xxhash64(key), F.lit(3)).cast("int")
    spread = rows.withColumn("__last", last).withColumn(
        "__no", F.explode(F.sequence(F.lit(0), F.col("__last")))
    )
    final = F.col("__no") == F.col("__last")
    age = F.col("__last") - F.col("__no")
    if ties:
        age = F.when(F.col("__no") == 0, F.col("__last")).otherwise(0)
    earlier = F.col(changed) - F.make_dt_interval(age)
    spread = spread.withColumn(changed, earlier.cast(rows.schema[changed].dataType))
    columns = []
    for name in rows.columns:
        text = as_text(spread, name)
        if name == stale:
            text = F.when(final, text).otherwise(F.lit("STALE"))
        if name == key:
            text = F.when((F.col("__no") > 0) | (F.col("__last") < 2), text)
        columns.append(text.alias(name))
    return spread.select(
        *columns,
        F.concat(F.lit("2024-01-0"), (F.col("__no") + 1).cast("string")).alias("extract_date"),
        F.concat(F.lit("run-"), F.col("__no").cast("string")).alias("run_id"),
    )


def line_versions(m: LensModels, view: str) -> DataFrame:
    """All deliveries of subscriptions or invoices, as text."""
    rows = m.all_versions(view)
    columns = [as_text(rows, c).alias(c) for c in rows.columns if c != "run_key"]
    return rows.select(
        *columns, F.lit("2024-01-01").alias("extract_date"), F.col("run_key").alias("run_id")
    )


def single_record_pages(rows: DataFrame) -> DataFrame:
    """One page per record: the shape of an API page, without a shuffle."""
    fields = [c for c in rows.columns if c not in ("extract_date", "run_id")]
    page = F.struct(
        F.lit(1).alias("page"),
        F.lit(1).alias("page_size"),
        F.array(F.struct(*fields)).alias("data"),
    )
    json = F.to_json(page, {"ignoreNullFields": "false"})
    return rows.select(json.alias("raw_json"), "extract_date", "run_id")


def raw_pages(m: LensModels, view: str) -> DataFrame:
    if view in ("subscriptions", "invoices"):
        return single_record_pages(line_versions(m, view))
    return single_record_pages(versions(m.view(view), view))


def landed_lines(m: LensModels, view: str) -> DataFrame:
    """Vehicles or listings written as gzip JSON lines by run and read back."""
    schema = RAW_VEHICLES if view == "vehicles" else RAW_LISTINGS
    numbers = {"model_year": "int", "mileage_km": "int", "asking_price_eur": "double"}
    rows = versions(m.view(view), view)
    rows = rows.withColumns({c: F.col(c).cast(t) for c, t in numbers.items() if c in rows.columns})
    path = scratch_path(m.spark, view)
    rows.write.option("compression", "gzip").partitionBy("extract_date", "run_id").json(path)
    return read_json_lines(m.spark, path, schema)


def event_versions(m: LensModels) -> DataFrame:
    rows = versions(m.events, "events_view", changed="event_timestamp", ties=False)
    return rows.drop("extract_date", "run_id")


def write_event_days(rows: DataFrame, path: str, mode: str = "errorifexists") -> None:
    """Events as gzip JSON lines by day folder."""
    (
        rows.hint("rebalance", "event_date")
        .write.mode(mode)
        .option("compression", "gzip")
        .partitionBy("event_date")
        .json(path)
    )


def landed_events(m: LensModels) -> tuple[str, DataFrame]:
    """Events written by day folder and read back; the time stands in ``timestamp``."""
    path = scratch_path(m.spark, "events")
    write_event_days(event_versions(m).withColumnRenamed("event_timestamp", "timestamp"), path)
    return path, read_events(m.spark, path)


def target_text(m: LensModels) -> DataFrame:
    """Targets as in the planning file: month without day, all text."""
    rows = versions(m.targets, "targets", changed="created_at", ties=False)
    month = F.substring("target_month", 1, 7)
    return rows.withColumn("target_month", month).drop("extract_date", "run_id")


def landed_targets(m: LensModels) -> tuple[str, DataFrame]:
    """Planning files landed under their digest and read back."""
    incoming, target = scratch_path(m.spark, "incoming"), scratch_path(m.spark, "targets")
    target_text(m).write.option("header", True).option("maxRecordsPerFile", 50_000).csv(incoming)
    land_by_content(m.spark, incoming, target)
    return target, read_sales_targets(m.spark, target)
