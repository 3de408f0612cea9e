"""Checked queries: readers, landing and sinks, over files written from the given tables."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.checks.cases import Cases
from forecourt.checks.frames import LensModels
from forecourt.checks.rawrows import write_event_days
from forecourt.functions.casts import text_to_timestamp
from forecourt.functions.keys import path_safe_run_id
from forecourt.functions.workspace import scratch_path
from forecourt.operators.paging import paged_envelopes
from forecourt.operators.unnest import unnest_records
from forecourt.schemas import RAW_VEHICLES, TARGET_COLUMNS
from forecourt.sources import landing, raw, tables

cases = Cases()
case = cases.case

DAY = "2024-02-01"
RUN = "manual__2024-02-01T00:00:00+00:00"
SAFE_RUN = "manual__2024-02-01T00-00-00_00-00"


def read_back(m: LensModels, folder: str, schema: str) -> DataFrame:
    root = folder.split("/extract_date=")[0]
    return raw.read_json_lines(m.spark, root, schema)


@case(
    "read_json_lines",
    f"""SELECT vehicle_id, make, model, CAST(model_year AS DOUBLE) AS model_year, fuel_type,
               body_type, CAST(mileage_km AS DOUBLE) AS mileage_km,
               strftime(created_at, '%Y-%m-%dT%H:%M:%S') AS created_at,
               strftime(updated_at, '%Y-%m-%dT%H:%M:%S') AS updated_at,
               '{DAY}' AS extract_date, '0012' AS run_id
        FROM vehicles""",
    "vehicles",
)
def _(m: LensModels) -> DataFrame:
    root = scratch_path(m.spark, "lines")
    landing.land_json_lines(m.vehicles, landing.run_folder(m.spark, root, DAY, "0012"))
    return read_back(m, root, RAW_VEHICLES).drop("source_file")


@case(
    "read_json_renamed",
    """SELECT event_id, strftime(event_timestamp, '%Y-%m-%d %H:%M:%S.%f') AS event_timestamp,
              event_type FROM events_view""",
    "events_view",
)
def _(m: LensModels) -> DataFrame:
    # Half of the files name the field ``timestamp``, half ``event_timestamp``.
    path = scratch_path(m.spark, "events")
    rows = m.events.withColumn("event_timestamp", F.col("event_timestamp").cast("string"))
    even = F.dayofmonth("event_date") % 2 == 0
    write_event_days(rows.filter(even).withColumnRenamed("event_timestamp", "timestamp"), path)
    write_event_days(rows.filter(~even), path, mode="append")
    read = raw.read_events(m.spark, path)
    return read.select(
        "event_id", text_to_timestamp(F.col("event_timestamp")).alias("event_timestamp"), "event_type"
    )


PAGES_SQL = """
    SELECT (row_no - 1) // {size} + 1 AS page, CAST({size} AS BIGINT) AS page_size,
           max(total) AS total_records, CAST(ceil(max(total) / {size}) AS BIGINT) AS total_pages,
           count(*) AS records, min({key}) AS first_key, max({key}) AS last_key
    FROM (SELECT {key}, row_number() OVER (ORDER BY {key}) AS row_no,
                 count(*) OVER () AS total FROM {view})
    GROUP BY 1"""


def page_summary(pages: DataFrame, key: str) -> DataFrame:
    shape = (
        "page bigint, page_size bigint, total_records bigint, total_pages bigint, "
        f"data array<struct<{key} string>>"
    )
    page = pages.select(F.from_json("raw_json", shape).alias("p")).select("p.*")
    keys = F.col("data").getField(key)
    return page.select(
        "page",
        "page_size",
        "total_records",
        "total_pages",
        F.size("data").alias("records"),
        F.array_min(keys).alias("first_key"),
        F.array_max(keys).alias("last_key"),
    )


@case(
    "read_json_envelope",
    PAGES_SQL.format(size=1000, key="contract_id", view="contracts"),
    "contracts",
)
def _(m: LensModels) -> DataFrame:
    root, side = scratch_path(m.spark, "pages"), scratch_path(m.spark, "side")
    landing.land_pages(
        m.contracts, root, "contracts", DAY, RUN, f"{side}/manifests", f"{side}/marks",
        order=["contract_id"],
    )
    return page_summary(raw.read_json_pages(m.spark, root), "contract_id")


@case(
    "paged_envelope_land",
    PAGES_SQL.format(size=500, key="price_id", view="prices"),
    "prices",
)
def _(m: LensModels) -> DataFrame:
    return page_summary(paged_envelopes(m.prices, ["price_id"], landing.PRICING_PAGE), "price_id")


@case(
    "unnest_join",
    """SELECT page, dealer_id, dealer_name, market, segment, sales_rep FROM (
           SELECT *, (row_number() OVER (ORDER BY dealer_id) - 1) // 100 + 1 AS page
           FROM accounts)""",
    "accounts",
)
def _(m: LensModels) -> DataFrame:
    pages = paged_envelopes(m.accounts, ["dealer_id"], 100).select("page", "raw_json")
    return unnest_records(pages, ["dealer_id", "dealer_name", "market", "segment", "sales_rep"])


_TARGET_TEXT = """
    SELECT target_id, strftime(target_month, '%Y-%m') AS target_month, market, sales_rep,
           product_group, CAST(revenue_target_eur AS VARCHAR) AS revenue_target_eur,
           CAST(upsell_target_eur AS VARCHAR) AS upsell_target_eur,
           CAST(new_dealer_target AS VARCHAR) AS new_dealer_target,
           CAST(retention_target_pct AS VARCHAR) AS retention_target_pct, planning_version,
           strftime(created_at, '%Y-%m-%dT%H:%M:%S') AS created_at
    FROM targets"""


def plain_targets(m: LensModels) -> DataFrame:
    rows = m.targets.withColumn("target_month", F.date_format("target_month", "yyyy-MM"))
    return rows.select(*[landing.json_value(rows, c).cast("string").alias(c) for c in rows.columns])


@case("read_csv_strings", _TARGET_TEXT, "targets")
def _(m: LensModels) -> DataFrame:
    path = f"{scratch_path(m.spark, 'csv')}/sha256=none"
    plain_targets(m).write.option("header", True).csv(path)
    read = raw.read_sales_targets(m.spark, path.rsplit("/", 1)[0], files="part-*.csv")
    return read.drop("sha256", "source_file")


def landed_days(m: LensModels) -> DataFrame:
    path = scratch_path(m.spark, "days")
    write_event_days(m.events.drop("event_timestamp"), path)
    return raw.read_events(m.spark, path)


_EVENTS_PER_DAY = """SELECT CAST(event_date AS VARCHAR) AS event_date, count(*) AS events
                     FROM events_view GROUP BY ALL"""


@case("partition_columns", _EVENTS_PER_DAY, "events_view")
def _(m: LensModels) -> DataFrame:
    return landed_days(m).groupBy("event_date").agg(F.count(F.lit(1)).alias("events"))


@case("source_file_column", _EVENTS_PER_DAY, "events_view")
def _(m: LensModels) -> DataFrame:
    folder = F.regexp_extract("source_file", "/event_date=([^/]+)/[^/]+$", 1)
    return landed_days(m).groupBy(folder.alias("event_date")).agg(
        F.count(F.lit(1)).alias("events")
    )


@case("source_file_filter", "SELECT make, count(*) AS vehicles FROM vehicles GROUP BY ALL", "vehicles")
def _(m: LensModels) -> DataFrame:
    # Other files lie beside the data and must not be read as rows.
    root = scratch_path(m.spark, "mixed")
    folder = landing.run_folder(m.spark, root, DAY, RUN)
    landing.land_json_lines(m.vehicles, folder)
    landing.json_encode_rows(m.vehicles).write.mode("append").text(folder)
    m.vehicles.drop("created_at", "updated_at").write.mode("append").json(folder)
    read = read_back(m, folder, RAW_VEHICLES)
    return read.groupBy("make").agg(F.count(F.lit(1)).alias("vehicles"))


def manifest_rows(m: LensModels, path: str) -> DataFrame:
    return m.spark.read.schema(landing.MANIFEST_SCHEMA).parquet(path)


@case(
    "snapshot_extract",
    f"""SELECT vehicle_id, model, '{SAFE_RUN}' AS run_id FROM vehicles""",
    "vehicles",
)
def _(m: LensModels) -> DataFrame:
    root, side = scratch_path(m.spark, "snapshot"), scratch_path(m.spark, "side")
    folder = landing.snapshot_extract(m.vehicles, root, "vehicles", DAY, RUN, side)
    return read_back(m, folder, RAW_VEHICLES).select("vehicle_id", "model", "run_id")


@case(
    "run_manifest",
    f"""SELECT dataset, 'full_snapshot' AS mode, '{DAY}' AS extract_date,
               '{SAFE_RUN}' AS run_id, count(*) AS records
        FROM (SELECT 'vehicles' AS dataset FROM vehicles
              UNION ALL SELECT 'accounts' FROM accounts
              UNION ALL SELECT 'contracts' FROM contracts)
        GROUP BY ALL""",
    "vehicles", "accounts", "contracts",
)
def _(m: LensModels) -> DataFrame:
    side = scratch_path(m.spark, "side")
    for name in ("vehicles", "accounts", "contracts"):
        root = scratch_path(m.spark, name)
        landing.snapshot_extract(getattr(m, name), root, name, DAY, RUN, side)
    return manifest_rows(m, side).select("dataset", "mode", "extract_date", "run_id", "records")


@case(
    "incremental_extract",
    """SELECT 'full' AS mode, CAST(NULL AS VARCHAR) AS previous_watermark,
              CAST(max(updated_at) AS VARCHAR) AS new_watermark, count(*) AS records
       FROM contracts WHERE updated_at < DATE '1998-01-01'
       UNION ALL
       SELECT 'incremental', (SELECT CAST(max(updated_at) AS VARCHAR) FROM contracts
                              WHERE updated_at < DATE '1998-01-01'),
              CAST(max(updated_at) AS VARCHAR), count(*)
       FROM contracts
       WHERE updated_at > (SELECT max(updated_at) FROM contracts
                           WHERE updated_at < DATE '1998-01-01')""",
    "contracts",
)
def _(m: LensModels) -> DataFrame:
    root, side = scratch_path(m.spark, "increments"), scratch_path(m.spark, "side")
    early = m.contracts.filter(F.col("updated_at") < "1998-01-01")
    for rows, run in ((early, "run-1"), (m.contracts, "run-2")):
        landing.incremental_extract(
            rows, root, "contracts", DAY, run, f"{side}/manifests", f"{side}/marks"
        )
    return manifest_rows(m, f"{side}/manifests").select(
        "mode", "previous_watermark", "new_watermark", "records"
    )


@case(
    "repeat_landing",
    """SELECT 'contracts' AS dataset, 2 AS runs, count(*) AS landed FROM contracts
       UNION ALL SELECT 'accounts', 1, count(*) FROM accounts
       UNION ALL SELECT 'vehicles', 1, count(*) FROM vehicles""",
    "contracts", "accounts", "vehicles",
)
def _(m: LensModels) -> DataFrame:
    # Every run is repeated with its own run id: an incremental extract in two runs, pages,
    # and a snapshot. All rows stay, and each run has one manifest row.
    side = scratch_path(m.spark, "side")
    manifests, marks = f"{side}/manifests", f"{side}/marks"
    roots = {name: scratch_path(m.spark, name) for name in ("contracts", "accounts", "vehicles")}
    early = m.contracts.filter(F.col("updated_at") < "1998-01-01")
    for rows, run in ((early, "run-1"), (early, "run-1"), (m.contracts, "r 2"), (m.contracts, "r 2")):
        landing.incremental_extract(
            rows, roots["contracts"], "contracts", DAY, run, manifests, marks
        )
    for _again in range(2):
        landing.land_pages(
            m.accounts, roots["accounts"], "accounts", DAY, RUN, manifests, marks, ["dealer_id"]
        )
        landing.snapshot_extract(m.vehicles, roots["vehicles"], "vehicles", DAY, RUN, manifests)
    pages = m.spark.read.schema("value string").text(roots["accounts"])
    records = F.from_json("value", "data array<string>").data
    counts = {
        "contracts": m.spark.read.schema("value string").text(roots["contracts"]).count(),
        "accounts": pages.agg(F.sum(F.size(records))).first()[0],
        "vehicles": m.spark.read.schema("value string").text(roots["vehicles"]).count(),
    }
    found = m.spark.createDataFrame(list(counts.items()), "dataset string, landed long")
    runs = manifest_rows(m, manifests).groupBy("dataset").agg(F.count(F.lit(1)).cast("int").alias("runs"))
    return runs.join(found, "dataset")


@case("land_new_partitions", _EVENTS_PER_DAY, "events_view")
def _(m: LensModels) -> DataFrame:
    # The second delivery repeats days landed before, with other content.
    first, second, target, ledger = (
        scratch_path(m.spark, p) for p in ("first", "second", "landed", "ledger")
    )
    rows = m.events.drop("event_timestamp")
    early = rows.filter(F.dayofmonth("event_date") <= 15)
    write_event_days(early, first)
    landing.land_new_days(m.spark, first, target, ledger)
    write_event_days(rows.unionAll(early), second)
    landing.land_new_days(m.spark, second, target, ledger)
    landed = raw.read_events(m.spark, target)
    return landed.groupBy("event_date").agg(F.count(F.lit(1)).alias("events"))


@case(
    "content_addressed_land",
    """SELECT 'digests not landed once' AS measure, 0 AS n
       UNION ALL SELECT 'rows', count(*) FROM targets
       UNION ALL SELECT 'target ids', count(DISTINCT target_id) FROM targets""",
    "targets",
)
def _(m: LensModels) -> DataFrame:
    # The same planning files are delivered twice.
    incoming, target = scratch_path(m.spark, "incoming"), scratch_path(m.spark, "targets")
    plain_targets(m).write.option("header", True).option("maxRecordsPerFile", 20_000).csv(incoming)
    delivered = landing.land_by_content(m.spark, incoming, target)
    landing.land_by_content(m.spark, incoming, target)
    kept = raw.partition_values(m.spark, target, "sha256")
    seen = delivered.distinct().unionAll(kept).groupBy("sha256").count()
    rows = raw.read_sales_targets(m.spark, target)

    def measure(name: str, df: DataFrame, value: Column) -> DataFrame:
        return df.agg(value.alias("n")).select(F.lit(name).alias("measure"), "n")

    return (
        measure("digests not landed once", seen, F.count_if(F.col("count") != 2))
        .unionAll(measure("rows", rows, F.count(F.lit(1))))
        .unionAll(measure("target ids", rows, F.countDistinct("target_id")))
    )


@case(
    "require_columns",
    "SELECT planning_version, count(*) AS targets FROM targets GROUP BY ALL",
    "targets",
)
def _(m: LensModels) -> DataFrame:
    rows = landing.require_columns(plain_targets(m), TARGET_COLUMNS)
    return rows.groupBy("planning_version").agg(F.count(F.lit(1)).alias("targets"))


@case(
    "columnar_sink",
    """SELECT CAST(date_trunc('month', invoice_date) AS DATE)::VARCHAR AS part,
              count(*) AS invoices, CAST(sum(invoice_amount) AS DOUBLE) AS amount
       FROM invoices GROUP BY ALL""",
    "invoices",
)
def _(m: LensModels) -> DataFrame:
    root = scratch_path(m.spark, "invoices")
    tables.write_partitions(m.invoices, root, tables.partition_value("invoice_date", True))
    return m.spark.read.parquet(root).groupBy(F.col("part").cast("string").alias("part")).agg(
        F.count(F.lit(1)).alias("invoices"), F.sum("invoice_amount").alias("amount")
    )


@case(
    "read_parquet",
    """SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderpriority,
              strftime(o_orderdate, '%Y-%m-%d %H:%M:%S.%f') AS o_orderdate FROM orders""",
)
def _(m: LensModels) -> DataFrame:
    return raw.read_parquet(m.spark, f"{m.folder}/orders.parquet")


@case(
    "normalise_run_id",
    """SELECT event_id, replace(replace('run__' || event_timestamp || '+00:00', ':', '-'),
                                '+', '_') AS run_id
       FROM events_view""",
    "events_view",
)
def _(m: LensModels) -> DataFrame:
    run = F.concat(F.lit("run__"), F.col("event_timestamp").cast("string"), F.lit("+00:00"))
    return m.events.select("event_id", path_safe_run_id(run).alias("run_id"))


@case(
    "json_encode_rows",
    """SELECT CAST(to_json({'dealer_id': dealer_id, 'dealer_name': dealer_name,
                            'sales_rep': sales_rep,
                            'created_date': CAST(created_date AS VARCHAR)}) AS VARCHAR) AS line
       FROM accounts""",
    "accounts",
)
def _(m: LensModels) -> DataFrame:
    return landing.json_encode_rows(
        m.accounts.select("dealer_id", "dealer_name", "sales_rep", "created_date")
    )


@case(
    "clock_watermark",
    """SELECT 'full' AS mode, count(*) AS records FROM contracts
       WHERE updated_at < DATE '1998-01-01'
       UNION ALL
       SELECT 'incremental', count(*) FROM contracts WHERE updated_at >= DATE '1998-01-01'""",
    "contracts",
)
def _(m: LensModels) -> DataFrame:
    # The clock of the first run says 1998-01-01; a change of that very day must not be lost.
    root, side = scratch_path(m.spark, "clock"), scratch_path(m.spark, "side")
    early = m.contracts.filter(F.col("updated_at") < "1998-01-01")
    runs = (
        (early, "run-1", datetime(1998, 1, 1, 2, 0)),
        (m.contracts, "run-2", datetime(2002, 1, 1, 2, 0)),
    )
    for rows, run, clock in runs:
        landing.land_pages(
            rows, root, "contracts", DAY, run, f"{side}/manifests", f"{side}/marks",
            order=["contract_id"], started_at=clock,
        )
    return manifest_rows(m, f"{side}/manifests").select("mode", "records")


QUERIES, ORACLES = cases.queries, cases.oracles
