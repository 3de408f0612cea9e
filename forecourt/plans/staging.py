"""Raw rows to typed staging rows: unnest, cast, drop rows without identity, keep the latest."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from forecourt.functions.casts import run_stamp, to_type
from forecourt.operators.latest import latest_record_wins, row_fingerprint
from forecourt.operators.unnest import unnest_records
from forecourt.schemas import KEYS, column_types, conform

# Columns of a staging table that do not come from the record itself.
_LINEAGE_FROM = {
    "source_extract_date": "extract_date",
    "source_run_id": "run_id",
    "source_sha256": "sha256",
    "source_file": "source_file",
}
_BY_RUN = ("updated_at", "source_extract_date", "source_run_id")


@dataclass(frozen=True)
class StageSpec:
    """How one staging table is made from its raw dataset."""

    table: str
    envelope: bool
    newest_first: tuple[str, ...]
    filter_column: str | None
    partition_column: str | None = None
    month_columns: tuple[str, ...] = ()
    lookback_days: int = 0

    @property
    def key(self) -> str:
        return KEYS[self.table]

    @property
    def record_fields(self) -> list[str]:
        skip = {*_LINEAGE_FROM, "staged_at"}
        fields = [c for c in column_types(self.table) if c not in skip]
        if self.table == "stg_engagement_events":
            fields.remove("event_date")  # a path partition, not part of the record
        return fields


_LINES = dict(envelope=False, newest_first=_BY_RUN, filter_column="extract_date")
_PAGES = dict(envelope=True, newest_first=_BY_RUN, filter_column="extract_date")

STAGES: dict[str, StageSpec] = {
    spec.table: spec
    for spec in (
        StageSpec("stg_marketplace_vehicles", **_LINES),
        StageSpec("stg_marketplace_listings", **_LINES, partition_column="listing_start_date"),
        StageSpec("stg_commercial_accounts", **_PAGES),
        StageSpec("stg_commercial_contracts", **_PAGES),
        StageSpec(
            "stg_commercial_subscriptions", **_PAGES, partition_column="subscription_start_date"
        ),
        StageSpec("stg_commercial_invoices", **_PAGES, partition_column="invoice_date"),
        StageSpec("stg_pricing_products", **_PAGES),
        StageSpec("stg_pricing_prices", **_PAGES),
        StageSpec(
            "stg_engagement_events",
            envelope=False,
            newest_first=("event_timestamp", "event_date", "source_file"),
            filter_column="event_date",
            partition_column="event_date",
            lookback_days=2,
        ),
        StageSpec(
            "stg_sales_targets",
            envelope=False,
            newest_first=("created_at", "planning_version", "source_sha256"),
            filter_column=None,
            partition_column="target_month",
            month_columns=("target_month",),
        ),
    )
}


def typed_rows(
    spec: StageSpec, raw: DataFrame, staged_at: Column | str | None = None, strict: bool = False
) -> DataFrame:
    """All versions of all records of a raw frame, typed, with their lineage."""
    records = unnest_records(raw, spec.record_fields) if spec.envelope else raw
    if "source_file" not in records.columns:
        records = records.withColumn("source_file", F.lit(None).cast("string"))
    typed = []
    for name, kind in column_types(spec.table).items():
        if name == "staged_at":
            typed.append(run_stamp(staged_at).alias(name))
            continue
        kind = {"timestamp_ntz": "timestamp"}.get(kind, kind)
        if name in spec.month_columns:
            kind = "month"
        source = F.col(_LINEAGE_FROM.get(name, name))
        typed.append(to_type(source, kind, strict).alias(name))
    return records.select(*typed).filter(F.col(spec.key).isNotNull())


def stage(
    spec: StageSpec,
    raw: DataFrame,
    where: Column | None = None,
    staged_at: Column | str | None = None,
    strict: bool = False,
) -> DataFrame:
    """Rows to upsert into a staging table.

    ``where`` restricts the raw partitions; it is applied before anything is
    parsed, so it reaches the scan as a partition filter.
    """
    selected = raw if where is None else raw.filter(where)
    typed = typed_rows(spec, selected, staged_at, strict)
    content = [c for c in column_types(spec.table) if c != "staged_at"]
    latest = latest_record_wins(
        typed,
        [spec.key],
        spec.newest_first,
        tie_break=["source_file", row_fingerprint(*content)],
    )
    return conform(latest, spec.table)
