"""Output form of checked queries: types that every engine prints alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from forecourt.schemas import AUDIT_COLUMNS

# Whole numbers that may be missing are compared as double, the one numeric type whose
# NULLs look alike in all clients.
NULLABLE_NUMBERS = (
    "start_date_key",
    "end_date_key",
    "model_year",
    "mileage_km",
    "end_key",
    "as_number",
    "events_found",
    "sessions_found",
    "revenue_cents",
    "target_cents",
    "started_subscriptions",
)


def plain(df: DataFrame, *skip: str) -> DataFrame:
    """Money as double, dates, times and booleans as text, whole numbers as bigint.

    Audit times differ from run to run and are left out.
    """
    columns = []
    for field in df.schema:
        if field.name in AUDIT_COLUMNS or field.name in skip:
            continue
        kind, col = field.dataType.simpleString(), F.col(field.name)
        if kind.startswith("decimal") or field.name in NULLABLE_NUMBERS:
            col = col.cast("double")
        elif kind in ("int", "smallint", "tinyint"):
            col = col.cast("bigint")
        elif kind in ("date", "boolean"):
            col = col.cast("string")
        elif kind.startswith("timestamp"):
            col = F.date_format(col, "yyyy-MM-dd HH:mm:ss.SSSSSS")
        columns.append(col.alias(field.name))
    return df.select(*columns)
