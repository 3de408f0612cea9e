"""Latest-record-wins: keep one row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def latest_record_wins(
    df: DataFrame,
    keys: Sequence[str],
    newest_first: Sequence[str | Column],
    tie_break: Sequence[str | Column] = (),
) -> DataFrame:
    """One row per key: the greatest by ``newest_first``, NULLs last.

    ``row_number() <= 1`` lets Spark cut each key to one row inside every map
    task before the shuffle (WindowGroupLimit), so a key that owns a large share
    of the rows crosses the network once per task, not once per row.
    """
    order = [
        (F.col(c) if isinstance(c, str) else c).desc_nulls_last()
        for c in (*newest_first, *tie_break)
    ]
    ranked = df.withColumn(
        _RANK, F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    )
    return ranked.filter(F.col(_RANK) <= 1).drop(_RANK)


def row_fingerprint(*columns: str) -> Column:
    """Content hash used as last sort key, so that exact ties do not flip between runs."""
    return F.xxhash64(*[F.col(c) for c in columns])
