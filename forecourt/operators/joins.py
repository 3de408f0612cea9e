"""Lookups, orphan counts and the n-way key spine."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from forecourt.operators.aggregates import repeated_keys
from forecourt.schemas import KEYS

_SPREAD = 4096


def spread_null_key(
    df: DataFrame, key: str, spread_by: str | Sequence[str] | None = None
) -> Column:
    """Join key in which NULLs take many different values that mean nothing.

    Rows with a NULL key find no partner, yet would all be hashed to one task;
    this sends them to as many as there are. The values come from few columns
    only, so that the scan below reads no more than is asked for: ``spread_by``,
    else the frame's primary key, else its first other column.
    """
    if spread_by is None:
        others = [c for c in df.columns if c != key] or [key]
        keys = set(KEYS.values())
        spread_by = next((c for c in others if c in keys), others[0])
    columns = [spread_by] if isinstance(spread_by, str) else spread_by
    filler = F.concat(F.lit("\u0000"), F.pmod(F.xxhash64(*columns), F.lit(_SPREAD)))
    return F.coalesce(F.col(key), filler)


def told_unique(parent: DataFrame, key: str) -> DataFrame:
    """The parent in a form that tells Spark that its keys do not repeat, if that is so.

    A left join that takes no column which is used later then costs nothing, as Spark
    leaves it out. Whether keys repeat is counted first, over the key column alone; a
    parent with repeated keys, which multiplies the rows that meet it, stays as it is.
    """
    known = parent.filter(F.col(key).isNotNull())
    return parent if not repeated_keys(known, [key]).isEmpty() else known.dropDuplicates([key])


def lookup(
    left: DataFrame,
    right: DataFrame,
    on: Mapping[str, str],
    take: Mapping[str, str],
    spread_by: str | Sequence[str] | None = None,
) -> DataFrame:
    """Left equi join that adds the ``take`` columns (new name: right-hand name).

    ``on`` maps left keys to right keys; a NULL key matches nothing. Whether the
    right side is broadcast is left to Spark, which knows its size at run time;
    hot keys of a shuffled join are split by AQE, NULL keys are spread here (by
    ``spread_by``, see ``spread_null_key``). The spread key stands in the condition,
    not in a column: it is not shuffled with the rows, and a second lookup by the
    same key finds them where they are.
    """
    right_side = right.select(
        *[F.col(r).alias(f"__key{i}") for i, r in enumerate(on.values())],
        *[F.col(r).alias(f"__take_{new}") for new, r in take.items()],
    )
    condition: Column | None = None
    for i, name in enumerate(on):
        if len(on) == 1 and isinstance(left.schema[name].dataType, StringType):
            spread = spread_null_key(left, name, spread_by)
            clause = (spread == F.col(f"__key{i}")) & F.col(name).isNotNull()
        else:
            clause = F.col(name) == F.col(f"__key{i}")
        condition = clause if condition is None else condition & clause
    joined = left.join(right_side, condition, "left")
    return joined.select(
        *[F.col(c) for c in left.columns if c not in take],
        *[F.col(f"__take_{new}").alias(new) for new in take],
    )


def orphans(child: DataFrame, child_key: str, parent: DataFrame, parent_key: str) -> DataFrame:
    """Child rows whose key is present but has no parent."""
    parents = parent.select(F.col(parent_key).alias("__parent"))
    present = child.filter(F.col(child_key).isNotNull())
    return present.join(parents, F.col(child_key) == F.col("__parent"), "left_anti")


def key_spine(frames: Sequence[DataFrame], keys: Sequence[str]) -> DataFrame:
    """Every key tuple found in any of the frames, once."""
    spine = frames[0].select(*keys)
    for frame in frames[1:]:
        spine = spine.union(frame.select(*keys))
    return spine.distinct()


def stack(frames: Sequence[DataFrame]) -> DataFrame:
    """All rows of all frames under one header; absent columns are NULL.

    Grouping the stack by the keys gives what joining the grouped frames on a
    key spine gives, with one shuffle in place of one per frame and join.
    """
    stacked = frames[0]
    for frame in frames[1:]:
        stacked = stacked.unionByName(frame, allowMissingColumns=True)
    return stacked
