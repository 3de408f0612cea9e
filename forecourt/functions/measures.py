"""Measure expressions: conditional counts, defaults and guarded ratios."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

UNKNOWN = "UNKNOWN"


def or_unknown(value: Column) -> Column:
    """Unknown member of a dimension attribute, applied before grouping."""
    return F.coalesce(value, F.lit(UNKNOWN))


def or_zero(value: Column, spark_type: str = "bigint") -> Column:
    return F.coalesce(value, F.lit(0)).cast(spark_type)


def is_active(status: Column) -> Column:
    return F.lower(F.coalesce(status, F.lit(""))) == "active"


def one_of(value: Column, words: Iterable[str]) -> Column:
    """Case-blind membership; a NULL value is not a member."""
    return F.coalesce(F.lower(value).isin(*[w.lower() for w in words]), F.lit(False))


def count_where(predicate: Column) -> Column:
    """Rows for which the predicate holds; 0 when none does."""
    return F.count_if(predicate)


def ratio_pct(
    part: Column, whole: Column, spark_type: str = "decimal(12,4)", first_round: int | None = None
) -> Column:
    """``100 * part / whole``; NULL when whole is zero or absent.

    The quotient keeps all digits and is rounded half-up once, on the cast.
    ``first_round`` rounds to that many digits beforehand, as engines do whose
    decimal division keeps the scale of its arguments.
    """
    base = F.coalesce(whole, F.lit(0)).cast("decimal(20,2)")
    top = (F.coalesce(part, F.lit(0)).cast("decimal(20,2)") * F.lit(100)).cast("decimal(24,2)")
    quotient = F.when(base != 0, top / base)
    if first_round is not None:
        quotient = F.round(quotient, first_round)
    return quotient.cast(spark_type)


def per_entity(amount: Column, entities: Column, spark_type: str = "decimal(18,2)") -> Column:
    """Amount per counted entity; NULL when there is none."""
    n = F.coalesce(entities, F.lit(0)).cast("decimal(20,0)")
    return F.when(n != 0, F.coalesce(amount, F.lit(0)).cast("decimal(20,2)") / n).cast(spark_type)
