"""Column expressions for sums, shares and rounding."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def stable_round(value: Column, digits: int) -> Column:
    """Round after dropping the float noise a distributed sum carries beyond 6 digits.

    Stays in double: amounts reach 1e73, past any decimal type.
    """
    return F.round(F.round(value, 6), digits)


def billions(total: Column) -> Column:
    return stable_round(total / F.lit(1e9), 3)


def count_where(condition: str) -> Column:
    """Rows of the group that meet an SQL condition; NULL does not."""
    return F.count_if(F.expr(condition))


def percent_where(condition: str) -> Column:
    """Share of the group's rows that meet an SQL condition, in percent with one digit."""
    return stable_round(count_where(condition) * F.lit(100.0) / F.count("*"), 1)


def or_zero(value: Column) -> Column:
    return F.coalesce(value, F.lit(0))


def or_false(flag: Column) -> Column:
    return F.coalesce(flag, F.lit(False))


def null_safe_sum(value: Column) -> Column:
    """Sum in which a missing amount counts as zero."""
    return F.sum(or_zero(value))
