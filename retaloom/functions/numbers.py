"""Exact money and guarded ratios."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

MONEY = "decimal(18,2)"


def as_column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def money(c: Column | str) -> Column:
    return as_column(c).cast(MONEY)


def rounded(c: Column | str, digits: int) -> Column:
    """Round a double half-up on its decimal form, so binary ties do not matter."""
    return F.round(as_column(c).cast("decimal(38,10)"), digits).cast("double")


def rounded_money(c: Column) -> Column:
    return F.round(c.cast("decimal(38,10)"), 2).cast(MONEY)


def ratio(num: Column | str, den: Column | str) -> Column:
    """``num / den`` as a double; NULL when ``den`` is zero or NULL."""
    return F.try_divide(as_column(num).cast("double"), as_column(den).cast("double"))


def percent(num: Column | str, den: Column | str, digits: int | None = 2) -> Column:
    value = ratio(num, den) * 100
    return value if digits is None else rounded(value, digits)


def or_zero(c: Column) -> Column:
    return F.coalesce(c, F.lit(0.0))


def count_if(c: Column) -> Column:
    return F.count_if(c)


def total(c: Column | str) -> Column:
    """Exact sum of a money column, handed over as a double."""
    return F.sum(as_column(c)).cast("double")


def mean(c: Column | str) -> Column:
    """Mean as exact sum over count of the non-NULL values."""
    return ratio(F.sum(as_column(c)), F.count(as_column(c)))
