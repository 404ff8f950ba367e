"""Money arithmetic. Sums stay decimal; doubles appear only in the final select."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def expense(amount: str | Column = "amount") -> Column:
    """The amount where it is negative, else 0, so that an empty sum is 0."""
    c = _col(amount)
    return F.when(c < 0, c).otherwise(F.lit(0).cast("decimal(12,2)"))


def income(amount: str | Column = "amount") -> Column:
    c = _col(amount)
    return F.when(c > 0, c).otherwise(F.lit(0).cast("decimal(12,2)"))


def double(value: str | Column) -> Column:
    return _col(value).cast("double")


def mean(total: str | Column, count: str | Column) -> Column:
    """Mean from an exact sum and a count; NULL over no rows."""
    return double(total) / F.nullif(double(count), F.lit(0.0))


def rounded_mean(total: str | Column, count: str | Column, digits: int = 2) -> Column:
    """Mean of exact sums, divided and rounded as decimals, so that halves round
    up whatever their nearest double is."""
    divisor = F.nullif(_col(count).cast("decimal(20,0)"), F.lit(0).cast("decimal(20,0)"))
    return double(F.round(_col(total) / divisor, digits))


def percent(part: str | Column, whole: str | Column) -> Column:
    """``part`` in percent of ``whole``; NULL when the divisor is 0."""
    return double(part) * 100.0 / F.nullif(double(whole), F.lit(0.0))


def savings_rate(earned: Column, spent: Column) -> Column:
    """Share of income not spent, in percent; 0 without income."""
    return F.when(earned > 0, (earned - spent) / earned * 100.0).otherwise(0.0)


def signed_sums(expenses: str, earnings: str, amount: str = "amount") -> list[Column]:
    """The pair of sums nearly every report carries."""
    return [F.sum(expense(amount)).alias(expenses), F.sum(income(amount)).alias(earnings)]


def clamp(value: Column, low: Column, high: Column) -> Column:
    return F.least(F.greatest(value, low), high)


def _col(value: str | Column) -> Column:
    return F.col(value) if isinstance(value, str) else value
