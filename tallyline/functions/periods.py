"""Date ranges relative to an explicit ``as_of`` day.

Ranges are closed-open comparisons on the bare date column, so that they reach
the file scan and prune month partitions.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F


def month_start(day: dt.date, back: int = 0) -> dt.date:
    """First day of the month ``back`` months before the month of ``day``."""
    index = day.year * 12 + day.month - 1 - back
    return dt.date(index // 12, index % 12 + 1, 1)


def between(date: str, start: dt.date, end: dt.date) -> Column:
    """start <= date < end."""
    return (F.col(date) >= F.lit(start)) & (F.col(date) < F.lit(end))


def in_month(date: str, as_of: dt.date, back: int = 0) -> Column:
    return between(date, month_start(as_of, back), month_start(as_of, back - 1))


def in_year(date: str, year: int) -> Column:
    return between(date, dt.date(year, 1, 1), dt.date(year + 1, 1, 1))


def trailing_days(date: str, as_of: dt.date, days: int) -> Column:
    """From ``days`` days before ``as_of`` on; later rows are kept as well."""
    return F.col(date) >= F.lit(as_of - dt.timedelta(days=days))


def days_before(date: str, as_of: dt.date, days: int) -> Column:
    """The ``days`` days that come before the trailing ones."""
    return between(date, as_of - dt.timedelta(days=2 * days), as_of - dt.timedelta(days=days))


def trailing_months(date: str, as_of: dt.date, months: int) -> Column:
    return F.col(date) >= F.add_months(F.lit(as_of), -months)


def on_previous_day(date: str, as_of: dt.date) -> Column:
    return F.col(date) == F.lit(as_of - dt.timedelta(days=1))


def day_of_week(date: str | Column) -> Column:
    """Sunday = 0 .. Saturday = 6."""
    return F.dayofweek(date) - 1


def month_of(date: str) -> Column:
    return F.trunc(date, "MM")


def year_month_text(date: str) -> Column:
    return F.date_format(date, "yyyy-MM")
