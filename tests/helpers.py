"""Small ledgers written by hand."""

import datetime as dt
from decimal import Decimal

from tallyline import schemas


def day(text):
    return dt.date.fromisoformat(text) if text else None


def ledger(spark, *rows):
    """Rows of (id, date text, amount, category, account)."""
    return spark.createDataFrame(
        [(i, day(d), None if a is None else Decimal(str(a)), c, acc) for i, d, a, c, acc in rows],
        schemas.LEDGER)


def rows(df, *columns):
    return [tuple(r) for r in (df.select(*columns) if columns else df).collect()]


def as_set(df, *columns):
    return set(rows(df, *columns))
