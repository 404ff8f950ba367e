"""Raw rows -> typed, labelled, de-duplicated rows."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.functions import labels
from tallyline.schemas import MONEY

NEWS_TIME_FORMATS = ("yyyy-MM-dd HH:mm:ss.SSSSSS", "yyyy-MM-dd HH:mm:ss")
NATURAL_KEY = ["date", "amount", "category", "account"]


def as_date(df: DataFrame, name: str) -> Column:
    """Date from text (yyyy-MM-dd, unreadable text gives NULL), a time or a date."""
    if isinstance(df.schema[name].dataType, T.StringType):
        return F.try_to_timestamp(name, F.lit("yyyy-MM-dd")).cast("date")
    return F.col(name).cast("date")


def silver_transactions(raw: DataFrame) -> DataFrame:
    """Drop full-row duplicates, type the columns, clean the category, name the keys."""
    return raw.distinct().select(
        as_date(raw, "date").alias("date"),
        F.col("amount").try_cast("double").alias("amount"),
        labels.remap_category(F.col("category")).alias("category"),
        F.col("id").cast("string").alias("transaction_id"),
        F.col("account").alias("account_id"))


def silver_news(raw: DataFrame, as_of: dt.datetime | None = None) -> DataFrame:
    """Parse the publication time row by row, type the score, drop incomplete rows.

    ``as_of`` stands in where the feed has no time column at all.
    """
    if "timestamp" not in raw.columns:
        if as_of is None:
            raise ValueError("a feed without a timestamp column needs as_of")
        published = F.lit(as_of)
    elif isinstance(raw.schema["timestamp"].dataType, T.StringType):
        published = F.coalesce(*[F.try_to_timestamp("timestamp", F.lit(f))
                                 for f in NEWS_TIME_FORMATS])
    else:
        published = F.col("timestamp")
    typed = raw.withColumns({"published_at": published,
                             "sentiment_score": F.col("sentiment").try_cast("double")})
    return typed.na.drop("any").select("published_at", "headline", "sentiment_score")


def staged_transactions(raw: DataFrame) -> DataFrame:
    """Rows with a readable date and amount and a category, trimmed, one per natural key.

    Of rows that agree in all four values the smallest id stays. All other output
    columns are the key itself, so a minimum aggregated map-side does what a
    ranking window would, and a key sent a billion times shuffles as one row.
    """
    cleaned = raw.select(
        "id",
        as_date(raw, "date").alias("transaction_date"),
        F.col("amount").try_cast(MONEY).alias("amount"),
        F.trim("category").alias("category"),
        F.trim("account").alias("account")).filter(
            "transaction_date IS NOT NULL AND amount IS NOT NULL AND category IS NOT NULL")
    return (cleaned.groupBy("transaction_date", "amount", "category", "account")
            .agg(F.min("id").alias("id"))
            .select("id", "transaction_date", "amount", "category", "account"))


def explode_payload(payloads: DataFrame) -> DataFrame:
    """API answers -> statement rows; the description serves as category. A date or
    amount that cannot be read is NULL; ``unreadable`` picks such rows out."""
    return (payloads.select(F.explode("transactions").alias("t"))
            .select(F.try_to_timestamp("t.date", F.lit("yyyy-MM-dd")).cast("date").alias("date"),
                    F.col("t.amount").try_cast(MONEY).alias("amount"),
                    F.col("t.description").alias("category"),
                    F.col("t.account").alias("account")))


def unreadable(rows: DataFrame, *needed: str) -> DataFrame:
    """Rows that lack one of the ``needed`` values, for a report or a side output."""
    missing = F.lit(False)
    for name in needed:
        missing = missing | F.col(name).isNull()
    return rows.filter(missing)


def new_rows(incoming: DataFrame, booked: DataFrame, keys: list[str] = NATURAL_KEY,
             null_safe: bool = False) -> DataFrame:
    """Rows of ``incoming`` not booked yet, each once.

    Keys compare as in SQL: a NULL equals nothing, so a row with a NULL key always
    counts as new, and repeats of it stay. ``null_safe`` makes NULLs equal.
    Booked keys are reduced to distinct ones before the join, on the same hash
    partitioning the join needs, so a key booked many times costs one row.
    """
    known = booked.select(*keys).distinct()
    if null_safe:
        left, right = incoming.dropDuplicates(keys).alias("i"), known.alias("b")
        same = [F.col(f"i.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
        return left.join(right, same, "left_anti")
    complete = F.lit(True)
    for k in keys:
        complete = complete & F.col(k).isNotNull()
    # Of rows with equal complete keys the smallest stays; a row with a NULL key has a number of its own.
    rest = [c for c in incoming.columns if c not in keys]
    own = F.when(~complete, F.monotonically_increasing_id())
    marked = incoming.withColumn("_own", own)
    first = marked.groupBy(*keys, "_own").agg(F.min(F.struct(*rest)).alias("_rest")) if rest else marked.groupBy(*keys, "_own").agg(F.count(F.lit(1)))
    return (first.join(known, keys, "left_anti")
            .select(*[F.col(f"_rest.{c}").alias(c) if c in rest else F.col(c) for c in incoming.columns]))


def stamped(df: DataFrame, name: str, at: dt.datetime | None = None) -> DataFrame:
    """Add the time of loading, the same for all rows of one run."""
    return df.withColumn(name, F.lit(at) if at else F.current_timestamp())
