"""The benchmark tables in the roles of this engine's inputs.

``orders`` plays the ledger, ``events`` the transaction stream and the news feed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.schemas import MONEY

# Columns of the benchmark tables, so that opening one starts no job.
SCHEMAS = {
    "region": "r_regionkey INT, r_name STRING",
    "nation": "n_nationkey INT, n_name STRING, n_regionkey INT",
    "customer": "c_custkey BIGINT, c_name STRING, c_nationkey INT, c_acctbal DOUBLE, "
                "c_mktsegment STRING",
    "orders": "o_orderkey BIGINT, o_custkey BIGINT, o_orderstatus STRING, o_totalprice DOUBLE, "
              "o_orderdate TIMESTAMP_NTZ, o_orderpriority STRING",
    "events": "event_id BIGINT, ts TIMESTAMP_NTZ, user_id BIGINT, event_type STRING, "
              "value DOUBLE, props STRING",
    "documents": "doc_id BIGINT, text STRING, lang STRING, source STRING, n_chars BIGINT",
}

RESENT_ID_SHIFT = 1_000_000_000_000


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    reader = spark.read.schema(SCHEMAS[name]) if name in SCHEMAS else spark.read
    return reader.parquet(f"{folder}/{name}.parquet")


def _by_value(column: str, names: dict[str, str | None], default: str) -> Column:
    branches = F
    for value, name in names.items():
        branches = branches.when(F.col(column) == value, F.lit(name))
    return branches.otherwise(default)


def _account() -> Column:
    kind = F.col("o_custkey") % 4
    return F.concat(F.when(kind == 0, "Checking_").when(kind == 1, "Savings_")
                    .when(kind == 2, "CreditCard_").otherwise("Business_"),
                    F.col("o_custkey").cast("string"))


def _signed_price() -> Column:
    price = F.col("o_totalprice").cast(MONEY)
    return F.when(F.col("o_orderstatus") == "F", price).otherwise(-price)


def ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as a clean ledger: finished orders are income, others expenses."""
    return _as_ledger(table(spark, folder, "orders"))


def _as_ledger(orders: DataFrame, *more: str) -> DataFrame:
    category = _by_value("o_orderpriority", {
        "1-URGENT": "Salary", "2-HIGH": "Restaurant", "3-MEDIUM": "Electronics",
        "4-NOT SPECIFIED": "Transport"}, "Coffee")
    return orders.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderdate").cast("date").alias("date"),
        _signed_price().cast(MONEY).alias("amount"),
        category.alias("category"),
        _account().alias("account"), *more)


def raw_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as they might land: text dates, untidy and missing categories, and
    pending orders delivered twice."""
    orders = table(spark, folder, "orders")
    category = _by_value("o_orderpriority", {
        "1-URGENT": "Salary", "2-HIGH": "RESTAURANT", "3-MEDIUM": "uber",
        "4-NOT SPECIFIED": None}, "  Coffee ")
    rows = orders.select(
        F.col("o_orderkey").alias("id"),
        F.date_format(F.col("o_orderdate").cast("date"), "yyyy-MM-dd").alias("date"),
        _signed_price().cast(MONEY).alias("amount"),
        category.alias("category"),
        _account().alias("account"),
        F.col("o_orderstatus").alias("status"))
    return rows.unionByName(rows.filter("status = 'P'")).drop("status")


def resent_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """The ledger with pending orders entered again under new ids."""
    orders = table(spark, folder, "orders")
    again = _as_ledger(orders.filter("o_orderstatus = 'P'"))
    return _as_ledger(orders).unionByName(
        again.withColumn("id", F.col("id") + F.lit(RESENT_ID_SHIFT)))


def booked_and_incoming(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """A ledger without open orders, and a batch with pending and open ones, in
    which the open ones come twice."""
    orders = table(spark, folder, "orders")
    booked = _as_ledger(orders.filter("o_orderstatus <> 'O'"))
    incoming = _as_ledger(orders.filter("o_orderstatus <> 'F'"))
    again = _as_ledger(orders.filter("o_orderstatus = 'O'"))
    return booked, incoming.unionByName(again).drop("id")


def transactions(spark: SparkSession, folder: str) -> DataFrame:
    """Events as decoded stream transactions (``ts`` beside the text timestamp)."""
    k = F.from_json("props", "k INT")["k"]
    value = F.col("value").cast(MONEY)
    category = _by_value("event_type", {
        "purchase": "Food", "view": "Entertainment", "click": "Shopping",
        "signup": "Income"}, "Transport")
    return table(spark, folder, "events").select(
        F.col("event_id").alias("transaction_id"),
        F.col("user_id").alias("account_id"),
        F.when(F.col("event_type") == "signup", value).otherwise(-value)
        .cast(MONEY).alias("amount"),
        category.alias("category"),
        F.col("event_type").alias("merchant"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("timestamp"),
        F.when(k < 10, "INTERNATIONAL")
        .otherwise(F.concat(F.lit("NY_"), k.cast("string"))).alias("location"),
        (k >= 95).alias("is_fraudulent"),
        F.col("ts").cast("timestamp").alias("ts"))


def ledger_changes(spark: SparkSession, folder: str) -> DataFrame:
    """Orders as a log of changes: all are inserted; a day later pending ones turn their sign and
    every fifth open one moves to another account; two days later every seventh finished one is deleted."""
    rows = _as_ledger(table(spark, folder, "orders"), "o_orderstatus")
    day = F.col("date").cast("timestamp")

    def change(df: DataFrame, kind: str, days: int, amount: Column, account: Column, old: Column, before: Column) -> DataFrame:
        return df.select("id", "date", amount.cast(MONEY).alias("amount"), "category", account.alias("account"),
                         F.lit(kind).alias("change_type"), (day + F.expr(f"INTERVAL {days} DAYS")).alias("changed_at"),
                         old.cast(MONEY).alias("old_amount"), before.alias("old_account"))

    amount, account, none, nobody = F.col("amount"), F.col("account"), F.lit(None).cast(MONEY), F.lit(None).cast("string")
    return (change(rows, "INSERT", 0, amount, account, none, nobody)
            .unionByName(change(rows.filter("o_orderstatus = 'P'"), "UPDATE", 1, -amount, account, amount, account))
            .unionByName(change(rows.filter("o_orderstatus = 'O' AND id % 5 = 0"), "UPDATE", 1, amount, F.lit("Savings_0"), amount, account))
            .unionByName(change(rows.filter("o_orderstatus = 'F' AND id % 7 = 0"), "DELETE", 2, none, nobody, amount, account)))


def news(spark: SparkSession, folder: str) -> DataFrame:
    """Events as headlines whose time is text with or without fractions of a
    second, or unreadable for errors."""
    seconds = F.date_format("ts", "yyyy-MM-dd HH:mm:ss")
    micros = F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS")
    return table(spark, folder, "events").select(
        F.when(F.col("event_type") == "error", "unknown")
        .when(F.col("event_type") == "click", seconds).otherwise(micros).alias("timestamp"),
        F.concat_ws(" ", F.col("event_type"), F.col("event_id").cast("string")).alias("headline"),
        (F.col("value") / 245 - 1).alias("sentiment"))
