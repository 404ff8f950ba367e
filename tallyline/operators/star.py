"""Star schema: dimensions, fact table and the denormalised warehouse table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.functions import labels, money, periods
from tallyline.operators.keys import Dimension, dense_keys


def dim_date(ledger: DataFrame) -> DataFrame:
    """Distinct days with their calendar parts, derived after the distinct."""
    dow = periods.day_of_week("date_key")
    return ledger.select(F.col("date").alias("date_key")).distinct().select(
        "date_key",
        F.year("date_key").alias("year"),
        F.month("date_key").alias("month"),
        F.dayofmonth("date_key").alias("day"),
        F.quarter("date_key").alias("quarter"),
        dow.alias("day_of_week"),
        labels.day_type(dow).alias("day_type"))


def _members(names: DataFrame, column: str, default: str) -> DataFrame:
    """Distinct names and the default member, once even if the data has it too."""
    extra = names.sparkSession.range(1).select(F.lit(default).alias(column))
    return names.unionByName(extra).distinct()


def _category_names(ledger: DataFrame) -> DataFrame:
    return _members(ledger.select(F.col("category").alias("category_name")), "category_name", "Unknown")


def _account_names(ledger: DataFrame) -> DataFrame:
    return _members(ledger.select(F.col("account").alias("account_name")), "account_name", "Unknown")


def _merchant_names(ledger: DataFrame) -> DataFrame:
    merchants = ledger.filter(labels.is_merchant(F.col("category")))
    return _members(merchants.select(F.col("category").alias("merchant_name")), "merchant_name", "Other")


#: Names of each dimension, and the attribute that follows from a name.
DIMENSIONS = {
    "category": (_category_names, "category_group", labels.category_group),
    "account": (_account_names, "account_type", labels.account_type),
    "merchant": (_merchant_names, "merchant_type", labels.merchant_type),
}


def dimensions(ledger: DataFrame, wanted: tuple[str, ...] = tuple(DIMENSIONS)) -> dict[str, Dimension]:
    """The wanted dimensions with dense keys, numbered together."""
    built = dense_keys({name: (DIMENSIONS[name][0](ledger), f"{name}_name", f"{name}_id") for name in wanted})
    out = {}
    for name, dim in built.items():
        _, attribute, label = DIMENSIONS[name]
        out[name] = Dimension(dim.frame.withColumn(attribute, label(F.col(f"{name}_name"))), dim.rows)
    return out


def dim_category(ledger: DataFrame) -> Dimension:
    return dimensions(ledger, ("category",))["category"]


def dim_account(ledger: DataFrame) -> Dimension:
    return dimensions(ledger, ("account",))["account"]


def dim_merchant(ledger: DataFrame) -> Dimension:
    return dimensions(ledger, ("merchant",))["merchant"]


@dataclass(frozen=True)
class Star:
    """The keyed dimensions of one ledger. Days need no surrogate: a date is its key."""

    category: Dimension
    account: Dimension
    merchant: Dimension


def build_star(ledger: DataFrame) -> Star:
    return Star(**dimensions(ledger))


def keyed(ledger: DataFrame, star: Star, used: tuple[str, ...] = tuple(DIMENSIONS)) -> DataFrame:
    """Ledger rows with surrogate key and attribute of each dimension, in one join for
    each; unmatched and NULL names keep a NULL key.

    The planner broadcasts a stored dimension that is small enough in bytes; else both
    sides are shuffled and adaptive execution splits skewed keys.
    """
    out = ledger
    for name in used:
        dim = getattr(star, name).frame
        source = "account" if name == "account" else "category"
        out = out.join(dim.select(f"{name}_id", DIMENSIONS[name][1], F.col(f"{name}_name").alias(source)), source, "left")
    return out


FACT = ["transaction_id", "transaction_date", "date_key", "category_id", "account_id", "merchant_id",
        "amount", "transaction_type", "absolute_amount"]


def _facts(rows: DataFrame) -> DataFrame:
    return rows.withColumns({
        "transaction_id": F.col("id"), "transaction_date": F.col("date"), "date_key": F.col("date"),
        "transaction_type": labels.transaction_type(F.col("amount")), "absolute_amount": F.abs("amount")})


def fact_transactions(ledger: DataFrame, star: Star) -> DataFrame:
    """Ledger rows with surrogate keys.

    The date dimension holds every ledger date under itself, so its key needs no
    join. Row order is left to the writer.
    """
    return _facts(keyed(ledger, star)).select(*FACT)


def warehouse_transactions(ledger: DataFrame, star: Star, size_scale: int = 1) -> DataFrame:
    """Fact rows with the attributes of their dimensions."""
    return _facts(keyed(ledger, star)).select(
        *FACT, F.year("date_key").alias("year"), F.month("date_key").alias("month"),
        periods.day_of_week("date_key").alias("day_of_week"),
        "category_group", "account_type", "merchant_type",
        labels.size_class(F.col("amount"), size_scale).alias("amount_category"))


def warehouse(ledger: DataFrame, size_scale: int = 1) -> DataFrame:
    """The warehouse table without surrogate keys, straight from the ledger.

    Every dimension attribute is a function of the name it describes, so reports
    that do not need the keys skip all joins and shuffles of the star.
    """
    category, account = F.col("category"), F.col("account")
    return ledger.select(
        F.col("id").alias("transaction_id"),
        F.col("date").alias("date_key"),
        "amount", "category", "account",
        F.year("date").alias("year"),
        F.month("date").alias("month"),
        periods.day_of_week("date").alias("day_of_week"),
        F.when(category.isNotNull(), labels.category_group(category)).alias("category_group"),
        F.when(account.isNotNull(), labels.account_type(account)).alias("account_type"),
        F.when(labels.is_merchant(category), labels.merchant_type(category)).alias("merchant_type"),
        labels.size_class(F.col("amount"), size_scale).alias("amount_category"))


def star_query(ledger: DataFrame, star: Star) -> DataFrame:
    """Totals by month, category group and account type; rows without a member of both are left out."""
    amount = F.col("absolute_amount")
    zero = F.lit(0).cast("decimal(12,2)")
    return (_facts(keyed(ledger, star, ("category", "account")))
            .filter("category_id IS NOT NULL AND account_id IS NOT NULL AND date_key IS NOT NULL")
            .groupBy(F.year("date_key").alias("year"), F.month("date_key").alias("month"),
                     "category_group", "account_type")
            .agg(F.count(F.lit(1)).alias("transaction_count"),
                 money.double(F.sum("amount")).alias("net_amount"),
                 money.double(F.sum(F.when(F.col("transaction_type") == "Expense", amount)
                                    .otherwise(zero))).alias("total_expenses"),
                 money.double(F.sum(F.when(F.col("transaction_type") == "Income", amount)
                                    .otherwise(zero))).alias("total_income"))
            .orderBy(F.desc("year"), F.desc("month"), F.desc("total_expenses"),
                     "category_group", "account_type"))
