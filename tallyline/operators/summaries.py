"""Gold tables and marts: summaries per day, category, account and month."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyline.functions import money


def _count(name: str = "transaction_count"):
    return F.count(F.lit(1)).alias(name)


def as_double(df: DataFrame, *columns: str) -> DataFrame:
    """Decimal sums -> doubles, for the columns a reader sees."""
    return df.withColumns({c: money.double(c) for c in columns})


def daily_summary(ledger: DataFrame) -> DataFrame:
    sums = ledger.groupBy("date").agg(
        _count(), F.sum("amount").alias("total_amount"),
        *money.signed_sums("total_spending", "total_income"))
    return as_double(sums, "total_amount", "total_spending", "total_income").orderBy("date")


def category_summary(ledger: DataFrame) -> DataFrame:
    """Expenses per category and their share of all expenses (both negative)."""
    sums = ledger.filter("amount < 0").groupBy("category").agg(
        _count(), F.sum("amount").alias("total_spent"))
    everything = F.sum("total_spent").over(Window.partitionBy())  # one row per category
    return sums.select(
        "category", "transaction_count",
        money.double("total_spent").alias("total_spent"),
        money.mean("total_spent", "transaction_count").alias("avg_transaction"),
        (money.double("total_spent") / money.double(everything) * 100)
        .alias("percentage_of_total")).orderBy("total_spent", "category")


def account_balance(ledger: DataFrame, account: str = "account") -> DataFrame:
    sums = ledger.groupBy(F.col(account).alias("account_id")).agg(
        F.sum("amount").alias("current_balance"), _count(),
        *money.signed_sums("total_withdrawals", "total_deposits"))
    return as_double(sums, "current_balance", "total_withdrawals", "total_deposits")


def balance_of(ledger: DataFrame, account: str) -> DataFrame:
    """Balance of one account; the filter reaches the scan."""
    return ledger.filter(F.col("account") == account).groupBy("account").agg(
        money.double(F.sum("amount")).alias("balance"))


def mart_daily(staged: DataFrame) -> DataFrame:
    sums = staged.groupBy("transaction_date").agg(
        _count(), F.sum("amount").alias("net_flow"),
        *money.signed_sums("total_expenses", "total_income"))
    return as_double(
        sums.withColumn("avg_transaction", money.mean("net_flow", "transaction_count")),
        "net_flow", "total_expenses", "total_income")


def mart_category(staged: DataFrame) -> DataFrame:
    sums = staged.groupBy("category").agg(
        _count(), F.sum("amount").alias("total_amount"),
        F.min("amount").alias("min_amount"), F.max("amount").alias("max_amount"),
        F.count_if(F.col("amount") < 0).alias("expense_count"),
        F.count_if(F.col("amount") > 0).alias("income_count"))
    return as_double(
        sums.withColumn("avg_amount", money.mean("total_amount", "transaction_count")),
        "total_amount", "min_amount", "max_amount")


def mart_account(staged: DataFrame) -> DataFrame:
    sums = staged.groupBy("account").agg(
        _count(), F.sum("amount").alias("current_balance"),
        F.min("transaction_date").alias("first_transaction"),
        F.max("transaction_date").alias("last_transaction"))
    return as_double(sums, "current_balance")


def first_of_product(parts: list[tuple[DataFrame, list]], rows: int) -> DataFrame:
    """First ``rows`` rows of the product of several tables, ordered by the sort
    columns of the first table, then the second, and so on.

    Such an order counts like an odometer: row r of the product takes row
    ``r div (sizes of the later tables)`` of a table, modulo its size. So a table
    gives at most its first ``rows`` rows, and equality joins on row numbers replace
    the product. Sizes are scalar subqueries over the same few rows.
    """
    spark = parts[0][0].sparkSession
    heads = [df.orderBy(*order).limit(rows) for df, order in parts]
    sizes = [head.agg(F.count(F.lit(1))).scalar() for head in heads]
    out = spark.range(rows).withColumnRenamed("id", "_r")
    out = out.withColumns({f"_n{k}": size for k, size in enumerate(sizes)})
    out = out.filter(F.col("_r") < reduce(lambda a, b: a * b, [F.col(f"_n{k}") for k in range(len(sizes))]))
    later = F.lit(1)
    for k, (head, (_, order)) in reversed(list(enumerate(zip(heads, parts)))):
        numbered = head.withColumn("_i", F.row_number().over(Window.orderBy(*order)).cast("bigint") - 1)  # at most ``rows`` rows
        place = F.floor(F.col("_r") / later) % F.col(f"_n{k}")
        out = out.withColumn("_i", place).join(numbered, "_i").drop("_i")
        later = later * F.col(f"_n{k}")
    return out.orderBy("_r").drop("_r", *[f"_n{k}" for k in range(len(sizes))])


def financial_dashboard(daily: DataFrame, category: DataFrame, balance: DataFrame,
                        rows: int = 50) -> DataFrame:
    """Latest days x categories x accounts, the first ``rows`` of them."""
    days = daily.select("date", "transaction_count", "total_spending", "total_income")
    spent = category.select("category", F.col("total_spent").alias("category_spending"))
    accounts = balance.select(F.col("account_id").alias("account"), "current_balance")
    product = first_of_product(
        [(days, [F.desc("date")]), (spent, [F.asc("category")]), (accounts, [F.asc("account")])],
        rows)
    return product.select("date", "transaction_count", "total_spending", "total_income",
                          "category", "category_spending", "account", "current_balance")


def financial_summary_mart(staged: DataFrame, rows: int = 100) -> DataFrame:
    days = mart_daily(staged).select(
        "transaction_date", F.col("transaction_count").alias("daily_transactions"),
        "total_expenses", "total_income", "net_flow")
    categories = mart_category(staged).select(
        "category", F.col("total_amount").alias("category_total"))
    accounts = mart_account(staged).select("account", "current_balance")
    product = first_of_product(
        [(days, [F.desc("transaction_date")]),
         (categories, [F.asc("category_total"), F.asc("category")]),
         (accounts, [F.asc("account")])], rows)
    return product.select("transaction_date", "daily_transactions", "total_expenses",
                          "total_income", "net_flow", "category", "category_total",
                          "account", "current_balance")


def monthly_trends(staged: DataFrame) -> DataFrame:
    """Month-over-month expenses per category and account, and for all together.

    The 'All' rows re-aggregate the monthly rows, so the ledger is shuffled once.
    """
    detail = (staged
              .groupBy(F.trunc("transaction_date", "MM").alias("month"), "category", "account")
              .agg(_count(), F.sum("amount").alias("total_amount"),
                   *money.signed_sums("monthly_expenses", "monthly_income")))
    overall = detail.groupBy("month").agg(
        *[F.sum(c).alias(c) for c in ("transaction_count", "total_amount",
                                      "monthly_expenses", "monthly_income")])
    both = (detail.withColumn("_all", F.lit(False)).unionByName(
        overall.withColumns({"category": F.lit("All"), "account": F.lit("All"),
                             "_all": F.lit(True)})))
    # A partition of this window has one row per month.
    previous = F.lag("monthly_expenses").over(
        Window.partitionBy("_all", "category", "account").orderBy("month"))
    change = F.col("monthly_expenses") - F.col("prev_month_expenses")
    rows = both.withColumn("prev_month_expenses", previous).select(
        "month", F.year("month").alias("year"), F.month("month").alias("month_num"),
        "category", "account", "transaction_count", "total_amount", "monthly_expenses",
        "monthly_income", "prev_month_expenses",
        change.alias("expense_change"),
        F.round(money.percent(change, F.abs("prev_month_expenses")), 2)
        .alias("expense_change_percent"))
    return as_double(rows, "total_amount", "monthly_expenses", "monthly_income",
                     "prev_month_expenses", "expense_change").orderBy(
        F.desc("month"), "category", "account")
