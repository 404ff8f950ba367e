"""Expectations, staging tests and the quality checks of the warehouse table."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions import labels, money
from tallyline.operators.contracts import KNOWN_CATEGORIES


class QualityFailure(RuntimeError):
    """A check that must hold does not."""


@dataclass(frozen=True)
class Expectation:
    """``holds`` must be true for at least ``mostly`` of the rows ``over`` selects."""

    kind: str
    column: str
    over: Column
    holds: Column
    mostly: float = 1.0


def expect_between(column: str, low: float, high: float, mostly: float = 1.0) -> Expectation:
    value = F.col(column)
    return Expectation("between", column, value.isNotNull(), value.between(low, high), mostly)


def expect_not_null(column: str) -> Expectation:
    return Expectation("not_null", column, F.lit(True), F.col(column).isNotNull())


def expect_in_set(column: str, values: list) -> Expectation:
    value = F.col(column)
    return Expectation("in_set", column, value.isNotNull(), value.isin(*values))


def ledger_suite(low: float = -10_000, high: float = 100_000) -> list[Expectation]:
    return [expect_between("amount", low, high, mostly=0.95), expect_not_null("id"),
            expect_not_null("date"), expect_not_null("amount"),
            expect_in_set("category", KNOWN_CATEGORIES)]


def expectation_report(df: DataFrame, suite: list[Expectation]) -> DataFrame:
    """One row per expectation, all counted in one pass. No rows to look at pass."""
    counts = df.agg(*[c for i, e in enumerate(suite) for c in (
        F.count_if(e.over).alias(f"n{i}"), F.count_if(e.over & e.holds).alias(f"k{i}"))])
    lines = []
    for i, e in enumerate(suite):
        rows, met = F.col(f"n{i}"), F.col(f"k{i}")
        share = F.when(rows == 0, 1.0).otherwise(met.cast("double") / rows)
        lines.append(F.struct(
            F.lit(e.kind).alias("expectation"), F.lit(e.column).alias("column_name"),
            rows.alias("checked_rows"), (rows - met).alias("unexpected_rows"),
            (share >= e.mostly).alias("success")))
    return counts.select(F.inline(F.array(*lines)))


STAGED_COLUMNS = ["id", "transaction_date", "amount", "category", "account"]


def staging_tests(staged: DataFrame, unique: str = "id",
                  not_null: list[str] = STAGED_COLUMNS) -> DataFrame:
    """Failures of the unique test (values found more than once) and the not-null tests.

    Null counts need no shuffle; only the unique column is grouped, and a value
    that fills a third of the table reaches the shuffle as one row per task.
    """
    nulls = staged.agg(F.array(*[
        F.struct(F.lit("not_null").alias("test"), F.lit(c).alias("column_name"),
                 F.count_if(F.col(c).isNull()).alias("failures")) for c in not_null])
        .alias("_lines")).select(F.inline("_lines"))
    repeated = (staged.filter(F.col(unique).isNotNull()).groupBy(unique)
                .agg(F.count(F.lit(1)).alias("_n"))
                .agg(F.count_if(F.col("_n") > 1).alias("failures"))
                .select(F.lit("unique").alias("test"), F.lit(unique).alias("column_name"), "failures"))
    return repeated.unionByName(nulls)


def _named_counts(df: DataFrame, checks: dict[str, Column]) -> DataFrame:
    """(check_name, row_count) for counts of one aggregate row."""
    lines = F.array(*[F.struct(F.lit(name).alias("check_name"), count.alias("row_count"))
                      for name, count in checks.items()])
    return df.agg(lines.alias("_lines")).select(F.inline("_lines"))


def completeness(warehouse: DataFrame, as_of: dt.date) -> DataFrame:
    # The names of the checks.
    return _named_counts(warehouse, {
        "Total transaction count": F.count(F.lit(1)),
        "Transactions today": F.count_if(F.col("date_key") == F.lit(as_of)),
        "Null amount check": F.count_if(F.col("amount").isNull()),
        "Null date check": F.count_if(F.col("date_key").isNull()),
        "Null category check": F.count_if(F.col("category").isNull()),
    })


def require_complete(checks: DataFrame) -> None:
    bad = checks.filter(F.col("check_name").startswith("Null") & (F.col("row_count") > 0)).collect()
    if bad:
        raise QualityFailure(f"missing values: {[tuple(r) for r in bad]}")


def accuracy(warehouse: DataFrame, as_of: dt.date) -> DataFrame:
    """Negative balances, future dates, zero amounts and repeated transactions.

    One scan: each row stands in two groupings, by account and by all that makes a
    transaction, both combined map-side; the counts of single rows ride on the first.
    """
    value, repeated = F.col("amount"), ["transaction_id", "amount", "date_key", "category"]
    none = {c: F.lit(None).cast(warehouse.schema[c].dataType) for c in (*repeated, "account")}

    def line(by_account: bool) -> Column:
        keys = [(F.col(c) if (c == "account") == by_account else none[c]).alias(f"k_{c}") for c in ("account", *repeated)]
        measures = ([value, F.col("date_key") > F.lit(as_of), value == 0] if by_account
                    else [F.lit(None).cast(warehouse.schema["amount"].dataType), F.lit(False), F.lit(False)])
        return F.struct(F.lit(by_account).alias("by_account"), *keys, measures[0].alias("value"),
                        measures[1].alias("future"), measures[2].alias("zero"))

    lines = warehouse.select(F.inline(F.array(line(True), line(False))))
    groups = lines.groupBy("by_account", *[f"k_{c}" for c in ("account", *repeated)]).agg(
        F.count(F.lit(1)).alias("n"), F.sum("value").alias("balance"), F.count_if("future").alias("future"), F.count_if("zero").alias("zero"))
    # The names of the checks.
    return _named_counts(groups, {
        "Negative balance accounts": F.count_if(F.col("by_account") & (F.col("balance") < 0)),
        "Future dated transactions": F.coalesce(F.sum("future"), F.lit(0)),
        "Zero amount transactions": F.coalesce(F.sum("zero"), F.lit(0)),
        "Duplicate transactions": F.count_if(~F.col("by_account") & (F.col("n") > 1))})


def freshness(warehouse: DataFrame, as_of: dt.date) -> DataFrame:
    latest = warehouse.agg(F.max("date_key").alias("latest_date"))
    behind = F.datediff(F.lit(as_of), F.col("latest_date"))
    return latest.select(
        "latest_date", F.lit(as_of).alias("today"), behind.alias("days_behind"),
        F.when(behind > 2, "stale").when(behind > 0, "behind").when(behind <= 0, "ok")
        .otherwise("empty").alias("status"))


def require_fresh(check: DataFrame) -> None:
    row = check.first()
    if row.status in ("stale", "empty"):
        raise QualityFailure(f"data is {row.status}: latest date {row.latest_date}")


# Expected types of the warehouse table; a type matches when it contains the text.
WAREHOUSE_TYPES = {
    "transaction_id": "bigint", "date_key": "date", "amount": "decimal", "category": "string",
    "account": "string", "account_type": "string", "year": "int", "month": "int",
    "day": "int", "category_group": "string",
}


def schema_check(df: DataFrame, expected: dict[str, str] = WAREHOUSE_TYPES) -> DataFrame:
    """Status of every column by its type, with its filled rows.

    Columns nobody expects are only pointed out.
    """
    lines = []
    for name, dtype in df.dtypes:
        wanted = expected.get(name)
        status = "unexpected" if wanted is None else "ok" if wanted in dtype else "mismatch"
        lines.append(F.struct(
            F.lit(name).alias("column_name"), F.lit(dtype).alias("actual_type"),
            F.lit(wanted).cast("string").alias("expected_type"), F.lit(status).alias("status"),
            F.count(name).alias("filled_rows")))
    return df.agg(F.array(*lines).alias("_lines")).select(F.inline("_lines"))


def require_schema(df: DataFrame, expected: dict[str, str] = WAREHOUSE_TYPES) -> None:
    wrong = {n: t for n, t in df.dtypes if n in expected and expected[n] not in t}
    if wrong:
        raise QualityFailure(f"unexpected column types: {wrong}")


def quality_report(warehouse: DataFrame, as_of: dt.date) -> DataFrame:
    """Completeness, accuracy and consistency scores.

    Rows are counted per account first. That makes the number of accounts and of
    account types plain counts of the second aggregate, without a distinct.
    """
    amount, date = F.col("amount"), F.col("date_key")
    per_account = warehouse.groupBy("account").agg(
        F.count(F.lit(1)).alias("rows"),
        F.count_if(amount.isNotNull() & date.isNotNull() & F.col("category").isNotNull())
        .alias("complete"),
        F.count_if((amount != 0) & (date <= F.lit(as_of))).alias("valid"))
    sums = per_account.agg(
        F.sum("rows").alias("rows"), F.sum("complete").alias("complete"),
        F.sum("valid").alias("valid"), F.count("account").alias("accounts"),
        F.collect_set(F.when(F.col("account").isNotNull(), labels.account_type(F.col("account"))))
        .alias("types"))  # at most four types
    lines = F.array(*[
        F.struct(F.lit(name).alias("metric_type"),
                 F.round(money.percent(part, whole), 2).alias("score"),
                 F.lit(text).alias("description"))
        for name, part, whole, text in [  # fixed values: metrics and their descriptions
            ("Completeness", F.col("complete"), F.col("rows"), "Percentage of non-null values"),
            ("Accuracy", F.col("valid"), F.col("rows"), "Percentage of valid transactions"),
            ("Consistency", F.size("types"), F.col("accounts"), "Account type consistency")]])
    return sums.select(F.inline(lines))
