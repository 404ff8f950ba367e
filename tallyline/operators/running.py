"""Running balances and patterns along the ledger and along each account."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.functions import fraud, labels, money
from tallyline.operators.ordered import Order, running_sums, trailing
from tallyline.operators.reports import bounded

LEDGER_ORDER = Order("date", "id")
STREAM_ORDER = Order("ts", "transaction_id")
OPENING_BALANCE = 10_000
# Texts of alerts.
FREQUENT_SPENDING = "High frequency large spending in "
UNUSUAL_AMOUNT = "Amount (%.2f) is unusual (mean: %.2f, std: %.2f)"

_RUNNING = ["running_balance", "cumulative_expenses", "cumulative_income"]


def running_analytics(ledger: DataFrame, rows_per_segment: int | None = None) -> DataFrame:
    """Balance, expenses, income and row number over the whole ledger, in order."""
    sums = running_sums(
        ledger.filter(F.col("date").isNotNull()), [], LEDGER_ORDER,
        {"running_balance": F.col("amount"),
         "cumulative_expenses": money.expense(),
         "cumulative_income": money.income(),
         "transaction_number": F.lit(1).cast("bigint")}, rows_per_segment)
    return sums.select("id", "date", "amount", "category", "account",
                       *[money.double(c).alias(c) for c in _RUNNING], "transaction_number")


def recent_transactions(ledger: DataFrame, limit: int = 10) -> DataFrame:
    """Latest rows with the running sums they end on.

    The sums after the latest row are the totals of the ledger, and each earlier
    row lacks what the newer ones added; so one aggregate and one top-n do, and
    the ledger is not sorted.
    """
    bounded("limit", limit, 1, 100)
    dated = ledger.filter(F.col("date").isNotNull())
    steps = {"running_balance": F.col("amount"), "cumulative_expenses": money.expense(),
             "cumulative_income": money.income()}
    totals = dated.agg(F.struct(*[F.sum(step).alias(n) for n, step in steps.items()]).alias("t"))
    newest_first = [F.desc("date"), F.desc("id")]
    newer = (Window.orderBy(*newest_first)  # at most ``limit`` rows
             .rowsBetween(Window.unboundedPreceding, -1))
    latest = dated.orderBy(*newest_first).limit(limit)
    zero = F.lit(0).cast("decimal(12,2)")
    return (latest.withColumns({f"_{n}": F.coalesce(F.sum(step).over(newer), zero)
                                for n, step in steps.items()})
            .withColumn("_t", totals.scalar())
            .select("id", "date", money.double("amount").alias("amount"), "category", "account",
                    *[money.double(F.col(f"_t.{n}") - F.col(f"_{n}")).alias(n) for n in _RUNNING])
            .orderBy(*newest_first))


def account_running_balance(transactions: DataFrame, opening: int = OPENING_BALANCE,
                            order: Order = STREAM_ORDER, account: str = "account_id",
                            rows_per_segment: int | None = None) -> DataFrame:
    """Balance of the account after each transaction, from an opening balance."""
    sums = running_sums(transactions, [account], order, {"balance": F.col("amount")},
                        rows_per_segment)
    return sums.withColumn("balance", money.double(F.col("balance") + F.lit(opening)))


def pattern_anomalies(transactions: DataFrame, limit: float = -200, rows: int = 10,
                      at_least: int = 5, rows_per_segment: int | None = None) -> DataFrame:
    """Transactions at which the mean of the last ``rows`` amounts of the same
    account and category falls below ``limit``."""
    seen = trailing(transactions, ["account_id", "category"], STREAM_ORDER, rows,
                    {"pattern_count": F.lit(1).cast("bigint"), "_sum": F.col("amount")},
                    rows_per_segment)
    mean = money.mean("_sum", "pattern_count")
    return (seen.withColumn("pattern_mean", mean).drop("_sum")
            .filter((F.col("pattern_count") >= at_least) & (F.col("pattern_mean") < limit))
            .withColumn("anomaly", F.concat(F.lit(FREQUENT_SPENDING), F.col("category"))))


@dataclass(frozen=True)
class SoFar:
    """What a stream has come to: totals, and balances of the accounts that came first."""

    transactions: int = 0
    active_accounts: int = 0
    fraud_alerts: int = 0
    first_accounts: tuple = ()
    balances: tuple = ()


def stream_summary(transactions: DataFrame, every: int = 10, opening: int = OPENING_BALANCE,
                   limits: fraud.FraudLimits = fraud.FraudLimits(), sampled: int = 3,
                   rows_per_segment: int | None = None) -> DataFrame:
    """State of the stream after every ``every`` transactions: transactions, accounts
    and fraud alerts so far, and balances of the accounts that came first."""
    first = first_transactions(transactions)
    early = first.orderBy("_first").limit(sampled).select(  # at most ``sampled`` rows
        "account_id", F.row_number().over(Window.orderBy("_first")).alias("_slot"))
    return summaries_of(transactions, first, early, SoFar(), every, opening, limits, sampled, rows_per_segment)


def first_transactions(transactions: DataFrame) -> DataFrame:
    """(account_id, _first): time and id of the first transaction of each account."""
    return transactions.groupBy("account_id").agg(F.min(F.struct("ts", "transaction_id")).alias("_first"))


def summaries_of(transactions: DataFrame, new: DataFrame, early: DataFrame, so_far: SoFar, every: int = 10,
                 opening: int = OPENING_BALANCE, limits: fraud.FraudLimits = fraud.FraudLimits(), sampled: int = 3,
                 rows_per_segment: int | None = None) -> DataFrame:
    """Summaries over ``transactions`` that follow on what came ``so_far``; ``new`` are accounts
    seen for the first time, ``early`` (account_id, _slot) those whose balances are shown."""
    # The opening of an account is a row of its own, in front of the account's first transaction.
    opened = new.select("account_id", "_first.ts", "_first.transaction_id", F.lit(False).alias("_real"))
    rows = (transactions.withColumn("_real", F.lit(True)).unionByName(opened, allowMissingColumns=True)
            .join(F.broadcast(early), "account_id", "left"))
    slots = range(1, sampled + 1)
    real, zero = F.col("_real"), F.lit(0).cast("bigint")
    alert = real & F.coalesce(fraud.additive_score(limits) > 50, F.lit(False))
    sums = running_sums(
        rows, [], Order(STREAM_ORDER.by, STREAM_ORDER.tie, ("_real",)),
        {"transactions": F.when(real, 1).otherwise(0).cast("bigint"),
         "active_accounts": F.when(real, zero).otherwise(F.lit(1).cast("bigint")),
         "fraud_alerts": F.when(alert, 1).otherwise(0).cast("bigint"),
         **{f"balance_{i}": F.when(F.col("_slot") == i, F.col("amount")) for i in slots}}, rows_per_segment)

    def balance(slot: int) -> Column:
        here = F.col(f"balance_{slot}")
        if slot <= len(so_far.balances):
            return F.coalesce(here, F.lit(0)) + F.lit(so_far.balances[slot - 1])
        return here + F.lit(opening)

    counts = [(F.col(n) + F.lit(getattr(so_far, n))).cast("bigint").alias(n) for n in ("transactions", "active_accounts", "fraud_alerts")]
    return sums.filter("_real").select(*counts, *[money.double(balance(i)).alias(f"balance_{i}") for i in slots]).filter(
        F.col("transactions") % every == 0)


def final_stream_summary(transactions: DataFrame, alerts: int = 3,
                         limits: fraud.FraudLimits = fraud.FraudLimits()) -> dict[str, DataFrame]:
    """Totals over all transactions and the last alerts."""
    scored = transactions.withColumn("score", fraud.additive_score(limits))
    return {
        "totals": scored.agg(F.count(F.lit(1)).alias("transactions"),
                             F.count_distinct("account_id").alias("accounts"),
                             F.count_if(F.col("score") > 50).alias("fraud_alerts")),
        "last_alerts": (scored.filter(F.col("score") > 50)
                        .orderBy(F.desc("ts"), F.desc("transaction_id")).limit(alerts)
                        .select("transaction_id", "score", fraud.reasons(limits).alias("reasons"))),
    }


def changed_amounts(changes: DataFrame) -> DataFrame:
    """(id, account, ts, amount, change_type): what each change adds to the balance of an account.

    Plain ledger rows are inserts at their date. With ``change_type`` (INSERT, UPDATE, DELETE)
    come ``changed_at`` and the row before it (old_amount, old_account); an update that moves
    a row between accounts is two lines.
    """
    if "change_type" not in changes.columns:
        return changes.select("id", "account", F.col("date").cast("timestamp").alias("ts"), "amount", F.lit("INSERT").alias("change_type"))
    kind, amount, old = F.col("change_type"), F.col("amount"), F.col("old_amount")

    def line(account: Column, value: Column) -> Column:
        return F.struct(account.alias("account"), value.cast("decimal(12,2)").alias("amount"))

    lines = (F.when(kind == "INSERT", F.array(line(F.col("account"), amount)))
             .when(kind == "DELETE", F.array(line(F.col("old_account"), -old)))
             .when(F.col("account") == F.col("old_account"), F.array(line(F.col("account"), amount - old)))
             .otherwise(F.array(line(F.col("old_account"), -old), line(F.col("account"), amount))))
    return changes.select("id", F.col("changed_at").alias("ts"), "change_type", F.explode(lines).alias("l")).select(
        "id", "l.account", "ts", "l.amount", "change_type")


def balance_changes(changes: DataFrame, rows_per_segment: int | None = None) -> DataFrame:
    """Change events: every change of the ledger with the balance of its account after it."""
    sums = running_sums(changed_amounts(changes), ["account"], Order("ts", "id"), {"new_balance": F.col("amount")},
                        rows_per_segment)
    return sums.select(
        "account", F.col("id").alias("transaction_id"),
        F.date_format("ts", "yyyy-MM-dd").alias("transaction_date"),
        money.double("amount").alias("transaction_amount"),
        money.double("new_balance").alias("new_balance"), "change_type")


def fraud_by_first_match(transactions: DataFrame,
                         limits: fraud.FraudLimits = fraud.FraudLimits()) -> DataFrame:
    return (transactions.withColumn("fraud_risk_score", fraud.first_match_score(limits))
            .withColumn("fraud_alert", fraud.alert_level(F.col("fraud_risk_score"))))


def fraud_by_sum(transactions: DataFrame,
                 limits: fraud.FraudLimits = fraud.FraudLimits()) -> DataFrame:
    return (transactions.withColumns({"fraud_score": fraud.additive_score(limits),
                                      "reasons": fraud.reasons(limits)})
            .withColumn("is_alert", F.col("fraud_score") > 50))


def unusual_amounts(ledger: DataFrame, deviations: float = 2) -> DataFrame:
    """Rows further than ``deviations`` standard deviations from the mean amount.

    A missing amount counts as 0. Mean and deviation come from one scalar
    subquery; the rows themselves are not shuffled.
    """
    amount = money.double(F.coalesce("amount", F.lit(0).cast("decimal(12,2)")))
    figures = ledger.agg(F.struct(F.avg(amount).alias("mean"),
                                  F.stddev_pop(amount).alias("std")).alias("s"))
    rows = ledger.withColumn("_s", figures.scalar())
    reason = F.format_string(UNUSUAL_AMOUNT,
                             amount, F.col("_s.mean"), F.col("_s.std"))
    return (rows.filter(F.abs(amount - F.col("_s.mean")) > deviations * F.col("_s.std"))
            .withColumn("anomaly_reason", reason).drop("_s"))


def categorize_text(texts: DataFrame, text: str = "text", amount: str = "amount") -> DataFrame:
    """Category of free text by keywords; the whole text is searched."""
    lowered = texts.withColumn("_lower", F.lower(text))
    return (lowered.withColumn("category", labels.category_of_text(F.col("_lower"), F.col(amount)))
            .drop("_lower"))
