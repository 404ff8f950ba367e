"""Reports over the warehouse table and the ledger.

Every report that speaks of "today" takes it as ``as_of``.
"""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.functions import labels, money, periods
from tallyline.operators.summaries import as_double

GROUP = ["year", "month", "category_group", "account_type"]


def _count(name: str = "transaction_count") -> Column:
    return F.count(F.lit(1)).alias(name)


def bounded(name: str, value: int, low: int, high: int) -> int:
    """Check a request parameter."""
    if isinstance(value, bool) or not isinstance(value, int) or not low <= value <= high:
        raise ValueError(f"{name} must be a whole number from {low} to {high}, got {value!r}")
    return value


def first_rows(df: DataFrame, order: list[str], rows: int = 5) -> DataFrame:
    """The first rows in order, as a top-n without a full sort."""
    return df.orderBy(*order).limit(rows)


def last_rows(df: DataFrame, order: list[str], rows: int = 5) -> DataFrame:
    """The last rows, in ascending order."""
    return df.orderBy(*[F.desc(c) for c in order]).limit(rows).orderBy(*order)


# --- over the warehouse table -------------------------------------------------


def running_totals(warehouse: DataFrame, rows: int | None = 10) -> DataFrame:
    """Daily totals with running balance, mean of the last 7 present days and rank.

    The ledger shrinks to one row per calendar day before any window runs.
    """
    daily = warehouse.groupBy("date_key").agg(F.sum("amount").alias("daily_amount"), _count())
    by_day = Window.orderBy("date_key")
    week = by_day.rowsBetween(-6, Window.currentRow)
    out = daily.select(
        "date_key", money.double("daily_amount").alias("daily_amount"), "transaction_count",
        money.double(F.sum("daily_amount").over(by_day)).alias("running_balance"),
        money.mean(F.sum("daily_amount").over(week), F.count("daily_amount").over(week))
        .alias("weekly_moving_avg"),
        F.rank().over(Window.orderBy(F.desc("daily_amount"))).alias("daily_rank"))
    out = out.orderBy("date_key")
    return out.limit(rows) if rows else out


def having_report(warehouse: DataFrame, year: int, groups: tuple[str, ...] = (
        "Dining", "Retail", "Transportation"), more_than: int = 2) -> DataFrame:
    """Expenses of a year per month, group and account type, small groups left out."""
    chosen = warehouse.filter(periods.in_year("date_key", year) & (F.col("amount") < 0)
                              & F.col("category_group").isin(*groups))
    sums = (chosen.groupBy(*GROUP)
            .agg(_count(), F.sum("amount").alias("total_amount"),
                 F.min("amount").alias("min_amount"), F.max("amount").alias("max_amount"))
            .filter(F.col("transaction_count") > more_than)
            .withColumn("avg_amount", money.mean("total_amount", "transaction_count")))
    return as_double(sums, "total_amount", "min_amount", "max_amount").orderBy(
        "total_amount", *GROUP)


def monthly_financial_summary(warehouse: DataFrame) -> DataFrame:
    """The stored summary that other reports read instead of the warehouse table.

    Sums stay decimal here, so that summing them up again stays exact.
    """
    return (warehouse.groupBy(*GROUP)
            .agg(_count(), F.sum("amount").alias("net_amount"),
                 *money.signed_sums("total_expenses", "total_income"),
                 F.min("date_key").alias("first_date"), F.max("date_key").alias("last_date"))
            .withColumn("avg_transaction", money.mean("net_amount", "transaction_count")))


def monthly_view_report(summary: DataFrame, year: int, rows: int = 15) -> DataFrame:
    return (summary.filter(F.col("year") == year)
            .orderBy("year", "month", "category_group", "account_type").limit(rows)
            .select("year", "month", "category_group",
                    F.round(money.double("total_expenses"), 2).alias("expenses"),
                    F.round(money.double("total_income"), 2).alias("income"),
                    F.round(money.double("net_amount"), 2).alias("net"),
                    "transaction_count"))


def warehouse_scalars(warehouse: DataFrame) -> DataFrame:
    """Four figures in one pass."""
    spent = F.when(F.col("amount") < 0, F.col("amount"))
    return warehouse.agg(
        _count(), F.sum(spent).alias("_spent"), F.count(spent).alias("_n"),
        F.count_distinct("account_type").alias("account_types"),
        F.sum(F.when(F.col("amount") > 0, F.col("amount"))).alias("total_income"),
    ).select("transaction_count", money.mean("_spent", "_n").alias("avg_expense"),
             "account_types", money.double("total_income").alias("total_income"))


def year_totals(warehouse: DataFrame, year: int) -> DataFrame:
    """Expenses of a year per month and group, from the base rows."""
    sums = (warehouse.filter(periods.in_year("date_key", year) & (F.col("amount") < 0))
            .groupBy("year", "month", "category_group").agg(F.sum("amount").alias("total")))
    return as_double(sums, "total").orderBy("total", "month", "category_group")


def year_totals_from_summary(summary: DataFrame, year: int) -> DataFrame:
    """The same answer from the stored summary, rolled up over account types."""
    sums = (summary.filter((F.col("year") == year) & (F.col("total_expenses") < 0))
            .groupBy("year", "month", "category_group")
            .agg(F.sum("total_expenses").alias("total")))
    return as_double(sums, "total").orderBy("total", "month", "category_group")


def daily_report(warehouse: DataFrame, as_of: dt.date) -> DataFrame:
    sums = (warehouse.filter(periods.on_previous_day("date_key", as_of))
            .groupBy(F.col("date_key").alias("date"))
            .agg(_count(), F.sum("amount").alias("net_amount"),
                 *money.signed_sums("total_expenses", "total_income")))
    return as_double(sums, "net_amount", "total_expenses", "total_income")


def monthly_report(warehouse: DataFrame, as_of: dt.date) -> DataFrame:
    """The summary of the month before ``as_of``."""
    month = warehouse.filter(periods.in_month("date_key", as_of, back=1))
    return as_double(monthly_financial_summary(month),
                     "net_amount", "total_expenses", "total_income").orderBy(
        F.desc("total_expenses"), "category_group", "account_type")


def monthly_insights(warehouse: DataFrame, as_of: dt.date) -> DataFrame:
    """Share of each category group in last month's expenses."""
    sums = (warehouse.filter(periods.in_month("date_key", as_of, back=1))
            .groupBy("category_group").agg(F.sum(money.expense()).alias("monthly_expenses")))
    total = F.sum("monthly_expenses").over(Window.partitionBy())  # one row per group
    return sums.select(
        "category_group", money.double("monthly_expenses").alias("monthly_expenses"),
        F.round(money.percent("monthly_expenses", total), 2).alias("percentage"),
    ).orderBy("monthly_expenses", "category_group")


def budget_vs_actual(budget: DataFrame, warehouse: DataFrame, as_of: dt.date) -> DataFrame:
    """Budget and expenses of last month per category group, either may be missing."""
    month = periods.month_start(as_of, 1)
    planned = (budget.filter((F.col("year") == month.year) & (F.col("month") == month.month))
               .groupBy("category_group").agg(F.sum("budget_amount").alias("budgeted")))
    spent = (warehouse.filter(periods.in_month("date_key", as_of, back=1))
             .groupBy("category_group").agg(F.sum(money.expense()).alias("actual_expenses")))
    zero = F.lit(0)
    return (planned.join(spent, "category_group", "full_outer")
            .select("category_group",
                    F.coalesce("budgeted", zero).alias("budgeted"),
                    F.coalesce("actual_expenses", zero).alias("actual_expenses"))
            .withColumn("variance", F.col("budgeted") + F.col("actual_expenses"))
            .transform(as_double, "budgeted", "actual_expenses", "variance"))


# --- over the ledger ------------------------------------------------------------


def analytics_transactions(ledger: DataFrame) -> DataFrame:
    return ledger.filter(F.col("date").isNotNull()).select(
        "id", "date", "amount", "category", "account",
        labels.transaction_type(F.col("amount"), "three_way").alias("transaction_type"),
        F.abs("amount").alias("absolute_amount"),
        F.year("date").alias("year"), F.month("date").alias("month"),
        F.dayofmonth("date").alias("day"),
        periods.day_of_week("date").alias("day_of_week"),
        F.weekofyear("date").alias("week_number"))


def monthly_stats(ledger: DataFrame) -> DataFrame:
    sums = (ledger.filter(F.col("date").isNotNull())
            .groupBy(F.trunc("date", "MM").alias("_m"))
            .agg(_count(), F.sum("amount").alias("net_flow"),
                 *money.signed_sums("total_expenses", "total_income"),
                 F.min("amount").alias("min_transaction"), F.max("amount").alias("max_transaction"),
                 F.stddev_samp(money.double("amount")).alias("std_dev_transaction")))
    rows = sums.select(
        F.year("_m").alias("year"), F.month("_m").alias("month"), "transaction_count", "net_flow",
        "total_expenses", "total_income",
        money.mean("net_flow", "transaction_count").alias("avg_transaction"),
        "min_transaction", "max_transaction",
        F.round("std_dev_transaction", 2).alias("std_dev_transaction"))
    return as_double(rows, "net_flow", "total_expenses", "total_income",
                     "min_transaction", "max_transaction").orderBy(F.desc("year"), F.desc("month"))


def category_analytics(ledger: DataFrame) -> DataFrame:
    """Totals per category and type, with the share of rows within the type."""
    kind = labels.transaction_type(F.col("amount"), "three_way").alias("transaction_type")
    sums = (ledger.filter(F.col("date").isNotNull()).groupBy("category", kind)
            .agg(_count(), F.sum("amount").alias("total_amount")))
    of_type = F.sum("transaction_count").over(Window.partitionBy("transaction_type"))
    return sums.select(
        "category", "transaction_type", "transaction_count",
        money.double("total_amount").alias("total_amount"),
        money.mean("total_amount", "transaction_count").alias("avg_amount"),
        F.round(money.percent("transaction_count", of_type), 2).alias("type_percentage"),
    ).orderBy(F.abs("total_amount").desc(), "category", "transaction_type")


def weekly_patterns(ledger: DataFrame) -> DataFrame:
    sums = (ledger.filter(F.col("date").isNotNull())
            .groupBy(periods.day_of_week("date").alias("day_of_week"))
            .agg(_count(), F.sum("amount").alias("total_amount"),
                 *money.signed_sums("total_expenses", "total_income"))
            .withColumn("avg_amount", money.mean("total_amount", "transaction_count")))
    return as_double(sums, "total_amount", "total_expenses", "total_income").orderBy("day_of_week")


def category_breakdown(ledger: DataFrame) -> DataFrame:
    amount = F.col("amount")
    sums = (ledger.filter(F.col("date").isNotNull()).groupBy("category")
            .agg(F.sum(F.abs(money.expense())).alias("total_expenses"),
                 F.sum(money.income()).alias("total_income"),
                 F.count_if(amount < 0).alias("expense_count"),
                 F.count_if(amount > 0).alias("income_count")))
    rows = sums.withColumns({
        "avg_expense": money.rounded_mean("total_expenses", "expense_count"),
        "avg_income": money.rounded_mean("total_income", "income_count")})
    return as_double(rows, "total_expenses", "total_income").orderBy(
        F.desc("total_expenses"), "category")


def category_breakdown_simple(ledger: DataFrame, rows: int | None = None) -> DataFrame:
    sums = ledger.groupBy("category").agg(_count(), F.sum("amount").alias("total_amount"))
    out = sums.select("category", "transaction_count",
                      money.double("total_amount").alias("total_amount"),
                      money.mean("total_amount", "transaction_count").alias("avg_amount"))
    out = out.orderBy(F.abs("total_amount").desc(), "category")
    return out.limit(rows) if rows else out


def account_analysis(ledger: DataFrame) -> DataFrame:
    sums = (ledger.filter(F.col("date").isNotNull()).groupBy("account")
            .agg(_count(), F.sum("amount").alias("net_flow"),
                 *money.signed_sums("expenses", "income"))
            .withColumn("avg_transaction", money.rounded_mean("net_flow", "transaction_count")))
    return as_double(sums, "net_flow", "expenses", "income").orderBy(
        F.abs("net_flow").desc(), "account")


def current_month_detailed(ledger: DataFrame, as_of: dt.date, style: str = "three_way") -> DataFrame:
    kind = labels.transaction_type(F.col("amount"), style).alias("transaction_type")
    sums = (ledger.filter(periods.in_month("date", as_of)).groupBy("category", kind)
            .agg(_count("count"), F.sum("amount").alias("total"))
            .withColumn("average", money.mean("total", "count")))
    return as_double(sums, "total").orderBy(F.abs("total").desc(), "category", "transaction_type")


def spending_trends(ledger: DataFrame, months: int = 12) -> DataFrame:
    """Expenses per month against the month before; the latest ``months`` of them."""
    sums = (ledger.filter(F.col("date").isNotNull()).groupBy(F.trunc("date", "MM").alias("_m"))
            .agg(F.sum(money.expense()).alias("expenses")))
    trend = sums.withColumn("prev_expenses", F.lag("expenses").over(Window.orderBy("_m")))
    change = F.col("expenses") - F.col("prev_expenses")
    rows = trend.select(
        F.year("_m").alias("year"), F.month("_m").alias("month"), "expenses", "prev_expenses",
        change.alias("change"),
        F.round(money.percent(change, F.abs("prev_expenses")), 2).alias("pct_change"))
    return as_double(rows, "expenses", "prev_expenses", "change").orderBy(
        F.desc("year"), F.desc("month")).limit(months)


def financial_summary(ledger: DataFrame, as_of: dt.date, top: int = 10) -> DataFrame:
    """One row: balance, this month's flow, savings rate, counts, largest categories.

    The ledger is read once and shrinks to one row per category first.
    """
    here = periods.in_month("date", as_of)
    zero = F.lit(0).cast("decimal(12,2)")
    by_category = ledger.groupBy("category").agg(
        _count("n"), F.sum("amount").alias("total"),
        F.sum(F.when(here, money.income()).otherwise(zero)).alias("income"),
        F.sum(F.when(here, money.expense()).otherwise(zero)).alias("expenses"))
    place = F.row_number().over(Window.orderBy(F.abs("total").desc(), "category"))
    entry = F.struct("_place", "category", F.col("n").alias("transaction_count"),
                     money.double("total").alias("total_amount"),
                     money.mean("total", "n").alias("avg_amount"))
    row = by_category.withColumn("_place", place).agg(
        F.coalesce(money.double(F.sum("total")), F.lit(0.0)).alias("total_balance"),
        F.coalesce(money.double(F.sum("income")), F.lit(0.0)).alias("monthly_income"),
        F.coalesce(F.abs(money.double(F.sum("expenses"))), F.lit(0.0)).alias("monthly_expenses"),
        F.coalesce(F.sum("n"), F.lit(0)).alias("total_transactions"),
        _count("categories_count"),
        F.array_sort(F.collect_list(F.when(F.col("_place") <= top, entry))).alias("_top"))
    return row.select(
        "total_balance", "monthly_income", "monthly_expenses",
        money.savings_rate(F.col("monthly_income"), F.col("monthly_expenses")).alias("savings_rate"),
        "total_transactions", "categories_count",
        F.transform("_top", lambda e: e.dropFields("_place")).alias("category_breakdown"))


def full_summary(ledger: DataFrame, as_of: dt.date, top: int = 10) -> dict[str, DataFrame]:
    """The parts of the dashboard summary: headline row, weekly pattern, trends,
    and the breakdown its ``category_breakdown`` list comes from."""
    return {
        "headline": financial_summary(ledger, as_of, top),
        "category_breakdown": category_breakdown(ledger).limit(top),
        "weekly_patterns": weekly_patterns(ledger),
        "spending_trends": spending_trends(ledger),
    }


def dashboard_lines(ledger: DataFrame, as_of: dt.date, top: int = 10) -> DataFrame:
    """The whole dashboard answer as lines (section, name, value): headline figures, data points,
    largest categories, weekly pattern and monthly trend."""
    parts = full_summary(ledger, as_of, top)
    row = parts["headline"]

    def lines(section: str, *names: str) -> DataFrame:
        made = F.array(*[F.struct(F.lit(section).alias("section"), F.lit(n).alias("name"), money.double(n).alias("value")) for n in names])
        return row.select(F.inline(made))

    largest = row.select(F.explode("category_breakdown").alias("c")).select(
        F.lit("category").alias("section"), F.col("c.category").alias("name"), F.col("c.total_amount").alias("value"))
    weekly = parts["weekly_patterns"].select(
        F.lit("weekly_pattern").alias("section"), F.col("day_of_week").cast("string").alias("name"), F.col("total_amount").alias("value"))
    trend = parts["spending_trends"].select(
        F.lit("spending_trend").alias("section"), F.format_string("%04d-%02d", "year", "month").alias("name"), F.col("expenses").alias("value"))
    return (lines("headline", "total_balance", "monthly_income", "monthly_expenses", "savings_rate")
            .unionByName(lines("data_points", "total_transactions", "categories_count"))
            .unionByName(largest).unionByName(weekly).unionByName(trend))


def top_categories(ledger: DataFrame, as_of: dt.date, days: int = 30, rows: int = 5) -> DataFrame:
    """Categories with the largest spending of the last days."""
    spent = (ledger.filter(periods.trailing_days("date", as_of, days) & (F.col("amount") < 0))
             .groupBy("category").agg(F.abs(F.sum("amount")).alias("amount")))
    return as_double(spent, "amount").orderBy(F.desc("amount"), "category").limit(rows)


def spending_by_category(ledger: DataFrame, as_of: dt.date, days: int = 30) -> DataFrame:
    """Spending of the last days against the days before, in one pass."""
    bounded("days", days, 1, 365)
    now = periods.trailing_days("date", as_of, days)
    zero = F.lit(0).cast("decimal(12,2)")
    spent = (ledger.filter((F.col("amount") < 0) & periods.trailing_days("date", as_of, 2 * days))
             .groupBy("category")
             .agg(F.count_if(now).alias("_n"),
                  F.abs(F.sum(F.when(now, F.col("amount")).otherwise(zero))).alias("current"),
                  F.abs(F.sum(F.when(now, zero).otherwise(F.col("amount")))).alias("previous"))
             .filter(F.col("_n") > 0))
    change = F.when(F.col("previous") > 0, F.col("current") - F.col("previous")).otherwise(zero)
    rows = as_double(spent.withColumn("change", change), "current", "previous", "change")
    return rows.select("category", "current", "previous", "change",
                       F.when(F.col("previous") > 0, F.col("change") / F.col("previous") * 100)
                       .otherwise(0.0).alias("pct_change"))


def spending_totals(spending: DataFrame) -> DataFrame:
    """Totals over all categories of ``spending_by_category``."""
    sums = spending.agg(F.sum(F.col("current").cast("decimal(22,2)")).alias("total_current"),
                        F.sum(F.col("previous").cast("decimal(22,2)")).alias("total_previous"))
    rows = as_double(sums.withColumn("total_change", F.col("total_current") - F.col("total_previous")),
                     "total_current", "total_previous", "total_change")
    return rows.withColumn(
        "total_pct_change",
        F.when(F.col("total_previous") > 0, F.col("total_change") / F.col("total_previous") * 100)
        .otherwise(0.0))


def _monthly_flow(ledger: DataFrame, as_of: dt.date, months: int) -> DataFrame:
    bounded("months", months, 1, 60)
    return (ledger.filter(periods.trailing_months("date", as_of, months))
            .groupBy(F.trunc("date", "MM").alias("_m"))
            .agg(F.sum(money.income()).alias("income"),
                 F.abs(F.sum(money.expense())).alias("expenses"),
                 F.sum("amount").alias("balance")))


def historical_monthly(ledger: DataFrame, as_of: dt.date, months: int = 6) -> DataFrame:
    flow = _monthly_flow(ledger, as_of, months).select(
        periods.year_month_text("_m").alias("month"), "income", "expenses", "balance")
    return as_double(flow, "income", "expenses", "balance").orderBy(F.desc("month"))


def historical_enhanced(ledger: DataFrame, as_of: dt.date, months: int = 6) -> DataFrame:
    """Adds turnover (income plus spending), its income share, and balance change."""
    flow = _monthly_flow(ledger, as_of, months)
    turnover = F.col("income") + F.col("expenses")
    rows = flow.select(
        periods.year_month_text("_m").alias("month"), "income", "expenses", "balance",
        turnover.alias("cash_flow"),
        F.round(money.percent("income", turnover), 2).alias("savings_rate"),
        F.lag("balance").over(Window.orderBy("_m")).alias("prev_balance"),
    ).withColumn("balance_change", F.col("balance") - F.col("prev_balance"))
    return as_double(rows, "income", "expenses", "balance", "cash_flow", "prev_balance",
                     "balance_change").orderBy(F.desc("month"))


# --- recommendations over spending_by_category ------------------------------------


@dataclass(frozen=True)
class BudgetRule:
    """Holds for spending and trend strictly within the given bounds."""

    factor: float
    reason: str
    priority: str | None = None
    above: float | None = None
    below: float | None = None
    rising: float | None = None
    falling: float | None = None

    def holds(self) -> Column:
        amount, trend = F.col("current"), F.col("pct_change")
        tests = [amount > self.above if self.above is not None else None,
                 amount < self.below if self.below is not None else None,
                 trend > self.rising if self.rising is not None else None,
                 trend < self.falling if self.falling is not None else None]
        return reduce(lambda a, b: a & b, [t for t in tests if t is not None], F.lit(True))


# Rules over spending alone; the first that holds counts.
SPENDING_RULES = [
    BudgetRule(0.8, "High spending detected", above=500),
    BudgetRule(1.2, "Low spending, can increase budget", below=50),
    BudgetRule(1.0, "Spending within normal range"),
]

# Rules over spending and its trend in percent.
TREND_RULES = [
    BudgetRule(0.7, "High spending with significant increase", "high", above=500, rising=20),
    BudgetRule(0.85, "Moderate spending increasing", "medium", above=300, rising=10),
    BudgetRule(1.3, "Low spending decreasing further", "low", below=50, falling=-20),
    BudgetRule(1.1, "Low spending, room for increase", "low", below=100),
    BudgetRule(1.0, "Spending within normal range", "normal"),
]


def _first_rule(rules: list[BudgetRule], value: str) -> Column:
    branches = F
    for rule in rules:
        branches = branches.when(rule.holds(), getattr(rule, value))
    return branches


def recommend_budget(spending: DataFrame, rules: list[BudgetRule] = SPENDING_RULES) -> DataFrame:
    """Limit per category with spending."""
    amount = F.col("current")
    return (spending.filter(amount > 0)
            .select("category", amount.alias("current_spending"),
                    (amount * _first_rule(rules, "factor")).alias("recommended_limit"),
                    _first_rule(rules, "reason").alias("reason"))
            .withColumn("percentage_change", _change_percent()))


def recommend_budget_by_trend(spending: DataFrame,
                              rules: list[BudgetRule] = TREND_RULES) -> DataFrame:
    """Limit per category from spending and its trend, with a priority."""
    amount = F.col("current")
    return (spending
            .select("category", amount.alias("current_spending"),
                    (amount * _first_rule(rules, "factor")).alias("recommended_limit"),
                    _first_rule(rules, "reason").alias("reason"),
                    _first_rule(rules, "priority").alias("priority"),
                    F.col("pct_change").alias("trend_pct_change"))
            .withColumn("percentage_change", _change_percent()))


def _change_percent() -> Column:
    spent, limit = F.col("current_spending"), F.col("recommended_limit")
    return F.when(spent > 0, (limit - spent) / spent * 100).otherwise(0.0)


def sentiment_summary(news: DataFrame) -> DataFrame:
    """Headlines per mood and their mean score, and the same over all of them."""
    mood = labels.mood(F.col("sentiment_score")).alias("mood")
    return (news.select(mood, "sentiment_score").rollup("mood")
            .agg(_count("headlines"), F.round(F.avg("sentiment_score"), 4).alias("avg_sentiment"))
            .withColumn("mood", F.coalesce("mood", F.lit("all"))))
