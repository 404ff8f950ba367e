"""Monthly reporting, the stored monthly summary, and the quality job."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.functions import money, periods
from tallyline.operators import quality, reports
from tallyline.plans.views import Aggregate, Measure, SummaryView
from tallyline.sources import files


def monthly_reports(warehouse: DataFrame, budget: DataFrame, as_of: dt.date) -> dict[str, DataFrame]:
    return {
        "summary": reports.monthly_report(warehouse, as_of),
        "insights": reports.monthly_insights(warehouse, as_of),
        "budget_vs_actual": reports.budget_vs_actual(budget, warehouse, as_of),
    }


def write_monthly_reports(warehouse: DataFrame, budget: DataFrame, as_of: dt.date,
                          folder: str) -> list[str]:
    stamp = as_of.strftime("%Y%m")
    return [files.write_report(report, folder, f"{name}_{stamp}")
            for name, report in monthly_reports(warehouse, budget, as_of).items()]


def write_daily_report(warehouse: DataFrame, as_of: dt.date, folder: str) -> str:
    return files.write_report(reports.daily_report(warehouse, as_of), folder,
                              f"daily_report_{as_of:%Y%m%d}")


# Keys and measures of the stored monthly summary.
SUMMARY_KEYS = ("year", "month", "category_group", "account_type")
SUMMARY_MEASURES = {
    "transaction_count": Measure("count"), "net_amount": Measure("sum", "amount"),
    "expenses": Measure("sum", "amount", "amount < 0"), "income": Measure("sum", "amount", "amount > 0"),
    "first_date": Measure("min", "date_key"), "last_date": Measure("max", "date_key")}


def monthly_view(spark: SparkSession, path: str) -> SummaryView:
    """The stored monthly summary, one part for each month."""
    return SummaryView(spark, path, SUMMARY_KEYS, SUMMARY_MEASURES, "format_string('%04d-%02d', year, month)")


def refresh_monthly_summary(warehouse: DataFrame, path: str, since: dt.date | None = None) -> None:
    """Store the monthly summary by (year, month).

    With ``since``, only months from that day's month on are computed and replaced;
    of these, months without rows go.
    """
    view = monthly_view(warehouse.sparkSession, path)
    if since:
        warehouse = warehouse.filter(F.col("date_key") >= F.lit(periods.month_start(since)))
    view.refresh(warehouse, f"{since:%Y-%m}" if since else None)


def append_to_monthly_summary(rows: DataFrame, path: str, batch: str) -> None:
    """Bring the stored summary up to date with rows that were appended to the warehouse table."""
    monthly_view(rows.sparkSession, path).append(rows, batch)


def read_monthly_summary(spark: SparkSession, path: str) -> DataFrame:
    """The stored summary in the form of ``reports.monthly_financial_summary``."""
    stored = monthly_view(spark, path).read()
    zero = F.lit(0).cast("decimal(12,2)")
    return stored.select(
        *SUMMARY_KEYS, "transaction_count", "net_amount", F.coalesce("expenses", zero).alias("total_expenses"),
        F.coalesce("income", zero).alias("total_income"), "first_date", "last_date",
        money.mean("net_amount", "transaction_count").alias("avg_transaction"))


def expenses_of(year: int) -> Aggregate:
    """Expenses of one year per month and group, as an aggregate that a summary may answer."""
    return Aggregate(("year", "month", "category_group"), {"total": SUMMARY_MEASURES["expenses"]}, (("year", "=", year),), filled=True)


def quality_checks(warehouse: DataFrame, as_of: dt.date) -> dict[str, DataFrame]:
    return {
        "completeness": quality.completeness(warehouse, as_of),
        "accuracy": quality.accuracy(warehouse, as_of),
        "freshness": quality.freshness(warehouse, as_of),
        "schema": quality.schema_check(warehouse),
    }


def run_quality(warehouse: DataFrame, as_of: dt.date, folder: str) -> str:
    """Run the four checks, stop at one that must hold, then store the scores."""
    checks = quality_checks(warehouse, as_of)
    quality.require_complete(checks["completeness"])
    quality.require_fresh(checks["freshness"])
    quality.require_schema(warehouse)
    return files.write_report(quality.quality_report(warehouse, as_of), folder,
                              f"quality_report_{as_of:%Y%m%d}")
