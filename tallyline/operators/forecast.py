"""Spending forecasts per category."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyline.functions import money, periods
from tallyline.operators import regression


def spending_per_period(ledger: DataFrame, as_of: dt.date, days: int, count: int) -> DataFrame:
    """Spending and number of expenses per category in the last ``count`` periods of ``days`` days.

    Period 0 ends at ``as_of`` (that day included), earlier ones are negative.
    """
    age = F.datediff(F.lit(as_of), F.col("date"))
    start = as_of - dt.timedelta(days=days * count - 1)
    end = as_of + dt.timedelta(days=1)
    return (ledger.filter(periods.between("date", start, end) & (F.col("amount") < 0))
            .groupBy("category", (-F.floor(age / days)).alias("period"))
            .agg(F.abs(F.sum("amount")).alias("spent"), F.count(F.lit(1)).alias("n")))


def fit_trends(spending: DataFrame) -> DataFrame:
    """Least-squares line of spending over periods per category, in one aggregate.

    Scaling the feature first, as a training pipeline would, leaves predictions of
    a least-squares line unchanged, so it is left out.
    """
    y, x = money.double("spent"), money.double("period")
    return spending.groupBy("category").agg(
        F.regr_slope(y, x).alias("slope"),
        F.regr_intercept(y, x).alias("intercept"),
        F.regr_r2(y, x).alias("r2"),
        F.count(F.lit(1)).alias("periods"),
        money.double(F.sum(F.when(F.col("period") == 0, F.col("spent")))).alias("last_spent"))


def spend_trend_fit(ledger: DataFrame, as_of: dt.date, days: int = 30, count: int = 12) -> DataFrame:
    fitted = fit_trends(spending_per_period(ledger, as_of, days, count))
    return fitted.select("category", F.round("slope", 2).alias("slope"),
                         F.round("intercept", 2).alias("intercept"),
                         F.round("r2", 6).alias("r2"), "periods")


def predict_spending(ledger: DataFrame, as_of: dt.date, days: int = 30, count: int = 12,
                     has_trend: bool = True) -> DataFrame:
    """Next period's spending of each category that spent in the last one.

    The line is read one period ahead and kept within half and one and a half of
    the last spending. A category with a single period has no line and repeats.
    """
    fitted = fit_trends(spending_per_period(ledger, as_of, days, count))
    last = F.col("last_spent")
    modelled = F.col("slope").isNotNull()
    ahead = money.clamp(F.col("intercept") + F.col("slope"), last * 0.5, last * 1.5)
    confidence = F.when(modelled, F.least(F.lit(0.95), F.lit(0.7) + last / 1000 * 0.25)).otherwise(0.6)
    if has_trend:
        confidence = F.least(F.lit(0.95), confidence + 0.1)
    month = (as_of + dt.timedelta(days=30)).strftime("%Y-%m")
    return fitted.filter(last.isNotNull()).select(
        F.lit(month).alias("month"),
        F.round(F.when(modelled, ahead).otherwise(last), 2).alias("predicted_amount"),
        "category", confidence.alias("confidence"))


def predict_fallback(spending: DataFrame, as_of: dt.date) -> DataFrame:
    """Without a model: half of the last change on top, or a tenth without change."""
    current, change = F.col("current"), F.col("change")
    step = F.when(change != 0, change / 2).otherwise(current * 0.1)
    return spending.select(F.lit(as_of.strftime("%Y-%m")).alias("month"),
                           (current + step).alias("predicted_amount"),
                           "category", F.lit(0.7).alias("confidence"))


def repeat_last(spending: DataFrame, as_of: dt.date) -> DataFrame:
    """The plainest forecast: the last period again."""
    return spending.select(F.lit(as_of.strftime("%Y-%m")).alias("month"),
                           F.col("current").alias("predicted_amount"),
                           "category", F.lit(0.7).alias("confidence"))


# --- several features per category ----------------------------------------------------

FEATURES = ["previous_spent", "previous_count", "period"]


def feature_rows(ledger: DataFrame, as_of: dt.date, days: int = 30, count: int = 12) -> DataFrame:
    """Per category and period: what was spent, and spending and number of expenses
    of the period before. Windows run over at most ``count`` rows per category."""
    spent = spending_per_period(ledger, as_of, days, count)
    before = Window.partitionBy("category").orderBy("period")
    return spent.select(
        "category", money.double("period").alias("period"), money.double("spent").alias("spent"),
        money.double(F.lag("spent").over(before)).alias("previous_spent"),
        money.double(F.lag("n").over(before)).alias("previous_count"))


def fit_models(rows: DataFrame) -> DataFrame:
    """A linear model of each category's spending: its weights, intercept and R²; in one aggregate
    for all categories. Categories without two usable rows are left out."""
    return regression.fit(rows, ["category"], FEATURES, "spent")


def predict_with_models(models: DataFrame, latest: DataFrame, as_of: dt.date) -> DataFrame:
    """Next period per category from (category, spent, n, period) of the last one.

    The model's answer is kept within half and one and a half of the last spending. Without
    a model the same again is expected, with confidence 0.6; with one that cannot answer,
    as an input is missing, with 0.5.
    """
    inputs = latest.select(
        "category", money.double("spent").alias("previous_spent"),
        money.double("n").alias("previous_count"), (F.col("period") + 1.0).alias("period"))
    last, answer = F.col("previous_spent"), regression.apply(FEATURES)
    modelled, finite = F.col("intercept").isNotNull(), answer.isNotNull() & ~F.isnan(answer)
    both = inputs.join(models, "category", "left")
    month = (as_of + dt.timedelta(days=30)).strftime("%Y-%m")
    return both.select(
        F.lit(month).alias("month"),
        F.when(modelled & finite, money.clamp(answer, last * 0.5, last * 1.5)).otherwise(last).alias("predicted_amount"),
        "category",
        F.when(~modelled, 0.6).when(finite, F.least(F.lit(0.95), F.lit(0.7) + last / 1000 * 0.25)).otherwise(0.5).alias("confidence"))


def spend_multi_fit(ledger: DataFrame, as_of: dt.date, days: int = 30, count: int = 12) -> DataFrame:
    """The models of all categories, rounded."""
    models = fit_models(feature_rows(ledger, as_of, days, count))
    return models.select("category", "rows", *[F.round(f"w_{f}", 4).alias(f"w_{f}") for f in FEATURES],
                         F.round("intercept", 1).alias("intercept"), F.round("r2", 6).alias("r2"))


def predict_multi(ledger: DataFrame, as_of: dt.date, days: int = 30, count: int = 12) -> DataFrame:
    """Next period's spending of each category that spent in the last one, by its model."""
    latest = spending_per_period(ledger, as_of, days, count).filter("period = 0")
    models = fit_models(feature_rows(ledger, as_of, days, count))
    return predict_with_models(models, latest, as_of).withColumn("predicted_amount", F.round("predicted_amount", 1))
