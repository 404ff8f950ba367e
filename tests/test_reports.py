import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyline import schemas
from tallyline.operators import forecast, reports, running, star, summaries
from tests.helpers import as_set, day, ledger, rows

AS_OF = dt.date(2024, 3, 15)


@pytest.fixture(scope="module")
def book(spark):
    return ledger(
        spark,
        (1, "2024-01-31", 1000, "Salary", "Checking_1"),
        (2, "2024-02-01", -50, "Coffee", "Checking_1"),
        (3, "2024-02-20", -450, "Restaurant", "CreditCard_1"),
        (4, "2024-03-01", 0, "Coffee", "Savings_1"),
        (5, "2024-03-10", -600, "Restaurant", "CreditCard_1"),
        (6, "2024-03-14", -25, "Coffee", "Checking_1"),
        (7, "2024-03-14", 40, "Salary", None))


def test_daily_summary(book):
    got = {r.date: tuple(r)[1:] for r in summaries.daily_summary(book).collect()}
    assert got[day("2024-03-14")] == (2, 15.0, -25.0, 40.0)
    assert got[day("2024-03-01")] == (1, 0.0, 0.0, 0.0)  # an empty sum is 0


def test_category_summary_shares(book):
    got = {r.category: r for r in summaries.category_summary(book).collect()}
    assert set(got) == {"Coffee", "Restaurant"}
    assert got["Restaurant"].percentage_of_total == pytest.approx(1050 / 1125 * 100)
    assert got["Coffee"].avg_transaction == -37.5


def test_balances(book):
    got = as_set(summaries.account_balance(book), "account_id", "current_balance")
    assert got == {("Checking_1", 925.0), ("CreditCard_1", -1050.0), ("Savings_1", 0.0), (None, 40.0)}
    assert rows(summaries.balance_of(book, "Checking_1")) == [("Checking_1", 925.0)]


def test_products_equal_the_naive_form(book):
    daily, category = summaries.daily_summary(book), summaries.category_summary(book)
    balance = summaries.account_balance(book).filter("account_id IS NOT NULL")
    naive = (daily.crossJoin(category.select("category", F.col("total_spent").alias("category_spending")))
             .crossJoin(balance.select(F.col("account_id").alias("account"), "current_balance"))
             .orderBy(F.desc("date"), "category", "account"))
    for n in (1, 4, 5, 50):
        page = summaries.financial_dashboard(daily, category, balance, n)
        expected = naive.limit(n).select(page.columns)
        assert page.collect() == expected.collect()
    empty = summaries.financial_dashboard(daily, category, balance.limit(0))
    assert empty.count() == 0


def test_monthly_trends(spark):
    staged = ledger(
        spark, (1, "2024-01-05", 10, "A", "x"), (2, "2024-02-05", -20, "A", "x"),
        (3, "2024-03-05", -30, "A", "x"), (4, "2024-03-06", -5, "All", "All"),
    ).withColumnRenamed("date", "transaction_date")
    got = {(r.month.month, r.category, r.monthly_expenses): r for r in summaries.monthly_trends(staged).collect()}
    assert got[(2, "A", -20.0)].expense_change_percent is None  # nothing spent the month before
    assert got[(2, "A", -20.0)].expense_change == -20.0
    assert got[(3, "A", -30.0)].expense_change_percent == -50.0
    # A category that is really called 'All' stays apart from the total.
    assert got[(3, "All", -5.0)].prev_month_expenses is None
    assert got[(3, "All", -35.0)].prev_month_expenses == -20.0


def test_star(spark, book):
    book = book.unionByName(ledger(spark, (8, "2024-03-15", -1, None, "Unknown")))
    built = star.build_star(book)
    categories = rows(built.category.frame.orderBy("category_id"), "category_id", "category_name")
    assert categories == [(1, "Coffee"), (2, "Restaurant"), (3, "Salary"), (4, "Unknown"), (5, None)]
    assert built.account.rows == 5 and built.category.rows == 5
    assert as_set(built.merchant.frame, "merchant_name") == {("Coffee",), ("Other",), ("Restaurant",)}
    fact = star.fact_transactions(book, built)
    assert fact.count() == book.count()
    lost = fact.filter("transaction_id = 8").first()
    assert (lost.category_id, lost.merchant_id, lost.transaction_type) == (None, None, "Expense")
    assert fact.filter("transaction_id = 7").first().account_id is None
    # Joined and computed attributes agree, except that no key means no attribute.
    shared = ["transaction_id", "year", "month", "day_of_week", "category_group", "account_type",
              "merchant_type", "amount_category"]
    joined = star.warehouse_transactions(book, built)
    assert as_set(joined, *shared) == as_set(star.warehouse(book), *shared)


def test_dense_keys_over_many_partitions(spark):
    names = spark.range(500).select(F.concat(F.lit("n"), F.lpad("id", 4, "0")).alias("account"))
    dim = star.dim_account(names.unionByName(names))
    got = rows(dim.frame.orderBy("account_name"), "account_id", "account_name")
    assert [i for i, _ in got] == list(range(1, 502))
    assert dim.rows == 501


def test_running_totals(book):
    got = reports.running_totals(star.warehouse(book), None).collect()
    assert [r.running_balance for r in got] == [1000.0, 950.0, 500.0, 500.0, -100.0, -85.0]
    assert [r.daily_rank for r in got] == [1, 4, 5, 3, 6, 2]
    assert got[-1].weekly_moving_avg == pytest.approx(-85 / 6)
    assert reports.running_totals(star.warehouse(book)).count() == 6


def test_summary_table_answers_like_the_base(book):
    warehouse = star.warehouse(book)
    summary = reports.monthly_financial_summary(warehouse)
    assert (reports.year_totals(warehouse, 2024).collect()
            == reports.year_totals_from_summary(summary, 2024).collect() != [])


def test_budget(spark, book):
    budget = spark.createDataFrame(
        [(2024, 2, "Dining", Decimal(600)), (2024, 2, "Housing", Decimal(10)), (2024, 1, "Dining", Decimal(1))],
        schemas.BUDGET)
    got = as_set(reports.budget_vs_actual(budget, star.warehouse(book), AS_OF))
    assert got == {("Dining", 600.0, -500.0, 100.0), ("Housing", 10.0, 0.0, 10.0)}
    none = reports.budget_vs_actual(budget.limit(0), star.warehouse(book), AS_OF)
    assert as_set(none) == {("Dining", 0.0, -500.0, -500.0)}


def test_single_row_has_no_deviation(spark):
    one = ledger(spark, (1, "2024-01-01", 5, "A", "x"))
    assert reports.monthly_stats(one).first().std_dev_transaction is None


def test_spending_periods(book):
    got = {r.category: r for r in reports.spending_by_category(book, AS_OF).collect()}
    assert got["Restaurant"].asDict() == {"category": "Restaurant", "current": 1050.0, "previous": 0.0,
                                          "change": 0.0, "pct_change": 0.0}
    assert (got["Coffee"].current, got["Coffee"].previous, got["Coffee"].change) == (25.0, 50.0, -25.0)
    assert got["Coffee"].pct_change == -50.0
    totals = reports.spending_totals(reports.spending_by_category(book, AS_OF)).first()
    assert tuple(totals) == (1075.0, 50.0, 1025.0, 2050.0)


def test_budget_rules(spark):
    cases = [("a", 600.0, 30.0), ("b", 400.0, 15.0), ("c", 40.0, -30.0), ("d", 90.0, 0.0), ("e", 200.0, 0.0),
             ("f", 0.0, 0.0)]
    spending = spark.createDataFrame([(c, x, 0.0, 0.0, p) for c, x, p in cases],
                                     "category STRING, current DOUBLE, previous DOUBLE, change DOUBLE, pct_change DOUBLE")
    v1 = {r.category: r for r in reports.recommend_budget(spending).collect()}
    assert "f" not in v1
    assert v1["a"].recommended_limit == 480.0 and v1["c"].recommended_limit == 48.0 and v1["e"].recommended_limit == 200.0
    v2 = {r.category: (r.recommended_limit, r.priority) for r in reports.recommend_budget_by_trend(spending).collect()}
    assert v2["a"] == (pytest.approx(420), "high") and v2["b"] == (pytest.approx(340), "medium")
    assert v2["c"] == (pytest.approx(52), "low") and v2["d"] == (pytest.approx(99), "low")
    assert v2["e"] == (200.0, "normal")


def test_financial_summary(book, spark):
    row = reports.financial_summary(book, AS_OF, top=2).first()
    assert (row.total_balance, row.monthly_income, row.monthly_expenses) == (-85.0, 40.0, 625.0)
    assert row.savings_rate == pytest.approx((40 - 625) / 40 * 100)
    assert [e.category for e in row.category_breakdown] == ["Restaurant", "Salary"]
    assert row.categories_count == 3 and row.total_transactions == 7
    empty = reports.financial_summary(book.limit(0), AS_OF).first()
    assert (empty.total_balance, empty.savings_rate, empty.category_breakdown) == (0.0, 0.0, [])
    assert set(reports.full_summary(book, AS_OF)) == {
        "headline", "category_breakdown", "weekly_patterns", "spending_trends"}


def test_recent_transactions_equal_the_full_window(book):
    recent = running.recent_transactions(book, 3).collect()
    every = {r.id: r for r in running.running_analytics(book).collect()}
    assert [r.id for r in recent] == [7, 6, 5]
    for r in recent:
        assert r.running_balance == every[r.id].running_balance
        assert r.cumulative_expenses == every[r.id].cumulative_expenses


@pytest.mark.parametrize("call", [
    lambda b: running.recent_transactions(b, 0), lambda b: running.recent_transactions(b, 101),
    lambda b: reports.spending_by_category(b, AS_OF, 366), lambda b: reports.historical_monthly(b, AS_OF, 61),
    lambda b: running.recent_transactions(b, "5")])
def test_parameter_bounds(book, call):
    with pytest.raises(ValueError):
        call(book)


def test_forecast(spark):
    book = ledger(spark, *[(i, str(AS_OF - dt.timedelta(days=30 * i)), -(100 - 10 * i), "A", "x") for i in range(4)],
                  (9, str(AS_OF), -7, "once", "x"), (10, str(AS_OF - dt.timedelta(days=90)), -7, "past", "x"))
    fit = {r.category: r for r in forecast.spend_trend_fit(book, AS_OF).collect()}
    assert (fit["A"].slope, fit["A"].intercept, fit["A"].r2) == (10.0, 100.0, 1.0)
    got = {r.category: r for r in forecast.predict_spending(book, AS_OF).collect()}
    assert got["A"].predicted_amount == 110.0 and got["A"].month == "2024-04"
    assert got["A"].confidence == pytest.approx(0.7 + 0.1 * 0.25 + 0.1)
    assert (got["once"].predicted_amount, got["once"].confidence) == (7.0, pytest.approx(0.7))
    assert "past" not in got
    steep = ledger(spark, (1, "2024-03-15", -400, "B", "x"), (2, "2024-02-14", -1, "B", "x"))
    assert forecast.predict_spending(steep, AS_OF).first().predicted_amount == 600.0  # kept below 1.5 times


def test_fallback_forecast(spark):
    spending = spark.createDataFrame([("a", 100.0, 20.0), ("b", 100.0, 0.0)], "category STRING, current DOUBLE, change DOUBLE")
    assert as_set(forecast.predict_fallback(spending, AS_OF), "predicted_amount") == {(110.0,)}
    assert as_set(forecast.repeat_last(spending, AS_OF), "month", "predicted_amount") == {("2024-03", 100.0)}


def test_unusual_amounts(spark):
    book = ledger(spark, *[(i, "2024-01-01", 10, "A", "x") for i in range(20)], (99, "2024-01-02", 500, "A", "x"),
                  (100, "2024-01-02", None, "A", "x"))
    got = running.unusual_amounts(book).collect()
    assert [r.id for r in got] == [99]
    assert got[0].anomaly_reason.startswith("Amount (500.00) is unusual (mean: 31.82, std: ")


def test_sentiment(spark):
    news = spark.createDataFrame([(0.3,), (0.9,), (-0.5,), (-0.3,)], "sentiment_score DOUBLE")
    assert as_set(reports.sentiment_summary(news)) == {
        ("flat", 2, 0.0), ("up", 1, 0.9), ("down", 1, -0.5), ("all", 4, 0.1)}


def test_models_with_several_features(spark):
    """Spending that is an exact linear function of the features is predicted."""
    import random
    rng = random.Random(5)
    rows_, previous, count = [], 50.0, 3.0
    for period in range(-11, 1):
        spent = 20 + 0.5 * previous + 2 * count + 3 * period
        rows_.append(("A", float(period), spent, previous, count))
        previous, count = spent + rng.random() * 9, float(rng.randrange(1, 9))
    rows_.append(("B", 0.0, 5.0, 4.0, 1.0))
    data = spark.createDataFrame(
        rows_, "category STRING, period DOUBLE, spent DOUBLE, previous_spent DOUBLE, previous_count DOUBLE")
    models = forecast.fit_models(data)
    assert [r.category for r in models.collect()] == ["A"]  # one row is no model
    found = models.first()
    assert found.r2 == pytest.approx(1) and found.rows == 12
    assert (found.w_previous_spent, found.w_previous_count, found.w_period, found.intercept) == pytest.approx((0.5, 2, 3, 20))
    latest = spark.createDataFrame([("A", 60.0, 4, 0.0), ("B", 5.0, 1, 0.0)],
                                   "category STRING, spent DOUBLE, n INT, period DOUBLE")
    got = {r.category: r for r in forecast.predict_with_models(models, latest, AS_OF).collect()}
    assert got["A"].predicted_amount == pytest.approx(20 + 30 + 8 + 3)
    assert got["A"].confidence == pytest.approx(0.7 + 0.06 * 0.25)
    assert (got["B"].predicted_amount, got["B"].confidence) == (5.0, 0.6)
    unknown = spark.createDataFrame([("A", 60.0, None, 0.0)], latest.schema)
    row = forecast.predict_with_models(models, unknown, AS_OF).first()
    assert (row.predicted_amount, row.confidence) == (60.0, 0.5)


@pytest.mark.parametrize("kind", ["free", "constant feature", "mixed feature", "two rows"])
def test_regression_equals_a_library_s(spark, kind):
    import numpy as np
    from tallyline.operators import regression
    rng = np.random.default_rng(3)
    data, expected = [], {}
    for group in range(5):
        n = 2 if kind == "two rows" else 40
        x = rng.normal(1e6, 1e5, (n, 3)) * [1, 1e-5, 1e-6]
        if kind == "constant feature":
            x[:, 1] = 7
        if kind == "mixed feature":
            x[:, 2] = 2 * x[:, 0] - 3 * x[:, 1] + 5
        y = x @ rng.normal(0, 1, 3) + rng.normal(0, 3, n) + 11
        scaled = (x - x.mean(0)) / np.where(x.std(0) > 0, x.std(0), 1)
        fitted = scaled @ np.linalg.lstsq(scaled, y - y.mean(), rcond=1e-6)[0] + y.mean()
        expected[group] = (fitted, 1 - ((y - fitted) ** 2).sum() / ((y - y.mean()) ** 2).sum())
        data += [(group, k, *map(float, x[k]), float(y[k])) for k in range(n)]
    data += [(0, 99, None, 1.0, 1.0, 1.0), (0, 98, 1.0, 1.0, 1.0, None), (9, 0, 1.0, 1.0, 1.0, 1.0)]
    rows_ = spark.createDataFrame(data, "g INT, k INT, a DOUBLE, b DOUBLE, c DOUBLE, y DOUBLE")
    models = regression.fit(rows_, ["g"], ["a", "b", "c"], "y")
    got = rows_.join(models, "g").na.drop().withColumn("p", regression.apply(["a", "b", "c"])).orderBy("g", "k").collect()
    for group, (fitted, r2) in expected.items():
        mine = [r for r in got if r.g == group]
        assert [r.p for r in mine] == pytest.approx(fitted.tolist(), rel=1e-7)
        assert mine[0].r2 == pytest.approx(r2, abs=1e-6)
    assert {r.g for r in got} == set(expected)


def test_feature_rows(book):
    got = {(r.category, int(r.period)): r for r in forecast.feature_rows(book, AS_OF).collect()}
    assert got["Coffee", 0].previous_spent == 50.0 and got["Coffee", 0].previous_count == 1.0
    assert got["Coffee", -1].previous_spent is None


def test_first_and_last_rows(book):
    assert [r.id for r in reports.first_rows(book, ["date", "id"], 2).collect()] == [1, 2]
    assert [r.id for r in reports.last_rows(book, ["date", "id"], 2).collect()] == [6, 7]
