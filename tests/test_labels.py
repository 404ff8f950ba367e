import pytest
from pyspark.sql import functions as F

from tallyline.functions import labels
from tallyline.operators import running


def values(spark, column, items, kind):
    df = spark.createDataFrame([(i,) for i in items], f"x {kind}")
    return [r[0] for r in df.select(column(F.col("x"))).collect()]


def test_size_class_limits(spark):
    amounts = [-1000.01, -1000.0, -500.0, -100.0, -0.01, 0.0, 5.0]
    assert values(spark, labels.size_class, amounts, "DOUBLE") == [
        "VERY_LARGE", "LARGE", "MEDIUM", "SMALL", "SMALL", "INCOME", "INCOME"]


@pytest.mark.parametrize("style, expected", [
    ("two_way", ["Expense", "Income", "Income"]), ("three_way", ["Expense", "Neutral", "Income"]),
    ("ledger", ["debit", "zero", "credit"])])
def test_type_names(spark, style, expected):
    assert values(spark, lambda c: labels.transaction_type(c, style), [-1, 0, 1], "INT") == expected


def test_groups_are_case_sensitive(spark):
    names = ["Food", "food", "Electronics", "Fuel", "Salary Bonus", "Deposit", "Rent"]
    assert values(spark, labels.category_group, names, "STRING") == [
        "Dining", "Other", "Retail", "Transportation", "Income", "Income", "Other"]
    assert values(spark, labels.merchant_type, ["Netflix", "Supermarket", "FinTech", "Bar"], "STRING") == [
        "Subscription", "Groceries", "Technology", "General"]
    assert values(spark, labels.account_type, ["My Checking", "Savings_1", "CreditCard", "Cash"], "STRING") == [
        "Checking", "Savings", "Credit Card", "Other"]


def test_text_keywords(spark):
    df = spark.createDataFrame(
        [("Business lunch", -5), ("restaurant bus", -5), ("gift from aunt", 5), ("gift from aunt", -5),
         ("x " * 5000 + "Pharmacy", -5)], "text STRING, amount INT")
    got = [r.category for r in running.categorize_text(df).collect()]
    assert got == ["transport", "food", "income", "other", "health"]
