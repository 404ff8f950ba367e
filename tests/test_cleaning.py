import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyline import schemas
from tallyline.functions import labels
from tallyline.operators import cleaning
from tests.helpers import as_set, day, ledger, rows


def test_full_row_duplicates_go(spark):
    raw = spark.createDataFrame(
        [(1, 10.0, "2024-01-01"), (2, 20.0, "2024-01-02"), (2, 20.0, "2024-01-02"),
         (3, 30.0, "2024-01-03"), (4, 40.0, "2024-01-04")], "id BIGINT, amount DOUBLE, date STRING")
    raw = raw.withColumns({"category": F.lit(None).cast("string"), "account": F.lit("a")})
    silver = cleaning.silver_transactions(raw)
    assert silver.count() == 4
    assert dict(silver.dtypes) == {"date": "date", "amount": "double", "category": "string",
                                   "transaction_id": "string", "account_id": "string"}


@pytest.mark.parametrize("value, kind", [("2024-05-06", "string"), (dt.date(2024, 5, 6), "date"),
                                         (dt.datetime(2024, 5, 6, 7, 8), "timestamp")])
def test_dates_of_any_type(spark, value, kind):
    df = spark.createDataFrame([(value,)], f"date {kind}")
    assert df.select(cleaning.as_date(df, "date")).first()[0] == dt.date(2024, 5, 6)


def test_unreadable_dates_become_null(spark):
    df = spark.createDataFrame([("06/05/2024",), (None,)], "date STRING")
    assert rows(df.select(cleaning.as_date(df, "date"))) == [(None,), (None,)]


def test_category_remap(spark):
    words = ["Coffee", "COFFEE", "grocery store", "Salary Deposit", "Rent", None]
    df = spark.createDataFrame([(w,) for w in words], "c STRING")
    got = [r[0] for r in df.select(labels.remap_category(F.col("c"))).collect()]
    assert got == ["food", "food", "food", "income", "other", "other"]
    strict = labels.remap_category(F.col("c"), {"Coffee": "food"}, default=None, lower=False)
    assert [r[0] for r in df.select(strict).collect()] == ["food"] + [None] * 5
    named = labels.remap_category(F.col("c"), {"none": "missing"}, null_label="none")
    assert df.select(named).collect()[-1][0] == "missing"


def test_staging_keeps_smallest_id_and_drops_incomplete_rows(spark):
    raw = ledger(
        spark,
        (5, "2024-01-01", -3, " Coffee", "A "), (2, "2024-01-01", -3, "Coffee", "A"),
        (9, "2024-01-01", -3, "Coffee  ", "A"),
        (3, "2024-01-01", -3, "Coffee", None),          # no account: stays
        (4, None, -3, "Coffee", "A"), (6, "2024-01-01", None, "Coffee", "A"),
        (7, "2024-01-01", -3, None, "A"))
    staged = cleaning.staged_transactions(raw)
    assert as_set(staged) == {(2, day("2024-01-01"), Decimal("-3.00"), "Coffee", "A"),
                              (3, day("2024-01-01"), Decimal("-3.00"), "Coffee", None)}


def test_news_times(spark):
    news = spark.createDataFrame(
        [("2024-01-01 10:00:00.123456", "a", 0.2), ("2024-01-01 10:00:00", "b", 0.9),
         ("yesterday", "c", 0.1), ("2024-01-01 11:00:00", "d", None)], schemas.NEWS_RAW)
    clean = cleaning.silver_news(news)
    assert as_set(clean, "published_at", "headline") == {
        (dt.datetime(2024, 1, 1, 10, 0, 0, 123456), "a"), (dt.datetime(2024, 1, 1, 10), "b")}
    now = dt.datetime(2024, 2, 2)
    assert cleaning.silver_news(news.drop("timestamp"), now).filter(
        F.col("published_at") == F.lit(now)).count() == 3
    with pytest.raises(ValueError):
        cleaning.silver_news(news.drop("timestamp"))


def batch(spark):
    return ledger(spark, (0, "2024-01-01", 5, "x", "a"), (0, "2024-01-01", 5, "x", "a"),
                  (0, "2024-01-02", 7, "y", "a"), (0, "2024-01-03", 1, None, "a"),
                  (0, "2024-01-03", 1, None, "a")).drop("id")


def test_new_rows(spark):
    booked = ledger(spark, (1, "2024-01-02", 7, "y", "a"), (2, "2024-01-03", 1, None, "a"),
                    (3, "2024-01-02", 7, "y", "a"))
    got = sorted(rows(cleaning.new_rows(batch(spark), booked), "date", "category"), key=str)
    # A NULL key matches nothing: both such rows count as new.
    assert got == [(day("2024-01-01"), "x"), (day("2024-01-03"), None), (day("2024-01-03"), None)]
    safe = cleaning.new_rows(batch(spark), booked, null_safe=True)
    assert rows(safe, "date", "category") == [(day("2024-01-01"), "x")]


def test_payload(spark):
    df = spark.createDataFrame([([(1, "2024-01-01", 2.5, "Coffee", "a"), (2, "2024-01-02", -1.0, None, "b")],)],
                               schemas.PAYLOAD)
    assert as_set(cleaning.explode_payload(df)) == {
        (day("2024-01-01"), Decimal("2.50"), "Coffee", "a"), (day("2024-01-02"), Decimal("-1.00"), None, "b")}


def test_unreadable_values_do_not_stop_a_load(spark):
    payloads = spark.createDataFrame(
        [([(1, "2024-13-77", 1.0, "x", "a"), (2, "2024-01-02", 2.0, "y", "b")],)],
        "transactions ARRAY<STRUCT<id: BIGINT, date: STRING, amount: DOUBLE, description: STRING, account: STRING>>")
    rows_ = cleaning.explode_payload(payloads)
    assert rows_.count() == 2 and cleaning.unreadable(rows_, "date").count() == 1
    raw = spark.createDataFrame([(1, "soon", "5", "c", "a"), (2, "2024-01-01", "five", "c", "a"), (3, "2024-01-01", "5", "c", "a")],
                                "id BIGINT, date STRING, amount STRING, category STRING, account STRING")
    assert [r.id for r in cleaning.staged_transactions(raw).collect()] == [3]
