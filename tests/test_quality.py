import datetime as dt
import json

import pytest

from tallyline.operators import contracts, quality, star
from tallyline.operators.contracts import ColumnContract, DataContract
from tests.helpers import as_set, ledger, rows

AS_OF = dt.date(2024, 3, 15)


@pytest.fixture(scope="module")
def book(spark):
    return ledger(
        spark,
        (1, "2024-03-13", -5, "Coffee", "Checking_1"), (2, "2024-03-14", 0, "Rent", "Savings_1"),
        (3, "2024-03-20", 200000, "Salary", "Checking_1"), (4, None, -9, None, None),
        (5, "2024-03-14", None, "Gifts", "Savings_1"))


def test_contract_report(book):
    got = as_set(contracts.ledger_contract().report(book))
    assert got == {("id", "not_null", 0, True), ("date", "not_null", 1, False),
                   ("amount", "not_null", 1, False), ("amount", "range", 1, False),
                   ("category", "not_null", 1, False), ("category", "allowed_values", 3, False),
                   ("account", "not_null", 1, False)}


def test_contract_result_lists_offenders(book):
    contract = contracts.ledger_contract()
    result = contract.validate(book)
    assert not result.valid and result.row_count == 5
    text = next(e for e in result.errors if "invalid values" in e)
    assert "3 rows" in text
    assert as_set(contract.all_offenders(book)) == {("category", None, 1), ("category", "Gifts", 1), ("category", "Rent", 1)}
    assert rows(contract.offenders(book, "category"), "category", "rows") == [
        (None, 1), ("Gifts", 1), ("Rent", 1)]
    with pytest.raises(contracts.ContractViolation):
        contract.enforce(book)


def test_valid_data_passes(book):
    good = book.filter("id = 1")
    assert contracts.ledger_contract().enforce(good) is good
    assert contracts.ledger_contract().validate(good).errors == []


def test_schema_rules(spark):
    df = spark.createDataFrame([("1", 5)], "transaction_id STRING, amount BIGINT")
    contract = DataContract("c", [ColumnContract("transaction_id", "Utf8"), ColumnContract("amount", "Float64"),
                                  ColumnContract("date", "Date")])
    errors = contract.schema_errors(df.selectExpr("*", "1 AS more"))
    assert errors == ["Missing columns: ['date']", "Extra columns: ['more']",
                      "Column 'amount' has type bigint, expected Float64"]


def test_one_sided_bounds(spark):
    df = spark.createDataFrame([(-1.0,), (5.0,)], "x DOUBLE")
    column = [ColumnContract("x", "Float64", min_value=0.01)]
    assert not DataContract("c", column).validate(df).valid
    assert DataContract("c", column, require_both_bounds=True).validate(df).valid


def test_contract_json_round_trip():
    contract = contracts.ledger_contract()
    again = DataContract.from_json(contract.to_json())
    assert again == contract
    assert json.loads(contract.to_json())["columns"][2]["max_value"] == 100_000


def test_expectations(spark):
    df = ledger(spark, *[(i, "2024-01-01", 5, "Coffee", "a") for i in range(19)],
                (19, "2024-01-01", 200_000, None, "a"), (None, "2024-01-01", None, "Rent", "a"))
    got = {(r.expectation, r.column_name): r for r in quality.expectation_report(df, quality.ledger_suite()).collect()}
    assert got["between", "amount"].success and got["between", "amount"].unexpected_rows == 1  # 19 of 20
    assert got["between", "amount"].checked_rows == 20
    assert not got["not_null", "id"].success
    assert (got["in_set", "category"].checked_rows, got["in_set", "category"].unexpected_rows) == (20, 1)
    empty = quality.expectation_report(df.limit(0), quality.ledger_suite())
    assert empty.filter("NOT success").count() == 0


def test_staging_tests(spark):
    staged = ledger(spark, (1, "2024-01-01", 1, "A", "x"), (1, "2024-01-01", 1, "A", None),
                    (None, None, 1, "A", "x"), (None, None, 1, "A", "x"), (2, "2024-01-01", 1, "A", "x"),
                    ).withColumnRenamed("date", "transaction_date")
    assert as_set(quality.staging_tests(staged)) == {
        ("unique", "id", 1), ("not_null", "id", 2), ("not_null", "transaction_date", 2),
        ("not_null", "amount", 0), ("not_null", "category", 0), ("not_null", "account", 1)}


def test_warehouse_checks(spark, book):
    warehouse = star.warehouse(book.unionByName(ledger(spark, (1, "2024-03-13", -5, "Coffee", "Checking_1"))))
    complete = dict(rows(quality.completeness(warehouse, dt.date(2024, 3, 14))))
    assert complete == {"Total transaction count": 6, "Transactions today": 2, "Null amount check": 1,
                        "Null date check": 1, "Null category check": 1}
    with pytest.raises(quality.QualityFailure):
        quality.require_complete(quality.completeness(warehouse, AS_OF))
    accurate = dict(rows(quality.accuracy(warehouse, AS_OF)))
    assert accurate == {"Negative balance accounts": 1, "Future dated transactions": 1,
                        "Zero amount transactions": 1, "Duplicate transactions": 1}


@pytest.mark.parametrize("as_of, status", [("2024-03-20", "ok"), ("2024-03-22", "behind"), ("2024-03-23", "stale")])
def test_freshness(book, as_of, status):
    check = quality.freshness(star.warehouse(book), dt.date.fromisoformat(as_of))
    assert check.first().status == status
    if status == "stale":
        with pytest.raises(quality.QualityFailure):
            quality.require_fresh(check)


def test_schema_check(book):
    warehouse = star.warehouse(book)
    got = {r.column_name: (r.status, r.filled_rows) for r in quality.schema_check(warehouse).collect()}
    assert got["amount"] == ("ok", 4) and got["merchant_type"][0] == "unexpected"
    wrong = warehouse.withColumn("year", warehouse.year.cast("string"))
    with pytest.raises(quality.QualityFailure):
        quality.require_schema(wrong)


def test_scores(book):
    got = dict(rows(quality.quality_report(star.warehouse(book), AS_OF), "metric_type", "score"))
    assert got == {"Completeness": 60.0, "Accuracy": 20.0, "Consistency": 100.0}
