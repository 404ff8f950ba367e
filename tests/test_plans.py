"""The plans behind the results: pushdown, pruning, and no single-task shuffles."""

import datetime as dt

import pytest

from tallyline.functions import periods
from tallyline.operators import cleaning, reports, running, star, summaries
from tallyline.queries import QUERIES
from tallyline.sources import files, tables

AS_OF = dt.date(2001, 7, 15)


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture(scope="module")
def stored(spark, small, tmp_path_factory):
    """The ledger as a month-partitioned table, as a silver layer would keep it."""
    from pyspark.sql import functions as F
    path = str(tmp_path_factory.mktemp("lake") / "ledger")
    ledger = tables.ledger(spark, small).withColumn("month", F.trunc("date", "MM"))
    files.write_layer(ledger, path, ["month"])
    return spark.read.parquet(path)


def test_filters_reach_the_scan(stored):
    plan = plan_of(reports.daily_report(star.warehouse(stored), AS_OF))
    assert "PushedFilters: [IsNotNull(date), EqualTo(date,2001-07-14)]" in plan
    assert "ReadSchema: struct<date:date,amount:decimal(12,2)>" in plan
    plan = plan_of(summaries.category_summary(stored))
    assert "LessThan(amount," in plan and "account" not in plan
    plan = plan_of(summaries.balance_of(stored, "Checking_4"))
    assert "EqualTo(account,Checking_4)" in plan


def test_date_ranges_reach_the_scan_of_timestamps(spark, small):
    plan = plan_of(reports.historical_monthly(tables.ledger(spark, small), AS_OF))
    assert "GreaterThanOrEqual(o_orderdate," in plan


def test_month_partitions_are_pruned(stored):
    plan = plan_of(stored.filter(periods.in_month("month", AS_OF)).groupBy("category").count())
    assert "PartitionFilters: [isnotnull(month" in plan


def test_reports_need_one_shuffle_of_the_ledger(spark, small):
    warehouse = star.warehouse(tables.ledger(spark, small))
    for df in (reports.having_report(warehouse, 2000), reports.monthly_report(warehouse, AS_OF),
               reports.year_totals(warehouse, 2000)):
        plan = plan_of(df)
        assert "Join" not in plan
        assert plan.count("Exchange hashpartitioning") == 1


@pytest.mark.parametrize("build", [
    lambda b: running.running_analytics(b, 200), lambda b: running.balance_changes(b, 200)])
def test_running_balances_leave_no_single_task_with_the_ledger(spark, small, build):
    plan = plan_of(build(tables.ledger(spark, small)))
    # One row per segment may meet in one task, ledger rows may not.
    rows = plan.split("BroadcastExchange")[0]
    assert "Bucketed: true" in rows and "Exchange" not in rows


def test_no_query_uses_a_product_or_python_rows(spark, small):
    for name, query in QUERIES.items():
        plan = plan_of(query(spark, small))
        assert "CartesianProduct" not in plan, name
        assert "BroadcastNestedLoopJoin" not in plan, name
        assert "BatchEvalPython" not in plan and "ArrowEvalPython" not in plan, name


def test_one_join_for_each_dimension_used(spark, small):
    ledger = tables.ledger(spark, small)
    built = star.build_star(ledger)
    plan = plan_of(star.warehouse_transactions(ledger, built))
    assert plan.count("BroadcastHashJoin") == 3 and "SortMergeJoin" not in plan
    assert plan_of(star.star_query(ledger, built)).count("BroadcastHashJoin") == 2


def test_the_dashboard_reads_its_tables(spark, small):
    plan = plan_of(QUERIES["financial_dashboard"](spark, small))
    assert "FileScan parquet" in plan and "LocalTableScan" not in plan


def test_booked_keys_are_reduced_before_the_join(spark, small):
    booked, incoming = tables.booked_and_incoming(spark, small)
    plan = plan_of(cleaning.new_rows(incoming, booked))
    right = plan[plan.index("LeftAnti"):]
    assert "HashAggregate" in right
