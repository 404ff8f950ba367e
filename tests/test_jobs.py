import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyline import schemas, session
from tallyline.functions import fraud
from tallyline.operators import hierarchy, reports, running, star
from tallyline.plans import batch, catalog, jobs, warehouse
from tallyline.sources import files, relational, tables
from tallyline.sources.lineage import LineageLog
from tests.helpers import as_set, day, ledger, rows

AS_OF = dt.date(2001, 7, 15)

# The sample tree.
TREE = [(1, "All", None, 0), (2, "Expenses", 1, 1), (3, "Income", 1, 1), (4, "Necessities", 2, 2),
        (5, "Discretionary", 2, 2), (6, "Food", 4, 3), (7, "Housing", 4, 3), (8, "Entertainment", 5, 3),
        (9, "Shopping", 5, 3), (10, "Salary", 3, 2), (11, "Investment", 3, 2)]


def test_category_tree(spark):
    edges = spark.createDataFrame(TREE, schemas.HIERARCHY)
    got = rows(hierarchy.category_tree(edges))
    assert len(got) == 11
    assert got[0] == (0, "All", "All")
    assert (3, "      Food", "All → Expenses → Necessities → Food") in got
    edges.createOrReplaceTempView("edges")
    assert rows(hierarchy.category_tree_sql(spark, "edges")) == got
    assert hierarchy.category_tree(edges.limit(0)).count() == 0


def test_deep_chain(spark):
    edges = spark.createDataFrame([(i, f"n{i}", i - 1 if i else None, i) for i in range(12)], schemas.HIERARCHY)
    assert hierarchy.category_tree(edges).count() == 12


def test_a_very_deep_chain_takes_few_rounds(spark, monkeypatch):
    rounds = []
    real = hierarchy.stored_sums
    monkeypatch.setattr(hierarchy, "stored_sums", lambda *args, **sums: rounds.append(1) or real(*args, **sums))
    depth = 3000
    edges = spark.range(depth).select(
        F.col("id").alias("category_id"), F.lit("n").alias("category_name"),
        F.when(F.col("id") > 0, F.col("id") - 1).alias("parent_category_id"), F.col("id").cast("int").alias("level"))
    tree = hierarchy.category_tree(edges)
    lengths = tree.select((F.length("full_path") + 3).alias("n")).orderBy("n").collect()
    assert [r.n for r in lengths] == [4 * (k + 1) for k in range(depth)]
    assert len(rounds) <= 14


def test_loops_without_a_root_do_not_grow_for_ever(spark, monkeypatch):
    monkeypatch.setattr(hierarchy, "ROUNDS", 3)
    rows_ = [(1, "root", None, 0), *[(k, f"n{k}", k - 1, k) for k in range(2, 40)], (50, "x", 52, 1), (51, "y", 50, 1), (52, "z", 51, 1)]
    assert hierarchy.category_tree(spark.createDataFrame(rows_, schemas.HIERARCHY)).count() == 39


def test_parts_without_a_root_are_left_out(spark):
    rows_ = [(1, "root", None, 0), (2, "a", 1, 1), (9, "b", 2, 2), (9, "twin", 1, 1), (10, "c", 9, 3),
             (20, "lost", 99, 1), (30, "x", 31, 1), (31, "y", 30, 2), (32, "z", 31, 3), (2, "half lost", 30, 4)]
    got = as_set(hierarchy.category_tree(spark.createDataFrame(rows_, schemas.HIERARCHY)), "full_path")
    assert got == {(p.replace(">", hierarchy.ARROW),) for p in ("root", "root>a", "root>a>b", "root>twin", "root>a>b>c", "root>twin>c")}


def test_batch_job(spark, small, tmp_path):
    out = str(tmp_path / "lake")
    paths = batch.run_batch(spark, tables.raw_ledger(spark, small), tables.news(spark, small), out)
    shapes = {r.layer: (r.rows, r.columns) for r in batch.layer_shapes(spark, paths).collect()}
    assert shapes["bronze/transactions"][0] > shapes["silver/transactions"][0] == 1500
    assert shapes["silver/news"] == (799, 3)
    gold = spark.read.parquet(paths["gold/daily_summary"])
    assert gold.agg(F.sum("transaction_count")).first()[0] == 1500
    log = LineageLog(spark, f"{out}/lineage").entries()
    counted = {r.destination: r.row_count for r in log.collect()}
    assert counted[paths["silver/transactions"]] == 1500
    # Running again replaces the layers.
    again = batch.run_batch(spark, tables.raw_ledger(spark, small), None, out)
    assert batch.layers(spark, out) == again
    assert spark.read.parquet(again["silver/transactions"]).count() == 1500


def test_star_tables_and_marts(spark, small, tmp_path):
    ledger_ = tables.ledger(spark, small)
    paths = warehouse.build_star_tables(spark, ledger_, str(tmp_path / "star"))
    fact = spark.read.parquet(paths["fact_transactions"])
    wide = spark.read.parquet(paths["warehouse_transactions"])
    assert fact.count() == wide.count() == 1500
    assert fact.select("loaded_at").distinct().count() == 1
    shared = ["transaction_id", "category_group", "account_type", "merchant_type", "year", "month"]
    assert as_set(wide, *shared) == as_set(star.warehouse(ledger_), *shared)
    accounts = spark.read.parquet(paths["dim_account"])
    assert fact.join(accounts, "account_id").count() == 1500
    marts = warehouse.build_marts(spark, tables.raw_ledger(spark, small), str(tmp_path / "marts"))
    assert spark.read.parquet(marts["financial_summary"]).count() == 100
    trends = spark.read.parquet(marts["monthly_trends"])
    assert trends.filter("category = 'All'").agg(F.sum("transaction_count")).first()[0] == \
        spark.read.parquet(marts["stg_transactions"]).count()


def test_statement_load_is_idempotent(spark, tmp_path):
    csv = tmp_path / "statement.csv"
    csv.write_text("date,amount,category,account\n2024-01-01,-4.50,Coffee,a\n2024-01-02,10.00,,a\n")
    statement = files.read_csv(spark, str(csv), schemas.STATEMENT)
    assert statement.first().amount == Decimal("-4.50")
    assert files.read_csv(spark, str(csv)).dtypes[1] == ("amount", "string")
    path = str(tmp_path / "ledger")
    files.append_rows(statement.filter("category IS NOT NULL"), path)
    assert batch.load_statement(spark, statement.filter("category IS NOT NULL"), path) == 0
    assert batch.load_statement(spark, statement, path) == 1  # the row without a category
    assert spark.read.parquet(path).count() == 2


def test_payload_files(spark, tmp_path):
    (tmp_path / "answer.json").write_text(
        '{"transactions": [{"id": 1, "date": "2024-01-01", "amount": 2.5,\n "description": "x", "account": "a"}]}')
    got = files.read_payloads(spark, str(tmp_path / "answer.json")).first()
    assert got.transactions[0].amount == 2.5


def test_monthly_summary_refresh(spark, small, tmp_path):
    warehouse = star.warehouse(tables.ledger(spark, small))
    path = str(tmp_path / "summary")
    jobs.refresh_monthly_summary(warehouse, path)
    before = as_set(jobs.read_monthly_summary(spark, path), "year", "month", "category_group", "account_type", "net_amount")
    jobs.refresh_monthly_summary(warehouse, path, since=dt.date(2001, 6, 20))
    after = as_set(jobs.read_monthly_summary(spark, path), "year", "month", "category_group", "account_type", "net_amount")
    assert before == after
    stored = jobs.read_monthly_summary(spark, path)
    assert (reports.year_totals_from_summary(stored, 2000).collect()
            == reports.year_totals(warehouse, 2000).collect())


def test_report_files(spark, small, tmp_path):
    warehouse = star.warehouse(tables.ledger(spark, small))
    budget = files.read_or_empty(spark, "monthly_budget", schemas.BUDGET)
    assert budget.count() == 0
    written = jobs.write_monthly_reports(warehouse, budget, AS_OF, str(tmp_path))
    assert [p.rsplit("/", 1)[1] for p in written] == ["summary_200107", "insights_200107", "budget_vs_actual_200107"]
    assert spark.read.option("header", True).csv(written[1]).count() == 4
    jobs.write_daily_report(warehouse, AS_OF, str(tmp_path))
    scores = jobs.run_quality(warehouse, dt.date(2001, 8, 1), str(tmp_path))
    assert spark.read.option("header", True).csv(scores).count() == 3


def test_saved_tables_and_catalog(spark, small):
    ledger_ = tables.ledger(spark, small)
    files.save_table(ledger_, "ledger_table")
    catalog.register_views({"ledger_view": ledger_})
    got = {r.object_name: (r.kind, r.row_count) for r in catalog.catalog_stats(spark).collect()}
    assert got["ledger_table"] == ("table", 1500) and got["ledger_view"] == ("view", None)
    assert files.read_or_empty(spark, "ledger_table", schemas.LEDGER).count() == 1500
    assert catalog.adhoc_sql(spark, "SELECT count(*) AS n FROM ledger_view").first().n == 1500
    named = catalog.Catalog(ledger_, AS_OF)
    assert named.run("recent_transactions", limit=3).count() == 3
    for name in named.queries:
        assert named.run(name).columns
    with pytest.raises(KeyError, match="spending_trends"):
        named.run("nothing")


def test_table_scan_options():
    source = relational.LedgerTable("jdbc:postgresql://host/db", lower=0, upper=1000, ranges=8, properties={"user": "u"})
    options = source.scan_options()
    assert (options["partitionColumn"], options["numPartitions"], options["user"]) == ("id", "8", "u")


@pytest.mark.parametrize("scale", ["0.001", "0.01", "0.1"])
def test_stated_schemas_are_those_of_the_files(spark, scale):
    for name in tables.SCHEMAS:
        path = f"/root/testdata/sf{scale}"
        assert tables.table(spark, path, name).dtypes == spark.read.parquet(f"{path}/{name}.parquet").dtypes


def test_stored_counted(spark):
    kept, rows_ = session.stored_counted(spark.range(7), "numbers")
    assert rows_ == 7 and kept.count() == 7
    empty, none = session.stored_counted(spark.range(0), "numbers")
    assert none == 0 and empty.columns == ["id"]


def halves(spark, small):
    raw = tables.raw_ledger(spark, small)
    return raw.filter("date < '1998-01-01'"), raw.filter("date >= '1998-01-01'")


def test_a_second_batch_leaves_nothing_of_the_first(spark, small, tmp_path):
    old, new = halves(spark, small)
    out = str(tmp_path / "lake")
    batch.run_batch(spark, old, None, out)
    paths = batch.run_batch(spark, new, None, out)
    silver = spark.read.parquet(paths["silver/transactions"])
    assert silver.filter("year < 1998").count() == 0
    gold = spark.read.parquet(paths["gold/daily_summary"])
    assert gold.agg(F.sum("transaction_count")).first()[0] == new.distinct().count() == silver.count()


def test_a_second_star_has_no_foreign_keys_of_the_first(spark, small, tmp_path):
    ledger_ = tables.ledger(spark, small)
    old, new = ledger_.filter("date < '1998-01-01'"), ledger_.filter("date >= '1998-01-01'")
    out = str(tmp_path / "star")
    warehouse.build_star_tables(spark, old, out)
    warehouse.build_star_tables(spark, new, out)
    paths = warehouse.star_tables(spark, out)
    fact, accounts = spark.read.parquet(paths["fact_transactions"]), spark.read.parquet(paths["dim_account"])
    assert fact.count() == new.count() and fact.filter("year < 1998").count() == 0
    named = fact.join(accounts, "account_id").select(F.col("transaction_id").alias("id"), F.col("account_name").alias("account"))
    assert as_set(named) == as_set(new.select("id", "account"))


def test_a_second_summary_has_no_months_of_the_first(spark, small, tmp_path):
    wide = star.warehouse(tables.ledger(spark, small))
    path = str(tmp_path / "summary")
    jobs.refresh_monthly_summary(wide.filter("year < 1998"), path)
    jobs.refresh_monthly_summary(wide.filter("year >= 1998"), path)
    stored = jobs.read_monthly_summary(spark, path)
    assert stored.filter("year < 1998").count() == 0
    # A month in the refreshed range that has no rows any more goes; older ones stay.
    jobs.refresh_monthly_summary(wide.filter("year < 2001 OR month <> 6"), path, since=dt.date(2001, 5, 1))
    stored = jobs.read_monthly_summary(spark, path)
    assert stored.filter("year = 2001 AND month = 6").count() == 0
    assert stored.filter("year = 2001 AND month = 5").count() > 0 and stored.filter("year = 1999").count() > 0


def test_a_loop_in_a_tree_is_an_error(spark):
    edges = spark.createDataFrame([(1, "root", None, 0), (2, "a", 1, 1), (3, "b", 2, 2), (2, "a again", 3, 3)], schemas.HIERARCHY)
    with pytest.raises(ValueError, match="own ancestor"):
        hierarchy.category_tree(edges).count()


def test_checkpoint_folder_comes_from_the_session(spark):
    assert session.checkpoint_dir(spark).startswith("file:") or session.checkpoint_dir(spark).startswith("/")
    assert spark.conf.get("spark.checkpoint.dir").rsplit("/", 1)[1] in session.checkpoint_dir(spark)


FRAUD = [
    ("1", -1.0, "Food", "NY", True, "2024-01-01 12:00:00", 100, 100),
    ("2", -350.0, "Other", "INTERNATIONAL", False, "2024-01-01 12:00:00", 85, 85),
    ("3", -250.0, "Other", "NY", False, "2024-01-01 03:00:00", 70, 70),
    ("4", -600.0, "Food", "INTERNATIONAL", False, "2024-01-01 03:00:00", 85, 215),
    ("5", -1.0, "Food", "NY", None, "2024-01-01 12:00:00", 10, 0),
    ("6", 600.0, "Entertainment", "NY", False, "2024-01-01 12:00:00", 60, 60),
]


def test_fraud_rules(spark):
    df = spark.createDataFrame([r[:6] for r in FRAUD],
                               "transaction_id STRING, amount DOUBLE, category STRING, location STRING, "
                               "is_fraudulent BOOLEAN, timestamp STRING")
    first = dict(rows(running.fraud_by_first_match(df), "transaction_id", "fraud_risk_score"))
    assert first == {r[0]: r[6] for r in FRAUD}
    added = {r.transaction_id: r for r in running.fraud_by_sum(df).collect()}
    assert {k: r.fraud_score for k, r in added.items()} == {r[0]: r[7] for r in FRAUD}
    assert added["4"].reasons == ["Large international transaction", "Unusual hour transaction (late night)",
                                  "Large discretionary spending"]
    assert added["5"].reasons == [] and not added["5"].is_alert
    assert rows(df.limit(1).select(fraud.alert_level(F.lit(40)))) == [("MEDIUM_RISK",)]


def test_null_dates_stay_out_of_the_running_balance(spark):
    book = ledger(spark, (1, None, 5, "A", "x"), (2, "2024-01-01", 7, "A", "x"))
    assert rows(running.running_analytics(book), "id", "date", "running_balance") == [(2, day("2024-01-01"), 7.0)]
