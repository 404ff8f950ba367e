"""Every operator as a query over the benchmark tables."""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.functions import fraud, labels
from tallyline.operators import (cleaning, contracts, forecast, hierarchy, quality, reports,
                                 running, star, summaries, windows)
from tallyline.plans import batch, catalog, jobs, warehouse
from tallyline.plans.views import answer
from tallyline.schemas import LEDGER, PAYLOAD
from tallyline.session import checkpoint_dir, small_table, stored
from tallyline.sources import files, tables, topics
from tallyline.sources.lineage import LineageLog
from tallyline.streaming import jobs as streams

Query = Callable[[SparkSession, str], DataFrame]

AS_OF = dt.date(2001, 7, 15)
YEAR = 2000
# Amounts of the benchmark ledger are about a hundred times those the limits were made for.
SCALE = 100
STREAM_LIMITS = fraud.FraudLimits(discretionary=250)
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

BUDGET_ROWS = [(2001, m, g, a) for m in (5, 6) for g, a in (
    ("Dining", 900_000), ("Retail", 450_000), ("Transportation", 500_000), ("Income", 100_000),
    ("Housing", 250_000))]


def _ledger_query(build: Callable[..., DataFrame], *args, **kwargs) -> Query:
    return lambda spark, folder: build(tables.ledger(spark, folder), *args, **kwargs)


def _warehouse_query(build: Callable[..., DataFrame], *args, **kwargs) -> Query:
    return lambda spark, folder: build(
        star.warehouse(tables.ledger(spark, folder), SCALE), *args, **kwargs)


def _staged_query(build: Callable[..., DataFrame], *args, **kwargs) -> Query:
    return lambda spark, folder: build(
        cleaning.staged_transactions(tables.raw_ledger(spark, folder)), *args, **kwargs)


def _stream_query(build: Callable[..., DataFrame], *args, **kwargs) -> Query:
    return lambda spark, folder: build(tables.transactions(spark, folder), *args, **kwargs)


def _spending_query(build: Callable[..., DataFrame], *args, days: int = 30, **kwargs) -> Query:
    return lambda spark, folder: build(
        reports.spending_by_category(tables.ledger(spark, folder), AS_OF, days), *args, **kwargs)


def _with_star(build: Callable[..., DataFrame]) -> Query:
    def query(spark: SparkSession, folder: str) -> DataFrame:
        ledger = tables.ledger(spark, folder)
        return build(ledger, star.build_star(ledger))
    return query


def scan_parquet_sql(spark: SparkSession, folder: str) -> DataFrame:
    source = files.parquet_relation(f"{folder}/orders.parquet")
    return spark.sql(f"""
        SELECT o_orderpriority AS priority, count(*) AS orders,
               CAST(sum(CAST(o_totalprice AS DECIMAL(12,2))) AS DOUBLE) AS total
        FROM {source} GROUP BY o_orderpriority""")


def adhoc_sql(spark: SparkSession, folder: str) -> DataFrame:
    return catalog.adhoc_sql(spark, """
        SELECT account, count(*) AS transactions, CAST(sum(amount) AS DOUBLE) AS balance
        FROM {ledger} WHERE date >= DATE '2000-01-01' GROUP BY account""",
        {"ledger": tables.ledger(spark, folder)})


def table_stats(spark: SparkSession, folder: str) -> DataFrame:
    return catalog.object_stats({t: tables.table(spark, folder, t) for t in TABLES})


def dedup_append(spark: SparkSession, folder: str) -> DataFrame:
    booked, incoming = tables.booked_and_incoming(spark, folder)
    return summaries.as_double(cleaning.new_rows(incoming, booked), "amount")


def json_explode(spark: SparkSession, folder: str) -> DataFrame:
    """Each ledger row as a JSON answer that holds the row and its reversal."""
    def item(amount):
        return F.struct("id", F.date_format("date", "yyyy-MM-dd").alias("date"),
                        amount.cast("double").alias("amount"),
                        F.col("category").alias("description"), "account")
    answers = tables.ledger(spark, folder).select(F.to_json(F.struct(
        F.array(item(F.col("amount")), item(-F.col("amount"))).alias("transactions"))).alias("value"))
    rows = cleaning.explode_payload(topics.decode(answers, PAYLOAD))
    return summaries.as_double(rows, "amount")


def json_decode(spark: SparkSession, folder: str) -> DataFrame:
    messages = tables.table(spark, folder, "events").select(
        "event_id", F.col("props").cast("binary").alias("value"))
    return topics.decode(messages, "k INT", keep=["event_id"])


def json_encode(spark: SparkSession, folder: str) -> DataFrame:
    rows = tables.transactions(spark, folder).select(
        F.col("transaction_id").cast("string").alias("transaction_id"),
        F.col("account_id").cast("string").alias("account_id"), "category", "location")
    return topics.encode(rows, "account_id")


def category_remap(spark: SparkSession, folder: str) -> DataFrame:
    raw = tables.raw_ledger(spark, folder)
    return raw.select("id", labels.remap_category(F.col("category")).alias("category"))


def category_remap_strict(spark: SparkSession, folder: str) -> DataFrame:
    raw = tables.raw_ledger(spark, folder)
    return raw.select("id", labels.remap_category(
        F.col("category"), labels.STRICT_CATEGORIES, default=None, lower=False).alias("category"))


def silver_news(spark: SparkSession, folder: str) -> DataFrame:
    clean = cleaning.silver_news(tables.news(spark, folder))
    return clean.withColumn("published_at", F.col("published_at").cast("timestamp_ntz"))


def amount_buckets(spark: SparkSession, folder: str) -> DataFrame:
    return tables.ledger(spark, folder).select(
        "id", labels.size_class(F.col("amount"), SCALE).alias("amount_category"))


def txn_type(spark: SparkSession, folder: str) -> DataFrame:
    amount = F.col("amount")
    return tables.ledger(spark, folder).select(
        "id", *[labels.transaction_type(amount, s).alias(s) for s in labels.TYPE_NAMES],
        F.abs(amount).cast("double").alias("absolute_amount"))


def fact_transactions(ledger: DataFrame, built: star.Star) -> DataFrame:
    return summaries.as_double(star.fact_transactions(ledger, built), "amount", "absolute_amount")


def warehouse_transactions(ledger: DataFrame, built: star.Star) -> DataFrame:
    return summaries.as_double(star.warehouse_transactions(ledger, built, SCALE),
                               "amount", "absolute_amount")


def financial_dashboard(spark: SparkSession, folder: str) -> DataFrame:
    ledger = tables.ledger(spark, folder)
    return summaries.financial_dashboard(
        summaries.daily_summary(ledger), summaries.category_summary(ledger),
        summaries.account_balance(ledger))


def category_tree(spark: SparkSession, folder: str) -> DataFrame:
    return hierarchy.category_tree(geography(spark, folder))


def geography(spark: SparkSession, folder: str) -> DataFrame:
    """World -> region -> nation -> customer as a tree of parent links."""
    def nodes(df, offset, key, name, parent, level):
        return df.select((F.col(key).cast("bigint") + offset).alias("category_id"),
                         F.col(name).alias("category_name"), parent.alias("parent_category_id"),
                         F.lit(level).alias("level"))
    region, nation, customer = (tables.table(spark, folder, t) for t in ("region", "nation", "customer"))
    root = region.agg(F.lit(0).cast("bigint").alias("category_id"), F.lit("All").alias("category_name"),
                      F.lit(None).cast("bigint").alias("parent_category_id"), F.lit(0).alias("level"))
    return (root
            .unionByName(nodes(region, 1_000, "r_regionkey", "r_name", F.lit(0).cast("bigint"), 1))
            .unionByName(nodes(nation, 10_000, "n_nationkey", "n_name",
                               F.col("n_regionkey").cast("bigint") + 1_000, 2))
            .unionByName(nodes(customer, 1_000_000, "c_custkey", "c_name",
                               F.col("c_nationkey").cast("bigint") + 10_000, 3)))


def categorize_text(spark: SparkSession, folder: str) -> DataFrame:
    docs = tables.table(spark, folder, "documents").select(
        "doc_id", "text", (F.lit(1500) - F.col("n_chars")).alias("amount"))
    return running.categorize_text(docs).select("doc_id", "category")


def budget_vs_actual(spark: SparkSession, folder: str) -> DataFrame:
    names = ["year", "month", "category_group", "budget_amount"]
    budget = small_table(spark, dict(zip(names, map(list, zip(*BUDGET_ROWS)))),
                         "year INT, month INT, category_group STRING, budget_amount DECIMAL(10,2)")
    return reports.budget_vs_actual(budget, star.warehouse(tables.ledger(spark, folder)), AS_OF)


def financial_summary(spark: SparkSession, folder: str) -> DataFrame:
    row = reports.financial_summary(tables.ledger(spark, folder), AS_OF)
    names = F.transform("category_breakdown", lambda e: e["category"])
    return row.withColumn("top_categories", F.array_join(names, ",")).drop("category_breakdown")


def _plain_window(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.col(c).cast("timestamp_ntz") for c in ("window_start", "window_end")})


def fraud_additive(transactions: DataFrame) -> DataFrame:
    scored = running.fraud_by_sum(transactions, STREAM_LIMITS)
    return scored.select("transaction_id", "fraud_score", "is_alert",
                         F.array_join("reasons", "; ").alias("reasons"))


def gold_overview(spark: SparkSession, folder: str) -> DataFrame:
    silver = stored(cleaning.silver_transactions(tables.raw_ledger(spark, folder)), "silver")
    return batch.gold_overview(silver)


RECENT = "1998-01-01"


def pipeline_gold(spark: SparkSession, folder: str) -> DataFrame:
    """The batch job run over the old rows, then over the recent ones: gold of the latter, from its files."""
    raw = tables.raw_ledger(spark, folder)
    out = f"{checkpoint_dir(spark)}/lake-{uuid.uuid4().hex}"
    batch.run_batch(spark, raw.filter(F.col("date") < RECENT), None, out)
    paths = batch.run_batch(spark, raw.filter(F.col("date") >= RECENT), None, out)
    return batch.overview({name: spark.read.parquet(paths[f"gold/{name}"]) for name in batch.GOLD})


def star_rebuilt(spark: SparkSession, folder: str) -> DataFrame:
    """Star tables built twice; names of the second fact through its own dimensions."""
    ledger = tables.ledger(spark, folder)
    out = f"{checkpoint_dir(spark)}/star-{uuid.uuid4().hex}"
    warehouse.build_star_tables(spark, ledger.filter(F.col("date") < F.lit(RECENT).cast("date")), out)
    warehouse.build_star_tables(spark, ledger.filter(F.col("date") >= F.lit(RECENT).cast("date")), out)
    stored = {name: spark.read.parquet(path) for name, path in warehouse.star_tables(spark, out).items()}
    return (stored["fact_transactions"].join(stored["dim_account"], "account_id")
            .join(stored["dim_category"], "category_id")
            .select("transaction_id", "account_name", "category_name"))


def layer_shapes(spark: SparkSession, folder: str) -> DataFrame:
    """Rows and columns of the layers that the batch job has written."""
    out = f"{checkpoint_dir(spark)}/lake-{uuid.uuid4().hex}"
    return batch.layer_shapes(spark, batch.run_batch(spark, tables.raw_ledger(spark, folder), None, out))


def lineage_counts(spark: SparkSession, folder: str) -> DataFrame:
    """What the lineage log of a batch run says about each step."""
    out = f"{checkpoint_dir(spark)}/lake-{uuid.uuid4().hex}"
    batch.run_batch(spark, tables.raw_ledger(spark, folder), None, out)
    return LineageLog(spark, f"{out}/lineage").entries().select(
        F.regexp_extract("destination", "([^/]+/[^/]+)$", 1).alias("layer"), "transformation", "row_count")


def monthly_summary_refreshed(spark: SparkSession, folder: str) -> DataFrame:
    """The stored monthly summary after all months from 1998 on were refreshed without one of them."""
    wide = star.warehouse(tables.ledger(spark, folder))
    path = f"{checkpoint_dir(spark)}/summary-{uuid.uuid4().hex}"
    jobs.refresh_monthly_summary(wide, path)
    jobs.refresh_monthly_summary(wide.filter("NOT (year = 1998 AND month = 5)"), path, dt.date(1998, 1, 1))
    return summaries.as_double(jobs.read_monthly_summary(spark, path).select(
        F.col("year").cast("int").alias("year"), F.col("month").cast("int").alias("month"),
        "category_group", "account_type", "transaction_count", "net_amount"), "net_amount")


def _appended_summary(spark: SparkSession, wide: DataFrame) -> str:
    """The monthly summary of the old rows, then brought up to date by two batches, one of them sent twice."""
    path = f"{checkpoint_dir(spark)}/summary-{uuid.uuid4().hex}"
    recent, last = F.lit(RECENT).cast("date"), F.lit("2000-06-15").cast("date")
    jobs.refresh_monthly_summary(wide.filter(F.col("date_key") < recent), path)
    batches = {"a": wide.filter((F.col("date_key") >= recent) & (F.col("date_key") < last)), "b": wide.filter(F.col("date_key") >= last)}
    for name in ("a", "b", "a"):
        jobs.append_to_monthly_summary(batches[name], path, name)
    return path


def summary_after_append(spark: SparkSession, folder: str) -> DataFrame:
    """The monthly summary after appended rows alone were aggregated and merged."""
    path = _appended_summary(spark, star.warehouse(tables.ledger(spark, folder)))
    return summaries.as_double(jobs.read_monthly_summary(spark, path).withColumns(
        {c: F.col(c).cast("int") for c in ("year", "month")}), "net_amount", "total_expenses", "total_income")


def expenses_answered_by_view(spark: SparkSession, folder: str) -> DataFrame:
    """Expenses of a year, which the stored summary covers."""
    wide = star.warehouse(tables.ledger(spark, folder))
    view = jobs.monthly_view(spark, _appended_summary(spark, wide))
    return summaries.as_double(answer(jobs.expenses_of(YEAR), wide, [view]).withColumns(
        {c: F.col(c).cast("int") for c in ("year", "month")}), "total")


def csv_scan(spark: SparkSession, folder: str) -> DataFrame:
    """The ledger written as CSV with a header and scanned again with its schema."""
    path = f"{checkpoint_dir(spark)}/csv-{uuid.uuid4().hex}"
    tables.ledger(spark, folder).write.option("header", True).csv(path)
    return summaries.as_double(files.read_csv(spark, path, LEDGER), "amount")


def csv_report(spark: SparkSession, folder: str) -> DataFrame:
    """The monthly report file, read back as its readers would."""
    report = reports.monthly_report(star.warehouse(tables.ledger(spark, folder)), AS_OF)
    path = files.write_report(report, f"{checkpoint_dir(spark)}/reports-{uuid.uuid4().hex}", f"monthly_report_{AS_OF:%Y%m%d}")
    return files.read_csv(spark, path, report.schema)


def statement_loaded(spark: SparkSession, folder: str) -> DataFrame:
    """The ledger after a statement was appended and then sent again: rows and sum of each account."""
    booked, incoming = tables.booked_and_incoming(spark, folder)
    path = f"{checkpoint_dir(spark)}/ledger-{uuid.uuid4().hex}"
    files.write_layer(booked.drop("id"), path)
    for _ in range(2):
        batch.load_statement(spark, incoming, path)
    return summaries.as_double(spark.read.parquet(path).groupBy("account").agg(
        F.count(F.lit(1)).alias("transactions"), F.sum("amount").alias("balance")), "balance")


def contract_from_file(spark: SparkSession, folder: str) -> DataFrame:
    """The report of a contract that was stored as JSON and read again."""
    path = f"{checkpoint_dir(spark)}/contract-{uuid.uuid4().hex}"
    contract = contracts.ledger_contract(-400_000, 400_000)
    spark.createDataFrame([(contract.to_json(),)], "value STRING").coalesce(1).write.text(path, lineSep="\x00")
    text = spark.read.text(path, wholetext=True).first().value.rstrip("\x00")
    return contracts.DataContract.from_json(text).report(tables.ledger(spark, folder))


def catalog_stats(spark: SparkSession, folder: str) -> DataFrame:
    """Statistics of session objects: stored tables with their rows, a view without."""
    for name in ("orders", "events"):
        files.save_table(tables.table(spark, folder, name), f"stats_of_{name}")
    catalog.register_views({"stats_of_view": tables.ledger(spark, folder)})
    return catalog.catalog_stats(spark).filter("object_name LIKE 'stats_of_%'")


def contract_offenders(spark: SparkSession, folder: str) -> DataFrame:
    """Every value that the ledger contract does not allow, over the raw ledger."""
    return contracts.ledger_contract().all_offenders(tables.raw_ledger(spark, folder))


def contract_schema_errors(spark: SparkSession, folder: str) -> DataFrame:
    """What the ledger contract says about the columns of the raw ledger, with its rows."""
    raw = tables.raw_ledger(spark, folder).drop("account").withColumn("note", F.lit("x"))
    errors = contracts.ledger_contract().schema_errors(raw)
    lines = F.explode(F.array(*map(F.lit, errors)))
    return raw.agg(F.count(F.lit(1)).alias("rows")).select(lines.alias("error"), "rows")


def json_decode_dirty(spark: SparkSession, folder: str) -> DataFrame:
    """Messages of which some are no JSON, lack an amount or have an unreadable time: what is left of each."""
    n = F.col("event_id") % 5
    events = tables.table(spark, folder, "events").select("event_id", F.when(n == 0, F.lit("no json")).when(
        n == 1, F.concat(F.lit('{"amount": null, "timestamp": "2024-01-01T00:00:00", "account_id": "'), F.col("user_id"), F.lit('"}'))).when(
        n == 2, F.concat(F.lit('{"amount": 2.5, "timestamp": "soon", "account_id": "'), F.col("user_id"), F.lit('"}'))).otherwise(
        F.concat(F.lit('{"amount": 2.5, "timestamp": "2024-01-01T00:00:00", "account_id": "'), F.col("user_id"), F.lit('"}'))).alias("value"))
    typed = streams.typed(topics.decode(events, keep=["event_id"]))
    return typed.select("event_id", "account_id", F.col("amount").cast("double").alias("amount"),
                        F.col("ts").cast("timestamp_ntz").alias("ts"))


def ends_of_ledger(spark: SparkSession, folder: str) -> DataFrame:
    """The first and last rows of the ledger by id."""
    ledger = tables.ledger(spark, folder).select("id", "date", "category", "account")
    parts = [ledger.orderBy(order).limit(5).withColumn("part", F.lit(name)) for name, order in (("head", F.asc("id")), ("tail", F.desc("id")))]
    return parts[0].unionByName(parts[1])


def named_query(spark: SparkSession, folder: str) -> DataFrame:
    """A report looked up by name, over views."""
    found = catalog.Catalog(tables.ledger(spark, folder), AS_OF).run("weekly_patterns")
    catalog.register_views({"found_patterns": found})
    return spark.table("found_patterns")


QUERIES: dict[str, Query] = {
    # stored layers and jobs
    "pipeline_gold": pipeline_gold,
    "star_rebuilt": star_rebuilt,
    "layer_shapes": layer_shapes,
    "lineage_counts": lineage_counts,
    "monthly_summary_refreshed": monthly_summary_refreshed,
    "summary_after_append": summary_after_append,
    "expenses_answered_by_view": expenses_answered_by_view,
    "csv_scan": csv_scan,
    "csv_report": csv_report,
    "statement_loaded": statement_loaded,
    "contract_from_file": contract_from_file,
    "catalog_stats": catalog_stats,
    "contract_offenders": contract_offenders,
    "contract_schema_errors": contract_schema_errors,
    "json_decode_dirty": json_decode_dirty,
    "ends_of_ledger": ends_of_ledger,
    "named_query": named_query,
    # sources
    "scan_parquet_sql": scan_parquet_sql,
    "adhoc_sql": adhoc_sql,
    "table_stats": table_stats,
    "dedup_append": dedup_append,
    "json_explode": json_explode,
    "json_decode": json_decode,
    "json_encode": json_encode,
    # cleaning and labels
    "silver_transactions": lambda s, d: cleaning.silver_transactions(tables.raw_ledger(s, d)),
    "silver_news": silver_news,
    "category_remap": category_remap,
    "category_remap_strict": category_remap_strict,
    "stg_transactions": lambda s, d: summaries.as_double(
        cleaning.staged_transactions(tables.resent_ledger(s, d)), "amount"),
    "amount_buckets": amount_buckets,
    "txn_type": txn_type,
    "analytics_transactions": lambda s, d: summaries.as_double(
        reports.analytics_transactions(tables.ledger(s, d)), "amount", "absolute_amount"),
    "categorize_text": categorize_text,
    "sentiment_summary": lambda s, d: reports.sentiment_summary(
        cleaning.silver_news(tables.news(s, d))),
    # star schema
    "dim_date": _ledger_query(star.dim_date),
    "dim_category": lambda s, d: star.dim_category(tables.ledger(s, d)).frame,
    "dim_account": lambda s, d: star.dim_account(tables.ledger(s, d)).frame,
    "dim_merchant": lambda s, d: star.dim_merchant(tables.ledger(s, d)).frame,
    "fact_transactions": _with_star(fact_transactions),
    "warehouse_transactions": _with_star(warehouse_transactions),
    "star_query": _with_star(star.star_query),
    # gold and marts
    "daily_summary": _ledger_query(summaries.daily_summary),
    "category_summary": _ledger_query(summaries.category_summary),
    "account_balance": _ledger_query(summaries.account_balance),
    "financial_dashboard": financial_dashboard,
    "mart_daily": _staged_query(summaries.mart_daily),
    "mart_category": _staged_query(summaries.mart_category),
    "mart_account": _staged_query(summaries.mart_account),
    "monthly_trends": _staged_query(summaries.monthly_trends),
    "financial_summary_mart": _staged_query(summaries.financial_summary_mart),
    "gold_overview": gold_overview,
    # reports over the warehouse table
    "running_totals": _warehouse_query(reports.running_totals, rows=None),
    "having_report": _warehouse_query(reports.having_report, YEAR),
    "monthly_financial_summary": lambda s, d: summaries.as_double(
        reports.monthly_financial_summary(star.warehouse(tables.ledger(s, d))),
        "net_amount", "total_expenses", "total_income"),
    "monthly_view_report": lambda s, d: reports.monthly_view_report(
        reports.monthly_financial_summary(star.warehouse(tables.ledger(s, d))), YEAR),
    "warehouse_scalars": _warehouse_query(reports.warehouse_scalars),
    "year_totals": _warehouse_query(reports.year_totals, YEAR),
    "year_totals_mv": lambda s, d: reports.year_totals_from_summary(
        reports.monthly_financial_summary(star.warehouse(tables.ledger(s, d))), YEAR),
    "daily_report": _warehouse_query(reports.daily_report, AS_OF),
    "monthly_report": _warehouse_query(reports.monthly_report, AS_OF),
    "monthly_insights": _warehouse_query(reports.monthly_insights, AS_OF),
    "budget_vs_actual": budget_vs_actual,
    # reports over the ledger
    "monthly_stats": _ledger_query(reports.monthly_stats),
    "category_analytics": _ledger_query(reports.category_analytics),
    "weekly_patterns": _ledger_query(reports.weekly_patterns),
    "category_breakdown": _ledger_query(reports.category_breakdown),
    "category_breakdown_simple": _ledger_query(reports.category_breakdown_simple),
    "account_analysis": _ledger_query(reports.account_analysis),
    "current_month_detailed": _ledger_query(reports.current_month_detailed, AS_OF),
    "spending_trends": _ledger_query(reports.spending_trends),
    "financial_summary": financial_summary,
    "dashboard_lines": _ledger_query(reports.dashboard_lines, AS_OF),
    "top_categories": _ledger_query(reports.top_categories, AS_OF),
    "spending_by_category": _ledger_query(reports.spending_by_category, AS_OF),
    "spending_totals": _spending_query(reports.spending_totals),
    "historical_monthly": _ledger_query(reports.historical_monthly, AS_OF),
    "historical_enhanced": _ledger_query(reports.historical_enhanced, AS_OF),
    "recent_transactions": _ledger_query(running.recent_transactions),
    "running_analytics": lambda s, d: summaries.as_double(
        running.running_analytics(tables.ledger(s, d)), "amount"),
    "budget_recommend_v1": _spending_query(reports.recommend_budget),
    "budget_recommend_v2": _spending_query(reports.recommend_budget_by_trend),
    # hierarchy
    "category_tree": category_tree,
    # quality
    "contract_report": _ledger_query(
        lambda ledger: contracts.ledger_contract(-400_000, 400_000).report(ledger)),
    "expectation_report": _ledger_query(
        lambda ledger: quality.expectation_report(ledger, quality.ledger_suite(-480_000, 480_000))),
    "dbt_tests": lambda s, d: quality.staging_tests(
        cleaning.staged_transactions(tables.resent_ledger(s, d))),
    "dq_completeness": _warehouse_query(quality.completeness, AS_OF),
    "dq_accuracy": _warehouse_query(quality.accuracy, AS_OF),
    "dq_freshness": _warehouse_query(quality.freshness, AS_OF),
    "dq_schema": _warehouse_query(quality.schema_check),
    "quality_report": _warehouse_query(quality.quality_report, AS_OF),
    # forecasts and unusual amounts
    "spend_trend_fit": _ledger_query(forecast.spend_trend_fit, AS_OF),
    "predict_spending": _ledger_query(forecast.predict_spending, AS_OF),
    "spend_multi_fit": _ledger_query(forecast.spend_multi_fit, AS_OF),
    "predict_multi": _ledger_query(forecast.predict_multi, AS_OF),
    "predict_fallback": _spending_query(forecast.predict_fallback, AS_OF),
    "zscore_anomalies": lambda s, d: summaries.as_double(
        running.unusual_amounts(tables.ledger(s, d)), "amount"),
    # batch twins of the streaming operators
    "fraud_priority": _stream_query(lambda t: running.fraud_by_first_match(t, STREAM_LIMITS).select(
        "transaction_id", "fraud_risk_score", "fraud_alert")),
    "fraud_additive": _stream_query(fraud_additive),
    "balance_windows": _stream_query(lambda t: _plain_window(windows.balance_windows(t))),
    "anomaly_windows": _stream_query(lambda t: _plain_window(
        windows.anomaly_windows(t, large=30, volatile=50, frequent=1))),
    "running_account_balance": _stream_query(lambda t: running.account_running_balance(t).select(
        "transaction_id", "account_id", "balance")),
    "pattern_anomalies": _stream_query(lambda t: running.pattern_anomalies(t, limit=-60).select(
        "transaction_id", "account_id", "category", "pattern_count", "pattern_mean", "anomaly")),
    "stream_summary": _stream_query(running.stream_summary, limits=STREAM_LIMITS),
    "cdc_balances": _ledger_query(running.balance_changes),
    "cdc_changes": lambda s, d: running.balance_changes(tables.ledger_changes(s, d)),
}
