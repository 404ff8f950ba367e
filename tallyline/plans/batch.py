"""The daily batch job: bronze -> silver -> gold, with contract check and lineage."""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyline.operators import cleaning, contracts, summaries
from tallyline.schemas import MONEY
from tallyline.sources import files
from tallyline.sources.lineage import LineageLog
from tallyline.sources.versions import Versions


def as_ledger(silver: DataFrame) -> DataFrame:
    """Silver rows with exact amounts, as the summaries sum them."""
    return silver.select("date", F.col("amount").cast(MONEY).alias("amount"), "category",
                         F.col("account_id").alias("account"))


def gold_tables(silver: DataFrame) -> dict[str, DataFrame]:
    ledger = as_ledger(silver)
    return {
        "daily_summary": summaries.daily_summary(ledger),
        "category_summary": summaries.category_summary(ledger),
        "account_balance": summaries.account_balance(ledger),
    }


def gold_overview(silver: DataFrame) -> DataFrame:
    """All gold tables side by side: one line per day, category and account."""
    return overview(gold_tables(silver))


GOLD = {"daily_summary": ("date", "total_amount"),
        "category_summary": ("category", "total_spent"),
        "account_balance": ("account_id", "current_balance")}


def overview(gold: dict[str, DataFrame]) -> DataFrame:
    """One line per day, category and account of the given gold tables."""
    lines = [gold[name].select(F.lit(name).alias("gold_table"), F.col(key).cast("string").alias("member"),
                               "transaction_count", F.col(total).alias("total"))
             for name, (key, total) in GOLD.items()]
    return lines[0].unionByName(lines[1]).unionByName(lines[2])


def run_batch(spark: SparkSession, raw_transactions: DataFrame, raw_news: DataFrame | None,
              out: str) -> dict[str, str]:
    """Write all layers as a new version below ``out`` and return their paths.

    Each layer is read back from its files, so a lost executor costs the work of
    one layer at most. The version becomes the current one (``layers``) when all its
    layers are there and the contract holds; a run that stops before leaves the last one.
    """
    log = LineageLog(spark, f"{out}/lineage")
    versions = Versions(spark, out)
    folder = versions.begin()
    paths = {name: f"{folder}/{name}" for name in
             ("bronze/transactions", "silver/transactions")}
    log.write_step(raw_transactions, paths["bronze/transactions"], "source", "raw ingestion")
    bronze = spark.read.parquet(paths["bronze/transactions"])

    cleaned = cleaning.silver_transactions(bronze).withColumns(
        {"year": F.year("date"), "month": F.month("date")})
    log.write_step(cleaned, paths["silver/transactions"], paths["bronze/transactions"],
                   "clean and type", partition_by=["year", "month"])
    silver = spark.read.parquet(paths["silver/transactions"]).drop("year", "month")
    contracts.silver_contract().enforce(silver)

    if raw_news is not None:
        paths["silver/news"] = f"{folder}/silver/news"
        log.write_step(cleaning.silver_news(raw_news), paths["silver/news"], "news", "clean and type")

    for name, gold in gold_tables(silver).items():
        paths[f"gold/{name}"] = f"{folder}/gold/{name}"
        log.write_step(gold, paths[f"gold/{name}"], paths["silver/transactions"], "aggregate")
    versions.commit(paths)
    versions.retain()
    return paths


def layers(spark: SparkSession, out: str) -> dict[str, str]:
    """Paths of the layers of the last batch that came to its end."""
    return Versions(spark, out).current().paths


def layer_shapes(spark: SparkSession, paths: dict[str, str]) -> DataFrame:
    """Rows and columns of every stored layer."""
    lines = None
    for name, path in paths.items():
        df = spark.read.parquet(path)
        line = df.agg(F.lit(name).alias("layer"), F.count(F.lit(1)).alias("rows"),
                      F.lit(len(df.columns)).alias("columns"))
        lines = line if lines is None else lines.unionByName(line)
    return lines


def load_statement(spark: SparkSession, statement: DataFrame, ledger_path: str,
                   only_new: bool = True) -> int:
    """Append statement rows to a stored ledger and return how many were added;
    repeated loads add nothing."""
    rows = statement
    if only_new:
        rows = cleaning.new_rows(statement, spark.read.parquet(ledger_path))
    added = Observation()
    files.append_rows(rows.observe(added, F.count(F.lit(1)).alias("rows")), ledger_path)
    return int(added.get["rows"])
