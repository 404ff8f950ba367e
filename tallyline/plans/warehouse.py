"""Builds the stored star schema, the warehouse table and the marts from a ledger."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.operators import cleaning, star, summaries
from tallyline.sources import files
from tallyline.sources.versions import Versions

MONTHLY = ["year", "month"]


def build_star_tables(spark: SparkSession, ledger: DataFrame, out: str, keep: int = 2) -> dict[str, str]:
    """Write dimensions, fact and warehouse table as one new version and return their paths.

    Keys are numbered anew for every version, so fact and dimensions belong together: all
    tables go to a folder of their own, and the version becomes the current one when all
    of them are there. Large tables are partitioned by month; the date part of the fact is
    its partition, so reports by period skip the other files.
    """
    versions = Versions(spark, out)
    version = versions.begin()
    built = star.build_star(ledger)
    paths = {f"dim_{name}": f"{version}/dim_{name}" for name in ("category", "account", "merchant", "date")}
    for name in ("category", "account", "merchant"):
        files.write_layer(getattr(built, name).frame, paths[f"dim_{name}"])
    files.write_layer(star.dim_date(ledger), paths["dim_date"])

    month = {"year": F.year("date_key"), "month": F.month("date_key")}
    fact = cleaning.stamped(star.fact_transactions(ledger, built), "loaded_at")
    paths["fact_transactions"] = f"{version}/fact_transactions"
    files.write_layer(fact.withColumns(month), paths["fact_transactions"], MONTHLY)

    wide = cleaning.stamped(star.warehouse_transactions(ledger, built), "loaded_at")
    paths["warehouse_transactions"] = f"{version}/warehouse_transactions"
    files.write_layer(wide, paths["warehouse_transactions"], MONTHLY)
    versions.commit(paths)
    versions.retain(keep)
    return paths


def star_tables(spark: SparkSession, out: str) -> dict[str, str]:
    """Paths of the current version of the star tables below ``out``."""
    return Versions(spark, out).current().paths


def build_marts(spark: SparkSession, raw: DataFrame, out: str) -> dict[str, str]:
    """Write the staging table and the marts over it as one new version."""
    versions = Versions(spark, out)
    folder = versions.begin()
    paths = {name: f"{folder}/{name}" for name in
             ("stg_transactions", "financial_summary", "monthly_trends")}
    files.write_layer(cleaning.stamped(cleaning.staged_transactions(raw), "loaded_at"),
                      paths["stg_transactions"])
    staged = spark.read.parquet(paths["stg_transactions"]).drop("loaded_at")
    files.write_layer(cleaning.stamped(summaries.financial_summary_mart(staged), "generated_at"),
                      paths["financial_summary"])
    files.write_layer(summaries.monthly_trends(staged), paths["monthly_trends"])
    versions.commit(paths)
    versions.retain()
    return paths
