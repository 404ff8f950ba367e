"""Named queries over a ledger, ad-hoc SQL over views, and object statistics."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyline.operators import reports, running

NamedQuery = Callable[..., DataFrame]


class Catalog:
    """Looks up reports by name and runs them on one ledger."""

    def __init__(self, ledger: DataFrame, as_of: dt.date):
        self.ledger = ledger
        self.as_of = as_of
        self.queries: dict[str, NamedQuery] = {
            "analytics_transactions": lambda: reports.analytics_transactions(ledger),
            "monthly_summary": lambda: reports.monthly_stats(ledger),
            "category_analytics": lambda: reports.category_analytics(ledger),
            "running_analytics": lambda: running.running_analytics(ledger),
            "weekly_patterns": lambda: reports.weekly_patterns(ledger),
            "category_breakdown": lambda: reports.category_breakdown(ledger),
            "account_analysis": lambda: reports.account_analysis(ledger),
            "spending_trends": lambda months=12: reports.spending_trends(ledger, months),
            "current_month_detailed": lambda: reports.current_month_detailed(ledger, as_of),
            "financial_summary": lambda: reports.financial_summary(ledger, as_of),
            "recent_transactions": lambda limit=10: running.recent_transactions(ledger, limit),
            "spending_by_category": lambda days=30: reports.spending_by_category(ledger, as_of, days),
            "historical": lambda months=6: reports.historical_enhanced(ledger, as_of, months),
        }

    def run(self, name: str, **params) -> DataFrame:
        if name not in self.queries:
            raise KeyError(f"unknown query {name!r}; known: {', '.join(sorted(self.queries))}")
        return self.queries[name](**params)


def register_views(frames: dict[str, DataFrame]) -> None:
    for name, df in frames.items():
        df.createOrReplaceTempView(name)


def adhoc_sql(spark: SparkSession, sql: str, frames: dict[str, DataFrame] | None = None) -> DataFrame:
    """Run SQL text over registered views, or over the given frames by name."""
    return spark.sql(sql, **(frames or {}))


def object_stats(frames: dict[str, DataFrame]) -> DataFrame:
    """Row count of every given object, counted side by side in one job."""
    counts = [df.agg(F.lit(name).alias("object_name"), F.count(F.lit(1)).alias("row_count"))
              for name, df in frames.items()]
    return reduce(DataFrame.unionByName, counts)


def catalog_stats(spark: SparkSession) -> DataFrame:
    """Tables of the session with row counts, and views without."""
    objects = spark.catalog.listTables()
    views = [o.name for o in objects if o.isTemporary or o.tableType == "VIEW"]
    tables = {o.name: spark.table(o.name) for o in objects if o.name not in views}
    listed = spark.createDataFrame([(v, "view") for v in views] + [(t, "table") for t in tables],
                                   "object_name STRING, kind STRING")
    if not tables:
        return listed.withColumn("row_count", F.lit(None).cast("bigint"))
    return listed.join(object_stats(tables), "object_name", "left")
