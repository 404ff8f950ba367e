"""Relational ledger tables over JDBC. The driver jar comes with the cluster."""

from __future__ import annotations

from dataclasses import dataclass, field, replace

from pyspark.sql import DataFrame, SparkSession


@dataclass(frozen=True)
class LedgerTable:
    """Where a ledger table lives and how a scan of it is cut into parallel ranges.

    The ranges lie between the smallest and largest key, asked from the database where
    they are not given.
    """

    url: str
    table: str = "public.transactions"
    key: str = "id"
    lower: int | None = None
    upper: int | None = None
    ranges: int = 64
    fetch_size: int = 10_000
    properties: dict[str, str] = field(default_factory=dict)

    def bounds_options(self) -> dict[str, str]:
        """The one-row query for the bounds."""
        query = f"SELECT MIN({self.key}) AS low, MAX({self.key}) AS high FROM {self.table}"
        return {"url": self.url, "query": query, **self.properties}

    def scan_options(self) -> dict[str, str]:
        return {
            "url": self.url,
            "dbtable": self.table,
            "partitionColumn": self.key,
            "lowerBound": str(self.lower),
            "upperBound": str(self.upper),
            "numPartitions": str(self.ranges),
            "fetchsize": str(self.fetch_size),
            **self.properties,
        }


def read_ledger_table(spark: SparkSession, source: LedgerTable) -> DataFrame:
    """Parallel range scan; filters and columns are pushed to the database."""
    if source.lower is None or source.upper is None:
        row = spark.read.format("jdbc").options(**source.bounds_options()).load().first()
        source = replace(source, lower=row[0] or 0, upper=max(row[1] or 0, (row[0] or 0) + 1))
    return spark.read.format("jdbc").options(**source.scan_options()).load()


def append_ledger_table(df: DataFrame, source: LedgerTable, batch_size: int = 10_000) -> None:
    """Append rows in batches from all tasks; the database assigns the keys."""
    (df.write.format("jdbc").mode("append")
     .options(url=source.url, dbtable=source.table, batchsize=str(batch_size),
              numPartitions=str(source.ranges), **source.properties)
     .save())
