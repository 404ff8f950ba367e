"""File sources and sinks: CSV, Parquet, JSON payloads and report files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline import schemas
from tallyline.sources.versions import Versions


def read_csv(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """CSV with a header. Without a schema all columns stay text (no inference scan)."""
    reader = spark.read.option("header", True)
    return (reader.schema(schema) if schema else reader).csv(path)


def read_parquet(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A schema, when known, saves the footer read that inference needs."""
    reader = spark.read
    return (reader.schema(schema) if schema else reader).parquet(path)


def parquet_relation(path: str) -> str:
    """Name under which SQL text can read a Parquet folder directly."""
    return f"parquet.`{path}`"


def write_layer(df: DataFrame, path: str, partition_by: list[str] | None = None) -> None:
    """Replace a whole layer; partitions that ``df`` has no rows for go.

    The rebalance hint lets adaptive execution pick the file count: it joins
    small partitions and splits a month that holds most of the rows.
    """
    if partition_by:
        df = df.hint("rebalance", *[F.col(c) for c in partition_by])
        (df.write.mode("overwrite").partitionBy(*partition_by)
         .option("partitionOverwriteMode", "static").parquet(path))
    else:
        df.hint("rebalance").write.mode("overwrite").parquet(path)


def append_rows(df: DataFrame, path: str) -> None:
    """Append a whole set of rows in one job."""
    df.write.mode("append").parquet(path)


def write_report(df: DataFrame, folder: str, name: str) -> str:
    """Write an aggregated report as one CSV file with a header.

    One task writes it, so it is meant for results of a report, whose rows are
    bounded by months, groups or categories.
    """
    path = f"{folder}/{name}"
    df.coalesce(1).write.mode("overwrite").option("header", True).csv(path)
    return path


def read_payloads(spark: SparkSession, path: str) -> DataFrame:
    """Bank API answers stored as JSON files, one document each."""
    return spark.read.schema(schemas.PAYLOAD).option("multiLine", True).json(path)


def read_or_empty(spark: SparkSession, table: str, schema: T.StructType) -> DataFrame:
    """A reference table, or no rows of its schema while it does not exist."""
    if spark.catalog.tableExists(table):
        return spark.table(table)
    return spark.createDataFrame([], schema)


def save_table(df: DataFrame, table: str) -> None:
    """Refresh a table: the rows are written as a new version, which the catalog then points to."""
    spark = df.sparkSession
    root = f"{spark.conf.get('spark.sql.warehouse.dir').rstrip('/')}/versions_of_{table.replace('.', '_')}"
    versions = Versions(spark, root)
    folder = versions.begin()
    write_layer(df, folder)
    versions.commit({table: folder})
    if spark.catalog.tableExists(table):
        spark.sql(f"ALTER TABLE {table} SET LOCATION '{folder}'")
        spark.catalog.refreshTable(table)
    else:
        spark.catalog.createTable(table, path=folder, source="parquet", schema=df.schema)
    versions.retain()
