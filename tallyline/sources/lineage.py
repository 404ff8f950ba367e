"""Lineage log: one row per step, appended to a Parquet folder."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from tallyline import schemas
from tallyline.sources import files


class LineageLog:
    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.path = path

    def record(self, source: str, transformation: str, destination: str,
               row_count: int | None = None, at: dt.datetime | None = None) -> None:
        stamp = (at or dt.datetime.now(dt.timezone.utc)).isoformat()
        row = [(stamp, source, transformation, destination, row_count)]
        files.append_rows(self.spark.createDataFrame(row, schemas.LINEAGE), self.path)

    def entries(self) -> DataFrame:
        return (self.spark.read.schema(schemas.LINEAGE).parquet(self.path)
                .orderBy("timestamp", "destination"))

    def write_step(self, df: DataFrame, path: str, source: str, transformation: str,
                   partition_by: list[str] | None = None) -> int:
        """Write a layer and log it; rows are counted while they are written."""
        seen = Observation()
        files.write_layer(df.observe(seen, F.count(F.lit(1)).alias("rows")), path, partition_by)
        rows = int(seen.get["rows"])
        self.record(source, transformation, path, rows)
        return rows
