"""Sinks that hold every micro-batch against a data contract while it is written.

The rules are counted in the pass that writes the rows, so nothing is read twice. A batch
is written aside; one that keeps the contract is then moved to ``data``, one that breaks it
to ``rejected``, and either way one row of the result is kept under ``results``. With
``stop``, a broken contract ends the query after that. A batch that runs again replaces what
it wrote before.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import asdict

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tallyline.operators.contracts import ContractViolation, DataContract

RESULT = "contract STRING, timestamp STRING, valid BOOLEAN, errors ARRAY<STRING>, row_count BIGINT"


def write_checked(contract: DataContract, path: str, stop: bool = False) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        hadoop = spark._jvm.org.apache.hadoop.fs.Path
        system = hadoop(path).getFileSystem(spark._jsc.hadoopConfiguration())
        seen, aside = Observation(), f"{path}/_aside/batch_id={batch_id}"
        batch.observe(seen, *contract.metrics(batch)).write.mode("overwrite").parquet(aside)
        result = contract.result(batch, seen.get)
        for folder in ("data", "rejected"):
            system.delete(hadoop(f"{path}/{folder}/batch_id={batch_id}"), True)
        folder = "data" if result.valid else "rejected"
        system.mkdirs(hadoop(f"{path}/{folder}"))
        if not system.rename(hadoop(aside), hadoop(f"{path}/{folder}/batch_id={batch_id}")):
            raise OSError(f"{aside} could not be moved to {folder}")
        spark.createDataFrame([tuple(asdict(result).values())], RESULT).coalesce(1).write.mode("overwrite").parquet(
            f"{path}/results/batch_id={batch_id}")
        if stop and not result.valid:
            raise ContractViolation(result)
    return write


def start_checked(rows: DataFrame, contract: DataContract, name: str, path: str, checkpoint: str, stop: bool = False,
                  every: str | None = None) -> StreamingQuery:
    """Write a stream under a contract: every so often, or once over all that is there."""
    writer = rows.writeStream.queryName(name).option("checkpointLocation", f"{checkpoint}/{name}")
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.foreachBatch(write_checked(contract, path, stop)).start()


def results(spark: SparkSession, path: str) -> DataFrame:
    """One row for each micro-batch: batch_id, contract, timestamp, valid, errors, row_count."""
    return spark.read.parquet(f"{path}/results")
