"""What a sink carries from one micro-batch to the next: a few values, kept under the batch's id.

A micro-batch that runs again after a failure reads the carry of the batch before it, so it
starts from the same values as the first time and replaces what it wrote.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Row, SparkSession

FOLDER = "_carry"   # readers of the sink's folder pass over names that begin so
#: Carries before the newest that are kept; a restart can ask for the one before the batch it repeats.
KEPT = 2


def _folder(spark: SparkSession, path: str):
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{FOLDER}")
    return folder, folder.getFileSystem(spark._jsc.hadoopConfiguration())


def _known(spark: SparkSession, path: str) -> list[int]:
    folder, system = _folder(spark, path)
    if not system.exists(folder):
        return []
    names = [status.getPath().getName() for status in system.listStatus(folder)]
    return [int(n.split("=")[1]) for n in names if n.startswith("batch=") and system.exists(
        spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{FOLDER}/{n}/_SUCCESS"))]


def before(spark: SparkSession, path: str, batch_id: int | None = None) -> Row | None:
    """The carry of the last batch before ``batch_id`` (without one: of the last batch)."""
    known = [k for k in _known(spark, path) if batch_id is None or k < batch_id]
    return spark.read.parquet(f"{path}/{FOLDER}/batch={max(known)}").first() if known else None


def keep(row: DataFrame, path: str, batch_id: int) -> None:
    """Writes the one-row ``row`` for ``batch_id`` and drops carries that no restart can ask for."""
    spark = row.sparkSession
    row.coalesce(1).write.mode("overwrite").parquet(f"{path}/{FOLDER}/batch={batch_id}")
    _, system = _folder(spark, path)
    for old in sorted(k for k in _known(spark, path) if k < batch_id)[:-KEPT]:
        system.delete(spark._jvm.org.apache.hadoop.fs.Path(f"{path}/{FOLDER}/batch={old}"), True)
