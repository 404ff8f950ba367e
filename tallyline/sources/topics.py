"""Message topics: decoding, encoding and the options of source and sink."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline import schemas


def read_topic(spark: SparkSession, servers: str, topic: str, start: str = "latest",
               per_trigger: int = 100_000) -> DataFrame:
    """Stream of raw messages. ``start`` holds for a query without a checkpoint;
    afterwards offsets come from the checkpoint. ``per_trigger`` bounds a batch."""
    options = {
        "kafka.bootstrap.servers": servers,
        "subscribe": topic,
        "startingOffsets": start,
        "failOnDataLoss": "false",
        "maxOffsetsPerTrigger": str(per_trigger),
    }
    return spark.readStream.format("kafka").options(**options).load()


def read_folder(spark: SparkSession, path: str, schema: T.StructType,
                fmt: str = "parquet", files_per_trigger: int = 8) -> DataFrame:
    """Stream of files landing in a folder, where no broker is at hand;
    ``files_per_trigger`` bounds a batch."""
    reader = spark.readStream.format(fmt).schema(schema)
    return reader.option("maxFilesPerTrigger", files_per_trigger).load(path)


def decode(messages: DataFrame, schema: T.StructType | str = schemas.STREAM_TRANSACTION,
           keep: list[str] | None = None) -> DataFrame:
    """JSON value -> columns. A value that is no valid JSON gives NULL columns."""
    body = F.from_json(F.col("value").cast("string"), schema).alias("data")
    return messages.select(*(keep or []), body).select(*(keep or []), "data.*")


def encode(rows: DataFrame, key: str) -> DataFrame:
    """Rows -> (key, JSON value); equal keys land in the same topic partition."""
    return rows.select(F.col(key).cast("string").alias("key"),
                       F.to_json(F.struct(*rows.columns)).alias("value"))


def write_topic(messages: DataFrame, servers: str, topic: str, checkpoint: str):
    return (messages.writeStream.format("kafka")
            .option("kafka.bootstrap.servers", servers).option("topic", topic)
            .option("checkpointLocation", checkpoint).start())
