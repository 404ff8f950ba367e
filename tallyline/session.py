"""Session settings shared by jobs, tests and the benchmark."""

from __future__ import annotations

import tempfile
import uuid

import pyarrow as pa
from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Settings a job needs whatever the cluster looks like. Sizes (executor memory,
# shuffle partitions, broadcast threshold) are left to the cluster.
COMMON_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Looking up the Python call site of every column expression costs more than
    # planning a report.
    "spark.python.sql.dataFrameDebugging.enabled": "false",
    # A session that runs many reports should not compile the same stage twice.
    "spark.sql.codegen.cache.maxEntries": "1000",
    "spark.sql.streaming.stateStore.providerClass":
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider",
}


def build_session(app: str = "tallyline", master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**COMMON_CONF, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def checkpoint_dir(spark: SparkSession) -> str:
    """Shared folder for checkpoints, as named by ``spark.checkpoint.dir``.

    A private temporary folder is used only on a local master, where it is
    visible to every task; elsewhere a missing setting is an error.
    """
    context = spark.sparkContext
    current = context._jsc.sc().getCheckpointDir()
    if current.isDefined():
        return current.get()
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not context.master.startswith("local"):
            raise RuntimeError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="tallyline-checkpoint-")
    context.setCheckpointDir(folder)
    return folder


def stored(df: DataFrame, name: str = "table") -> DataFrame:
    """``df`` computed once, as Parquet in the shared folder.

    Its rows stay the same for every later read and survive lost executors; later
    stages read only the columns they need, and joins see its size. The files
    stay until that folder is cleared.
    """
    path = f"{checkpoint_dir(df.sparkSession)}/{name}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_sums(df: DataFrame, name: str, **sums) -> tuple[DataFrame, dict]:
    """``stored``, and aggregates that are taken while its rows are written."""
    seen = Observation()
    kept = stored(df.observe(seen, *[value.alias(key) for key, value in sums.items()]), name)
    return kept, seen.get


def stored_counted(df: DataFrame, name: str = "table") -> tuple[DataFrame, int]:
    """``stored``, and the number of rows, counted while they are written."""
    seen = Observation()
    kept = stored(df.observe(seen, F.count(F.lit(1)).alias("rows")), name)
    return kept, int(seen.get["rows"])


def small_table(spark: SparkSession, columns: dict[str, list],
                schema: str | T.StructType) -> DataFrame:
    """A literal table of driver-side values (metadata, reference rows)."""
    if not any(columns.values()):
        return spark.createDataFrame([], schema)
    table = pa.table(columns)
    target = schema if isinstance(schema, T.StructType) else T.StructType.fromDDL(schema)
    return spark.createDataFrame(table).select(
        *[F.col(f.name).cast(f.dataType).alias(f.name) for f in target])
