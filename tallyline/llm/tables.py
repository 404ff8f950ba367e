"""Intermediate tables in the shared folder, and connected components over them."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import Column, DataFrame, Observation, SparkSession, Window
from pyspark.sql import functions as F

from tallyline.llm.texts import give_back
from tallyline.session import checkpoint_dir


def place(spark: SparkSession, name: str) -> str:
    """A new path in the folder of ``spark.checkpoint.dir``."""
    return f"{checkpoint_dir(spark)}/{name}-{uuid.uuid4().hex}"


def stored(df: DataFrame, name: str = "table", path: str | None = None) -> DataFrame:
    """``df`` computed once, as Parquet in the folder of ``spark.checkpoint.dir``.

    Its rows survive lost executors, later stages read only the columns they need, and
    joins see its size. The files stay until that folder is cleared, or until another table
    that does not depend on them is stored at the same ``path``.
    """
    path = path or place(df.sparkSession, name)
    df.write.mode("overwrite").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def stored_sum(df: DataFrame, name: str, **values) -> tuple[DataFrame, dict]:
    """``stored`` together with aggregates that are taken while writing."""
    seen = Observation()
    kept = stored(df.observe(seen, *[value.alias(key) for key, value in values.items()]), name)
    return kept, seen.get


#: How many times the wanted rows a hash threshold lets through before they are counted out.
MARGIN = 2


def threshold(wanted: int, rows: int) -> int:
    """The 63-bit hash below which about ``MARGIN`` times the wanted of so many rows lie, however many there are."""
    top = (1 << 63) - 1
    return top if MARGIN * wanted >= rows else max(1, top * MARGIN * wanted // rows)


def hash63(*columns) -> Column:
    return F.shiftrightunsigned(F.xxhash64(*columns), 1)


def bounded_sample(rows: DataFrame, groups: list[str], wanted: int) -> DataFrame:
    """The ``wanted`` rows of each group that have the smallest hashes, from ``rows`` (groups, __hash, more).

    Rows with one hash, which repeat each other, are one. Exact at every size: a threshold
    lets a little more than the wanted through, so only these are sorted.
    """
    sizes = rows.groupBy(*groups).agg(F.approx_count_distinct("__hash").alias("n")).collect()   # one row for each group
    limit = F
    for row in sizes:
        same = F.lit(True)
        for name in groups:
            same = same & F.col(name).eqNullSafe(F.lit(row[name]))
        limit = limit.when(same, F.lit(threshold(wanted, row["n"])))
    if not sizes:
        return rows.limit(0)
    few = rows.where(F.col("__hash") <= limit.otherwise(F.lit(0).cast("long"))).dropDuplicates([*groups, "__hash"])
    place = F.row_number().over(Window.partitionBy(*groups).orderBy("__hash"))
    return few.withColumn("__place", place).where(F.col("__place") <= wanted).drop("__place")


#: Ids that are sent to every task instead of dealing the rows they are looked up for.
SENT_IDS = 1 << 20


def few(ids: DataFrame) -> DataFrame:
    """``ids``, a stored table of one or two numbers a row, as a broadcast up to ``SENT_IDS`` rows, and as it is beyond them."""
    return F.broadcast(ids) if ids.count() <= SENT_IDS else ids


def let_go(spark: SparkSession) -> None:
    """Has the driver collect tables that nothing refers to, so that the shuffles behind them leave the disks.

    Freed memory goes back to the system.
    """
    gc.collect()
    give_back()
    spark.sparkContext._jvm.System.gc()


def components(edges: DataFrame) -> DataFrame:
    """(node, component) of each node of ``edges`` (a, b): the smallest node reachable.

    Large-star and small-star steps in turn until nothing changes; every step is two
    shuffles of the edges, and the edges never become more than their first number plus
    the nodes. The minima are written before they are joined, so a node with very many
    neighbours is split by adaptive execution. NULL ends and loops are no edges.
    """
    edges = edges.select("a", "b").where("a IS NOT NULL AND b IS NOT NULL AND a <> b")
    edges = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct()
    edges, before = stored_sum(edges, "edges", rows=F.count("*"), total=F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
    while True:
        both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = stored(both.groupBy("a").agg(F.min("b").alias("low")).withColumn("low", F.least("a", "low")), "least")
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("low").alias("b")).distinct()
        large = stored(large, "large")
        least = stored(large.groupBy("a").agg(F.min("b").alias("low")), "least")
        small = large.join(least, "a").where("b <> low").select(F.col("b").alias("a"), F.col("low").alias("b"))
        small = small.union(least.select("a", F.col("low").alias("b"))).distinct()
        edges, now = stored_sum(small, "edges", rows=F.count("*"), total=F.sum(F.xxhash64("a", "b").cast("decimal(38,0)")))
        if now == before:
            break
        before = now
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(
        edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
