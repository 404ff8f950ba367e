"""Dense surrogate keys 1..n in name order, for dimensions of any size."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tallyline.session import small_table, stored


@dataclass(frozen=True)
class Dimension:
    """A stored dimension table, whose size in bytes the planner sees, and its row count."""

    frame: DataFrame
    rows: int


def dense_keys(names: dict[str, tuple[DataFrame, str, str]]) -> dict[str, Dimension]:
    """Number the distinct names of several dimensions in order, NULL last.

    ``names`` gives for each dimension a table of distinct names, its column and the key
    to add. All names are range-partitioned and written once, so that both the counts
    and the numbering see the same partitions; a partition is numbered on its own and
    shifted by the rows before it.
    """
    lists = [df.select(F.lit(dim).alias("_dim"), F.col(column).alias("_name")) for dim, (df, column, _) in names.items()]
    order = F.col("_name").asc_nulls_last()
    fixed = stored(reduce(DataFrame.unionByName, lists).repartitionByRange("_dim", order)
                   .withColumn("_part", F.spark_partition_id()), "names")
    sizes = sorted(fixed.groupBy("_dim", "_part").count().collect())  # one row per partition and dimension
    shifts, totals = [], dict.fromkeys(names, 0)
    for dim, part, n in sizes:
        shifts.append((dim, part, totals[dim]))
        totals[dim] += n
    before = small_table(fixed.sparkSession, dict(zip(("_dim", "_part", "_shift"), map(list, zip(*shifts)))),
                         "_dim STRING, _part INT, _shift BIGINT")
    numbered = stored(
        fixed.join(F.broadcast(before), ["_dim", "_part"])
        .withColumn("_key", F.row_number().over(Window.partitionBy("_dim", "_part").orderBy(order)) + F.col("_shift"))
        .select("_dim", "_name", "_key"), "dimensions")
    return {dim: Dimension(numbered.filter(F.col("_dim") == dim).select(F.col("_key").alias(key), F.col("_name").alias(column)), totals[dim])
            for dim, (_, column, key) in names.items()}
