"""Ordered computations that no single task has to carry.

A running total over the whole ledger, or over one account that holds a third of
it, is a window whose partition does not fit one task. Here the order is cut into
segments of about equal size first, in the same way at every size:

1. rows are range-partitioned by (key, order, tie-break), so a key, a day or one
   moment that holds most rows becomes many segments as long as the tie-break
   differs. This is the only shuffle of the rows. Each segment is written as one bucket
   of a stored table, so windows and sums by segment read it where it lies;
2. only the first and the last key of a segment can go on in another one, so at most two
   totals for each segment make the opening values: what a segment's first key has come
   to before it;
3. the opening value of its segment, broadcast, is added to each row of that key.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.session import checkpoint_dir

#: Bytes of input for one segment.
SEGMENT_BYTES = 8 << 20
#: Buckets of one stored table, as many as Spark allows.
MOST_SEGMENTS = 100_000

SEGMENT = "_segment"
_AT = "segment"


@dataclass(frozen=True)
class Order:
    """Ascending order of any comparable columns: a date, time or number, then a tie-break."""

    by: str
    tie: str
    last: tuple[str, ...] = ()

    def columns(self) -> list[Column]:
        return [F.col(c).asc_nulls_first() for c in (self.by, self.tie, *self.last)]


def _input_bytes(df: DataFrame) -> int | None:
    """Bytes of the files and tables that ``df`` reads, as the planner knows them."""
    leaves = df._jdf.queryExecution().optimizedPlan().collectLeaves()
    sizes = [int(str(leaves.apply(k).stats().sizeInBytes())) for k in range(leaves.size())]
    return None if any(size > 1 << 60 for size in sizes) else sum(sizes)


def segments(df: DataFrame, rows_per_segment: int | None = None) -> int:
    """In how many parts ``df`` is dealt out."""
    if rows_per_segment is not None:
        return max(1, -(-df.count() // rows_per_segment))
    size = _input_bytes(df)
    wanted = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")) if size is None else -(-size // SEGMENT_BYTES)
    return min(max(1, wanted), MOST_SEGMENTS)


def segmented(df: DataFrame, keys: list[str], order: Order, rows_per_segment: int | None = None) -> DataFrame:
    """``df`` with its ``_segment``, as a stored table with a bucket for each segment.

    The number of segments follows from the bytes of the input (where these are not known,
    it is that of the shuffle partitions), or from ``rows_per_segment`` and one count.
    """
    return _cut(df, keys, order, segments(df, rows_per_segment))


def _cut(df: DataFrame, keys: list[str], order: Order, parts: int) -> DataFrame:
    spark = df.sparkSession
    along = [*[F.col(k).asc_nulls_first() for k in keys], *order.columns()]
    cut = df.repartitionByRange(parts, *along).withColumn(SEGMENT, F.spark_partition_id())
    name = f"segments_{uuid.uuid4().hex}"
    cut.write.format("parquet").bucketBy(parts, SEGMENT).option("path", f"{checkpoint_dir(spark)}/{name}").saveAsTable(name)
    table = spark.table(name)
    spark.sql(f"DROP TABLE {name}")   # its files stay, the frame knows where and how they lie
    return table


def _same_key(keys: list[str]) -> Column:
    same = F.col(f"_of_{_AT}").isNotNull()
    for key in keys:
        same = same & F.col(key).eqNullSafe(F.col(f"_of_{key}"))
    return same


def _opened(table: DataFrame, keys: list[str], sums: list[str]) -> DataFrame:
    """(_of_ columns): for each segment its first key and what the key's sums had come to before it.

    At most one row for each segment, from at most two totals for each.
    """
    totals = table.groupBy(*keys, SEGMENT).agg(*[F.sum(n).alias(n) for n in sums])
    inside = Window.partitionBy(SEGMENT)
    upward = inside.orderBy(*([F.col(k).asc_nulls_first() for k in keys] or [F.lit(0)]))
    downward = inside.orderBy(*([F.col(k).desc_nulls_last() for k in keys] or [F.lit(0)]))
    edges = totals.withColumns({"_first": F.row_number().over(upward) == 1, "_last": F.row_number().over(downward) == 1})
    edges = edges.filter(F.col("_first") | F.col("_last"))
    before = Window.partitionBy(*keys).orderBy(SEGMENT).rowsBetween(Window.unboundedPreceding, -1)
    openings = edges.select(*keys, SEGMENT, "_first", F.count(F.lit(1)).over(before).alias("_earlier"),
                            *[F.sum(n).over(before).alias(n) for n in sums]).filter(F.col("_first") & (F.col("_earlier") > 0))
    return openings.select(F.col(SEGMENT).alias(f"_of_{_AT}"), *[F.col(c).alias(f"_of_{c}") for c in (*keys, *sums)])


def _scanned(table: DataFrame, keys: list[str], order: Order, sums: list[str], parts: int) -> DataFrame:
    """``table`` with its ``sums`` replaced by running ones; one segment alone has nothing before it."""
    window = (Window.partitionBy(*keys, SEGMENT).orderBy(*order.columns())
              .rowsBetween(Window.unboundedPreceding, Window.currentRow))
    local = table.select(*[c for c in table.columns if c not in sums], *[F.sum(n).over(window).alias(n) for n in sums])
    if parts == 1:
        return local
    opened = F.broadcast(_opened(table, keys, sums))
    joined = local.join(opened, F.col(SEGMENT) == F.col(f"_of_{_AT}"), "left")
    # A sum without values is NULL until there is one.
    added = [F.when(_same_key(keys) & F.col(f"_of_{n}").isNotNull(), F.coalesce(F.col(n), F.lit(0)) + F.col(f"_of_{n}"))
             .otherwise(F.col(n)).cast(local.schema[n].dataType).alias(n) for n in sums]
    return joined.select(*[c for c in local.columns if c not in sums], *added)


def running_sums(df: DataFrame, keys: list[str], order: Order, sums: dict[str, Column],
                 rows_per_segment: int | None = None) -> DataFrame:
    """Running sums along ``order`` within ``keys`` (no keys: over all rows).

    ``sums`` maps an output column to the value summed up to and including the
    row. The order must be total within a key for the result to be defined.
    """
    values = df.select(*df.columns, *[v.alias(f"_sum_{n}") for n, v in sums.items()])
    names = [f"_sum_{n}" for n in sums]
    parts = segments(values, rows_per_segment)
    scanned = _scanned(_cut(values, keys, order, parts), keys, order, names, parts)
    return scanned.select(*[c for c in df.columns if c not in sums], *[F.col(f"_sum_{n}").alias(n) for n in sums])


def trailing(df: DataFrame, keys: list[str], order: Order, rows: int, sums: dict[str, Column],
             rows_per_segment: int | None = None) -> DataFrame:
    """Sums over the current row and the ``rows - 1`` rows before it within its key.

    A trailing sum is the difference of two running sums. Where the earlier one lies in
    another segment, it is looked up in the running sums of the last ``rows`` rows before
    the segment, of which ``rows`` for each segment are broadcast.
    """
    at = "_number"
    values = df.select(*df.columns, F.lit(1).cast("bigint").alias(at), *[F.coalesce(v, F.lit(0)).alias(f"_sum_{n}") for n, v in sums.items()])
    names = [f"_sum_{n}" for n in sums]
    parts = segments(values, rows_per_segment)
    table = _cut(values, keys, order, parts)
    scanned = _scanned(table, keys, order, [at, *names], parts)
    wanted = F.col(at) - rows
    window = Window.partitionBy(*keys, SEGMENT).orderBy(*order.columns())

    def difference(joined: DataFrame, earlier) -> DataFrame:
        return joined.select(*[c for c in df.columns if c not in sums],
                             *[(F.col(f"_sum_{n}") - earlier(f"_sum_{n}")).cast(scanned.schema[f"_sum_{n}"].dataType).alias(n) for n in sums])

    if parts == 1:
        return difference(scanned, lambda name: F.coalesce(F.lag(name, rows).over(window), F.lit(0)))
    # The last rows of each segment's last key, at most ``rows`` of them.
    back = Window.partitionBy(SEGMENT).orderBy(*[F.col(k).desc_nulls_last() for k in keys], F.desc(at))
    tails = scanned.select(*keys, SEGMENT, at, *names).withColumn("_place", F.row_number().over(back)).filter(F.col("_place") <= rows)
    # A segment inside a key's span has at least one of its rows, so the ``rows`` segments before hold all that is asked for.
    ahead = F.explode(F.sequence(F.col(SEGMENT) + 1, F.col(SEGMENT) + rows)).alias("_to")
    known = tails.select(*keys, ahead, F.struct(at, *names).alias("_row")).groupBy(*keys, "_to").agg(F.collect_list("_row").alias("_rows"))
    firsts = table.groupBy(SEGMENT).agg(F.min(F.struct(F.lit(0).alias("_none"), *[F.struct(F.col(k).isNotNull(), F.col(k)).alias(f"_k{i}")
                                                                                      for i, k in enumerate(keys)])).alias("_key"))
    firsts = firsts.select(F.col(SEGMENT).alias("_to"), *[F.col(f"_key._k{i}").getField(k).alias(f"_of_{k}") for i, k in enumerate(keys)])
    same = known["_to"] == firsts["_to"]
    for key in keys:
        same = same & known[key].eqNullSafe(firsts[f"_of_{key}"])
    carried = firsts.join(known, same).select(firsts["_to"].alias(f"_of_{_AT}"), *[f"_of_{k}" for k in keys], "_rows")
    joined = scanned.join(F.broadcast(carried), F.col(SEGMENT) == F.col(f"_of_{_AT}"), "left")

    def earlier(name: str) -> Column:
        """The running sum ``rows`` rows before, 0 where the key is not as old."""
        here = F.lag(name, rows).over(window)
        there = F.filter("_rows", lambda row: row[at] == wanted)
        return F.when(wanted <= 0, F.lit(0)).when(here.isNotNull(), here).otherwise(F.get(there, F.lit(0))[name])

    return difference(joined, earlier)
