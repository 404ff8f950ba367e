"""Sliding-window aggregates; the same functions take batch and streaming input.

In a batch, rows are first summed up by panes, which are as wide as a window's step; a
window is then the sum of the panes it covers. So a row enters one group, not one for each
window over it, and only panes are spread over windows: a pane travels once to the stretch
of time it lies in, and once more if windows of the stretch before reach into it, and the
windows of a stretch are put together where its panes are, in as many parts as the bytes
of the input and the windows over a row ask for, so a task holds about as much at every size. A stream keeps its windows as
state, so there each row enters them at once.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.functions import money
from tallyline.operators.ordered import segments

OPENING_BALANCE = 10_000
#: Panes in one stretch of time.
STRETCH = 60


def _windows(transactions: DataFrame, width: int, step: int, keys: list[str], sums: dict[str, Column]) -> DataFrame:
    """Sums over windows of ``width`` minutes that slide by ``step``, with their start and end."""
    if transactions.isStreaming:
        window = F.window("ts", f"{width} minutes", f"{step} minutes")
        found = transactions.groupBy(window, *keys).agg(*[F.sum(v).alias(n) for n, v in sums.items()])
        return found.select("window.start", "window.end", *keys, *sums)
    size, count = 60 * step, width // step
    pane = F.floor(F.unix_seconds("ts") / size)
    panes = (transactions.filter(F.col("ts").isNotNull()).groupBy(*keys, pane.alias("_pane"))
             .agg(*[F.sum(v).alias(n) for n, v in sums.items()]))
    own = F.floor(F.col("_pane") / STRETCH)
    reached = F.when(F.pmod(F.col("_pane"), F.lit(STRETCH)) < count - 1, F.array(own, own - 1)).otherwise(F.array(own))
    spread = panes.withColumn("_stretch", F.explode(reached)).repartition(count * segments(transactions), *keys, "_stretch")
    # Windows that begin in the stretch: those of the pane itself and of the panes before it.
    start = F.explode(F.filter(F.transform(F.sequence(F.lit(0), F.lit(count - 1)), lambda k: F.col("_pane") - k),
                               lambda p: F.floor(p / STRETCH) == F.col("_stretch")))
    found = (spread.withColumn("_start", start).groupBy(*keys, "_stretch", "_start").agg(*[F.sum(n).alias(n) for n in sums]))
    moment = F.timestamp_seconds(F.col("_start") * size)
    return found.select(moment.alias("start"), (moment + F.expr(f"INTERVAL {width} MINUTES")).alias("end"), *keys, *sums)


def balance_windows(transactions: DataFrame, opening: int = OPENING_BALANCE) -> DataFrame:
    """Flow per account in 5-minute windows sliding by 1 minute.

    Sums are combined map-side, so a busy account shuffles as one row per pane and task.
    """
    sums = _windows(transactions, 5, 1, ["account_id"], {
        "transaction_count": F.lit(1).cast("bigint"), "net_flow": F.col("amount"),
        "total_expenses": money.expense(), "total_income": money.income()})
    return sums.select(
        *_bounds(), "account_id", "transaction_count",
        money.double("net_flow").alias("net_flow"),
        money.double("total_expenses").alias("total_expenses"),
        money.double("total_income").alias("total_income"),
        money.double(F.col("net_flow") + F.lit(opening)).alias("estimated_balance"))


def anomaly_windows(transactions: DataFrame, large: float = 200, volatile: float = 150,
                    frequent: int = 5) -> DataFrame:
    """Spending per account and category in 10-minute windows sliding by 2 minutes.

    The deviation follows from count, sum and sum of squares, which are exact and add up.
    """
    amount = F.col("amount")
    sums = _windows(transactions.filter("amount < 0"), 10, 2, ["account_id", "category"], {
        "tx_count": F.lit(1).cast("bigint"), "_sum": amount, "_squares": (amount * amount).cast("decimal(24,4)")})
    mean = money.mean("_sum", "tx_count")
    n = F.col("tx_count").cast("decimal(10,0)")
    off = money.double(F.col("_squares") * n - F.col("_sum").cast("decimal(18,2)") * F.col("_sum").cast("decimal(18,2)"))
    sums = sums.withColumn("amount_stddev", F.when(F.col("tx_count") > 1, F.sqrt(F.greatest(off, F.lit(0.0)) / money.double(F.col("tx_count") * (F.col("tx_count") - 1)))))
    flag = (F.when((F.col("tx_count") > frequent) & (F.abs(mean) > large), "HIGH_FREQUENCY_LARGE")
            .when(F.col("amount_stddev") > volatile, "VOLATILE_SPENDING")
            .otherwise("NORMAL"))
    return sums.select(*_bounds(), "account_id", "category", "tx_count",
                       mean.alias("avg_amount"),
                       F.round("amount_stddev", 2).alias("amount_stddev"),
                       flag.alias("anomaly_flag"))


def _bounds():
    return [F.col("start").alias("window_start"), F.col("end").alias("window_end")]
