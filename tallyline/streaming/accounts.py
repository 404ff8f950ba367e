"""Per-account state in event order: running balances, spending patterns and balance changes.

Rows of a key wait in its state until the watermark has passed them, in buckets of event
time. A timer at the end of a bucket puts its rows in order and folds them, so results do
not depend on how the feed was cut into micro-batches or in which order rows arrived, as
long as they are no later than the watermark allows; later ones are dropped by Spark, as for
windows. What a task holds of a key is one bucket, never the rows of its whole batch, so an
account with a third of all rows needs no more memory than its busiest bucket. State of a
bucket is removed with it.

For a backlog of any size, the batch twins in ``operators.running`` split hot accounts.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import Any

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tallyline.operators.running import FREQUENT_SPENDING, OPENING_BALANCE, changed_amounts
from tallyline.session import stored
from tallyline.streaming import carry

#: Events later than this behind the newest one are dropped; rows wait at least as long.
LATENESS = "10 minutes"
#: Width of a bucket of waiting rows, in microseconds.
BUCKET = 60_000_000

_NEEDED = ("account_id", "transaction_id", "amount", "ts")


def _complete() -> Column:
    """Rows that may enter the state: a missing amount or time would spoil it for good."""
    found = F.lit(True)
    for name in _NEEDED:
        found = found & F.col(name).isNotNull()
    return found


def incomplete(transactions: DataFrame) -> DataFrame:
    """Messages that the stateful queries leave out, for a side output."""
    return transactions.filter(~_complete())


def _cents() -> Column:
    return (F.col("amount") * 100).cast("bigint").alias("cents")


class InOrder(StatefulProcessor):
    """Folds the rows of a key in the order of (``micros``, ``tie``).

    ``fold(key, rows, before)`` gets the rows of a bucket in order and what it returned
    last time (None at first), and returns a frame to emit and what to remember.
    """

    def __init__(self, fold: Callable[[tuple, pd.DataFrame, tuple | None], tuple[pd.DataFrame, tuple]], waiting: T.StructType,
                 remembered: str, bucket: int = BUCKET):
        self.fold, self.waiting, self.remembered, self.bucket = fold, waiting, remembered, bucket

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        lists = T.StructType([T.StructField(f.name, T.ArrayType(f.dataType), True) for f in self.waiting])
        self.rows = handle.getMapState("rows", "bucket long", lists)
        self.last = handle.getValueState("last", self.remembered)

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        for some in rows:
            ends = (some["micros"] // self.bucket + 1) * self.bucket
            for end, part in some.groupby(ends.to_numpy()):
                lists = tuple(part[f.name].tolist() for f in self.waiting)
                if self.rows.containsKey((int(end),)):
                    lists = tuple([*old, *new] for old, new in zip(self.rows.getValue((int(end),)), lists))
                else:
                    self.handle.registerTimer(int(end) // 1000)
                self.rows.updateValue((int(end),), lists)
        return iter([])

    def handleExpiredTimer(self, key: Any, timerValues: Any, expiredTimerInfo: Any) -> Iterator[pd.DataFrame]:
        end = expiredTimerInfo.getExpiryTimeInMs() * 1000
        lists = self.rows.getValue((end,))
        self.rows.removeKey((end,))
        rows = pd.DataFrame({f.name: list(values) for f, values in zip(self.waiting, lists)})
        rows = rows.sort_values(["micros", "tie"], kind="stable", ignore_index=True)
        out, last = self.fold(key, rows, self.last.get() if self.last.exists() else None)
        self.last.update(last)
        yield out

    def close(self) -> None:
        pass


def _in_order(rows: DataFrame, keys: list[str], fold: Callable, out: str, remembered: str, lateness: str) -> DataFrame:
    """``fold`` over ``rows`` (keys, ts, tie, ...) by key in event order."""
    rows = rows.withColumn("micros", F.unix_micros("ts")).withWatermark("ts", lateness)
    waiting = T.StructType([f for f in rows.schema.fields if f.name not in (*keys, "ts")])
    return rows.groupBy(*keys).transformWithStateInPandas(InOrder(fold, waiting, remembered), out, "append", "eventTime")


def _balance(key: tuple, rows: pd.DataFrame, before: tuple | None) -> tuple[pd.DataFrame, tuple]:
    start = before[0] if before is not None else int(rows["opening"].iloc[0])
    after = start + rows["cents"].cumsum()
    made = rows[["tie", "micros", "cents", "note"]].assign(account_id=key[0], balance=after / 100, amount=rows["cents"] / 100)
    return made[["account_id", "tie", "micros", "amount", "balance", "note"]], (int(after.iloc[-1]),)


def account_balances(transactions: DataFrame, opening: int | Column = OPENING_BALANCE, lateness: str = LATENESS,
                     note: str | None = None) -> DataFrame:
    """Balance of the account after every transaction; ``opening`` is what it begins with.

    ``note`` names a column of text to hand through.
    """
    kinds = dict(transactions.dtypes)
    begins = (opening if isinstance(opening, Column) else F.lit(opening)) * 100
    rows = transactions.filter(_complete()).select(
        "account_id", "ts", F.col("transaction_id").alias("tie"), _cents(), begins.cast("bigint").alias("opening"),
        (F.col(note) if note else F.lit("")).alias("note"))
    found = _in_order(rows, ["account_id"], _balance, f"account_id {kinds['account_id']}, tie {kinds['transaction_id']}, micros BIGINT, "
                      "amount DOUBLE, balance DOUBLE, note STRING", "balance BIGINT", lateness)
    return found.select("account_id", F.col("tie").alias("transaction_id"), F.timestamp_micros("micros").alias("ts"), "amount", "balance",
                        *([F.col("note").alias(note)] if note else []))


def _pattern(limit: float, length: int, at_least: int) -> Callable:
    def fold(key: tuple, rows: pd.DataFrame, last: tuple | None) -> tuple[pd.DataFrame, tuple]:
        before = list(last[0]) if last is not None else []
        values = np.concatenate([np.array(before, dtype="int64"), rows["cents"].to_numpy(dtype="int64")])
        recent = pd.Series(values).rolling(length, min_periods=1)
        count = recent.count().to_numpy(dtype="int64")[len(before):]
        mean = recent.sum().to_numpy()[len(before):] / 100 / count
        odd = (count >= at_least) & (mean < limit)
        out = pd.DataFrame({
            "account_id": key[0], "category": key[1], "tie": rows["tie"].to_numpy()[odd], "micros": rows["micros"].to_numpy()[odd],
            "pattern_count": count[odd], "pattern_mean": mean[odd], "anomaly": f"{FREQUENT_SPENDING}{key[1]}"})
        return out, (values[-(length - 1):].tolist(),)
    return fold


def pattern_anomalies(transactions: DataFrame, limit: float = -200, length: int = 10, at_least: int = 5,
                      lateness: str = LATENESS) -> DataFrame:
    """Transactions at which the mean of the last amounts of the same account and
    category falls below ``limit``; beside the rows that wait, the state is at most ``length - 1`` amounts."""
    kinds = dict(transactions.dtypes)
    rows = transactions.filter(_complete() & F.col("category").isNotNull()).select(
        "account_id", "category", "ts", F.col("transaction_id").alias("tie"), _cents())
    found = _in_order(rows, ["account_id", "category"], _pattern(limit, length, at_least),
                      f"account_id {kinds['account_id']}, category STRING, tie {kinds['transaction_id']}, micros BIGINT, "
                      "pattern_count BIGINT, pattern_mean DOUBLE, anomaly STRING", "recent ARRAY<BIGINT>", lateness)
    return found.select("account_id", "category", F.col("tie").alias("transaction_id"), F.timestamp_micros("micros").alias("ts"),
                        "pattern_count", "pattern_mean", "anomaly")


def balance_changes(changes: DataFrame, current: DataFrame | None = None, lateness: str = LATENESS) -> DataFrame:
    """Change events of the ledger: the new balance of the account after every change,
    starting from its ``current`` balance (account, balance), or from nothing.

    ``changes`` are ledger rows (id, date, amount, category, account), all of them inserted;
    or changes with ``change_type`` INSERT, UPDATE or DELETE, their time ``changed_at``, and the
    row before (old_amount, old_account). A delete takes the old amount back, an update books
    the difference, and one that moves a row to another account is an event of both. Events
    come in the order of time and id, once the watermark has passed them.
    """
    rows = changed_amounts(changes).withColumns({"account_id": F.col("account"), "transaction_id": F.col("id")})
    opening = F.lit(0)
    if current is not None:
        before = current.select(F.col("account").alias("account_id"), F.col("balance").cast("decimal(18,2)").alias("_before"))
        rows = rows.join(before, "account_id", "left")
        opening = F.coalesce("_before", F.lit(0))
    return account_balances(rows, opening, lateness, note="change_type").select(
        F.col("account_id").alias("account"), "transaction_id",
        F.date_format("ts", "yyyy-MM-dd").alias("transaction_date"),
        F.col("amount").alias("transaction_amount"), F.col("balance").alias("new_balance"), "change_type",
        F.date_format(F.current_timestamp(), "yyyy-MM-dd'T'HH:mm:ss.SSSSSS").alias("change_timestamp"))


def write_numbered(path: str) -> Callable[[DataFrame, int], None]:
    """Sink of a change consumer: events as it reports them, numbered 1, 2, ... over all
    micro-batches and restarts. A batch that runs again replaces its own folder and gets
    the same numbers: the number it starts from is a carry of the batch before it. Numbers
    within a batch come from counts by range partition, not from one task."""
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        last = carry.before(spark, path, batch_id)
        before = last.last if last else 0
        order = ["change_timestamp", "account", "transaction_id"]
        parted = batch.repartitionByRange(*order).sortWithinPartitions(*order).withColumns(
            {"_part": F.spark_partition_id(), "_at": F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))})
        parted = stored(parted, "numbered")
        ends = parted.groupBy("_part").agg(F.count("*").alias("n"))       # one row for each partition
        earlier = Window.orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
        ends = ends.select("_part", (F.coalesce(F.sum("n").over(earlier), F.lit(0)) + F.lit(before + 1)).alias("_first"), "n")
        (parted.join(F.broadcast(ends.drop("n")), "_part")
         .select((F.col("_first") + F.col("_at")).cast("bigint").alias("event_number"), "account",
                 "new_balance", "transaction_amount", "change_timestamp")
         .write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}"))
        carry.keep(ends.agg((F.coalesce(F.sum("n"), F.lit(0)) + F.lit(before)).cast("bigint").alias("last")), path, batch_id)
    return write


def start_consumer(changes: DataFrame, name: str, path: str, checkpoint: str, every: str | None = None) -> StreamingQuery:
    """Read the change table from its start and report every event with its number."""
    writer = changes.writeStream.queryName(name).option("checkpointLocation", f"{checkpoint}/{name}")
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.foreachBatch(write_numbered(path)).start()
