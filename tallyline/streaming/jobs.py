"""Fraud, balance and anomaly queries on the transaction stream."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import Decimal
from typing import Any

import pandas as pd
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle, StreamingQuery

from tallyline.functions import fraud
from tallyline.operators import running, windows
from tallyline.schemas import MONEY
from tallyline.session import small_table, stored
from tallyline.streaming import carry

# Events later than this behind the newest one no longer change a window.
LATENESS = "10 minutes"

# How often each query runs.
EVERY = {"fraud": "10 seconds", "balances": "30 seconds", "anomalies": "20 seconds",
         "summary": "10 seconds"}


def typed(decoded: DataFrame) -> DataFrame:
    """Decoded messages with exact amounts and an event time beside the text one; what
    cannot be read is NULL (``accounts.incomplete`` picks such messages out)."""
    return decoded.withColumns({"amount": F.col("amount").try_cast(MONEY),
                                "ts": F.try_to_timestamp("timestamp")})


def fraud_scores(transactions: DataFrame,
                 limits: fraud.FraudLimits = fraud.FraudLimits()) -> DataFrame:
    """Stateless; ``processing_time`` tells when a row passed."""
    return running.fraud_by_first_match(transactions, limits).withColumn(
        "processing_time", F.current_timestamp())


def fraud_alerts(transactions: DataFrame,
                 limits: fraud.FraudLimits = fraud.FraudLimits()) -> DataFrame:
    """Transactions whose rules add up to an alert, with the reasons."""
    return running.fraud_by_sum(transactions, limits).filter("is_alert")


def balance_updates(transactions: DataFrame, lateness: str = LATENESS) -> DataFrame:
    return windows.balance_windows(transactions.withWatermark("ts", lateness))


def spending_anomalies(transactions: DataFrame, lateness: str = LATENESS, **limits) -> DataFrame:
    return windows.anomaly_windows(transactions.withWatermark("ts", lateness), **limits)


def write_batches(path: str) -> Callable[[DataFrame, int], None]:
    """Sink for any output mode: every micro-batch replaces its own folder, so a
    batch that runs again after a failure leaves no second copy."""
    def write(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
    return write


def start(df: DataFrame, name: str, path: str, checkpoint: str, mode: str = "append",
          every: str | None = None) -> StreamingQuery:
    """Start a query into Parquet: every so often, or once over all that is there."""
    writer = df.writeStream.queryName(name).outputMode(mode).option(
        "checkpointLocation", f"{checkpoint}/{name}")
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    if mode == "append":
        return writer.format("parquet").option("path", path).start()
    return writer.foreachBatch(write_batches(path)).start()


def start_all(transactions: DataFrame, out: str, checkpoint: str,
              once: bool = False) -> dict[str, StreamingQuery]:
    """The three queries side by side on one stream definition."""
    plans = {
        "fraud": (fraud_scores(transactions), "append"),
        "balances": (balance_updates(transactions), "update"),
        "anomalies": (spending_anomalies(transactions), "append"),
    }
    return {name: start(df, name, f"{out}/{name}", checkpoint, mode, None if once else EVERY[name])
            for name, (df, mode) in plans.items()}


def stop_all(spark: SparkSession, seconds: float | None = None) -> None:
    """Let each active query end by itself for a while, then stop it."""
    for query in spark.streams.active:
        if seconds:
            query.awaitTermination(seconds)
        query.stop()


# --- running summary ---------------------------------------------------------------


class SeenBefore(StatefulProcessor):
    """Hands rows through with ``fresh``: whether the account first came in this micro-batch.

    The state of an account is one flag, so no trigger reads the accounts of earlier ones.
    """

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.seen = handle.getValueState("seen", "yes boolean")

    def handleInputRows(self, key: Any, rows: Iterator[pd.DataFrame], timerValues: Any) -> Iterator[pd.DataFrame]:
        fresh = not self.seen.exists()
        for some in rows:
            yield some.assign(fresh=fresh)
        if fresh:
            self.seen.update((True,))

    def close(self) -> None:
        pass


def with_fresh(transactions: DataFrame) -> DataFrame:
    """Transactions that can be summed up, with whether their account is new to the stream."""
    rows = transactions.filter("account_id IS NOT NULL AND amount IS NOT NULL AND ts IS NOT NULL").withColumn("ts", F.unix_micros("ts"))
    schema = T.StructType([*rows.schema.fields, T.StructField("fresh", T.BooleanType())])
    marked = rows.groupBy("account_id").transformWithStateInPandas(SeenBefore(), schema, "append", "none")
    return marked.withColumn("ts", F.timestamp_micros("ts"))


def _early(new: DataFrame, so_far: running.SoFar, sampled: int) -> list:
    """Accounts that came first, old ones before new ones: at most ``sampled``."""
    more = new.orderBy("_first").limit(sampled - len(so_far.first_accounts)).collect() if len(so_far.first_accounts) < sampled else []
    return [*so_far.first_accounts, *(r.account_id for r in more)]


def write_summaries(path: str, every: int = 10, opening: int = running.OPENING_BALANCE, limits: fraud.FraudLimits = fraud.FraudLimits(),
                    sampled: int = 3, alerts: int = 3) -> Callable[[DataFrame, int], None]:
    """Sink for ``with_fresh``: a row after every ``every``-th transaction of the stream.

    Transactions are taken in the order of time and id within a micro-batch. Their running
    sums follow on a carry of a few values: totals, balances of the accounts that came
    first, and the last alerts. A batch that runs again gives the same rows.
    """
    def write(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        last = carry.before(spark, path, batch_id)
        so_far = running.SoFar(*last[:5]) if last else running.SoFar()
        rows = stored(batch, "summary")
        new = stored(running.first_transactions(rows.filter("fresh")), "new_accounts")
        accounts = _early(new, so_far, sampled)
        kind = dict(rows.dtypes)["account_id"]
        early = small_table(spark, {"account_id": accounts, "_slot": list(range(1, len(accounts) + 1))}, f"account_id {kind}, _slot INT")
        summaries = running.summaries_of(rows.drop("fresh"), new, early, so_far, every, opening, limits, sampled)
        summaries.write.mode("overwrite").parquet(f"{path}/batch_id={batch_id}")
        # The carry: what this batch adds, in one aggregate, and the last alerts.
        score = F.coalesce(fraud.additive_score(limits), F.lit(0))
        flows = rows.groupBy().agg(
            F.count(F.lit(1)).alias("n"), F.count_if(score > 50).alias("alerts"),
            *[F.coalesce(F.sum(F.when(F.col("account_id") == F.lit(a), F.col("amount"))), F.lit(0)).alias(f"f{k}") for k, a in enumerate(accounts)]).first()
        balances = [*so_far.balances, *[Decimal(opening)] * (len(accounts) - len(so_far.balances))]
        balances = [b + flows[f"f{k}"] for k, b in enumerate(balances)]
        latest = rows.withColumn("score", score).filter("score > 50").orderBy(F.desc("ts"), F.desc("transaction_id")).limit(alerts).select(
            F.col("transaction_id").cast("string"), "score", fraud.reasons(limits).alias("reasons")).collect()
        seen = [tuple(r) for r in latest] + ([tuple(r) for r in last.last_alerts] if last else [])
        row = spark.createDataFrame(
            [(so_far.transactions + flows.n, so_far.active_accounts + new.count(), so_far.fraud_alerts + flows.alerts, accounts, balances, seen[:alerts])],
            f"transactions BIGINT, active_accounts BIGINT, fraud_alerts BIGINT, first_accounts ARRAY<{kind}>, balances ARRAY<DECIMAL(24,2)>, "
            "last_alerts ARRAY<STRUCT<transaction_id: STRING, score: INT, reasons: ARRAY<STRING>>>")
        carry.keep(row, path, batch_id)
    return write


def final_summary(spark: SparkSession, path: str) -> Row | None:
    """Totals, first balances and last alerts of a summary sink; None before its first batch."""
    return carry.before(spark, path)


def start_summary(transactions: DataFrame, path: str, checkpoint: str, once: bool = False, every: int = 10,
                  limits: fraud.FraudLimits = fraud.FraudLimits()) -> StreamingQuery:
    """Append a summary after every ``every``-th transaction of the stream."""
    writer = with_fresh(transactions).writeStream.queryName("summary").outputMode("append").option(
        "checkpointLocation", f"{checkpoint}/summary")
    trigger = {"availableNow": True} if once else {"processingTime": EVERY["summary"]}
    return writer.trigger(**trigger).foreachBatch(write_summaries(path, every, limits=limits)).start()
