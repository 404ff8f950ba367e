"""Streaming forms against their batch twins."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyline import schemas
from tallyline.functions import fraud
from tallyline.operators import running, windows
from tallyline.sources import tables, topics
from tallyline.streaming import accounts, jobs


@pytest.fixture(scope="module")
def feed(spark, small, tmp_path_factory):
    """Encoded messages in four files of consecutive events, and the same as a batch."""
    path = str(tmp_path_factory.mktemp("feed") / "messages")
    rows = tables.transactions(spark, small).drop("ts").withColumn("description", F.lit("x"))
    rows = rows.withColumns({"transaction_id": F.col("transaction_id").cast("string"),
                             "account_id": F.col("account_id").cast("string"),
                             "amount": F.col("amount").cast("double")})
    messages = topics.encode(rows.select(*[f.name for f in schemas.STREAM_TRANSACTION]), "account_id")
    number = F.get_json_object("value", "$.transaction_id").cast("int")
    for part in range(4):  # one after the other, as files are taken up by age
        chosen = messages.filter((number >= 250 * part) & (number < 250 * (part + 1)))
        chosen.coalesce(1).write.mode("append").parquet(path)
    batch = jobs.typed(topics.decode(spark.read.parquet(path)))
    return path, batch


def stream_of(spark, path, files=1):
    raw = topics.read_folder(spark, path, spark.read.parquet(path).schema, files_per_trigger=files)
    return jobs.typed(topics.decode(raw))


def as_set(df):
    return {tuple(r) for r in df.collect()}


def test_decode_restores_what_encode_wrote(spark, small, feed):
    _, batch = feed
    assert batch.count() == 1000
    assert batch.filter("amount IS NULL OR ts IS NULL OR location IS NULL").count() == 0
    bad = spark.createDataFrame([("no json",)], "value STRING")
    assert topics.decode(bad).first().transaction_id is None


def test_three_queries_equal_their_batch_twins(spark, feed, tmp_path):
    path, batch = feed
    out, checkpoint = str(tmp_path / "out"), str(tmp_path / "checkpoint")
    queries = jobs.start_all(stream_of(spark, path), out, checkpoint, once=True)
    for query in queries.values():
        query.awaitTermination(180)
        assert query.exception() is None
    jobs.stop_all(spark)

    fraud = spark.read.parquet(f"{out}/fraud")
    columns = ["transaction_id", "fraud_risk_score", "fraud_alert"]
    assert as_set(fraud.select(columns)) == as_set(running.fraud_by_first_match(batch).select(columns))

    # Update mode: the last version of a window is its final one.
    updates = spark.read.parquet(f"{out}/balances")
    last = updates.groupBy("window_start", "account_id").agg(
        F.max_by(F.struct("transaction_count", "net_flow", "estimated_balance"), "batch_id").alias("s"))
    twin = windows.balance_windows(batch).select(
        "window_start", "account_id", F.struct("transaction_count", "net_flow", "estimated_balance"))
    assert as_set(last) == as_set(twin)

    # Append mode: windows that the watermark has passed, each exactly as in batch.
    done = spark.read.parquet(f"{out}/anomalies").drop("amount_stddev")
    twin = windows.anomaly_windows(batch).drop("amount_stddev")
    assert as_set(done) < as_set(twin)
    assert done.count() == len(as_set(done)) > 0.9 * twin.count()


def test_late_events_are_dropped(spark, tmp_path):
    schema = "transaction_id STRING, account_id STRING, amount DECIMAL(12,2), category STRING, ts TIMESTAMP"
    path = str(tmp_path / "in")
    def land(*rows):
        spark.createDataFrame([(i, "a", -1.0, "Food", t) for i, t in rows],
                              "id STRING, a STRING, amount DOUBLE, c STRING, t STRING").select(
            F.col("id").alias("transaction_id"), F.col("a").alias("account_id"),
            F.col("amount").cast("decimal(12,2)"), F.col("c").alias("category"),
            F.col("t").cast("timestamp").alias("ts")).coalesce(1).write.mode("append").parquet(path)

    def run():
        stream = topics.read_folder(spark, path, spark.createDataFrame([], schema).schema)
        query = jobs.start(jobs.balance_updates(stream), "late", str(tmp_path / "out"),
                           str(tmp_path / "cp"), mode="update")
        query.awaitTermination(120)
    land(("1", "2024-01-01 10:00:00"), ("2", "2024-01-01 12:00:00"))
    run()
    land(("3", "2024-01-01 10:00:30"), ("4", "2024-01-01 11:55:30"))
    run()
    seen = spark.read.parquet(str(tmp_path / "out"))
    early = seen.filter("window_start < '2024-01-01 10:01:00'")
    assert early.agg(F.max("transaction_count")).first()[0] == 1
    assert seen.filter("window_start = '2024-01-01 11:55:00'").count() == 1


def land(spark, rows, path, parts=4, jitter=0):
    """``rows`` in files one after the other by time, each row up to ``jitter`` seconds late, and a last
    file with one row far ahead, which lets the watermark pass all others."""
    late = F.pmod(F.xxhash64("transaction_id"), F.lit(jitter + 1)).cast("int")
    edges = [rows.selectExpr("min(unix_timestamp(ts))").first()[0], rows.selectExpr("max(unix_timestamp(ts))").first()[0] + 1 + jitter]
    width = -(-(edges[1] - edges[0]) // parts)
    placed = rows.withColumn("_part", F.floor((F.unix_timestamp("ts") + late - edges[0]) / width))
    for part in range(parts):
        placed.filter(F.col("_part") == part).drop("_part").coalesce(1).write.mode("append").parquet(path)
    clock = rows.limit(1).withColumn("ts", F.to_timestamp(F.lit("2100-01-01"))).withColumn("account_id", F.lit("clock").cast(dict(rows.dtypes)["account_id"]))
    clock.coalesce(1).write.mode("append").parquet(path)
    return lambda files: spark.readStream.schema(rows.schema).option("maxFilesPerTrigger", files).parquet(path)


def run(df, name, tmp_path):
    query = jobs.start(df, name, str(tmp_path / "out"), str(tmp_path / "cp"))
    query.awaitTermination(240)
    assert query.exception() is None
    return query


@pytest.mark.parametrize("files, parts, jitter", [(1, 5, 540), (2, 7, 300), (100, 3, 540)])
def test_account_state_equals_batch_for_any_split_and_disorder(spark, feed, tmp_path, files, parts, jitter):
    rows = feed[1].withColumn("ts", F.timestamp_seconds(F.lit(1704067200) + F.col("transaction_id").cast("int") * 20))
    stream = land(spark, rows, str(tmp_path / "in"), parts, jitter)
    run(accounts.account_balances(stream(files)), "accounts", tmp_path)
    got = spark.read.parquet(str(tmp_path / "out")).select("transaction_id", "balance")
    twin = running.account_running_balance(rows).select("transaction_id", "balance")
    assert as_set(got) == as_set(twin) and got.count() == rows.count()


def test_state_goes_on_after_a_restart(spark, feed, tmp_path):
    rows = feed[1]
    path = str(tmp_path / "in")
    half = rows.selectExpr("percentile(unix_timestamp(ts), 0.5)").first()[0]
    rows.filter(F.unix_timestamp("ts") < half).coalesce(1).write.parquet(path)
    run(accounts.account_balances(spark.readStream.schema(rows.schema).parquet(path)), "restarted", tmp_path)
    stream = land(spark, rows.filter(F.unix_timestamp("ts") >= half), path, 2)
    run(accounts.account_balances(stream(1)), "restarted", tmp_path)
    got = spark.read.parquet(str(tmp_path / "out")).select("transaction_id", "balance")
    assert as_set(got) == as_set(running.account_running_balance(rows).select("transaction_id", "balance"))


def test_a_hot_account_is_folded_bucket_by_bucket(spark, feed, tmp_path, monkeypatch):
    rows = feed[1].withColumn("account_id", F.lit("hot")).withColumn(
        "ts", F.timestamp_seconds(F.lit(1704067200) + F.col("transaction_id").cast("int") * 10))
    most = 60 // 10
    fold = accounts._balance

    def small(key, part, before):
        assert len(part) <= most
        return fold(key, part, before)

    monkeypatch.setattr(accounts, "_balance", small)
    stream = land(spark, rows, str(tmp_path / "in"), 2)
    run(accounts.account_balances(stream(10)), "hot", tmp_path)
    got = spark.read.parquet(str(tmp_path / "out")).select("transaction_id", "balance")
    assert as_set(got) == as_set(running.account_running_balance(rows).select("transaction_id", "balance"))


def test_pattern_state_equals_batch(spark, feed, tmp_path):
    rows = feed[1]
    stream = land(spark, rows, str(tmp_path / "in"), 4, 500)
    run(accounts.pattern_anomalies(stream(1), limit=-60), "patterns", tmp_path)
    columns = ["transaction_id", "pattern_count", F.round("pattern_mean", 6), "anomaly"]
    got = spark.read.parquet(str(tmp_path / "out")).select(columns)
    twin = running.pattern_anomalies(rows, limit=-60).select(columns)
    assert as_set(got) == as_set(twin) != set()


@pytest.mark.parametrize("parts", [1, 3])
def test_a_summary_after_every_tenth_transaction(spark, feed, tmp_path, parts):
    rows = feed[1]
    limits = fraud.FraudLimits(discretionary=100)
    path, out = str(tmp_path / "in"), str(tmp_path / "out")
    edges = rows.selectExpr("percentile(unix_timestamp(ts), array(0.013, 0.4, 0.97)) AS q").first().q[:parts - 1]
    for low, high in zip([-1, *edges], [*edges, 1 << 60]):
        # Whatever the cut, a query that is started again goes on with the count.
        moment = F.unix_timestamp("ts")
        rows.filter((moment > low) & (moment <= high)).coalesce(1).write.mode("append").parquet(path)
        query = jobs.start_summary(spark.readStream.schema(rows.schema).parquet(path), out, str(tmp_path / "cp"), once=True, limits=limits)
        query.awaitTermination(180)
        assert query.exception() is None
    got = spark.read.parquet(out).drop("batch_id")
    assert as_set(got) == as_set(running.stream_summary(rows, limits=limits)) and got.count() == 100
    final, twin = jobs.final_summary(spark, out), running.final_stream_summary(rows, limits=limits)
    assert (final.transactions, final.active_accounts, final.fraud_alerts) == tuple(twin["totals"].first())
    assert [tuple(a) for a in final.last_alerts] == [tuple(r) for r in twin["last_alerts"].collect()] and len(final.last_alerts) == 3


def test_a_summary_batch_that_runs_again_gives_the_same_rows(spark, feed, tmp_path):
    rows, out = feed[1], str(tmp_path / "out")
    first = running.first_transactions(rows).withColumnRenamed("_first", "f")
    marked = rows.join(first, "account_id")
    half = marked.selectExpr("percentile_approx(ts, 0.43)").first()[0]
    write = jobs.write_summaries(out)
    parts = [marked.filter(F.col("ts") <= half).withColumn("fresh", F.lit(True)).drop("f"),
             marked.filter(F.col("ts") > half).withColumn("fresh", F.col("f.ts") > half).drop("f")]
    for batch_id, part in ((0, parts[0]), (0, parts[0]), (1, parts[1]), (1, parts[1])):
        write(part, batch_id)
    assert as_set(spark.read.parquet(out).drop("batch_id")) == as_set(running.stream_summary(rows))


LAST_DAY = dt.date(2100, 1, 1)


def clock(spark, schema):
    """A ledger row that lets the watermark pass all others."""
    names = [f.name for f in schema]
    values = {"id": -1, "date": LAST_DAY, "amount": Decimal("0.00"), "category": "x", "account": "clock",
              "change_type": "INSERT", "changed_at": dt.datetime(2100, 1, 1), "old_amount": None, "old_account": None}
    return spark.createDataFrame([tuple(values[n] for n in names)], schema).coalesce(1)


def test_change_events_and_their_consumer(spark, small, tmp_path):
    ledger = tables.ledger(spark, small)
    source, events = str(tmp_path / "ledger"), str(tmp_path / "changes")
    half = F.col("date") < F.lit("1998-01-01").cast("date")

    def book(rows):
        rows.coalesce(1).write.mode("append").parquet(source)
        stream = topics.read_folder(spark, source, ledger.schema)
        jobs.start(accounts.balance_changes(stream), "changes", events, str(tmp_path / "cp")).awaitTermination(180)

    def consume():
        # A second query reads the change table from the start, and goes on where it stopped.
        changes = topics.read_folder(spark, events, spark.read.parquet(events).schema)
        accounts.start_consumer(changes, "consumer", str(tmp_path / "log"), str(tmp_path / "cp2")).awaitTermination(180)

    book(ledger.filter(half))
    consume()
    first = spark.read.parquet(str(tmp_path / "log")).count()
    book(ledger.filter(~half).unionByName(clock(spark, ledger.schema)))
    consume()
    twin = running.balance_changes(ledger)
    got = spark.read.parquet(events).select(twin.columns)
    assert as_set(got) == as_set(twin)
    numbers = sorted(r.event_number for r in spark.read.parquet(str(tmp_path / "log")).collect())
    assert 0 < first < len(numbers) and numbers == list(range(1, ledger.count() + 1))


def test_a_batch_that_runs_again_gets_the_same_numbers(spark, tmp_path):
    rows = spark.createDataFrame([("a", float(k), 1.0, f"t{k}", k) for k in range(50)],
                                 "account STRING, new_balance DOUBLE, transaction_amount DOUBLE, change_timestamp STRING, transaction_id INT")
    write = accounts.write_numbered(str(tmp_path / "log"))
    for batch_id, part in ((0, rows.limit(20)), (1, rows.filter("transaction_id >= 20")), (1, rows.filter("transaction_id >= 20"))):
        write(part, batch_id)
    assert sorted(r.event_number for r in spark.read.parquet(str(tmp_path / "log")).collect()) == list(range(1, 51))


CHANGES = ("id BIGINT, date DATE, amount DECIMAL(12,2), category STRING, account STRING, change_type STRING, "
           "changed_at TIMESTAMP, old_amount DECIMAL(12,2), old_account STRING")


def test_updates_moves_and_deletes(spark, tmp_path):
    def change(i, kind, second, amount=None, account=None, old=None, before=None):
        money = lambda v: None if v is None else Decimal(f"{v:.2f}")
        return (i, dt.date(2024, 1, 1), money(amount), "c", account, kind, dt.datetime(2024, 1, 1, 0, second // 60, second % 60), money(old), before)

    log = [change(1, "INSERT", 0, 10, "a"), change(2, "INSERT", 100, 5, "a"), change(1, "UPDATE", 200, 30, "a", 10, "a"),
           change(2, "UPDATE", 300, 6, "b", 5, "a"), change(1, "DELETE", 400, None, None, 30, "a")]
    rows = spark.createDataFrame(log, CHANGES)
    source = str(tmp_path / "rows")
    for part in ([log[1], log[3]], [log[0], log[4], log[2]]):       # not in order
        spark.createDataFrame(part, CHANGES).coalesce(1).write.mode("append").parquet(source)
    clock(spark, rows.schema).write.mode("append").parquet(source)
    stream = topics.read_folder(spark, source, rows.schema, files_per_trigger=1)
    jobs.start(accounts.balance_changes(stream), "kinds", str(tmp_path / "out"), str(tmp_path / "cp")).awaitTermination(180)
    columns = ["account", "transaction_id", "transaction_amount", "new_balance", "change_type"]
    expected = {("a", 1, 10.0, 10.0, "INSERT"), ("a", 2, 5.0, 15.0, "INSERT"), ("a", 1, 20.0, 35.0, "UPDATE"), ("a", 2, -5.0, 30.0, "UPDATE"),
                ("b", 2, 6.0, 6.0, "UPDATE"), ("a", 1, -30.0, 0.0, "DELETE")}
    assert as_set(spark.read.parquet(str(tmp_path / "out")).select(columns)) == expected
    assert as_set(running.balance_changes(rows).select(columns)) == expected


def test_changes_start_from_current_balances(spark, tmp_path):
    rows = spark.createDataFrame([(1, dt.date(2024, 1, 1), Decimal("5.00"), "c", "a"), (2, dt.date(2024, 1, 2), Decimal("2.00"), "c", "b")],
                                 schemas.LEDGER)
    source = str(tmp_path / "rows")
    rows.unionByName(clock(spark, rows.schema)).coalesce(1).write.parquet(source)
    current = spark.createDataFrame([("a", 100.0)], "account STRING, balance DOUBLE")
    out = str(tmp_path / "out")
    jobs.start(accounts.balance_changes(topics.read_folder(spark, source, rows.schema), current), "seeded", out,
               str(tmp_path / "cp")).awaitTermination(180)
    assert as_set(spark.read.parquet(out).select("account", "new_balance")) == {("a", 105.0), ("b", 2.0)}


def test_broken_messages_do_not_stop_the_streams(spark, feed, tmp_path):
    path, batch = feed
    good = spark.read.parquet(path)
    broken = ['{"transaction_id": "x1", "account_id": "1", "amount": null, "timestamp": "2024-01-01T00:00:00"}',
              '{"transaction_id": "x2", "account_id": "1", "amount": 5, "timestamp": "soon"}', "no json", None]
    ahead = '{"transaction_id": "x3", "account_id": "clock", "amount": 5, "timestamp": "2100-01-01T00:00:00"}'
    bad = spark.createDataFrame([(None, b) for b in [*broken, ahead]], "key STRING, value STRING")
    mixed = str(tmp_path / "mixed")
    good.select("key", "value").unionByName(bad).coalesce(1).write.parquet(mixed)
    stream = stream_of(spark, mixed)
    out = str(tmp_path / "out")
    query = jobs.start(accounts.account_balances(stream), "balances_of_mixed", out, str(tmp_path / "checkpoint"))
    query.awaitTermination(180)
    assert query.exception() is None
    got = spark.read.parquet(out)
    assert as_set(got.select("transaction_id")) == as_set(batch.select("transaction_id"))
    scored = jobs.start(jobs.fraud_scores(stream), "scores_of_mixed", f"{out}_scores", str(tmp_path / "checkpoint"))
    scored.awaitTermination(180)
    assert scored.exception() is None and spark.read.parquet(f"{out}_scores").count() == batch.count() + 5
    assert accounts.incomplete(jobs.typed(topics.decode(spark.read.parquet(mixed)))).count() == 4
