"""Relational tables through a driver, and the log with consumer groups."""

import sqlite3
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from tallyline import schemas
from tallyline.operators import running
from tallyline.sources import database, log, tables, topics
from tallyline.streaming import jobs
from tests.helpers import as_set

COLUMNS = "id BIGINT, date DATE, amount DECIMAL(12,2), category STRING, account STRING"


@pytest.fixture()
def place(spark, small, tmp_path):
    path = str(tmp_path / "ledger.db")
    connection = sqlite3.connect(path)
    connection.execute("CREATE TABLE transactions (id INTEGER, date TEXT, amount NUMERIC, category TEXT, account TEXT)")
    rows = tables.ledger(spark, small).collect()
    connection.executemany("INSERT INTO transactions VALUES (?, ?, ?, ?, ?)",
                           [(r.id, r.date.isoformat(), str(r.amount), r.category, r.account) for r in rows] + [(None, None, None, None, "nobody")])
    connection.commit()
    connection.close()
    return database.Place("sqlite3:connect", "transactions", (path,), ranges=6)


def test_a_table_is_read_in_ranges(spark, small, place):
    got = database.read_table(spark, place, COLUMNS)
    assert got.rdd.getNumPartitions() == 6
    per_task = [r.n for r in got.groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]
    assert len(per_task) == 6 and sum(per_task) == 1501
    assert as_set(got.filter("id IS NOT NULL")) == as_set(tables.ledger(spark, small))
    assert got.filter("id IS NULL").count() == 1


def test_filters_and_columns_reach_the_database(spark, small, place):
    reader = database.Reader(place, database.T.StructType.fromDDL("id BIGINT, category STRING"))
    kept = list(reader.pushFilters([database.EqualTo(("category",), "Salary"), database.GreaterThan(("id",), 100),
                                    database.In(("account",), ("a", "b")), database.IsNotNull(("id",)), object()]))
    assert len(kept) == 4          # all but IS NOT NULL are looked at once more
    sql, values = reader.query(database.Range(200, 300))
    assert sql == ("SELECT id, category FROM transactions WHERE category = ? AND id > ? AND account IN (?, ?) AND id IS NOT NULL "
                   "AND id >= ? AND id < ?")
    assert values == ["Salary", 100, "a", "b", 200, 300]
    ledger = tables.ledger(spark, small)
    for condition in ("category = 'Salary' AND id > 1000", "date >= DATE '2000-01-01'", "amount < -1000", "account IS NULL",
                      "category IN ('Coffee', 'Transport')"):
        got = database.read_table(spark, place, COLUMNS).filter(condition).filter("id IS NOT NULL")
        assert as_set(got) == as_set(ledger.filter(condition)), condition
    plan = database.read_table(spark, place, COLUMNS).filter("category = 'Salary'")._jdf.queryExecution().executedPlan().toString()
    assert "category" in plan


def test_a_load_that_is_sent_again_adds_nothing(spark, small, place, tmp_path):
    rows = tables.ledger(spark, small).limit(300).withColumn("id", F.col("id") + 10**9).repartition(3, "id")
    for _ in range(2):
        database.append_table(rows, place, "july")
    database.append_table(rows.limit(5).withColumn("id", F.col("id") + 10**9).coalesce(1), place, "august")
    assert database.read_table(spark, place, COLUMNS).count() == 1501 + 300 + 5
    got = database.read_table(spark, place, COLUMNS).filter(f"id >= {10**9} AND id < {2 * 10**9}")
    assert as_set(got) == as_set(rows)


def test_an_empty_table(spark, tmp_path):
    path = str(tmp_path / "empty.db")
    sqlite3.connect(path).execute("CREATE TABLE transactions (id INTEGER, amount NUMERIC)")
    assert database.read_table(spark, database.Place("sqlite3:connect", "transactions", (path,)), "id BIGINT, amount DECIMAL(12,2)").collect() == []


def messages(spark, low, high):
    return spark.range(low, high, 1, 3).select((F.col("id") % 20).cast("string").alias("key"), F.concat(F.lit("m"), "id").alias("value"))


def consume(spark, path, out, checkpoint, **options):
    query = log.read(spark, path, **options).writeStream.format("parquet").option("path", out).option(
        "checkpointLocation", checkpoint).trigger(processingTime="0 seconds").start()
    query.processAllAvailable()
    query.stop()
    assert query.exception() is None
    return sorted(r.value for r in spark.read.parquet(out).collect())


def values(low, high):
    return sorted(f"m{k}" for k in range(low, high))


def test_offsets_are_dense_and_keys_keep_their_order(spark, tmp_path):
    path = str(tmp_path / "topic")
    log.append(messages(spark, 0, 500), path, partitions=4)
    log.append(messages(spark, 500, 800), path, partitions=4)
    rows = spark.read.option("basePath", f"{path}/log").parquet(f"{path}/log")
    for r in rows.groupBy("partition").agg(F.sort_array(F.collect_list("offset")).alias("o")).collect():
        assert r.o == list(range(len(r.o)))
    assert rows.count() == 800 and sum(log.ends(path).values()) == 800
    for r in rows.groupBy("key").agg(F.count_distinct("partition").alias("p"),
                                     F.transform(F.sort_array(F.collect_list(F.struct("offset", "value"))), lambda x: x["value"]).alias("v")).collect():
        assert r.p == 1 and [int(v[1:]) for v in r.v] == sorted(int(v[1:]) for v in r.v)


def test_two_groups_read_on_their_own_and_go_on(spark, tmp_path):
    path = str(tmp_path / "topic")
    log.append(messages(spark, 0, 100), path, partitions=3)
    place = lambda name: (str(tmp_path / f"out_{name}"), str(tmp_path / f"cp_{name}"))
    assert consume(spark, path, *place("a"), group="a", start="earliest", per_batch=7) == values(0, 100)
    log.append(messages(spark, 100, 150), path, partitions=3)
    assert consume(spark, path, *place("a"), group="a", start="earliest", per_batch=1000) == values(0, 150)
    assert consume(spark, path, *place("b"), group="b", start="earliest") == values(0, 150)
    log.append(messages(spark, 150, 160), path, partitions=3)
    assert consume(spark, path, *place("b"), group="b") == values(0, 160)
    assert consume(spark, path, *place("a"), group="a") == values(0, 160)


def test_a_new_group_begins_at_the_latest_message_and_a_known_one_where_it_was(spark, tmp_path):
    path = str(tmp_path / "topic")
    log.append(messages(spark, 0, 60), path, partitions=3)
    reader = log.Reader({"path": path, "group": "late", "startingOffsets": "latest"})
    assert reader.initialOffset() == {str(k): v for k, v in log.ends(path).items()}
    assert log.Reader({"path": path, "startingOffsets": "earliest"}).initialOffset() == {str(k): 0 for k in log.ends(path)}
    reader.commit({"0": 3, "1": 4, "2": 5})
    assert log.Reader({"path": path, "group": "late", "startingOffsets": "earliest"}).initialOffset() == {"0": 3, "1": 4, "2": 5}
    few = log.Reader({"path": path, "startingOffsets": "earliest", "maxPerBatch": "2"})
    assert set(few.latestOffset().values()) == {2} and set(few.latestOffset().values()) == {4}


def test_encoded_transactions_pass_through_the_log(spark, small, tmp_path):
    rows = tables.transactions(spark, small).drop("ts").withColumn("description", F.lit("x"))
    rows = rows.withColumns({"transaction_id": F.col("transaction_id").cast("string"), "account_id": F.col("account_id").cast("string"),
                             "amount": F.col("amount").cast("double")}).select(*[f.name for f in schemas.STREAM_TRANSACTION])
    path, out = str(tmp_path / "topic"), str(tmp_path / "out")
    log.append(topics.encode(rows, "account_id"), path)
    stream = jobs.typed(topics.decode(log.read(spark, path, group="fraud", start="earliest", per_batch=40)))
    query = jobs.start(jobs.fraud_scores(stream), "scores", out, str(tmp_path / "cp"), every="0 seconds")
    query.processAllAvailable()
    query.stop()
    assert query.exception() is None
    columns = ["transaction_id", "fraud_risk_score"]
    batch = jobs.typed(topics.decode(topics.encode(rows, "account_id")))
    assert as_set(spark.read.parquet(out).select(columns)) == as_set(running.fraud_by_first_match(batch).select(columns))
    assert isinstance(batch.first().amount, Decimal)
