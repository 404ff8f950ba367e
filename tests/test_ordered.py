"""Running sums and trailing windows over many segments, against brute force."""

import datetime as dt
import random
from decimal import Decimal

import pytest
from hypothesis import HealthCheck, given, settings, strategies as st
from pyspark.sql import functions as F

from tallyline.operators import running
from tallyline.operators.ordered import SEGMENT, Order, running_sums, segmented, trailing

SCHEMA = "k STRING, d DATE, id BIGINT, v DECIMAL(12,2)"
ORDER = Order("d", "id")


def frame(spark, data):
    return spark.createDataFrame(data, SCHEMA)


def hot_data(n=3000, seed=3):
    """One key and one day hold most rows; ids of that day lie close together."""
    rng = random.Random(seed)
    data = []
    for i in range(n):
        hot = rng.random() < 0.6
        key = "hot" if hot else rng.choice(["a", "b", None, "c"])
        date = dt.date(2024, 3, 5) if rng.random() < 0.6 else dt.date(2024, 1, 1) + dt.timedelta(rng.randrange(90))
        data.append((key, date, 10 * i if hot else 10**9 + i, Decimal(rng.randrange(-50000, 50000)) / 100))
    rng.shuffle(data)
    return data


def in_order(data):
    return sorted(data, key=lambda r: (r[1], r[2]))


def brute_running(data, keyed):
    total, out = {}, {}
    for k, d, i, v in in_order(data):
        key = k if keyed else 0
        total[key] = total.get(key, 0) + v
        out[(k, i)] = total[key]
    return out


@pytest.mark.parametrize("keyed", [False, True])
@pytest.mark.parametrize("size", [50, 700, 10**6])
def test_running_sums(spark, keyed, size):
    data = hot_data()
    got = running_sums(frame(spark, data), ["k"] if keyed else [], ORDER, {"s": F.col("v")}, size)
    assert {(r.k, r.id): r.s for r in got.collect()} == brute_running(data, keyed)
    assert got.columns == ["k", "d", "id", "v", "s"]


@pytest.mark.parametrize("size", [40, 10**6])
def test_trailing(spark, size):
    data = hot_data(2000)
    got = trailing(frame(spark, data), ["k"], ORDER, 10,
                   {"n": F.lit(1).cast("bigint"), "s": F.col("v")}, size)
    expected, seen = {}, {}
    for k, d, i, v in in_order(data):
        last = seen.setdefault(k, [])
        last.append(v)
        expected[(k, i)] = (len(last[-10:]), sum(last[-10:]))
    assert {(r.k, r.id): (r.n, r.s) for r in got.collect()} == expected


def largest(cut):
    return cut.groupBy(SEGMENT).count().agg(F.max("count")).first()[0]


def test_hot_key_and_day_are_split(spark):
    cut = segmented(frame(spark, hot_data()), ["k"], ORDER, 100)
    assert cut.select(SEGMENT).distinct().count() > 15
    assert largest(cut) < 300


@pytest.mark.parametrize("kind", ["one moment", "sparse ids", "text ids"])
def test_ties_are_split_whatever_they_are(spark, kind):
    moment = dt.datetime(2024, 3, 5, 12)
    ids = [10**12 if kind == "sparse ids" and n == 0 else n for n in range(1500)]
    data = [("k", moment if n % 2 or kind != "one moment" else moment + dt.timedelta(n), f"t{i:07d}" if kind == "text ids" else i, Decimal(1))
            for n, i in enumerate(ids)]
    kinds = "STRING" if kind == "text ids" else "BIGINT"
    df = spark.createDataFrame(data, f"k STRING, ts TIMESTAMP, id {kinds}, v DECIMAL(12,2)")
    order = Order("ts", "id")
    assert largest(segmented(df, ["k"], order, 100)) < 300
    sums = running_sums(df, ["k"], order, {"n": F.col("v")}, 100)
    assert [int(r.n) for r in sums.orderBy("ts", "id").collect()] == list(range(1, 1501))


def test_segments_follow_the_bytes_of_the_input(spark, small, monkeypatch):
    from tallyline.operators import ordered
    from tallyline.sources import tables
    ledger = tables.ledger(spark, small)
    size = ordered._input_bytes(ledger)
    assert size == ordered._input_bytes(ledger.filter("amount < 0").select("id")) and size > 10_000
    monkeypatch.setattr(ordered, "SEGMENT_BYTES", size // 6 + 1)
    cut = segmented(ledger, [], Order("date", "id"))
    assert cut.select(SEGMENT).distinct().count() == 6
    monkeypatch.setattr(ordered, "SEGMENT_BYTES", 10 * size)
    assert segmented(ledger, [], Order("date", "id")).select(SEGMENT).distinct().count() == 1


@pytest.mark.parametrize("build", [
    lambda t: running.account_running_balance(t, rows_per_segment=100),
    lambda t: running.pattern_anomalies(t, rows_per_segment=100)])
def test_rows_are_not_shuffled_after_they_are_cut(spark, small, build):
    from tallyline.sources import tables
    plan = build(tables.transactions(spark, small))._jdf.queryExecution().executedPlan().toString()
    rows = plan.split("BroadcastExchange")[0]
    assert "Exchange" not in rows and "Bucketed: true" in rows and "Window" in rows


def test_trailing_sums_reach_over_several_small_segments(spark):
    data = [("k" if n != 17 else "j", dt.date(2024, 1, 1) + dt.timedelta(n), n, Decimal(n)) for n in range(60)]
    got = trailing(frame(spark, data), ["k"], ORDER, 10, {"n": F.lit(1).cast("bigint"), "s": F.col("v")}, 2)
    ids = [n for n in range(60) if n != 17]
    expected = {n: (min(k + 1, 10), sum(ids[max(0, k - 9) : k + 1])) for k, n in enumerate(ids)} | {17: (1, 17)}
    assert {r.id: (r.n, int(r.s)) for r in got.collect()} == expected


def test_segments_follow_the_order(spark):
    cut = segmented(frame(spark, hot_data()), [], ORDER, 100)
    parts = [r[SEGMENT] for r in cut.orderBy("d", "id").collect()]
    assert parts == sorted(parts)


def test_repeated_delivery_opens_no_account_twice(spark, small):
    from tallyline.sources import tables
    events = tables.transactions(spark, small)
    twice = running.stream_summary(events.union(events), every=1)
    once = running.stream_summary(events, every=1)
    last = lambda df: max(r.active_accounts for r in df.collect())
    assert last(twice) == last(once) == events.select("account_id").distinct().count()


def test_timestamps_far_apart(spark):
    data = [("k", dt.datetime(1990, 1, 1) + dt.timedelta(seconds=s), n, Decimal(1))
            for n, s in enumerate([0, 1, 2, 10**9] + list(range(100, 400)))]
    df = spark.createDataFrame(data, "k STRING, ts TIMESTAMP, id BIGINT, v DECIMAL(12,2)")
    got = running_sums(df, ["k"], Order("ts", "id"), {"n": F.col("v")}, 20)
    assert [int(r.n) for r in got.orderBy("ts").collect()] == list(range(1, len(data) + 1))


def test_null_order_values_come_first(spark):
    data = [("k", None, i, Decimal(1)) for i in range(30)]
    data += [("k", dt.date(2024, 1, 1 + i), i, Decimal(2)) for i in range(30)]
    got = running_sums(frame(spark, data), [], ORDER, {"s": F.col("v")}, 10)
    assert [int(r.s) for r in got.orderBy("s").collect()] == list(range(1, 31)) + list(range(32, 91, 2))


@settings(max_examples=8, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(st.tuples(st.sampled_from(["x", "y"]), st.integers(0, 4), st.integers(-99, 99)),
                min_size=1, max_size=60), st.integers(2, 20))
def test_any_ledger(spark, items, size):
    data = [(k, dt.date(2024, 1, 1 + d), n, Decimal(v)) for n, (k, d, v) in enumerate(items)]
    got = running_sums(frame(spark, data), ["k"], ORDER, {"s": F.col("v")}, size)
    assert {(r.k, r.id): r.s for r in got.collect()} == brute_running(data, True)


def test_running_operators_do_not_depend_on_the_segments(spark, small):
    from tallyline.sources import tables
    ledger, events = tables.ledger(spark, small), tables.transactions(spark, small)
    for build, df, key in [
            (running.running_analytics, ledger, "id"),
            (running.balance_changes, ledger, "transaction_id"),
            (running.account_running_balance, events, "transaction_id"),
            (running.stream_summary, events, "transactions"),
            (lambda t, rows_per_segment: running.pattern_anomalies(
                t, limit=-40, rows_per_segment=rows_per_segment), events, "transaction_id")]:
        split = build(df, rows_per_segment=90).orderBy(key).collect()
        whole = build(df, rows_per_segment=10**9).orderBy(key).collect()
        assert split == whole != []


def test_windows_and_segments_follow_the_bytes_of_the_input(spark, monkeypatch, small):
    from tallyline.operators import ordered, windows
    from tallyline.sources import tables

    rows = tables.transactions(spark, small)
    expected = sorted(map(tuple, windows.balance_windows(rows).collect()), key=str)
    monkeypatch.setattr(ordered, "SEGMENT_BYTES", max(1, ordered._input_bytes(rows) // 3))
    dealt = windows.balance_windows(rows)
    assert dealt.rdd.getNumPartitions() >= 15 and ordered.segments(rows) >= 3
    assert sorted(map(tuple, dealt.collect()), key=str) == expected
