"""Every query against its SQL twin on the smallest tables."""

import datetime as dt
import math

import duckdb
import pytest

import __spark_entry__ as entry_module
from oracle_queries import ORACLE
from tallyline.queries import QUERIES, TABLES

KINDS = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
         "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP"}


@pytest.fixture(scope="module")
def sql(small):
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM '{small}/{t}.parquet'")
    return connection


def sortable(row):
    return [(v is not None, str(v)) for v in row]


def same(a, b):
    if isinstance(a, float) and isinstance(b, float):
        return math.isclose(a, b, rel_tol=1e-12, abs_tol=1e-9)
    return a == b


@pytest.mark.parametrize("name", list(QUERIES))
def test_query(spark, small, sql, name):
    df = QUERIES[name](spark, small)
    columns = sorted(df.columns)
    twin = sql.execute(ORACLE[name])
    kinds = {d[0]: str(d[1]) for d in twin.description}
    assert columns == sorted(kinds)
    assert {c: KINDS[t] for c, t in df.dtypes} == kinds
    order = [list(kinds).index(c) for c in columns]
    expected = sorted(([r[i] for i in order] for r in twin.fetchall()), key=sortable)
    actual = sorted(([r[c] for c in columns] for r in df.collect()), key=sortable)
    assert len(actual) == len(expected) > 0
    bad = [(a, e) for a, e in zip(actual, expected) if not all(map(same, a, e))]
    assert not bad, bad[:3]


def test_every_query_has_a_twin():
    assert QUERIES.keys() == ORACLE.keys()


def test_entry(spark):
    row = entry_module.entry(spark).first()
    assert isinstance(row.date, dt.date)
