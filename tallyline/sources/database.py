"""Relational tables through any DB-API driver, read and appended by all tasks.

Where no JDBC driver is at hand, a Python one does: ``connect`` names a function that every
task calls for a connection of its own, as ``module:function``. A scan is cut into ranges of
a key, each read by one task in batches; simple filters and the asked columns become part
of its SQL. An append is one transaction for each task, which first books the task's number
under the name of the load; a task that runs again, or a load that is sent again, finds it
booked and adds nothing.
"""

from __future__ import annotations

import datetime as dt
import importlib
import json
from collections.abc import Iterator
from dataclasses import dataclass
from decimal import Decimal

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.datasource import (DataSource, DataSourceReader, DataSourceWriter, EqualTo, Filter, GreaterThan, GreaterThanOrEqual, In,
                                    InputPartition, IsNotNull, IsNull, LessThan, LessThanOrEqual, WriterCommitMessage)

FORMAT = "tallyline_database"
FETCH = 10_000
#: Table that keeps which tasks of which loads are in.
LOADS = "booked_loads"
SIGNS = {EqualTo: "=", GreaterThan: ">", GreaterThanOrEqual: ">=", LessThan: "<", LessThanOrEqual: "<="}


@dataclass(frozen=True)
class Place:
    """Where a table is: how to connect, its key, and the sign that stands for a value in SQL."""

    connect: str
    table: str
    arguments: tuple = ()
    key: str = "id"
    ranges: int = 64
    mark: str = "?"

    def open(self):
        module, name = self.connect.split(":")
        return getattr(importlib.import_module(module), name)(*self.arguments)

    def options(self) -> dict[str, str]:
        return {"connect": self.connect, "table": self.table, "arguments": json.dumps(list(self.arguments)),
                "key": self.key, "ranges": str(self.ranges), "mark": self.mark}

    @classmethod
    def of(cls, options: dict) -> Place:
        return cls(options["connect"], options["table"], tuple(json.loads(options.get("arguments", "[]"))),
                   options.get("key", "id"), int(options.get("ranges", 64)), options.get("mark", "?"))


@dataclass
class Range(InputPartition):
    """Keys from ``low`` (None: from the first) up to before ``high`` (None: to the last); rows without key go with the first."""

    low: int | None
    high: int | None


def _stored(value):
    """A value as plain drivers take it."""
    if isinstance(value, Decimal):
        return str(value)
    return value.isoformat() if isinstance(value, (dt.date, dt.datetime)) else value


class Reader(DataSourceReader):
    def __init__(self, place: Place, schema: T.StructType):
        self.place, self.schema = place, schema
        self.conditions: list[str] = []
        self.values: list = []

    def pushFilters(self, filters: list[Filter]) -> Iterator[Filter]:
        for one in filters:
            name = ".".join(one.attribute) if hasattr(one, "attribute") else ""
            if type(one) in SIGNS and not isinstance(one.value, float):
                self.conditions.append(f"{name} {SIGNS[type(one)]} {self.place.mark}")
                self.values.append(_stored(one.value))
            elif isinstance(one, In) and one.value:
                self.conditions.append(f"{name} IN ({', '.join([self.place.mark] * len(one.value))})")
                self.values += [_stored(v) for v in one.value]
            elif isinstance(one, (IsNull, IsNotNull)):
                self.conditions.append(f"{name} IS {'NOT ' if isinstance(one, IsNotNull) else ''}NULL")
                continue
            # What is compared is compared once more by Spark, as a driver may keep values in forms of its own.
            if not isinstance(one, (IsNull, IsNotNull)):
                yield one

    def partitions(self) -> list[Range]:
        place = self.place
        connection = place.open()
        try:
            cursor = connection.cursor()
            cursor.execute(f"SELECT MIN({place.key}), MAX({place.key}) FROM {place.table}")
            low, high = cursor.fetchone()
        finally:
            connection.close()
        if low is None or place.ranges < 2 or high <= low:
            return [Range(None, None)]
        count = min(place.ranges, high - low + 1)
        edges = [low + (high - low + 1) * k // count for k in range(1, count)]
        return [Range(a, b) for a, b in zip([None, *edges], [*edges, None])]

    def query(self, part: Range) -> tuple[str, list]:
        """The SQL of one range, and its values."""
        where, values = list(self.conditions), list(self.values)
        key, mark = self.place.key, self.place.mark
        if part.low is not None:
            where.append(f"{key} >= {mark}")
            values.append(part.low)
        if part.high is not None:
            where.append(f"{key} < {mark}" if part.low is not None else f"({key} < {mark} OR {key} IS NULL)")
            values.append(part.high)
        names = ", ".join(f.name for f in self.schema)
        return f"SELECT {names} FROM {self.place.table}" + (f" WHERE {' AND '.join(where)}" if where else ""), values

    def read(self, partition: Range) -> Iterator[pa.RecordBatch]:
        from pyspark.sql.pandas.types import to_arrow_schema
        arrow = to_arrow_schema(self.schema)
        connection = self.place.open()
        try:
            cursor = connection.cursor()
            cursor.execute(*self.query(partition))
            while rows := cursor.fetchmany(FETCH):
                columns = [pa.array([_typed(v, f.type) for v in column], f.type) for column, f in zip(zip(*rows), arrow)]
                yield pa.RecordBatch.from_arrays(columns, schema=arrow)
        finally:
            connection.close()


def _typed(value, kind: pa.DataType):
    """A driver's value in the type that was asked for."""
    if value is None:
        return None
    if pa.types.is_decimal(kind):
        return Decimal(str(value)).quantize(Decimal(1).scaleb(-kind.scale))
    if pa.types.is_date(kind) and isinstance(value, str):
        return dt.date.fromisoformat(value[:10])
    if pa.types.is_timestamp(kind) and isinstance(value, str):
        return dt.datetime.fromisoformat(value)
    return str(value) if pa.types.is_string(kind) else value


@dataclass
class Added(WriterCommitMessage):
    rows: int


class Writer(DataSourceWriter):
    def __init__(self, place: Place, schema: T.StructType, load: str):
        self.place, self.schema, self.load = place, schema, load
        connection = place.open()
        try:
            connection.cursor().execute(f"CREATE TABLE IF NOT EXISTS {LOADS} (load_name VARCHAR(200), task INTEGER, PRIMARY KEY (load_name, task))")
            connection.commit()
        finally:
            connection.close()

    def write(self, iterator: Iterator) -> Added:
        from pyspark import TaskContext
        task, mark, total = TaskContext.get().partitionId(), self.place.mark, 0
        names = [f.name for f in self.schema]
        insert = f"INSERT INTO {self.place.table} ({', '.join(names)}) VALUES ({', '.join([mark] * len(names))})"
        connection = self.place.open()
        try:
            cursor = connection.cursor()
            try:
                cursor.execute(f"INSERT INTO {LOADS} (load_name, task) VALUES ({mark}, {mark})", (self.load, task))
            except Exception as error:
                if "unique" in str(error).lower() or "duplicate" in str(error).lower():
                    connection.rollback()
                    return Added(0)
                raise
            some: list[tuple] = []
            for row in iterator:
                some.append(tuple(_stored(row[n]) for n in names))
                if len(some) >= FETCH:
                    cursor.executemany(insert, some)
                    total, some = total + len(some), []
            if some:
                cursor.executemany(insert, some)
            connection.commit()
            return Added(total + len(some))
        finally:
            connection.close()


class Database(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        raise ValueError("give the schema of the columns to read")

    def reader(self, schema: T.StructType) -> Reader:
        return Reader(Place.of(self.options), schema)

    def writer(self, schema: T.StructType, overwrite: bool) -> Writer:
        if overwrite:
            raise ValueError("tables are only appended to")
        return Writer(Place.of(self.options), schema, self.options["load"])


def _register(spark: SparkSession) -> None:
    spark.conf.set("spark.sql.python.filterPushdown.enabled", "true")
    spark.dataSource.register(Database)


def read_table(spark: SparkSession, place: Place, schema: T.StructType | str) -> DataFrame:
    """The columns of ``schema``, read by ranges of the key in parallel."""
    _register(spark)
    return spark.read.format(FORMAT).schema(schema).options(**place.options()).load()


def append_table(df: DataFrame, place: Place, load: str) -> None:
    """Append rows under the name of a load; sent again, it adds nothing.

    The rows are those of ``df``'s partitions, so the same load must be cut in the same way: it
    is read from stored files, or has been repartitioned by a key.
    """
    _register(df.sparkSession)
    df.write.format(FORMAT).mode("append").options(**place.options(), load=load).save()
