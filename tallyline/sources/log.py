"""A topic kept as files: an append-only log in partitions, read by consumer groups.

Every message has a place, its partition and its offset. A partition is a folder of files,
each named by the offset of its first message and its number of messages; files are never
changed. Equal keys go to the same partition. A reader keeps one offset for each partition;
a group's position is stored when a batch has been written and the next one begins, so a
query of that group goes on there whatever its checkpoint (its own checkpoint knows the last
batch as well), and groups do not know of each other. A new group begins at the
``earliest`` or the ``latest`` message. A batch takes at most so many messages of each
partition; a query that runs once (``availableNow``) takes one such batch.
"""

from __future__ import annotations

import json
import uuid
from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

from tallyline.session import stored

FORMAT = "tallyline_log"
MESSAGE = "partition INT, offset BIGINT, key STRING, value STRING"
PER_BATCH = 100_000


def _system(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _files(path: str) -> dict[int, list[tuple[int, int, str]]]:
    """For each partition its files as (first offset, messages, path), in order."""
    system, root = _system(path)
    found: dict[int, list] = {}
    for info in system.get_file_info(fs.FileSelector(f"{root}/log", recursive=True, allow_not_found=True)):
        parts = info.path.split("/")
        if info.type == fs.FileType.File and info.base_name.endswith(".parquet") and parts[-2].startswith("partition="):
            first, count = info.base_name.split(".")[0].split("-")[:2]
            found.setdefault(int(parts[-2].split("=")[1]), []).append((int(first), int(count), info.path))
    return {k: sorted(v) for k, v in found.items()}


def ends(path: str) -> dict[int, int]:
    """The offset after the last message of each partition."""
    return {k: files[-1][0] + files[-1][1] for k, files in _files(path).items()}


def append(messages: DataFrame, path: str, partitions: int = 8) -> None:
    """Append (key, value) messages in their order within a task; equal keys share a partition.

    One writer at a time. The messages of a partition get their offsets in one task each, and
    a file appears under its name when it is whole.
    """
    before = ends(path)
    rows = messages.select(F.col("key").cast("string"), F.col("value").cast("string"), F.monotonically_increasing_id().alias("_at"))
    rows = stored(rows.withColumn("partition", F.pmod(F.xxhash64("key"), F.lit(partitions)).cast("int")), "messages")
    start = F.coalesce(F.create_map(*[F.lit(x) for k, v in before.items() for x in (k, v)])[F.col("partition")], F.lit(0)) if before else F.lit(0)
    place = F.row_number().over(Window.partitionBy("partition").orderBy("_at")) - 1 + start
    placed = rows.withColumn("offset", place.cast("bigint")).select("partition", "offset", "key", "value")

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, root = _system(path)
        for batch in batches:                    # rows of a partition come in order
            table = pa.Table.from_batches([batch])
            which = table.column("partition").to_pylist()
            cuts = [0, *[k for k in range(1, len(which)) if which[k] != which[k - 1]], len(which)]
            for a, b in zip(cuts, cuts[1:]):
                part = table.slice(a, b - a)
                folder = f"{root}/log/partition={which[a]}"
                system.create_dir(folder, recursive=True)
                hidden = f"{folder}/.{uuid.uuid4().hex}"
                with system.open_output_stream(hidden) as out:
                    pq.write_table(part, out)
                system.move(hidden, f"{folder}/{part.column('offset')[0].as_py():020d}-{b - a}.parquet")
        yield pa.RecordBatch.from_pylist([], pa.schema([("n", pa.int32())]))

    placed.mapInArrow(write, "n int").count()


@dataclass
class Stretch(InputPartition):
    """Messages from one offset to before another of one partition."""

    partition: int
    low: int
    high: int


class Reader(DataSourceStreamReader):
    def __init__(self, options: dict):
        self.path, self.group = options["path"], options.get("group")
        self.start = options.get("startingOffsets", "latest")
        self.most = int(options.get("maxPerBatch", PER_BATCH))
        self.reached: dict[str, int] | None = None

    def _position(self) -> dict[str, int] | None:
        if not self.group:
            return None
        system, root = _system(self.path)
        infos = system.get_file_info(fs.FileSelector(f"{root}/groups/{self.group}", allow_not_found=True))
        names = sorted(i.path for i in infos if i.base_name.endswith(".json"))
        if not names:
            return None
        with system.open_input_stream(names[-1]) as file:
            return json.loads(file.read())

    def initialOffset(self) -> dict:
        found = self._position()
        if found is None:
            found = {str(k): v if self.start == "latest" else 0 for k, v in ends(self.path).items()}
        return found

    def latestOffset(self) -> dict:
        if self.reached is None:
            self.reached = self.initialOffset()
        last = ends(self.path)
        self.reached = {str(k): min(v, self.reached.get(str(k), 0) + self.most) for k, v in last.items()}
        return self.reached

    def partitions(self, start: dict, end: dict) -> list[Stretch]:
        # A restart gives the end that was planned before it; the next batch goes on from there.
        if self.reached is None or any(self.reached.get(k, 0) < v for k, v in end.items()):
            self.reached = dict(end)
        return [Stretch(int(k), start.get(k, 0), high) for k, high in end.items() if high > start.get(k, 0)]

    def read(self, partition: Stretch) -> Iterator[pa.RecordBatch]:
        system, _ = _system(self.path)
        for first, count, path in _files(self.path).get(partition.partition, []):
            if first < partition.high and first + count > partition.low:
                with system.open_input_file(path) as file:
                    for batch in pq.ParquetFile(file).iter_batches(8192):
                        offset = batch.column("offset").to_numpy()
                        low, high = (int(x) for x in offset.searchsorted([partition.low, partition.high]))
                        if high > low:
                            yield pa.RecordBatch.from_arrays(
                                [batch.column(n).slice(low, high - low) for n in ("partition", "offset", "key", "value")],
                                schema=pa.schema([("partition", pa.int32()), ("offset", pa.int64()), ("key", pa.string()), ("value", pa.string())]))

    def commit(self, end: dict) -> None:
        """Stores the group's position; called when the batch up to ``end`` has been written."""
        if not self.group:
            return
        system, root = _system(self.path)
        folder = f"{root}/groups/{self.group}"
        system.create_dir(folder, recursive=True)
        name = f"{sum(end.values()):020d}.json"
        with system.open_output_stream(f"{folder}/.{name}") as out:
            out.write(json.dumps(end).encode())
        system.move(f"{folder}/.{name}", f"{folder}/{name}")


class Log(DataSource):
    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return MESSAGE

    def streamReader(self, schema) -> Reader:
        return Reader(self.options)


def read(spark: SparkSession, path: str, group: str | None = None, start: str = "latest", per_batch: int = PER_BATCH) -> DataFrame:
    """Stream of (partition, offset, key, value) for a consumer group."""
    spark.dataSource.register(Log)
    options = {"path": path, "startingOffsets": start, "maxPerBatch": str(per_batch)} | ({"group": group} if group else {})
    return spark.readStream.format(FORMAT).options(**options).load()
