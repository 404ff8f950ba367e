"""Running a function over whole texts, a bounded number of bytes at a time.

Texts arrive as Arrow batches. A batch is cut into slices of at most ``SLICE_BYTES``
of text, so memory is bounded by that or by the longest single text. Vectorised
operators see the UTF-8 bytes of a slice as one array with the places where its
texts begin.
"""

from __future__ import annotations

import ctypes
import tempfile
import zipfile
from collections.abc import Callable, Iterator
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

SLICE_BYTES = 2 << 20
#: Rows in an Arrow batch; the JVM holds one batch for each running task.
BATCH_ROWS = 2_000

#: Bytes that end a word: the space and 0x09 to 0x0D.
SPACES = bytes([0x20, *range(0x09, 0x0E)])


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def bounded_batches(spark: SparkSession) -> None:
    """Readies a session for functions over texts: small Arrow batches, and this package on all executors."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    context = spark.sparkContext
    if getattr(context, "_tallyline_shipped", False):
        return
    package = Path(__file__).resolve().parents[1]
    folder = tempfile.mkdtemp(prefix="tallyline-package-")
    with zipfile.ZipFile(f"{folder}/{package.name}.zip", "w") as out:
        for file in package.rglob("*.py"):
            out.write(file, file.relative_to(package.parent))
    context.addPyFile(f"{folder}/{package.name}.zip")
    context._tallyline_shipped = True


def remainder(column: str, divisor: int):
    """crc32 of the id as text, modulo ``divisor``; NULL for a NULL id."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % divisor


def slices(batch: pa.RecordBatch, text: int, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in order, in parts of at most ``limit`` bytes of text or of one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(text)), 0).to_numpy(zero_copy_only=False)
    ends = np.cumsum(sizes)
    start = 0
    while start < batch.num_rows:
        before = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, before + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def utf8(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The bytes of all texts and the offset of each (one more than there are texts); NULL is empty."""
    if texts.null_count:
        texts = texts.fill_null("")
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    _, places, data = texts.buffers()
    if len(texts) == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(places, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64)
    size = int(offsets[-1] - offsets[0])
    if not size:
        return np.zeros(0, np.uint8), offsets - offsets[0]
    return np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]], offsets - offsets[0]


def give_back() -> None:
    """Hands what Arrow and the C library keep of freed memory to the system; a worker process runs many tasks."""
    pa.default_memory_pool().release_unused()
    if trim := getattr(ctypes.CDLL(None), "malloc_trim", None):
        trim(0)


def map_text(docs: DataFrame, make: Callable[[], Callable], fields: str, keep: list[str] | None = None,
             text: str = "text") -> DataFrame:
    """``docs`` with new columns computed from its texts, row by row, in Arrow batches.

    ``make()`` is called once in each task and gives a function from an Arrow array of
    texts (NULLs included) to one array or list per new column. ``fields`` is the DDL of
    the new columns; a kept column of the same name is replaced. ``keep`` names the
    columns to keep (default: all).
    """
    bounded_batches(docs.sparkSession)
    new = T.StructType.fromDDL(fields)
    keep = [f for f in docs.schema.fields if (keep is None or f.name in keep) and f.name not in new.names]
    kept = [f.name for f in keep]
    out = T.StructType([*keep, *(T.StructField(f.name, f.dataType, True) for f in new.fields)])
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(new)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part in slices(batch, len(kept)):
                made = work(part.column(len(kept)))
                columns = [part.column(k) for k in range(len(kept))]
                columns += [pa.array(value, field.type) if not isinstance(value, pa.Array) else value.cast(field.type)
                            for value, field in zip(made, arrow, strict=True)]
                yield pa.RecordBatch.from_arrays(columns, names=[*kept, *arrow.names])
        give_back()

    names = [F.col(f"`{name}`") for name in kept]
    return docs.select(*names, F.col(f"`{text}`").alias("__text")).mapInArrow(run, out)


def emit_from_text(docs: DataFrame, make: Callable[[], Callable], fields: str, keys: list[str],
                   text: str = "text") -> DataFrame:
    """Rows that a function makes of each slice: ``make()(texts, *key arrays)`` gives a dict of arrays.

    It may also return None, or hold rows back and give them from ``finish()``, an
    attribute of the function that is called at the end of the task.
    """
    bounded_batches(docs.sparkSession)
    schema = T.StructType.fromDDL(fields)
    from pyspark.sql.pandas.types import to_arrow_schema
    arrow = to_arrow_schema(schema)

    def table(made: dict) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(made[f.name], f.type) for f in arrow], schema=arrow)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work = make()
        for batch in batches:
            for part in slices(batch, len(keys)):
                made = work(part.column(len(keys)), *(part.column(k) for k in range(len(keys))))
                if made is not None:
                    yield table(made)
        finish = getattr(work, "finish", None)
        if finish is not None:
            for made in finish():
                yield table(made)
        give_back()

    names = [F.col(f"`{name}`") for name in keys]
    return docs.select(*names, F.col(f"`{text}`").alias("__text")).mapInArrow(run, schema)


def word_table(ends: bytes) -> np.ndarray:
    """For each byte whether it belongs to a word, given the bytes that do not."""
    table = np.ones(256, bool)
    table[np.frombuffer(ends, np.uint8)] = False
    return table


WORD_BYTE = word_table(SPACES)


def words(data: np.ndarray, offsets: np.ndarray, table: np.ndarray = WORD_BYTE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start and end byte of every word, and the index of its text."""
    if not len(data):
        none = np.zeros(0, np.int64)
        return none, none, none
    inside = table[data]
    filled = offsets[:-1] < offsets[1:]
    before = np.empty_like(inside)
    before[0] = False
    before[1:] = inside[:-1]
    before[offsets[:-1][filled]] = False
    starts = np.flatnonzero(inside & ~before)
    after = np.empty_like(inside)
    after[-1] = False
    after[:-1] = inside[1:]
    after[offsets[1:][filled] - 1] = False
    ends = np.flatnonzero(inside & ~after) + 1
    return starts, ends, np.searchsorted(offsets[1:], starts, side="right")


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads the bits of 64-bit numbers (a bijection)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(_BASE, -1, 1 << 64)
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, size: int) -> np.ndarray:
    """1, base, base^2, ... modulo 2^64."""
    known = _POWERS.get(base)
    if known is None or len(known) < size:
        known = np.full(max(size, 1 << 16), np.uint64(base))
        known[0] = 1
        known = np.multiply.accumulate(known)
        if len(known) <= SLICE_BYTES + (1 << 16):
            _POWERS[base] = known
    return known[:size]


def range_hashes(values: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each range of values, equal for equal ranges: a polynomial by prefix sums."""
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values.astype(np.uint64) * powers(_BASE, len(values)), out=sums[1:])
    back = powers(_INVERSE, len(values) + 1)
    return mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    return range_hashes(data.astype(np.uint64) + np.uint64(1), starts, ends)
