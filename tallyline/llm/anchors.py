"""Near-duplicates by SimHash, linked through the anchor points of a covering code.

Fingerprint: 64 bits, by majority over the hashes of a text's word shingles. Two
fingerprints are linked if they differ in at most ``threshold`` bits (here up to 5).

The 64 bits are three blocks. If two fingerprints differ in at most five bits, they
differ in at most one bit of some block. Each block is covered by a code: its first 15
bits by the perfect Hamming code, whose words lie within one bit of every value, its
other bits by all their values. The code words are the anchors. A fingerprint's home is
the anchor within the covering radius (1); it is sent to every anchor within radius
plus block threshold (2), 14.5 of them on average in each block. Linked fingerprints so
meet at the home of one of them, whatever else lies there.

Per anchor, fingerprints are compared with those at home there, and the links found are
given as a forest: once two are known to belong together no further link between them
is looked for, so a group of near copies yields as many links as members, not pairs.
An anchor with more than ``CELL`` fingerprints is split into blocks, and each pair of
blocks is one piece of work. Links are joined by connected components over
fingerprints; exact copies share one fingerprint and meet only in the first grouping.

NULL and empty texts have fingerprint zero, which is linked like any other. A row with
a NULL id takes part, but is never a component's id. Repeated rows are kept. Very long
texts take memory in proportion to their own length.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.tables import components, stored
from tallyline.llm.texts import bounded_batches, map_text

SHINGLE, SEED, THRESHOLD = 4, 42, 4
CODED = 15
#: (first bit, bits beyond the coded ones) of each block.
BLOCKS = ((0, 6), (21, 6), (42, 7))
#: Fingerprints at one anchor that one piece of work compares with each other.
CELL = 1 << 16
#: Comparisons at one anchor up to which all its pairs are tested at once with those of other anchors.
TOGETHER = 4096


def fingerprint(text: str | None, size: int = SHINGLE) -> int:
    """The fingerprint of one text as an unsigned number."""
    parts = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not parts:
        return 0
    line = b" ".join(parts)
    if len(parts) <= size:
        return xxhash.xxh64_intdigest(line, SEED)
    ends = np.cumsum([len(part) + 1 for part in parts])
    begins = [0, *ends[:-size].tolist()]
    stops = (ends[size - 1 :] - 1).tolist()
    digest = xxhash.xxh64_intdigest
    hashes = np.fromiter([digest(line[a:b], SEED) for a, b in zip(begins, stops)], np.uint64, len(stops))
    ones = np.zeros(64, np.int64)
    for k in range(0, len(hashes), 1 << 15):
        bits = np.unpackbits(hashes[k : k + (1 << 15)].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        ones += np.add.reduce(bits, axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view(np.uint64)[0])


def fingerprints(docs: DataFrame, keep: list[str] | None = None, size: int = SHINGLE, text: str = "text",
                 name: str = "fp") -> DataFrame:
    """``docs`` with the fingerprint of each whole text as a signed 64-bit number."""

    def make():
        return lambda texts: [np.array([fingerprint(t, size) for t in texts.to_pylist()], np.uint64).view(np.int64)]

    return map_text(docs, make, f"`{name}` long", keep, text)


def _syndromes() -> np.ndarray:
    """For each 15-bit value the XOR of the positions (from 1) of its set bits."""
    values = np.arange(1 << CODED)
    out = np.zeros(1 << CODED, np.int64)
    for bit in range(CODED):
        out ^= np.where(values >> bit & 1, bit + 1, 0)
    return out


SYNDROME = _syndromes()


def _flip(values: np.ndarray, position: np.ndarray) -> np.ndarray:
    """Flips the coded bit at each position from 1; position 0 flips none."""
    return np.where(position > 0, values ^ (1 << np.maximum(position - 1, 0)), values)


def _parts(fps: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    first, rest = BLOCKS[block]
    bits = (fps >> np.uint64(first)).astype(np.int64) & ((1 << CODED + rest) - 1)
    return bits & ((1 << CODED) - 1), bits >> CODED


def _cell(block: int, word: np.ndarray, rest: np.ndarray) -> np.ndarray:
    return (block << 40) | (rest << CODED) | word


def home(fps: np.ndarray, block: int) -> np.ndarray:
    """The anchor within radius 1 of each fingerprint."""
    coded, rest = _parts(fps, block)
    return _cell(block, _flip(coded, SYNDROME[coded]), rest)


def visits(fps: np.ndarray, block: int) -> tuple[np.ndarray, np.ndarray]:
    """(index, anchor) of every anchor within distance 2 of each fingerprint."""
    coded, rest = _parts(fps, block)
    syndrome = SYNDROME[coded]
    which = np.arange(len(fps))
    near = _flip(coded, syndrome)                      # distance 0 or 1
    found = [(which, _cell(block, near, rest))]
    off = syndrome > 0
    for i in range(1, CODED + 1):                      # two flips whose positions XOR to the syndrome
        j = syndrome ^ i
        take = off & (j > i)
        found.append((which[take], _cell(block, _flip(_flip(coded, np.full_like(coded, i)), j)[take], rest[take])))
    bits = range(BLOCKS[block][1])
    for i in bits:
        found.append((which, _cell(block, near, rest ^ (1 << i))))
        for j in bits[:i]:
            found.append((which[~off], _cell(block, near[~off], rest[~off] ^ (1 << i) ^ (1 << j))))
    return np.concatenate([w for w, _ in found]), np.concatenate([c for _, c in found])


def forest(fps: np.ndarray, at_home: np.ndarray, threshold: int) -> tuple[list, list]:
    """Links that connect whatever is linked to a member at home, one for each member reached."""
    left, right, rest = [], [], np.arange(len(fps))
    open_ = np.ones(len(fps), bool)
    for root in np.flatnonzero(at_home):
        if not open_[root]:
            continue
        open_[root] = False
        rest = rest[open_[rest]]
        queue = [root]
        while queue and len(rest):
            x = queue.pop()
            close = np.bitwise_count(fps[rest] ^ fps[x]) <= threshold
            if close.any():
                reached = rest[close]
                rest = rest[~close]
                open_[reached] = False
                queue.extend(reached)
                left.append(np.full(len(reached), fps[x]))
                right.append(fps[reached])
    return left, right


def compare(cells: np.ndarray, parts: np.ndarray, fps: np.ndarray, threshold: int) -> tuple[np.ndarray, np.ndarray]:
    """Links within the groups of equal (cell, part); the rows of a group stand together."""
    cut = np.flatnonzero((cells[1:] != cells[:-1]) | (parts[1:] != parts[:-1])) + 1
    starts = np.concatenate([[0], cut])
    sizes = np.diff(np.concatenate([starts, [len(cells)]]))
    at_home = np.zeros(len(cells), bool)
    for block in range(len(BLOCKS)):
        mine = cells >> 40 == block
        at_home[mine] = home(fps[mine], block) == cells[mine]
    homes = np.add.reduceat(at_home, starts, dtype=np.int64)
    small = homes * sizes <= TOGETHER
    group = np.repeat(np.arange(len(starts)), sizes)
    left, right = [], []
    a = np.flatnonzero(at_home & small[group])
    width = sizes[group[a]]
    first = np.repeat(a, width)
    second = np.arange(len(first)) - np.repeat(np.cumsum(width) - width, width) + starts[group[first]]
    close = (np.bitwise_count(fps[first] ^ fps[second]) <= threshold) & (first != second)
    first, second = first[close], second[close]
    hits = np.bincount(group[first], minlength=len(starts))
    few = (hits <= sizes)[group[first]]
    left.append(fps[first[few]])
    right.append(fps[second[few]])
    for g in np.flatnonzero(~small & (homes > 0) | (hits > sizes)):
        part = slice(starts[g], starts[g] + sizes[g])
        some = forest(fps[part], at_home[part], threshold)
        left += some[0]
        right += some[1]
    return np.concatenate(left), np.concatenate(right)


def links(distinct: DataFrame, threshold: int = THRESHOLD, cell_size: int = CELL) -> DataFrame:
    """Links (a, b) between the fingerprints in column ``fp`` (no repeats) that connect all within ``threshold`` bits."""
    if threshold >= 2 * len(BLOCKS):
        raise ValueError("three blocks guarantee one with at most one differing bit up to five bits")

    bounded_batches(distinct.sparkSession)

    def expand(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            fps = batch.column(0).to_numpy().view(np.uint64)
            for block in range(len(BLOCKS)):
                which, cells = visits(fps, block)
                yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(fps[which].view(np.int64))], ["cell", "fp"])

    members = distinct.select("fp").mapInArrow(expand, "cell long, fp long")
    crowded = members.groupBy("cell").agg(F.count("*").alias("n")).where(F.col("n") > cell_size)
    crowded = stored(crowded.select("cell", F.ceil(F.col("n") / cell_size).cast("int").alias("k")), "crowded")
    members = members.join(crowded, "cell", "left").withColumn("k", F.coalesce("k", F.lit(1)))
    members = members.withColumn("s", F.pmod(F.xxhash64("fp"), F.col("k")).cast("int"))
    other = F.explode(F.when(F.col("k") == 1, F.array(F.lit(0))).otherwise(F.sequence(F.lit(0), F.col("k") - 1)))
    members = members.withColumn("o", other).select(
        "cell", (F.least("s", "o") * F.col("k").cast("long") + F.greatest("s", "o")).alias("part"), "fp")
    members = members.repartition("cell", "part").sortWithinPartitions("cell", "part")

    def found(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []

        def flush(rows: tuple) -> Iterator[pa.RecordBatch]:
            if len(rows[0]):
                a, b = compare(*rows, threshold)
                yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64))], ["a", "b"])

        for batch in batches:
            cells, parts = batch.column(0).to_numpy(), batch.column(1).to_numpy()
            held.append((cells, parts, batch.column(2).to_numpy().view(np.uint64)))
            if cells[0] == cells[-1] and parts[0] == parts[-1] or sum(len(h[0]) for h in held) < 1 << 14:
                continue
            rows = tuple(map(np.concatenate, zip(*held)))
            last = int(np.flatnonzero((rows[0] != rows[0][-1]) | (rows[1] != rows[1][-1]))[-1]) + 1 if (
                (rows[0][0], rows[1][0]) != (rows[0][-1], rows[1][-1])) else 0
            yield from flush(tuple(r[:last] for r in rows))
            held = [tuple(r[last:].copy() for r in rows)]
        if held:
            yield from flush(tuple(map(np.concatenate, zip(*held))))

    return members.mapInArrow(found, "a long, b long")


def labels(prints: DataFrame, threshold: int = THRESHOLD) -> DataFrame:
    """(fp, component_id, rows) of each fingerprint of ``prints`` (doc_id, fp): the smallest id reachable."""
    distinct = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct")
    joined = components(links(distinct, threshold))
    linked = distinct.join(joined, distinct.fp == joined.node, "left").select(
        "fp", "low", F.coalesce("component", "fp").alias("component"))
    linked = stored(linked, "linked")
    lowest = stored(linked.groupBy("component").agg(F.min("low").alias("component_id")), "lowest")
    return stored(linked.join(lowest, "component").select("fp", "component_id"), "labels")


def near_duplicates(docs: DataFrame, threshold: int = THRESHOLD, size: int = SHINGLE) -> DataFrame:
    """(doc_id, fingerprint, component_id) of each row of ``docs`` (doc_id, text)."""
    prints = stored(fingerprints(docs, ["doc_id"], size), "prints")
    return prints.join(labels(prints, threshold), "fp").select(
        "doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def first_of_each(docs: DataFrame, threshold: int = THRESHOLD, size: int = SHINGLE) -> DataFrame:
    """``docs`` with one row of each component, that of its smallest id; rows with a NULL id stay."""
    ids = near_duplicates(docs, threshold, size).where("doc_id = component_id")
    ids = stored(ids.groupBy(F.col("doc_id").alias("__id")).agg(F.count("*").alias("__n")), "kept")
    kept = docs.join(ids, F.col("doc_id") == F.col("__id"))
    single = kept.where("__n = 1").select(*[docs[f"`{c}`"] for c in docs.columns])
    repeated = kept.where("__n > 1").dropDuplicates(["doc_id"]).select(*[docs[f"`{c}`"] for c in docs.columns])
    return single.unionAll(repeated).unionAll(docs.where("doc_id IS NULL"))
