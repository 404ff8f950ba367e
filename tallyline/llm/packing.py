"""Packing of token sequences by best-fit decreasing with certified bin counts.

A document's tokens and its end form pieces of at most ``CAPACITY`` tokens: whole if they
fit, else cut so that only the first piece may be shorter. Pieces are dealt evenly to
partitions of about ``PART_PIECES``, whatever their ids. Each partition

1. packs its pieces by best-fit decreasing: the longest piece left goes into the fullest
   sequence it fits. Equal lengths are placed together, which gives the same sequences;
2. takes a lower bound of the sequences any packing of its pieces needs, by dual-feasible
   functions: weights that no full sequence can exceed in sum, so the total weight is a
   bound. Three families are used (rounding, cut-off and their composition);
3. is certified if it uses no more sequences than its bound.

A partition with a gap gives all its sequences with room back to the exchange, a
certified one only its emptiest. What is given back is dealt anew and packed again, until
the sequences of all partitions meet the bound of the whole table, one partition holds
the exchange, a round saves nothing, or after ``ROUNDS``. A round that saves nothing is
not taken.

NULL and empty texts are an end alone. Repeated rows and NULL ids are packed as rows of
their own; ties have any order. An empty table has no pieces. A special token's string
inside a text is that token. Memory is bounded by a slice, the longest text, or the
lengths of one partition.
"""

from __future__ import annotations

import json
import zlib

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.llm.speculative import byte_alphabet
from tallyline.llm.tables import stored, stored_sum
from tallyline.llm.texts import emit_from_text, mix

CAPACITY, END = 1024, 2
#: Pieces that one task packs, and rounds of exchange.
PART_PIECES, ROUNDS = 16_384, 4
#: The pattern of byte-level vocabularies.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""


# -- lower bounds ---------------------------------------------------------------------


def feasible_functions(capacity: int) -> list[tuple[np.ndarray, int]]:
    """(weights of the lengths 0 to capacity, what a full sequence can weigh at most)."""
    x = np.arange(capacity + 1, dtype=np.int64)
    found = [(x, capacity)]
    cut = [np.where(x > capacity - low, capacity, np.where(x < low, 0, x)) for low in range(1, capacity // 2 + 1)]
    found += [(weights, capacity) for weights in cut]
    for k in (1, 2, 3, 4, 5, 7):
        for weights in [x, *cut]:
            exact = (k + 1) * weights % capacity == 0
            found.append((np.where(exact, weights * k, (k + 1) * weights // capacity * capacity), k * capacity))
    for low in range(1, capacity // 2 + 1):
        fit = capacity // low
        small = np.where((x >= low) & (2 * x <= capacity), 1, 0)
        found.append((np.where(2 * x > capacity, fit - (capacity - x) // low, small), fit))
    return found


_FUNCTIONS: dict[int, tuple[np.ndarray, np.ndarray]] = {}


def lower_bound(counts: np.ndarray) -> int:
    """Sequences that ``counts[length]`` pieces need at least; the last length is the capacity."""
    capacity = len(counts) - 1
    if capacity not in _FUNCTIONS:
        found = feasible_functions(capacity)
        _FUNCTIONS[capacity] = np.stack([w for w, _ in found]), np.array([most for _, most in found], np.int64)
    weights, most = _FUNCTIONS[capacity]
    return int((-(-(weights @ counts.astype(np.int64)) // most)).max())


# -- best fit ---------------------------------------------------------------------------


def best_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """(sequence, offset) of each piece by best-fit decreasing."""
    if len(lengths) and not (lengths.min() > 0 and lengths.max() <= capacity):
        raise ValueError("lengths from 1 to the capacity are packed")
    order = np.argsort(-lengths, kind="stable")
    values, firsts = np.unique(-lengths[order], return_index=True)
    sequence, offset = np.empty(len(lengths), np.int64), np.empty(len(lengths), np.int64)
    rooms: list[list[int]] = [[] for _ in range(capacity + 1)]
    filled = np.zeros(capacity + 1, bool)
    opened = 0
    for value, first, stop in zip((-values).tolist(), firsts.tolist(), [*firsts[1:].tolist(), len(order)]):
        def place(bins: np.ndarray, room: int, at: int) -> int:
            """Fills ``bins`` of equal room one after the other; the next piece to place."""
            fit = room // value
            n = min(len(bins) * fit, stop - at)
            which = order[at : at + n]
            turn = np.arange(n)
            sequence[which] = bins[turn // fit]
            offset[which] = capacity - room + value * (turn % fit)
            full, rest = divmod(n, fit)
            left = room - value * fit
            if full and left:
                rooms[left] += bins[:full].tolist()
                filled[left] = True
            if rest:
                rooms[room - value * rest].append(int(bins[full]))
                filled[room - value * rest] = True
            return at + n

        at = first
        while at < stop:
            fitting = filled[value:]
            room = value + int(fitting.argmax())
            if not filled[room]:
                count = -(-(stop - at) // (capacity // value))
                at = place(np.arange(opened, opened + count), capacity, at)
                opened += count
                break
            count = min(len(rooms[room]), -(-(stop - at) // (room // value)))
            bins = np.array(rooms[room][:count])
            rooms[room] = rooms[room][count:]
            filled[room] = bool(rooms[room])
            at = place(bins, room, at)
    return sequence, offset


def pack_part(lengths: np.ndarray, capacity: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, bool]:
    """(sequence, offset, whether it goes to the exchange, certified) of one partition."""
    sequence, offset = best_fit(lengths, capacity)
    used = np.bincount(sequence, lengths).astype(np.int64)
    certified = len(used) <= lower_bound(np.bincount(lengths, minlength=capacity + 1))
    given = used < capacity
    if certified:
        given = given & (np.arange(len(used)) == used.argmin())
    return sequence, offset, given[sequence], certified


# -- on Spark ------------------------------------------------------------------------------


def pieces(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, ids: bool = False, text: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, deal, and with ``ids`` the ids) of each piece.

    ``path`` is a byte-level tokenizer file, read on the driver and broadcast; ``deal`` is a
    number of its own for each piece, which spreads pieces evenly.
    """
    with open(path, encoding="utf-8") as file:
        whole = json.load(file)
    if whole["normalizer"] is not None or whole["pre_tokenizer"]["type"] != "ByteLevel" or whole["pre_tokenizer"]["add_prefix_space"]:
        raise ValueError(f"{path}: not a byte-level tokenizer without prefix spaces")
    special = {token["content"]: token["id"] for token in whole["added_tokens"]}
    letters = {char: byte for byte, char in enumerate(byte_alphabet())}
    ranks = {bytes(letters[c] for c in token): i for token, i in whole["model"]["vocab"].items() if token not in special}
    shared = docs.sparkSession.sparkContext.broadcast((ranks, special))

    def make():
        ranks, special = shared.value
        encode = tiktoken.Encoding("vocabulary", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens=special).encode
        at = (TaskContext.get().partitionId() if TaskContext.get() else 0) << 40

        def work(texts, doc_ids):
            nonlocal at
            which, piece, start, length, crc, tokens = [], [], [], [], [], []
            for row, value in enumerate(texts.to_pylist()):
                row_ids = np.array([*encode(value or "", allowed_special="all"), end], "<u4")
                first = len(row_ids) % capacity if len(row_ids) > capacity else len(row_ids)
                begins = [0, *range(first or capacity, len(row_ids), capacity)]
                for k, (a, b) in enumerate(zip(begins, [*begins[1:], len(row_ids)])):
                    which.append(row)
                    piece.append(k)
                    start.append(a)
                    length.append(b - a)
                    crc.append(zlib.crc32(row_ids[a:b].tobytes()))
                    if ids:
                        tokens.append(row_ids[a:b].astype(np.int32))
            deal = mix(np.arange(at, at + len(which), dtype=np.uint64)).view(np.int64)
            at += len(which)
            made = {"doc_id": doc_ids.take(pa.array(which, pa.int64())), "piece": piece, "start": start, "length": length,
                    "ids_crc32": crc, "deal": deal}
            return {**made, "ids": tokens} if ids else made

        return work

    kind = docs.schema["doc_id"].dataType.simpleString()
    fields = f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, deal long" + (", ids array<int>" if ids else "")
    return emit_from_text(docs, make, fields, ["doc_id"], text)


def _round(rows: DataFrame, number: int, parts: int, capacity: int) -> tuple[DataFrame, dict]:
    """``rows`` (deal, length, ...) packed in ``parts`` partitions, with the sequences used."""
    rows = rows.drop("sequence_id", "offset", "given", "certified")
    names = [*rows.columns, "sequence_id", "offset", "given", "certified"]

    def pack(key: tuple, table: pa.Table) -> pa.Table:
        lengths = table.column("length").to_numpy()
        sequence, offset, given, certified = pack_part(lengths, capacity)
        sequence += (number << 24 | key[0].as_py()) << 32
        flags = pa.array(np.full(len(lengths), certified))
        return pa.Table.from_arrays([*table.drop_columns(["part"]).columns, pa.array(sequence), pa.array(offset),
                                     pa.array(given), flags], names)

    out = T.StructType(list(rows.schema.fields)).add("sequence_id", "long").add("offset", "long").add("given", "boolean").add("certified", "boolean")
    dealt = rows.withColumn("part", F.pmod(F.xxhash64("deal", F.lit(number)), F.lit(parts)).cast("long"))
    return stored_sum(dealt.groupBy("part").applyInArrow(pack, out), "packed", bins=F.count_if(F.expr("offset = 0")),
                      given=F.count_if("given"), given_bins=F.count_if(F.expr("given AND offset = 0")))


def place(cut: DataFrame, capacity: int = CAPACITY, part_pieces: int = PART_PIECES, rounds: int = ROUNDS) -> DataFrame:
    """``cut`` (deal, length, any more), a stored table, with sequence_id, offset, and whether the
    partition that placed a piece was certified to need all its sequences."""
    lengths = np.zeros(capacity + 1, np.int64)
    for row in cut.groupBy("length").count().toLocalIterator():   # at most one row for each length
        lengths[row["length"]] = row["count"]
    parts = max(1, -(-int(lengths.sum()) // part_pieces))
    bound = lower_bound(lengths)
    placed, seen = _round(cut, 0, parts, capacity)
    total, done = seen["bins"] or 0, []
    for number in range(1, rounds + 1):
        if total <= bound or parts == 1 or not seen["given"]:
            break
        parts = max(1, -(-seen["given"] // part_pieces))
        again, now = _round(placed.where("given"), number, parts, capacity)
        if now["bins"] >= seen["given_bins"]:
            break
        done.append(placed.where("NOT given"))
        total += now["bins"] - seen["given_bins"]
        placed, seen = again, now
    for part in done:
        placed = placed.unionByName(part)
    return placed.drop("given")


def pack(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, text: str = "text") -> DataFrame:
    """(doc_id, piece, start, length, ids_crc32, sequence_id, offset, certified) of each piece of ``docs``."""
    return place(stored(pieces(docs, path, capacity, end, text=text), "pieces"), capacity).drop("deal")


def sequences(docs: DataFrame, path: str, capacity: int = CAPACITY, end: int = END, text: str = "text") -> DataFrame:
    """(sequence_id, ids): the packed token sequences, each of at most ``capacity`` ids."""
    cut = stored(pieces(docs, path, capacity, end, True, text), "pieces")
    placed = place(cut.drop("ids"), capacity).select("deal", "sequence_id", "offset")
    parts = placed.join(cut.select("deal", "ids"), "deal").groupBy("sequence_id").agg(
        F.sort_array(F.collect_list(F.struct("offset", "ids"))).alias("parts"))   # at most ``capacity`` tokens
    return parts.select("sequence_id", F.flatten("parts.ids").alias("ids"))
