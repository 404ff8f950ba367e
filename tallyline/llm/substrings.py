"""Exact substring de-duplication by recompression.

A window is ``WINDOW`` consecutive words of one document. Every word is removed that a
window covers whose words also start in a document with a smaller id.

Recompression replaces, round by round, runs of one word and then neighbouring pairs by
new symbols. A symbol's name is a hash of what it stands for, so names agree in all
documents without a table of names. Pairs are chosen by a bit of each symbol's name
(left or right half of the alphabet, drawn anew each round), so whether two symbols join
depends on those two alone, and equal stretches of words get equal symbols inside. With
each symbol goes its context: the stretch of words that settles its existence. A window
that holds a symbol's context holds that symbol wherever the window occurs. The symbol
with the smallest hash among those is the window's key; a window without one has its
own hash as key. The key depends on the window's words only, so equal windows have
equal keys, and neighbouring windows mostly share one.

1. Keys of all documents, combined in each slice, grouped: keys in two documents or more.
2. Keys of all documents again, joined with these: the documents that hold shared keys.
   Exact copies of a document with a smaller id are settled by a hash of the whole text.
3. Those documents, with their shared keys: hashes of their windows, grouped by key in
   the order of ids. The first document of a window keeps it. A window seen twice in one
   slice is settled there, so a passage in a third of all documents is sent once per slice.
4. The texts are joined with the stretches to remove.

A window is known by its key and its hash, 128 bits. NULL and empty texts have no words.
A document with a NULL id keeps all words and takes none from others. Repeated rows (one
id twice) do not remove each other. Memory is bounded by a slice, the longest text, or
the different windows around one symbol.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.tables import stored
from tallyline.llm.texts import bounded_batches, emit_from_text, mix, range_hashes, slices, utf8, word_hashes, words

WINDOW = 50
#: Rounds of pairing, and the most words one symbol may stand for.
ROUNDS, LONGEST = 4, 8
#: Bytes of text whose windows are compared before they are sent.
SETTLE_BYTES = 4 << 20


def _salt(round_: int) -> np.uint64:
    return np.uint64((0xD6E8FEB86659FD93 * (2 * round_ + 1)) & 0xFFFFFFFFFFFFFFFF)


def parse(names: np.ndarray, first: np.ndarray, beyond: np.ndarray, rounds: int = ROUNDS,
          longest: int = LONGEST) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The symbols of a row of words, each with the begin and end of its context.

    ``names`` are word hashes; ``first`` and ``beyond`` give for each word the begin and
    end of its document. A context that reaches outside its document does not count.
    """
    n = len(names)
    at = np.arange(n)
    # Runs: a word is a symbol of its own if both its neighbours differ.
    starts = np.ones(n, bool)
    starts[1:] = (names[1:] != names[:-1]) | (first[1:] != first[:-1])
    begin = at[starts]
    size = np.diff(np.append(begin, n))
    symbol = names[starts]
    run = size > 1
    symbol[run] = mix(symbol[run] ^ mix(size[run].astype(np.uint64)))
    low, high = begin - 1, begin + size + 1
    first, beyond = first[starts], beyond[starts]
    for k in range(rounds):
        if len(symbol) < 2:
            break
        bit = (mix(symbol ^ _salt(k)) >> np.uint64(17)) & np.uint64(1)
        open_ = size < longest
        left, right = open_ & (bit == 0), open_ & (bit == 1)
        same = first[1:] == first[:-1]
        joined = np.zeros(len(symbol), bool)
        joined[:-1] = left[:-1] & right[1:] & same & (size[:-1] + size[1:] <= longest)
        second = np.zeros(len(symbol), bool)
        second[1:] = joined[:-1]
        # Who stays needs to know the neighbour that it did not join.
        new_low, new_high = low.copy(), high.copy()
        before = np.where(np.concatenate([[False], same]), np.concatenate([low[:1], low[:-1]]), first - 1)
        after = np.where(np.concatenate([same, [False]]), np.concatenate([high[1:], high[-1:]]), beyond + 1)
        stays = right & ~second
        new_low[stays] = np.minimum(low, before)[stays]
        stays = left & ~joined
        new_high[stays] = np.maximum(high, after)[stays]
        pair = np.flatnonzero(joined)
        symbol[pair] = mix(symbol[pair] * np.uint64(3) ^ mix(symbol[pair + 1]))
        size[pair] += size[pair + 1]
        new_high[pair] = high[pair + 1]
        keep = ~second
        symbol, size, low, high = symbol[keep], size[keep], new_low[keep], new_high[keep]
        first, beyond = first[keep], beyond[keep]
    return symbol, low, high


def least_inside(order: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """For each range [begin, end) the index of its smallest value, the leftmost of equals; -1 where it is empty."""
    out = np.full(len(begin), -1, np.int64)
    some = np.flatnonzero(end > begin)
    if not len(some):
        return out
    level = np.frexp((end - begin)[some].astype(float))[1] - 1
    best = np.arange(len(order))
    for k in range(int(level.max()) + 1):
        now = level == k
        a, b = best[begin[some[now]]], best[end[some[now]] - (1 << k)]
        out[some[now]] = np.where(order[b] < order[a], b, a)
        width = 1 << k
        if len(best) <= width:
            break
        shifted = best[width:]
        best = np.where(order[shifted] < order[best[:-width]], shifted, best[:-width])
    return out


class Windows:
    """All windows of the texts of a slice: document index, first word, key."""

    def __init__(self, texts: pa.Array, size: int):
        data, offsets = utf8(texts)
        starts, ends, doc = words(data, offsets)
        self.names = word_hashes(data, starts, ends)
        counts = np.bincount(doc, minlength=len(texts))
        stops = np.cumsum(counts)
        self.begins = stops - counts
        first, beyond = self.begins[doc], stops[doc]
        self.size = size
        self.at = np.flatnonzero(np.arange(len(doc)) + size <= beyond)
        self.doc = doc[self.at]
        symbol, low, high = parse(self.names, first, beyond)
        begin = np.searchsorted(low, self.at)
        end = np.searchsorted(high, self.at + size, side="right")
        order = mix(symbol)
        chosen = least_inside(order, begin, end)
        self.key = symbol[chosen] if len(symbol) else np.zeros(0, np.uint64)
        self.key[chosen < 0] = self.hashes(np.flatnonzero(chosen < 0))

    def hashes(self, which: np.ndarray) -> np.ndarray:
        return range_hashes(self.names, self.at[which], self.at[which] + self.size)

    def keys(self) -> tuple[np.ndarray, np.ndarray]:
        """The different (document index, key)."""
        if not len(self.key):
            return self.doc, self.key
        change = np.ones(len(self.key), bool)
        change[1:] = (self.key[1:] != self.key[:-1]) | (self.doc[1:] != self.doc[:-1])
        doc, key = self.doc[change], self.key[change]
        order = np.lexsort((key, doc))
        doc, key = doc[order], key[order]
        change = np.ones(len(key), bool)
        change[1:] = (key[1:] != key[:-1]) | (doc[1:] != doc[:-1])
        return doc[change], key[change]


def _present(docs: DataFrame, text: str) -> DataFrame:
    """(doc_id, rid, text): ``rid`` tells rows of one id with different texts apart."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", text).alias("rid"),
                       F.col(text).alias("text"))


def _keys(size: int):
    def make():
        def work(texts, ids, rids):
            doc, key = Windows(texts, size).keys()
            return {"key": key.view(np.int64), "doc_id": ids.to_numpy()[doc], "rid": rids.to_numpy()[doc]}

        return work

    return make


def _combined_keys(size: int):
    def make():
        def work(texts, ids):
            doc, key = Windows(texts, size).keys()
            ids = ids.to_numpy()[doc]
            order = np.lexsort((ids, key))
            key, ids = key[order], ids[order]
            change = np.flatnonzero(np.concatenate([[True], key[1:] != key[:-1]])) if len(key) else np.zeros(0, np.int64)
            last = np.append(change[1:], len(key)) - 1 if len(key) else change
            return {"key": key[change].view(np.int64), "low": ids[change], "high": ids[last]}

        return work

    return make


def _runs(at: np.ndarray, size: int) -> list[tuple[int, int]]:
    """The stretches of words that windows at these places cover."""
    if not len(at):
        return []
    at = np.unique(at)
    cut = np.flatnonzero(at[1:] > at[:-1] + size) + 1
    return [(int(part[0]), int(part[-1]) + size) for part in np.split(at, cut)]


def _send_windows(size: int):
    """Of each slice: stretches settled there, and each different window once, of its smallest id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for part in slices(batch, 3, SETTLE_BYTES):
                ids, rids = part.column(0).to_numpy(), part.column(1).to_numpy()
                shared = part.column(2)
                windows = Windows(part.column(3), size)
                flat = shared.flatten().to_numpy().view(np.uint64)
                owner = np.repeat(np.arange(len(ids)), shared.value_lengths().to_numpy())
                # A window counts if its document holds its key as a shared one.
                wanted = np.sort(mix(flat ^ mix(owner.astype(np.uint64))))
                mine = mix(windows.key ^ mix(windows.doc.astype(np.uint64)))
                place = np.minimum(np.searchsorted(wanted, mine), max(len(wanted) - 1, 0))
                which = np.flatnonzero(wanted[place] == mine) if len(wanted) else np.zeros(0, np.int64)
                if not len(which):
                    continue
                doc, key, at = windows.doc[which], windows.key[which], windows.at[which] - windows.begins[windows.doc[which]]
                hashes = windows.hashes(which)
                order = np.lexsort((at, doc, ids[doc], hashes, key))
                which, doc, key, at, hashes = which[order], doc[order], key[order], at[order], hashes[order]
                new = np.ones(len(key), bool)
                new[1:] = (key[1:] != key[:-1]) | (hashes[1:] != hashes[:-1])
                holder = ids[doc][np.maximum.accumulate(np.where(new, np.arange(len(new)), 0))]
                settled = ids[doc] > holder
                rows = {name: [] for name in ("key", "doc_id", "rid", "at", "hashes", "begin", "end")}

                def add(key_, d, at_, hashes_, begin, end):
                    for name, value in zip(rows, (key_, int(ids[d]), int(rids[d]), at_, hashes_, begin, end)):
                        rows[name].append(value)

                for d in np.unique(doc[settled]):
                    for begin, end in _runs(at[settled & (doc == d)], size):
                        add(None, d, None, None, begin, end)
                doc, key, at, hashes = doc[~settled], key[~settled], at[~settled], hashes[~settled]
                order = np.lexsort((at, doc, key))
                doc, key, at, hashes = doc[order], key[order], at[order], hashes[order].view(np.int64)
                cut = np.flatnonzero((key[1:] != key[:-1]) | (doc[1:] != doc[:-1])) + 1
                bounds = [0, *cut.tolist(), len(key)] if len(key) else [0]
                signed = key.view(np.int64)
                for a, b in zip(bounds, bounds[1:]):
                    add(int(signed[a]), doc[a], at[a:b], hashes[a:b], None, None)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(rows["key"], pa.int64()), pa.array(rows["doc_id"], pa.int64()), pa.array(rows["rid"], pa.int64()),
                     pa.array(rows["at"], pa.list_(pa.int32())), pa.array(rows["hashes"], pa.list_(pa.int64())),
                     pa.array(rows["begin"], pa.int32()), pa.array(rows["end"], pa.int32())], list(rows))

    return run


def _settle(size: int):
    """Rows of one key in the order of ids: a window that a smaller id has shown is to be removed."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, seen = None, {}
        for batch in batches:
            out = {"doc_id": [], "rid": [], "begin": [], "end": []}
            keys, ids, rids, ats, hashes = (batch.column(k) for k in range(5))
            flat_at, flat_hash = ats.flatten().to_numpy(), hashes.flatten().to_numpy().tolist()
            ends = np.cumsum(ats.value_lengths().to_numpy()).tolist()
            begin = 0
            for key, doc, rid, end in zip(keys.to_numpy().tolist(), ids.to_numpy().tolist(), rids.to_numpy().tolist(), ends):
                if key != now:
                    now, seen = key, {}
                gone = [k for k in range(begin, end) if seen.setdefault(flat_hash[k], doc) < doc]
                for a, b in _runs(flat_at[gone], size) if gone else ():
                    for name, value in zip(out, (doc, rid, a, b)):
                        out[name].append(value)
                begin = end
            yield pa.RecordBatch.from_arrays([pa.array(out["doc_id"], pa.int64()), pa.array(out["rid"], pa.int64()),
                                              pa.array(out["begin"], pa.int32()), pa.array(out["end"], pa.int32())], list(out))

    return run


def copies(docs: DataFrame, text: str = "text") -> DataFrame:
    """(doc_id, rid) of each row whose whole text a row with a smaller id has."""
    rows = docs.where(f"doc_id IS NOT NULL AND `{text}` IS NOT NULL").select(
        F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", text).alias("rid"),
        F.xxhash64(text).alias("h1"), F.xxhash64(F.lit(1), text).alias("h2"))
    rows = stored(rows, "texts")
    firsts = rows.groupBy("h1", "h2").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high")
    firsts = stored(firsts.select("h1", "h2", "low"), "firsts")
    return rows.join(firsts, ["h1", "h2"]).where("doc_id > low").select("doc_id", "rid").distinct()


def stretches(docs: DataFrame, size: int = WINDOW, text: str = "text") -> DataFrame:
    """(doc_id, rid, whole, cuts) of the documents that lose words: ``cuts`` are (begin, end) in words.

    ``whole`` marks exact copies, which lose all words if they have ``size`` or more.
    """
    spark = docs.sparkSession
    rows = _present(docs, text)
    known = rows.where("doc_id IS NOT NULL")
    keys = emit_from_text(known, _combined_keys(size), "key long, low long, high long", ["doc_id"])
    shared = keys.groupBy("key").agg(F.min("low").alias("low"), F.max("high").alias("high")).where("low < high")
    shared = stored(shared.select("key"), "shared")
    same = stored(copies(docs, text), "copies")
    held = emit_from_text(known, _keys(size), "key long, doc_id long, rid long", ["doc_id", "rid"]).join(shared, "key")
    marks = held.groupBy("doc_id", "rid").agg(F.collect_set("key").alias("keys"))
    marks = stored(marks.join(same, ["doc_id", "rid"], "left_anti"), "marks")
    bounded_batches(spark)
    sent = rows.join(marks, ["doc_id", "rid"]).select("doc_id", "rid", "keys", "text").mapInArrow(
        _send_windows(size), "key long, doc_id long, rid long, at array<int>, hashes array<long>, begin int, end int")
    sent = stored(sent, "windows")
    ordered = sent.where("key IS NOT NULL").select("key", "doc_id", "rid", "at", "hashes").repartition("key")
    settled = ordered.sortWithinPartitions("key", "doc_id").mapInArrow(_settle(size), "doc_id long, rid long, begin int, end int")
    cuts = settled.union(sent.where("key IS NULL").select("doc_id", "rid", "begin", "end"))
    cuts = cuts.groupBy("doc_id", "rid").agg(F.collect_list(F.struct("begin", "end")).alias("cuts"))
    cuts = cuts.withColumn("whole", F.lit(False)).select("doc_id", "rid", "whole", "cuts")
    none = F.lit(None).cast("array<struct<begin:int,end:int>>")
    return stored(cuts.union(same.select("doc_id", "rid", F.lit(True), none)), "cuts")


def kept_words(text: str | None, whole: bool | None, cuts: list | None, size: int) -> tuple[int, list[bytes]]:
    """Number of words of a text, and the words that stay."""
    parts = (text or "").encode("utf-8", "surrogatepass").split()
    if whole and len(parts) >= size:
        return len(parts), []
    if not cuts:
        return len(parts), parts
    out, at = [], 0
    for cut in sorted((c["begin"], c["end"]) for c in cuts):
        out += parts[at : max(at, cut[0])]
        at = max(at, cut[1])
    return len(parts), out + parts[at:]


def _with_cuts(docs: DataFrame, size: int, text: str) -> DataFrame:
    cuts = stretches(docs, size, text).select(F.col("doc_id").alias("__id"), F.col("rid").alias("__rid"), "whole", "cuts")
    rows = _present(docs, text)
    return rows.join(cuts, (F.col("doc_id") == F.col("__id")) & (F.col("rid") == F.col("__rid")), "left").select(
        "doc_id", "whole", "cuts", "text")


def digest(docs: DataFrame, size: int = WINDOW, text: str = "text") -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256) of each row of ``docs``."""

    def run(batches):
        for batch in batches:
            ids, whole, cuts, texts = (batch.column(k) for k in range(4))
            made = [kept_words(*row, size) for row in zip(texts.to_pylist(), whole.to_pylist(), cuts.to_pylist())]
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array([n for n, _ in made], pa.int64()), pa.array([n - len(kept) for n, kept in made], pa.int64()),
                 pa.array([sha256(b" ".join(kept)).hexdigest() for _, kept in made])],
                ["doc_id", "n_words", "n_removed", "kept_sha256"])

    return _with_cuts(docs, size, text).mapInArrow(run, "doc_id long, n_words long, n_removed long, kept_sha256 string")


def remove_repeats(docs: DataFrame, size: int = WINDOW, text: str = "text") -> DataFrame:
    """(doc_id, text) with the repeated words taken out; the words that stay are joined by one space."""

    def run(batches):
        for batch in batches:
            ids, whole, cuts, texts = (batch.column(k) for k in range(4))
            made = [kept_words(*row, size)[1] for row in zip(texts.to_pylist(), whole.to_pylist(), cuts.to_pylist())]
            yield pa.RecordBatch.from_arrays([ids, pa.array([b" ".join(kept).decode() for kept in made])], ["doc_id", "text"])

    return _with_cuts(docs, size, text).mapInArrow(run, "doc_id long, text string")
