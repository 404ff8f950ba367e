"""Benchmark decontamination by a distributed positional inverted index.

The words of the training texts that some test item uses are stored as postings: for
each document the term ids and places, as two packed arrays. The index is partitioned by
document, as search engines do it: each task holds the whole lists of its own documents,
and no list of a frequent word is ever gathered in one place. A test phrase is looked up
from its rarest term (by its count in the whole index): the places of that term, shifted
by its offset in the phrase, are intersected with the shifted lists of the next rarer
terms until all are used or no place is left.

A test set is worked off in blocks of at most ``BLOCK_BYTES`` of text; only the terms and
phrases of one block are sent to the tasks, whatever the size of the test set.

Words: A to Z in lower case, then runs of digits, letters and non-ASCII characters. An
item's phrases are its windows of ``WINDOW`` words, or all its words if it has fewer. NULL
and empty texts have no words; items without words match nothing; rows with a NULL id
are searched like others; repeated rows give repeated rows. Memory is bounded by a
slice of postings or the longest single text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyline.llm.tables import stored
from tallyline.llm.texts import bounded_batches, emit_from_text, map_text, utf8, word_hashes, word_table, words

WINDOW = 10
BLOCK_BYTES = 16 << 20
#: Bytes that end a word; the others are digits, letters and what is not ASCII.
WORD_BYTE = word_table(bytes([*range(0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
#: A posting's key is term * SPAN + place.
SPAN = 1 << 32


def hashed_words(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The hash of every word and the index of its text."""
    data, offsets = utf8(texts)
    data = LOWER[data]
    starts, ends, doc = words(data, offsets, WORD_BYTE)
    return word_hashes(data, starts, ends), doc


@dataclass
class Phrases:
    """The phrases of a block of items: term ids by offset (-1 beyond the end), and whose they are."""

    vocabulary: np.ndarray
    terms: np.ndarray
    owner: np.ndarray       # phrase index of each (phrase, item)
    items: np.ndarray       # item index of the same
    names: list             # item ids

    @classmethod
    def of(cls, items: list[tuple], size: int = WINDOW) -> Phrases:
        hashes, doc = hashed_words(pa.array([text for _, text in items], pa.string()))
        vocabulary, terms = np.unique(hashes, return_inverse=True)
        rows, owners = [], []
        for k in range(len(items)):
            own = terms[doc == k] if len(items) < 64 else terms[np.searchsorted(doc, k) : np.searchsorted(doc, k + 1)]
            if not len(own):
                continue
            width = min(size, len(own))
            some = np.full((len(own) - width + 1, size), -1, np.int64)
            some[:, :width] = np.lib.stride_tricks.sliding_window_view(own, width)
            rows.append(some)
            owners.append(np.full(len(some), k))
        if not rows:
            return cls(vocabulary, np.zeros((0, size), np.int64), np.zeros(0, np.int64), np.zeros(0, np.int64), [i for i, _ in items])
        unique, back = np.unique(np.concatenate(rows), axis=0, return_inverse=True)
        pairs = np.unique(np.stack([back.ravel(), np.concatenate(owners)]), axis=1)
        return cls(vocabulary, unique, pairs[0], pairs[1], [i for i, _ in items])

    def rarest_first(self, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(terms, offsets) of each phrase by rising count; -1 at the end of short phrases."""
        weight = np.where(self.terms >= 0, counts[self.terms], np.iinfo(np.int64).max)
        order = np.argsort(weight, axis=1, kind="stable")
        return np.take_along_axis(self.terms, order, axis=1), np.where(np.take_along_axis(self.terms, order, axis=1) >= 0, order, -1)


def packer(known: np.ndarray):
    """A function from texts to the packed terms and places of each, and its number of words."""
    maybe = np.zeros(1 << 20, bool)
    maybe[(known & np.uint64(0xFFFFF)).astype(np.int64)] = True

    def pack(texts: pa.Array) -> tuple[list[bytes], list[bytes], np.ndarray]:
        hashes, doc = hashed_words(texts)
        counts = np.bincount(doc, minlength=len(texts))
        stops = np.cumsum(counts)
        at = np.flatnonzero(maybe[(hashes & np.uint64(0xFFFFF)).astype(np.int64)])
        term = np.searchsorted(known, hashes[at])
        hit = term < len(known)
        hit[hit] = known[term[hit]] == hashes[at[hit]]
        at, term = at[hit], term[hit].astype("<u4")
        place = (at - (stops - counts)[doc[at]]).astype("<u4")
        cuts = np.searchsorted(at, stops).tolist()
        bounds = list(zip([0, *cuts[:-1]], cuts)) if cuts else []
        return [term[a:b].tobytes() for a, b in bounds], [place[a:b].tobytes() for a, b in bounds], counts

    return pack


def postings(docs: DataFrame, vocabulary: np.ndarray, text: str = "text") -> DataFrame:
    """The index: (doc_id, rid, n_words, terms, places) of each row; the last two are packed 32-bit numbers."""
    shared = docs.sparkSession.sparkContext.broadcast(vocabulary)

    def make():
        pack = packer(shared.value)

        def work(texts, ids, rids):
            terms, places, counts = pack(texts)
            return {"doc_id": ids, "rid": rids, "n_words": counts, "terms": terms, "places": places}

        return work

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("doc_id", text).alias("rid"), F.col(text).alias("text"))
    return emit_from_text(rows, make, "doc_id long, rid long, n_words long, terms binary, places binary", ["doc_id", "rid"])


def term_counts(index: DataFrame, size: int) -> np.ndarray:
    """How often each of ``size`` terms occurs in the whole index; summed by tasks, then by term."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(size, np.int64)
        for batch in batches:
            for packed in batch.column(0).to_pylist():
                if packed:
                    total += np.bincount(np.frombuffer(packed, "<u4"), minlength=size)
        some = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(total[some])], ["term", "n"])

    out = np.zeros(size, np.int64)
    summed = index.select("terms").mapInArrow(run, "term long, n long").groupBy("term").agg(F.sum("n").alias("n")).toArrow()
    out[summed.column(0).to_numpy()] = summed.column(1).to_numpy()
    return out


class Lists:
    """The postings of some documents as one sorted array of (term, place); documents stand apart by ``gap``."""

    def __init__(self, terms: list, places: list, sizes: np.ndarray, gap: int):
        self.begins = np.concatenate([[0], np.cumsum(sizes + gap)]).astype(np.int64)
        term = np.frombuffer(b"".join(terms), "<u4").astype(np.int64)
        place = np.frombuffer(b"".join(places), "<u4").astype(np.int64)
        place += np.repeat(self.begins[:-1], [len(packed) // 4 for packed in terms])
        self.keys = np.sort(term * SPAN + place)

    def has(self, term: np.ndarray, place: np.ndarray) -> np.ndarray:
        at = np.searchsorted(self.keys, term * SPAN + place)
        inside = at < len(self.keys)
        inside[inside] = self.keys[at[inside]] == (term * SPAN + place)[inside]
        return inside & (place >= 0)

    def phrases(self, terms: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(phrase, first place) of every exact occurrence."""
        first = terms[:, 0]
        low = np.searchsorted(self.keys, first * SPAN)
        count = np.searchsorted(self.keys, (first + 1) * SPAN) - low
        which = np.repeat(np.arange(len(terms)), count)
        at = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + low[which]
        start = self.keys[at] % SPAN - offsets[which, 0]
        keep = start >= 0
        which, start = which[keep], start[keep]
        for k in range(1, terms.shape[1]):
            need = terms[which, k]
            keep = need < 0
            keep |= self.has(np.maximum(need, 0), start + offsets[which, k])
            which, start = which[keep], start[keep]
        return which, start

    def near(self, terms: np.ndarray, slop: int) -> tuple[np.ndarray, np.ndarray]:
        """(phrase, place of its rarest term) where every term stands within ``slop`` words of that place."""
        first = terms[:, 0]
        low = np.searchsorted(self.keys, first * SPAN)
        count = np.searchsorted(self.keys, (first + 1) * SPAN) - low
        which = np.repeat(np.arange(len(terms)), count)
        at = np.arange(len(which)) - np.repeat(np.cumsum(count) - count, count) + low[which]
        place = self.keys[at] % SPAN
        for k in range(1, terms.shape[1]):
            need = terms[which, k]
            wanted = np.maximum(need, 0) * SPAN
            after = np.searchsorted(self.keys, wanted + np.maximum(place - slop, 0))
            found = after < len(self.keys)
            found[found] = self.keys[after[found]] <= (wanted + place + slop)[found]
            keep = (need < 0) | found
            which, place = which[keep], place[keep]
        return which, place


def _runs(begin: np.ndarray, end: np.ndarray) -> list[dict]:
    """Stretches covered by [begin, end), sorted and joined."""
    order = np.argsort(begin, kind="stable")
    begin, end = begin[order], np.maximum.accumulate(end[order])
    new = np.flatnonzero(np.concatenate([[True], begin[1:] > end[:-1]]))
    return [{"begin": int(b), "end": int(e)} for b, e in zip(begin[new], end[np.append(new[1:], len(end)) - 1])]


def search(index: DataFrame, phrases: Phrases, counts: np.ndarray, slop: int | None = None) -> DataFrame:
    """(doc_id, rid, items, runs) of each document of the index with matches.

    Exact phrases, with the stretches of words they cover; or, given ``slop``, places
    where all terms of a phrase stand within so many words of its rarest.
    """
    terms, offsets = phrases.rarest_first(counts)
    alive = np.all((terms < 0) | (counts[terms] > 0), axis=1) if len(terms) else np.zeros(0, bool)
    kept = np.flatnonzero(alive)
    number = np.full(len(terms), -1)
    number[kept] = np.arange(len(kept))
    of = np.isin(phrases.owner, kept)
    sort = np.argsort(number[phrases.owner[of]], kind="stable")
    shared = index.sparkSession.sparkContext.broadcast(
        (terms[kept], offsets[kept], number[phrases.owner[of]][sort], phrases.items[of][sort], [str(n) for n in phrases.names]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        terms, offsets, owner, items, names = shared.value
        width = (terms >= 0).sum(axis=1)
        gap = terms.shape[1] + (slop or 0)
        for batch in batches:
            ids, rids = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            lists = Lists(batch.column(3).to_pylist(), batch.column(4).to_pylist(), batch.column(2).to_numpy(), gap)
            if slop is None:
                which, start = lists.phrases(terms, offsets)
                end = start + width[which]
            else:
                which, start = lists.near(terms, slop)
                end = start + 1
            doc = np.searchsorted(lists.begins, start, side="right") - 1
            order = np.argsort(doc, kind="stable")
            which, start, end, doc = which[order], start[order], end[order], doc[order]
            rows = {"doc_id": [], "rid": [], "items": [], "runs": []}
            for d, a, b in zip(*[x.tolist() for x in np.unique(doc, return_index=True)], [*np.unique(doc, return_index=True)[1][1:].tolist(), len(doc)]):
                own = np.unique(which[a:b])
                some = [items[x:y] for x, y in zip(np.searchsorted(owner, own), np.searchsorted(owner, own, side="right"))]
                rows["doc_id"].append(ids[d])
                rows["rid"].append(rids[d])
                rows["items"].append([names[i] for i in np.unique(np.concatenate(some))])
                rows["runs"].append(_runs(start[a:b] - lists.begins[d], end[a:b] - lists.begins[d]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(rows["doc_id"], pa.int64()), pa.array(rows["rid"], pa.int64()), pa.array(rows["items"], pa.list_(pa.string())),
                 pa.array(rows["runs"], pa.list_(pa.struct([("begin", pa.int32()), ("end", pa.int32())])))], list(rows))

    bounded_batches(index.sparkSession)
    return index.mapInArrow(run, "doc_id long, rid long, items array<string>, runs array<struct<begin:int,end:int>>")


def blocks(items: DataFrame, key: str = "item_id", text: str = "text", block_bytes: int = BLOCK_BYTES) -> Iterator[list[tuple]]:
    """The items in blocks of about ``block_bytes`` of text; one empty block if there are none."""
    total = items.agg(F.sum(F.octet_length(text))).head()[0] or 0
    parts = max(1, -(-total // block_bytes))
    rows = items.where(f"`{text}` IS NOT NULL").select(F.col(key).cast("string").alias("k"), F.col(text).alias("t")).distinct()
    for part in range(parts):
        yield [(row.k, row.t) for row in rows.where(F.pmod(F.xxhash64("k", "t"), F.lit(parts)) == part).collect()]


def matches(docs: DataFrame, items: DataFrame, size: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, n_words, n_hit, items) of each row of ``docs`` (doc_id, text) against ``items`` (item_id, text)."""
    found, first = None, None
    for block in blocks(items, block_bytes=block_bytes):
        phrases = Phrases.of(block, size)
        index = stored(postings(docs, phrases.vocabulary), "postings")
        first = index if first is None else first
        some = search(index, phrases, term_counts(index, len(phrases.vocabulary)))
        found = some if found is None else found.union(some)
    # A stretch that continues one seen before adds only what is new.
    joined = F.aggregate(
        F.array_sort(F.flatten(F.collect_list("runs"))), F.struct(F.lit(0).alias("n"), F.lit(0).alias("to")),
        lambda acc, run: F.struct(
            (acc["n"] + F.greatest(F.lit(0), run["end"] - F.greatest(acc["to"], run["begin"]))).alias("n"),
            F.greatest(acc["to"], run["end"]).alias("to")),
        lambda acc: acc["n"])
    hits = found.groupBy(F.col("doc_id").alias("__id"), F.col("rid").alias("__rid")).agg(
        joined.cast("long").alias("n_hit"),
        F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"))
    hits = stored(hits, "hits")
    rows = first.select("doc_id", "rid", "n_words").join(
        hits, (F.col("rid") == F.col("__rid")) & F.col("doc_id").eqNullSafe(F.col("__id")), "left")
    return rows.select("doc_id", "rid", "n_words", F.coalesce("n_hit", F.lit(0).cast("long")).alias("n_hit"),
                       F.coalesce("items", F.array().cast("array<string>")).alias("items"))


def digest(docs: DataFrame, items: DataFrame, size: int = WINDOW) -> DataFrame:
    """(doc_id, n_words, n_hit, n_items, items_sha256, contaminated) of each row of ``docs``."""
    return matches(docs, items, size).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ",").cast("binary"), 256).alias("items_sha256"), (F.col("n_hit") > 0).alias("contaminated"))


def clean_documents(docs: DataFrame, items: DataFrame, size: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` without the rows that share a phrase with an item.

    The stored index gives the counts that order the terms; the lists of a slice are then
    searched beside its rows, so no text is shuffled.
    """
    columns = [f"`{c}`" for c in docs.columns]
    for block in blocks(items, block_bytes=block_bytes):
        phrases = Phrases.of(block, size)
        counts = term_counts(stored(postings(docs, phrases.vocabulary), "postings"), len(phrases.vocabulary))
        terms, offsets = phrases.rarest_first(counts)
        alive = np.all((terms < 0) | (counts[terms] > 0), axis=1) if len(terms) else np.zeros(0, bool)
        shared = docs.sparkSession.sparkContext.broadcast((phrases.vocabulary, terms[alive], offsets[alive]))

        def make(shared=shared):
            known, terms, offsets = shared.value
            pack = packer(known)

            def work(texts):
                packed, places, sizes = pack(texts)
                lists = Lists(packed, places, sizes, terms.shape[1])
                hit = np.zeros(len(texts), bool)
                hit[np.searchsorted(lists.begins, lists.phrases(terms, offsets)[1], side="right") - 1] = True
                return [hit]

            return work

        docs = map_text(docs, make, "`__hit` boolean").where("NOT __hit").select(*columns)
    return docs
