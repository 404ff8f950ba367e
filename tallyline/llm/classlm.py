"""Scores of texts under a Brown class-based bigram model.

Tokens are words, A to Z in lower case, and one end after each text. The chance of a
token is the chance of its class after the class before it, times the chance of the token
in its class; both are smoothed by one half.

Every word that training texts repeat has a class of its own. Classes start from exchange
clustering over ``FREQUENT`` most frequent tokens and ``GROUPS`` groups of all other words,
formed by their last bytes and length. Then rounds on Spark go over all repeated words: the
classes of each word's neighbours are counted over all training texts, each word takes the
class under which these are most likely, and the class sums are taken anew. Rounds end when
no word moves, when the log likelihood rises by less than ``LEAST_GAIN`` a token, or after
``EXCHANGES``; the most likely classes are kept. Only words seen once or never keep the
class of their group. The class of a token stands beside its count.

The counts of all training tokens stay distributed. Texts are dealt into blocks of about
``BLOCK_BYTES``; each block asks once for each of its different tokens, the counts are
joined to these requests, and the answers come back to the block. What moves for a block
is bounded by the block, and a frequent word is asked for once per block. In the rounds the
words of a block move together, one row for each bucket of hashes.

NULL and empty texts are an end alone. Rows with a NULL id are scored, but nothing is
learned from them. With no training text every count is 0. Repeated rows and extra
columns change nothing; equal counts are ordered by token. Memory is bounded by a block
or the longest text.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, replace
from functools import cached_property

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.tables import let_go, place, stored, stored_sum
from tallyline.llm.texts import bounded_batches, emit_from_text, mix, slices, utf8, word_hashes, words

FREQUENT, GROUPS, CLASSES, EXCHANGES = 512, 128, 40, 8
BLOCK_BYTES = 24 << 20
#: The same for the blocks of training text that the rounds read.
ROUND_BYTES = 12 << 20
#: Rounds go on while the log likelihood rises by so much a token.
LEAST_GAIN = 1e-3
#: Words whose neighbours are counted together.
TALLIED = 1 << 16
#: Repeated words of one bucket, of which there are so many that each holds about as many.
BUCKET_WORDS = 1 << 13
HELD_TOKENS = 1 << 20
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
#: A token is the upper 57 bits of its word's hash and 7 bits of its group.
END = np.uint64(1 << 7)
GROUP = np.uint64(GROUPS - 1)


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All tokens of the texts in order, and the number of each text's."""
    data, offsets = utf8(texts)
    data = LOWER[data]
    starts, ends, doc = words(data, offsets)
    hashes = word_hashes(data, starts, ends)
    size = ends - starts
    last = data[ends - 1].astype(np.uint64) if len(data) else np.zeros(0, np.uint64)
    before = np.where(size > 1, data[np.maximum(ends - 2, 0)], 0).astype(np.uint64) if len(data) else last
    group = mix(last << np.uint64(16) | before << np.uint64(8) | np.minimum(size // 4, 2).astype(np.uint64)) & GROUP
    counts = np.bincount(doc, minlength=len(texts)) + 1
    out = np.full(int(counts.sum()), END, np.uint64)
    out[np.arange(len(doc)) + doc] = hashes & ~GROUP | group
    return out, counts


def _merge(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    token = np.concatenate([p[0] for p in parts])
    unique, back = np.unique(token, return_inverse=True)
    return unique, np.bincount(back, np.concatenate([p[1] for p in parts]), len(unique)).astype(np.int64)


def token_counts(docs: DataFrame, text: str = "text") -> DataFrame:
    """(token, n) over all texts, summed within a task before it is shuffled."""

    def make():
        held: list[tuple] = []

        def give(parts):
            token, n = _merge(parts)
            return {"token": token.view(np.int64), "n": n}

        def work(texts):
            token, n = np.unique(tokens(texts)[0], return_counts=True)
            held.append((token, n))
            if len(held) > 8:
                held[:] = [_merge(held)]
                if len(held[0][0]) > HELD_TOKENS:
                    return give([held.pop()])
            return None

        def finish():
            if held:
                yield give(held)

        work.finish = finish
        return work

    return emit_from_text(docs, make, "token long, n long", [], text).groupBy("token").agg(F.sum("n").alias("n"))


def items(token: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """The item of each token: its place among the frequent ones, or its group beyond them."""
    if not len(frequent):
        return (token & GROUP).astype(np.int64)
    at = np.minimum(np.searchsorted(frequent, token), len(frequent) - 1)
    return np.where(frequent[at] == token, at, len(frequent) + (token & GROUP).astype(np.int64))


def pair_counts(docs: DataFrame, frequent: np.ndarray, text: str = "text") -> np.ndarray:
    """How often one item follows another; a text begins after an end. At most 640 squared sums reach the driver."""
    size = len(frequent) + GROUPS
    first = items(np.array([END]), frequent)[0]

    def make():
        total = np.zeros(size * size, np.int64)

        def work(texts):
            token, counts = tokens(texts)
            now = items(token, frequent)
            before = np.empty_like(now)
            before[1:] = now[:-1]
            before[np.cumsum(counts) - counts] = first
            np.add(total, np.bincount(before * size + now, minlength=size * size), out=total)
            return None

        def finish():
            some = np.flatnonzero(total)
            yield {"pair": some, "n": total[some]}

        work.finish = finish
        return work

    summed = emit_from_text(docs, make, "pair long, n long", [], text).groupBy("pair").agg(F.sum("n").alias("n")).toArrow()
    out = np.zeros(size * size, np.int64)
    out[summed.column(0).to_numpy()] = summed.column(1).to_numpy()
    return out.reshape(size, size)


def _weigh(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1e-300))


def exchange(pairs: np.ndarray, classes: int = CLASSES, rounds: int = EXCHANGES) -> np.ndarray:
    """The class of each item: items move, the most frequent first, to where the likelihood of the pairs is largest."""
    weight = pairs.sum(axis=0) + pairs.sum(axis=1)
    order = np.argsort(-weight, kind="stable")
    of = np.zeros(len(pairs), np.int64)
    of[order] = np.arange(len(order)) % classes
    pairs = pairs.astype(float)
    member = np.eye(classes)[of]
    between = member.T @ pairs @ member
    every = np.arange(classes)
    for _ in range(rounds):
        moved = 0
        for item in order:
            if not weight[item]:
                continue
            old = of[item]
            out = np.bincount(of, pairs[item], classes)
            in_ = np.bincount(of, pairs[:, item], classes)
            own = pairs[item, item]
            out[old] -= own
            in_[old] -= own
            between[old] -= out
            between[:, old] -= in_
            between[old, old] -= own
            base = _weigh(between)
            row = _weigh(between + out) - base                  # [class, other]: the item's successors
            column = _weigh(between + in_[:, None]) - base      # [other, class]
            both = between[every, every] + out + in_ + own
            gain = row.sum(axis=1) + column.sum(axis=0) - row[every, every] - column[every, every] + _weigh(both) - base[every, every]
            before, after = between.sum(axis=1), between.sum(axis=0)
            gain -= _weigh(before + out.sum() + own) - _weigh(before)
            gain -= _weigh(after + in_.sum() + own) - _weigh(after)
            new = int(gain.argmax()) if gain.max() > gain[old] + 1e-9 else old
            between[new] += out
            between[:, new] += in_
            between[new, new] += own
            of[item] = new
            moved += new != old
        if not moved:
            break
    return of


@dataclass
class Model:
    group_of: np.ndarray       # class of each group, for words seen once or never
    step: np.ndarray           # log10 chance of a class after another
    inside: np.ndarray         # log10 of what a class's token chances are divided by
    total: int
    different: int
    table: DataFrame           # (token, n, class) of all training tokens

    @cached_property
    def frequent(self) -> np.ndarray:
        """The repeated tokens, sorted; gathers them, so for small vocabularies only."""
        return self._repeated[0]

    @cached_property
    def of(self) -> np.ndarray:
        """The class of each repeated token and of each group; gathers them as ``frequent`` does."""
        return np.concatenate([self._repeated[1], self.group_of])

    @cached_property
    def _repeated(self) -> tuple[np.ndarray, np.ndarray]:
        rows = self.table.where("n > 1").select("token", "class").toArrow()
        token = rows.column(0).to_numpy().view(np.uint64)
        order = np.argsort(token)
        return token[order], rows.column(1).to_numpy()[order].astype(np.int64)

    def score(self, token: np.ndarray, counts: np.ndarray, known: np.ndarray, now: np.ndarray, end: int) -> tuple[np.ndarray, ...]:
        """(tokens, known tokens, base score, score) of each text, given the training count and class of each token and the class of an end."""
        begin = np.cumsum(counts) - counts
        before = np.empty_like(now)
        before[1:] = now[:-1]
        before[begin] = end
        seen = np.log10(known + 0.5)
        base = seen - np.log10(self.total + 0.5 * (self.different + 1))
        best = seen - self.inside[now] + self.step[before, now]
        return counts, np.add.reduceat((known > 0).astype(np.int64), begin), np.add.reduceat(base, begin), np.add.reduceat(best, begin)


def _blocks(docs: DataFrame, text: str, block_bytes: int) -> DataFrame:
    """(doc_id, text, block) of each row, dealt into blocks of about so many bytes."""
    size = docs.agg(F.sum(F.octet_length(text)).alias("n")).head().n or 0
    blocks = max(1, -(-size // block_bytes))
    dealt = docs.select(F.col("doc_id"), F.col(text).alias("text"), F.pmod(F.xxhash64("doc_id", text), F.lit(blocks)).cast("int").alias("block"))
    return dealt.repartition(blocks, "block")


def buckets(token: np.ndarray, bits: int) -> np.ndarray:
    """The bucket of each token: its first bits."""
    return (token >> np.uint64(64 - bits)).astype(np.int32) if bits else np.zeros(len(token), np.int32)


def _runs(values: np.ndarray) -> np.ndarray:
    """Where the runs of equal values end."""
    return np.flatnonzero(np.concatenate([values[1:] != values[:-1], [True]])) + 1 if len(values) else np.zeros(0, np.int64)


def _binary(values: np.ndarray, ends: np.ndarray) -> pa.Array:
    """The values as one binary for each end."""
    offsets = np.concatenate([[0], ends]).astype(np.int32) * np.int32(values.itemsize)
    return pa.Array.from_buffers(pa.binary(), len(ends), [None, pa.py_buffer(offsets), pa.py_buffer(values)])


def _values(column: pa.ChunkedArray, kind: type) -> np.ndarray:
    """The values of all binaries in order."""
    return np.frombuffer(b"".join(column.to_pylist()), kind)


def sequences(docs: DataFrame, bits: int = 0, text: str = "text", block_bytes: int = ROUND_BYTES) -> DataFrame:
    """(block, ids, bucket, token): each block's different tokens, sorted, a row for each bucket, and its texts as their places in that order, in parts."""
    bounded_batches(docs.sparkSession)

    def encode(texts: pa.Table) -> pa.Table:
        runs = [tokens(part.column(0))[0] for batch in texts.select(["text"]).combine_chunks().to_batches() for part in slices(batch, 0)]
        different = np.unique(np.concatenate([np.unique(run) for run in runs]))
        block = texts.column("block")[0].as_py()
        ids = pa.array([np.searchsorted(different, run).astype(np.int32).tobytes() for run in runs], pa.binary())
        own = buckets(different, bits)
        ends = _runs(own)
        schema = pa.schema([("block", pa.int32()), ("ids", pa.binary()), ("bucket", pa.int32()), ("token", pa.binary())])
        count, size = len(ids), len(ends)
        return pa.concat_tables([
            pa.table([pa.array([block] * count, pa.int32()), ids, pa.nulls(count, pa.int32()), pa.nulls(count, pa.binary())], schema=schema),
            pa.table([pa.array([block] * size, pa.int32()), pa.nulls(size, pa.binary()), pa.array(own[ends - 1]), _binary(different, ends)], schema=schema)])

    dealt = _blocks(docs, text, block_bytes).select("text", "block")
    return dealt.groupBy("block").applyInArrow(encode, "block int, ids binary, bucket int, token binary")


#: Added to the class of a repeated word.
REPEATED = 128


def answers(runs: DataFrame, table: DataFrame, bits: int) -> DataFrame:
    """(of, at, known): the classes of the tokens of each block and bucket, a byte each."""

    def look(asked: pa.Table, rows: pa.Table) -> pa.Table:
        token = rows.column("token").to_numpy().view(np.uint64)
        order = np.argsort(token)
        token = token[order]
        kind = (rows.column("class").to_numpy() + REPEATED * (rows.column("n").to_numpy() > 1)).astype(np.uint8)[order]
        known = [kind[np.searchsorted(token, np.frombuffer(mine.as_buffer(), np.uint64))].tobytes() for mine in asked.column("token")]
        return pa.table({"of": asked.column("block"), "at": asked.column("bucket"), "known": pa.array(known, pa.binary())})

    place = F.shiftrightunsigned("token", 64 - bits).cast("int") if bits else F.lit(0)
    asked = runs.where("token IS NOT NULL").select("block", "bucket", "token")
    words_ = table.select(place.alias("place"), "token", "n", "class")
    return asked.groupBy("bucket").cogroup(words_.groupBy("place")).applyInArrow(look, "of int, at int, known binary")


def tallies(runs: DataFrame, table: DataFrame, bits: int = 0) -> DataFrame:
    """How often each class follows (codes from 0) and precedes (from ``CLASSES``) each repeated word, a row for each block and bucket.

    A row holds its words, their classes, how many codes each has, the codes and how often
    they are. Rows with a NULL bucket hold how often one class follows another (``cells`` alone).
    """
    none = pa.schema([("bucket", pa.int32()), *((name, pa.binary()) for name in ("token", "class", "sizes", "codes", "cells"))])

    def tally(parts: pa.Table, found: pa.Table) -> pa.Table:
        ids = parts.column("ids").drop_null()
        if not len(ids):
            return none.empty_table()
        mine = parts.filter(pc.is_valid(parts.column("token"))).sort_by("bucket")
        token = _values(mine.column("token"), np.uint64)
        kind = _values(found.sort_by("at").column("known"), np.uint8)
        of, repeated = kind.astype(np.int64) % REPEATED, np.flatnonzero(kind >= REPEATED)
        end = np.searchsorted(token, END)
        place = np.full(len(token), -1, np.int64)
        place[repeated] = np.arange(len(repeated))
        between = np.zeros(CLASSES * CLASSES, np.int64)
        keys = []
        for run in ids:
            now = np.frombuffer(run.as_buffer(), np.int32)
            before = np.empty_like(now)
            before[1:] = now[:-1]
            before[:1] = end
            between += np.bincount(of[before] * CLASSES + of[now], minlength=len(between))
            for word, code in ((before, of[now]), (now, of[before] + CLASSES)):
                key = place[word] * (2 * CLASSES) + code
                keys.append(key[place[word] >= 0])
        keys = np.concatenate(keys)
        made = [pa.table([pa.nulls(1, pa.int32()), *(pa.nulls(1, pa.binary()) for _ in range(4)), pa.array([between.tobytes()])], schema=none)]
        for first in range(0, len(repeated), TALLIED):
            mine = repeated[first : first + TALLIED]
            low, high = first * 2 * CLASSES, (first + len(mine)) * 2 * CLASSES
            total = np.bincount(keys[(keys >= low) & (keys < high)] - low, minlength=high - low)
            some = np.flatnonzero(total)
            after = np.searchsorted(some, (np.arange(len(mine)) + 1) * 2 * CLASSES)
            own = buckets(token[mine], bits)
            ends = _runs(own)
            made.append(pa.table([
                pa.array(own[ends - 1]), _binary(token[mine], ends), _binary(of[mine].astype(np.uint8), ends),
                _binary(np.diff(after, prepend=0).astype(np.uint8), ends),
                _binary((some % (2 * CLASSES)).astype(np.uint8), after[ends - 1]), _binary(total[some].astype(np.int32), after[ends - 1])], schema=none))
        return pa.concat_tables(made)

    fields = "bucket int, token binary, class binary, sizes binary, codes binary, cells binary"
    return runs.groupBy("block").cogroup(answers(runs, table, bits).groupBy("of")).applyInArrow(tally, fields)


def best_classes(follow: np.ndarray, precede: np.ndarray, old: np.ndarray, between: np.ndarray) -> np.ndarray:
    """The class of each word under which the classes beside it are most likely, its old one unless another is better."""
    step = np.log((between + 0.5) / (between.sum(axis=1, keepdims=True) + 0.5 * CLASSES))
    size = np.log(between.sum(axis=0) + 0.5)
    gain = follow @ step.T + precede @ step - precede.sum(axis=1, keepdims=True) * size
    every = np.arange(len(old))
    new = gain.argmax(axis=1)
    return np.where(gain[every, new] > gain[every, old] + 1e-6, new, old)


def moves(tallied: DataFrame, between: np.ndarray) -> DataFrame:
    """(token, to) of each repeated word that another class suits better."""

    def choose(rows: pa.Table) -> pa.Table:
        token, first, word = np.unique(_values(rows.column("token"), np.uint64), return_index=True, return_inverse=True)
        old = _values(rows.column("class"), np.uint8)[first].astype(np.int64)
        sizes, codes, cells = (_values(rows.column(name), kind) for name, kind in (("sizes", np.uint8), ("codes", np.uint8), ("cells", np.int32)))
        sums = np.bincount(np.repeat(word, sizes) * (2 * CLASSES) + codes, cells, len(token) * 2 * CLASSES).reshape(-1, 2 * CLASSES)
        new = best_classes(sums[:, :CLASSES], sums[:, CLASSES:], old, between)
        moved = new != old
        return pa.table({"token": pa.array(token[moved].view(np.int64)), "to": pa.array(new[moved].astype(np.int32))})

    return tallied.where("bucket IS NOT NULL").groupBy("bucket").applyInArrow(choose, "token long, to int")


def likelihood(between: np.ndarray) -> float:
    """Log likelihood of the training tokens under their class pairs, but for what no class changes."""
    return float(_weigh(between).sum() - _weigh(between.sum(axis=1)).sum() - _weigh(between.sum(axis=0)).sum())


def settle(docs: DataFrame, table: DataFrame, rounds: int = EXCHANGES, text: str = "text",
           block_bytes: int = ROUND_BYTES) -> tuple[DataFrame, np.ndarray]:
    """(table (token, n, class) after the rounds, how often one class follows another under it).

    What a round counts is stored in the place of the round before, and the shuffles behind it
    leave the disks before it is read; of the classes the last two tables are kept.
    """
    spark = docs.sparkSession
    counted, kept = place(spark, "tallies"), [place(spark, "classes"), place(spark, "classes")]
    words_, repeated = table.agg(F.sum("n"), F.count_if(F.col("n") > 1)).head()
    words_, bits = words_ or 0, max(0, -(-repeated // BUCKET_WORDS) - 1).bit_length()
    runs = stored(sequences(docs, bits, text, block_bytes), "sequences")
    let_go(docs.sparkSession)
    best = None
    for k in range(rounds + 1):
        tallied = stored(tallies(runs, table, bits), path=counted)
        let_go(spark)
        between = np.zeros((CLASSES, CLASSES))
        for batch in tallied.where("bucket IS NULL").select("cells").toLocalIterator():
            between += np.frombuffer(bytes(batch.cells), np.int64).reshape(CLASSES, CLASSES)
        reached = likelihood(between)
        gained = best is None or reached > best[0] + LEAST_GAIN * words_
        if best is None or reached > best[0]:
            best = reached, table, between
        if k < rounds and gained:
            moved = stored(moves(tallied, between), "moves")
            some = bool(moved.head(1))
            if some:
                table = stored(table.join(moved, "token", "left").select("token", "n", F.coalesce("to", "class").alias("class")), path=kept[k % 2])
        let_go(spark)
        if k == rounds or not gained or not some:
            return best[1], best[2]
    raise AssertionError


def learn(docs: DataFrame, text: str = "text") -> tuple[DataFrame, Model]:
    """(counts and classes of all tokens as a stored table, the model) from training texts."""
    counts, seen = stored_sum(token_counts(docs, text), "counts", total=F.sum("n"), different=F.count("*"))
    top = counts.orderBy(F.desc("n"), "token").limit(FREQUENT).toArrow()
    frequent = np.sort(top.column(0).to_numpy().view(np.uint64))
    of = exchange(pair_counts(docs, frequent, text))
    group_of = of[len(frequent) :]
    group = F.array(*map(F.lit, group_of.tolist()))[F.col("token").bitwiseAND(GROUPS - 1).cast("int")]
    first = counts.sparkSession.createDataFrame(list(zip(frequent.view(np.int64).tolist(), of.tolist())), "token long, first int")
    own = F.when(F.col("n") > 1, F.col("first"))
    table = counts.join(F.broadcast(first), "token", "left").select("token", "n", F.coalesce(own, group).cast("int").alias("class"))
    table, between = settle(docs, stored(table, "classes"), text=text)
    weight, different = np.zeros(CLASSES), np.zeros(CLASSES)
    for row in table.groupBy("class").agg(F.sum("n").alias("n"), F.count("*").alias("v")).collect():
        weight[row["class"]], different[row["class"]] = row.n, row.v
    inside = np.log10(weight + 0.5 * (different + 1))
    step = np.log10((between + 0.5) / (between.sum(axis=1, keepdims=True) + 0.5 * CLASSES))
    return table, Model(group_of, step, inside, seen["total"] or 0, seen["different"], table)


def score(docs: DataFrame, counts: DataFrame, model: Model, block_bytes: int = BLOCK_BYTES, text: str = "text") -> DataFrame:
    """(doc_id, n_tokens, n_known, base_score, score) of each row of ``docs``."""
    bounded_batches(docs.sparkSession)
    dealt = _blocks(docs, text, block_bytes)
    group_of, chances = model.group_of, replace(model, table=None)

    def ask(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, list[np.ndarray]] = {}
        for batch in batches:
            for part in slices(batch, 1):
                block = part.column(2).to_numpy()
                token, sizes = tokens(part.column(1))
                owner = np.repeat(block, sizes)
                for b in np.unique(block).tolist():
                    mine = held.setdefault(b, [])
                    mine.append(np.unique(token[owner == b]))
                    if len(mine) > 8:
                        mine[:] = [np.unique(np.concatenate(mine))]
        for b, mine in held.items():
            token = np.unique(np.concatenate(mine)).view(np.int64)
            for k in range(0, len(token), 1 << 16):
                some = token[k : k + (1 << 16)]
                yield pa.RecordBatch.from_arrays([pa.array(np.full(len(some), b, np.int32)), pa.array(some)], ["block", "token"])

    asked = dealt.mapInArrow(ask, "block int, token long")
    answers = asked.join(counts, "token").select("block", "token", "n", "class")

    def tell(texts: pa.Table, known: pa.Table) -> pa.Table:
        token = known.column("token").to_numpy().view(np.uint64)
        order = np.argsort(token)
        token, n, of = token[order], known.column("n").to_numpy()[order], known.column("class").to_numpy()[order]

        def look(mine: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            kind = group_of[(mine & GROUP).astype(np.int64)]
            if not len(token):
                return np.zeros(len(mine), np.int64), kind
            at = np.minimum(np.searchsorted(token, mine), len(token) - 1)
            same = token[at] == mine
            return np.where(same, n[at], 0), np.where(same, of[at], kind)

        end = int(look(np.array([END]))[1][0])
        made = []
        for batch in texts.combine_chunks().to_batches():
            for part in slices(batch, 1):
                mine, sizes = tokens(part.column(1))
                made.append(pa.RecordBatch.from_arrays(
                    [part.column(0), *map(pa.array, chances.score(mine, sizes, *look(mine), end))],
                    ["doc_id", "n_tokens", "n_known", "base_score", "score"]))
        return pa.Table.from_batches(made)

    kind = docs.schema["doc_id"].dataType.simpleString()
    return dealt.groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(
        lambda a, b: tell(a, b) if a.num_rows else pa.Table.from_pylist([], pa.schema(
            [("doc_id", a.schema.field("doc_id").type), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
             ("base_score", pa.float64()), ("score", pa.float64())])),
        f"doc_id {kind}, n_tokens long, n_known long, base_score double, score double")


def scores(docs: DataFrame, training: Column, text: str = "text") -> DataFrame:
    """``score`` of all rows after learning from the ``training`` ones, with train_tokens."""
    counts, model = learn(docs.where(training), text)
    return score(docs, counts, model, text=text).withColumn("train_tokens", F.lit(int(model.total)).cast("long"))
