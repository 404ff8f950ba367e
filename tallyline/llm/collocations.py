"""Collocations: frequent phrases of each language, scored by their weakest cut.

Texts are cut into pieces at ``[.,;:!?`` and line ends, pieces into words. Everything is
per language; a NULL language is ``und``.

1. Words are counted, within a task first. Those seen at least ``LEAST`` times get numbers,
   a number standing for a word of one language, and each text becomes the row of its
   numbers, with 0 for breaks and rarer words, which no frequent phrase can hold.
2. Candidates grow level by level. A phrase of k words can be frequent only if its first
   and its last k - 1 words are, so the frequent phrases of the level before form a
   double-array trie that is broadcast; all positions of a batch of texts walk it at once,
   one word a step, and where the walks from two neighbouring positions both end in a
   phrase, the phrase of both is a candidate. Candidates are taken from the text rather
   than by joining phrases with each other, which is quadratic around a common word; those
   that all tasks together meet less than ``LEAST`` times are left out.
3. All candidates form one more double-array trie. All positions walk it level by level,
   the phrases they end in are counted by ``bincount``, and the tasks' counts are summed
   as arrays.
4. Scores, containment and ranks are joins and aggregates over the counted phrases.

A trie holds at most ``TRIE_PHRASES``, a table of words at most ``TABLE_WORDS``; more are
spread over several by hash, each walked in a pass of its own over the numbered texts, so
what is broadcast stays bounded (for several tries only the first k - 1 words are asked
for in step 2, which leaves more candidates and the same results). A text stays in one row.

Words are found by 64-bit hashes; as many must be found as were counted, else another
hash is drawn. NULL and empty texts have no words. Repeated
rows count as often as they stand; equal scores and counts are ordered by phrase; extra
columns change nothing; an empty table gives no rows. Memory is bounded by a batch, the
longest text, a trie, or the different words or pairs held before they are sent.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyline.llm.tables import stored, stored_sum
from tallyline.llm.texts import bounded_batches, emit_from_text, mix, utf8, word_hashes, word_table, words

LEAST, LONGEST, SHARE, TOP = 100, 5, 100, 2000
UNKNOWN = "und"
#: Phrases in one trie, words in one table of numbers.
TRIE_PHRASES, TABLE_WORDS = 1 << 20, 1 << 21
#: Different words, and candidates met, that a task holds before it sends them.
HELD_WORDS, HELD_MET = 400_000, 1 << 20
#: Positions that walk a trie at once, and rows that a task sends at once.
WALKED, SENT = 1 << 18, 1 << 16
#: Phrases whose counts travel in one row, and tasks whose rows are added up together.
BLOCK, SUMMED = 4096, 64
BREAKS = b".,;:!?\x0a\x0b\x0c\x0d"
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
IN_WORD = word_table(b" \t" + BREAKS)
IS_BREAK = ~word_table(BREAKS)


# -- double-array tries -----------------------------------------------------------------------


class Trie:
    """A double-array trie over rows of word numbers.

    The child of a node by a word stands at ``base[node] + word`` if ``check`` there names
    the node. Words are the nodes of depth one, at their own numbers. ``phrase`` gives for a
    node the index of the phrase that ends there, or -1.
    """

    def __init__(self, phrases: np.ndarray, lengths: np.ndarray, words: int):
        """``phrases``: one row for each, filled with 0 beyond its length; numbers run from 1 to ``words``."""
        self.words = words
        self.used = np.zeros(2 * words + 2, bool)
        self.used[: words + 1] = True
        self.base = np.zeros(len(self.used), np.int64)
        self.check = np.zeros(len(self.used), np.int64)
        self.check[1 : words + 1] = -1
        self.phrase = np.full(len(self.used), -1, np.int32)
        self.top = words
        self.begin: dict[int, int] = {}
        node = phrases[:, 0].astype(np.int64) if len(phrases) else np.zeros(0, np.int64)
        rows = np.arange(len(phrases))
        for depth in range(1, phrases.shape[1] + 1 if len(phrases) else 1):
            ends = lengths[rows] == depth
            self.phrase[node[ends]] = rows[ends]
            if depth == phrases.shape[1]:
                break
            node, rows = node[~ends], rows[~ends]
            word = phrases[rows, depth].astype(np.int64)
            edges, back = np.unique(node * (words + 1) + word, return_inverse=True)
            node = self._grow(edges // (words + 1), edges % (words + 1))[back]
        size = self.top + words + 2
        self._fit(size)
        self.base, self.check, self.phrase = self.base[:size].astype(np.int32), self.check[:size].astype(np.int32), self.phrase[:size]
        del self.used, self.begin

    def _fit(self, size: int) -> None:
        if size > len(self.used):
            more = max(size, 2 * len(self.used)) - len(self.used)
            self.used = np.concatenate([self.used, np.zeros(more, bool)])
            self.base = np.concatenate([self.base, np.zeros(more, np.int64)])
            self.check = np.concatenate([self.check, np.zeros(more, np.int64)])
            self.phrase = np.concatenate([self.phrase, np.full(more, -1, np.int32)])

    def _grow(self, parent: np.ndarray, word: np.ndarray) -> np.ndarray:
        """Places the children (sorted by parent, then word); the node of each."""
        out = np.zeros(len(parent), np.int64)
        starts = np.flatnonzero(np.concatenate([[True], parent[1:] != parent[:-1]])) if len(parent) else np.zeros(0, np.int64)
        sizes = np.diff(np.concatenate([starts, [len(parent)]]))
        for k in np.argsort(-sizes, kind="stable")[: np.count_nonzero(sizes > 1)]:
            part = slice(starts[k], starts[k] + sizes[k])
            base = self._find(word[part])
            out[part] = base + word[part]
            self.base[parent[starts[k]]] = base
            self._fit(int(out[part][-1]) + self.words + 2)
            self.used[out[part]] = True
            self.top = max(self.top, int(out[part][-1]))
        single = starts[sizes == 1]                      # any free place will do
        if len(single):
            self._fit(self.top + len(single) + self.words + 2)
            free = self.words + 1 + np.flatnonzero(~self.used[self.words + 1 :])[: len(single)]
            out[single] = free
            self.base[parent[single]] = free - word[single]
            self.used[free] = True
            self.top = max(self.top, int(free[-1]))
        self.check[out] = parent
        return out

    def _find(self, word: np.ndarray) -> int:
        """The first base, from where the last row of about this size went, at which all places are free."""
        away = word - word[0]
        kind = int(len(word)).bit_length()
        at = self.begin.get(kind, self.words + 1)
        while True:
            self._fit(at + 4096 + self.words + 2)
            free = at + np.flatnonzero(~self.used[at : at + 4096])
            for some in np.array_split(free, max(1, len(free) * len(away) // (1 << 18))):
                good = ~self.used[some[:, None] + away].any(axis=1)
                if good.any():
                    self.begin[kind] = int(some[good.argmax()])
                    return int(some[good.argmax()] - word[0])
            at += 4096

    def step(self, nodes: np.ndarray, word: np.ndarray) -> np.ndarray:
        """The children by the given words, 0 where there is none."""
        to = self.base[nodes] + word
        return np.where(self.check[to] == nodes, to, 0)


def _chunk(df: DataFrame, limit: int, *by: str) -> Iterator[DataFrame]:
    """``df``, a stored table, in parts of at most about ``limit`` rows, dealt by hash."""
    parts = -(-df.count() // limit)
    part = F.pmod(F.xxhash64(*by), F.lit(max(parts, 1)))
    return iter([df]) if parts == 1 else (df.where(part == k) for k in range(parts))


# -- words and their numbers ---------------------------------------------------------------------


def _tokens(texts: pa.Array, seed: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(bytes, starts, ends, text, hash) of the words in lower case, and whether a break comes before each."""
    data, offsets = utf8(texts)
    data = LOWER[data]
    starts, ends, doc = words(data, offsets, IN_WORD)
    hashes = mix(word_hashes(data, starts, ends) + np.uint64(seed))
    sums = np.concatenate([[0], np.cumsum(IS_BREAK[data], dtype=np.int64)]) if len(data) else np.zeros(1, np.int64)
    cut = np.ones(len(starts), bool)
    cut[1:] = (doc[1:] != doc[:-1]) | (sums[starts[1:]] > sums[ends[:-1]])
    return data, starts, ends, doc, hashes, cut


def _languages(langs: pa.Array) -> tuple[list[str], np.ndarray]:
    found = langs.cast(pa.string()).fill_null(UNKNOWN).dictionary_encode()
    return found.dictionary.to_pylist(), found.indices.to_numpy(zero_copy_only=False).astype(np.int64)


def word_counts(docs: DataFrame, text: str = "text", lang: str = "lang") -> DataFrame:
    """(lang, word, n) of every word; the row of a NULL word has the number of all words."""

    def make():
        held: dict[str, list] = {}      # language -> [hashes sorted, their places, counts, words]
        totals: dict[str, int] = {}

        def table():
            if not totals:
                return None
            found = {"lang": [], "word": [], "n": np.concatenate([*(x[2] for x in held.values()), list(totals.values())])}
            for name, (_, _, _, some) in held.items():
                found["lang"] += [name] * len(some)
                found["word"] += some
            found["lang"] += totals
            found["word"] += [None] * len(totals)
            held.clear()
            totals.clear()
            return found

        def work(texts, langs):
            data, starts, ends, doc, hashes, _ = _tokens(texts, 0)
            names, index = _languages(langs)
            line = data.tobytes()
            of = index[doc]
            for k, name in enumerate(names):
                mine = np.flatnonzero(of == k) if len(names) > 1 else np.arange(len(doc))
                totals[name] = totals.get(name, 0) + len(mine)
                unique, first, n = np.unique(hashes[mine], return_index=True, return_counts=True)
                known, places, counts, some = held.get(name) or [np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), []]
                at = np.minimum(np.searchsorted(known, unique), max(len(known) - 1, 0))
                old = known[at] == unique if len(known) else np.zeros(len(unique), bool)
                counts[places[at[old]]] += n[old]
                new = mine[first[~old]]
                merged = np.concatenate([known, unique[~old]])
                order = np.argsort(merged, kind="stable")
                places = np.concatenate([places, len(some) + np.arange(len(new))])[order]
                some += [line[a:b].decode("utf-8", "replace") for a, b in zip(starts[new].tolist(), ends[new].tolist())]
                held[name] = [merged[order], places, np.concatenate([counts, n[~old]]), some]
            return table() if sum(len(x[3]) for x in held.values()) > HELD_WORDS else None

        def finish():
            made = table()
            if made is not None:
                yield made

        work.finish = finish
        return work

    return emit_from_text(docs, make, "lang string, word string, n long", [lang], text).groupBy("lang", "word").agg(F.sum("n").alias("n"))


def _lookup(rows: list, first: int, seed: int) -> dict[str, tuple[np.ndarray, np.ndarray]]:
    """For each language the sorted hashes of its words and their numbers, which run on from ``first``.

    Of words with one hash all but one are left without a number.
    """
    out: dict[str, list] = {}
    for k, (lang, word) in enumerate(rows):
        out.setdefault(lang, []).append((word, first + k))
    made = {}
    for lang, some in out.items():
        data, offsets = utf8(pa.array([word for word, _ in some]))
        hashes = mix(word_hashes(data, offsets[:-1], offsets[1:]) + np.uint64(seed))
        hashes, order = np.unique(hashes, return_index=True)
        made[lang] = hashes, np.array([number for _, number in some], np.int32)[order]
    return made


def _numbered(docs: DataFrame, tables: list[tuple[list, int, int]], seed: int, text: str, lang: str) -> DataFrame | None:
    """(ids): the numbers of each text's words, 0 between pieces, for words without one, and at the end.

    ``tables`` has words, the first number, and how often all of them occur; None if that
    differs from what is found, as then some hash stands for two words.
    """
    rows = docs.select(F.col(f"`{lang}`").cast("string").alias("lang"), F.col(f"`{text}`").alias("text"))
    for k, (some, first, expected) in enumerate(tables):
        last = k == len(tables) - 1
        shared = rows.sparkSession.sparkContext.broadcast(_lookup(some, first, seed))

        def make(shared=shared, last=last, again=k > 0):
            def work(texts, langs, before=None):
                lookup = shared.value
                _, starts, _, doc, hashes, cut = _tokens(texts, seed)
                names, index = _languages(langs)
                of = index[doc]
                found = np.zeros(len(starts), np.int32)
                for j, name in enumerate(names):
                    if name in lookup:
                        mine = np.flatnonzero(of == j) if len(names) > 1 else slice(None)
                        listed, number = lookup[name]
                        at = np.minimum(np.searchsorted(listed, hashes[mine]), len(listed) - 1)
                        found[mine] = np.where(listed[at] == hashes[mine], number[at], 0)
                known = np.bincount(doc[found > 0], minlength=len(texts))
                if again:
                    found = np.where(found > 0, found, before.flatten().to_numpy())
                if not last:
                    return {"known": known, "lang": langs, "text": texts, "ids": _lists(found, np.bincount(doc, minlength=len(texts)))}
                # A 0 before each piece, and one for each run of them.
                wide = np.zeros(len(found) + int(cut.sum()) + 1, np.int32)
                place = np.arange(len(found)) + np.cumsum(cut)
                wide[place] = found
                owner = np.concatenate([np.repeat(doc, 1 + cut), [len(texts)]])
                keep = wide > 0
                keep[1:] |= wide[:-1] > 0
                return {"known": known, "ids": _closed(wide[keep], owner[keep], len(texts))}

            return work

        fields = "known long, ids array<int>" if last else "known long, lang string, text string, ids array<int>"
        rows, seen = stored_sum(emit_from_text(rows, make, fields, ["lang", "ids"] if k else ["lang"]), "numbered", known=F.sum("known"))
        if (seen["known"] or 0) != expected:
            return None
        rows = rows.drop("known")
    return rows.where("size(ids) > 2")


def _lists(values: np.ndarray, sizes: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(np.concatenate([[0], np.cumsum(sizes)]), pa.int32()), pa.array(values, pa.int32()))


def _closed(values: np.ndarray, owner: np.ndarray, count: int) -> pa.Array:
    """The numbers of each of ``count`` texts, with one 0 at its end."""
    inner = owner < count
    values, owner = values[inner], owner[inner]
    sizes = np.bincount(owner, minlength=count)
    out = np.zeros(len(values) + count, np.int32)
    out[np.arange(len(values)) + owner] = values
    return _lists(out, sizes + 1)


# -- phrases ------------------------------------------------------------------------------------------


def _walk(numbered: DataFrame, make, fields: str) -> DataFrame:
    """Rows that ``make()(numbers)`` gives for each batch of numbered texts, and at its end."""
    bounded_batches(numbered.sparkSession)

    def sent(made: pa.RecordBatch | None) -> Iterator[pa.RecordBatch]:
        if made is not None:
            for start in range(0, made.num_rows, SENT):
                yield made.slice(start, SENT)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        work, finish = make()
        for batch in batches:
            values = np.concatenate([batch.column(0).flatten().to_numpy(), np.zeros(LONGEST, np.int32)])
            for start in range(0, len(values) - LONGEST, WALKED):
                yield from sent(work(values[start : start + WALKED + LONGEST]))
        yield from sent(finish())

    return numbered.mapInArrow(run, fields)


def _met(numbered: DataFrame, depth: int, trie: Trie | None, both: bool) -> DataFrame:
    """(parent, word, n): phrases of ``depth`` words that continue a phrase of the trie, by its index.

    Without a trie all words are phrases of one word, by their number.
    """
    shared = numbered.sparkSession.sparkContext.broadcast(trie)

    def make():
        trie, held, size = shared.value, [], 0

        def give():
            nonlocal size
            if not held:
                return None
            codes, n = np.unique(np.concatenate(held), return_counts=True)
            held.clear()
            size = 0
            return pa.RecordBatch.from_arrays([pa.array(codes >> 32), pa.array((codes & 0xFFFFFFFF).astype(np.int32)), pa.array(n)],
                                              ["parent", "word", "n"])

        def work(ids):
            nonlocal size
            end = len(ids) - LONGEST
            if trie is None:
                parent = ids[: end + 1].astype(np.int64) - 1
            else:
                nodes = ids[: end + 1]
                for k in range(1, depth - 1):
                    nodes = trie.step(nodes, ids[k : end + 1 + k])
                parent = np.where(nodes > 0, trie.phrase[nodes], -1).astype(np.int64)
            after = ids[depth - 1 : end + depth - 1]
            good = (parent[:-1] >= 0) & (after > 0)
            if both:
                good &= parent[1:] >= 0
            held.append(parent[:-1][good] << 32 | after[good])
            size += len(held[-1])
            return give() if size > HELD_MET else None

        return work, give

    met = _walk(numbered, make, "parent long, word int, n long")
    return met.groupBy("parent", "word").agg(F.sum("n").alias("n"))


def _counted(numbered: DataFrame, trie: Trie, count: int) -> DataFrame:
    """(parent, n): how often each phrase of the trie occurs.

    A task's counts leave it as one row for each block of phrases; blocks of ``SUMMED``
    tasks are added up as arrays, and only those sums are rows of their own.
    """
    shared = numbered.sparkSession.sparkContext.broadcast(trie)

    def make():
        trie, sums = shared.value, np.zeros(count + 1, np.int64)

        def work(ids):
            end = len(ids) - LONGEST
            at = np.flatnonzero(ids[:end])
            nodes = ids[at]
            for k in range(1, LONGEST):
                nodes = trie.step(nodes, ids[at + k])
                at, nodes = at[nodes > 0], nodes[nodes > 0]
                found, n = np.unique(trie.phrase[nodes], return_counts=True)
                sums[found + 1] += n
            return None

        def finish():
            found = np.flatnonzero(sums[1:])
            blocks, starts = np.unique(found // BLOCK, return_index=True)
            ends = pa.array(np.append(starts, len(found)), pa.int32())
            group = np.full(len(blocks), TaskContext.get().partitionId() // SUMMED)
            return pa.RecordBatch.from_arrays(
                [pa.array(blocks), pa.array(group), pa.ListArray.from_arrays(ends, pa.array(found)), pa.ListArray.from_arrays(ends, pa.array(sums[1:][found]))],
                ["block", "tasks", "parents", "counts"])

        return work, finish

    def add(table: pa.Table) -> pa.Table:
        parents, counts = (table.column(name).combine_chunks().flatten().to_numpy() for name in ("parents", "counts"))
        first = parents.min()
        total = np.zeros(BLOCK, np.int64)
        np.add.at(total, parents - first, counts)
        found = np.flatnonzero(total)
        return pa.table({"parent": pa.array(found + first), "n": pa.array(total[found])})

    tallied = _walk(numbered, make, "block long, tasks long, parents array<long>, counts array<long>")
    return tallied.groupBy("block", "tasks").applyInArrow(add, "parent long, n long").groupBy("parent").agg(F.sum("n").alias("n"))


def _collected(phrases: DataFrame, words: int) -> tuple[Trie, DataFrame, int]:
    """The trie of a bounded table of phrases, and (parent, phrase): the index of each in it."""
    table = phrases.select("phrase").toArrow().column("phrase").combine_chunks()
    lengths = np.diff(table.offsets.to_numpy()) if len(table) else np.zeros(0, np.int64)
    square = np.zeros((len(table), int(lengths.max()) if len(table) else 1), np.int32)
    square[np.arange(square.shape[1]) < lengths[:, None]] = table.flatten().to_numpy()
    index = phrases.sparkSession.createDataFrame(pa.table({"parent": pa.array(np.arange(len(table))), "phrase": table}))
    return Trie(square, lengths, words), index, len(table)


def phrases(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, text: str = "text", lang: str = "lang",
            trie_phrases: int = TRIE_PHRASES, table_words: int = TABLE_WORDS) -> tuple[DataFrame, DataFrame, DataFrame]:
    """Words (number, lang, word, n), totals (lang, n), and phrases of 2 to ``longest`` words
    (phrase as numbers, n) that occur at least ``least`` times."""
    if longest > LONGEST or longest < 2:
        raise ValueError(f"phrases of 2 to {LONGEST} words")
    spark = docs.sparkSession
    counts = stored(word_counts(docs, text, lang).where(F.col("word").isNull() | (F.col("n") >= least)), "words")
    totals = counts.where("word IS NULL").select("lang", "n")
    frequent = counts.where("word IS NOT NULL")
    for seed in range(1, 5):
        tables, index, first = [], [], 1
        for part in _chunk(frequent, table_words, "lang", "word"):
            some = part.orderBy("lang", "word").toArrow()
            number = pa.array(np.arange(first, first + len(some)), pa.int32())
            tables.append(([*zip(some.column("lang").to_pylist(), some.column("word").to_pylist())], first, sum(some.column("n").to_pylist())))
            index.append(stored(spark.createDataFrame(some.append_column("number", number).select(["number", "lang", "word", "n"])), "numbers"))
            first += len(some)
        words_ = first - 1
        if not words_:
            none = spark.createDataFrame([], "phrase array<int>, n long")
            return spark.createDataFrame([], "number int, lang string, word string, n long"), totals, none
        listed = index[0]
        for part in index[1:]:
            listed = listed.unionByName(part)
        numbered = _numbered(docs, tables, seed, text, lang)
        if numbered is not None:
            break
    else:
        raise RuntimeError("words share hashes under every seed")
    met = _met(numbered, 2, None, True).where(F.col("n") >= least)
    level = stored(met.select(F.array((F.col("parent") + 1).cast("int"), "word").alias("phrase"), "n"), "level")
    candidates = [level]
    for depth in range(3, longest + 1):
        parts = []
        some = list(_chunk(level, trie_phrases, "phrase"))
        for part in some:
            trie, place, _ = _collected(part, words_)
            grown = _met(numbered, depth, trie, len(some) == 1).where(F.col("n") >= least).join(place, "parent")
            parts.append(stored(grown.select(F.concat("phrase", F.array("word")).alias("phrase"), "n"), "level"))
        if not parts:
            break
        level = parts[0]
        for part in parts[1:]:
            level = level.unionByName(part)
        candidates.append(level)
    every = candidates[0]
    for level in candidates[1:]:
        every = every.unionByName(level)
    every = every.select("phrase")
    parts = []
    for part in _chunk(every, trie_phrases, "phrase"):
        trie, place, count = _collected(part, words_)
        parts.append(stored(_counted(numbered, trie, count).join(place, "parent").select("phrase", "n"), "counted"))
    out = parts[0] if parts else spark.createDataFrame([], "phrase array<int>, n long")
    for part in parts[1:]:
        out = out.unionByName(part)
    return listed, totals, out.where(F.col("n") >= least)


def _big(column: str | Column) -> Column:
    return (F.col(column) if isinstance(column, str) else column).cast("decimal(20,0)")


def collocations(docs: DataFrame, least: int = LEAST, longest: int = LONGEST, share: int = SHARE, top: int = TOP,
                 text: str = "text", lang: str = "lang", **bounds) -> DataFrame:
    """(lang, rank, phrase, a, l, r, n, score): each language's first ``top`` phrases.

    A phrase inside a longer one that has at least ``share`` percent of its occurrences is left out.
    """
    listed, totals, found = phrases(docs, least, longest, text, lang, **bounds)
    every = found.unionByName(listed.select(F.array("number").alias("phrase"), "n"))
    # Each phrase with the most that a longer one around it occurs.
    inside = found.where("size(phrase) > 2").select("n", F.explode(F.flatten(F.transform(
        F.sequence(F.lit(2), F.size("phrase") - 1),
        lambda size: F.transform(F.sequence(F.lit(1), F.size("phrase") - size + 1), lambda at: F.slice("phrase", at, size))))).alias("phrase"))
    longer = inside.groupBy("phrase").agg(F.max("n").alias("longer"))
    kept = found.withColumnRenamed("n", "a").join(longer, "phrase", "left").where(
        F.col("longer").isNull() | (F.lit(100) * F.col("longer") < F.lit(share) * F.col("a"))).drop("longer")
    # Its language, its words, and the counts of both sides of each cut.
    named = listed.select("number", "lang", "word")
    spoken = kept.select("phrase", F.posexplode("phrase").alias("pos", "number")).join(named, "number").groupBy("phrase").agg(
        F.first("lang").alias("lang"), F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("pos", "word"))), lambda x: x["word"]), " ").alias("words"))
    cuts = kept.select("phrase", "a", F.explode(F.sequence(F.lit(1), F.size("phrase") - 1)).alias("k"))
    cuts = cuts.withColumns({"left": F.slice("phrase", 1, F.col("k")), "right": F.expr("slice(phrase, k + 1, size(phrase) - k)")})
    sides = cuts.join(every.select(F.col("phrase").alias("left"), F.col("n").alias("l")), "left").join(
        every.select(F.col("phrase").alias("right"), F.col("n").alias("r")), "right")
    sides = sides.join(spoken, "phrase").join(totals, "lang")
    # Products are decimals of up to 38 digits, divided as whole numbers.
    score = F.call_function("div", _big(F.lit(1000)) * _big("a") * _big("n"), _big("l") * _big("r"))
    scored = sides.withColumn("score", score).groupBy("phrase", "lang", "words", "a", "n").agg(
        F.min(F.struct("score", "k", "l", "r")).alias("worst")).select(
        "lang", F.col("words").alias("phrase"), "a", "worst.l", "worst.r", "n", "worst.score")
    # A language's first in each of many parts, then the first of those.
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    part = F.pmod(F.xxhash64("phrase"), F.lit(256))
    some = scored.withColumn("part", part).withColumn("place", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*best)))
    some = some.where(F.col("place") <= top).drop("place", "part")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*best)).cast("long").alias("rank")
    return some.select("lang", rank, "phrase", "a", "l", "r", "n", "score").where(F.col("rank") <= top)
