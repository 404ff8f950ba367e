"""Toxicity by a convolutional classifier over hashed words.

Words (runs of digits, letters and non-ASCII characters, A to Z in lower case) are hashed
to 2^40 places; those that ``LEAST_DOCUMENTS`` sampled documents have get an embedding,
all others share one of zeros, so a word never seen says nothing. One dimension of an
embedding begins as the word's log-odds between the labels. The network (see
``convnet``) takes the largest response of each filter over the whole text.

Thresholds are calibrated by language: on sampled documents kept from the fit, each
language gets the threshold that separates its labels best, and the score is moved on
the log-odds scale so that this threshold reads ``CUT``. A text's language is guessed
from its words by their frequencies in the sample's languages.

The network is fitted on the driver to a bounded sample of labelled rows:
``PER_GROUP`` documents of each label and language, or all there are, those with the
smallest hash of id and text, of at most ``SAMPLE_BYTES`` bytes each. A row repeated any
number of times is one. Whole texts are scored, whatever their length.

NULL and empty texts get the score of a text without known words. With no labelled row,
or one label only, every score is 0, or that label. Rows are independent: repeated rows,
ties and extra columns change nothing.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.convnet import Network, softmax, train
from tallyline.llm.phrases import hashed_words
from tallyline.llm.tables import bounded_sample, hash63, stored
from tallyline.llm.texts import SLICE_BYTES, map_text, slices

WIDTHS, FILTERS, DEPTH, EPOCHS = (1, 2, 3), 8, 8, 7
PER_GROUP, SAMPLE_BYTES, LEAST_DOCUMENTS = 1000, 1 << 15, 4
CUT = 0.7
BUCKETS = np.uint64((1 << 40) - 1)


def sample(docs: DataFrame, labels: DataFrame, allowed: Column, per_group: int = PER_GROUP) -> list[tuple]:
    """(id, language, label, text) of a bounded sample of the allowed labelled rows, to the driver.

    Each label and language give ``per_group`` documents, or all they have; rows that repeat id
    and text are one. Only ids and hashes are sorted; the texts of those chosen are read after.
    """
    known = labels.where("toxic IS NOT NULL").groupBy(F.col("doc_id").alias("__id")).agg(F.max("toxic").alias("__toxic"))
    rows = docs.where(allowed & (F.octet_length("text") <= SAMPLE_BYTES)).select(
        "doc_id", F.coalesce("lang", F.lit("")).alias("lang"), hash63("doc_id", "text").alias("__hash"), "text")
    ids = rows.select("doc_id", "lang", "__hash").join(known, F.col("doc_id") == F.col("__id")).drop("__id")
    chosen = stored(bounded_sample(ids, ["lang", "__toxic"], per_group).select("doc_id", "__hash", "__toxic"), "chosen")
    texts = rows.join(chosen.select(F.col("doc_id").alias("__id"), F.col("__hash").alias("__h"), "__toxic"),
                      (F.col("doc_id") == F.col("__id")) & (F.col("__hash") == F.col("__h")))
    texts = texts.dropDuplicates(["doc_id", "lang", "__hash"])
    return sorted((r.doc_id, r.lang, int(r["__toxic"] > 0), r.text) for r in texts.select("doc_id", "lang", "__toxic", "text").toLocalIterator())


@dataclass
class Model:
    buckets: np.ndarray        # sorted places of known words
    network: Network
    spoken: np.ndarray         # known words x languages: log frequencies
    moves: np.ndarray          # for each language, what is added to the log-odds
    tables: list | None = None  # of the network, once it is trained

    def known(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """For every word its row (the last: none) and the index of its text."""
        hashes, doc = hashed_words(texts)
        place = hashes & BUCKETS
        low = (self.buckets & np.uint64(0xFFFFF)).astype(np.int64)
        maybe = np.zeros(1 << 20, bool)
        maybe[low] = True
        rows = np.full(len(place), len(self.buckets), np.int64)
        some = np.flatnonzero(maybe[(place & np.uint64(0xFFFFF)).astype(np.int64)])
        at = np.searchsorted(self.buckets, place[some])
        hit = at < len(self.buckets)
        hit[hit] = self.buckets[at[hit]] == place[some][hit]
        rows[some[hit]] = at[hit]
        return rows, doc

    def odds(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Log-odds and guessed language of each text."""
        rows, doc = self.known(texts)
        n, gap, none = len(texts), self.network.pads + 1, len(self.buckets)
        counts = np.bincount(doc, minlength=n)
        begins = np.concatenate([[0], np.cumsum(counts + gap)[:-1]]).astype(np.int64) if n else np.zeros(0, np.int64)
        ids = np.full(int(counts.sum()) + n * gap, none, np.int64)
        ids[np.arange(len(rows)) + doc * gap] = rows
        # Places in the padding behind a text see the next one; a text without words keeps one of its own.
        behind = np.concatenate([(begins + np.maximum(counts, 1))[:, None] + k for k in range(gap)], axis=1).ravel() if n else begins
        behind = behind[np.repeat(begins + counts + gap, gap) > behind] if n else behind
        pooled = []
        for group in self.tables or self.network.tables():
            out = self.network.respond(group, ids)
            out[behind] = -np.inf
            pooled.append(np.maximum.reduceat(out, begins, axis=0) if n else out)
        chance = softmax(self.network.logits(pooled).astype(np.float64))
        speech = np.add.reduceat(self.spoken.take(ids, axis=0), begins, axis=0) if n else np.zeros((0, self.spoken.shape[1]))
        tiny = 1e-9
        return np.log(chance[:, 1] + tiny) - np.log(chance[:, 0] + tiny), speech.argmax(axis=1)

    def score(self, texts: pa.Array) -> np.ndarray:
        odds, language = self.odds(texts)
        return 1 / (1 + np.exp(-(odds + self.moves[language])))


def in_parts(texts: pa.Array, limit: int = SLICE_BYTES) -> list[pa.Array]:
    """The texts in order, in parts of bounded size."""
    return [part.column(0) for part in slices(pa.RecordBatch.from_arrays([texts], ["t"]), 0, limit)]


def best_threshold(odds: np.ndarray, labels: np.ndarray) -> float:
    """The log-odds that separate the labels with fewest errors; in the middle of the widest such gap."""
    order = np.argsort(odds)
    odds, labels = odds[order], labels[order]
    errors = np.concatenate([[0], np.cumsum(labels)]) + np.concatenate([np.cumsum((1 - labels)[::-1])[::-1], [0]])
    edge = np.concatenate([[odds[0] - 2], odds, [odds[-1] + 2]])
    width = np.where(errors == errors.min(), edge[1:] - edge[:-1], -1)
    k = int(width.argmax())
    return float((edge[k] + edge[k + 1]) / 2)


def fit(rows: list[tuple]) -> Model | float:
    """The model, or the one score that all texts get where the sample has fewer than two labels."""
    labels = np.array([row[2] for row in rows], np.int64)
    if len(set(labels.tolist())) < 2:
        return float(labels[0]) if len(labels) else 0.0
    parts = in_parts(pa.array([row[3] for row in rows], pa.string()))
    each, begin = [], 0
    for part in parts:  # every different word of each document once
        hashes, doc = hashed_words(part)
        order = np.lexsort((hashes & BUCKETS, doc))
        place, doc = (hashes & BUCKETS)[order], doc[order].astype(np.int32) + begin
        first = np.ones(len(place), bool)
        first[1:] = (place[1:] != place[:-1]) | (doc[1:] != doc[:-1])
        each.append((place[first], doc[first]))
        begin += len(part)
    place, doc = np.concatenate([e[0] for e in each]), np.concatenate([e[1] for e in each])
    words, count = np.unique(place, return_counts=True)
    buckets = words[count >= LEAST_DOCUMENTS]
    languages = sorted({row[1] for row in rows})
    spoken = np.zeros((len(buckets) + 1, len(languages)), np.float32)
    model = Model(buckets, Network.new(len(buckets), 2, DEPTH, WIDTHS, FILTERS), spoken, np.zeros(len(languages)))
    at = np.searchsorted(buckets, place)
    at[at == len(buckets)] = 0
    inside = buckets[at] == place if len(buckets) else np.zeros(len(place), bool)
    once = at[inside], doc[inside]
    language = np.array([languages.index(r[1]) for r in rows])
    seen = 1.0 + np.bincount(once[0] * len(languages) + language[once[1]], minlength=spoken[:-1].size).reshape(-1, len(languages))
    model.spoken[:-1] = np.log(seen / seen.sum(axis=0))
    sequences = []
    for part in parts:
        row, doc = model.known(part)
        sequences += np.split(row.astype(np.int32), np.cumsum(np.bincount(doc, minlength=len(part)))[:-1])
    held = np.array([k % 5 == 0 for k in range(len(rows))])
    if min(len(set(labels[~held].tolist())), len(set(labels[held].tolist()))) < 2:
        held[:] = False
    weights = (len(labels) / np.bincount(labels))[labels]
    use = np.flatnonzero(~held)
    # One dimension of an embedding begins as the word's log-odds among the documents of the fit.
    fitted = ~held[once[1]]
    once = once[0][fitted], once[1][fitted]
    with_word = [np.bincount(once[0][labels[once[1]] == label], minlength=len(buckets)) for label in (0, 1)]
    share = [np.log((with_word[label] + 0.5) / ((labels[use] == label).sum() + 1)) for label in (0, 1)]
    model.network.embedding[:-1, 0] = (share[1] - share[0]) / 2
    model.network.embedding[:-1, 1:] *= 0.2
    train(model.network, [sequences[k] for k in use], labels[use], weights[use], EPOCHS, batch=16)
    check = np.flatnonzero(held) if held.any() else np.arange(len(rows))
    read = [model.odds(part) for part in in_parts(pa.array([rows[k][3] for k in check], pa.string()))]
    odds, guessed = (np.concatenate([r[k] for r in read]) for k in (0, 1))
    general = best_threshold(odds, labels[check])
    for k in range(len(languages)):
        mine = guessed == k
        enough = min(np.bincount(labels[check][mine], minlength=2)) >= 5
        model.moves[k] = np.log(CUT / (1 - CUT)) - (best_threshold(odds[mine], labels[check][mine]) if enough else general)
    return model


def score(docs: DataFrame, model: Model | float, keep: list[str] | None = None, text: str = "text",
          name: str = "score") -> DataFrame:
    """``docs`` with the score of each whole text; the model goes to the tasks in one broadcast, bounded by the sample."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def make():
        model = shared.value
        if isinstance(model, float):
            return lambda texts: [np.full(len(texts), model)]
        model.tables = model.tables or model.network.tables()
        return lambda texts: [model.score(texts)]

    return map_text(docs, make, f"`{name}` double", keep, text)
