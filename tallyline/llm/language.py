"""Language identification by a convolutional network over bytes.

A text's UTF-8 bytes, A to Z in lower case, are cut into windows of ``WINDOW`` bytes, all of them, the last one
padded. The network (see ``convnet``) runs over many windows at once; a text's
probabilities are the mean over its windows, weighted by their bytes.

The network is fitted on the driver to a bounded sample of labelled rows: for each
language ``PER_LANGUAGE`` documents, or all it has, those with the smallest hash of id and
text, and of each ``PLACES`` windows spread over the whole text. A row repeated any number
of times is one.

NULL texts and texts without a letter (Unicode category L) are ``und`` with score 0. With no labelled row, or
only one language, that language or ``und`` is all there is to say. Ties go to the
language that sorts first. Rows are independent: repeated rows and extra columns change
nothing. Memory is bounded by a slice or the longest text.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyline.llm.convnet import Network, softmax, train
from tallyline.llm.tables import bounded_sample, hash63
from tallyline.llm.texts import map_text, utf8

WINDOW = 256
WIDTHS, FILTERS, DEPTH, EPOCHS = (2, 3, 4), 16, 8, 3
PER_LANGUAGE, PLACES = 600, 4
UNKNOWN = "und"
PAD = 256
#: Windows that go through the network together.
TOGETHER = 128
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32
LETTER = regex.compile(r"\p{L}")


def sample(docs: DataFrame, allowed: Column, per_language: int = PER_LANGUAGE) -> list[tuple[str, str]]:
    """(language, stretch of text) of a bounded sample of the allowed labelled rows, to the driver.

    Each language gives ``per_language`` documents, or all it has; rows that repeat id and text are one.
    """
    labelled = docs.where(allowed & F.col("lang").isNotNull() & (F.length("text") > 0))
    places = [F.substr("text", (F.length("text") * k / PLACES).cast("int") + 1, F.lit(WINDOW)) for k in range(PLACES)]
    rows = labelled.select("lang", hash63("doc_id", "text").alias("__hash"), F.array_distinct(F.array(*places)).alias("texts"))
    cut = bounded_sample(rows, ["lang"], per_language).select("lang", F.explode("texts").alias("text")).orderBy("lang", "text")
    return [(row.lang, row.text) for row in cut.toLocalIterator()]


def fit(stretches: list[tuple[str, str]]) -> tuple[Network | None, list[str]]:
    languages = sorted({lang for lang, _ in stretches})
    if len(languages) < 2:
        return None, languages
    network = Network.new(256, len(languages), DEPTH, WIDTHS, FILTERS)
    labels = np.array([languages.index(lang) for lang, _ in stretches])
    sequences = [LOWER[np.frombuffer(text.encode("utf-8", "surrogatepass")[:WINDOW], np.uint8)].astype(np.int64) for _, text in stretches]
    weights = (len(labels) / np.bincount(labels))[labels]
    return train(network, sequences, labels, weights, EPOCHS), languages


class Reader:
    """Probabilities of whole texts."""

    def __init__(self, network: Network):
        self.network = network
        self.tables = network.tables()

    def windows(self, matrix: np.ndarray) -> np.ndarray:
        """Probabilities of each row of padded bytes."""
        out = []
        for k in range(0, len(matrix), TOGETHER):
            some = matrix[k : k + TOGETHER]
            ids = some.ravel()
            pooled = [self.network.respond(group, ids).reshape(*some.shape, -1)[:, :WINDOW].max(axis=1) for group in self.tables]
            out.append(softmax(self.network.logits(pooled)))
        return np.concatenate(out)

    def __call__(self, texts: pa.Array) -> np.ndarray:
        data, offsets = utf8(texts)
        size = np.diff(offsets)
        count = np.maximum(-(-size // WINDOW), 1)
        doc = np.repeat(np.arange(len(size)), count)
        first = np.cumsum(count) - count
        begin = offsets[:-1][doc] + (np.arange(len(doc)) - first[doc]) * WINDOW
        length = np.minimum(offsets[1:][doc] - begin, WINDOW)
        padded = np.concatenate([LOWER[data], np.zeros(WINDOW, np.uint8)])
        total = np.zeros((len(size), len(self.network.shift)))
        for k in range(0, len(doc), 4096):
            rows = slice(k, k + 4096)
            matrix = np.full((len(begin[rows]), WINDOW + self.network.pads), PAD, np.int16)
            matrix[:, :WINDOW] = padded[begin[rows, None] + np.arange(WINDOW)]
            matrix[:, :WINDOW][np.arange(WINDOW) >= length[rows, None]] = PAD
            np.add.at(total, doc[rows], self.windows(matrix) * np.maximum(length[rows], 1)[:, None])
        return total / np.maximum(size, 1)[:, None]


def identify(docs: DataFrame, network: Network | None, languages: list[str], keep: list[str] | None = None,
             text: str = "text") -> DataFrame:
    """``docs`` with lang_pred and score of each whole text."""

    def make():
        reader = Reader(network) if network is not None else None

        def work(texts):
            spoken = np.array([bool(t) and LETTER.search(t) is not None for t in texts.to_pylist()])
            if reader is None:
                only = languages[0] if languages else UNKNOWN
                return [[only if s else UNKNOWN for s in spoken], np.where(spoken, float(bool(languages)), 0.0)]
            chance = reader(texts)
            best = chance.argmax(axis=1)
            score = np.clip(chance[np.arange(len(best)), best], 0, 1)
            return [[languages[b] if s else UNKNOWN for b, s in zip(best, spoken)], np.where(spoken, score, 0.0)]

        return work

    return map_text(docs, make, "lang_pred string, score double", keep, text)
