"""Collocations against plain counting, and double-array tries against plain look-ups."""

import random
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from tallyline.llm import collocations
from tests.llm import docs, plain


def plain_rows(rows, least, share=100, top=2000, longest=5):
    counts, totals, out = Counter(), Counter(), []
    for text, lang in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", plain.lower(text)):
            words = re.findall(r"[^\x20\x09]+", piece)
            totals[lang] += len(words)
            for size in range(1, longest + 1):
                for i in range(len(words) - size + 1):
                    counts[lang, tuple(words[i : i + size])] += 1
    frequent = {k: n for k, n in counts.items() if len(k[1]) > 1 and n >= least}
    inside = {}
    for (lang, longer), n in frequent.items():
        for size in range(2, len(longer)):
            for i in range(len(longer) - size + 1):
                key = lang, longer[i : i + size]
                inside[key] = max(n, inside.get(key, 0))
    for (lang, phrase), a in frequent.items():
        if 100 * inside.get((lang, phrase), 0) >= share * a:
            continue
        cuts = []
        for k in range(1, len(phrase)):
            left, right = counts[lang, phrase[:k]], counts[lang, phrase[k:]]
            cuts.append((1000 * a * totals[lang] // (left * right), k, left, right))
        score, _, left, right = min(cuts)
        out.append((lang, " ".join(phrase), a, left, right, totals[lang], score))
    ranked = []
    for lang in {row[0] for row in out}:
        mine = sorted((row for row in out if row[0] == lang), key=lambda row: (-row[6], -row[2], row[1].encode()))
        ranked += [(lang, k + 1, *row[1:]) for k, row in enumerate(mine[:top])]
    return ranked


def some_rows(seed=3, count=300):
    rng = random.Random(seed)
    words = ["the", "of", "New", "York", "city", "hall", "très", "bien", "x y", "漢字", "(a)", "-", "ö"]
    out = []
    for k in range(count):
        line = []
        for _ in range(rng.randint(0, 60)):
            line.append(rng.choice(["new york city hall of", "NEW York", "très bien", *words, f"w{rng.randint(0, 40)}"]))
            if rng.random() < 0.2:
                line.append(rng.choice([".", ", ", "\n", "?", "\x0b", "\t", "  "]))
        out.append((" ".join(line), rng.choice(["en", "en", "fr", None, "und"])))
    out += [(None, "en"), ("", None), ("...!", "fr"), ("the " * 5000, "en"), ("alone", "zz")] + out[5:9] * 3
    return out


def frame(spark, rows):
    made = [(k, text, lang, "s", None, None, None) for k, (text, lang) in enumerate(rows)]
    return docs.frame(spark, made)


def found(df):
    assert df.columns == ["lang", "rank", "phrase", "a", "l", "r", "n", "score"]
    return [tuple(r) for r in df.collect()]


@pytest.mark.parametrize("bounds", [{}, {"trie_phrases": 25, "table_words": 20}])
def test_equals_plain_counting(spark, bounds):
    rows = some_rows()
    docs.same(found(collocations.collocations(frame(spark, rows), least=12, **bounds)), plain_rows(rows, 12))


def test_other_settings(spark):
    rows = some_rows(5, 120)
    docs.same(found(collocations.collocations(frame(spark, rows), least=4, longest=3, share=60, top=7)), plain_rows(rows, 4, 60, 7, 3))


def test_few_held_at_once(spark, monkeypatch):
    rows = some_rows(7, 100)
    monkeypatch.setattr(collocations, "HELD_WORDS", 10)
    docs.same(found(collocations.collocations(frame(spark, rows), least=6)), plain_rows(rows, 6))


def test_trie_walks():
    rng = np.random.default_rng(1)
    for words in (3, 40, 3000):
        sizes = rng.integers(2, 6, 4000)
        some = {tuple(rng.integers(1, words + 1, n).tolist()) if rng.random() < 0.6 else (1, *rng.integers(1, words + 1, n - 1).tolist()) for n in sizes}
        some = sorted(some)
        square = np.zeros((len(some), 5), np.int32)
        for k, phrase in enumerate(some):
            square[k, : len(phrase)] = phrase
        trie = collocations.Trie(square, np.array([len(p) for p in some]), words)
        places = {phrase: k for k, phrase in enumerate(some)}
        asked = [*some, *(tuple(rng.integers(0, words + 1, rng.integers(1, 6)).tolist()) for _ in range(3000))]
        for size in range(1, 6):
            mine = np.array([p for p in asked if len(p) == size], np.int32).reshape(-1, size)
            nodes = mine[:, 0]
            for k in range(1, size):
                nodes = trie.step(nodes, mine[:, k])
            got = np.where(nodes > 0, trie.phrase[nodes], -1)
            assert got.tolist() == [places.get(tuple(p), -1) for p in mine.tolist()]


def test_products_beyond_64_bits(spark):
    big = spark.range(1).selectExpr("CAST(3000000000 AS BIGINT) a", "CAST(900000000000 AS BIGINT) n", "CAST(3000000001 AS BIGINT) l", "CAST(7 AS BIGINT) r")
    from pyspark.sql import functions as F
    score = F.call_function("div", collocations._big(F.lit(1000)) * collocations._big("a") * collocations._big("n"),
                            collocations._big("l") * collocations._big("r"))
    assert big.select(score.alias("s")).first().s == 1000 * 3000000000 * 900000000000 // (3000000001 * 7)


def test_empty(spark):
    assert found(collocations.collocations(frame(spark, []))) == []
    assert found(collocations.collocations(frame(spark, [(None, None), ("a b", "en")]))) == []


def test_a_long_text_walks_in_bounded_parts(spark):
    size = 2 * collocations.WALKED + 3
    numbered = spark.range(0, 1, 1, 1).selectExpr(f"transform(sequence(1, {size}), x -> cast(x AS int)) AS ids")

    def make():
        def work(ids):
            end = len(ids) - collocations.LONGEST
            return pa.RecordBatch.from_arrays([pa.array([end]), pa.array([int(ids[0])]), pa.array([int(ids[end])])], ["positions", "first", "after"])

        return work, lambda: pa.RecordBatch.from_arrays([pa.array(np.full(3 * collocations.SENT + 1, -1))] * 3, ["positions", "first", "after"])

    rows = collocations._walk(numbered, make, "positions long, first long, after long")
    step = collocations.WALKED
    assert [tuple(r) for r in rows.where("positions > 0").collect()] == [(step, 1, step + 1), (step, step + 1, 2 * step + 1), (3, 2 * step + 1, 0)]
    assert rows.where("positions < 0").count() == 3 * collocations.SENT + 1
