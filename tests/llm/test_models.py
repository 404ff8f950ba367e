"""Operators that learn: held-out accuracy, contracts of their columns, awkward rows."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from tallyline.llm import classlm, language, tables, toxicity
from tallyline.llm.texts import remainder, utf8, words
from tests.llm import docs, plain

SYLLABLES = {"en": ["th", "ing", "er", "an", "sh", "wh"], "de": ["sch", "ung", "keit", "ü", "ver", "ß"], "fr": ["eau", "é", "eux", "oi", "ç", "tion"]}
BAD = {"en": ["scum", "moron"], "de": ["lump", "depp"], "fr": ["con", "salaud"]}


def prose(rng, lang, count):
    return " ".join("".join(rng.choice(SYLLABLES[lang]) for _ in range(rng.randint(1, 3))) for _ in range(count))


@pytest.fixture(scope="module")
def corpus(spark):
    rng = random.Random(4)
    made = []
    for k in range(900):
        lang = ["en", "de", "fr"][k % 3]
        toxic = rng.random() < 0.3
        parts = prose(rng, lang, rng.randint(5, 120)).split()
        if toxic:
            parts.insert(rng.randint(0, len(parts)), rng.choice(BAD[lang]) + rng.choice(["", ".", "!"]))
        made.append((k, " ".join(parts), lang, "s", 0, "old", None, int(toxic)))
    return spark.createDataFrame(made, docs.SCHEMA + ", toxic int").repartition(4).cache()


@pytest.fixture(scope="module")
def table(spark):
    return docs.frame(spark).cache()


def test_words_of_a_slice():
    rng = random.Random(1)
    texts = ["".join(rng.choice("ab é\t\n\x0b\x1c丝") for _ in range(rng.randint(0, 20))) for _ in range(200)] + [None]
    data, offsets = utf8(pa.array(texts).slice(3))
    starts, ends, doc = words(data, offsets)
    found = [[] for _ in texts[3:]]
    for a, b, d in zip(starts, ends, doc):
        found[d].append(data[a:b].tobytes().decode())
    assert found == [plain.spaced(t) for t in texts[3:]]


def test_language(corpus):
    rest = remainder("doc_id", 4)
    network, languages = language.fit(language.sample(corpus, rest != 2))
    got = language.identify(corpus, network, languages).where(rest == 2).collect()
    assert np.mean([r.lang == r.lang_pred for r in got]) > 0.97
    assert set(r.lang_pred for r in got) == set(languages) and all(0 <= r.score <= 1 for r in got)
    assert got[0].asDict().keys() >= {"doc_id", "text", "toxic", "lang_pred", "score"}


def test_language_of_awkward_rows(table, corpus, spark):
    network, languages = language.fit(language.sample(corpus, F.lit(True)))
    got = language.identify(table, network, languages, keep=["doc_id", "text"]).collect()
    assert len(got) == table.count()
    for r in got:
        speaks = any(c.isalpha() for c in r.text or "")
        assert (r.lang_pred == "und") == (not speaks) and (speaks or r.score == 0)
    one = spark.createDataFrame([("a",)], "text string")
    assert [r.lang_pred for r in language.identify(one, None, ["en"]).collect()] == ["en"]
    assert [r.lang_pred for r in language.identify(one, None, []).collect()] == ["und"]
    assert language.identify(docs.frame(spark, []), network, languages).collect() == []
    assert language.sample(docs.frame(spark, []), F.lit(True)) == []


def test_letters_are_those_of_unicode(spark):
    texts = ["½ ² 123", "Ⅷ ① ٣ _", "é", "漢", "½ a"]
    rows = [(k, t, None, None, None, None, None) for k, t in enumerate(texts)]
    got = {r.doc_id: r.lang_pred for r in language.identify(docs.frame(spark, rows), None, ["en"]).collect()}
    assert [got[k] for k in range(5)] == ["und", "und", "en", "en", "en"]


def test_thresholds_at_every_size():
    for n in (1, 600, 10**4, 6 * 10**8, 10**10, 10**15):
        share = min(1, tables.threshold(600, n) / (1 << 63))
        assert min(n, 600) <= share * n <= max(n if n < 1300 else 1300, 1)


def test_samples_are_exact_and_bounded_whatever_repeats(spark):
    hot = spark.range(20_000).selectExpr("cast(7 as long) doc_id", "'the same text of one id' text", "'en' lang")
    rest = spark.range(900).selectExpr("id doc_id", "concat('text ', id, ' of many') text", "if(id % 3 = 0, 'de', 'en') lang")
    found = language.sample(hot.unionByName(rest), F.lit(True), per_language=50)
    whole = lambda some, lang: {t for la, t in some if la == lang and t.startswith(("text ", "the same"))}
    assert [len(whole(found, lang)) for lang in ("de", "en")] == [50, 50]
    few = language.sample(rest.limit(30), F.lit(True), per_language=50)
    assert sum(len(whole(few, lang)) for lang in ("de", "en")) == 30
    # What is chosen does not depend on partitions.
    assert found == language.sample(rest.repartition(7).unionByName(hot), F.lit(True), per_language=50)


def test_toxicity_sample_of_one_repeated_id(spark):
    hot = spark.range(20_000).selectExpr("cast(7 as long) doc_id", "'the same text of one id' text", "'en' lang")
    rest = spark.range(1000, 2200).selectExpr("id doc_id", "concat('text ', id) text", "if(id % 3 = 0, null, 'en') lang")
    marks = spark.range(0, 2200).selectExpr("id doc_id", "cast(id % 2 as int) toxic")
    found = toxicity.sample(hot.unionByName(rest), marks, F.lit(True), per_group=40)
    groups = {(lang, toxic): sum(f[1:3] == (lang, toxic) for f in found) for lang in ("", "en") for toxic in (0, 1)}
    assert set(groups.values()) == {40} and sum(f[0] == 7 for f in found) <= 1
    assert found == toxicity.sample(rest.repartition(5).unionByName(hot), marks, F.lit(True), per_group=40)


def test_toxicity_network_by_plain_sums(corpus):
    """The score of a text from its known words, convolution, pooling, softmax and the language's move, written out."""
    labels = corpus.select("doc_id", "toxic")
    model = toxicity.fit(toxicity.sample(corpus, labels, F.lit(True)))
    none = len(model.buckets)
    for row in corpus.orderBy("doc_id").limit(6).collect():
        words = [int(h) & int(toxicity.BUCKETS) for h in toxicity.hashed_words(pa.array([row.text]))[0]]
        places = {int(b): k for k, b in enumerate(model.buckets)}
        ids = [places.get(w, none) for w in words] or [none]
        chance = plain.convolved(model.network, ids)
        language_ = model.spoken[ids].sum(axis=0).argmax()
        odds = np.log(chance[1] + 1e-9) - np.log(chance[0] + 1e-9) + model.moves[language_]
        assert model.score(pa.array([row.text]))[0] == pytest.approx(1 / (1 + np.exp(-odds)), abs=1e-3)


def test_language_network_by_plain_sums(corpus, spark):
    """Convolution, pooling and softmax of single windows, written out."""
    network, languages = language.fit(language.sample(corpus, F.lit(True)))
    texts = ["The stone and the river of the cloud", "Der Fluss und das Haus", "x" * 700 + " la maison de la rue", "é!"]
    for text, chances in zip(texts, language.Reader(network)(pa.array(texts))):
        data = bytes(b + 32 if 65 <= b <= 90 else b for b in text.encode())
        total = np.zeros(len(languages))
        for start in range(0, len(data), language.WINDOW):
            window = data[start : start + language.WINDOW]
            total += plain.convolved(network, list(window) + [language.PAD] * (language.WINDOW - len(window))) * len(window)
        assert chances == pytest.approx(total / len(data), abs=1e-4)


def test_a_long_text_is_read_to_its_end(corpus):
    network, languages = language.fit(language.sample(corpus, F.lit(True)))
    rng = random.Random(9)
    mixed = prose(rng, "en", 100) + " " + prose(rng, "de", 900)
    chance = language.Reader(network)(pa.array([mixed, mixed[:300]]))
    assert languages[chance[0].argmax()] == "de" and languages[chance[1].argmax()] == "en"


def test_toxicity(corpus):
    rest = remainder("doc_id", 3)
    labels = corpus.select("doc_id", "toxic")
    model = toxicity.fit(toxicity.sample(corpus, labels, rest != 1))
    got = toxicity.score(corpus, model).where(rest == 1).collect()
    hit = [r.score >= toxicity.CUT for r in got if r.toxic]
    wrong = [r.score >= toxicity.CUT for r in got if not r.toxic]
    assert np.mean(hit) > 0.95 and np.mean(wrong) < 0.02
    assert all(0 <= r.score <= 1 for r in got)


def test_toxicity_does_not_depend_on_neighbours(corpus, table, spark):
    labels = corpus.select("doc_id", "toxic")
    model = toxicity.fit(toxicity.sample(corpus, labels, F.lit(True)))
    texts = [t for _, t in docs.pairs(table)]
    together = model.score(pa.array(texts, pa.string()))
    alone = np.concatenate([model.score(pa.array([t], pa.string())) for t in texts])
    assert np.allclose(together, alone)
    blank = {round(float(s), 9) for t, s in zip(texts, together) if not plain.spaced(t)}
    assert len(blank) == 1 and blank.pop() < toxicity.CUT
    assert len(toxicity.score(table, model).collect()) == table.count()
    assert toxicity.score(docs.frame(spark, []), model).collect() == []


def test_toxicity_without_labels(corpus, spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert toxicity.fit(toxicity.sample(corpus, none, F.lit(True))) == 0.0
    one = spark.createDataFrame([(0, 1, 1), (3, 1, None), (None, 1, 0)], "doc_id long, quality int, toxic int")
    assert toxicity.fit(toxicity.sample(corpus, one, F.lit(True))) == 1.0
    assert {r.score for r in toxicity.score(corpus, 0.0).collect()} == {0.0}


def test_class_scores(table, spark):
    rest = remainder("doc_id", 5)
    got = classlm.scores(table, rest != 1).withColumn("held", F.coalesce(rest == 1, F.lit(False))).collect()
    expected = plain.unigram_rows(docs.pairs(table))
    docs.same([(r.doc_id, r.held, r.n_tokens, r.n_known, r.train_tokens, f"{r.base_score:.6f}") for r in got],
              [(*row[:-1], f"{row[-1]:.6f}") for row in expected])
    assert all(r.score < 0 for r in got)
    empty = docs.frame(spark, [])
    assert classlm.scores(empty, rest != 1).collect() == []
    blind = classlm.scores(table, F.lit(False)).collect()
    assert {(r.n_known, r.train_tokens) for r in blind} == {(0, 0)} and len(blind) == table.count()


def test_classes_predict_better_than_words_alone(corpus):
    rest = remainder("doc_id", 5)
    got = classlm.scores(corpus, rest != 1).where(rest == 1).collect()
    assert sum(r.score for r in got) > sum(r.base_score for r in got)


def test_chances_sum_to_one(corpus):
    counts, model = classlm.learn(corpus)
    known = counts.toPandas()
    token, n = known.token.to_numpy().view(np.uint64), known.n.to_numpy()
    of = model.of[classlm.items(token, model.frequent)]
    inside = np.bincount(of, 10 ** (np.log10(n + 0.5) - model.inside[of]), classlm.CLASSES)
    rest = 0.5 * 10 ** -model.inside
    assert np.allclose(inside + rest, 1) and np.allclose((10**model.step).sum(axis=1), 1)


def test_repeated_words_have_classes_of_their_own(spark):
    rng = random.Random(8)
    sides = [[f"{a}{b}{c}{side}xy" for a in "bdfgk" for b in "aeiou" for c in "lmnprstvz"] for side in "qw"]
    sides = [[w + end for w in side for end in "abc"] for side in sides]
    made = [(k, " ".join(rng.choice(sides[j % 2]) for j in range(60)) + f" once{k}", "en", "s", 0, "", None) for k in range(400)]
    counts, model = classlm.learn(docs.frame(spark, made))
    assert (counts.where("n > 1").count(), len(model.frequent)) == (1351, 1351)
    hashes = [classlm.tokens(pa.array([" ".join(side)]))[0][:-1] for side in sides]
    classes = [model.of[classlm.items(h, model.frequent)] for h in hashes]
    shared = np.intersect1d(*classes)
    assert np.isin(classes[0], shared).mean() < 0.02 and np.isin(classes[1], shared).mean() < 0.02
    assert {r["class"] for r in counts.where("n = 1").collect()} <= set(model.group_of.tolist())


def test_exchange_finds_what_alternates():
    pairs = np.zeros((8, 8), np.int64)
    for a in range(8):
        for b in range(8):
            if a % 2 != b % 2:
                pairs[a, b] = 50 + a + b
    of = classlm.exchange(pairs, classes=2)
    assert len({of[k] for k in (0, 2, 4, 6)}) == 1 and len({of[k] for k in (1, 3, 5, 7)}) == 1 and of[0] != of[1]


def test_rounds_hold_no_shuffles_of_what_was_counted(spark, monkeypatch):
    rng = random.Random(2)
    rows = [(k, " ".join(f"w{rng.randint(0, 30)}{'ab'[j % 2]}" for j in range(40)), "en", "s", None, "x", None) for k in range(80)]
    held, places, move = [], [], classlm.moves

    def moves(tallied, between):
        held.append(spark.sparkContext._jsc.getPersistentRDDs().size())
        places.append({name.rsplit("/", 2)[-2] for name in tallied.inputFiles()})
        return move(tallied, between)

    monkeypatch.setattr(classlm, "moves", moves)
    before = spark.sparkContext._jsc.getPersistentRDDs().size()
    assert classlm.scores(docs.frame(spark, rows), F.lit(True)).count() == 80
    assert held and set(held) == {before} and len(set().union(*places)) == 1


def test_rounds_move_a_row_for_each_block_and_bucket(spark, monkeypatch):
    rng = random.Random(4)
    rows = [(k, " ".join(f"w{rng.randint(0, 3000)}" for _ in range(200)), "en", "s", None, "x", None) for k in range(60)]
    table, made, move = docs.frame(spark, rows), [], classlm.moves

    def moves(tallied, between):
        made.append(tallied.count())
        return move(tallied, between)

    monkeypatch.setattr(classlm, "moves", moves)
    expected = {r.doc_id: r.score for r in classlm.scores(table, F.lit(True)).collect()}
    assert set(made) == {2}
    monkeypatch.setattr(classlm, "BUCKET_WORDS", 256)
    made.clear()
    got = {r.doc_id: r.score for r in classlm.scores(table, F.lit(True)).collect()}
    assert got == pytest.approx(expected) and 2 < min(made) and max(made) <= 17
