"""Operators with one right answer, against the contracts written plainly, over awkward rows."""

import random

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest

from tallyline.llm import anchors, divergence, personal, phrases, speculative, substrings, transducer
from tests.llm import docs, plain

WORDS = public_tokenizers.path("word_bpe_49k.json")
PIECES = public_tokenizers.path("piece_bpe_32k.model")


@pytest.fixture(scope="module")
def table(spark):
    return docs.frame(spark).cache()


@pytest.fixture(scope="module")
def empty(spark):
    return docs.frame(spark, [])


@pytest.fixture(scope="module")
def items(spark):
    some = docs.texts()
    made = [(1, some[0][40:400]), (2, some[9][:300]), (10, "word"), (3, "the of"), (4, None), (5, "..."), (6, some[0][40:400]), (7, "Again " * 12)]
    return spark.createDataFrame(made, "item_id long, text string")


def test_substrings(table, empty):
    docs.same(substrings.digest(table).collect(), plain.substring_rows(docs.pairs(table)))
    assert substrings.digest(empty).collect() == []


@pytest.mark.parametrize("size", [12, 20])
def test_substrings_of_other_sizes(table, size):
    docs.same(substrings.digest(table, size).collect(), plain.substring_rows(docs.pairs(table), size))


def test_equal_windows_have_equal_keys():
    rng = random.Random(2)
    shared = [rng.choice("abcdefgh") for _ in range(70)]
    around = [" ".join([*(rng.choice("abcdefgh") for _ in range(n)), *shared, *(rng.choice("abcdefgh") for _ in range(m))]) for n, m in ((3, 9), (40, 0), (0, 31))]
    windows = substrings.Windows(pa.array(around), 50)
    keys = [windows.key[windows.doc == k][n : n + 21] for k, n in enumerate((3, 40, 0))]
    assert all((keys[0] == k).all() for k in keys)


def test_phrases(table, empty, items):
    docs.same(phrases.digest(table, items).collect(), plain.phrase_rows(docs.pairs(table), [tuple(r) for r in items.collect()]))
    assert phrases.digest(empty, items).collect() == []
    none = phrases.digest(table, items.limit(0)).collect()
    assert len(none) == table.count() and not any(r.contaminated for r in none)


def test_phrases_in_blocks_of_items(table, items):
    docs.same(phrases.matches(table, items, block_bytes=400).select("doc_id", "n_hit", "items").collect(),
              phrases.matches(table, items).select("doc_id", "n_hit", "items").collect())


def test_clean_documents_keep_their_columns(table, items):
    clean = phrases.clean_documents(table, items)
    docs.same(docs.pairs(phrases.clean_documents(table, items, block_bytes=400)), docs.pairs(clean))
    assert phrases.clean_documents(table, items.limit(0)).count() == table.count()
    hit = {r[0] for r in plain.phrase_rows(docs.pairs(table), [tuple(r) for r in items.collect()]) if r[-1] and r[0] is not None}
    assert clean.columns == table.columns
    assert {r.doc_id for r in clean.collect() if r.doc_id is not None} == {r.doc_id for r in table.collect() if r.doc_id is not None} - hit


def test_words_near_each_other(spark):
    table = spark.createDataFrame([(1, "alpha x beta y gamma"), (2, "gamma z z z z z z z alpha beta"), (3, None)], "doc_id long, text string")
    some = phrases.Phrases.of([("p", "alpha beta gamma")])
    index = phrases.postings(table, some.vocabulary)
    counts = phrases.term_counts(index, len(some.vocabulary))
    assert [r.doc_id for r in phrases.search(index, some, counts, slop=4).collect()] == [1]
    assert phrases.search(index, some, counts).collect() == []


def test_fingerprints_and_components(table, empty):
    rows = docs.pairs(table)
    prints = [plain.fingerprint(text) for _, text in rows]
    roots = plain.linked(prints)
    lowest = {}
    for (i, _), root in zip(rows, roots):
        if i is not None:
            lowest[root] = min(i, lowest.get(root, i))
    expected = [(i, f"{p:016x}", lowest.get(root)) for (i, _), p, root in zip(rows, prints, roots)]
    docs.same(anchors.near_duplicates(table).collect(), expected)
    assert anchors.near_duplicates(empty).collect() == []


def test_links_of_many_close_fingerprints(spark):
    rng = np.random.default_rng(4)
    base = rng.integers(0, 1 << 63, 40, dtype=np.uint64)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, rng.integers(0, 7), replace=False)) for _ in range(3000)], np.uint64)
    prints = np.unique(np.concatenate([base, base[rng.integers(0, 3, 3000)] ^ flips]))
    frame = spark.createDataFrame([(int(p),) for p in prints.view(np.int64)], "fp long")
    expected = plain.linked(prints)
    for cell_size in (anchors.CELL, 50):
        found = anchors.links(frame, cell_size=cell_size).collect()
        place = {int(p): k for k, p in enumerate(prints.view(np.int64))}
        parent = list(range(len(prints)))

        def root(k):
            while parent[k] != k:
                k = parent[k]
            return k

        for a, b in ((place[r.a], place[r.b]) for r in found):
            x, y = sorted((root(a), root(b)))
            parent[y] = x
        assert [root(k) for k in range(len(prints))] == expected
        assert cell_size == 50 or len(found) < 45 * len(prints)


def test_anchors_cover_every_close_pair():
    rng = np.random.default_rng(1)
    x = rng.integers(0, 1 << 63, 2000, dtype=np.uint64)
    y = x ^ np.array([sum(1 << int(b) for b in rng.choice(64, 5, replace=False)) for _ in x], np.uint64)
    met = np.zeros(len(x), bool)
    for block in range(3):
        which, cells = anchors.visits(y, block)
        met[which[cells == anchors.home(x, block)[which]]] = True
    assert met.all()


def test_one_of_each_group_stays(table):
    kept = anchors.first_of_each(table)
    ids = [r.doc_id for r in kept.collect() if r.doc_id is not None]
    firsts = {r.component_id for r in anchors.near_duplicates(table).collect()} - {None}
    assert kept.columns == table.columns and sorted(ids) == sorted(firsts)


def test_personal_base_spans(table):
    rng = random.Random(6)
    for alphabet in ("0123456789" * 2 + ".....@@--++  ()aZ_%é\n", "0123456789" * 4 + " -"):
        for _ in range(3000):
            text = "".join(rng.choice(alphabet) for _ in range(rng.randint(0, 60)))
            assert personal.base_spans(text) == plain.base_spans(text)
    for long in ("1" * 200_000, ".1" * 100_000, "+1(" * 60_000, "a" * 200_000 + "@" * 1000):
        personal.base_spans(long)


def test_personal_digest(table, empty):
    classifier = personal.learn(table)
    got = personal.digest(table, classifier, keep=["doc_id"]).collect()
    expected = []
    for i, text in docs.pairs(table):
        base = plain.base_spans(text)
        flat = ",".join(f"{kind}:{a}:{b}" for kind in personal.KINDS for a, b in base[kind])
        expected.append((i, *[len(base[kind]) for kind in personal.KINDS], plain.sha(flat)))
        mine = [r for r in got if (r.doc_id, r.base_sha256) == (i, plain.sha(flat))]
        assert mine and set(flat.split(",")) - {""} <= set(mine[0].spans.split(","))
    docs.same([tuple(r)[:-1] for r in got], expected)
    assert personal.digest(empty, personal.learn(empty)).collect() == []


def test_personal_spans_are_added_and_masked(spark):
    rng = random.Random(1)
    texts = [f"contact us {chr(97 + k % 26)}b@mail{k}.example.com or card {4111111111111111 if k % 2 else 4111111111111112} at 10.0.{k}.7" for k in range(60)]
    texts += [f"my e-mail: joe{k} [at] example [dot] org" for k in range(3)]
    rng.shuffle(texts)
    table = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    classifier = personal.learn(table)
    base, spans = classifier.spans("write to jane [at] example [dot] com, not 10.20.30.40")
    assert base["email"] == [] and ("email", 9, 36) in spans and ("ip", 42, 53) in spans
    assert classifier.spans("order 4111111111111112")[1] == []
    assert personal.masked("write to a@b.co now", classifier.spans("write to a@b.co now")[1]) == "write to <email> now"
    assert personal.mask(table, classifier).columns == ["doc_id", "text"]


def test_piece_counts(table, empty):
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    expected = [(i, len((t or "").encode()), len(model.encode(t or "")), len(model.encode(t or "")) > 4096) for i, t in docs.pairs(table)]
    docs.same(transducer.count_tokens(table, PIECES, keep=["doc_id"]).collect(), expected)
    assert transducer.count_tokens(empty, PIECES).collect() == []
    kept = transducer.count_tokens(table, PIECES)
    assert kept.columns == [*table.columns, "n_bytes", "n_tokens", "over_limit"]


def test_chunks_compose_wherever_they_are_cut():
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    machine = transducer.Transducer(transducer.Vocabulary.load(PIECES))
    rng = random.Random(3)
    for _ in range(1500):
        text = "".join(rng.choice("abcdehlot  \n\t\r{}();>_▁éß丝ħ🙂<s/>'1290    ") for _ in range(rng.randint(1, 40)))
        marked = "▁" + text.replace(" ", "▁")
        cuts = [0, *sorted(rng.randint(0, len(marked)) for _ in range(4)), len(marked)]
        spans = [transducer.describe(machine, marked[a:b]) for a, b in zip(cuts, cuts[1:])]
        assert transducer.scan(machine, spans) == len(model.encode(text))


def test_word_encoding(table, empty):
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(WORDS)
    expected = []
    for i, text in docs.pairs(table):
        ids = library.encode(text or "", add_special_tokens=False).ids
        expected.append((i, len(ids), plain.sha(" ".join(map(str, ids))), plain.sha(library.decode(ids, skip_special_tokens=False))))
    docs.same(speculative.digest(table, WORDS, keep=["doc_id"]).collect(), expected)
    assert speculative.digest(empty, WORDS).collect() == []
    full = speculative.encode(table, WORDS, keep=["doc_id"]).collect()
    coder = speculative.Encoder(speculative.Model.load(WORDS))
    assert all(coder.decode(r.ids) == r.decoded for r in full)


def test_word_encoding_of_odd_characters():
    from tokenizers import Tokenizer

    library, coder = Tokenizer.from_file(WORDS), speculative.Encoder(speculative.Model.load(WORDS))
    rng = random.Random(1)
    parts = [*"abcdehlotSTΣσςİıẞǅ  \n\t\r{}();>_éÉ丝🙂\x00'12½²\x85\x1c\x0bﬁ한하", "'s", "'LL", "<|startoftext|>", "<|endoftext|>", "é", "Å", "नि", "the", "tion"]
    texts = ["".join(rng.choice(parts) for _ in range(rng.randint(0, 30))) for _ in range(4000)]
    for text, (n, ids, decoded) in zip(texts, coder.encode(texts)):
        right = library.encode(text, add_special_tokens=False).ids
        assert (n, ids, decoded) == (len(right), " ".join(map(str, right)), library.decode(right, skip_special_tokens=False))


def test_quality_counts(table, empty):
    got = divergence.judge(table).select("doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed").collect()
    docs.same(got, [(i, *plain.quality_counts(text)) for i, text in docs.pairs(table)])
    assert divergence.judge(empty).collect() == []


def test_quality_verdict(spark):
    rng = random.Random(8)
    prose = lambda: " ".join(rng.choice(["the", "of", "and", "to", "stone", "river", "cloud", "light", "is", "that"]) + rng.choice(["", "", str(rng.choice("xyz"))]) for _ in range(150))
    shout = " ".join(f"{w.upper()} !!" for w in prose().split())
    table = spark.createDataFrame([(k, prose(), "en") for k in range(30)] + [(90, shout, "en"), (91, shout, None), (92, "Short text of few words only, far from it all.", "en")],
                                  "doc_id long, text string, lang string")
    got = {r.doc_id: r for r in divergence.judge(table).collect()}
    assert all(got[k].kept for k in range(30)) and not got[90].kept and not got[91].kept
    assert got[92].char_distance is None and got[92].word_distance is None
    assert 0 <= got[0].char_distance < got[90].char_distance <= 1


def test_quality_of_languages_without_a_list(spark):
    rng = random.Random(4)
    speak = {"fr": ["de", "la", "et", "les", "maison", "chat", "sur", "dans", "rue"], "pl": ["jest", "się", "nie", "dom", "kot", "ulica", "że", "być"],
             "ru": ["дом", "кот", "улица", "река", "и", "не", "быть", "что"]}
    prose = lambda lang: " ".join(rng.choice(speak[lang]) + rng.choice(["", "", rng.choice(speak[lang])]) for _ in range(150))
    rows = [(lang, prose(lang)) for lang, n in (("fr", 40), ("pl", 20), ("ru", 10)) for _ in range(n)]
    rows += [("ru", "x7 #$% " * 150)] + [(None, prose("fr"))]
    table = spark.createDataFrame([(k, text, lang) for k, (lang, text) in enumerate(rows)], "doc_id long, text string, lang string")
    kept = {r.doc_id: r.kept for r in divergence.judge(table).collect()}
    assert all(kept[k] for k in range(70)) and not kept[70] and kept[71]


def test_personal_data_of_very_long_runs(spark):
    import time
    line = "10.0.0.1 555-123-4567 "
    learned = personal.Classifier({kind: np.concatenate([[9.0], np.zeros(personal.LABELERS * 2 + personal.SIZES - 1)]) for kind in personal.KINDS})
    took = {}
    for n in (5_000, 40_000):
        start = time.perf_counter()
        base, spans = learned.spans(line * n)
        took[n] = time.perf_counter() - start
        assert len(base["ip"]) == n and len(spans) >= n
        assert all(a[2] <= b[1] for a, b in zip(sorted(spans, key=lambda s: s[1]), sorted(spans, key=lambda s: s[1])[1:]))
    assert took[40_000] < 30 * took[5_000]
