"""Packing against the library, plain best fit, and exact bounds."""

import itertools
import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tallyline.llm import packing
from tests.llm import docs

PATH = public_tokenizers.path("byte_bpe_50k.json")


def plain_best_fit(lengths, capacity):
    rooms, total = [], 0
    for length in sorted(lengths, reverse=True):
        fitting = [k for k, room in enumerate(rooms) if room >= length]
        if fitting:
            k = min(fitting, key=rooms.__getitem__)
            rooms[k] -= length
        else:
            rooms.append(capacity - length)
    return sorted(rooms)


@pytest.mark.parametrize("capacity", [10, 37, 100])
def test_best_fit_is_that_of_single_pieces(capacity):
    rng = random.Random(capacity)
    for _ in range(60):
        lengths = np.array([rng.randint(1, rng.choice([capacity, capacity // 2])) for _ in range(rng.randint(1, 120))])
        sequence, offset = packing.best_fit(lengths, capacity)
        used = np.bincount(sequence, lengths).astype(int)
        assert sorted(capacity - used) == plain_best_fit(lengths.tolist(), capacity)
        for k in range(len(used)):
            mine = np.flatnonzero(sequence == k)
            mine = mine[np.argsort(offset[mine])]
            assert offset[mine].tolist() == [0, *np.cumsum(lengths[mine])[:-1].tolist()]


@pytest.mark.parametrize("capacity", [7, 12, 30])
def test_weights_are_dual_feasible(capacity):
    for weights, most in packing.feasible_functions(capacity):
        best = np.zeros(capacity + 1, np.int64)      # the most that lengths of some sum can weigh
        for total in range(1, capacity + 1):
            best[total] = max(best[total - x] + weights[x] for x in range(1, total + 1))
        assert best.max() <= most


def fewest(lengths, capacity):
    """The fewest sequences, by search."""
    lengths = sorted(lengths, reverse=True)
    best = len(lengths)

    def go(k, rooms):
        nonlocal best
        if len(rooms) >= best:
            return
        if k == len(lengths):
            best = len(rooms)
            return
        for room in set(r for r in rooms if r >= lengths[k]):
            rest = list(rooms)
            rest[rest.index(room)] -= lengths[k]
            go(k + 1, rest)
        go(k + 1, [*rooms, capacity - lengths[k]])

    go(0, [])
    return best


def test_bound_is_never_above_the_fewest_and_often_equal():
    rng, met = random.Random(3), 0
    for _ in range(80):
        lengths = [rng.randint(1, 20) for _ in range(rng.randint(1, 9))]
        bound, exact = packing.lower_bound(np.bincount(lengths, minlength=21)), fewest(lengths, 20)
        assert bound <= exact
        met += bound == exact
    assert met > 70
    assert packing.lower_bound(np.bincount([11] * 6, minlength=21)) == 6       # sums alone say four
    assert packing.lower_bound(np.zeros(21, np.int64)) == 0


def expected_pieces(rows):
    tokenizer, out = Tokenizer.from_file(PATH), []
    for i, text in rows:
        ids = [*tokenizer.encode(text or "", add_special_tokens=False).ids, 2]
        first = len(ids) if len(ids) <= 1024 else len(ids) % 1024 or 1024
        begins = [0, *range(first, len(ids), 1024)]
        for k, (a, b) in enumerate(zip(begins, [*begins[1:], len(ids)])):
            out.append((i, k, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())))
    return out


def check(placed, bound=None):
    for _, group in itertools.groupby(sorted(placed, key=lambda r: (r.sequence_id, r.offset)), lambda r: r.sequence_id):
        at = 0
        for r in group:
            assert r.offset == at
            at += r.length
        assert at <= 1024


def test_pieces_and_places(spark):
    rows = [*docs.rows(), (900, "<|endoftext|>a <|endoftext|>" * 3, None, None, None, None, None), (901, "x " * 2046, None, None, None, None, None),
            (902, "x " * 2047, None, None, None, None, None), (903, "don't    '́s ½\n\n\t 漢字" * 400, None, None, None, None, None)]
    table = docs.frame(spark, rows)
    placed = packing.pack(table, PATH).collect()
    docs.same([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in placed], expected_pieces([(r[0], r[1]) for r in rows]))
    check(placed)
    made = packing.sequences(table, PATH).collect()
    assert sum(len(r.ids) for r in made) == sum(r.length for r in placed) and max(len(r.ids) for r in made) <= 1024
    assert len(made) == len({r.sequence_id for r in placed})


def test_same_ids_as_the_library_around_every_kind_of_character(spark):
    rng = random.Random(7)
    some = [chr(c) for c in [*range(0x3000), *range(0xFE00, 0x10000), *range(0x1F000, 0x1FB00)] if not 0xD800 <= c < 0xE000]
    texts = ["".join(f"{rng.choice(['a', '1', ' ', '!', chr(10), ''])}{c}{rng.choice([' ', 'b', '2', '  '])}" for c in some[k : k + 500])
             for k in range(0, len(some), 500)]
    rows = [(k, t, None, None, None, None, None) for k, t in enumerate(texts)]
    found = packing.pieces(docs.frame(spark, rows), PATH).collect()
    docs.same([(r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in found], expected_pieces([(r[0], r[1]) for r in rows]))


def test_exchange_saves_sequences_and_keeps_every_piece(spark):
    rng = random.Random(1)
    rows = [(k, rng.choice([rng.randint(1, 1024), rng.randint(300, 700), 1024])) for k in range(4000)]
    cut = spark.createDataFrame(rows, "deal long, length long")
    once = packing.place(cut, part_pieces=200, rounds=0).collect()
    more = packing.place(cut, part_pieces=200).collect()
    for placed in (once, more):
        check(placed)
        assert sorted((r.deal, r.length) for r in placed) == rows
    count = lambda placed: len({r.sequence_id for r in placed})
    bound = packing.lower_bound(np.bincount([n for _, n in rows], minlength=1025))
    assert bound <= count(more) < count(once) and count(more) <= 1.02 * bound


def test_one_hot_document_is_dealt_evenly(spark):
    rows = [(5, "same words here", None, None, None, None, None)] * 3000
    found = packing.pieces(docs.frame(spark, rows), PATH).collect()
    assert len({r.deal for r in found}) == 3000
    assert len({r.sequence_id for r in packing.pack(docs.frame(spark, rows), PATH).collect()}) == -(-3000 // (1024 // 4))


def test_empty(spark):
    assert packing.pack(docs.frame(spark, []), PATH).collect() == []
    assert packing.sequences(docs.frame(spark, []), PATH).collect() == []
