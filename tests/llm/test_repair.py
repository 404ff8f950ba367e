"""Conversation repair against the contract written plainly."""

import itertools
import random
import re
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from tallyline.llm import repair
from tests.llm import docs

INK = re.compile(r"[^\x20\x09-\x0D]")
GOOD = re.compile(r"(s?(ua)+)?")


def plain_edits(rows):
    """The cheapest, then ASCII-least edits of (role, text, fault) rows, by whole lists of them."""
    best = {"": (0, "", [])}          # by the state: what has been written lately

    def inserted(found):
        for _ in range(3):
            for state, (cost, audit, lines) in list(found.items()):
                role = "assistant" if state == "u" else "user"
                new = (cost + 3, audit + "I", [*lines, f"{role}:"])
                found[role[0]] = min(found.get(role[0], new), new, key=lambda x: x[:2])
        return found

    for role, text, fault in rows:
        after = {}
        for state, (cost, audit, lines) in inserted(best).items():
            ways = [(state, 4, "D", None)]
            if fault not in ("blank", "duplicate"):
                more = 3 * (fault == "truncated")
                follows = {"": "su", "s": "u", "u": "a", "a": "u"}[state]
                if role[:1] and role[0] in follows:
                    ways.append((role[0], more, "K", role))
                ways += [(new[0], 3 + more, "R", new) for new in ("user", "assistant") if new[0] in follows]
            for to, more, edit, new in ways:
                made = (cost + more, audit + edit, lines if new is None else [*lines, f"{new}:{text}"])
                after[to] = min(after.get(to, made), made, key=lambda x: x[:2])
        best = after
    if not rows:
        return 0, "", []
    return min((way for state, way in inserted(best).items() if state in ("", "a")), key=lambda x: x[:2])


def plain_report(rows):
    groups = {}
    for conv, turn, role, text in rows:
        out = groups.setdefault(conv, [])
        show = lambda v: " " if v is None else str(v)
        code = zlib.crc32(f"{show(conv)}:{show(turn)}".encode()) % 20
        role, text = show(role), show(text)
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        role = "user" if code == 4 else role
        out += [(turn, role, text)] * (0 if code == 0 else 2 if code == 3 else 1)
    made = []
    for conv, some in groups.items():
        some.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, lines = set(), []
        for _, role, text in some:
            ink = INK.findall(text)
            fault = "blank" if not ink else "duplicate" if (role, text) in seen else "truncated" if ink[-1] not in ".!?" else ""
            seen.add((role, text))
            lines.append((role, text, fault))
        turns = [t for t, _, _ in some if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0][:1] + b[0][:1] not in ("su", "ua", "au") for a, b in itertools.pairwise(lines))
        cost, audit, fixed = plain_edits(lines)
        count = lambda f: sum(x[2] == f for x in lines)  # noqa: E731,B023
        made.append((conv, gaps, count("blank"), count("duplicate"), count("truncated"), illegal, cost, audit,
                     sha256("\n".join(fixed).encode()).hexdigest()))
    return made


def some_rows(seed=4, conversations=60):
    rng, rows = random.Random(seed), []
    for conv in [*range(conversations), None]:
        turn = 0
        for k in range(rng.choice([0, 1, 2, 4, 8, 15])):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None])
            if rng.random() < 0.6:
                role = "user" if k % 2 == 0 else "assistant"
            text = rng.choice(["Hello there.", "Fine!", "What", "", " \t", None, "same. ", "ünïcode?", f"no {rng.randint(0, 3)}.", "line\ntwo.\n"])
            rows.append((conv, None if rng.random() < 0.05 else turn, role, text))
            turn += rng.choice([0, 1, 1, 1, 2])
    return rows + rows[3:9] + [(1000, 5, "user", "x.")] * 40


SCHEMA = "conv_id long, turn long, role string, text string"


def report(made):
    return [(r.conv_id, r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in made.collect()]


@pytest.mark.parametrize("seed", [4, 5])
def test_report(spark, seed):
    rows = some_rows(seed)
    docs.same(report(repair.report(spark.createDataFrame(rows, SCHEMA).repartition(3).withColumn("key", F.lit("x")))), plain_report(rows))


def test_conversations_in_many_pieces(spark):
    rng = random.Random(8)
    rows = [(7, t, rng.choice(["user", "assistant", "system"]), rng.choice(["Yes.", "No.", f"{t}.", f"{t}", ""])) for t in range(900)]
    rows += some_rows(6, 20)
    table = repair.damage(spark.createDataFrame(rows, SCHEMA).repartition(3))
    for shuffle, held in (("4", 5), ("13", 4096), ("13", 50)):
        before = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", shuffle)
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
        try:
            edits, found = repair.repair(table, held_rows=held)
            docs.same(report(found), plain_report(rows))
            lines = edits.where("conv_id = 7").orderBy("part", "at", "step").collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)
            spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
        expected = next(r for r in plain_report(rows) if r[0] == 7)
        assert "".join(r.edit * r.copies for r in lines) == expected[7]
        kept = [f"{r.role}:{r.text}" for r in lines if r.role is not None]
        assert sha256("\n".join(kept).encode()).hexdigest() == expected[8]
        assert GOOD.fullmatch("".join(r.role[0] for r in lines if r.role is not None))


def test_least_edits_by_trying_all():
    rng = random.Random(2)
    faults = {"": repair.FINE, "blank": repair.BLANK, "duplicate": repair.DUPLICATE, "truncated": repair.CUT_OFF}
    costs = {"K": 0, "R": 3, "D": 4, "I": 3}

    def run(audit, rows):
        """Cost of a list of edits, or None where it is not allowed."""
        written, at, cost = "", 0, 0
        for edit in audit:
            cost += costs[edit]
            if edit == "I":
                written += "a" if written.endswith("u") else "u"
                continue
            if at == len(rows):
                return None
            role, fault = rows[at]
            at += 1
            if edit == "D":
                continue
            if fault in ("blank", "duplicate"):
                return None
            cost += 3 * (fault == "truncated")
            if edit == "K" and not role:
                return None
            written += role[0] if edit == "K" else "a" if written.endswith("u") else "u"
        return cost if at == len(rows) and GOOD.fullmatch(written) else None

    for _ in range(25):
        rows = [(rng.choice(["user", "assistant", "system", "other"]), rng.choice(list(faults))) for _ in range(rng.randint(1, 4))]
        found = [(run(a, rows), "".join(a)) for n in range(len(rows), len(rows) + 4) for a in itertools.product("DIKR", repeat=n)]
        cost, audit = min(x for x in found if x[0] is not None)
        assert repair.solve(bytes(repair.row_code(r[:1], faults[f]) for r, f in rows))[0] == cost
        assert "".join(repair.solve(bytes(repair.row_code(r[:1], faults[f]) for r, f in rows))[1]) == audit


def test_halves_meet_whatever_the_length():
    rng = random.Random(9)
    for n in (33, 100, 1000):
        rows = [(rng.choice(["user", "assistant", "system", "other"]), "x", rng.choice(["", "", "", "truncated", "blank", "duplicate"])) for _ in range(n)]
        faults = {"": 0, "blank": 1, "duplicate": 2, "truncated": 3}
        cost, found = repair.solve(bytes(repair.row_code(r[:1], faults[f]) for r, _, f in rows))
        assert (cost, "".join(found)) == plain_edits(rows)[:2]


def test_empty(spark):
    assert repair.report(spark.createDataFrame([], SCHEMA)).collect() == []
