"""Least-cost repair of conversations by divide and conquer.

The rows of a conversation, in the order of their turns, are edited until their roles read
``(s?(ua)+)?``: an optional system message, then user and assistant in turn. Each row is
kept (0), given the other role (3) or deleted (4); rows with an empty text may be inserted
anywhere (3). Blank rows and repeated ones (role and text seen earlier) must go, and a
truncated row that stays adds 3. Of the cheapest ways the one whose list of edits
(``K``, ``R``, ``D``, ``I``) is least in ASCII is taken.

Where the output stands is one of four states: nothing yet, after a system message, after
a user, after an assistant. An edit leads from a state to one other, so a list of edits
names its states. For a stretch of rows, forward costs from its first state and backward
costs to its last one meet in the middle; of the states with the least sum the one whose
edits up to there are least is crossed, and both halves are solved in the same way. What
is kept is one vector of four costs for each half. With the costs goes the order of the
four least lists of edits, which is all that later rows need to break ties. Vectors less
their minimum are few, so a step is a look-up.

Rows are cut into ranges by conversation, turn, role and text, and a task solves the
conversations that lie inside its range. One that crosses a border, or is too large to
hold, leaves the costs between any two states of its piece; pieces of a conversation are
joined (at most one for each range), which gives each piece its first and last state, and
the pieces are solved side by side. So no task holds a conversation's texts, however long.
Only its SHA-256, which is sequential by definition, is taken by one task that reads the
rows in order without holding them.

Equal rows are counted before anything is sent, and of rows repeated on the same turn the
first may stay. Rows with equal turns are ordered by role, then text; a NULL turn comes
first; a NULL text or role is one space. The NULL conversation is one like any other. A
conversation without rows after damage has an empty list. Extra columns are left out. An
empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache
from hashlib import sha256

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyline.llm.tables import stored
from tallyline.llm.texts import SPACES, bounded_batches

KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 3, 4, 3, 3
NOTHING, SYSTEM, USER, ASSISTANT = range(4)
#: The state after one more user or assistant.
NEXT = (USER, USER, ASSISTANT, USER)
NAMES = {USER: "user", ASSISTANT: "assistant"}
#: Faults of a row, the first that applies.
FINE, BLANK, DUPLICATE, CUT_OFF = range(4)
NEVER = 1 << 40
#: Rows and characters of one conversation that a task holds; a larger one is solved in pieces.
HELD_ROWS, HELD_CHARS = 4096, 4 << 20
#: Initials of the roles that follow each other in a sound conversation.
LEGAL = {"su", "ua", "au"}


# -- the least-cost edits of one conversation ------------------------------------------------


def row_code(initial: str, fault: int) -> int:
    """What the edits of a row depend on: its role's initial and its fault."""
    kind = "sua".find(initial) if initial else -1
    return (3 if kind < 0 else kind) | (fault in (BLANK, DUPLICATE)) << 2 | (fault == CUT_OFF) << 3


def _steps(code: int, state: int) -> dict[int, tuple[int, str]]:
    """For each state after a row: the least cost and the least edits that lead there."""
    kind, must_go, cut_off = code & 3, code >> 2 & 1, code >> 3
    found: dict[int, tuple[int, str]] = {}

    def add(to: int, cost: int, edits: str) -> None:
        found[to] = min(found.get(to, (NEVER, "")), (cost, edits))

    for inserted in range(3):
        before, cost = "I" * inserted, INSERT * inserted
        add(state, cost + DELETE, before + "D")
        if not must_go:
            stays = cost + TRUNCATED * cut_off
            add(NEXT[state], stays + REROLE, before + "R")
            if kind == 0 and state == NOTHING:
                add(SYSTEM, stays + KEEP, before + "K")
            elif kind in (1, 2) and NEXT[state] == (USER, ASSISTANT)[kind - 1]:
                add(NEXT[state], stays + KEEP, before + "K")
        state = NEXT[state]
    return found


STEPS = [[_steps(code, state) for state in range(4)] for code in range(16)]
#: Inserts after the last row that lead from each state to an end.
ENDING = ("", "II", "I", "")

#: (cost less the least, order of the edits) of the four states; NEVER where a state is out of reach.
Vector = tuple[tuple[int, int], ...]


@lru_cache(1 << 16)
def _forward(vector: Vector, code: int) -> tuple[int, Vector]:
    best: dict[int, tuple] = {}
    for state, (cost, order) in enumerate(vector):
        if cost < NEVER:
            for to, (more, edits) in STEPS[code][state].items():
                best[to] = min(best.get(to, (NEVER,)), (cost + more, order, edits))
    least = min(cost for cost, _, _ in best.values())
    places = {to: k for k, to in enumerate(sorted(best, key=lambda to: best[to][1:]))}
    return least, tuple((best[to][0] - least, places[to]) if to in best else (NEVER, 0) for to in range(4))


@lru_cache(1 << 16)
def _backward(vector: tuple[int, ...], code: int) -> tuple[int, tuple[int, ...]]:
    costs = [min((more + vector[to] for to, (more, _) in STEPS[code][state].items()), default=NEVER) for state in range(4)]
    least = min(costs)
    return least, tuple(NEVER if cost >= NEVER else cost - least for cost in costs)


def forward(codes: bytes, start: int) -> tuple[int, Vector]:
    """(least cost, vector) after all rows, beginning in one state."""
    total, vector = 0, tuple((0, 0) if state == start else (NEVER, 0) for state in range(4))
    for code in codes:
        more, vector = _forward(vector, code)
        total += more
    return total, vector


def backward(codes: bytes, end: int) -> tuple[int, ...]:
    """Cost of reaching one state after all rows from each of the four, less the least."""
    vector = tuple(0 if state == end else NEVER for state in range(4))
    for code in reversed(codes):
        vector = _backward(vector, code)[1]
    return vector


def edits(codes: bytes, start: int, end: int) -> list[str]:
    """The least-cost, then least, edits of each row between two states."""
    if len(codes) < 2:
        return [STEPS[code][start][end][1] for code in codes]
    middle = len(codes) // 2
    before = forward(codes[:middle], start)[1]
    after = backward(codes[middle:], end)
    crossing = min(range(4), key=lambda state: (before[state][0] + after[state], before[state][1]))
    return edits(codes[:middle], start, crossing) + edits(codes[middle:], crossing, end)


def last_state(vector: Vector) -> int:
    """The state after the last row from which the cheapest, then least, edits end."""
    return min(range(4), key=lambda state: (vector[state][0] + INSERT * len(ENDING[state]), vector[state][1]))


@lru_cache(1 << 12)
def _short(codes: bytes) -> tuple[int, tuple[str, ...]]:
    return _solve(codes)


def _solve(codes: bytes) -> tuple[int, tuple[str, ...]]:
    total, vector = forward(codes, NOTHING)
    end = last_state(vector)
    found = edits(codes, NOTHING, end)
    if found:
        found[-1] += ENDING[end]
    return total + vector[end][0] + INSERT * len(ENDING[end]), tuple(found)


def solve(codes: bytes) -> tuple[int, tuple[str, ...]]:
    """(cost, edits of each row) of a whole conversation."""
    return _short(codes) if len(codes) <= 32 else _solve(codes)


def roles_of(found: list[str] | tuple[str, ...], roles: list[str], start: int = NOTHING) -> Iterator[tuple[int, str, str | None]]:
    """(row, edit, role written) of every edit; a deleted row has no role."""
    state = start
    for row, some in enumerate(found):
        for edit in some:
            if edit == "D":
                yield row, edit, None
            elif edit == "K":
                state = SYSTEM if roles[row][:1] == "s" else NEXT[state]
                yield row, edit, roles[row]
            else:
                state = NEXT[state]
                yield row, edit, NAMES[state]


# -- rows, faults and order ---------------------------------------------------------------------


def damage(conversations: DataFrame) -> DataFrame:
    """(conv_id, turn, role, text, n): the rows after damage, each with the number of its copies.

    By ``crc32(conv_id:turn) % 20``: 0 drops the row, 1 empties its text, 2 removes its full
    stops, exclamation and question marks, 3 repeats it, 4 makes its role ``user``. A dropped
    row leaves its conversation's id with n = 0.
    """
    words = {name: F.coalesce(F.col(name).cast("string"), F.lit(" ")) for name in ("conv_id", "turn", "role", "text")}
    code = F.crc32(F.concat(words["conv_id"], F.lit(":"), words["turn"]).cast("binary")) % 20
    text = F.when(code == 1, "").when(code == 2, F.translate(words["text"], ".!?", "")).otherwise(words["text"])
    rows = conversations.select(
        "conv_id", F.when(code != 0, F.col("turn").cast("long")).alias("turn"),
        F.when(code != 0, F.when(code == 4, "user").otherwise(words["role"])).alias("role"),
        F.when(code != 0, text).alias("text"), F.when(code == 0, 0).when(code == 3, 2).otherwise(1).alias("copies"))
    return rows.groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("n"))


def _faults(rows: DataFrame) -> DataFrame:
    """``rows`` (equal ones counted) with ``fault``, that of the first copy."""
    spaces = SPACES.decode()
    shown = F.rtrim(F.col("text"), F.lit(spaces))
    blank = F.trim(F.col("text"), F.lit(spaces)) == ""
    conv = F.col("conv_id").cast("string")
    said = F.md5(F.concat(
        F.coalesce(F.length(conv).cast("string"), F.lit("n")), F.lit(":"), F.coalesce(conv, F.lit("")),
        F.length("role").cast("string"), F.lit(":"), "role", "text"))
    when = F.struct(F.col("turn").isNotNull().alias("known"), F.col("turn").alias("turn"))
    # Blank rows repeat nothing; a key of their own spreads them over the tasks of the join.
    alone = F.concat(F.lit("-"), F.xxhash64("conv_id", "turn", "role", "text").cast("string"))
    rows = rows.withColumns({"said": F.when(~blank, said).otherwise(alone), "when": when})
    first = rows.where(~F.startswith("said", F.lit("-"))).groupBy("said").agg(F.min("when").alias("first"), F.count("*").alias("times"))
    first = first.where("times > 1").drop("times")        # seen on several turns
    fault = (F.when(blank, BLANK).when(F.col("when") > F.col("first"), DUPLICATE)
             .when(~F.right(shown, F.lit(1)).isin(".", "!", "?"), CUT_OFF).otherwise(FINE))
    return rows.join(first, "said", "left").withColumn("fault", F.when(F.col("role").isNotNull(), fault)).drop("said", "when", "first")


# -- one task: the conversations of a range ----------------------------------------------------------

_SUMS = ("open boolean, rows long, blank long, duplicate long, truncated long, illegal long, low long, high long, turns long, "
         "first string, last string, cost long, audit string, repaired_sha256 string, costs array<long>, orders array<int>")


def _solved_schema(conv: T.StructField) -> T.StructType:
    fields = T.StructType.fromDDL(
        "part int, piece int, at long, step int, open boolean, edit string, copies long, turn long, role string, "
        "old_role string, text string, fault int")
    return T.StructType([T.StructField("conv_id", conv.dataType, True), *fields, T.StructField("whole", T.StructType.fromDDL(_SUMS), True)])


class _Conversation:
    """What is gathered of one conversation while its rows pass by."""

    def __init__(self, conv_id):
        self.conv_id, self.codes, self.held, self.chars = conv_id, bytearray(), [], 0
        self.sums = dict(rows=0, blank=0, duplicate=0, truncated=0, illegal=0, low=None, high=None, turns=0, first=None, last=None)
        self.extra = 0

    def add(self, at, turn, role, text, n, fault) -> None:
        sums, initial = self.sums, role[:1]
        self.held.append((at, turn, role, text, n, fault))
        self.chars += len(text)
        self.codes.append(row_code(initial, fault))
        self.extra += n - 1
        if sums["rows"]:
            sums["illegal"] += sums["last"] + initial not in LEGAL
        else:
            sums["first"] = initial
        sums["illegal"] += (n - 1) * (initial * 2 not in LEGAL)
        sums["last"] = initial
        sums["rows"] += n
        sums["blank"] += n if fault == BLANK else 0
        sums["duplicate"] += (n - 1 if fault != BLANK else 0) + (fault == DUPLICATE)
        sums["truncated"] += fault == CUT_OFF
        if turn is not None:
            sums["turns"] += turn != sums["high"]
            sums["low"] = turn if sums["low"] is None else sums["low"]
            sums["high"] = turn


def _solve_range(rows: Iterator[tuple], part: int, held_rows: int, held_chars: int) -> Iterator[dict]:
    """Edits of the conversations inside a sorted range, rows and costs of those that may go on outside."""
    now: _Conversation | None = None
    piece = -1
    loose = False

    def base(conv, **more):
        return {"conv_id": conv.conv_id, "part": part, "piece": piece, **more}

    def give_loose(conv):
        for at, turn, role, text, n, fault in conv.held:
            yield base(conv, at=at, step=0, open=True, copies=n, turn=turn, role=None, old_role=role, text=text, fault=fault)
        conv.held, conv.chars = [], 0

    def close(conv, open_):
        codes = bytes(conv.codes)
        if open_:
            yield from give_loose(conv)
            costs, orders = matrix(codes)
            yield base(conv, open=True, whole={"open": True, **conv.sums, "cost": (conv.extra) * DELETE, "costs": costs, "orders": orders})
            return
        cost, found = solve(codes)
        digest, audit, first = sha256(), [], True
        roles = [row[2] for row in conv.held]
        steps = [0] * len(roles)
        waiting = [row[4] - 1 for row in conv.held]

        def extra(row):
            if waiting[row]:
                audit.append("D" * waiting[row])
                at, turn, role, text, _, fault = conv.held[row]
                yield base(conv, at=at, step=3, open=False, edit="D", copies=waiting[row], turn=turn, role=None, old_role=role, text=text,
                           fault=BLANK if fault == BLANK else DUPLICATE)
                waiting[row] = 0

        for row, edit, role in roles_of(found, roles):
            at, turn, old, text, _, fault = conv.held[row]
            own = edit != "I"
            if not own and steps[row] and found[row][:steps[row]].strip("I"):   # inserts after the last row follow its copies
                yield from extra(row)
            audit.append(edit)
            if role is not None:
                digest.update(f"{'' if first else chr(10)}{role}:{text if own else ''}".encode("utf-8", "surrogatepass"))
                first = False
            place = steps[row] if not found[row][:steps[row]].strip("I") else steps[row] + 3
            yield base(conv, at=at, step=place, open=False, edit=edit, copies=1, turn=turn if own else None, role=role,
                       old_role=old if own else None, text=text if own else "", fault=fault if own else None)
            steps[row] += 1
            if steps[row] == len(found[row]):
                yield from extra(row)
        yield base(conv, open=False, whole={"open": False, **conv.sums, "cost": cost + conv.extra * DELETE,
                                            "audit": "".join(audit), "repaired_sha256": digest.hexdigest()})

    for at, (conv_id, turn, role, text, n, fault) in enumerate(rows):
        if now is None or conv_id != now.conv_id:
            if now is not None:
                yield from close(now, loose)
            loose = now is None              # the first may have begun in an earlier range
            now, piece = _Conversation(conv_id), piece + 1
        if n:
            now.add(at, turn, role, text, n, fault)
            if len(now.held) > held_rows or now.chars > held_chars:
                loose = True
                yield from give_loose(now)
    if now is not None:
        yield from close(now, True)          # the last may go on in a later range


def matrix(codes: bytes) -> tuple[list[int], list[int]]:
    """Costs between any two states over a stretch of rows, and for each first state the order of the edits."""
    costs, orders = [], []
    for start in range(4):
        total, vector = forward(codes, start)
        costs += [min(total + cost, NEVER) for cost, _ in vector]
        orders += [order for _, order in vector]
    return costs, orders


def join_pieces(pieces: list[dict]) -> tuple[dict, list[tuple[int, int]]]:
    """The sums of a conversation in pieces, and the first and last state of each piece."""
    out = dict(rows=0, blank=0, duplicate=0, truncated=0, illegal=0, low=None, high=None, turns=0, cost=0, last=None)
    vector = {NOTHING: (0, 0)}
    back: list[dict[int, int]] = []
    for piece in pieces:
        for name in ("rows", "blank", "duplicate", "truncated", "illegal", "turns", "cost"):
            out[name] += piece[name]
        if piece["low"] is not None:
            out["turns"] -= piece["low"] == out["high"]
            out["low"], out["high"] = piece["low"] if out["low"] is None else out["low"], piece["high"]
        if piece["first"] is not None:
            if out["last"] is not None:
                out["illegal"] += out["last"] + piece["first"] not in LEGAL
            out["last"] = piece["last"]
        best: dict[int, tuple] = {}
        if piece["rows"]:
            for state, (cost, order) in vector.items():
                for to in range(4):
                    more = piece["costs"][4 * state + to]
                    if more < NEVER:
                        best[to] = min(best.get(to, (NEVER,)), (cost + more, order, piece["orders"][4 * state + to], state))
        else:
            best = {state: (cost, order, 0, state) for state, (cost, order) in vector.items()}
        places = {to: k for k, to in enumerate(sorted(best, key=lambda to: best[to][1:3]))}
        back.append({to: best[to][3] for to in best})
        vector = {to: (best[to][0], places[to]) for to in best}
    state = min(vector, key=lambda to: (vector[to][0] + INSERT * len(ENDING[to]), vector[to][1])) if out["rows"] else NOTHING
    out["cost"] += vector[state][0] + (INSERT * len(ENDING[state]) if out["rows"] else 0)
    ends = []
    for came in reversed(back):
        ends.append((came[state], state))
        state = came[state]
    return out, ends[::-1]


# -- on Spark ---------------------------------------------------------------------------------------


def _arrow(schema: T.StructType) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(schema)


def _tables(made: Iterator[dict], schema: pa.Schema, rows: int = 2000) -> Iterator[pa.RecordBatch]:
    some: list[dict] = []
    for row in made:
        some.append(row)
        if len(some) >= rows:
            yield pa.RecordBatch.from_pylist(some, schema)
            some = []
    if some:
        yield pa.RecordBatch.from_pylist(some, schema)


def _solved(rows: DataFrame, held_rows: int, held_chars: int) -> DataFrame:
    """Edits of whole conversations, rows of those in pieces, and one row of sums for each of both."""
    order = [F.col(c).asc_nulls_first() for c in ("conv_id", "turn", "role", "text")]
    rows = _faults(rows).select("conv_id", "turn", "role", "text", "n", "fault").repartitionByRange(*order).sortWithinPartitions(*order)
    schema = _solved_schema(rows.schema["conv_id"])
    arrow = _arrow(schema)
    bounded_batches(rows.sparkSession)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        lines = (line for batch in batches for line in zip(*(column.to_pylist() for column in batch.columns)))
        yield from _tables(_solve_range(lines, part, held_rows, held_chars), arrow)

    return stored(rows.mapInArrow(run, schema), "solved")


def _joined(solved: DataFrame) -> DataFrame:
    """(conv_id, the sums, and for each piece part, piece, start, end, final) of conversations in pieces."""
    conv = solved.schema["conv_id"]
    schema = T.StructType([T.StructField("conv_id", conv.dataType, True), *T.StructType.fromDDL(
        "part int, piece int, start int, end int, final boolean, rows long, blank long, duplicate long, truncated long, illegal long, low long, high long, turns long, cost long")])
    arrow = _arrow(schema)

    def join(key: tuple, table: pa.Table) -> pa.Table:
        pieces = sorted(table.to_pylist(), key=lambda row: row["part"])
        sums, ends = join_pieces([row["whole"] for row in pieces])
        sums.pop("last")
        filled = [k for k, row in enumerate(pieces) if row["whole"]["rows"]]
        last = filled[-1] if filled else len(pieces) - 1
        return pa.Table.from_pylist([{"conv_id": row["conv_id"], "part": row["part"], "piece": row["piece"], "start": a, "end": b,
                                      "final": k == last, **sums} for k, (row, (a, b)) in enumerate(zip(pieces, ends))], arrow)

    pieces = solved.where("whole IS NOT NULL AND whole.open").select("conv_id", "part", "piece", "whole")
    return stored(pieces.groupBy("conv_id").applyInArrow(join, schema), "joined")


def _pieces_solved(solved: DataFrame, joined: DataFrame) -> DataFrame:
    """The edits of conversations in pieces; what one task holds of a piece is a few numbers a row."""
    rows = solved.where("whole IS NULL AND open").join(joined.select("part", "piece", "start", "end", "final"), ["part", "piece"])
    small = rows.select("part", "piece", "at", F.coalesce(F.col("old_role"), F.lit("")).alias("role"), "fault", "start", "end", "final")
    schema = T.StructType.fromDDL("part int, at long, step int, edit string, role string")
    arrow = _arrow(schema)

    def run(key: tuple, table: pa.Table) -> pa.Table:
        table = table.sort_by("at")
        roles, at = table.column("role").to_pylist(), table.column("at").to_pylist()
        codes = bytes(row_code(role[:1], fault) for role, fault in zip(roles, table.column("fault").to_pylist()))
        start, end, final = (table.column(name)[0].as_py() for name in ("start", "end", "final"))
        found = edits(codes, start, end)
        if final:
            found[-1] += ENDING[end]
        out, steps, own = [], [0] * len(at), [False] * len(at)
        for row, edit, role in roles_of(found, roles, start):
            out.append({"part": key[0].as_py(), "at": at[row], "step": steps[row] + 3 * own[row], "edit": edit, "role": role})
            steps[row] += 1
            own[row] = own[row] or edit != "I"
        return pa.Table.from_pylist(out, arrow)

    made = stored(small.groupBy("part", "piece").applyInArrow(run, schema), "pieces")
    texts = rows.select("conv_id", "part", "at", F.col("copies").alias("n"), "turn", "old_role", "text", "fault")
    own = F.col("edit") != "I"
    lines = texts.join(made, ["part", "at"])
    first = lines.select(
        "conv_id", "part", "at", "step", "edit", F.lit(1).cast("long").alias("copies"), F.when(own, F.col("turn")).alias("turn"), "role",
        F.when(own, F.col("old_role")).alias("old_role"), F.when(own, F.col("text")).otherwise("").alias("text"),
        F.when(own, F.col("fault")).alias("fault"))
    again = texts.where("n > 1").select(
        "conv_id", "part", "at", F.lit(3).alias("step"), F.lit("D").alias("edit"), (F.col("n") - 1).alias("copies"), "turn",
        F.lit(None).cast("string").alias("role"), "old_role", "text",
        F.when(F.col("fault") == BLANK, BLANK).otherwise(DUPLICATE).alias("fault"))
    return first.unionByName(again)


_REPORT = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost"]


def _gaps(low: str, high: str, turns: str) -> Column:
    return F.coalesce(F.col(high) - F.col(low) + 1 - F.col(turns), F.lit(0).cast("long")).alias("gaps")


def _digests(lines: DataFrame) -> DataFrame:
    """(conv_id, audit, repaired_sha256): one task reads the edits of a conversation in order."""
    schema = T.StructType([lines.schema["conv_id"], *T.StructType.fromDDL("audit string, repaired_sha256 string")])
    arrow = _arrow(schema)
    bounded_batches(lines.sparkSession)
    lines = lines.select("conv_id", "part", "at", "step", "edit", "copies", "role", F.when(F.col("edit") != "D", F.col("text")).alias("text"))
    lines = lines.repartition("conv_id").sortWithinPartitions("conv_id", "part", "at", "step")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def made() -> Iterator[dict]:
            now, audit, digest, first = (), [], None, True
            for batch in batches:
                columns = (batch.column(k).to_pylist() for k in (0, 4, 5, 6, 7))
                for conv_id, edit, copies, role, text in zip(*columns):
                    if now != (conv_id,):
                        if now:
                            yield {"conv_id": now[0], "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}
                        now, audit, digest, first = (conv_id,), [], sha256(), True
                    audit.append(edit * copies)
                    if edit != "D":
                        digest.update(f"{'' if first else chr(10)}{role}:{text}".encode("utf-8", "surrogatepass"))
                        first = False
            if now:
                yield {"conv_id": now[0], "audit": "".join(audit), "repaired_sha256": digest.hexdigest()}

        yield from _tables(made(), arrow)

    return lines.mapInArrow(run, schema)


def repair(rows: DataFrame, held_rows: int = HELD_ROWS, held_chars: int = HELD_CHARS) -> tuple[DataFrame, DataFrame]:
    """The edits of ``rows`` (conv_id, turn, role, text, n) and one report for each conversation.

    Edits: conv_id, part, at and step (their order), edit, copies, turn, role (as written; NULL
    for a deleted row), old_role, text, fault. The repaired conversation is what is not deleted.
    Report: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.
    """
    solved = _solved(rows, held_rows, held_chars)
    joined = _joined(solved)
    columns = ["conv_id", "part", "at", "step", "edit", "copies", "turn", "role", "old_role", "text", "fault"]
    inside = solved.where("whole IS NULL AND NOT open").select(columns)
    across = stored(_pieces_solved(solved, joined).select(columns), "across")
    closed = solved.where("whole IS NOT NULL AND NOT whole.open").select("conv_id", "whole.*").select(
        "conv_id", _gaps("low", "high", "turns"), *_REPORT[1:], "audit", "repaired_sha256")
    sums = joined.groupBy("conv_id").agg(*[F.first(c).alias(c) for c in ("low", "high", "turns", *_REPORT[1:])])
    digests = _digests(across).withColumnRenamed("conv_id", "_id")
    opened = sums.join(digests, sums.conv_id.eqNullSafe(digests["_id"]), "left").select(
        "conv_id", _gaps("low", "high", "turns"), *_REPORT[1:], F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.lit(sha256().hexdigest())).alias("repaired_sha256"))
    return inside.unionByName(across), closed.unionByName(opened)


def report(conversations: DataFrame) -> DataFrame:
    """The report of ``conversations`` after damage."""
    return repair(damage(conversations))[1]
