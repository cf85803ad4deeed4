"""Repair of conversation structure by Wagner-Fischer alignment to a role grammar.

Turns are aligned to target strings of role initials, ``(s?(ua)+)?``.  Edits: keep a
turn (K, 0), give it the role user or assistant (R, 2), delete it (D, 3; blank and
duplicate turns must go), insert an empty user or assistant turn (I, 2); a truncated
turn that stays adds 1.

Method.  For every feasible length of the target one table is filled, from the end,
with the least cost of aligning the remaining turns to the rest of the target.  The
cost of the best alignment so far (the incumbent) limits the lengths that are tried
and, by Ukkonen's argument, the diagonals of each table: a cell whose distance from
the diagonal alone costs more than the incumbent cannot be part of a cheapest path.
Walking forward through a table and taking the least letter that stays on a cheapest
path gives its least audit; the audits of lengths of equal cost are compared as text.

A conversation is taken in pieces of ``PIECE`` turns.  A piece starts behind one of
four points of the grammar (the beginning, behind s, behind u, behind a) and is aligned to
every feasible length of the rest of the grammar string from there; the best alignment
for each point behind the piece is kept.  This is exact: two equally dear edits of the same
turns that end at the same point never are prefixes of each other (a longer one has more
insertions), so their order stands whatever follows.  A conversation of any length thus
streams through its task in order, with one piece, four audits and four running hashes in
memory; its rows are one task's, since the SHA-256 of one repaired text runs through
it from end to end.  Equal pieces are aligned once per task (bounded cache).

Defined results: a null role or text is one space; rows without a conv_id are one conversation,
and the text of a null conv_id or turn is one space in the damage key; turns come
in the order of turn (nulls first), then role, then text; an empty table gives an empty
table; other columns are left out.
"""

from __future__ import annotations

import hashlib
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import arrow_map

# Turns of a piece; longer conversations take several.
PIECE = 16
# Alignments that a task remembers.
CACHE = 1 << 15
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
INFINITE = 1 << 60
# White space of the word pattern [^\x20\x09-\x0D]+.
BLANKS = " \t\n\x0b\x0c\r"
DAMAGE_KINDS = 20

# Points of the grammar: the beginning, behind s, behind u, behind a.  A repaired conversation ends at the first or last.
BEGIN, AFTER_S, AFTER_U, AFTER_A = range(4)
ENDS = (BEGIN, AFTER_A)
BEHIND = {"s": AFTER_S, "u": AFTER_U, "a": AFTER_A}
# How the rest of the grammar string may go on behind each point: its first letter.
GOES_ON = {BEGIN: "us", AFTER_S: "u", AFTER_U: "a", AFTER_A: "u"}
NAMES = {"u": "user", "a": "assistant"}


def target(first: str, length: int) -> str:
    """The first ``length`` letters of the grammar string that starts with ``first``."""
    if first == "s":
        return ("s" + "ua" * (length // 2 + 1))[:length]
    return (("ua" if first == "u" else "au") * (length // 2 + 1))[:length]


def _gap(d: int) -> int:
    """Least cost of ``d`` more target letters than turns (fewer: below 0)."""
    return INSERT * d if d >= 0 else -DELETE * d


def align(codes: str, goal: str, limit: int) -> tuple[int, str] | None:
    """The least (cost, audit) of editing ``codes`` into ``goal``; None where it costs over ``limit``.

    A code per turn: d is a turn that must go, else the initial (s, u, a, x for
    others), in upper case where the turn is truncated.
    """
    n, m = len(codes), len(goal)
    alive = [0]  # turns before i that need not go
    for c in codes:
        alive.append(alive[-1] + (c != "d"))
    forced = DELETE * (n - alive[n])
    base = _gap(m - alive[n])
    if forced + base > limit:
        return None
    # Ukkonen's band: a step aside from the diagonals between start and end costs an insertion and a deletion.
    slack = (limit - forced - base) // (INSERT + DELETE)
    low, high = min(0, m - alive[n]) - slack, max(0, m - alive[n]) + slack
    rest = [None] * (n + 1)  # rest[i][j]: cost of turns i.. against goal[j:]
    for i in range(n, -1, -1):
        row, below = {}, rest[i + 1] if i < n else None
        for j in range(min(m, alive[i] + high), max(0, alive[i] + low) - 1, -1):
            if i == n and j == m:
                row[j] = 0
                continue
            best = INFINITE
            if j < m and goal[j] != "s":
                best = row.get(j + 1, INFINITE) + INSERT
            if below is not None:
                best = min(best, below.get(j, INFINITE) + DELETE)
                if j < m and (step := _match(codes[i], goal[j])) is not None:
                    best = min(best, below.get(j + 1, INFINITE) + step[0])
            if best < INFINITE:
                row[j] = best
        rest[i] = row
    total = rest[0].get(0, INFINITE)
    if total > limit:
        return None
    audit, i, j = [], 0, 0
    while i < n or j < m:  # letters in the order D, I, K, R
        here = rest[i][j]
        if i < n and rest[i + 1].get(j, INFINITE) + DELETE == here:
            audit.append("D")
            i += 1
        elif j < m and goal[j] != "s" and rest[i].get(j + 1, INFINITE) + INSERT == here:
            audit.append("I")
            j += 1
        else:
            audit.append(_match(codes[i], goal[j])[1])
            i, j = i + 1, j + 1
    return total, "".join(audit)


def _match(code: str, letter: str) -> tuple[int, str] | None:
    """Cost and letter of turning a turn into ``letter``."""
    if code == "d":
        return None
    late = TRUNCATED if code.isupper() else 0
    if code.lower() == letter:
        return KEEP + late, "K"
    return None if letter == "s" else (REROLE + late, "R")


@lru_cache(maxsize=CACHE)
def best_edits(codes: str, start: int) -> dict[int, tuple[int, str]]:
    """For each point behind a piece: the least (cost, audit) of its turns from ``start``."""
    found: dict[int, tuple[int, str]] = {}
    n = len(codes)
    middle = sum(c != "d" for c in codes)
    # Lengths nearest to the number of turns first: they give a low incumbent.  A point is reached with at
    # most one letter per turn and three more, for a whole turn of the grammar behind the last one.
    for length in sorted(range(2 * n + 4), key=lambda m: (abs(m - middle), m)):
        for first in GOES_ON[start]:
            goal = target(first, length)
            end = BEHIND[goal[-1]] if goal else start
            if not goal and first != GOES_ON[start][0]:
                continue
            got = align(codes, goal, found[end][0] if end in found else INFINITE // 2)
            if got and (end not in found or got < found[end]):
                found[end] = got
    return found


class Conversation:
    """One conversation as its turns go by."""

    def __init__(self, conv_id):
        self.conv_id = conv_id
        self.turns: list[tuple[str, str, str]] = []  # code, role, text of the current piece
        self.states = {BEGIN: (0, "", None)}  # point: cost, audit, hash of the repaired text (None: nothing yet)
        self.n = {"blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0}
        self.initial = None
        self.low = self.high = self.last = None
        self.distinct = 0

    def add(self, turn, role: str, text: str, fault: str) -> None:
        initial = role[:1]
        if self.initial is not None and self.initial + initial not in ("su", "ua", "au"):
            self.n["illegal"] += 1
        self.initial = initial
        if turn is not None and turn != self.last:
            self.low = turn if self.low is None else self.low
            self.high = self.last = turn
            self.distinct += 1
        if fault:
            self.n[fault] += 1
        code = initial if initial in ("s", "u", "a") else "x"
        code = "d" if fault in ("blank", "duplicate") else code.upper() if fault == "truncated" else code
        self.turns.append((code, role, text))
        if len(self.turns) == PIECE:
            self.flush()

    def flush(self) -> None:
        codes = "".join(t[0] for t in self.turns)
        best: dict[int, tuple[int, str, int, str]] = {}
        for start, (cost, audit, _) in self.states.items():
            for end, (more, letters) in best_edits(codes, start).items():
                new = (cost + more, audit + letters, start, letters)
                if end not in best or new[:2] < best[end][:2]:
                    best[end] = new
        self.states = {end: (cost, audit, self._hashed(start, letters))
                       for end, (cost, audit, start, letters) in best.items()}
        self.turns = []

    def _hashed(self, start: int, letters: str):
        """The running hash behind point ``start`` carried on over the piece edited by ``letters``."""
        old = self.states[start][2]
        run = old.copy() if old is not None else None
        i, point = 0, start
        for letter in letters:
            role, text = ("", "") if letter == "I" else self.turns[i][1:]
            i += letter != "I"
            if letter == "D":
                continue
            if letter == "K":
                point = BEHIND[role[:1]]
            else:
                goes = GOES_ON[point][0]
                role, point = NAMES[goes], BEHIND[goes]
            piece = f"{role}:{text}".encode()
            if run is None:
                run = hashlib.sha256(piece)
            else:
                run.update(b"\n" + piece)
        return run

    def row(self) -> tuple:
        self.flush()
        cost, audit, run = min((self.states[e] for e in ENDS if e in self.states), key=lambda s: s[:2])
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.distinct
        return (self.conv_id, gaps, *self.n.values(), cost, audit, (run or hashlib.sha256()).hexdigest())


COLUMNS = ("conv_id long, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, "
           "audit string, repaired_sha256 string")
_SCHEMA = pa.schema([("conv_id", pa.int64()), *[(c, pa.int64()) for c in
                    ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")],
                     ("audit", pa.string()), ("repaired_sha256", pa.string())])


def _repair(batches):
    """Rows in order of conversation and turn -> a row per conversation."""
    now: Conversation | None = None
    for b in batches:
        done = []
        for conv_id, turn, role, text, there, fault in zip(*(c.to_pylist() for c in b.columns), strict=True):
            if now is None or now.conv_id != conv_id:
                if now is not None:
                    done.append(now.row())
                now = Conversation(conv_id)
            if there:
                now.add(turn, role, text, fault)
        if done:
            yield pa.RecordBatch.from_pylist([dict(zip(_SCHEMA.names, r, strict=True)) for r in done], schema=_SCHEMA)
    if now is not None:
        yield pa.RecordBatch.from_pylist([dict(zip(_SCHEMA.names, now.row(), strict=True))], schema=_SCHEMA)


def turns_of(conversations: DataFrame) -> DataFrame:
    """``(conv_id, turn, role, text)``; a null role or text is one space."""
    return conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
        *[F.coalesce(F.col(c).cast("string"), F.lit(" ")).alias(c) for c in ("role", "text")])


def damage(turns: DataFrame) -> DataFrame:
    """``turns`` with ``copies``: 0 for a dropped turn, 2 for a repeated one; texts and roles damaged by hash."""
    def name(c: str) -> Column:
        return F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(name("conv_id"), F.lit(":"), name("turn"))) % DAMAGE_KINDS
    return turns.select(
        "conv_id", "turn", F.when(kind == 4, "user").otherwise(F.col("role")).alias("role"),
        F.when((kind == 0) | (kind == 1), "").when(kind == 2, F.translate("text", ".!?", "")).otherwise(F.col("text"))
        .alias("text"), F.when(kind == 0, 0).when(kind == 3, 2).otherwise(1).alias("copies"))


def repair(turns: DataFrame) -> DataFrame:
    """One row per conversation of ``turns`` (conv_id, turn, role, text, copies).

    Output: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.
    """
    rows = turns.select("conv_id", "turn", "role", "text", (F.col("copies") > 0).alias("there"),
                        F.explode(F.expr("sequence(1, greatest(copies, 1))")).alias("copy"))
    # One shuffle by conversation serves the window, the order and the alignment.
    rows = rows.repartition("conv_id")
    same = Window.partitionBy("conv_id", "role", "text", "there").orderBy("turn", "copy")
    body = F.rtrim(F.col("text"), F.lit(BLANKS))
    fault = (F.when(body == "", "blank").when(F.col("nth") > 1, "duplicate")
             .when(~F.right(body, F.lit(1)).isin(".", "!", "?"), "truncated").otherwise(""))
    rows = (rows.withColumn("nth", F.row_number().over(same))
            .select("conv_id", "turn", "role", "text", "there", fault.alias("fault"), "copy")
            .sortWithinPartitions("conv_id", "turn", "role", "text", "copy").drop("copy"))
    return arrow_map(rows, _repair, COLUMNS)
