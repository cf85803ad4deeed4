import hashlib
import heapq
import random
import zlib

import duckdb
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from labelsieve.llm import queries, turn_repair
from labelsieve.llm.oracle import ORACLE

SF = "/root/testdata/sf0.001"
SCHEMA = "conv_id long, turn long, role string, text string, copies long, fault string, nth string"
STEPS = {"": "su", "s": "u", "u": "a", "a": "u"}


def plain_search(codes, start="", ends=("", "a")):
    """Uniform-cost search over single edits: the first end met has the least (cost, audit)."""
    heap, seen = [(0, "", 0, start)], set()
    while heap:
        cost, audit, i, last = heapq.heappop(heap)
        if i == len(codes) and last in ends:
            return cost, audit
        if (i, last) in seen:
            continue
        seen.add((i, last))
        for letter in STEPS[last]:
            if letter != "s":
                heapq.heappush(heap, (cost + 2, audit + "I", i, letter))
            if i < len(codes) and codes[i] != "d":
                late = int(codes[i].isupper())
                if codes[i].lower() == letter:
                    heapq.heappush(heap, (cost + late, audit + "K", i + 1, letter))
                elif letter != "s":
                    heapq.heappush(heap, (cost + 2 + late, audit + "R", i + 1, letter))
        if i < len(codes):
            heapq.heappush(heap, (cost + 3, audit + "D", i + 1, last))
    return None


def plain(rows):
    """The contract, row by row."""
    out, kept = [], {}
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        mine = kept.setdefault(conv, [])
        if kind == 0:
            continue
        role = "user" if kind == 4 else role
        text = "" if kind == 1 else "".join(c for c in text if c not in ".!?") if kind == 2 else text
        mine += [(turn is not None, turn or 0, role, text)] * (2 if kind == 3 else 1)
    for conv, turns in kept.items():
        turns.sort()
        seen, codes, n = set(), "", dict(blank=0, duplicate=0, truncated=0)
        for *_, role, text in turns:
            body = text.strip(" \t\n\x0b\x0c\r")
            fault = ("blank" if not body else "duplicate" if (role, text) in seen else
                     "truncated" if body[-1] not in ".!?" else None)
            seen.add((role, text))
            code = role[:1] if role[:1] in ("s", "u", "a") else "x"
            codes += "d" if fault in ("blank", "duplicate") else code.upper() if fault else code
            if fault:
                n[fault] += 1
        illegal = sum(a[2][:1] + b[2][:1] not in ("su", "ua", "au") for a, b in zip(turns, turns[1:], strict=False))
        known = [t[1] for t in turns if t[0]]
        gaps = max(known) - min(known) + 1 - len(set(known)) if known else 0
        cost, audit = plain_search(codes)
        lines, i = [], 0
        for e in audit:
            if e == "K":
                lines.append(":".join(turns[i][2:]))
            elif e != "D":
                last = lines[-1][:1] if lines else ""
                lines.append(("assistant:" if last == "u" else "user:") + (turns[i][3] if e == "R" else ""))
            i += e != "I"
        out.append((conv, gaps, n["blank"], n["duplicate"], n["truncated"], illegal, cost, audit,
                    hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(out, key=str)


def run(spark, rows):
    table = spark.createDataFrame([(*r, 5, "f", "n") for r in rows], SCHEMA)
    got = turn_repair.repair(turn_repair.damage(turn_repair.turns_of(table)))
    return sorted(map(tuple, got.collect()), key=str)


@settings(max_examples=300, deadline=None)
@given(st.text("suaxSUAXd", max_size=9))
def test_alignment_is_the_cheapest_edit_and_the_least_audit(codes):
    found = turn_repair.best_edits(codes, turn_repair.BEGIN)
    best = min(found[e] for e in turn_repair.ENDS if e in found)
    assert best == plain_search(codes)


@settings(max_examples=100, deadline=None)
@given(st.text("suaxSUAXd", max_size=8), st.sampled_from([("s", 1), ("u", 2), ("a", 3)]))
def test_every_point_of_the_grammar(codes, start):
    found = turn_repair.best_edits(codes, start[1])
    for end, point in (("s", 1), ("u", 2), ("a", 3)):
        assert found.get(point) == plain_search(codes, start[0], (end,))


def test_bands_leave_out_no_cheapest_path():
    rng = random.Random(3)
    for _ in range(200):
        codes = "".join(rng.choice("suaxSUAd") for _ in range(rng.randrange(8)))
        goal = turn_repair.target(rng.choice("sua"), rng.randrange(8))
        free = turn_repair.align(codes, goal, turn_repair.INFINITE // 2)
        if free:
            assert turn_repair.align(codes, goal, free[0]) == free
            assert turn_repair.align(codes, goal, free[0] - 1) is None
            assert turn_repair.align(codes, goal, free[0] + 7) == free


def test_odd_rows(spark):
    rng = random.Random(1)
    roles = ["user", "assistant", "system", "tool", "", None, " ", "Assistant", "usher"]
    texts = ["Fine.", "cut", "", None, " \t\n", "é!", "a ", "why? ", "x" * 30_000 + ".", ".", "\x1c"]
    rows = [(rng.choice([None, -7, 1, 2, 3, 4, 5, 2**40]), rng.choice([None, *range(12)]), rng.choice(roles), rng.choice(texts))
            for _ in range(160)]
    rows += rows[:20]  # repeated rows
    rows += [(9, t, "user", "All gone.") for t in range(200) if zlib.crc32(f"9:{t}".encode()) % 20 == 0][:3]
    got = run(spark, rows)
    assert got == plain(rows)
    assert (9, 0, 0, 0, 0, 0, 0, "", hashlib.sha256(b"").hexdigest()) in got


def test_long_conversation_in_pieces(spark):
    rng = random.Random(2)
    rows = [(1, t, rng.choice(["user", "assistant", "assistant", "system"]), rng.choice([f"Turn {t}.", "cut off", "Same."]))
            for t in range(700)]
    rows += [(2, t, ("user", "assistant")[t % 2], f"Turn {t}.") for t in range(turn_repair.PIECE)]
    assert run(spark, rows) == plain(rows)


def test_empty_table(spark):
    assert run(spark, []) == []


@pytest.mark.parametrize("sf", [SF])
def test_query_against_sql_and_plain(spark, sf):
    got = queries.op11_turn_repair(spark, sf)
    con = duckdb.connect()
    con.execute(f"create view conversations as select * from '{sf}/conversations.parquet'")
    want = con.execute(f"select {', '.join(got.columns)} from ({ORACLE['op11_turn_repair']})").fetchall()
    rows = sorted(map(tuple, got.collect()), key=str)
    assert rows == sorted(want, key=str)
    source = con.execute("select conv_id, turn, role, text from conversations").fetchall()
    assert rows == plain(source)
