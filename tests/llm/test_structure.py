"""Conversation structure repair against plain dynamic programming over whole edit texts."""

import hashlib
import random
import re
import zlib

import duckdb
import pytest

from dwspark.llm import queries, structure
from . import helpers as h

TURNS = "conv_id long, turn long, role string, text string"


def cheapest(rows):
    """Cost, audit and repaired turns of rows (role, text, must go, unfinished)."""
    ways = {0: (0, "", [])}

    def put(to, state, way):
        if state not in to or way[:2] < to[state][:2]:
            to[state] = way

    def with_inserts(ways):
        for _ in range(3):
            more = dict(ways)
            for state, (cost, audit, done) in ways.items():
                due = 3 if state == 2 else 2
                put(more, due, (cost + 3, audit + "I", done + [("assistant" if due == 3 else "user") + ":"]))
            ways = more
        return ways

    for role, text, must_go, unfinished in rows:
        after = {}
        for state, (cost, audit, done) in with_inserts(ways).items():
            put(after, state, (cost + 4, audit + "D", done))
            if must_go:
                continue
            cost += 3 if unfinished else 0
            due = 3 if state == 2 else 2
            name = "assistant" if due == 3 else "user"
            if state == 0 and role[:1] == "s":
                put(after, 1, (cost, audit + "K", done + [f"{role}:{text}"]))
            if role[:1] == name[0]:
                put(after, due, (cost, audit + "K", done + [f"{role}:{text}"]))
            put(after, due, (cost + 3, audit + "R", done + [f"{name}:{text}"]))
        ways = after
    ways = with_inserts(ways)
    return min((ways[s] for s in (0, 3) if s in ways), key=lambda w: w[:2])


def brute_force(conversations):
    groups = {}
    for conv, turn, role, text in conversations:
        role, text = (" " if x is None else x for x in (role, text))
        rows = groups.setdefault(conv, [])
        name = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        kind = zlib.crc32(name.encode()) % 20
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(kind, text)
        rows += {0: 0, 3: 2}.get(kind, 1) * [(turn, "user" if kind == 4 else role, text)]
    out = {}
    for conv, rows in groups.items():
        rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, marked, counts = set(), [], {"blank": 0, "duplicate": 0, "truncated": 0, None: 0}
        for turn, role, text in rows:
            last = re.findall(r"[^\x20\x09-\x0D]", text)[-1:]
            fault = "blank" if not last else "duplicate" if (role, text) in seen else "truncated" if last[0] not in ".!?" else None
            seen.add((role, text))
            counts[fault] += 1
            marked.append((role, text, fault in ("blank", "duplicate"), fault == "truncated"))
        turns = [t for t, *_ in rows if t is not None]
        pairs = [a[0][:1] + b[0][:1] for a, b in zip(marked, marked[1:])]
        cost, audit, done = cheapest(marked)
        out[conv] = (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, counts["blank"], counts["duplicate"], counts["truncated"],
                     sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(done).encode()).hexdigest(), done)
    return out


def _check(spark, rows):
    want = brute_force(rows)
    turns = structure.damaged(spark.createDataFrame(rows, TURNS))
    got = {r[0]: tuple(r)[1:] for r in structure.repair(turns).collect()}
    assert got == {k: v[:-1] for k, v in want.items()}
    edits = {}
    for r in sorted(structure.edits(turns).collect(), key=lambda r: r.number):
        edits[r.conv_id] = edits.get(r.conv_id, "") + r.edit
    assert edits == {k: v[6] for k, v in want.items() if v[6]}
    done = {}
    for r in sorted(structure.repaired(turns).collect(), key=lambda r: r.place):
        done.setdefault(r.conv_id, []).append(f"{r.role}:{r.text}")
    assert done == {k: v[-1] for k, v in want.items() if v[-1]}


def test_all_conversations(spark):
    rows = duckdb.sql(f"SELECT conv_id, turn, role, text FROM '{h.SF}/conversations.parquet'").fetchall()
    got = {r[0]: tuple(r)[1:] for r in queries.queries()["op11_structure_repair"](spark, h.SF).collect()}
    assert got == {k: v[:-1] for k, v in brute_force(rows).items()}


def test_random_conversations_with_nulls_ties_and_repeats(spark):
    r = random.Random(3)
    rows = []
    for conv in [None, *range(150)]:
        roles = r.choice([["user"], ["user", "assistant"], ["system", "user", "assistant", "tool", "", None], ["system"]])
        for _ in range(r.randint(1, 12)):
            rows.append((conv, r.choice([None, *range(-2, 9)]), r.choice(roles), r.choice([None, "", " \t", "a", "a.", "b!", "ü?", "c. \n", "é"])))
    _check(spark, rows + rows[:40])


def test_long_conversation_and_long_text(spark):
    rows = [(1, i, "user" if i % 3 else "assistant", f"turn {i}.") for i in range(5000)]
    _check(spark, rows + [(2, 0, "user", "x" * 2_000_000 + ".")])


def test_empty_table_and_clashing_columns(spark):
    assert structure.query(spark.createDataFrame([], TURNS)).collect() == []
    odd = spark.createDataFrame([(1, 1, "user", "a.", "x", 5)], TURNS + ", fault string, present long").selectExpr("*", "1 AS audit", "2 AS kind")
    assert structure.query(odd).count() == 1


@pytest.mark.parametrize("rows, most", [
    ([("user", "a", 0, 0), ("assistant", "b", 0, 0)] * 3000, 8),  # survivors agree at once: nothing piles up
    ([("user", "a", 0, 0)] * 5000, 10_000),  # two ways that never agree: two edits a row, no texts
    ([("system", "a", 0, 0)] + [("user", "", 1, 0)] * 5000, 15_100),
])
def test_memory_is_the_unresolved_part(rows, most):
    out = bytearray()
    search = structure.Repair(out.extend)
    for row in rows:
        search.turn(*row)
        assert sum(1 for s in search.alive.values() for _ in structure.line(s.node)) <= 16
    assert search.unresolved() <= most
    cost, _ = search.finish()
    assert (cost, out.decode()) == cheapest(rows)[:2]
