"""Conversation structure repair by a Viterbi search whose decisions leave once the survivors agree.

A conversation's turns must read as an optional system turn and then user and assistant turns by turns, or be
empty. The cheapest edits (keep, rerole, delete, insert; costs below) are found by a Viterbi search over four states: nothing yet,
after the system turn, after a user turn, after an assistant turn. Each state's survivor is a leaf of a
backpointer tree whose nodes count their references. A node that loses its last reference goes, with its edits; when the
root has one child left, all survivors share it, and its edits leave. What stays in memory is the part on which the
survivors still differ: at most four leaves and three forks, whose edits are bytes (one an edit). Equal costs are
settled by comparing the complete unresolved edits of both survivors from their last common node, as text.

The repaired texts are never held: each survivor carries the running hash of its own repaired text, copied at a fork.
A survivor that costs more than a state from which everything can follow that can follow it, plus
the dearest way to imitate it, cannot win and is dropped (a conversation that begins with deletions would
otherwise never agree).

A conversation's rows are read as a sorted stream in Arrow batches, so a conversation with a third of all rows
is sorted by Spark (with spilling) and then passes through one task in constant memory besides its own result;
its SHA-256, defined over the whole conversation in order, allows no other way. The faults that need earlier rows
(duplicates) come before that from a window over (conversation, role, text), which spreads a long conversation.

Defined results: a null role or text is one blank; null identifiers are a conversation of their own; null turns
come first; rows of one turn are ordered by role and text after damage, so equal rows are neighbours; a role's
first character decides; an empty table gives an empty result; other columns are ignored; a conversation whose rows
are all dropped is returned with zeros.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

RESULT = ("gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string")
KEEP, REROLE, DELETE, INSERT, UNFINISHED = 0, 3, 4, 3, 3  # costs
START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}  # state after a turn of the role that is due
ROLE = {USER: "user", ASSISTANT: "assistant"}
LEGAL = ("su", "ua", "au")
NEWLINE = "\n"


class Node:
    """Edits that lie between two forks of the backpointer tree."""

    __slots__ = ("parent", "edits", "children")

    def __init__(self, parent: Node | None, edits: bytes = b""):
        self.parent, self.edits, self.children = parent, bytearray(edits), 0
        if parent:
            parent.children += 1


class Survivor:
    """The cheapest way into a state: its cost, its leaf of the tree and the hash of its repaired text."""

    __slots__ = ("cost", "node", "hash", "turns")

    def __init__(self, cost: int, node: Node, hash_, turns: int):
        self.cost, self.node, self.hash, self.turns = cost, node, hash_, turns


def earlier(a: tuple[Node, bytes], b: tuple[Node, bytes]) -> bool:
    """Whether the edits of ``a`` come before those of ``b`` as text: the complete unresolved parts, a leaf's
    path and the edits about to be added, without the nodes that both share."""
    one, other = line(a[0]), line(b[0])
    common = 0
    while common < min(len(one), len(other)) and one[common] is other[common]:
        common += 1
    return b"".join([*(n.edits for n in one[common:]), a[1]]) < b"".join([*(n.edits for n in other[common:]), b[1]])


class Repair:
    """The search over one conversation. Edits leave through ``emit(bytes)`` as soon as they are decided."""

    def __init__(self, emit):
        self.emit = emit
        self.alive: dict[int, Survivor] = {START: Survivor(0, Node(None), hashlib.sha256(), 0)}

    def turn(self, role: str, text: str, must_go: bool, unfinished: bool) -> None:
        self._advance(self._inserts(1))
        extra = UNFINISHED if unfinished else 0
        steps = []
        for state, s in self.alive.items():
            steps.append((s.cost + DELETE, state, state, b"D", ()))
            if must_go:
                continue
            due = NEXT[state]
            if state == START and role[:1] == "s":
                steps.append((s.cost + KEEP + extra, SYSTEM, state, b"K", ((role, text),)))
            if role[:1] == ROLE[due][0]:
                steps.append((s.cost + KEEP + extra, due, state, b"K", ((role, text),)))
            else:
                steps.append((s.cost + REROLE + extra, due, state, b"R", ((ROLE[due], text),)))
        self._advance(steps)

    def finish(self) -> tuple[int, str]:
        """Cost and hash of the cheapest repair, whose last edits leave."""
        self._advance(self._inserts(2))
        ends = [self.alive[state] for state in (START, ASSISTANT) if state in self.alive]
        best = ends[0]
        for s in ends[1:]:
            if s.cost < best.cost or (s.cost == best.cost and earlier((s.node, b""), (best.node, b""))):
                best = s
        for node in line(best.node):
            self.emit(bytes(node.edits))
        return best.cost, best.hash.hexdigest()

    def unresolved(self) -> int:
        """Edits held in memory."""
        return sum(len(n.edits) for n in {id(n): n for s in self.alive.values() for n in line(s.node)}.values())

    def _inserts(self, most: int) -> list[tuple]:
        """Every survivor as it is and after up to ``most`` inserted turns. Two in a row help at the end only: an
        assistant turn is followed by the same turns as the start or a system turn."""
        steps = []
        for state, s in self.alive.items():
            here, added = state, ()
            steps.append((s.cost, state, state, b"", ()))
            for k in range(1, most + 1):
                here = NEXT[here]
                added = (*added, (ROLE[here], ""))
                steps.append((s.cost + INSERT * k, here, state, b"I" * k, added))
        return steps

    def _advance(self, steps: list[tuple]) -> None:
        """Choose each state's cheapest step (cost, to, from, edits, turns), ties by text; grow and prune the tree."""
        best: dict[int, tuple] = {}
        for step in steps:
            cost, to, origin, edits, _ = step
            held = best.get(to)
            if held is None or cost < held[0] or (
                    cost == held[0] and earlier((self.alive[origin].node, edits), (self.alive[held[2]].node, held[3]))):
                best[to] = step
        # Whatever follows the start or the system turn may follow an assistant turn as well; only a system
        # turn that is kept later would have to go there.
        if ASSISTANT in best:
            bound = best[ASSISTANT][0]
            if START in best and best[START][0] > bound + DELETE:
                del best[START]
            if SYSTEM in best and best[SYSTEM][0] > bound:
                del best[SYSTEM]
        uses: dict[int, int] = {}
        for step in best.values():
            uses[step[2]] = uses.get(step[2], 0) + 1
        old, self.alive = self.alive, {}
        for to, (cost, _, origin, edits, added) in best.items():
            s = old[origin]
            if uses[origin] == 1:
                node, running = s.node, s.hash
                node.edits += edits
            else:  # a fork; the one step without new turns goes on with the hash itself
                node, running = Node(s.node, edits), s.hash.copy() if added else s.hash
            turns = s.turns
            for role, text in added:
                running.update(f"{NEWLINE if turns else ''}{role}:{text}".encode())
                turns += 1
            self.alive[to] = Survivor(cost, node, running, turns)
        for origin, s in old.items():
            if origin not in uses:
                self._release(s.node)
        self._settle()

    def _release(self, node: Node) -> None:
        """Drop a leaf and the ancestors that nothing else refers to."""
        while node.parent and not node.children:
            node = node.parent
            node.children -= 1

    def _settle(self) -> None:
        """Join forks that have one child left, and let the edits leave that all survivors share."""
        for s in self.alive.values():
            node = s.node
            while node.parent:
                parent = node.parent
                if parent.parent and parent.children == 1:
                    parent.edits += node.edits
                    parent.children = node.children
                    self._replace(node, parent)
                node = parent
            if node.children:
                self.emit(bytes(node.edits))
                node.edits.clear()
                if node.children == 1:
                    for t in self.alive.values():
                        for x in line(t.node):
                            if x.parent is node:
                                x.parent = None
        if len(self.alive) == 1:
            for s in self.alive.values():
                self.emit(bytes(s.node.edits))
                s.node.edits.clear()

    def _replace(self, node: Node, by: Node) -> None:
        for s in self.alive.values():
            for x in line(s.node):
                if x.parent is node:
                    x.parent = by
            if s.node is node:
                s.node = by


def line(node: Node | None) -> list[Node]:
    """The nodes from the root of the unresolved tree down to ``node``."""
    found = []
    while node:
        found.append(node)
        node = node.parent
    return found[::-1]


def damaged(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text of all rows after the damage that a row's identifier and turn decide; a dropped row
    stays as a row with ``present`` false, so that its conversation is known."""
    blank = F.lit(" ")
    part = lambda c: F.coalesce(F.col(c).cast("string"), blank)
    kind = F.crc32(F.encode(F.concat(part("conv_id"), F.lit(":"), part("turn")), "UTF-8")) % 20
    rows = conversations.select("conv_id", "turn", part("role").alias("role"), part("text").alias("text"), kind.alias("kind"))
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    present = F.col("kind") != 0
    return rows.select(
        "conv_id", "turn", F.when(present, F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))).alias("role"),
        F.when(present, text).alias("text"), present.alias("present"),
        F.explode(F.when(F.col("kind") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))).alias("_copy")).drop("_copy")


def _order() -> list[Column]:
    return [F.col("turn").asc_nulls_first(), F.col("role"), F.col("text")]


def with_faults(turns: DataFrame) -> DataFrame:
    """``turns`` (conv_id, turn, role, text, present) with ``fault``, the first of blank, duplicate and truncated."""
    same = Window.partitionBy("conv_id", "role", F.sha2("text", 256)).orderBy(F.col("turn").asc_nulls_first())
    visible = F.regexp_extract("text", r"([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z", 1)
    rows = turns.withColumns({"_nth": F.row_number().over(same), "_last": visible})
    fault = F.when(F.col("_last") == "", "blank").when(F.col("_nth") > 1, "duplicate").when(~F.col("_last").isin(".", "!", "?"), "truncated")
    return rows.select("conv_id", "turn", "role", "text", "present", F.when(F.col("present"), fault).alias("fault"))


def _sorted(rows: DataFrame) -> DataFrame:
    """Each conversation's rows in order within one partition, as a stream."""
    return rows.repartition("conv_id").sortWithinPartitions("conv_id", *_order(), F.coalesce(F.col("fault") == "duplicate", F.lit(False)))


class _Digest:
    """Counts, audit and hash of one conversation, from its rows in order."""

    def __init__(self):
        self.audit = bytearray()
        self.repair = Repair(self.audit.extend)
        self.faults = {"blank": 0, "duplicate": 0, "truncated": 0}
        self.low = self.high = self.last = None
        self.turns = self.illegal = 0

    def add(self, turn: int | None, role: str, text: str, fault: str | None) -> None:
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        if fault:
            self.faults[fault] += 1
        if self.last is not None:
            self.illegal += self.last + role[:1] not in LEGAL
        self.last = role[:1]
        self.repair.turn(role, text, fault in ("blank", "duplicate"), fault == "truncated")

    def result(self) -> tuple:
        cost, hashed = self.repair.finish()
        gaps = self.high - self.low + 1 - self.turns if self.turns else 0
        return (gaps, *self.faults.values(), self.illegal, cost, self.audit.decode(), hashed)


class _Edits:
    """The edits of one conversation as rows: number, edit, row (place among the rows read, null for an insert), place (among the
    repaired turns, null for a deletion) and role (that a reroled or inserted turn gets)."""

    def __init__(self):
        self.out: list[tuple] = []
        self.repair = Repair(self._take)
        self.number = self.row = self.place = 0
        self.odd: int | None = None  # 1 if the repaired conversation begins with a system turn
        self.roles: list[str] = []

    def _take(self, edits: bytes) -> None:
        for edit in edits.decode():
            row = None if edit == "I" else self.row
            self.row += edit != "I"
            if edit == "D":
                self.out.append((self.number, edit, row, None, None))
            else:
                if self.place == 0:  # only a kept system turn can stand first and not be a user turn
                    self.odd = int(edit == "K" and self.first_role(row) == "s")
                due = "assistant" if (self.place - self.odd) % 2 else "user"
                self.out.append((self.number, edit, row, self.place, due if edit in "RI" else None))
                self.place += 1
            self.number += 1

    def first_role(self, row: int) -> str:
        return self.roles[row] if row < len(self.roles) else ""

    def add(self, turn: int | None, role: str, text: str, fault: str | None) -> None:
        if self.odd is None:  # until the first repaired turn is known
            self.roles.append(role[:1])
        self.repair.turn(role, "", fault in ("blank", "duplicate"), fault == "truncated")


def _by_conversation(rows: DataFrame, kind: type, out: str):
    """Run ``kind`` over each conversation's stream. Results leave with the Arrow batch that settles them."""
    head = f"`conv_id` {dict(rows.dtypes)['conv_id']}"
    schema = f"{head}, {out}"
    names = [x.split()[0].strip("`") for x in schema.split(", ")]
    per_edit = kind is _Edits

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        types: list[pa.DataType] | None = None
        current, state, found = None, None, []

        def close():
            if per_edit:
                state.repair.finish()
                found.extend((current, *x) for x in state.out)
            else:
                found.append((current, *state.result()))

        def packed():
            columns = list(zip(*found)) if found else [()] * len(names)
            made = [pa.array(list(c), t) for c, t in zip(columns, types)]
            found.clear()
            return pa.RecordBatch.from_arrays(made, names=names)

        for batch in batches:
            if types is None:
                kinds = {"long": pa.int64(), "string": pa.string()}
                types = [batch.schema.field("conv_id").type, *[kinds[x.split()[1]] for x in out.split(", ")]]
            columns = [batch.column(batch.schema.get_field_index(c)).to_pylist() for c in ("conv_id", "turn", "role", "text", "present", "fault")]
            for conv, turn, role, text, present, fault in zip(*columns):
                if state is None or conv != current:
                    if state is not None:
                        close()
                    current, state = conv, kind()
                if present:
                    state.add(turn, role, text, fault)
            if per_edit and state is not None:
                found.extend((current, *x) for x in state.out)
                state.out.clear()
            if found:
                yield packed()
        if state is not None:
            close()
            yield packed()

    return rows.mapInArrow(run, schema)


def repair(turns: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.
    ``turns``: conv_id, turn, role, text and ``present`` (false: only names its conversation)."""
    return _by_conversation(_sorted(with_faults(turns)), _Digest, RESULT)


def edits(turns: DataFrame) -> DataFrame:
    """One row per edit, in order: conv_id, number, edit, row, place, role (see :class:`_Edits`)."""
    return _by_conversation(_sorted(with_faults(turns)), _Edits, "number long, edit string, row long, place long, role string")


def repaired(turns: DataFrame) -> DataFrame:
    """The repaired conversations: conv_id, place, turn (null for an inserted turn), role, text."""
    row = F.row_number().over(Window.partitionBy("conv_id").orderBy(*_order())) - 1
    numbered = turns.where("present").select("conv_id", row.cast("long").alias("row"), "turn", F.col("role").alias("_role"), "text")
    kept = edits(turns).where("place IS NOT NULL").alias("e").join(
        numbered.alias("n"), F.col("e.conv_id").eqNullSafe(F.col("n.conv_id")) & (F.col("e.row") == F.col("n.row")), "left")
    return kept.select("e.conv_id", "place", "turn", F.coalesce("e.role", "_role").alias("role"), F.coalesce("text", F.lit("")).alias("text"))


def query(conversations: DataFrame) -> DataFrame:
    return repair(damaged(conversations))


def sql() -> str:
    """The same by dynamic programming over states, keeping whole edit texts and repaired texts."""
    key = "coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')"
    crc = f"""xor(list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(range(1, length({key}) + 1),
        lambda i: [ascii(substr({key}, i, 1))::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
        lambda c, x: xor(xor(c, x) >> 1, CASE WHEN xor(c, x) & 1 = 1 THEN 3988292384 ELSE 0 END)), 4294967295)"""
    join = lambda a, b: f"CASE WHEN {b} = '' THEN {a} WHEN {a} = '' THEN {b} ELSE {a} || chr(10) || {b} END"
    return rf"""
WITH RECURSIVE kinds AS (
    SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, {crc} % 20 AS kind FROM conversations),
after AS (
    SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
        CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
        unnest(CASE kind WHEN 0 THEN [] WHEN 3 THEN [1, 2] ELSE [1] END) AS copy
    FROM kinds),
seen AS (SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST) AS nth FROM after),
numbered AS (
    SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, nth) AS i,
        regexp_extract(text, '([^\x20\x09-\x0D])[\x20\x09-\x0D]*\z', 1) AS last,
        left(lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, nth), 1) || left(role, 1) AS pair
    FROM seen),
turns AS (
    SELECT conv_id, turn, role, text, i, pair,
        CASE WHEN last = '' THEN 'blank' WHEN nth > 1 THEN 'duplicate' WHEN last NOT IN ('.', '!', '?') THEN 'truncated' ELSE '' END AS fault
    FROM numbered),
inserts(from_, to_, added, price, lines) AS (
    VALUES (0, 0, '', 0, ''), (1, 1, '', 0, ''), (2, 2, '', 0, ''), (3, 3, '', 0, ''),
        (0, 2, 'I', 3, 'user:'), (1, 2, 'I', 3, 'user:'), (2, 3, 'I', 3, 'assistant:'), (3, 2, 'I', 3, 'user:'),
        (0, 3, 'II', 6, 'user:' || chr(10) || 'assistant:'), (1, 3, 'II', 6, 'user:' || chr(10) || 'assistant:')),
ops(from_, to_, edit, price, initial, role) AS (
    VALUES (0, 0, 'D', 4, NULL, NULL), (1, 1, 'D', 4, NULL, NULL), (2, 2, 'D', 4, NULL, NULL), (3, 3, 'D', 4, NULL, NULL),
        (0, 1, 'K', 0, 's', NULL), (0, 2, 'K', 0, 'u', NULL), (1, 2, 'K', 0, 'u', NULL), (3, 2, 'K', 0, 'u', NULL), (2, 3, 'K', 0, 'a', NULL),
        (0, 2, 'R', 3, NULL, 'user'), (1, 2, 'R', 3, NULL, 'user'), (3, 2, 'R', 3, NULL, 'user'), (2, 3, 'R', 3, NULL, 'assistant')),
ways AS (
    SELECT DISTINCT conv_id, 0::BIGINT AS i, 0 AS state, 0::BIGINT AS cost, '' AS audit, '' AS done FROM conversations
    UNION ALL
    SELECT conv_id, i, state, cost, audit, done FROM (
        SELECT w.conv_id, t.i, o.to_ AS state, w.cost + n.price + o.price + CASE WHEN o.edit <> 'D' AND t.fault = 'truncated' THEN 3 ELSE 0 END AS cost,
            w.audit || n.added || o.edit AS audit,
            CASE WHEN o.edit = 'D' THEN {join('w.done', 'n.lines')}
                ELSE {join('(' + join('w.done', 'n.lines') + ')', "(coalesce(o.role, t.role) || ':' || t.text)")} END AS done,
            row_number() OVER (PARTITION BY w.conv_id, o.to_ ORDER BY w.cost + n.price + o.price
                + CASE WHEN o.edit <> 'D' AND t.fault = 'truncated' THEN 3 ELSE 0 END, w.audit || n.added || o.edit) AS nth
        FROM ways w JOIN turns t ON t.conv_id IS NOT DISTINCT FROM w.conv_id AND t.i = w.i + 1
        JOIN inserts n ON n.from_ = w.state JOIN ops o ON o.from_ = n.to_
        WHERE (o.edit = 'D' OR t.fault NOT IN ('blank', 'duplicate')) AND (o.initial IS NULL OR left(t.role, 1) = o.initial)) x
    WHERE nth = 1),
counts AS (
    SELECT c.conv_id, count(t.i) AS n, coalesce(max(t.turn) - min(t.turn) + 1 - count(DISTINCT t.turn), 0) AS gaps,
        count(*) FILTER (t.fault = 'blank') AS blank, count(*) FILTER (t.fault = 'duplicate') AS duplicate, count(*) FILTER (t.fault = 'truncated') AS truncated,
        count(*) FILTER (t.i > 1 AND t.pair NOT IN ('su', 'ua', 'au')) AS illegal
    FROM (SELECT DISTINCT conv_id FROM conversations) c LEFT JOIN turns t ON t.conv_id IS NOT DISTINCT FROM c.conv_id GROUP BY c.conv_id),
ends AS (
    SELECT c.*, w.cost + n.price AS cost, w.audit || n.added AS audit, sha256({join('w.done', 'n.lines')}) AS repaired_sha256
    FROM counts c JOIN ways w ON w.conv_id IS NOT DISTINCT FROM c.conv_id AND w.i = c.n JOIN inserts n ON n.from_ = w.state WHERE n.to_ IN (0, 3)
    QUALIFY row_number() OVER (PARTITION BY c.conv_id ORDER BY w.cost + n.price, w.audit || n.added) = 1)
SELECT conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256 FROM ends"""
