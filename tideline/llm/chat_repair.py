"""Conversation structure repair as a cheapest path through the edit lattice.

A node of the lattice is (rows passed, role state); an edge keeps, re-roles or
deletes the next row, or inserts an empty turn. Bidirectional Dijkstra finds
the least cost: a forward heap from the start and a reverse heap from the goals
take whole cost levels in turn until no cheaper meeting is possible, so that
every cheapest path has a crossing, an edge between the two settled sets. Of
all paths through the crossings the one with the least audit (the edits'
letters in ASCII order) is then read off from the start.

Rows of one conversation are numbered and cut into chunks. A chunk's paths
from each state to each state (cost and audit) are the edges of a lattice of
chunks, which the same search goes through; a conversation of one chunk, the
usual case, is searched row by row at once. Texts take no part in that. They
meet the audit in one sorted pass that hashes the repaired conversation.
"""

from __future__ import annotations

import hashlib
import heapq
import math
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..operators.scan import Scan, prefix_scan
from .common import cut, frugal

#: Rows of a conversation that are searched together.
CHUNK_ROWS = 4096

REROLE, DELETE, INSERT, TRUNCATED = 1, 2, 5, 5
SPACE = " \t\n\x0b\f\r"

#: States: nothing yet, after the system turn, after a user turn, after an
#: assistant turn. What each may go on with, and the states that may be last.
STEP = [{"s": 1, "u": 2}, {"u": 2}, {"a": 3}, {"u": 2}]
GOALS = (0, 3)
ROLES = {"u": "user", "a": "assistant"}
#: The role that an edit can make in each state, and the state after it.
MADE = [next((r, q) for r, q in s.items() if r in ROLES) for s in STEP]

Node = tuple[int, int]
Edge = tuple[Node, int, str]


class _Side:
    """One of the two searches: its heap and what it has settled."""

    def __init__(self, start: list[Node], edges: Callable[[Node], list[Edge]]):
        self.edges, self.done = edges, {}
        self.heap = [(0, v) for v in start]
        self.least = {v: 0 for v in start}

    def next_level(self) -> float:
        while self.heap and self.heap[0][1] in self.done:
            heapq.heappop(self.heap)
        return self.heap[0][0] if self.heap else math.inf

    def settle(self, other: dict[Node, int]) -> float:
        """Settle all nodes of the next level. Returns the least cost of a path
        that this joins with one that the other side has settled."""
        level, joined = self.next_level(), math.inf
        while self.heap and self.heap[0][0] == level:
            _, v = heapq.heappop(self.heap)
            if v in self.done:
                continue
            self.done[v] = level
            joined = min(joined, level + other.get(v, math.inf))
            for to, cost, _ in self.edges(v):
                joined = min(joined, level + cost + other.get(to, math.inf))
                if to not in self.done and level + cost < self.least.get(to, math.inf):
                    self.least[to] = level + cost
                    heapq.heappush(self.heap, (level + cost, to))
        return joined


def cheapest(start: Node, goals: list[Node], out: Callable[[Node], list[Edge]],
             into: Callable[[Node], list[Edge]]) -> tuple[int, str] | None:
    """Cost and least audit of the cheapest paths from ``start`` to a goal, or
    None. ``out`` and ``into`` give a node's edges in both directions.

    The searches settle whole levels and stop when the two levels to come cost
    more together than the best path. The node behind the last one of a
    cheapest path that is settled forward then costs less from the goals than
    the reverse level to come, so the edge between them is a crossing.
    """
    ahead, back = _Side([start], out), _Side(goals, into)
    best = min(ahead.settle(back.done), back.settle(ahead.done))
    while (a := ahead.next_level()) + (b := back.next_level()) <= best and min(a, b) < math.inf:
        best = min(best, ahead.settle(back.done) if a <= b else back.settle(ahead.done))
    if best == math.inf:
        return None
    g, h = ahead.done, back.done

    # the crossings' nodes, and those before them, that lie on cheapest paths
    todo = [v for v in g if g[v] + h.get(v, math.inf) == best
            or any(g[v] + cost + h.get(to, math.inf) == best for to, cost, _ in out(v))]
    on_path = set(todo)
    while todo:
        v = todo.pop()
        for before, cost, _ in into(v):
            if before not in on_path and g.get(before, math.inf) + cost == g[v]:
                on_path.add(before)
                todo.append(before)

    audit, v, spent, ends = [], start, 0, set(goals)
    while v not in ends or spent != best:
        label, cost, v = min(
            (label, cost, to) for to, cost, label in out(v)
            if spent + cost + h.get(to, math.inf) == best or (to in on_path and g[to] == spent + cost))
        audit.append(label)
        spent += cost
    return best, "".join(audit)


class Rows:
    """Lattice of the rows of one chunk. A row is ``(role initial, edits)``:
    the edits that it allows are "D" with as many letters as rows it stands
    for, "K" (with "R") and "T" for a truncated row that may stay."""

    def __init__(self, rows: list[tuple[str, str, int]], insert_last: bool):
        self.rows, self.n = rows, len(rows)
        self.insert_until = self.n if insert_last else self.n - 1

    def _of_row(self, i: int, q: int) -> Iterator[tuple[int, int, str]]:
        """State after row ``i``, cost and letters of each of its edits."""
        initial, kind, copies = self.rows[i]
        yield q, DELETE * copies, "D" * copies
        if kind != "D":
            extra = TRUNCATED if kind == "T" else 0
            if initial in STEP[q]:
                yield STEP[q][initial], extra, "K"
            yield MADE[q][1], REROLE + extra, "R"

    def out(self, v: Node) -> list[Edge]:
        i, q = v
        edges = [((i + 1, to), cost, s) for to, cost, s in self._of_row(i, q)] if i < self.n else []
        if i <= self.insert_until:
            edges.append(((i, MADE[q][1]), INSERT, "I"))
        return edges

    def into(self, v: Node) -> list[Edge]:
        i, q = v
        edges = []
        if i:
            edges = [((i - 1, before), cost, s) for before in range(4)
                     for to, cost, s in self._of_row(i - 1, before) if to == q]
        if i <= self.insert_until:
            edges += [((i, before), INSERT, "I") for before in range(4) if MADE[before][1] == q]
        return edges

    def search(self, q: int = 0, goals: tuple[int, ...] = GOALS) -> tuple[int, str] | None:
        return cheapest((0, q), [(self.n, p) for p in goals], self.out, self.into)


class Chunks:
    """Lattice of chunks: an edge is a cheapest path through a chunk, which
    ends with its last row's edit; behind the last chunk turns are inserted."""

    def __init__(self, tables: list[list[list[tuple[int, str] | None]]]):
        self.tables, self.n = tables, len(tables)

    def out(self, v: Node) -> list[Edge]:
        i, q = v
        if i < self.n:
            return [((i + 1, to), *e) for to, e in enumerate(self.tables[i][q]) if e is not None]
        return [((i, MADE[q][1]), INSERT, "I")]

    def into(self, v: Node) -> list[Edge]:
        i, q = v
        edges = []
        if i:
            edges = [((i - 1, before), *self.tables[i - 1][before][q]) for before in range(4)
                     if self.tables[i - 1][before][q] is not None]
        if i == self.n:
            edges += [((i, before), INSERT, "I") for before in range(4) if MADE[before][1] == q]
        return edges

    def search(self) -> tuple[int, str]:
        return cheapest((0, 0), [(self.n, p) for p in GOALS], self.out, self.into)


def faults(text: Column) -> tuple[Column, Column]:
    """Whether a text is blank, and whether its last character other than
    ASCII white space is no ``.``, ``!`` or ``?``."""
    end = F.rtrim(text, F.lit(SPACE))
    return end == "", ~F.substring(end, -1, 1).isin(".", "!", "?")


def damage(turns: DataFrame) -> DataFrame:
    """Damage rows of ``conv_id, turn, role, text`` by the CRC-32 of
    ``conv_id:turn`` modulo 20: 0 drops a row, 1 empties its text, 2 removes
    its ``.``, ``!`` and ``?``, 3 makes it stand twice (``copies``), 4 makes
    its role user. A null role, text, or part of the key is one space."""
    space = F.lit(" ")
    key = F.concat_ws(":", F.coalesce(F.col("conv_id").cast("string"), space), F.coalesce(F.col("turn").cast("string"), space))
    kind = F.crc32(key.cast("binary")) % 20
    role, text = F.coalesce("role", space), F.coalesce("text", space)
    return (turns.where(kind != 0).select(
        "conv_id", F.col("turn").cast("bigint").alias("turn"), F.when(kind == 4, "user").otherwise(role).alias("role"),
        F.when(kind == 1, "").when(kind == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(kind == 3, 2).otherwise(1).cast("bigint").alias("copies")))


def placed(rows: DataFrame) -> DataFrame:
    """The rows without their texts, numbered in their conversation (``place``
    from 0), with their faults; ``again`` if role and text were seen earlier."""
    blank, truncated = faults(F.col("text"))
    slim = rows.select("conv_id", "turn", "role", "digest", "copies", blank.alias("blank"), truncated.alias("truncated"))
    # rows of one conversation, role and text differ in their turns
    slim = cut(prefix_scan(slim, "turn", [Scan("earlier", F.lit(1), "count", inclusive=False)],
                           ["conv_id", "role", "digest"]), "repair-seen")
    numbered = prefix_scan(slim, ["turn", "role", "digest"], [Scan("place", F.lit(1), "count", inclusive=False)], "conv_id")
    return cut(numbered.select("conv_id", "place", "turn", F.substring("role", 1, 1).alias("initial"), "copies", "blank",
                               "truncated", (F.col("earlier") > 0).alias("again")), "repair-placed")


_TABLE = pa.list_(pa.struct([("q", pa.int32()), ("to", pa.int32()), ("cost", pa.int64()), ("audit", pa.string())]))
_COUNTS = ["blank", "duplicate", "truncated", "illegal", "distinct_turns"]
_CHUNK = ("chunk bigint, whole boolean, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
          "distinct_turns bigint, first_initial string, last_initial string, first_turn bigint, last_turn bigint, "
          "paths array<struct<q:int,to:int,cost:bigint,audit:string>>")
LEGAL = {"su", "ua", "au"}


def _chunk_row(rows: list[dict], chunk_rows: int) -> dict:
    """Counts and cheapest paths of the sorted rows of one chunk."""
    n = dict.fromkeys(_COUNTS, 0)
    lattice: list[tuple[str, str, int]] = []
    before = before_turn = None
    for r in rows:
        again = r["copies"] - 1
        if r["blank"]:
            n["blank"] += r["copies"]
            lattice.append((r["initial"], "D", r["copies"]))
        elif r["again"]:
            n["duplicate"] += r["copies"]
            lattice.append((r["initial"], "D", r["copies"]))
        else:
            n["duplicate"] += again
            n["truncated"] += r["truncated"]
            lattice.append((r["initial"], "T" if r["truncated"] else "K", 1))
            if again:
                lattice.append((r["initial"], "D", again))
        n["illegal"] += again  # no role may follow itself
        if before is not None and before + r["initial"] not in LEGAL:
            n["illegal"] += 1
        if r["turn"] is not None and r["turn"] != before_turn:
            n["distinct_turns"] += 1
        before, before_turn = r["initial"], r["turn"]
    # a full chunk may not be the conversation's last, and one that isn't the first is not all
    whole = rows[0]["place"] < chunk_rows and len(rows) < chunk_rows
    if whole:
        cost, audit = Rows(lattice, True).search()
        paths = [{"q": 0, "to": 0, "cost": cost, "audit": audit}]
    else:
        chunk = Rows(lattice, False)
        found = [(q, to, chunk.search(q, (to,))) for q in range(4) for to in range(4)]
        paths = [{"q": q, "to": to, "cost": e[0], "audit": e[1]} for q, to, e in found if e is not None]
    turns = [r["turn"] for r in rows if r["turn"] is not None]
    return n | {"chunk": rows[0]["place"] // chunk_rows, "whole": whole, "paths": paths,
                "first_initial": rows[0]["initial"], "last_initial": rows[-1]["initial"],
                "first_turn": min(turns, default=None), "last_turn": max(turns, default=None)}


def chunks(rows: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """One row per chunk of a conversation: its counts and its cheapest paths."""
    kind = rows.schema["conv_id"].dataType.simpleString()
    names = ["place", "turn", "initial", "copies", "blank", "truncated", "again"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held = None, []
        types = None

        def packed(done: list[dict]) -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist(done, schema=types)

        for batch in batches:
            if types is None:
                types = pa.schema([("conv_id", batch.schema.field("conv_id").type), ("chunk", pa.int64()),
                                   ("whole", pa.bool_()), *[(c, pa.int64()) for c in _COUNTS],
                                   ("first_initial", pa.string()), ("last_initial", pa.string()),
                                   ("first_turn", pa.int64()), ("last_turn", pa.int64()), ("paths", _TABLE)])
            done = []
            for conv, chunk, *values in zip(*(batch.column(c).to_pylist() for c in ["conv_id", "chunk", *names])):
                if held and now != (conv, chunk):
                    done.append({"conv_id": now[0]} | _chunk_row(held, chunk_rows))
                    held = []
                now = conv, chunk
                held.append(dict(zip(names, values)))
            if done:
                yield packed(done)
        if held:
            yield packed([{"conv_id": now[0]} | _chunk_row(held, chunk_rows)])

    ordered = (rows.withColumn("chunk", F.expr(f"place div {int(chunk_rows)}")).repartition("conv_id", "chunk")
               .sortWithinPartitions("conv_id", "chunk", "place"))
    return ordered.select("conv_id", "chunk", *names).mapInArrow(frugal(run), f"conv_id {kind}, {_CHUNK}")


class Repaired:
    """Result of one conversation, fed with its chunks and then with its rows."""

    def __init__(self, conv: object):
        self.conv, self.chunks = conv, []
        self.hash, self.empty = hashlib.sha256(), True
        self.audit: str | None = None

    def solve(self) -> None:
        parts = self.chunks
        self.n = {c: sum(p[c] for p in parts) for c in _COUNTS}
        for a, b in zip(parts, parts[1:]):
            self.n["illegal"] += a["last_initial"] + b["first_initial"] not in LEGAL
            self.n["distinct_turns"] -= a["last_turn"] is not None and a["last_turn"] == b["first_turn"]
        turns = [t for p in parts for t in (p["first_turn"], p["last_turn"]) if t is not None]
        self.gaps = max(turns) - min(turns) + 1 - self.n["distinct_turns"] if turns else 0
        if not parts:
            self.cost, self.audit = 0, ""
        elif parts[0]["whole"]:
            self.cost, self.audit = parts[0]["paths"][0]["cost"], parts[0]["paths"][0]["audit"]
        else:
            tables = []
            for p in parts:
                table = [[None] * 4 for _ in range(4)]
                for e in p["paths"]:
                    table[e["q"]][e["to"]] = (e["cost"], e["audit"])
                tables.append(table)
            self.cost, self.audit = Chunks(tables).search()
        self.chunks, self.at, self.state = [], 0, 0

    def add(self, role: str, text: str) -> None:
        self.hash.update(f"{'' if self.empty else chr(10)}{role}:{text}".encode())
        self.empty = False
        self.state = STEP[self.state][role[0]]

    def inserted(self) -> None:
        while self.audit[self.at:self.at + 1] == "I":
            self.add(ROLES[MADE[self.state][0]], "")
            self.at += 1

    def row(self, role: str, text: str, copies: int) -> None:
        if self.audit is None:
            self.solve()
        for _ in range(copies):
            self.inserted()
            letter = self.audit[self.at]
            self.at += 1
            if letter != "D":
                self.add(role if letter == "K" else ROLES[MADE[self.state][0]], text)

    def result(self) -> tuple:
        if self.audit is None:
            self.solve()
        self.inserted()
        return (self.conv, self.gaps, self.n["blank"], self.n["duplicate"], self.n["truncated"], self.n["illegal"],
                self.cost, self.audit, self.hash.hexdigest())


def repair(turns: DataFrame, chunk_rows: int = CHUNK_ROWS, conversations: DataFrame | None = None) -> DataFrame:
    """Repair conversations, rows ``conv_id, turn, role, text`` and optionally
    ``copies`` (times that a row stands there). Returns ``conv_id, gaps, blank,
    duplicate, truncated, illegal, cost, audit, repaired_sha256``, also for
    each ``conv_id`` of ``conversations`` that has no rows: zeros, an empty
    audit and the digest of nothing.

    Rows stand in the order of their turns, null first; ties go by role, then
    by the SHA-256 of the text. Equal rows of one turn are folded into one row
    with a count before they are shuffled. Null roles and texts are one space.
    A row's first fault counts: blank, duplicate (role and text seen earlier in
    the conversation), truncated. Edits keep (K), re-role (R), delete (D) or
    insert (I) until the role initials are ``(s?(ua)+)?``; a role with another
    or no initial can't be kept. A null ``conv_id`` is a conversation. Extra
    columns are not looked at; an empty table gives an empty result.

    What must run in order is one task's stream: a conversation's SHA-256, and
    its audit, which is one value. Texts are held one at a time.
    """
    copies = F.col("copies") if "copies" in turns.columns else F.lit(1).cast("bigint")
    space = F.lit(" ")
    # one row per conversation, turn, role and text: copies meet summed up
    rows = (turns.select("conv_id", F.col("turn").cast("bigint").alias("turn"), F.coalesce("role", space).alias("role"),
                         F.coalesce("text", space).alias("text"), copies.alias("copies"))
            .groupBy("conv_id", "turn", "role", "text").agg(F.sum("copies").alias("copies"))
            .withColumn("digest", F.sha2("text", 256)))
    rows = cut(rows, "repair-rows")
    solved = chunks(placed(rows), chunk_rows)
    kind = rows.schema["conv_id"].dataType.simpleString()

    # a conversation's chunks come before its rows
    head = solved.select("conv_id", F.lit(0).alias("part"), F.struct(*[c for c in solved.columns if c != "conv_id"]).alias("solved"))
    tail = rows.select("conv_id", F.lit(1).alias("part"), "turn", "role", "digest", "text", "copies")
    both = head.unionByName(tail, allowMissingColumns=True)
    if conversations is not None:
        named = conversations.select("conv_id", F.lit(-1).alias("part")).distinct()
        both = both.unionByName(named, allowMissingColumns=True)
    both = (both.repartition("conv_id")
            .sortWithinPartitions("conv_id", "part", "solved.chunk", "turn", "role", "digest"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
        now: Repaired | None = None
        types = None

        def packed(done: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*done), types)], names)

        for batch in batches:
            if types is None:
                types = [batch.schema.field("conv_id").type, *[pa.int64()] * 6, pa.string(), pa.string()]
            done = []
            for conv, part, solved_, role, text, copies_ in zip(*(batch.column(c) for c in (
                    "conv_id", "part", "solved", "role", "text", "copies"))):
                conv = conv.as_py()
                if now is None or now.conv != conv:
                    if now is not None:
                        done.append(now.result())
                    now = Repaired(conv)
                if part.as_py() == 0:
                    now.chunks.append(solved_.as_py())
                elif part.as_py() == 1:
                    now.row(role.as_py(), text.as_py(), copies_.as_py())
            if done:
                yield packed(done)
        if now is not None:
            yield packed([now.result()])

    return both.select("conv_id", "part", "solved", "role", "text", "copies").mapInArrow(
        frugal(run), f"conv_id {kind}, gaps bigint, blank bigint, duplicate bigint, truncated bigint, illegal bigint, "
                     "cost bigint, audit string, repaired_sha256 string")


def repair_damaged(turns: DataFrame, chunk_rows: int = CHUNK_ROWS) -> DataFrame:
    """Damage ``turns`` and repair what is left; a row for every ``conv_id``."""
    return repair(damage(turns), chunk_rows, turns)
