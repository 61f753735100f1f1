"""Conversation repair by a Viterbi search whose survivors coalesce.

A conversation must read `(s?(ua)+)?` in the initials of its roles. Four states say what has been read: nothing, a system turn, a
user's, an assistant's. Each row is kept, given another role or deleted, after any turns that are inserted before it; every state has one survivor, the
cheapest way to it, of equally cheap ones the one whose edits come first in ASCII. A survivor that is dearer than
another by more than any rest can make good is given up. Survivors are leaves of a tree
of backpointers; a node counts the nodes and survivors that lean on it and goes when none does. Once
all survivors share an ancestor, everything up to it is decided: its edits are given out and it becomes the root. So what is held is the
unresolved part alone, however long the conversation.

Ways that cost the same are compared by all of their unresolved edits. No way of these is the beginning of another (each ends with what became of the
same row), so their order stays as it is when more is appended; it is kept as a rank of each survivor, and a tie is settled by rank, then by the edits of the last row.

Rows are dealt out by conversation and sorted on the way, and each task reads its rows as a stream. What a
conversation holds in memory doesn't grow with it, but for its edits as a string, where a summary asks for them.
"""
from __future__ import annotations

import hashlib
from collections import deque
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .frames import cut

#: White space that makes no text, how a whole text ends.
SPACE, ENDS = "\x20\x09\x0a\x0b\x0c\x0d", ".!?"
#: Costs of the edits, and of a truncated row that stays.
KEEP, REROLE, DELETE, INSERT, TRUNCATED = 0, 2, 3, 2, 1
START, SYSTEM, USER, ASSISTANT = range(4)
#: From each state, where the turn leads that a rerole or an insert makes, and its role.
MADE = {START: (USER, "user"), SYSTEM: (USER, "user"), USER: (ASSISTANT, "assistant"), ASSISTANT: (USER, "user")}
#: Where a kept row leads, by the initial of its role.
KEPT = {(START, "s"): SYSTEM, (START, "u"): USER, (SYSTEM, "u"): USER, (ASSISTANT, "u"): USER, (USER, "a"): ASSISTANT}
#: Inserts that lead from each state to a whole conversation.
LAST = {START: "", SYSTEM: "II", USER: "I", ASSISTANT: ""}
#: How much more the rest can cost from the first state than from the second, at most: what the second does next the first can do, too, after
#: inserting a turn (2), deleting a kept system turn (3), or closing a conversation that is still empty (4).
BEHIND = {
    (ASSISTANT, START): 3, (USER, START): 5, (SYSTEM, START): 4, (START, SYSTEM): 0, (USER, SYSTEM): 2, (ASSISTANT, SYSTEM): 0,
    (START, USER): 2, (SYSTEM, USER): 2, (ASSISTANT, USER): 2, (START, ASSISTANT): 0, (SYSTEM, ASSISTANT): 4, (USER, ASSISTANT): 2,
}
LEGAL = ("su", "ua", "au")
FINE, CUT, BLANK, AGAIN = range(4)


def moves(initial: str, fault: int) -> list[list[tuple[int, str, int]]]:
    """For each state what a row may become: (next state, edits, cost); of ways to the same state the best."""
    out = []
    for state in range(4):
        best: dict[int, tuple[int, str]] = {state: (DELETE, "D")}
        if fault in (FINE, CUT):
            more, at, inserted = TRUNCATED * (fault == CUT), state, ""
            for _ in range(3):
                ways = [(MADE[at][0], (len(inserted) * INSERT + REROLE + more, inserted + "R"))]
                if (at, initial) in KEPT:
                    ways.append((KEPT[at, initial], (len(inserted) * INSERT + KEEP + more, inserted + "K")))
                for to, way in ways:
                    best[to] = min(best.get(to, way), way)
                at, inserted = MADE[at][0], inserted + "I"
        out.append([(to, edits, cost) for to, (cost, edits) in best.items()])
    return out


class Node:
    """The edits of one row on a way, and how many nodes and survivors lean on it."""

    __slots__ = ("parent", "edits", "kids", "leaning")

    def __init__(self, parent: Node | None, edits: str):
        self.parent, self.edits, self.kids, self.leaning = parent, edits, {}, 0
        if parent:
            parent.kids[id(self)] = self
            parent.leaning += 1


def release(node: Node) -> None:
    """One leans on the node no longer; nodes that nothing leans on go."""
    node.leaning -= 1
    while not node.leaning and node.parent:
        above = node.parent
        del above.kids[id(node)]
        above.leaning -= 1
        node = above


class Search:
    """The survivors of a conversation; step() and finish() yield the edits of rows as soon as they are decided."""

    TABLES: dict[tuple[str, int], list[list[tuple[int, str, int]]]] = {}

    def __init__(self):
        self.root = Node(None, "")
        self.root.leaning = 1
        #: state to (cost, rank, leaf)
        self.alive: dict[int, tuple[int, int, Node]] = {START: (0, 0, self.root)}
        self.cost, self.held, self.most = 0, 0, 0

    def step(self, initial: str, fault: int) -> Iterator[str]:
        key = (initial if initial in "sua" else "", fault)
        if key not in self.TABLES:
            self.TABLES[key] = moves(*key)
        best: dict[int, tuple[int, int, str, Node]] = {}
        for state, (cost, rank, leaf) in self.alive.items():
            for to, edits, more in self.TABLES[key][state]:
                if to not in best or (cost + more, rank, edits) < best[to][:3]:
                    best[to] = (cost + more, rank, edits, leaf)
        # a survivor that any other one surely beats goes, as else the empty conversation would never coalesce with the others
        best = {s: own for s, own in best.items() if not any(own[0] > other[0] + BEHIND[t, s] for t, other in best.items() if t != s)}
        order = {way: n for n, way in enumerate(sorted((rank, edits) for _, rank, edits, _ in best.values()))}
        made = {to: (cost, order[rank, edits], Node(leaf, edits)) for to, (cost, rank, edits, leaf) in best.items()}
        for _, _, leaf in made.values():
            leaf.leaning += 1
        for _, _, leaf in self.alive.values():
            release(leaf)
        self.alive = made
        self.held += 1
        self.most = max(self.most, self.held)
        yield from self.decided()

    def decided(self) -> Iterator[str]:
        """The edits up to the youngest node that all survivors share."""
        while len(self.root.kids) == 1 and self.root.leaning == 1:
            (self.root,) = self.root.kids.values()
            self.root.parent = None
            self.held -= 1
            yield self.root.edits

    def finish(self) -> Iterator[str]:
        """The rest of the edits, and at last what is inserted at the end."""
        ways = [(cost + INSERT * len(LAST[s]), rank, LAST[s], s) for s, (cost, rank, _) in self.alive.items()]
        self.cost, _, last, state = min(ways)
        for s, (_, _, leaf) in self.alive.items():
            if s != state:
                release(leaf)
        yield from self.decided_to(self.alive[state][2])
        yield last

    def decided_to(self, leaf: Node) -> Iterator[str]:
        while self.root is not leaf:
            (self.root,) = self.root.kids.values()
            self.root.parent = None
            yield self.root.edits


class Repair:
    """One conversation: takes rows in order, gives (edits, row) in order, and counts what was wrong."""

    def __init__(self):
        self.search, self.waiting, self.before, self.state = Search(), deque(), None, START
        self.blank = self.again = self.truncated = self.illegal = self.turns = 0
        self.low = self.high = self.turn = None

    def take(self, turn: int | None, role: str, text: str, fault: int, repeats: int | None) -> Iterator[tuple[str, str, str]]:
        """repeats: whether the same role and text come at another turn first (1), or here first and later again (0); null if nowhere else."""
        if fault != BLANK and (repeats == 1 or (repeats == 0 and self.before == (turn, role, text))):
            fault = AGAIN
        self.blank, self.again, self.truncated = self.blank + (fault == BLANK), self.again + (fault == AGAIN), self.truncated + (fault == CUT)
        if self.before is not None:
            self.illegal += self.before[1][:1] + role[:1] not in LEGAL
        if turn is not None and turn != self.turn:
            self.turns, self.low, self.high, self.turn = self.turns + 1, turn if self.low is None else self.low, turn, turn
        self.before = (turn, role, text)
        self.waiting.append((role, text))
        for edits in self.search.step(role[:1], fault):
            yield from self.given(edits)

    def given(self, edits: str) -> Iterator[tuple[str, str | None, str | None]]:
        """(edit, role, text) for each edit; a deleted row has neither."""
        for edit in edits:
            role, text = ("", "") if edit == "I" else self.waiting.popleft()
            if edit == "D":
                yield edit, None, None
                continue
            if edit == "K":
                self.state = KEPT[self.state, role[:1]]
            else:
                self.state, role = MADE[self.state]
            yield edit, role, text

    def end(self) -> Iterator[tuple[str, str | None, str | None]]:
        for edits in self.search.finish():
            yield from self.given(edits)

    @property
    def gaps(self) -> int:
        return self.high - self.low + 1 - self.turns if self.turns else 0


def conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[object, bool, Repair, Iterator[tuple]]]:
    """(conversation, whether it is over, its repair, what was decided) for the rows (conv, turn, role, text, fault, repeats), sorted."""
    own, key = None, None
    for batch in batches:
        for conv, *row in zip(*[c.to_pylist() for c in batch.columns]):
            if own is None or conv != key:
                if own is not None:
                    yield key, True, own, own.end()
                own, key = Repair(), conv
            yield key, False, own, own.take(*row)
    if own is not None:
        yield key, True, own, own.end()


#: Rows of a result that are given out at once, and characters of text.
ROWS, CHARACTERS = 4096, 1 << 22


def messages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edits as rows: conv, place, edit, role, text."""
    out: list[list] = [[] for _ in range(5)]
    place = size = 0
    for conv, over, _, decided in conversations(batches):
        for edit, role, text in decided:
            for column, value in zip(out, (conv, place, edit, role, text)):
                column.append(value)
            place, size = place + 1, size + len(text or "")
        if over:
            place = 0
        if len(out[0]) >= ROWS or size >= CHARACTERS:
            yield rows_of(out, MESSAGES)
            out, size = [[] for _ in range(5)], 0
    yield rows_of(out, MESSAGES)


def summaries(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """One row for each conversation, as SUMMARY has it."""
    out: list[list] = [[] for _ in SUMMARY]
    audit: list[str] = []
    digest, first = hashlib.sha256(), True
    for conv, over, own, decided in conversations(batches):
        for edit, role, text in decided:
            audit.append(edit)
            if edit != "D":
                digest.update(("" if first else "\n").encode() + f"{role}:{text}".encode())
                first = False
        if len(audit) > 65536:
            audit = ["".join(audit)]
        if over:
            for column, value in zip(out, (conv, own.gaps, own.blank, own.again, own.truncated, own.illegal, own.search.cost, "".join(audit), digest.hexdigest(), own.search.most)):
                column.append(value)
            audit, digest, first = [], hashlib.sha256(), True
            if len(out[0]) >= ROWS:
                yield rows_of(out, SUMMARY)
                out = [[] for _ in SUMMARY]
    yield rows_of(out, SUMMARY)


MESSAGES = {"conv": "long", "place": "long", "edit": "string", "role": "string", "text": "string"}
SUMMARY = {"conv": "long", "gaps": "long", "blank": "long", "duplicate": "long", "truncated": "long", "illegal": "long", "cost": "long", "audit": "string", "repaired_sha256": "string", "unresolved": "long"}


def rows_of(columns: list[list], kinds: dict[str, str]) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64() if t == "long" else pa.string()) for c, t in zip(columns, kinds.values())], names=list(kinds))


def prepared(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    """(conv, turn, role, text, fault, repeats) by conversation and in order; nulls of role and text are one space."""
    text, role = F.coalesce(F.col(f"`{text_col}`"), F.lit(" ")), F.coalesce(F.col(f"`{role_col}`"), F.lit(" "))
    rows = df.select(F.col(f"`{conv_col}`").cast("long").alias("conv"), F.col(f"`{turn_col}`").cast("long").alias("turn"), role.alias("role"), text.alias("text"))
    filled = F.btrim("text", F.lit(SPACE))
    fault = F.when(filled == "", BLANK).when(F.substring(filled, -1, 1).isin(*ENDS), FINE).otherwise(CUT)
    rows = rows.select("*", fault.alias("fault"), F.xxhash64(F.col("conv").isNull(), "conv", "role", "text").alias("h1"), F.xxhash64("text", "role", "conv", F.col("conv").isNull(), F.lit(1)).alias("h2"))
    # 128 bits stand for a role and a text in a conversation; those that come once are left out, so that little is left
    seen = rows.filter(F.col("fault") != BLANK).groupBy("h1", "h2").agg(F.count("*").alias("n"), F.min(F.struct("turn")).alias("first")).filter("n > 1")
    seen = cut(seen.select("h1", "h2", F.struct("first.turn").alias("first")))
    met = rows.join(seen, ["h1", "h2"], "left")
    repeats = F.when(F.col("first").isNotNull(), F.when(F.col("first.turn").eqNullSafe(F.col("turn")), 0).otherwise(1))
    return met.select("conv", "turn", "role", "text", "fault", repeats.alias("repeats")).repartition("conv").sortWithinPartitions("conv", "turn", "role", "text")


def repair(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv, place long, edit, role, text): what each conversation becomes, edit by edit; K keeps, R gives another role, I inserts, D deletes.

    place counts a conversation's edits from 0; deleted rows have a null role and text, and the others are the repaired
    conversation. Rows are taken by turn (nulls first), equal turns by role, then text. A row's first fault counts: blank
    (no text but ASCII white space), a repeat of a role and text earlier in the conversation, truncated (its text doesn't end with one of ENDS). Blank rows and
    repeats must go, a truncated row that stays costs TRUNCATED. The edits are the cheapest ones that make the roles' initials read `(s?(ua)+)?`,
    of equally cheap ones the least in ASCII.

    Null roles and texts are one space; rows of a null conversation make up one; repeated rows are repeats. Conversation and turn
    must be integers; other columns are ignored; an empty table gives an empty table. A conversation of any length is one stream in one
    task, as each edit may depend on all the ones before.
    """
    rows = prepared(df, conv_col, turn_col, role_col, text_col)
    return rows.mapInArrow(messages, ", ".join(f"{c} {t}" for c, t in MESSAGES.items()))


def audit(df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """One row for each conversation of the rows, with SUMMARY's columns: its faults, the cost and string of its edits, and a digest of what it becomes.

    gaps counts the turns missing between the lowest and the highest; illegal the neighbours whose initials are none of LEGAL; the digest
    is of the repaired `role:text`, joined by newlines; unresolved is the most rows that were undecided at once. Cases as in repair().
    """
    rows = prepared(df, conv_col, turn_col, role_col, text_col)
    return rows.mapInArrow(summaries, ", ".join(f"{c} {t}" for c, t in SUMMARY.items()))


def damaged(df: DataFrame) -> DataFrame:
    """Rows (conv_id, turn, role, text) with faults that a checksum of conversation and turn deals out; nulls are one space."""
    spaced = lambda c: F.coalesce(F.col(c).cast("string"), F.lit(" "))
    kind = F.crc32(F.concat(spaced("conv_id"), F.lit(":"), spaced("turn")).cast("binary")) % 20
    rows = df.select("conv_id", "turn", spaced("role").alias("role"), spaced("text").alias("text"), kind.alias("kind")).filter("kind <> 0")
    text = F.when(F.col("kind") == 1, "").when(F.col("kind") == 2, F.regexp_replace("text", "[.!?]", "")).otherwise(F.col("text"))
    role = F.when(F.col("kind") == 4, "user").otherwise(F.col("role"))
    copies = F.when(F.col("kind") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))
    return rows.select("conv_id", "turn", role.alias("role"), text.alias("text"), F.explode(copies).alias("copy")).drop("copy")
