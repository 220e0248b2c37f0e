"""Cheapest edits that give a conversation the role order ``(s?(ua)+)?``, with their audit trail.

Rows of a conversation are taken by turn (nulls first), rows of one turn by
role and text.  A row is blank (no character beside blanks), a duplicate (role
and text seen earlier in the conversation) or truncated (its last character
beside blanks is none of ``.!?``); the first of these counts.  Edits: Keep 0,
Rerole to user or assistant 2, Delete 3 (asked for blank and duplicate rows),
Insert an empty user or assistant row 2; a truncated row that stays adds 1.
Among the cheapest edit lists the one whose initials are ASCII-least is taken.

The search goes over four states (nothing yet, after a system, user, assistant
row), each with its cheapest edit list.  Lists share their prefixes as linked
nodes; a node knows its ancestors 1, 2, 4, ... steps back and the rolling hash
of its whole list.  Of two lists of equal cost the lesser is found by a search
for their longest common prefix over these ancestors; equal hashes are checked
against the characters down to the node that both share.  (Lists of one state,
row and cost are never prefixes of each other, as only Insert takes no row and
it costs 2; so the lesser prefix stays the lesser list.)  States more than
``MARGIN`` dearer than the best can't be on a cheapest path and go.  What all
states' lists share is handed on every ``FLUSH`` rows, so a long conversation
streams through a task that holds its open end, not the whole.

Spark finds the duplicates (first places by aggregate, joined back) and sorts
the rows; a conversation's rows pass through one task in order, since its
SHA-256 has to read them in order.

Nulls: a null role or text is one space; an empty role has no initial, so its row is never kept; rows of null ``conv_id`` are one
conversation; a null turn has no part in ``gaps``.  Repeated rows are
duplicates.  Conversations without rows have zeros, an empty audit and the
hash of the empty string; an empty table gives no row.  Other columns are not
used.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import BLANKS, cut, small_batches

START, SYSTEM, USER, ASSISTANT = range(4)
NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
ROLES = {USER: "user", ASSISTANT: "assistant"}
REROLE, DELETE, INSERT, TRUNCATED = 2, 3, 2, 1
#: From any state, what another state can still do costs at most 5 more (an inserted row, a deleted system row).
MARGIN = 8
FLUSH = 64
BASE, MOD = 1_000_003, (1 << 61) - 1


class Node:
    """Last edit of a list, with the lists 1, 2, 4, ... edits shorter."""

    __slots__ = ("char", "depth", "hash", "up")

    def __init__(self, parent: Node | None = None, char: str = "", mod: int = MOD):
        self.char, self.up = char, []
        self.depth = parent.depth + 1 if parent else 0
        self.hash = (parent.hash * BASE + ord(char)) % mod if parent else 0
        while parent is not None:
            self.up.append(parent)
            k = len(self.up) - 1
            parent = parent.up[k] if k < len(parent.up) else None

    def text(self) -> str:
        out, node = [], self
        while node.up:
            out.append(node.char)
            node = node.up[0]
        return "".join(reversed(out))

    def lifted(self, depth: int) -> Node:
        node = self
        while node.depth > depth:
            node = node.up[(node.depth - depth).bit_length() - 1]
        return node


def _same(a: Node, b: Node) -> bool:
    """Whether lists of equal length and hash are equal, by their characters down to the shared node."""
    while a is not b:
        if a.char != b.char:
            return False
        a, b = a.up[0], b.up[0]
    return True


def less(x: Node, y: Node) -> bool:
    """Whether list x comes before list y in ASCII order."""
    if x is y:
        return False
    a, b = x.lifted(min(x.depth, y.depth)), y.lifted(min(x.depth, y.depth))
    if a is b or a.hash == b.hash and _same(a, b):
        return x.depth < y.depth
    if a.hash != b.hash:
        for k in reversed(range(len(a.up))):
            if k < len(a.up) and a.up[k].hash != b.up[k].hash:
                a, b = a.up[k], b.up[k]
        if a.char != b.char and _same(a.up[0], b.up[0]):
            return a.char < b.char
    return x.text() < y.text()  # two lists share a hash


class Conversation:
    """The open end of one conversation's search."""

    def __init__(self, conv_id: str | None, emit: Callable[..., None] | None = None, mod: int = MOD):
        self.conv_id, self.emit, self.mod = conv_id, emit, mod
        self.live = {START: (0, Node(mod=mod))}
        self.open: list[tuple] = []  # rows that are not handed on
        self.audit, self.state, self.place, self.sha = [], START, 0, hashlib.sha256()
        self.counts = dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0)
        self.last = self.low = self.high = None
        self.turns = 0

    def _offer(self, into: dict, state: int, cost: int, parent: Node, char: str) -> bool:
        now = into.get(state)
        if now is not None and now[0] < cost:
            return False
        node = Node(parent, char, self.mod)
        if now is not None and now[0] == cost and not less(node, now[1]):
            return False
        into[state] = (cost, node)
        return True

    def _insert(self) -> None:
        """Inserted rows at this place, as long as they make a state cheaper or its list lesser."""
        again = True
        while again:
            again = False
            for s, (cost, node) in sorted(self.live.items(), key=lambda x: x[1][0]):
                again |= self._offer(self.live, NEXT[s], cost + INSERT, node, "I")

    def add(self, turn: int | None, role: str, text: str, again: bool) -> None:
        """The next row; ``again``: its role and text were seen earlier."""
        if turn is not None:
            self.turns += turn != self.high
            self.low, self.high = turn if self.low is None else self.low, turn
        if self.last is not None:
            self.counts["illegal"] += (self.last[:1], role[:1]) not in (("s", "u"), ("u", "a"), ("a", "u"))
        self.last = role
        seen = text.rstrip(BLANKS)
        fault = "blank" if not seen else "duplicate" if again else "truncated" if seen[-1] not in ".!?" else None
        if fault:
            self.counts[fault] += 1
        self.open.append((turn, role, text))
        self._insert()
        new: dict[int, tuple[int, Node]] = {}
        for s, (cost, node) in self.live.items():
            self._offer(new, s, cost + DELETE, node, "D")
            if fault in (None, "truncated"):
                stays = cost + (TRUNCATED if fault else 0)
                kept = SYSTEM if role[:1] == "s" and s == START else NEXT[s] if role[:1] == ROLES[NEXT[s]][0] else None
                if kept is not None:
                    self._offer(new, kept, stays, node, "K")
                self._offer(new, NEXT[s], stays + REROLE, node, "R")
        best = min(cost for cost, _ in new.values())
        self.live = {s: x for s, x in new.items() if x[0] <= best + MARGIN}
        if len(self.open) >= FLUSH:
            self._hand_on()

    def _hand_on(self) -> None:
        """What every state's list begins with is settled: its rows go out, the rest becomes the list."""
        ends = [node for _, node in self.live.values()]
        shared = [x.lifted(min(x.depth for x in ends)) for x in ends]
        while any(x is not shared[0] for x in shared):
            shared = [x.up[0] for x in shared]
        n = shared[0].depth
        if not n:
            return
        self._settle(shared[0].text())
        root, made = Node(mod=self.mod), {}
        for s, (cost, node) in self.live.items():
            text = node.text()
            for i in range(n, len(text)):
                if text[n:i + 1] not in made:
                    made[text[n:i + 1]] = Node(made.get(text[n:i], root), text[i], self.mod)
            self.live[s] = (cost, made.get(text[n:], root))

    def _settle(self, edits: str) -> None:
        self.audit.append(edits)
        rows = iter(self.open)
        taken = 0
        for edit in edits:
            turn, role, text = (None, None, "") if edit == "I" else next(rows)
            taken += edit != "I"
            if edit != "D":
                to = SYSTEM if edit == "K" and role[:1] == "s" and self.state == START else NEXT[self.state]
                role = role if edit == "K" else ROLES[to]
                self.sha.update(f"{chr(10) if self.place else ''}{role}:{text}".encode())
                self.state, self.place = to, self.place + 1
            if self.emit:
                self.emit(self.conv_id, None if edit == "D" else self.place, edit, turn, role, text)
        del self.open[:taken]

    def done(self) -> tuple:
        self._insert()
        best = None
        for s in (START, ASSISTANT):
            if s in self.live and (best is None or self.live[s][0] < best[0]
                                   or self.live[s][0] == best[0] and less(self.live[s][1], best[1])):
                best = self.live[s]
        cost, node = best
        self._settle(node.text())
        gaps = 0 if self.low is None else self.high - self.low + 1 - self.turns
        return (gaps, *self.counts.values(), cost, "".join(self.audit), self.sha.hexdigest())


SUMMARY = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
EDITS = ["place", "edit", "turn", "role", "text"]
KINDS = dict.fromkeys(SUMMARY[:6], "long") | {"audit": "string", "repaired_sha256": "string", "place": "long", "edit": "string",
                                              "turn": "long", "role": "string", "text": "string"}


def _streamed(summary: bool):
    """Rows sorted by conversation in, a row for each conversation or each edit out."""
    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        out: list[tuple] = []
        emit = None if summary else lambda *x: out.append(x)
        columns = ["conv_id", *(SUMMARY if summary else EDITS)]

        def frame() -> pd.DataFrame:
            df = pd.DataFrame(out, columns=columns, dtype=object)
            out.clear()
            return df

        now = None
        number = lambda x: None if x is None else int(x)

        def close() -> None:
            end = now.done()
            if summary:
                out.append((now.conv_id, *end))

        for batch in batches:
            for conv, turn, role, text, again, kept in zip(*(batch[c] for c in ("conv", "turn", "role", "text", "again", "kept"))):
                if now is None or now.conv_id != number(conv):
                    if now is not None:
                        close()
                    now = Conversation(number(conv), emit)
                if kept:
                    now.add(number(turn), role, text, again)
            yield frame()
        if now is not None:
            close()
        yield frame()

    return run


def damaged(conversations: DataFrame) -> DataFrame:
    """The contract's damage, by ``crc32("conv_id:turn") % 20``: 0 drops the row, 1 empties its text, 2 removes
    ``.``, ``!`` and ``?``, 3 repeats it, 4 makes it the user's.  Dropped rows stay with ``kept`` false, so that
    conversations which lose all their rows are still known."""
    space = F.lit(" ")
    key = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    own = conversations.select("conv_id", "turn", F.coalesce("role", space).alias("role"), F.coalesce("text", space).alias("text"),
                               (F.crc32(key.cast("binary")) % 20).alias("h"))
    own = own.withColumn("text", F.when(F.col("h") == 1, "").when(F.col("h") == 2, F.regexp_replace("text", "[.!?]", ""))
                         .otherwise(F.col("text")))
    own = own.withColumn("role", F.when(F.col("h") == 4, "user").otherwise(F.col("role")))
    return own.select("conv_id", "turn", "role", "text", (F.col("h") != 0).alias("kept"),
                      F.explode(F.when(F.col("h") == 3, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0))))).drop("col")


def _ordered(rows: DataFrame) -> DataFrame:
    """Rows by conversation and order, each with ``again``: whether its role and text were seen earlier."""
    small_batches(rows.sparkSession)
    if "kept" not in rows.columns:
        rows = rows.withColumn("kept", F.lit(True))
    own = rows.select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"),
                      F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), "kept")
    own = cut(own.withColumn("row", F.monotonically_increasing_id()).withColumn("key", F.md5(F.col("text").cast("binary"))), "repair-rows")
    # a group's minimum: partial sums first, so a text that repeats a million times is one row of the shuffle for each task
    first = own.where("kept").groupBy("conv_id", "role", "key").agg(F.min(F.struct("turn", "row")).alias("first"))
    first = first.select(*(F.col(c).alias(f"f_{c}") for c in ("conv_id", "role", "key")), F.col("first.row").alias("f_row"))
    same: Column = F.col("conv_id").eqNullSafe(F.col("f_conv_id")) & (F.col("role") == F.col("f_role")) & (F.col("key") == F.col("f_key"))
    both = own.join(first, same, "left").withColumn("again", F.coalesce(F.col("row") != F.col("f_row"), F.lit(False)))
    return both.repartition("conv_id").sortWithinPartitions(
        F.col("conv_id").asc_nulls_first(), F.col("turn").asc_nulls_first(), "role", "text", "row").select(
        F.col("conv_id").cast("string").alias("conv"), F.col("turn").cast("string").alias("turn"), "role", "text", "again", "kept")


def _result(rows: DataFrame, summary: bool) -> DataFrame:
    names = SUMMARY if summary else EDITS
    return _ordered(rows).mapInPandas(_streamed(summary), ", ".join(["conv_id long", *(f"{c} {KINDS[c]}" for c in names)]))


def summaries(rows: DataFrame) -> DataFrame:
    """One row per conversation: conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256.
    Rows with a false ``kept`` (if there is such a column) only make their conversation known."""
    return _result(rows, True)


def repair(rows: DataFrame) -> DataFrame:
    """Every edit, in order: conv_id, place in the repaired conversation (null: deleted), edit (K, R, D or I), turn
    (null: inserted), role and text as repaired."""
    return _result(rows, False)
