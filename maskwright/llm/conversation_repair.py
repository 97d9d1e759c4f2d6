"""Faults in the structure of conversations, and the cheapest edits that mend it.

A conversation should be an optional system row and then user and assistant in turns. Its rows
are kept, given another role, deleted, or joined by new empty rows, each at a cost. Iterative
deepening A* finds the cheapest edits: depth first, in the ASCII order of the edits' letters,
under a bound that rises to the least cost that may still succeed; a table keeps, for each
row and role before it, the cost below which the search has failed there. So the first path
that ends well is the answer, and of equally cheap ones the least as text.

A conversation of more than ``BLOCK`` rows is searched block by block, from each role before a
block to each role after it. Insertions count to the block of the row behind them, so no text
of edits of a block begins another one, and the best paths to the end of a block extend
the best ones to its beginning: the result is that of one search over all rows.

Two passes, each a shuffle by conversation and a sort inside tasks. The first takes a few bytes
for each row and gives faults and edits; the second streams the texts past the edits. A
conversation of any length needs memory only for its edits, never for its texts.

Defined cases: rows are in the order of turn, nulls first, then role, then SHA-256 of the text.
A null role or text counts as one space. A null conversation is one conversation, repeated
rows are faults of the second one on, long texts are read whole, an empty table gives none.
Other columns are not read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass, field
from functools import lru_cache
from math import inf

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from maskwright.llm.tables import column, stored

DELETE, INSERT, KEEP, REROLE = "DIKR"
#: What edits cost, and what a row adds that is cut off and not deleted.
DELETE_COST, INSERT_COST, REROLE_COST, TRUNCATED_COST = 4, 3, 3, 3
BLOCK = 16
KEPT_BLOCKS = 100_000
#: Output rows at a time, in characters of text.
OUTPUT = 4_000_000

#: What came before: nothing, the system row, a user's row, an assistant's row.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = (START, SYSTEM, USER, ASSISTANT)
WHOLE = (START, ASSISTANT)
_ROLE = {START: "user", SYSTEM: "user", USER: "assistant", ASSISTANT: "user"}
_NEXT = {START: USER, SYSTEM: USER, USER: ASSISTANT, ASSISTANT: USER}
_LEGAL = {"su", "ua", "au"}

#: Faults of a row; a row has its first one only.
FINE, BLANK, DUPLICATE, TRUNCATED = range(4)
#: Rows as letters for the search: initial of the role, or ``?`` for others; upper case if the
#: row is truncated; ``-`` if it must go.
_LETTERS = {"s": "s", "u": "u", "a": "a"}


def _kept(state: int, letter: str) -> int | None:
    """The state after a row that stays as it is; None where it can't."""
    initial = letter.lower()
    if initial == "s":
        return SYSTEM if state == START else None
    if initial == _ROLE[state][0]:
        return _NEXT[state]
    return None


def _least(letter: str) -> int:
    """What a row costs whatever stands around it."""
    if letter == "-":
        return DELETE_COST
    return TRUNCATED_COST if letter.isupper() or letter == "!" else 0


@lru_cache(KEPT_BLOCKS)
def search(rows: str, start: int, goals: tuple[int, ...], last: bool) -> tuple[int, str] | None:
    """The cost and the edits of the cheapest path from a state through all rows to a goal; of
    equally cheap ones the least as text. New rows come before rows, and behind the
    last one only if ``last``. None if there is no path."""
    size = len(rows)
    rest = [0] * (size + 1)
    for i in range(size - 1, -1, -1):
        rest[i] = rest[i + 1] + _least(rows[i])
    #: Failed states: no path from there costs less than this.
    failed: dict[tuple[int, int], float] = {}
    path: list[str] = []

    def moves(i: int, state: int) -> Iterator[tuple[str, int, int, int]]:
        if i < size:
            yield DELETE, DELETE_COST, i + 1, state
        if i < size or last:
            yield INSERT, INSERT_COST, i, _NEXT[state]
        if i < size and rows[i] != "-":
            more = _least(rows[i])
            after = _kept(state, rows[i])
            if after is not None:
                yield KEEP, more, i + 1, after
            yield REROLE, REROLE_COST + more, i + 1, _NEXT[state]

    def visit(i: int, state: int, left: float) -> bool:
        if i == size and state in goals:
            return True
        least = inf
        for edit, cost, j, after in moves(i, state):
            needed = cost + failed.get((j, after), rest[j])
            if needed <= left:
                path.append(edit)
                if visit(j, after, left - cost):
                    return True
                path.pop()
                needed = cost + failed.get((j, after), rest[j])
            least = min(least, needed)
        failed[i, state] = least
        return False

    # Deleting all rows but one and two new ones lead to every state that can be reached.
    most = DELETE_COST * size + 2 * INSERT_COST
    bound: float = rest[0]
    while bound <= most and any(_reached(rows, start, goal) for goal in goals):
        if visit(0, start, bound):
            return int(bound), "".join(path)
        bound = failed[0, start]
    return None


def _reached(rows: str, start: int, goal: int) -> bool:
    """Whether edits of some rows can lead from a state to another one."""
    if goal == SYSTEM and start == START:
        return "s" in rows.lower()
    return goal in (USER, ASSISTANT) or goal == start


class Search:
    """The search over the rows of one conversation, given one by one."""

    def __init__(self):
        self.rows: list[str] = []
        # For each state after the blocks so far: cost and place among the edits of all states.
        self.best: dict[int, tuple[int, int]] = {START: (0, 0)}
        # For each block and state after it: the state before it and the block's edits.
        self.back: list[dict[int, tuple[int, str]]] = []

    def add(self, letter: str) -> None:
        if len(self.rows) == BLOCK:
            self._close()
        self.rows.append(letter)

    def _close(self) -> None:
        rows = "".join(self.rows)
        self.rows.clear()
        reached = {}
        for after in STATES:
            found = []
            for before, (cost, place) in self.best.items():
                if path := search(rows, before, (after,), False):
                    found.append((cost + path[0], place, path[1], before))
            if found:
                reached[after] = min(found)
        order = sorted(reached, key=lambda state: reached[state][1:3])
        self.best = {state: (reached[state][0], order.index(state)) for state in reached}
        self.back.append({state: (r[3], r[2]) for state, r in reached.items()})

    def result(self) -> tuple[int, str]:
        """The cost and the edits of all rows."""
        rows = "".join(self.rows)
        found = []
        for before, (cost, place) in self.best.items():
            if path := search(rows, before, WHOLE, True):
                found.append((cost + path[0], place, path[1], before))
        cost, _, edits, state = min(found)
        parts = [edits]
        for block in reversed(self.back):
            state, edits = block[state]
            parts.append(edits)
        return cost, "".join(reversed(parts))


@dataclass
class _Conversation:
    """Counts over the rows of one conversation, in order."""

    key: object
    search: Search = field(default_factory=Search)
    first: int | None = None
    turn: int | None = None
    turns: int = 0
    initial: str | None = None
    illegal: int = 0
    faults: list[int] = field(default_factory=lambda: [0] * 4)

    def add(self, turn: int | None, initial: str, fault: int) -> None:
        if turn is not None and turn != self.turn:
            self.first = turn if self.first is None else self.first
            self.turn = turn
            self.turns += 1
        if self.initial is not None:
            self.illegal += self.initial + initial not in _LEGAL
        self.initial = initial
        self.faults[fault] += 1
        letter = _LETTERS.get(initial, "?")
        if fault in (BLANK, DUPLICATE):
            letter = "-"
        elif fault == TRUNCATED:
            letter = "!" if letter == "?" else letter.upper()
        self.search.add(letter)

    def result(self) -> tuple:
        gaps = 0 if self.turn is None else self.turn - self.first + 1 - self.turns
        cost, edits = self.search.result()
        return (self.key, gaps, *self.faults[BLANK:], self.illegal, cost, edits)


_COUNTS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")


@dataclass(frozen=True)
class Repair:
    """``audits``: one row for each conversation that has rows (conversation, gaps, blank,
    duplicate, truncated, illegal, cost, audit), the audit being the edits' letters.
    ``rows``: the repaired rows (conversation, place, edit, role, text); each task has its
    conversations one after the other and their rows in order."""

    audits: DataFrame
    rows: DataFrame


def repair(
    rows: DataFrame,
    *,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
) -> Repair:
    """Faults and cheapest edits of conversations, and their repaired rows."""
    space = F.lit(" ")
    given = rows.select(
        column(rows, conversation).alias("conversation"),
        column(rows, turn).cast("bigint").alias("turn"),
        F.coalesce(column(rows, role).cast("string"), space).alias("role"),
        F.coalesce(column(rows, text).cast("string"), space).alias("text"),
    )
    given = given.withColumn("digest", F.unhex(F.sha2("text", 256)))
    audits = stored(_audits(given), "audits")
    return Repair(audits, _repaired(given, audits))


def _faults(given: DataFrame) -> DataFrame:
    """(conversation, turn, role, digest, initial, fault): no texts."""
    blank = ~F.col("text").rlike(r"[^\x20\x09-\x0D]")
    cut = ~F.col("text").rlike(r"[.!?][\x20\x09-\x0D]*\z")
    seen = Window.partitionBy("conversation", "role", "digest").orderBy(F.asc_nulls_first("turn"))
    coded = given.select(
        "conversation", "turn", "role", "digest", blank.alias("blank"), cut.alias("cut")
    )
    repeated = F.row_number().over(seen) > 1
    return coded.withColumn("repeated", repeated).select(
        "conversation",
        "turn",
        "role",
        "digest",
        F.substring("role", 1, 1).alias("initial"),
        F.when(F.col("blank"), BLANK)
        .when(F.col("repeated"), DUPLICATE)
        .when(F.col("cut"), TRUNCATED)
        .otherwise(FINE)
        .alias("fault"),
    )


def _audits(given: DataFrame) -> DataFrame:
    # Of equal rows the one that is no duplicate comes first.
    order = [F.asc_nulls_first("turn"), "role", "digest", F.col("fault") == DUPLICATE]
    ordered = _faults(given).repartition("conversation")
    ordered = ordered.sortWithinPartitions("conversation", *order)
    kind = given.schema["conversation"].dataType
    schema = T.StructType([T.StructField("conversation", kind)])
    for name in _COUNTS:
        schema = schema.add(name, "long")
    schema = schema.add("audit", "string")

    def audited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own: _Conversation | None = None
        for batch in batches:
            done = []
            for key, *row in zip(*(c.to_pylist() for c in batch.columns)):
                if own is None or own.key != key:
                    if own is not None:
                        done.append(own.result())
                    own = _Conversation(key)
                own.add(*row)
            if done:
                yield table_of(done, batch.schema.field(0).type)
        if own is not None:
            yield table_of([own.result()], batch.schema.field(0).type)

    def table_of(done: list[tuple], key: pa.DataType) -> pa.RecordBatch:
        kinds = [key, *[pa.int64()] * len(_COUNTS), pa.string()]
        columns = [pa.array(list(c), k) for c, k in zip(zip(*done), kinds)]
        return pa.RecordBatch.from_arrays(columns, schema.names)

    return ordered.select("conversation", "turn", "initial", "fault").mapInArrow(audited, schema)


def _repaired(given: DataFrame, audits: DataFrame) -> DataFrame:
    """The rows, streamed past the audit of their conversation, which comes before them."""
    none = F.lit(None)
    texts = given.select(
        "conversation", "turn", "role", "text", "digest", none.cast("string").alias("audit")
    )
    heads = audits.select(
        "conversation",
        none.cast("bigint").alias("turn"),
        none.cast("string").alias("role"),
        none.cast("string").alias("text"),
        none.cast("binary").alias("digest"),
        "audit",
    )
    order = [F.col("audit").isNull(), F.asc_nulls_first("turn"), "role", "digest"]
    both = heads.unionByName(texts).repartition("conversation")
    both = both.sortWithinPartitions("conversation", *order)
    schema = T.StructType([T.StructField("conversation", given.schema["conversation"].dataType)])
    for name, kind in (("place", "long"), ("edit", "string"), ("role", "string"), ("text", "string")):
        schema = schema.add(name, kind)

    def edited(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, audit, at, place, state = None, "", 0, 0, START
        out, held, kind = [], 0, None

        def flush() -> pa.RecordBatch:
            kinds = [kind, pa.int64(), pa.string(), pa.string(), pa.string()]
            columns = [pa.array(list(c), k) for c, k in zip(zip(*out), kinds)]
            out.clear()
            return pa.RecordBatch.from_arrays(columns, schema.names)

        def put(edit: str, role: str, text: str) -> None:
            nonlocal place, held
            out.append((key, place, edit, role, text))
            place += 1
            held += len(text)

        def inserted() -> None:
            nonlocal at, state
            while at < len(audit) and audit[at] == INSERT:
                put(INSERT, _ROLE[state], "")
                state = _NEXT[state]
                at += 1

        for batch in batches:
            kind = batch.schema.field(0).type
            for head, role, text, edits in zip(*(c.to_pylist() for c in batch.columns)):
                if edits is not None:
                    inserted()  # behind the last row of the conversation before
                    key, audit, at, place, state = head, edits, 0, 0, START
                    continue
                inserted()
                edit = audit[at]
                at += 1
                if edit == KEEP:
                    put(KEEP, role, text)
                    state = SYSTEM if role[0] == "s" else _NEXT[state]
                elif edit == REROLE:
                    put(REROLE, _ROLE[state], text)
                    state = _NEXT[state]
                if held > OUTPUT:
                    yield flush()
                    held = 0
            if out:
                yield flush()
                held = 0
        inserted()
        if out:
            yield flush()

    return both.select("conversation", "role", "text", "audit").mapInArrow(edited, schema)


def digests(rows: DataFrame) -> DataFrame:
    """(conversation, sha256) over the repaired rows of ``repair``: of ``role:text`` for each,
    joined by newlines, taken row by row."""
    lines = rows.select("conversation", F.concat_ws(":", "role", "text").alias("line"))
    schema = T.StructType([rows.schema["conversation"]]).add("sha256", "string")

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, digest, kind = None, None, None

        def done(found: list[tuple]) -> pa.RecordBatch:
            keys, values = zip(*found)
            return pa.RecordBatch.from_arrays(
                [pa.array(list(keys), kind), pa.array(list(values), pa.string())], schema.names
            )

        for batch in batches:
            kind, found = batch.schema.field(0).type, []
            for own, value in zip(*(c.to_pylist() for c in batch.columns)):
                if digest is None or own != key:
                    if digest is not None:
                        found.append((key, digest.hexdigest()))
                    key, digest = own, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(value.encode())
            if found:
                yield done(found)
        if digest is not None:
            yield done([(key, digest.hexdigest())])

    return lines.mapInArrow(hashed, schema)
