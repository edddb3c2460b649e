"""Repair of the order of turns by weighted interval parsing.

A conversation is right if the initials of its roles read ``(s?(ua)+)?``: maybe a
system turn, then pairs of user and assistant, or nothing at all. Four edits make
any conversation right: each row is kept, given another role or deleted, and empty
turns are inserted anywhere. The repair grammar is in Chomsky normal form:

* A nonterminal (p, q) stands for the rows of an interval after edits that take
  the grammar from state p to state q: S nothing yet, s system, u user, a assistant.
* (p, q) -> (p, r) (r, q) joins two neighbouring intervals.
* (p, q) -> row for each edit of one row.
* Insertions are rules without a row. Their closure, the cheapest insertions
  from each state to each other, stands on both sides of every row, so no
  rule is left that gives nothing.

A cell of the chart holds the least (cost, audit) of a nonterminal over an
interval, where the audit has an initial for each edit. Intervals are joined
bottom-up by length: 1, 2, 4, ... Every derivation can be bracketed anew at any
place, since a nonterminal for every pair of states is there, so one split of an
interval is as good as all. Costs depend on the audit's letters and the rows
alone: of two audits of one cost none begins with the other, so the lesser one
stays the lesser whatever follows, and least cells make least cells.

Rows of a conversation come in order, and the intervals of ``BLOCK`` rows are
joined from the left, with the digest of the repaired text so far for each state.
So a conversation of any length takes a block, four audits and four digests.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator, Sequence
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Rows of a conversation whose cells are joined at once.
BLOCK = 256
SPACES = " \t\n\x0b\f\r"

# Faults of a row.
NONE, BLANK, DUPLICATE, TRUNCATED = range(4)
# Costs of edits, and what a truncated row costs that stays.
RENAME, DELETE, INSERT, CUT = 1, 2, 5, 5

START, END = "S", ("S", "a")
#: Where each initial leads from each state.
MOVES = {("S", "s"): "s", ("S", "u"): "u", ("s", "u"): "u", ("a", "u"): "u", ("u", "a"): "a"}
ROLES = {"u": "user", "a": "assistant"}

Cells = dict[tuple[str, str], tuple[int, str]]


def _least(cells: Cells, key: tuple[str, str], found: tuple[int, str]) -> None:
    if key not in cells or found < cells[key]:
        cells[key] = found


def joined(left: Cells, right: Cells) -> Cells:
    """The cells of two neighbouring intervals as one: (p, q) -> (p, r) (r, q)."""
    cells: Cells = {}
    for (p, r), (cost, audit) in left.items():
        for (s, q), (more, further) in right.items():
            if r == s:
                _least(cells, (p, q), (cost + more, audit + further))
    return cells


def _insertions() -> Cells:
    """The cheapest insertions from each state to each other."""
    cells: Cells = {(p, p): (0, "") for p in "Ssua"}
    once = {(p, q): (INSERT, "I") for (p, initial), q in MOVES.items() if initial in ROLES}
    while True:
        longer = joined(cells, once)
        merged = dict(cells)
        for key, found in longer.items():
            _least(merged, key, found)
        if merged == cells:
            return cells
        cells = merged


INSERTIONS = _insertions()


@lru_cache(maxsize=64)
def row_cells(initial: str, fault: int) -> Cells:
    """The cells of one row: its edits with insertions on both sides."""
    cells: Cells = {(p, p): (DELETE, "D") for p in "Ssua"}
    if fault not in (BLANK, DUPLICATE):
        cost = CUT if fault == TRUNCATED else 0
        for (p, own), q in MOVES.items():
            if own == initial:
                _least(cells, (p, q), (cost, "K"))
            if own in ROLES:
                _least(cells, (p, q), (cost + RENAME, "R"))
    return joined(joined(INSERTIONS, cells), INSERTIONS)


@lru_cache(maxsize=4096)
def chart(rows: tuple[tuple[str, int], ...]) -> Cells:
    """The cells over all rows (initial, fault), at least one, by ever longer intervals."""
    level = [row_cells(initial if initial in "sua" else "", fault) for initial, fault in rows]
    while len(level) > 1:
        pairs = [joined(a, b) for a, b in zip(level[::2], level[1::2], strict=False)]
        level = pairs + level[len(pairs) * 2 :]
    return level[0]


def edited(
    rows: Sequence[tuple[str, str]], audit: str, state: str = START
) -> Iterator[tuple[str, str, str, int | None]]:
    """What an audit makes of rows (role, text): edit, role, text and place of the row, None if inserted."""
    place = 0
    for edit in audit:
        role, text, own = "", "", None
        if edit != "I":
            (role, text), own = rows[place], place
            place += 1
        if edit == "D":
            yield edit, role, text, own
            continue
        if edit in "RI":
            role = ROLES["a" if state == "u" else "u"]
        state = MOVES[state, role[:1]]
        yield edit, role, text, own


class _Conversation:
    """One conversation while its rows pass by."""

    def __init__(self, conv_id: object) -> None:
        self.conv_id = conv_id
        self.faults = [0, 0, 0, 0]
        self.first = self.last = None
        self.turns = self.illegal = 0
        self.before: str | None = None
        self.block: list[tuple[str, str, int]] = []
        self.states = {START: (0, "", hashlib.sha256())}

    def add(self, turn: int | None, role: str, text: str, fault: int) -> None:
        if len(self.block) == BLOCK:
            self._close("Ssua")
        self.block.append((role, text, fault))
        self.faults[fault] += 1
        if turn is not None:
            self.turns += turn != self.last
            self.first = turn if self.first is None else self.first
            self.last = turn
        if self.before is not None:
            self.illegal += self.before + role[:1] not in ("su", "ua", "au")
        self.before = role[:1]

    def _close(self, ends: Sequence[str]) -> None:
        """Join the block to what is left of it, as far as it gets to these states."""
        cells = chart(tuple((role[:1], fault) for role, _, fault in self.block))
        rows = [(role, text) for role, text, _ in self.block]
        best: dict[str, tuple[int, str, str, str]] = {}
        for p, (cost, audit, _) in self.states.items():
            for q in ends:
                if (p, q) in cells:
                    more, further = cells[p, q]
                    found = (cost + more, audit + further, p, further)
                    if q not in best or found < best[q]:
                        best[q] = found
        states = {}
        for q, (cost, audit, p, further) in best.items():
            digest = self.states[p][2].copy()
            begun = p != START  # in the first state nothing is written
            for edit, role, text, _ in edited(rows, further, p):
                if edit != "D":
                    digest.update((("\n" if begun else "") + f"{role}:{text}").encode())
                    begun = True
            states[q] = (cost, audit, digest)
        self.states, self.block = states, []

    def result(self) -> tuple:
        self._close(END)  # a conversation has at least one row, so there is a block
        cost, audit, digest = min(self.states.values(), key=lambda s: s[:2])
        gaps = 0 if self.first is None else self.last - self.first + 1 - self.turns
        _, blank, duplicate, truncated = self.faults
        return (
            self.conv_id, gaps, blank, duplicate, truncated, self.illegal, cost, audit, digest.hexdigest()
        )


_LONGS = ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")
_REPORT = pa.schema(
    [("conv_id", pa.int64()), *[(n, pa.int64()) for n in _LONGS], ("audit", pa.string()), ("repaired_sha256", pa.string())]
)
REPORT_SCHEMA = "conv_id LONG, " + "".join(f"{n} LONG, " for n in _LONGS) + "audit STRING, repaired_sha256 STRING"


def _reports(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A report for each run of rows of one conv_id."""
    current: _Conversation | None = None

    def batch_of(done: list[tuple]) -> pa.RecordBatch:
        columns = zip(*done, strict=True)
        return pa.RecordBatch.from_arrays(
            [pa.array(c, f.type) for c, f in zip(columns, _REPORT, strict=True)], schema=_REPORT
        )

    for batch in batches:
        done = []
        for conv_id, *row in zip(*[c.to_pylist() for c in batch.columns], strict=True):
            if current is None or current.conv_id != conv_id:
                if current is not None:
                    done.append(current.result())
                current = _Conversation(conv_id)
            current.add(*row)
        if done:
            yield batch_of(done)
    if current is not None:
        yield batch_of([current.result()])


def with_faults(conversations: DataFrame) -> DataFrame:
    """conv_id, turn, role, text and the first fault of each row.

    Blank: nothing but white space. Duplicate: the same role and text stand
    earlier in the conversation. Truncated: the last character but white space
    isn't one of ``.!?``. Rows go by turn (NULL first), role and text; NULL roles and texts are
    empty. The rows of a conversation end in one partition.
    """
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).repartition("conv_id")
    same = Window.partitionBy("conv_id", "role", F.sha2("text", 256)).orderBy(F.col("turn").asc_nulls_first())
    ends = F.right(F.rtrim("text", F.lit(SPACES)), F.lit(1))
    fault = (
        F.when(ends == "", BLANK)
        .when(F.row_number().over(same) > 1, DUPLICATE)
        .when(~ends.isin(".", "!", "?"), TRUNCATED)
        .otherwise(NONE)
    )
    return rows.withColumn("fault", fault)


def repair(conversations: DataFrame) -> DataFrame:
    """One row for each conv_id: its faults, and the cheapest edits that put its turns in order.

    Input: conv_id, turn, role, text; other columns are ignored. ``gaps`` counts
    turns missing between the first and the last; ``blank``, ``duplicate`` and
    ``truncated`` count rows by their first fault; ``illegal`` counts neighbours
    that no right conversation has. ``cost`` and ``audit`` are those of the least
    edits, where keeping costs 0, another role 1, deleting 2, inserting 5, and a
    truncated row that stays 5 more; blank and duplicate rows are deleted. Of
    equally cheap audits the ASCII-least counts. ``repaired_sha256`` is the
    digest of the repaired ``role:text`` lines. A NULL conv_id is a conversation
    too; repeated rows are duplicates; an empty table gives no rows.

    A conversation is read as a stream by one task, as its digest can only be
    taken in order; the task keeps a block of its rows and a letter per edit.
    """
    copies_last = F.col("fault") == DUPLICATE  # of rows that are the same, the first isn't the duplicate
    rows = with_faults(conversations).sortWithinPartitions("conv_id", "turn", "role", "text", copies_last)
    return rows.mapInArrow(_reports, REPORT_SCHEMA)


def repaired_turns(conversations: DataFrame, report: DataFrame) -> DataFrame:
    """The edits of all conversations: conv_id, place, edit, role, text, and the row's old turn and role.

    ``place`` numbers edits from 0, deletions included; without those, the rows
    are the repaired conversations. Inserted turns have no old turn. Windows number
    the rows and edits of a conversation in the order of the report; they keep
    one row at a time, and their sorts spill.
    """
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "text")
    rows = with_faults(conversations).select(
        "conv_id", "turn", "role", "text", F.row_number().over(order).alias("number")
    )
    letters = "transform(sequence(1, length(audit)), i -> substr(audit, i, 1))"
    # The state before each edit depends on the roles of kept rows, which only ever begin a conversation.
    steps = report.filter("audit <> ''").selectExpr("conv_id", f"posexplode({letters}) AS (place, edit)")
    before = Window.partitionBy("conv_id").orderBy("place")
    numbered = steps.select(
        "conv_id",
        "place",
        "edit",
        F.when(F.col("edit") != "I", F.sum((F.col("edit") != "I").cast("int")).over(before)).alias("number"),
        F.sum((F.col("edit") != "D").cast("int")).over(before).alias("written"),
    )
    same = numbered["conv_id"].eqNullSafe(rows["conv_id"]) & (numbered["number"] == rows["number"])
    met = numbered.join(rows, same, "left").select(
        numbered["conv_id"], "place", "edit", "written", F.col("turn").alias("old_turn"),
        F.col("role").alias("old_role"), F.coalesce("text", F.lit("")).alias("text"),
    )
    system = F.max(
        F.when((F.col("written") == 1) & (F.col("edit") == "K") & F.col("old_role").startswith("s"), 1).otherwise(0)
    ).over(Window.partitionBy("conv_id"))
    made = F.when((F.col("written") - system) % 2 == 1, "user").otherwise("assistant")
    return met.select(
        "conv_id",
        "place",
        "edit",
        F.when(F.col("edit").isin("R", "I"), made).otherwise(F.col("old_role")).alias("role"),
        "text",
        "old_turn",
        "old_role",
    )
