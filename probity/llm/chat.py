"""Conversations as marked text: a declarative template, a state machine over the roles.

Built-in functions only. Control strings inside texts are escaped with a
backslash behind their first character, backslashes by doubling them, so the
written form can be read back exactly.
"""

from __future__ import annotations

import re
from collections.abc import Mapping
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ESCAPE = "\\"


@dataclass(frozen=True)
class Turn:
    """What stands before and behind a text, and whether the text counts for the loss."""

    before: str
    after: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    """Marks per role, marks of all other roles, and the turns allowed in each state.

    ``follows[state]`` lists the roles that may come next; a role is the state
    after its turn, and the first state is the empty text.
    """

    turns: Mapping[str, Turn]
    follows: Mapping[str, tuple[str, ...]]
    role_marks: tuple[str, str] = ("<<ROLE>>", "<</ROLE>>")
    other_after: str = "<</TURN>>"
    controls: tuple[str, ...] = field(init=False)

    def __post_init__(self) -> None:
        marks = [m for t in self.turns.values() for m in (t.before, t.after)]
        found = tuple(dict.fromkeys([*marks, *self.role_marks, self.other_after]))
        for mark in found:
            if len(mark) < 2 or ESCAPE in mark:
                raise ValueError(f"a mark has two characters and no backslash: {mark!r}")
            if any(mark[:n] == mark[-n:] for n in range(1, len(mark))):
                raise ValueError(f"a mark must not end as it begins: {mark!r}")
            if any(mark != other and mark in other for other in found):
                raise ValueError(f"no mark may contain another: {mark!r}")
        if len({t.before for t in self.turns.values()}) < len(self.turns):
            raise ValueError("each role needs a mark of its own")
        object.__setattr__(self, "controls", found)


TEMPLATE = Template(
    turns={
        "system": Turn("[SYS]", "[/SYS]"),
        "user": Turn("[INST]", "[/INST]"),
        "assistant": Turn("<s>", "</s>", loss=True),
    },
    follows={
        "": ("system", "user"),
        "system": ("user",),
        "user": ("assistant",),
        "assistant": ("user",),
    },
)


def escaped(text: Column, template: Template) -> Column:
    """The text without any control string of the template."""
    text = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE * 2))
    for mark in template.controls:
        text = F.replace(text, F.lit(mark), F.lit(mark[0] + ESCAPE + mark[1:]))
    return text


def unescaped(text: Column) -> Column:
    return F.regexp_replace(text, r"(?s)\\(.)", "$1")


def _segments(turn: Column, template: Template) -> Column:
    def segment(text: Column | str, loss: bool = False) -> Column:
        text = F.lit(text) if isinstance(text, str) else text
        return F.struct(text.alias("text"), F.lit(loss).alias("loss"))

    content = escaped(turn["text"], template)
    opened, closed = template.role_marks
    found = F.array(
        segment(opened),
        segment(escaped(turn["role"], template)),
        segment(closed),
        segment(content),
        segment(template.other_after),
    )
    for role, marks in template.turns.items():
        own = F.array(segment(marks.before), segment(content, marks.loss), segment(marks.after))
        found = F.when(turn["role"] == role, own).otherwise(found)
    return found


def _machine(turns: Column, template: Template) -> Column:
    """The machine's run over the turns: its last state, the turns read, and the first that it didn't allow.

    A turn that is not allowed is noted, and the machine goes on from its role.
    """
    allowed = F.array(*[F.lit(f"{a}\n{b}") for a, follow in template.follows.items() for b in follow])

    def run(state: Column, read: Column, wrong: Column) -> Column:
        return F.struct(state.alias("state"), read.alias("read"), wrong.alias("first_wrong"))

    def step(now: Column, turn: Column) -> Column:
        known = F.array_contains(allowed, F.concat(now["state"], F.lit("\n"), turn["role"]))
        wrong = F.coalesce(now["first_wrong"], F.when(~known, now["read"]))
        return run(turn["role"], now["read"] + 1, wrong)

    start = run(F.lit(""), F.lit(0).cast("long"), F.lit(None).cast("long"))
    return F.aggregate(turns, start, step)


def format_conversations(conversations: DataFrame, template: Template = TEMPLATE) -> DataFrame:
    """One row per conv_id: n_turns, segments (text, loss), first_wrong, valid, formatted.

    Input columns: conv_id, turn, role, text; others are ignored. Turns go by
    turn, role and text, NULL first; repeated rows are turns of their own. A NULL
    text or role is empty. Roles the template does not know get general marks.
    ``first_wrong`` is the place, from 0, of the first turn that the template does not
    allow after the one before it, NULL if there is none, and ``valid`` says whether
    there is none. Other conversations are written all the same. An empty table
    gives no rows.
    """
    row = F.struct(
        F.col("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    )
    turns = conversations.groupBy("conv_id").agg(F.array_sort(F.collect_list(row)).alias("turns"))
    run = turns.select("conv_id", "turns", _machine(F.col("turns"), template).alias("run"))
    written = run.select(
        "conv_id",
        F.col("run.read").alias("n_turns"),
        F.flatten(F.transform("turns", lambda t: _segments(t, template))).alias("segments"),
        F.col("run.first_wrong").alias("first_wrong"),
        F.col("run.first_wrong").isNull().alias("valid"),
    )
    joined = F.array_join(F.transform("segments", lambda s: s["text"]), "")
    return written.withColumn("formatted", joined)


def read_turns(formatted: Column, template: Template = TEMPLATE) -> Column:
    """The turns of a formatted text, as an array of (role, text)."""

    def any_of(marks: list[str]) -> str:
        return "|".join(re.escape(m) for m in marks)

    own = any_of([t.before for t in template.turns.values()])
    opened, closed = map(re.escape, template.role_marks)
    ends = any_of([*dict.fromkeys(t.after for t in template.turns.values()), template.other_after])
    turn = F.lit(f"(?s)(?:({own})|{opened}(.*?){closed})(.*?)(?:{ends})")
    parts = [F.regexp_extract_all(formatted, turn, F.lit(k)) for k in (1, 2, 3)]
    role_of = F.create_map(
        *[F.lit(x) for role, marks in template.turns.items() for x in (marks.before, role)]
    )
    zipped = F.arrays_zip(*[p.alias(n) for p, n in zip(parts, ("mark", "role", "text"), strict=True)])
    return F.transform(
        zipped,
        lambda t: F.struct(
            F.coalesce(F.try_element_at(role_of, t["mark"]), unescaped(t["role"])).alias("role"),
            unescaped(t["text"]).alias("text"),
        ),
    )


def read_loss(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    kept = F.filter(segments, lambda s: s["loss"])
    return F.array_join(F.transform(kept, lambda s: unescaped(s["text"])), "")
