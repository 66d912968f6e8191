"""Chat formatting: a finite-state machine over roles and a declarative template, in SQL functions only."""

from __future__ import annotations

import itertools
import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Turn:
    """How one role is written: a mark before its text, one after it, and whether the text is learned from."""

    opens: str
    closes: str
    loss: bool = False


@dataclass(frozen=True)
class ChatTemplate:
    """Marks by role, the marks of all other roles, and the order that turns may take.

    ``other`` has three marks: one before the role's name, one between name and
    text, one after the text. ``moves`` gives the state that a role leads to from a
    state; a conversation starts in ``start`` and is whole when it ends in one of
    ``ends``. Marks are the control strings: none may lie in another or begin where
    another ends, and none may hold ``escape``. ``gap`` stands between marks and texts.
    """

    turns: dict[str, Turn]
    other: tuple[str, str, str]
    moves: dict[tuple[str, str], str]
    start: str = "start"
    ends: tuple[str, ...] = ("assistant",)
    escape: str = "␛"
    gap: str = " "
    controls: tuple[str, ...] = field(init=False)

    def __post_init__(self):
        marks = [m for t in self.turns.values() for m in (t.opens, t.closes)] + list(self.other)
        if len(set(marks)) != len(marks) or not all(marks) or len(self.escape) != 1:
            raise ValueError("marks must be different and not empty, the escape one character")
        for a, b in itertools.product(marks, marks):
            meets = any(a.endswith(b[:n]) for n in range(1, min(len(a), len(b)) + (a != b)))
            if meets or (a != b and a in b) or self.escape in a or self.gap in a:
                raise ValueError(f"marks {a!r} and {b!r} cannot be told apart")
        object.__setattr__(self, "controls", tuple(marks))


#: User turns in [INST], the system's in [SYS], answers in <s>.
INSTRUCT = ChatTemplate(
    turns={"system": Turn("[SYS]", "[/SYS]"), "user": Turn("[INST]", "[/INST]"), "assistant": Turn("<s>", "</s>", loss=True)},
    other=("[ROLE]", "[TEXT]", "[/ROLE]"),
    moves={("start", "system"): "system", ("start", "user"): "user", ("system", "user"): "user",
           ("user", "assistant"): "assistant", ("assistant", "user"): "user"},
)

#: State of a conversation once a turn had no place.
_LOST = "invalid"


def escape(text: Column, template: ChatTemplate) -> Column:
    """``text`` without any control string: the escape character goes behind the first character of each."""
    e = template.escape
    out = F.replace(text, F.lit(e), F.lit(f"{e}0"))
    for mark in template.controls:
        out = F.replace(out, F.lit(mark), F.lit(f"{mark[0]}{e}1{mark[1:]}"))
    return out


def unescape(text: Column, template: ChatTemplate) -> Column:
    """The text that ``escape`` was given."""
    e = template.escape
    return F.replace(F.replace(text, F.lit(f"{e}1"), F.lit("")), F.lit(f"{e}0"), F.lit(e))


def segments(role: Column, text: Column, template: ChatTemplate) -> Column:
    """array<struct<text, loss>> of one turn: its marks, and its escaped text under the role's loss flag."""
    def part(value: Column, loss: bool) -> Column:
        return F.struct(value.alias("text"), F.lit(loss).alias("loss"))

    gap, body = template.gap, escape(text, template)
    name, middle, last = template.other
    out = F.array(part(F.concat(F.lit(name + gap), escape(role, template), F.lit(gap + middle + gap)), False),
                  part(body, False), part(F.lit(gap + last), False))
    for known, turn in template.turns.items():
        own = F.array(part(F.lit(turn.opens + gap), False), part(body, turn.loss), part(F.lit(gap + turn.closes), False))
        out = F.when(role == known, own).otherwise(out)
    return out


def _said(turns: DataFrame, conv_id: str, turn: str, role: str, text: str) -> DataFrame:
    return turns.select(
        F.col(f"`{conv_id}`").alias("conv_id"), F.col(f"`{turn}`").alias("turn"),
        F.coalesce(F.col(f"`{role}`"), F.lit("")).alias("role"), F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"))


def turn_segments(turns: DataFrame, template: ChatTemplate = INSTRUCT, conv_id: str = "conv_id", turn: str = "turn",
                  role: str = "role", text: str = "text") -> DataFrame:
    """conv_id, turn, role, text, segments of every row; nothing is shuffled.

    A null role or text counts as empty; a role that the template does not list is
    written with the marks of other roles. Extra columns are left out.
    """
    return _said(turns, conv_id, turn, role, text).withColumn("segments", segments(F.col("role"), F.col("text"), template))


def _final_state(roles: Column, template: ChatTemplate) -> Column:
    """struct<state, place, broken_at> after all roles; ``broken_at`` is the place of the first one without a move."""
    def step(acc: Column, role: Column) -> Column:
        after = F.lit(_LOST)
        for (state, known), to in template.moves.items():
            after = F.when((acc["state"] == state) & (role == known), to).otherwise(after)
        return F.struct(
            after.alias("state"), (acc["place"] + 1).alias("place"),
            F.coalesce(acc["broken_at"], F.when(after == _LOST, acc["place"])).alias("broken_at"))

    first = F.struct(F.lit(template.start).alias("state"), F.lit(0).cast("long").alias("place"), F.lit(None).cast("long").alias("broken_at"))
    return F.aggregate(roles, first, step)


def format_chats(turns: DataFrame, template: ChatTemplate = INSTRUCT, conv_id: str = "conv_id", turn: str = "turn",
                 role: str = "role", text: str = "text") -> DataFrame:
    """One row per conversation: conv_id, formatted, segments, state, broken_at, valid.

    ``segments`` is array<struct<text, loss>>, whose texts joined are ``formatted``.
    Turns stand by turn number, ties by role and text, nulls first; a row that is
    repeated is a turn each time, rows without conversation id are one conversation.
    ``state`` is where the machine over roles ends, ``broken_at`` the place (from 0) of the first
    turn out of order; such a conversation is formatted all the same, ``valid`` says
    whether it is in order and whole. A null role or text counts as empty. No rows give no rows.

    One shuffle moves every text once. A conversation is one string, so it must fit
    one row (2 GB); ``turn_segments`` has no such bound.
    """
    rows = _said(turns, conv_id, turn, role, text)
    chats = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("said"))
    parts = F.flatten(F.transform("said", lambda t: segments(t["role"], t["text"], template)))
    out = chats.select("conv_id", parts.alias("segments"), _final_state(F.col("said.role"), template).alias("end"))
    return out.select(
        "conv_id", F.array_join(F.col("segments.text"), "").alias("formatted"), "segments", F.col("end.state").alias("state"),
        F.col("end.broken_at").alias("broken_at"), F.col("end.state").isin(list(template.ends)).alias("valid"))


def read_back(formatted: Column, template: ChatTemplate = INSTRUCT) -> Column:
    """array<struct<role, text>>: the turns of a formatted conversation, as they were before.

    Only marks can be control strings there, so each turn goes to the first closing mark.
    """
    def quoted(marks) -> str:
        return "|".join(re.escape(m) for m in marks)

    gap = len(template.gap)
    opens = [t.opens for t in template.turns.values()] + [template.other[0]]
    closes = [t.closes for t in template.turns.values()] + [template.other[2]]
    found = F.regexp_extract_all(formatted, F.lit(f"(?s)(?:{quoted(opens)}).*?(?:{quoted(closes)})"), F.lit(0))

    def between(said: Column, opened: int, closed: int) -> Column:
        return F.substring(said, F.lit(opened + 1), F.char_length(said) - F.lit(opened + closed))

    def turn(said: Column) -> Column:
        name, middle, last = template.other
        both = between(said, len(name) + gap, len(last) + gap)
        cut = template.gap + middle + template.gap
        at = F.instr(both, cut)
        out = F.struct(unescape(F.substring(both, F.lit(1), at - 1), template).alias("role"),
                       unescape(F.substring(both, at + len(cut), F.char_length(both)), template).alias("text"))
        for role, t in template.turns.items():
            text = unescape(between(said, len(t.opens) + gap, len(t.closes) + gap), template)
            out = F.when(said.startswith(t.opens), F.struct(F.lit(role).alias("role"), text.alias("text"))).otherwise(out)
        return out

    return F.transform(found, turn)


def learned_text(parts: Column, template: ChatTemplate = INSTRUCT) -> Column:
    """All text under the loss flag, as it was before, nothing between."""
    return F.array_join(F.transform(F.filter(parts, lambda p: p["loss"]), lambda p: unescape(p["text"], template)), "")
