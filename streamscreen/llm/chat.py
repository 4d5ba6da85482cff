"""Conversations as one formatted text with loss flags.

A ``Template`` declares the roles, which role may follow which, which roles are trained on, and the
strings around a turn. Turns run through the template's state machine in order; the first turn that
may not follow its predecessor is reported. The output is a list of segments (text, loss), whose
concatenation is the formatted conversation. Control strings inside texts and roles are escaped, so
a turn can never forge a marker, and ``read_back`` restores every turn from the formatted text alone.

Defined results: a null text or role is ''; turns are ordered by turn (null first), then role and
text, and repeated rows are repeated turns; an unknown role is formatted without loss and reported as
a violation; rows with a null conv_id form one conversation of that id; an empty table gives no rows;
other columns are ignored. A conversation is one row of the output, and so is as long as its turns.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Template:
    """``turn_open`` + role + ``role_end`` + text + ``turn_close`` for each turn."""

    turn_open: str = "<|im_start|>"
    role_end: str = "\n"
    turn_close: str = "<|im_end|>\n"
    start: str = "start"
    #: state (the last role, or ``start``) -> roles that may come next
    follows: Mapping[str, Sequence[str]] = field(default_factory=lambda: {
        "start": ("system", "user"), "system": ("user",), "user": ("assistant",),
        "assistant": ("user", "tool"), "tool": ("assistant",)})
    trained: Sequence[str] = ("assistant",)
    #: what a control string begins with, and how it is written inside a text
    marker: str = "<|"
    escaped_marker: str = "&lt;|"
    #: replacements made before the marker's, so that reading back is unambiguous
    escape_first: tuple[str, str] = ("&", "&amp;")
    escaped_line: str = "&#10;"


CHAT = Template()


def escape(text: Column, t: Template = CHAT) -> Column:
    return F.replace(F.replace(text, F.lit(t.escape_first[0]), F.lit(t.escape_first[1])),
                     F.lit(t.marker), F.lit(t.escaped_marker))


def unescape(text: Column, t: Template = CHAT) -> Column:
    return F.replace(F.replace(text, F.lit(t.escaped_marker), F.lit(t.marker)),
                     F.lit(t.escape_first[1]), F.lit(t.escape_first[0]))


def _escape_role(role: Column, t: Template) -> Column:
    """A role ends at the line's end, so a line break inside it is escaped too."""
    return F.replace(escape(role, t), F.lit("\n"), F.lit(t.escaped_line))


def _unescape_role(role: Column, t: Template) -> Column:
    return unescape(F.replace(role, F.lit(t.escaped_line), F.lit("\n")), t)


def _allowed(state: Column, role: Column, t: Template) -> Column:
    rules = [(state == s) & role.isin(*nexts) for s, nexts in t.follows.items()]
    return reduce(lambda a, b: a | b, rules, F.lit(False))


def _first_violation(turns: Column, t: Template) -> Column:
    """Position of the first turn that may not come where it does; null if there is none."""
    begin = F.struct(F.lit(t.start).alias("state"), F.lit(0).alias("at"), F.lit(None).cast("int").alias("bad"))

    def step(acc: Column, turn: Column) -> Column:
        bad = F.when(acc["bad"].isNull() & ~_allowed(acc["state"], turn["role"], t), acc["at"]).otherwise(acc["bad"])
        return F.struct(turn["role"].alias("state"), (acc["at"] + 1).alias("at"), bad.alias("bad"))

    return F.aggregate(turns, begin, step, lambda acc: acc["bad"])


def _segments(turns: Column, t: Template) -> Column:
    def of(turn: Column) -> Column:
        loss = turn["role"].isin(*t.trained)
        head = F.concat(F.lit(t.turn_open), _escape_role(turn["role"], t), F.lit(t.role_end))
        return F.array(F.struct(head.alias("text"), F.lit(False).alias("loss")),
                       F.struct(escape(turn["text"], t).alias("text"), loss.alias("loss")),
                       F.struct(F.lit(t.turn_close).alias("text"), F.lit(False).alias("loss")))

    return F.flatten(F.transform(turns, of))


def format_conversations(rows: DataFrame, template: Template = CHAT) -> DataFrame:
    """conv_id, segments (array of text and loss flag), formatted, valid, first_violation."""
    turns = rows.groupBy("conv_id").agg(F.array_sort(F.collect_list(F.struct(
        F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))))
        .alias("_turns"))
    made = turns.select("conv_id", _segments(F.col("_turns"), template).alias("segments"),
                        _first_violation(F.col("_turns"), template).alias("first_violation"))
    return made.select("conv_id", "segments", F.concat_ws("", F.col("segments.text")).alias("formatted"),
                       F.col("first_violation").isNull().alias("valid"), "first_violation")


def read_back(formatted: Column, template: Template = CHAT) -> Column:
    """The turns (role, text) that a formatted text holds.

    Escaped texts hold no marker, so every ``turn_open`` in the output opens a turn.
    """
    t = template

    def turn(piece: Column) -> Column:
        role = F.substring_index(piece, t.role_end, 1)
        inside = F.substr(piece, F.length(role) + 1 + len(t.role_end),
                          F.length(piece) - F.length(role) - len(t.role_end) - len(t.turn_close))
        return F.struct(_unescape_role(role, t).alias("role"), unescape(inside, t).alias("text"))

    pieces = F.split(formatted, _literal(t.turn_open))
    return F.transform(F.slice(pieces, 2, F.greatest(F.size(pieces) - 1, F.lit(0))), turn)


def trained_text(segments: Column, template: Template = CHAT) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    kept = F.filter(segments, lambda s: s["loss"])
    return F.concat_ws("", F.transform(kept, lambda s: unescape(s["text"], template)))


def _literal(text: str) -> str:
    return "".join(f"\\{c}" if c in r"\.[]{}()<>*+-=!?^$|" else c for c in text)
