"""Chat formatting: a finite-state machine over roles and a declarative template.

A `Template` names, for each role, the markers around a turn, whether its text is trained on, and which
roles may follow. The state of the machine is the role of the turn before, so a window over the
conversation walks it. Every turn becomes segments (marker, text, marker), each with a loss flag.

Inside texts the first character of every control string, and the escape character itself, is replaced
by the escape character and a digit, so no text can look like a marker and `unescape` restores it.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

START = ""
ESCAPE = "\\"


@dataclass(frozen=True)
class Turn:
    """Markers around the text of a role, its loss flag, and the roles that may come next."""

    before: str
    after: str
    loss: bool
    follow: tuple[str, ...]


@dataclass(frozen=True)
class Template:
    """Turn layouts by role; `named` lays out any other role and carries the role's name."""

    turns: dict[str, Turn]
    first: tuple[str, ...]
    last: tuple[str, ...]
    named: tuple[str, str, str] = ("[ROLE]", "[TEXT]", "[/TEXT]")
    controls: tuple[str, ...] = field(init=False)

    def __post_init__(self) -> None:
        marks = {m.strip() for t in self.turns.values() for m in (t.before, t.after)} | set(self.named)
        object.__setattr__(self, "controls", tuple(sorted(marks)))
        if any(m[0] not in "<[" for m in self.controls):
            raise ValueError("control strings start with < or [")

    def escape(self, text: Column) -> Column:
        out = F.replace(text, F.lit(ESCAPE), F.lit(ESCAPE + "0"))
        for digit, head in (("1", "<"), ("2", "[")):
            tails = "|".join(re.escape(m[1:]) for m in self.controls if m[0] == head)
            if tails:
                out = F.regexp_replace(out, f"{re.escape(head)}(?={tails})", f"\\\\{digit}")
        return out

    @staticmethod
    def unescape(text: Column) -> Column:
        for digit, head in (("1", "<"), ("2", "["), ("0", ESCAPE)):
            text = F.replace(text, F.lit(ESCAPE + digit), F.lit(head))
        return text


INSTRUCT = Template(
    turns={
        "system": Turn("<<SYS>>\n", "\n<</SYS>>", False, ("user",)),
        "user": Turn("[INST] ", " [/INST]", False, ("assistant",)),
        "assistant": Turn("<s> ", " </s>", True, ("user",)),
    },
    first=("system", "user"),
    last=("assistant",),
)


def format_turns(conversations: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """One row per turn: conv_id, position (from 0), role, legal, segments (array of text and loss).

    Turns are taken in the order of turn, then role, then text; a null turn number comes first. Null
    roles and texts count as empty. Turns out of order are formatted like others and have legal = false.
    Rows without conv_id form one conversation, repeated rows are repeated turns, an empty table gives
    an empty result, and other columns are ignored.
    """
    rows = conversations.select(
        "conv_id", "turn", F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("_t"))
    order = Window.partitionBy("conv_id").orderBy(F.col("turn").asc_nulls_first(), "role", "_t")
    state = F.lag("role").over(order)
    legal = F.when(state.isNull(), F.col("role").isin(*template.first))
    for role, turn in template.turns.items():
        legal = legal.when(state == role, F.col("role").isin(*turn.follow))
    text = template.escape(F.col("_t"))

    def segment(value: Column, loss: bool) -> Column:
        return F.struct(value.alias("text"), F.lit(loss).alias("loss"))

    opening, middle, closing = template.named
    segments = None
    for role, turn in template.turns.items():
        layout = F.array(segment(F.lit(turn.before), False), segment(text, turn.loss), segment(F.lit(turn.after), False))
        segments = (F if segments is None else segments).when(F.col("role") == role, layout)
    name = F.concat(F.lit(opening), template.escape(F.col("role")), F.lit(middle))
    segments = segments.otherwise(
        F.array(segment(name, False), segment(text, False), segment(F.lit(closing), False)))
    return rows.select(
        "conv_id", (F.row_number().over(order) - 1).alias("position"), "role",
        F.coalesce(legal.otherwise(F.lit(False)), F.lit(False)).alias("legal"), segments.alias("segments"))


def assemble(turns: DataFrame, template: Template = INSTRUCT) -> DataFrame:
    """One row per conversation: conv_id, n_turns, valid, formatted, segments.

    `valid` tells that every turn was legal and the last role may end a conversation. A conversation
    becomes one value here, since it is one training example.
    """
    listed = turns.groupBy("conv_id").agg(
        F.count("*").alias("n_turns"), F.bool_and("legal").alias("_legal"),
        F.array_sort(F.collect_list(F.struct("position", "role", "segments"))).alias("_turns"))
    last = F.element_at("_turns", -1)["role"]
    segments = F.flatten(F.transform("_turns", lambda t: t["segments"]))
    listed = listed.select("conv_id", "n_turns", (F.col("_legal") & last.isin(*template.last)).alias("valid"),
                           segments.alias("segments"))
    formatted = F.array_join(F.transform("segments", lambda s: s["text"]), "")
    return listed.select("conv_id", "n_turns", "valid", formatted.alias("formatted"), "segments")


def loss_text(segments: Column) -> Column:
    """All text under the loss mask, unescaped."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]),
                                    lambda s: Template.unescape(s["text"])), "")


def parse_turns(formatted: Column, template: Template = INSTRUCT) -> Column:
    """Turns read back from formatted text: array of role and text."""
    closers = {t.after: (role, t.before) for role, t in template.turns.items()}
    opening, middle, closing = template.named
    ends = "|".join(f"(?<={re.escape(c)})" for c in (*closers, closing))
    pieces = F.filter(F.split(formatted, ends), lambda piece: piece != "")

    def parsed(piece: Column) -> Column:
        out = None
        for after, (role, before) in closers.items():
            body = F.substr(piece, F.lit(len(before) + 1), F.length(piece) - (len(before) + len(after)))
            made = F.struct(F.lit(role).alias("role"), Template.unescape(body).alias("text"))
            out = (F if out is None else out).when(
                F.startswith(piece, F.lit(before)) & F.endswith(piece, F.lit(after)), made)
        inner = F.substr(piece, F.lit(len(opening) + 1), F.length(piece) - len(opening) - len(closing))
        at = F.instr(inner, F.lit(middle))
        return out.otherwise(F.struct(
            Template.unescape(F.substr(inner, F.lit(1), at - 1)).alias("role"),
            Template.unescape(F.substr(inner, at + len(middle))).alias("text")))

    return F.transform(pieces, parsed)
