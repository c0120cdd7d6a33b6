"""Chat formatting: a finite-state machine over roles, driven by a declarative template.

A template names, for every role, the control strings around its text and whether the text counts
for the loss, and the allowed transitions between roles. The machine's state is the role read last
(START before the first turn); a turn that no transition allows makes the conversation invalid
from there on. Invalid conversations are formatted too and marked.

Texts are escaped so that no control string appears in them: after the first character of a
control string, and of one that is already escaped, one more escape character is put in. Taking
one out again restores any text exactly.

Output per conversation: `formatted`, `segments` (text, loss, role; their texts make up
`formatted`), `spans` (start, end in code points of the text under the loss mask), `valid`,
`first_error`. `parse` reads roles and texts back from `formatted` alone.

Defined cases: null text or role: empty. Turns are ordered by (turn, role, text), null turns first;
repeated rows are turns of their own. Rows with a null conversation id are one conversation. Extra
columns are ignored; no rows give no conversations. A conversation is one output row, so its turns
meet in one task and one array: some 2 GB of text is the most that a conversation can hold, and rows
without an id should be given ids first where they are many.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Part:
    open: str
    close: str
    loss: bool = False


@dataclass(frozen=True)
class Template:
    roles: dict[str, Part] = field(default_factory=lambda: {"system": Part("<<SYS>>", "<</SYS>>"), "user": Part("[INST]", "[/INST]"), "assistant": Part("<s>", "</s>", loss=True)})
    #: Around the name of any other role; its text follows, up to other_close.
    other: Part = Part("<<ROLE>>", "<</ROLE>>")
    other_close: str = "<</TURN>>"
    transitions: tuple[tuple[str, str], ...] = (("START", "system"), ("START", "user"), ("system", "user"), ("user", "assistant"), ("assistant", "user"))
    final: tuple[str, ...] = ("assistant",)
    escape: str = "\\"

    def controls(self) -> list[str]:
        parts = [*self.roles.values(), self.other]
        return list(dict.fromkeys([*(p.open for p in parts), *(p.close for p in parts), self.other_close]))


def _first(template: Template, escapes: str) -> str:
    """The first character of a control string, before `escapes` and the rest of the string."""
    e = re.escape(template.escape)
    by_first: dict[str, list[str]] = {}
    for c in template.controls():
        by_first.setdefault(c[0], []).append(re.escape(c[1:]))
    return "(" + "|".join(f"{re.escape(c)}(?={e}{escapes}(?:{'|'.join(rests)}))" for c, rests in by_first.items()) + ")"


def escape_text(c: Column, template: Template) -> Column:
    return F.regexp_replace(c, _first(template, "*"), "$1" + re.escape(template.escape))


def unescape_text(c: Column, template: Template) -> Column:
    return F.regexp_replace(c, _first(template, "+") + re.escape(template.escape), "$1")


def _pick(role: Column, template: Template, value, other: Column) -> Column:
    out = None
    for name, part in template.roles.items():
        out = F.when(role == name, value(part)) if out is None else out.when(role == name, value(part))
    return other if out is None else out.otherwise(other)


def format_turns(turns: DataFrame, template: Template = Template(), id_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:  # noqa: B008
    """One row per turn: conv, pos, open, text (escaped), close, loss, ok, start and end of the text in the formatted conversation."""
    role = F.coalesce(F.col(role_col).cast("string"), F.lit(""))
    base = turns.select(F.col(id_col).alias("conv"), F.col(turn_col).alias("turn"), role.alias("role"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("raw"))
    e = escape_text(F.col("role"), template)
    other_open = F.concat(F.lit(template.other.open), e, F.lit(template.other.close))
    parts = base.select(
        "conv", "turn", "role", "raw", escape_text(F.col("raw"), template).alias("text"),
        _pick(F.col("role"), template, lambda p: F.lit(p.open), other_open).alias("open"),
        _pick(F.col("role"), template, lambda p: F.lit(p.close), F.lit(template.other_close)).alias("close"),
        _pick(F.col("role"), template, lambda p: F.lit(p.loss), F.lit(False)).alias("loss"),
    )
    order = Window.partitionBy("conv").orderBy(F.col("turn").asc_nulls_first(), "role", "raw")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    state = F.coalesce(F.lag("role").over(order), F.lit("START"))
    length = F.char_length("open") + F.char_length("text") + F.char_length("close")
    timed = parts.select("*", F.row_number().over(order).alias("pos"), state.alias("state"), F.sum(length).over(upto).alias("upto"))
    known = F.lit(False)
    for a, b in template.transitions:
        known = known | ((F.col("state") == a) & (F.col("role") == b) & ((F.lit(a) != "START") | (F.col("pos") == 1)))
    end = F.col("upto") - F.char_length("close")
    return timed.select("conv", "pos", "role", "open", "text", "close", "loss", known.alias("ok"), (end - F.char_length("text")).alias("start"), end.alias("end"))


def format_conversations(turns: DataFrame, template: Template = Template(), **columns: str) -> DataFrame:  # noqa: B008
    """One row per conversation: conv, n_turns, formatted, segments, spans, valid, first_error."""
    rows = format_turns(turns, template, **columns)
    per = rows.groupBy("conv").agg(F.array_sort(F.collect_list(F.struct("pos", "role", "open", "text", "close", "loss", "ok", "start", "end"))).alias("t"))
    segments = F.flatten(F.transform("t", lambda x: F.array(F.struct(x["open"].alias("text"), F.lit(False).alias("loss"), x["role"].alias("role")), F.struct(x["text"].alias("text"), x["loss"].alias("loss"), x["role"].alias("role")), F.struct(x["close"].alias("text"), F.lit(False).alias("loss"), x["role"].alias("role")))))
    errors = F.transform(F.filter("t", lambda x: ~x["ok"]), lambda x: x["pos"])
    ends = F.element_at("t", -1)["role"].isin(*template.final)
    return per.select(
        F.col("conv"), F.size("t").cast("long").alias("n_turns"), F.array_join(F.transform("t", lambda x: F.concat(x["open"], x["text"], x["close"])), "").alias("formatted"), segments.alias("segments"),
        F.transform(F.filter("t", lambda x: x["loss"]), lambda x: F.struct(x["start"].alias("start"), x["end"].alias("end"))).alias("spans"),
        ((F.size(errors) == 0) & ends).alias("valid"), F.when(F.size(errors) > 0, F.get(errors, F.lit(0))).alias("first_error"),
    )


def parse(formatted: Column, template: Template = Template()) -> Column:  # noqa: B008
    """Array of (role, text) read back from a formatted conversation."""
    closes = [*(p.close for p in template.roles.values()), template.other_close]
    turns = F.filter(F.split(formatted, "(?<=" + "|".join(re.escape(c) for c in closes) + ")"), lambda x: x != "")
    lit_len = lambda s: F.lit(len(s))

    def read(x: Column) -> Column:
        o = template.other
        name = F.substr(x, F.lit(len(o.open) + 1), F.instr(x, F.lit(o.close)) - len(o.open) - 1)
        at = F.instr(x, F.lit(o.close)) + len(o.close)
        out = F.struct(unescape_text(name, template).alias("role"), unescape_text(F.substr(x, at, F.char_length(x) - at + 1 - len(template.other_close)), template).alias("text"))
        for role, p in template.roles.items():
            text = F.substr(x, F.lit(len(p.open) + 1), F.char_length(x) - lit_len(p.open) - lit_len(p.close))
            out = F.when(F.startswith(x, F.lit(p.open)), F.struct(F.lit(role).alias("role"), unescape_text(text, template).alias("text"))).otherwise(out)
        return out

    return F.transform(turns, read)
