"""Prompt sets: small tables (prompt_pos, chat_turns, use_multiturn, examples, metadata) and their builders.

Seeded shuffles and samples follow random.Random, so they run on the driver; prompt sets are small.
Everything that touches corpus rows is a DataFrame operation.
"""

from __future__ import annotations

import random
from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from .joins import assign_prompts

Chat = list[str]
SCHEMA = "prompt_pos long, chat_turns array<string>, use_multiturn boolean, examples array<array<string>>, metadata map<string,string>"
#: Placeholders of the prompt files.
DOC, TEXT = "{{DOC}}", "{{TEXT}}"
COLUMN_PATTERN = r"<<([^<>]+)>>"


@dataclass
class Prompt:
    chat_turns: Chat
    use_multiturn: bool = True
    examples: list[tuple[str, str]] = field(default_factory=list)
    metadata: dict[str, Any] = field(default_factory=dict)


def shuffled(items: Sequence, seed: int = 42) -> list:
    out = list(items)
    random.Random(seed).shuffle(out)
    return out


def cut_point(n: int, proportion: float, min_size: int = 1) -> int:
    """Size of the first part; Python's rounding, both parts at least min_size."""
    if n == 0 or n < 2 * min_size:
        raise ValueError(f"{n} items cannot give two parts of {min_size}")
    return max(min(int(round(n * proportion)), n - min_size), min_size)


def split(items: Sequence, proportion: float = 0.5, min_size: int = 1) -> tuple[list, list]:
    at = cut_point(len(items), proportion, min_size)
    return list(items[:at]), list(items[at:])


def resize(items: Sequence, target: int, shuffle: bool = True, seed: int = 42) -> list:
    """`target` items: whole copies and a sample of the rest, or a subset."""
    if not items or target < 1:
        raise ValueError("items and a positive target are needed")
    rng = random.Random(seed)
    copies, rest = divmod(target, len(items)) if target > len(items) else (0, target)
    out = list(items) * copies
    if rest:
        pool = list(items)
        if shuffle:
            rng.shuffle(pool)
        out += pool[:rest]
    if copies and shuffle:
        rng.shuffle(out)
    return out


def partial_stack(lists: Sequence[Sequence[Chat]], least: int = 1, most: int = 1, seed: int = 42) -> list[Chat]:
    """Row i joins the i-th chats of the first k lists, k drawn from least..most."""
    if not lists or len({len(x) for x in lists}) != 1 or not 1 <= least <= most <= len(lists):
        raise ValueError("lists of one length and 1 <= least <= most <= their number are needed")
    rng = random.Random(seed)
    sizes = [rng.randint(least, most) for _ in lists[0]]
    return [[turn for chats in lists[:k] for turn in chats[i]] for i, k in enumerate(sizes)]


def reformat(chats: Column, template: str, only_first: bool = False) -> Column:
    """Every turn (or the first) put into a template."""
    if TEXT not in template:
        raise ValueError(f"{TEXT} is missing in the template")
    put = lambda t: F.replace(F.lit(template), F.lit(TEXT), t)
    return F.transform(chats, lambda t, i: F.when((i == 0) | F.lit(not only_first), put(t)).otherwise(t))


def recursive_format(chats: Column, order: str = "first", header: str = "{{RESP_#}}") -> Column:
    """The placeholder of the previous response before or after every turn but the first."""
    if order not in ("first", "last"):
        raise ValueError(f"unknown order: {order}")
    mark = lambda i: F.replace(F.lit(header), F.lit("#"), (i - 1).cast("string"))
    made = lambda t, i: F.concat_ws("\n", mark(i), t) if order == "first" else F.concat_ws("\n", t, mark(i))
    return F.transform(chats, lambda t, i: F.when(i == 0, t).otherwise(made(t, i)))


def prompts_of(chats: Sequence[Chat], use_multiturn: bool = True) -> list[Prompt]:
    return [Prompt(list(c), use_multiturn) for c in chats]


def with_metadata(prompts: DataFrame, key: str, value: str) -> DataFrame:
    without = F.map_filter("metadata", lambda k, _: k != key)
    return prompts.withColumn("metadata", F.map_concat(without, F.create_map(F.lit(key), F.lit(value))))


def with_example(prompts: DataFrame, user: str, assistant: str) -> DataFrame:
    return prompts.withColumn("examples", F.array_append("examples", F.array(F.lit(user), F.lit(assistant))))


def final_variants(prompts: Sequence[Prompt], variants: Sequence[str | None], seed: int = 42) -> list[Prompt]:
    """A drawn variant under each prompt's last turn; None leaves it."""
    if not variants:
        raise ValueError("variants are needed")
    rng = random.Random(seed)
    out = []
    for p in prompts:
        v = rng.choice(variants)
        turns = p.chat_turns if v is None else [*p.chat_turns[:-1], f"{p.chat_turns[-1]}\n{v}"]
        out.append(Prompt(list(turns), p.use_multiturn, list(p.examples), dict(p.metadata)))
    return out


def prompt_table(spark: SparkSession, prompts: Sequence[Prompt]) -> DataFrame:
    rows = [(i, p.chat_turns, p.use_multiturn, [list(e) for e in p.examples], {k: str(v) for k, v in p.metadata.items()}) for i, p in enumerate(prompts)]
    return spark.createDataFrame(rows, SCHEMA)


@dataclass
class PromptCursor:
    """Train and test parts of a prompt table, and how far each has been used."""

    table: DataFrame
    cut: int | None = None
    used: dict[str, int] = field(default_factory=lambda: {"train": 0, "test": 0})

    def split_test(self, proportion: float, min_size: int = 1) -> None:
        if self.cut is not None:
            raise ValueError("there is a test part already")
        self.cut = cut_point(self.table.count(), 1 - proportion, min_size)

    def clear_test(self) -> None:
        self.cut = None
        self.used["test"] = 0

    def part(self, name: str) -> DataFrame:
        if name == "train":
            return self.table if self.cut is None else self.table.where(F.col("prompt_pos") < self.cut)
        if self.cut is None:
            raise ValueError("there is no test part")
        return self.table.where(F.col("prompt_pos") >= self.cut).withColumn("prompt_pos", F.col("prompt_pos") - self.cut)

    def take(self, rows: DataFrame, n: int, name: str = "train", key: str = "row_id") -> DataFrame:
        """Prompts for rows 0..n-1, going on where the last call ended."""
        out = assign_prompts(rows, self.part(name), key, self.used[name])
        self.used[name] += n
        return out

    def reset(self) -> None:
        self.used = {"train": 0, "test": 0}


def fill_prompts(rows: DataFrame, doc: str, columns: Sequence[str] = (), turns: str = "chat_turns") -> DataFrame:
    """Puts column values, then the document, into the turns; a null value that is asked for is an error.

    Placeholders inside the document are not filled, as it goes in last.
    """

    def filled(t: Column) -> Column:
        out = t
        for c in columns:
            mark = F.lit(f"<<{c}>>")
            value = F.when(F.contains(t, mark) & F.col(c).isNull(), F.raise_error(F.lit(f"null in column {c}"))).otherwise(F.col(c).cast("string"))
            out = F.when(F.contains(out, mark), F.replace(out, mark, value)).otherwise(out)
        left = F.regexp_extract(out, COLUMN_PATTERN, 1)
        out = F.when(left != "", F.raise_error(F.concat(F.lit("missing column "), left))).otherwise(out)
        return F.replace(out, F.lit(DOC), F.coalesce(F.col(doc), F.lit("")))

    return rows.withColumn(turns, F.transform(turns, filled))


def messages(turn: int, responses: Sequence[str], turns: str = "chat_turns", examples: str = "examples", multi: str = "use_multiturn") -> Column:
    """Array of (role, content) for turn `turn`, given the names of the response columns so far."""

    def said(role: str, c: Column) -> Column:
        return F.struct(F.lit(role).alias("role"), c.alias("content"))

    history = []
    for t in range(turn + 1):
        text = F.get(turns, F.lit(t))
        for i in range(t):
            text = F.replace(text, F.lit(f"{{{{RESP_{i}}}}}"), F.col(responses[i]))
        history.append(said("user", text))
        if t < turn:
            history.append(said("assistant", F.col(responses[t])))
    shown = F.flatten(F.transform(examples, lambda e: F.array(said("user", F.get(e, F.lit(0))), said("assistant", F.get(e, F.lit(1))))))
    none = F.array().cast("array<struct<role:string,content:string>>")
    before = F.when(F.col(multi) | F.lit(turn == 0), F.coalesce(shown, none)).otherwise(none)
    return F.concat(before, F.when(F.col(multi), F.array(*history)).otherwise(F.array(history[-1])))
