"""Ordinal labels from a score."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import col


def banded(score, n: int, lo: float, hi: float) -> Column:
    """0 up to lo, n - 1 from hi, the band between in equal parts; two buckets split at its middle."""
    s = col(score)
    if n == 2:
        return F.when(s <= (lo + hi) / 2, 0).otherwise(1)
    return F.when(s <= lo, 0).when(s >= hi, n - 1).otherwise(1 + ((s - lo) / (hi - lo) * (n - 2)).cast("int"))


def even(score, n: int) -> Column:
    return F.least((col(score) * n).cast("int"), F.lit(n - 1))


def human_first(score, n: int) -> Column:
    """0 for scores up to 0, equal parts above."""
    s = col(score)
    return F.when(s <= 0, 0).otherwise(1 + F.least((s * (n - 1)).cast("int"), F.lit(n - 2)))


def human_banded(score, n: int, lo: float, hi: float) -> Column:
    s = col(score)
    return F.when(s <= 0, 0).otherwise(F.lit(1) if n == 2 else 1 + banded(s, n - 1, lo, hi))


def human_sized(score, edges: Column) -> Column:
    """0 for scores up to 0, else by ascending edges (right side)."""
    s = col(score)
    return F.when(s <= 0, 0).otherwise(1 + F.size(F.filter(edges, lambda e: e <= s)))


def size_edges(training: DataFrame, score: str, n: int) -> list[float]:
    """Interior quantile edges of the positive scores, of the training rows only."""
    if n <= 2:
        return []
    row = training.where(F.col(score) > 0).agg(F.percentile(score, F.array(*[F.lit(i / (n - 1)) for i in range(1, n - 1)]))).first()
    return list(row[0] or [])


def bucketer(strategy: str, score, n: int, lo: float = 0.0, hi: float = 1.0, edges: list[float] | None = None) -> Column:
    made = {"banded": lambda: banded(score, n, lo, hi), "even": lambda: even(score, n), "human": lambda: human_first(score, n), "human_banded": lambda: human_banded(score, n, lo, hi), "human_size": lambda: human_sized(score, F.array(*map(F.lit, edges or [])).cast("array<double>"))}
    return made[strategy]()
