"""Distances between two texts, and between lists of chunks."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import as_text, col, grams, let, lines, strip, transliterate, words


def _set_distance(x: Column, y: Column, same: Column) -> Column:
    """1 - |x & y| / |x | y| of two distinct arrays; both empty: 0 if `same` else 1."""
    both = let(F.size(F.array_intersect(x, y)), lambda i: 1.0 - i / (F.size(x) + F.size(y) - i))
    return F.when((F.size(x) == 0) & (F.size(y) == 0), F.when(same, F.lit(0.0)).otherwise(F.lit(1.0))).when((F.size(x) == 0) | (F.size(y) == 0), F.lit(1.0)).otherwise(both)


def gram_set(c, n: int) -> Column:
    return let(words(c), lambda w: F.array_distinct(grams(w, n)))


def jaccard(a, b, n: int) -> Column:
    """Jaccard distance of the sets of word n-grams."""
    same = strip(as_text(a)) == strip(as_text(b))
    return let(F.struct(gram_set(a, n).alias("x"), gram_set(b, n).alias("y")), lambda p: _set_distance(p["x"], p["y"], same))


def token_jaccard(x: Column, y: Column, n: int, same: Column) -> Column:
    """Jaccard distance of the sets of n-grams of two word arrays; `same`: whether the texts are equal."""
    return let(F.struct(F.array_distinct(grams(x, n)).alias("x"), F.array_distinct(grams(y, n)).alias("y")), lambda p: _set_distance(p["x"], p["y"], same))


def edit_distance(a, b) -> Column:
    return F.levenshtein(as_text(a), as_text(b)).cast("double")


def _deviation(x: Column, y: Column) -> Column:
    most = F.greatest(x, y)
    return F.struct(F.when(most > 0, F.abs(x - y) / most).otherwise(F.lit(0.0)).alias("proportion"), F.abs(x - y).cast("long").alias("count"))


def _sizes(c) -> Column:
    """Lines, words and characters of a text in ASCII, which is made once."""
    return let(transliterate(as_text(c)), lambda t: F.struct(F.size(lines(t)).alias("lines"), F.size(words(t)).alias("words"), F.char_length(t).alias("characters")))


def deviations(a, b) -> Column:
    """struct(lines, words, characters) of struct(proportion, count): how far two texts differ in size."""
    units = ("lines", "words", "characters")
    return let(F.struct(_sizes(a).alias("x"), _sizes(b).alias("y")), lambda p: F.struct(*[_deviation(p["x"][u], p["y"][u]).alias(u) for u in units]))


def deviated_lines(a, b) -> Column:
    """struct(proportion, count): difference in lines."""
    return deviations(a, b)["lines"]


def deviated_words(a, b) -> Column:
    return deviations(a, b)["words"]


def deviated_characters(a, b) -> Column:
    return deviations(a, b)["characters"]


def reduce_chunks(scores: Column, operation: str) -> Column:
    if operation == "max":
        return F.array_max(scores)
    if operation == "min":
        return F.array_min(scores)
    if operation == "mean":
        return F.aggregate(scores, F.lit(0.0), lambda s, x: s + x) / F.size(scores)
    raise ValueError(f"unknown operation: {operation}")


def _chunked(a, b, distance: Callable[[Column, Column], Column], alone: Callable[[Column], Column], operation: str) -> Column:
    reduce_chunks(F.array(F.lit(0.0)), operation)
    x, y = F.coalesce(col(a), F.array().cast("array<string>")), F.coalesce(col(b), F.array().cast("array<string>"))
    return F.transform(y, lambda cb: F.when(F.size(x) == 0, alone(cb)).otherwise(reduce_chunks(F.transform(x, lambda ca: distance(ca, cb)), operation)))


def chunked_jaccards(a, b, n: int, operation: str = "max") -> Column:
    """For each chunk of b: its Jaccard distances to all chunks of a, reduced. No chunks in a: 1."""
    return _chunked(a, b, lambda x, y: jaccard(x, y, n), lambda y: F.lit(1.0), operation)


def chunked_levenshteins(a, b, operation: str = "max") -> Column:
    """As chunked_jaccards, with edit distances. No chunks in a: the chunk's length."""
    return _chunked(a, b, edit_distance, lambda y: F.char_length(y).cast("double"), operation)


def window_chunks(c, window: int, step: int) -> Column:
    """Windows of words from every step-th word, the short ones at the end included."""
    cut = lambda w: F.transform(F.sequence(F.lit(1), F.size(w), F.lit(step)), lambda i: F.array_join(F.slice(w, i, window), " "))
    return let(words(c), lambda w: F.when(F.size(w) > 0, cut(w)).otherwise(F.array().cast("array<string>")))


def phrases(c, shortest: int = 6, longest: int = 12) -> Column:
    """All n-grams of `shortest` to `longest` words, in order, with repeats; shorter texts count as one phrase."""

    def made(w: Column) -> Column:
        lo = F.least(F.size(w), F.lit(shortest))
        hi = F.least(F.size(w), F.lit(longest))
        of_length = lambda n: F.transform(F.sequence(F.lit(1), F.size(w) - n + 1), lambda i: F.array_join(F.slice(w, i, n), " "))
        return F.when(F.size(w) > 0, F.flatten(F.transform(F.sequence(lo, hi), of_length))).otherwise(F.array().cast("array<string>"))

    return let(words(c), made)
