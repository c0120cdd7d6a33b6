"""Removal flags: true where a row should go. Null texts count as empty."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .distance import jaccard, token_jaccard
from .text import as_text, java, let, lines, matches, strip, transliterate, word_count, words

# The phrases that mark failed generations.
REFUSAL = (
    r"(?i)^\W*(?:i\s*(?:'m|am)?\s*(?:cannot|can't|can not|won't|will not|unable|not able)(?:\s+to)?\s+"
    r"(?:fulfill|complete|comply|assist|help|provide|create|generate|produce|write|proceed|continue|do)\b"
    r"|i'?m sorry\b|sorry, (?:but )?i\b|as an ai\b"
    r"|please provide (?:the|me)\b|you (?:haven't|have not) provided\b"
    r"|(?:it (?:seems|appears|looks like)|there (?:does\s?n.t appear to be|is no|are no)|unfortunately,)"
    r"[^.\n]{0,140}\b(?:input|document|descriptor|trace|passage|source text|provided|your message|no actual)\b)"
)
FILLER = (
    r"(?i)\b(?:the quick brown fox jumps over the lazy dog|lorem ipsum"
    r"|insert (?:the )?(?:source|original) text|source (?:text|material) "
    r"(?:to be |not )?provided)\b|\[(?:NOUN|VERB|ADJECTIVE|PUNCTUATION)\]"
)
PLACEHOLDER = (
    r"(?i)\[(?:insert|add|enter|your|their|client|company|recipient|author|product)\b[^\]\n]{0,40}\]"
    r"|\[(?:name|date|title|address|city|phone number|email address|link|url|website)\]"
    r"|\[(?:source text|original (?:text|passage)|placeholder)[^\]\n]{0,30}\]"
)
META_COMMENTARY = (
    r"(?i)\bthe (?:original|provided|source|above) (?:text|passage|article|document)\b"
    r"|\b(?:here'?s|here is|below is) the (?:rewritten|revised|recreated|reworded|new|updated) "
    r"(?:text|version|passage|draft)\b"
    r"|\bi (?:have |'ve )?(?:rewritten|revised|recreated|reworded) (?:the|this|it)\b"
)


def _new(text, original, pattern: str) -> Column:
    return matches(as_text(text), pattern) & ~matches(as_text(original), pattern)


def is_empty(c, min_characters: int = 50) -> Column:
    return F.char_length(strip(as_text(c))) < min_characters


def has_refusal(c) -> Column:
    return matches(as_text(c), REFUSAL)


def has_filler_output(c, original) -> Column:
    return _new(c, original, FILLER)


def has_placeholder(c, original) -> Column:
    return _new(c, original, PLACEHOLDER)


def has_meta_commentary(c, original) -> Column:
    return _new(c, original, META_COMMENTARY)


def has_prompt_echo(c, instruction, min_characters: int = 60) -> Column:
    """A long line of the instruction stands in the text."""
    told = F.filter(F.transform(lines(as_text(instruction)), strip), lambda x: F.char_length(x) >= min_characters)
    return F.exists(told, lambda x: F.contains(as_text(c), x))


def is_unchanged(c, original) -> Column:
    return as_text(c) == as_text(original)


def is_near_duplicate(original, c, threshold: float = 0.9, n: int = 1) -> Column:
    return (F.lit(1.0) - jaccard(original, c, n)) >= threshold


def has_insufficient_jaccard_distance(original, c, unigram: float = 0.025, bigram: float = 0.05) -> Column:
    same = strip(as_text(original)) == strip(as_text(c))
    near = lambda p, n, most: token_jaccard(p["x"], p["y"], n, same) <= most
    pair = F.struct(words(original).alias("x"), words(c).alias("y"))
    return let(pair, lambda p: F.when(near(p, 1, unigram), near(p, 2, bigram)).otherwise(F.lit(False)))


def has_length_anomaly(original, c, min_ratio: float = 0.1, max_ratio: float = 5.0) -> Column:
    a, b = F.char_length(as_text(original)), F.char_length(as_text(c))
    return ~F.when(a == 0, F.lit(0.0)).otherwise(b / a).between(min_ratio, max_ratio)


def has_instruction_vocabulary(c, instruction, threshold: float = 0.25) -> Column:
    """Too many of the text's distinct words are the instruction's."""
    vocabulary = lambda x: F.array_distinct(F.regexp_extract_all(F.lower(as_text(x)), F.lit(java(r"(\w+)")), 1))
    return let(vocabulary(c), lambda w: F.when(F.size(w) > 0, F.size(F.array_intersect(w, vocabulary(instruction))) / F.size(w) >= threshold).otherwise(F.lit(False)))


def has_encoding_damage(c) -> Column:
    return F.contains(as_text(c), F.lit("�"))


def is_strict_subset(a, b) -> Column:
    """b is not empty and stands in a."""
    return (as_text(b) != "") & F.contains(as_text(a), as_text(b))


def _canonical(c: Column) -> Column:
    return F.lower(F.regexp_replace(transliterate(c), r"[\s\x1c-\x1f]+", ""))


def loose_subset(a, b) -> Column:
    """struct(found, slice): b stands in a but for accents, case and white space; slice is that stretch of a as written."""
    source = as_text(a)

    def located(pair: Column) -> Column:
        ca, cb = pair["ca"], pair["cb"]
        at = F.position(cb, ca)
        found = (cb != "") & (at > 0)
        each = F.split(source, "")
        plain = F.transform(each, lambda ch, i: F.array_repeat(i, F.when(F.ascii(ch).between(9, 13) | F.ascii(ch).between(28, 32), F.lit(0)).otherwise(F.lit(1))))
        marked = F.transform(each, lambda ch, i: F.array_repeat(i, F.char_length(_canonical(ch))))
        places = F.flatten(F.when(source.rlike(r"[^\x00-\x7F]"), marked).otherwise(plain))
        cut = let(places, lambda p: F.substr(source, F.get(p, at - 1) + 1, F.get(p, at + F.char_length(cb) - 2) - F.get(p, at - 1) + 1))
        return F.struct(found.alias("found"), F.when(found, cut).otherwise(F.lit("")).alias("slice"))

    return let(F.struct(_canonical(source).alias("ca"), _canonical(as_text(b)).alias("cb")), located)


def has_too_few_words(c, min_words: int) -> Column:
    """Fewer than min_words runs of word characters."""
    return F.size(F.regexp_extract_all(as_text(c), F.lit(java(r"(\w+)")), 1)) < min_words


#: The reasons a generation is rejected for, in the order they are reported.
REASONS = ("empty or too short", "refusal", "filler output", "unfilled placeholder", "task meta-commentary", "echoed instruction", "near-verbatim source", "identical to source")


def rejection_reasons(original, response, instruction) -> dict[str, Column]:
    """One flag per reason."""
    flags = (
        is_empty(response), has_refusal(response), has_filler_output(response, original), has_placeholder(response, original), has_meta_commentary(response, original),
        has_prompt_echo(response, instruction), has_insufficient_jaccard_distance(original, response), is_unchanged(response, original),
    )
    return dict(zip(REASONS, flags, strict=True))


__all__ = [n for n in dir() if n.startswith(("is_", "has_"))] + ["REASONS", "loose_subset", "rejection_reasons", "word_count"]
