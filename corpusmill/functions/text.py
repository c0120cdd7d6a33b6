"""Text primitives with Python's Unicode rules, as Spark columns."""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

#: str.isspace as a Java class (under (?U)), and the word characters of Python's \w.
WS = r"[\s\x1c-\x1f]"
WORD_CHAR = r"[\p{L}\p{N}_]"
LINE_BREAK = r"\r\n|[\n\r\x0b\x0c\x1c-\x1e\x{85}\x{2028}\x{2029}]"


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def as_text(c: Column | str) -> Column:
    """The value as text; null is empty."""
    return F.coalesce(col(c).cast("string"), F.lit(""))


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """Evaluates `value` once per row for all its uses in `body`."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def java(pattern: str) -> str:
    r"""A Python pattern in Java's syntax: \b, \w, \W and \s by Python's Unicode rules, (?i) Unicode-aware."""
    boundary = f"(?:(?<={WORD_CHAR})(?!{WORD_CHAR})|(?<!{WORD_CHAR})(?={WORD_CHAR}))"
    flags = "(?iuU)" if pattern.startswith("(?i)") else "(?U)"
    body = pattern.removeprefix("(?i)")
    into = {r"\b": boundary, r"\w": WORD_CHAR, r"\W": r"[^\p{L}\p{N}_]", r"\s": WS}
    return flags + re.sub(r"\\[bwWs]", lambda m: into[m[0]], body)


def matches(c: Column, pattern: str) -> Column:
    """Whether a pattern is found. Word boundaries are costly, so the pattern without them is tried first: it finds no less."""
    if r"\b" not in pattern or "(?!" in pattern or "(?<!" in pattern:
        return c.rlike(java(pattern))
    return F.when(c.rlike(java(pattern.replace(r"\b", ""))), c.rlike(java(pattern))).otherwise(F.lit(False))


def words(c: Column | str) -> Column:
    """str.split()."""
    return F.filter(F.split(as_text(c), f"(?U){WS}+"), lambda w: w != "")


def word_count(c: Column | str) -> Column:
    return F.size(words(c)).cast("long")


def strip(c: Column) -> Column:
    return F.regexp_replace(c, f"(?U)^{WS}+|{WS}+\\z", "")


def lstrip(c: Column) -> Column:
    return F.regexp_replace(c, f"(?U)^{WS}+", "")


def squeeze(c: Column) -> Column:
    """" ".join(text.split())."""
    return strip(F.regexp_replace(c, f"(?U){WS}+", " "))


def lines(c: Column) -> Column:
    """str.splitlines()."""
    body = F.regexp_replace(c, f"(?:{LINE_BREAK})\\z", "")
    return F.when(c == "", F.array().cast("array<string>")).otherwise(F.split(body, LINE_BREAK, -1))


def grams(tokens: Column, n: int) -> Column:
    """Word n-grams of a word array, joined by spaces; none where there are fewer words."""
    whole = F.sequence(F.lit(1), F.size(tokens) - (n - 1))
    if n == 1:
        return tokens
    return F.when(F.size(tokens) >= n, F.transform(whole, lambda i: F.array_join(F.slice(tokens, i, n), " "))).otherwise(F.array().cast("array<string>"))


def ngrams(c: Column | str, n: int) -> Column:
    return let(words(c), lambda w: grams(w, n))


# Letters and signs whose ASCII form is not given by Unicode decomposition.
ASCII_OF = {
    "ß": "ss", "ẞ": "SS", "æ": "ae", "Æ": "AE", "œ": "oe", "Œ": "OE", "ø": "o", "Ø": "O", "đ": "d", "Đ": "D", "ð": "d", "Ð": "D", "þ": "th", "Þ": "Th", "ł": "l", "Ł": "L", "ħ": "h", "Ħ": "H", "ı": "i", "ŋ": "ng", "Ŋ": "NG",
    "‘": "'", "’": "'", "‚": ",", "‛": "'", "“": '"', "”": '"', "„": ",,", "–": "-", "—": "--", "―": "--", "‐": "-", "‑": "-", "‒": "-", "…": "...", "•": "*", "«": "<<", "»": ">>", "‹": "<", "›": ">", "€": "EUR", "£": "PS", "©": "(c)", "®": "(r)", "×": "x", "÷": "/", "°": "deg", "¡": "!", "¿": "?", "·": "*", "´": "'", " ": " ",
}


@functools.lru_cache(maxsize=1)
def _ascii_tables() -> tuple[str, str, dict[str, str]]:
    """One-to-one pairs, and the longer replacements, for Latin, Greek-free punctuation and full-width forms."""
    one, to, more = [], [], {}
    for code in [*range(0x80, 0x250), *range(0x1E00, 0x1F00), *range(0x2000, 0x2070), *range(0xFF01, 0xFF5F)]:
        ch = chr(code)
        plain = ASCII_OF.get(ch)
        if plain is None:
            plain = " " if ch.isspace() else "".join(x for x in unicodedata.normalize("NFKD", ch) if ord(x) < 128)
        if len(plain) == 1:
            one.append(ch)
            to.append(plain)
        elif plain:
            more[ch] = plain
    more |= {c: p for c, p in ASCII_OF.items() if len(p) > 1}
    for c, p in ASCII_OF.items():
        if len(p) == 1 and c not in one:
            one.append(c)
            to.append(p)
    return "".join(one), "".join(to), more


def transliterate(c: Column) -> Column:
    """ASCII form of a text: Latin letters lose their marks, signs get look-alikes, what has no form is dropped."""
    one, to, more = _ascii_tables()
    out = F.translate(c, one, to)
    for ch in [ch for ch in more if ch in ASCII_OF]:
        out = F.replace(out, F.lit(ch), F.lit(more[ch]))
    out = F.regexp_replace(out, r"[^\x00-\x7F]", "")
    return F.when(c.rlike(r"[^\x00-\x7F]"), out).otherwise(c)
