"""Cleaners of model responses and labels: text in, text out; null is empty."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import WS, as_text, java, let, lines, lstrip, squeeze, strip, word_count

# How an acknowledgement begins, and the marks of a rule line, a title and mojibake.
ACKNOWLEDGEMENTS = ("here ", "sure ", "here,", "sure,", "here:", "sure:", "sure!", "certainly ", "certainly,", "certainly!", "i'm happy to help ")
RULE_LINE = r"(?md)^[ \t]*-{3,}[ \t]*$"
TITLE_LINE = r"^\s*(?:#{1,6}[^\n]*|\*\*[^\n*]{1,120}\*\*:?)[ \t]*\n"
MOJIBAKE = r"Ã[\x{80}-\x{bf}]|â€|Â[\x{a0}-\x{bf}]"
# The characters of cp1252 at 0x80-0x9F (five bytes there have none).
CP1252 = "€‚ƒ„…†‡ˆ‰Š‹ŒŽ‘’“”•–—˜™š›œžŸ"
CP1252_BYTES = (0x80, 0x82, 0x83, 0x84, 0x85, 0x86, 0x87, 0x88, 0x89, 0x8A, 0x8B, 0x8C, 0x8E, 0x91, 0x92, 0x93, 0x94, 0x95, 0x96, 0x97, 0x98, 0x99, 0x9A, 0x9B, 0x9C, 0x9E, 0x9F)
EMOJI = (
    r"(?:[\x{1F1E6}-\x{1F1FF}]{2}|[0-9#*]\x{FE0F}?\x{20E3}"
    r"|[\x{1F000}-\x{1FAFF}\x{2600}-\x{27BF}\x{2B00}-\x{2BFF}\x{2300}-\x{23FF}\x{2934}\x{2935}\x{3030}\x{303D}\x{3297}\x{3299}\x{203C}\x{2049}]"
    r"[\x{FE0E}\x{FE0F}]?[\x{1F3FB}-\x{1F3FF}]?(?:\x{200D}[\x{1F000}-\x{1FAFF}\x{2600}-\x{27BF}]\x{FE0F}?[\x{1F3FB}-\x{1F3FF}]?)*)"
)


def strip_reasoning_trace(c) -> Column:
    """What follows the last closing think tag."""
    return F.regexp_replace(as_text(c), rf"(?isU)^.*</{WS}*think{WS}*>{WS}*", "")


def normalize_whitespace(c) -> Column:
    """Horizontal runs become one space, white space around line feeds one line feed; edges are stripped."""
    flat = F.regexp_replace(as_text(c), rf"(?U)[\s\x1c-\x1f&&[^\n]]+", " ")
    return strip(F.regexp_replace(flat, rf"(?U){WS}*\n{WS}*", "\n"))


def _acknowledges(c: Column) -> Column:
    low = F.lower(c)
    out = F.lit(False)
    for prefix in ACKNOWLEDGEMENTS:
        out = out | F.startswith(low, F.lit(prefix))
    return out


def strip_wrapper_boilerplate(c, original, max_wrapper_words: int = 20, max_dropped_words: int = 40, max_dropped_proportion: float = 0.25) -> Column:
    """Takes off an acknowledgement line and rule-line wrappers that the original lacks; undone where too much would go."""
    text, source = as_text(c), as_text(original)
    ruled = source.rlike(RULE_LINE)

    def opened(t: Column) -> Column:
        body = strip(F.when(F.instr(t, F.lit("\n")) > 0, F.substr(t, F.instr(t, F.lit("\n")) + 1)).otherwise(F.lit("")))
        fits = _acknowledges(t) & ~_acknowledges(strip(source)) & (word_count(F.substring_index(t, "\n", 1)) <= max_wrapper_words)
        return let(body, lambda b: F.when(fits & (b != ""), b).otherwise(t))

    def headless(t: Column) -> Column:
        return let(F.split(t, RULE_LINE, 2), lambda p: F.when(~ruled & (F.size(p) == 2) & (word_count(F.get(p, F.lit(0))) <= max_wrapper_words), strip(F.get(p, F.lit(1)))).otherwise(t))

    def tailless(t: Column) -> Column:
        return let(F.split(t, RULE_LINE, -1), lambda p: F.when(~ruled & (F.size(p) == 2) & (word_count(F.get(p, F.lit(1))) <= max_wrapper_words), strip(F.get(p, F.lit(0)))).otherwise(t))

    def kept(t: Column) -> Column:
        n = word_count(text)
        gone = n - word_count(t)
        return F.when((gone > max_dropped_words) | ((n > 0) & (gone > n * max_dropped_proportion)), text).otherwise(t)

    return let(let(let(let(strip(text), opened), headless), tailless), kept)


def strip_added_title(c, original) -> Column:
    """Drops a leading heading or bold line, and a rule under it, unless the original starts with one too."""
    text, title = as_text(c), java(TITLE_LINE)
    rest = lstrip(F.regexp_replace(lstrip(F.regexp_replace(text, title, "")), r"^-{3,}[ \t]*\n", ""))
    return F.when(text.rlike(title) & ~as_text(original).rlike(title), rest).otherwise(text)


def strip_markdown(c) -> Column:
    """Removes code fences, backticks, link targets, heading marks and emphasis marks."""
    out = F.replace(F.regexp_replace(as_text(c), rf"(?mdU)^{WS}*```[^\n]*\n?", ""), F.lit("`"), F.lit(""))
    out = F.regexp_replace(out, r"\[([^\]\n]+)\]\([^)\n]*\)", "$1")
    return F.regexp_replace(F.regexp_replace(out, r"(?md)^[ \t]*#{1,6}[ \t]*", ""), r"\*\*|__", "")


def strip_emoji(c) -> Column:
    """Removes emoji by code-point class (flags, keycaps, skin tones and joined sequences included)."""
    return F.regexp_replace(as_text(c), EMOJI, "")


def fix_encoding(c) -> Column:
    """Turns literal \\n and \\t into the characters, and undoes UTF-8 read as cp1252 where that gives valid UTF-8."""

    def repaired(t: Column) -> Column:
        latin = F.translate(t, CP1252, "".join(map(chr, CP1252_BYTES)))
        possible = t.rlike(MOJIBAKE) & ~t.rlike(r"[\x{80}-\x{9f}]") & ~latin.rlike(r"[^\x{00}-\x{ff}]")
        # Only what can be written in one byte per character reaches encode(), which refuses all else.
        safe = F.when(possible, latin).otherwise(F.lit(""))
        read = F.try_validate_utf8(F.encode(safe, "ISO-8859-1").cast("string"))
        return F.when(possible, F.coalesce(read, t)).otherwise(t)

    return let(F.replace(F.replace(as_text(c), F.lit("\\n"), F.lit("\n")), F.lit("\\t"), F.lit("\t")), repaired)


def clean_responses(c, original) -> Column:
    """The chain for generated text: reasoning trace, encoding, wrappers, white space."""
    return normalize_whitespace(strip_wrapper_boilerplate(fix_encoding(strip_reasoning_trace(c)), original))


def clean_detector_input(c) -> Column:
    """Text as a detector reads it: no think blocks, white space squeezed, lower case. Emoji are dropped, not named."""
    return F.lower(squeeze(F.regexp_replace(strip_emoji(c), r"(?s)<think>.*?</think>", "")))


def instruction_text(turns) -> Column:
    """Chat turns joined by line feeds, without document and response placeholders."""
    return F.regexp_replace(F.array_join(turns, "\n"), r"\{\{(?:DOC|TEXT|RESP_\d+)\}\}", "")


def without_document(c) -> Column:
    return F.regexp_replace(as_text(c), r"(?s)<document>.*?</document>", "")


def message_lines(c) -> Column:
    """Stripped, non-empty lines of a prompt message without its document."""
    return F.filter(F.transform(lines(without_document(c)), strip), lambda x: x != "")


def prompt_instruction(c, boilerplate: Column) -> Column:
    """A message in one line, without shared lines unless nothing else is left."""

    def told(all_lines: Column) -> Column:
        own = F.filter(all_lines, lambda x: ~F.array_contains(boilerplate, x))
        kept = F.when(F.size(own) > 0, own).otherwise(all_lines)
        return strip(F.replace(F.regexp_replace(F.array_join(kept, " "), rf"(?U){WS}+", " "), F.lit("{{DOC}}"), F.lit("[source text]")))

    return let(message_lines(c), told)


def safe_name(c) -> Column:
    return F.upper(F.regexp_replace(F.regexp_replace(as_text(c), "[^a-zA-Z0-9]+", "_"), "^_+|_+$", "").cast("string"))


def dataset_title(c) -> Column:
    """Last part of a dataset path, without its kind, in title case."""
    tail = F.regexp_replace(F.element_at(F.split(as_text(c), "/"), -1), "-(?:train|val|test)$", "")
    return F.initcap(F.regexp_replace(tail, "[-_]+", " "))


def split_front_matter(text: str) -> tuple[str, str]:
    """(YAML header with its marks, body) of a Markdown text; no header: empty."""
    if text.startswith("---\n"):
        end = text.find("\n---", 4)
        if end >= 0:
            stop = text.find("\n", end + 1)
            stop = len(text) if stop < 0 else stop + 1
            return text[:stop], text[stop:]
    return "", text
