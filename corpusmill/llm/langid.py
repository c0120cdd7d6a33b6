"""Language identification with hyperdimensional profiles.

Every letter has a random vector of +1 and -1 of its own, drawn from its code point; so has the word
boundary. A letter n-gram binds (multiplies) its letters' vectors, each permuted by its place in the
n-gram; a text bundles (adds) the vectors of its n-grams, which lie within words and their
boundaries. The prototype of a language bundles the unit vectors of its training texts; a text gets
the language whose prototype has the largest cosine with its vector.

N-grams are counted first, so a text costs one pass plus a product over its distinct n-grams, whose
bound vectors a worker keeps (BANK of them).

Training takes about `per_language` distinct texts of each language (default 1,500; all where there
are fewer): those whose text hash falls below the language's share, so ids play no part and copies
count once. Unit vectors are added as integers, so the prototypes do not depend on the order.

Defined cases: null text, or no letters: `und` with score 0. No training texts: all `und`. Ties of
cosine (to 9 digits) go to the language that sorts first. Repeated rows get equal results. Text is
read whole, in pieces of bounded size. Columns other than `id_cols` and the text are ignored,
whatever their names. Empty table: no rows. A label column with over 4,096 values is an error.
"""

from __future__ import annotations

import functools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import class_shares, in_sample, slices

DIM, GRAM = 1024, 3
PIECE = 1 << 19
#: Bound vectors kept by a worker, and those of one text handled at once.
BANK, TAKE = 1 << 15, 1 << 13
#: Unit vectors are rounded to multiples of 1 / UNIT.
UNIT = 1 << 24
PROTOTYPES = "lang string, total array<long>"


@functools.lru_cache(maxsize=1)
def letter_table() -> np.ndarray:
    """Which code points are letters."""
    return np.array([not 0xD800 <= c < 0xE000 and chr(c).isalpha() for c in range(0x110000)])


@functools.lru_cache(maxsize=1 << 14)
def letter_vector(code: int) -> np.ndarray:
    """The random vector of a letter (0: the word boundary)."""
    bits = np.random.Generator(np.random.Philox(key=[613, code])).integers(0, 2, DIM, np.int8)
    return bits * np.int8(2) - np.int8(1)


def bound_vector(gram: tuple[int, int, int]) -> np.ndarray:
    """rho(rho(first) * second) * third."""
    out = letter_vector(gram[0])
    for code in gram[1:]:
        out = np.roll(out, 1) * letter_vector(code)
    return out


class Bank:
    """Bound vectors of n-grams met before."""

    def __init__(self):
        self.place: dict[int, int] = {}
        self.rows = np.empty((BANK, DIM), np.int8)

    def take(self, keys: np.ndarray) -> np.ndarray:
        """The vectors of at most TAKE packed n-grams."""
        place, names = self.place, keys.tolist()
        if len(place) + len(names) > BANK:
            place.clear()
        for key in names:
            if key not in place:
                i = place[key] = len(place)
                self.rows[i] = bound_vector((key >> 42, key >> 21 & 0x1FFFFF, key & 0x1FFFFF))
        return self.rows[[place[key] for key in names]]


@functools.lru_cache(maxsize=1)
def bank() -> Bank:
    return Bank()


def gram_keys(text: str, before: np.ndarray, last: bool) -> tuple[np.ndarray, np.ndarray]:
    """Packed n-grams of a piece that follows the codes `before`, and the last codes of it."""
    codes = np.frombuffer(text.lower().encode("utf-32-le", "replace"), np.uint32).astype(np.int64)
    codes = np.concatenate((before, codes * letter_table()[codes], np.zeros(int(last), np.int64)))
    middle = codes[1:-1] != 0
    return (codes[:-2] << 42 | codes[1:-1] << 21 | codes[2:])[middle], codes[-2:]


def vector(text: str) -> np.ndarray | None:
    """The bundle of a text's n-grams; None without letters."""
    out, codes, seen = np.zeros(DIM), np.zeros(1, np.int64), False
    for at in range(0, len(text), PIECE):
        grams, codes = gram_keys(text[at : at + PIECE], codes, at + PIECE >= len(text))
        keys, counts = np.unique(grams, return_counts=True)
        for lo in range(0, len(keys), TAKE):
            seen = True
            out += counts[lo : lo + TAKE].astype(np.float32) @ bank().take(keys[lo : lo + TAKE]).astype(np.float32)
    return out if seen else None


def _train(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    total: dict[str, np.ndarray] = {}
    for batch in slices(batches):
        for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist(), strict=True):
            v = vector(text)
            if v is not None and (size := float(np.linalg.norm(v))) > 0:
                total[lang] = total.get(lang, 0) + np.rint(v / size * UNIT).astype(np.int64)
    if total:
        yield pa.RecordBatch.from_arrays([pa.array(list(total)), pa.array([t.tolist() for t in total.values()], pa.list_(pa.int64()))], names=["lang", "total"])


def fit(train: DataFrame, text_col: str = "text", lang_col: str = "lang", per_language: int = 1500) -> tuple[list[str], np.ndarray]:
    """Languages and their unit prototypes, from labelled rows."""
    rows = train.select(F.col(text_col).cast("string").alias("text"), F.col(lang_col).cast("string").alias("lang")).where("text is not null and lang is not null")
    shares = class_shares(rows, "lang", F.xxhash64("text"), per_language)
    chosen = rows.where(in_sample("lang", F.xxhash64("text"), shares)).dropDuplicates(["text", "lang"])
    # One vector per task and language: bounded by the sample.
    sums: dict[str, np.ndarray] = {}
    for row in chosen.mapInArrow(_train, PROTOTYPES).collect():
        sums[row["lang"]] = sums.get(row["lang"], 0) + np.array(row["total"], np.int64)
    langs = sorted(sums)
    if not langs:
        return [], np.zeros((0, DIM))
    profile = np.stack([sums[k] for k in langs]).astype(np.float64)
    norms = np.linalg.norm(profile, axis=1, keepdims=True)
    return langs, profile / np.where(norms > 0, norms, 1)


def _predict(langs: list[str], profile: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            best, score = [], []
            for text in batch.column("text").to_pylist():
                v = vector(text) if text else None
                if v is None or not langs:
                    best.append("und")
                    score.append(0.0)
                    continue
                size = float(np.linalg.norm(v))
                cosine = np.round(profile @ v / size, 9) if size else np.zeros(len(langs))
                i = int(cosine.argmax())
                best.append(langs[i])
                score.append(float(min(1.0, max(0.0, cosine[i]))))
            kept = [c for c in batch.schema.names if c != "text"]
            yield pa.RecordBatch.from_arrays([*[batch.column(c) for c in kept], pa.array(best, pa.string()), pa.array(score, pa.float64())], names=[*kept, "lang_pred", "score"])

    return run


def identify(docs: DataFrame, model: tuple[list[str], np.ndarray], id_cols: dict[str, str], text_col: str = "text") -> DataFrame:
    """Per row: `id_cols` (name to type; carried along unseen), lang_pred, score. One pass, no shuffle."""
    names = {f"c{i}": F.col(f"`{n}`") for i, n in enumerate(id_cols)}
    rows = docs.select(*[c.alias(k) for k, c in names.items()], F.col(text_col).cast("string").alias("text"))
    schema = ", ".join(f"{k} {t}" for k, t in zip(names, id_cols.values(), strict=True))
    out = rows.mapInArrow(_predict(*model), f"{schema}, lang_pred string, score double")
    return out.select(*[F.col(k).alias(n) for k, n in zip(names, id_cols, strict=True)], "lang_pred", "score")
