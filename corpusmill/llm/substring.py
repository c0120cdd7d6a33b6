"""Exact substring deduplication by seed and extend over winnowed anchors.

A window is `length` consecutive words of one text. A window is a repeat if the same words start
earlier: in a smaller id, or earlier in the same text. Every word of a repeat is removed, so the
removed stretches are the maximal repeats of at least `length` words.

Seed: of the word k-grams in each window the one of least hash is the window's anchor, so equal
windows share an anchor at the same offset. Successive windows with the same anchor form a cell.
Occurrences are joined on their anchors by partitioning and sorting on (anchor, cell).
Extend: an anchor is extended both ways to its whole cell. A cell that occurred before is a repeat
as a whole. Where cells around one anchor differ, the extensions part somewhere inside, and only
the first occurrence of each such cell is extended window by window, again by partitioning and
sorting. No pair of occurrences is ever built, so a group of n copies costs n rows, and of a
passage that many texts share a task sends only few of them into the group (see Emitter).

Runs of words are equal if the 128-bit BLAKE2b digests over the BLAKE2b digests of their words are;
the 64-bit hashes of anchors only say which cells are compared.

Defined cases: null or blank text: no words. Rows without an id come after all others. Rows of one
id but different texts are ordered by a fingerprint of the text; fully equal rows are the same
occurrence, never repeats of each other, and get equal results. Texts shorter than `length` words
keep all words. Very long texts are hashed in pieces; a text has at most 2^43 words and `length`
is below 2^20. Extra columns travel in one struct, whatever their names. Empty table: no rows.
"""

from __future__ import annotations

import functools
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import BASE_A, KEYS, NO_ID, U64, binary_parts, chunk_words, documents_keyed, mix, range_hash, run_digests, shared_table, signed, slices

#: A cell or window is packed as start * SPAN + number of windows.
SPAN = 1 << 20
ORDER = [*KEYS, "span"]


def sliding_argmin(values: np.ndarray, width: int) -> np.ndarray:
    """Leftmost position of the least value in each window of `width` values."""
    bits = max(20, int(len(values)).bit_length())
    low = U64((1 << bits) - 1)
    key = (values & ~low) | np.arange(len(values), dtype=U64)
    have = 1
    while have < width:
        step = min(have, width - have)
        key = np.minimum(key[:-step], key[step:])
        have += step
    return (key & low).astype(np.int64)


def cells(w: np.ndarray, begins: np.ndarray, length: int, k: int) -> tuple[np.ndarray, ...]:
    """Row, start, number of windows, anchor hash and digest (x 2) of every cell."""
    none = np.empty(0, np.int64)
    if len(w) < length:
        return none, none, none, none.astype(U64), np.empty((0, 2), U64)
    at = np.arange(len(w) - k + 1)
    grams = mix(range_hash(w[:, 0], at, at + k, BASE_A))
    anchor = sliding_argmin(grams, length - k + 1)
    row = np.repeat(np.arange(len(begins) - 1), np.diff(begins))[: len(anchor)]
    inside = np.arange(len(anchor)) + length <= begins[1:][row]
    start = np.flatnonzero(inside)
    if not len(start):
        return none, none, none, none.astype(U64), np.empty((0, 2), U64)
    a, r = anchor[start], row[start]
    new = np.ones(len(start), bool)
    new[1:] = (a[1:] != a[:-1]) | (r[1:] != r[:-1])
    first = np.flatnonzero(new)
    n = np.diff(np.append(first, len(start)))
    s, a, r = start[first], a[first], r[first]
    # Cells of one anchor and equal words that place the anchor alike have as many windows.
    digest = run_digests(w, s, s + n + length - 1)
    digest[:, 1] += (a - s).astype(U64)
    return r, s - begins[:-1][r], n, grams[a], digest


class Emitter:
    """Rows (x, y, z, keys, span, local) for the shuffle; what is known here to be a repeat is marked and spread by a key of its own.

    (x, y, z) stands for the words. Repeats within a piece are found by sorting. Words that repeat there are remembered
    for the rest of the task (the first `most` of them) with their least key, so a passage that many texts share
    sends few rows a task into the group where its first occurrence is found.
    """

    def __init__(self, most: int = 100_000):
        self.most = most
        self.seen: dict[int, tuple] = {}

    def __call__(self, x: np.ndarray, y: np.ndarray, z: np.ndarray, keys: dict[str, np.ndarray]) -> pa.RecordBatch:
        order = np.lexsort([keys["span"], keys["fp"], keys["k"], z, y, x])
        xs, ys, zs = x[order], y[order], z[order]
        cols = {c: v[order] for c, v in keys.items()}
        new = np.ones(len(order), bool)
        new[1:] = (xs[1:] != xs[:-1]) | (ys[1:] != ys[:-1]) | (zs[1:] != zs[:-1])
        at = np.flatnonzero(new)
        first = np.repeat(at, np.diff(np.append(at, len(order))))
        repeat = ~new
        for_all = np.ones(len(order), bool)
        for c in ORDER:
            for_all &= cols[c] == cols[c][first]
        repeat &= ~for_all  # equal keys: one occurrence, in equal rows
        several = np.diff(np.append(at, len(order))) > 1
        seen = self.seen
        for j, v in enumerate(ys[at].tolist()):
            if several[j] or v in seen:
                i = at[j]
                words, key = (int(xs[i]), int(zs[i])), tuple(int(cols[c][i]) for c in ORDER)
                known = seen.get(v)
                if known is None:
                    if len(seen) < self.most:
                        seen[v] = (words, key)
                elif known[0] == words:
                    if known[1] < key:
                        repeat[i] = True
                    else:
                        seen[v] = (words, key)
        if repeat.any():
            xs, ys, zs = xs.copy(), ys.copy(), zs.copy()
            xs[repeat] = mix(cols["k"][repeat].astype(U64) * U64(31) + cols["span"][repeat].astype(U64))
            ys[repeat] = zs[repeat] = 0
        return pa.RecordBatch.from_arrays([signed(xs), signed(ys), signed(zs), *[pa.array(cols[c]) for c in ORDER], pa.array(repeat)], names=["x", "y", "z", *ORDER, "local"])


def _anchor_rows(length: int, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emit = Emitter()
        for batch in slices(batches):
            off, raw = binary_parts(batch.column("text"))
            own = {c: batch.column(c).to_numpy() for c in KEYS}
            for a, _, w, begins in chunk_words(off, raw, fold=False):
                r, s, n, anchor, digest = cells(w, begins, length, k)
                if len(r):
                    yield emit(anchor, digest[:, 0], digest[:, 1], {c: own[c][a + r] for c in KEYS} | {"span": s * SPAN + n})

    return run


def _resolve(with_checks: bool):
    """Over rows sorted by (x, y, z, keys, span): repeats, and first occurrences of cells whose anchor has several.

    Keeps one row between batches, so a group of any size is passed in bounded memory.
    """
    names = ORDER

    def out(cols: dict[str, np.ndarray], check: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([*[pa.array(cols[c]) for c in names], pa.array(check)], names=[*names, "check"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last = None  # the first occurrence of the cell in hand, and whether it was given out as a check
        for batch in batches:
            cols = {c: batch.column(c).to_numpy(zero_copy_only=False) for c in ["x", "y", "z", *names]}
            local = batch.column("local").to_numpy(zero_copy_only=False)
            if local.any():
                yield out({c: cols[c][local] for c in names}, np.zeros(int(local.sum()), bool))
                cols = {c: v[~local] for c, v in cols.items()}
            if not len(cols["x"]):
                continue
            if last is not None:  # the cell in hand goes in front
                cols = {c: np.concatenate(([last[c]], v)) for c, v in cols.items()}
            x, y, z = cols["x"], cols["y"], cols["z"]
            new = np.ones(len(x), bool)
            new[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1]) | (z[1:] != z[:-1])
            at = np.flatnonzero(new)
            first = np.maximum.accumulate(np.where(new, np.arange(len(x)), 0))
            repeat = ~new
            same = repeat.copy()
            for c in names:
                same &= cols[c] == cols[c][first]
            repeat &= ~same
            if repeat.any():
                yield out({c: cols[c][repeat] for c in names}, np.zeros(int(repeat.sum()), bool))
            done = last is not None and last["done"] and len(at) == 1
            if with_checks:
                fx = x[at]
                after, before = np.zeros(len(at), bool), np.zeros(len(at), bool)
                after[:-1] = fx[:-1] == fx[1:]
                before[1:] = after[:-1]
                check = before | after
                done = done or bool(check[-1])
                if last is not None and last["done"]:
                    check[0] = False
                rows = at[check]
                if len(rows):
                    yield out({c: cols[c][rows] for c in names}, np.ones(len(rows), bool))
            i = at[-1]
            last = {c: v[i] for c, v in cols.items()} | {"done": done}

    return run


def _window_rows(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        emit = Emitter()
        for batch in slices(batches):
            off, raw = binary_parts(batch.column("text"))
            own = {c: batch.column(c).to_numpy() for c in KEYS}
            lists = batch.column("checks")
            loff, spans = np.asarray(lists.offsets), lists.values.to_numpy()
            for a, b, w, begins in chunk_words(off, raw, fold=False):
                span = spans[loff[a] : loff[b]]
                row = np.repeat(np.arange(a, b), np.diff(loff[a : b + 1]))
                n = span % SPAN
                start = np.repeat(span // SPAN, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                row = np.repeat(row, n)
                if not len(row):
                    continue
                s = start + begins[:-1][row - a]
                digest = run_digests(w, s, s + length)
                yield emit(digest[:, 0], digest[:, 1], np.zeros(len(s), U64), {c: own[c][row] for c in KEYS} | {"span": start * SPAN + 1})

    return run


def removed_words(n: int, spans: np.ndarray, length: int) -> np.ndarray:
    """Which of n words the packed spans cover."""
    edge = np.zeros(n + 1, np.int64)
    start, k = spans // SPAN, spans % SPAN
    np.add.at(edge, start, 1)
    np.add.at(edge, start + k + length - 1, -1)
    return np.cumsum(edge[:n]) > 0


def repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 20, k: int = 6) -> DataFrame:
    """Every row (k, fp, text as bytes, row: the input row) with its repeated stretches `spans` (null if none)."""
    if not 0 < k <= length < SPAN:
        raise ValueError(f"need 0 < k <= length < {SPAN}")
    whole = documents_keyed(docs, id_col, text_col).withColumn("text", F.col("text").cast("binary"))
    texts = whole.select(*KEYS, "text")
    row = "x long, y long, z long, k long, fp long, span long, local boolean"
    found = "k long, fp long, span long, check boolean"
    order = ["x", "y", "z", *ORDER]
    anchors = texts.mapInArrow(_anchor_rows(length, k), row)
    seeds = anchors.repartition("x").sortWithinPartitions(*order).mapInArrow(_resolve(True), found)
    per_text = shared_table(seeds.groupBy(*KEYS).agg(F.collect_list(F.when(~F.col("check"), F.col("span"))).alias("dups"), F.collect_list(F.when(F.col("check"), F.col("span"))).alias("checks")), "substring-seeds")
    open_cells = texts.join(per_text.select(*KEYS, "checks").where(F.size("checks") > 0), KEYS)
    windows = open_cells.mapInArrow(_window_rows(length), row)
    late = windows.repartition("x").sortWithinPartitions(*order).mapInArrow(_resolve(False), found)
    late = late.groupBy(*KEYS).agg(F.collect_list("span").alias("late"))
    none = F.array().cast("array<long>")
    spans = F.concat(F.coalesce("dups", none), F.coalesce("late", none))
    marked = whole.join(per_text.select(*KEYS, "dups"), KEYS, "left").join(late, KEYS, "left")
    return marked.select(*KEYS, "text", "row", F.when(F.size(spans) > 0, spans).alias("spans"))


def _spans_of(batch: pa.RecordBatch) -> list[np.ndarray | None]:
    return [None if x is None else np.asarray(x, np.int64) for x in batch.column("spans").to_pylist()]


def _digest(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            n, gone, sha = [], [], []
            for text, spans in zip(batch.column("text").to_pylist(), _spans_of(batch), strict=True):
                words = text.split()
                n.append(len(words))
                if spans is not None:
                    out = removed_words(len(words), spans, length)
                    words = [w for w, x in zip(words, out.tolist(), strict=True) if not x]
                gone.append(n[-1] - len(words))
                sha.append(hashlib.sha256(b" ".join(words)).hexdigest())
            yield pa.RecordBatch.from_arrays([batch.column("k"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha)], names=["k", "n_words", "n_removed", "kept_sha256"])

    return run


@functools.lru_cache(maxsize=1)
def _word():
    import re

    return re.compile(rb"[^\x20\x09-\x0d]+")


def cut_words(text: bytes, spans: np.ndarray, length: int) -> tuple[bytes, int]:
    """The text without the words that spans cover, and their number; white space before a kept word stays."""
    found = [(m.start(), m.end()) for m in _word().finditer(text)]
    out = removed_words(len(found), spans, length)
    parts, at = [], 0
    for (_, e), gone in zip(found, out.tolist(), strict=True):
        if not gone:
            parts.append(text[at:e])
        at = e
    return b"".join(parts).lstrip(b" \t\n\x0b\x0c\r"), int(out.sum())


def _cut(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            made, gone, left = [], [], []
            for text, spans in zip(batch.column("text").to_pylist(), _spans_of(batch), strict=True):
                new, n = (text, 0) if spans is None else cut_words(text, spans, length)
                made.append(new.decode())
                gone.append(n)
                left.append(bool(new.split()))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(made, pa.string()), pa.array(gone, pa.int64()), pa.array(left, pa.bool_())], names=["row", "text", "n_removed", "has_words"])

    return run


def word_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 20, k: int = 6) -> DataFrame:
    """Per input row: id, n_words, n_removed, and kept_sha256 of the kept words joined by one space."""
    out = repeats(docs, id_col, text_col, length, k).select("k", "text", "spans").mapInArrow(_digest(length), "k long, n_words long, n_removed long, kept_sha256 string")
    return out.select(F.when(F.col("k") != NO_ID, F.col("k")).alias(id_col), "n_words", "n_removed", "kept_sha256")


def remove_repeats(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 50, k: int = 16) -> DataFrame:
    """Per input row: row (the input row, as a struct), text (without repeats; empty for null), n_removed, has_words."""
    marked = repeats(docs, id_col, text_col, length, k).select("row", "text", "spans")
    added = [T.StructField("text", T.StringType()), T.StructField("n_removed", T.LongType()), T.StructField("has_words", T.BooleanType())]
    return marked.mapInArrow(_cut(length), T.StructType([marked.schema["row"], *added]))
