"""Near-duplicate documents: one-permutation MinHash with optimal densification.

1. Every text gets the set of its distinct word shingles, one signature of `bins` values from a
   single hash pass, and bands of `rows` values each. Empty bins copy the first filled bin of a
   fixed random probe order (optimal densification).
2. Texts with equal sets (by the 128-bit BLAKE2b digest of the whole set) collapse into a class, so
   copies are never paired. A class is named by the least (id, fingerprint) of its texts.
3. In each bucket (equal band) every class is joined to the bucket's centre only: star edges,
   linear in the bucket. Links are confirmed on the full sets, made of the words themselves.
4. A star can miss links between two of its points. Buckets that hold several components after a
   round get another, random centre in the next, and only edges between components are confirmed.
   After `rounds` rounds the texts left are joined by an exact prefix filter on their shingles,
   which also finds the links that no star showed.
5. Components of the confirmed links, as the smallest reachable name.

With 6 rows and 40 bands a pair at similarity 0.8 meets in some bucket with probability 1 - 5e-6.
Joins whose left side may gather on one bucket, shingle, centre or hub are salted (common.salted_join);
a centre's text goes once to each of at most `FANS` groups of its partners.

Defined cases: null or blank text: 0 shingles, linked with nothing. Rows that share an id but not a
text are documents of their own, and kept says whether the row's text is the first of its component.
Equal rows get equal results (`copies` counts them). Rows without an id come after all others; a
component of such rows only has a null id. Words of any length and very long texts are hashed in
pieces. Extra columns are ignored. Empty table: no rows.
"""

from __future__ import annotations

import functools
import math
from collections import defaultdict
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import BASE_A, KEYS, NO_ID, U64, binary_parts, chunk_words, cut, documents_keyed, forget, mix, range_hash, salted_join, shared_table, signed, slices
from .components import connected_components

#: Groups among which the partners of one centre are dealt.
FANS = 64
NAME = "struct<k:long,fp:long>"


def shingle_sets(w: np.ndarray, begins: np.ndarray, width: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, end to end; where each text's begin; and a 128-bit digest of each set (x 2)."""
    n = np.diff(begins)
    lanes = []
    for lane in range(2):
        h = w[:, lane]
        at = np.arange(max(0, len(h) - width + 1))
        lanes.append(mix(range_hash(h, at, at + width, BASE_A) + U64(width)) if len(at) else np.empty(0, U64))
    parts, sizes, digests = [], np.zeros(len(n), np.int64), np.zeros((len(n), 2), U64)
    for i in range(len(n)):
        if n[i] == 0:
            continue
        if n[i] < width:
            lo, to = np.array([begins[i]]), np.array([begins[i + 1]])
            first, second = (mix(range_hash(w[:, lane], lo, to, BASE_A) + U64(n[i])) for lane in range(2))
        else:
            first, second = (lane[begins[i] : begins[i + 1] - width + 1] for lane in lanes)
            order = np.argsort(first)
            first = first[order]
            new = np.ones(len(first), bool)
            new[1:] = first[1:] != first[:-1]
            first, second = first[new], second[order][new]
        parts.append(first)
        sizes[i] = len(first)
        digests[i] = np.frombuffer(blake2b(first.tobytes() + second.tobytes(), digest_size=16).digest(), "<u8")
    return (np.concatenate(parts) if parts else np.empty(0, U64)), np.concatenate(([0], np.cumsum(sizes))), digests


@functools.lru_cache(maxsize=4)
def probe_order(bins: int) -> np.ndarray:
    """For each bin, the order in which an empty bin looks at the others."""
    rng = np.random.default_rng(20_240_101)
    return np.stack([rng.permutation(bins) for _ in range(bins)]).astype(np.int32)


def signatures(sets: np.ndarray, begins: np.ndarray, bins: int) -> np.ndarray:
    """One-permutation MinHash of each non-empty set, densified: array of texts x bins."""
    n = len(begins) - 1
    sig, filled = np.zeros((n, bins), U64), np.zeros((n, bins), bool)
    row = np.repeat(np.arange(n), np.diff(begins))
    at = ((sets >> U64(32)) * U64(bins) >> U64(32)).astype(np.int64)
    first = np.ones(len(sets), bool)
    first[1:] = (at[1:] != at[:-1]) | (row[1:] != row[:-1])
    sig[row[first], at[first]] = sets[first]
    filled[row[first], at[first]] = True
    r, c = np.nonzero(~filled & (np.diff(begins) > 0)[:, None])
    probes, t = probe_order(bins), 0
    while len(r) and t < bins:
        source = probes[c, t]
        found = filled[r, source]
        sig[r[found], c[found]] = sig[r[found], source[found]]
        r, c, t = r[~found], c[~found], t + 1
    return sig


def band_hashes(sig: np.ndarray, rows: int) -> np.ndarray:
    n, bins = sig.shape
    bands = sig.reshape(n, bins // rows, rows)
    out = np.broadcast_to(np.arange(1, bins // rows + 1, dtype=U64) * U64(0x9E3779B97F4A7C15), bands.shape[:2]).copy()
    for j in range(rows):
        out = mix(out * U64(0xD6E8FEB86659FD93 | 1) + bands[:, :, j])
    return out


def _profile(width: int, bins: int, rows: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            off, raw = binary_parts(batch.column("text"))
            for a, b, w, begins in chunk_words(off, raw, fold=True):
                sets, at, digests = shingle_sets(w, begins, width)
                n = np.diff(at)
                some = n > 0
                bands = band_hashes(signatures(sets, at, bins), rows)[some]
                lists = pa.ListArray.from_arrays(pa.array(np.concatenate(([0], np.cumsum(some * (bins // rows)))).astype(np.int32)), signed(bands.reshape(-1)))
                keys = [batch.column(c).slice(a, b - a) for c in KEYS]
                yield pa.RecordBatch.from_arrays([*keys, pa.array(n), signed(digests[:, 0].copy()), signed(digests[:, 1].copy()), lists], names=[*KEYS, "n", "h1", "h2", "bands"])

    return run


class ExactSets:
    """Shingle sets of the words themselves: words are numbered by a dictionary, a shingle is the bytes of its numbers."""

    MOST_WORDS = 1_000_000

    def __init__(self, width: int):
        self.width = width
        self.clear()

    def clear(self) -> None:
        self.number: defaultdict[bytes, int] = defaultdict()
        self.number.default_factory = self.number.__len__

    @property
    def full(self) -> bool:
        return len(self.number) > self.MOST_WORDS

    def __call__(self, text: bytes) -> np.ndarray:
        """Sorted distinct shingles of a text."""
        words = text.lower().split()
        ids = np.fromiter(map(self.number.__getitem__, words), np.uint32, len(words))
        width = min(self.width, len(ids))
        if not width:
            return np.empty(0, "V4")
        if width == 2:
            return np.unique(ids[:-1].astype(U64) << U64(32) | ids[1:])
        rows = np.ascontiguousarray(np.lib.stride_tricks.sliding_window_view(ids, width))
        return np.unique(rows.view(f"V{4 * width}").ravel())


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Whether two exact sets reach the similarity."""
    if not len(a) or not len(b) or a.dtype != b.dtype or 100 * min(len(a), len(b)) < percent * max(len(a), len(b)):
        return False
    same = len(a) + len(b) - len(np.unique(np.concatenate((a, b))))
    return 100 * same >= percent * (len(a) + len(b) - same)


def _confirm(width: int, percent: int):
    """Over groups (centre, fan) that begin with the centre's text: the links among centre and partners."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sets = ExactSets(width)
        centre, text, mine = None, b"", None
        for batch in slices(batches):
            out = []
            columns = [batch.column(c) for c in ("ak", "afp", "bk", "bfp")]
            for i, (ak, afp, first) in enumerate(zip(columns[0].to_pylist(), columns[1].to_pylist(), batch.column("first").to_pylist(), strict=True)):
                if first:
                    centre, text, mine = (ak, afp), batch.column("text")[i].as_py(), None
                    continue
                if centre != (ak, afp):
                    raise ValueError("a partner stands before its centre")
                if sets.full:
                    sets.clear()
                    mine = None
                if mine is None:
                    mine = sets(text)
                if linked(mine, sets(batch.column("text")[i].as_py()), percent):
                    out.append(i)
            if out:
                yield pa.RecordBatch.from_arrays([c.take(pa.array(out)) for c in columns], names=["ak", "afp", "bk", "bfp"])

    return run


def _pair(a: str, b: str) -> list[Column]:
    return [F.struct(F.col(f"{x}k").alias("k"), F.col(f"{x}fp").alias("fp")).alias(x) for x in (a, b)]


def _confirmed(pairs: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """The (a, b) of `pairs` that are links; `a` is the side that has many partners."""
    apart = pairs.select(F.col("a.k").alias("ak"), F.col("a.fp").alias("afp"), F.col("b.k").alias("bk"), F.col("b.fp").alias("bfp")).withColumn("fan", F.pmod(F.xxhash64("bk", "bfp"), F.lit(FANS)))
    none = F.lit(None).cast("long")
    partners = apart.join(texts.select(F.col("k").alias("bk"), F.col("fp").alias("bfp"), "text"), ["bk", "bfp"]).select("ak", "afp", "fan", F.lit(False).alias("first"), "bk", "bfp", "text")
    centres = apart.select("ak", "afp", "fan").distinct().join(texts.select(F.col("k").alias("ak"), F.col("fp").alias("afp"), "text"), ["ak", "afp"]).select("ak", "afp", "fan", F.lit(True).alias("first"), none.alias("bk"), none.alias("bfp"), "text")
    grouped = partners.unionByName(centres).repartition("ak", "afp", "fan").sortWithinPartitions("ak", "afp", "fan", F.desc("first"))
    return grouped.select("ak", "afp", "first", "bk", "bfp", "text").mapInArrow(_confirm(width, percent), "ak long, afp long, bk long, bfp long").select(*_pair("a", "b"))


def _sets(width: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            off, raw = binary_parts(batch.column("text"))
            for a, b, w, begins in chunk_words(off, raw, fold=True):
                sets, at, _ = shingle_sets(w, begins, width)
                kept = [batch.column(c).slice(a, b - a) for c in ("rep", "n", "of")]
                yield pa.RecordBatch.from_arrays([*kept, pa.ListArray.from_arrays(pa.array(at.astype(np.int32)), signed(sets))], names=["rep", "n", "of", "set"])

    return run


def _several_components(rows: DataFrame) -> DataFrame:
    """The rows of buckets that hold more than one component."""
    split = rows.groupBy("bucket").agg(F.min("of").alias("lo"), F.max("of").alias("hi")).where("lo != hi").select("bucket")
    return salted_join(rows, split, ["bucket"], "left_semi")


def _pairs_left(rest: DataFrame, texts: DataFrame, width: int, percent: int) -> DataFrame:
    """Pairs (a, b) of texts in `rest`, in different components, that may still be links: an exact prefix filter.

    Two texts of n and m shingles are linked only if they share i >= p (n + m) / (100 + p) of them.
    Then, whatever the order, one of the first n - i + 1 shingles of the first is in the second.
    Each text's shingles are ordered by how many texts hold them, rarest first, so these prefixes
    meet few others. One side is enough: that of the smaller component (ties: smaller id). Texts
    are indexed by shingle and size class, as the prefix is the shorter the larger the other text.
    """
    who = rest.select("rep", "of", "n").distinct()
    sizes = who.groupBy("of").agg(F.count(F.lit(1)).alias("texts"))
    owner = cut(who).join(sizes, "of").select("rep.k", "rep.fp", "n", F.struct("texts", "of").alias("of"))
    rows = texts.join(owner, KEYS).select(F.struct(*KEYS).alias("rep"), "n", "of", "text")
    sets = cut(rows.mapInArrow(_sets(width), f"rep {NAME}, n long, of struct<texts:long,of:{NAME}>, set array<long>"))
    each = sets.select("rep", "n", "of", F.explode("set").alias("g"))
    held = each.groupBy("g").agg(F.count(F.lit(1)).alias("df"), F.max("of").alias("top"))
    needed = lambda n, m: F.ceil(percent * (n + m) / F.lit(100.0 + percent) - 1e-9)
    size_class = lambda n: F.floor(F.log(n.cast("double")) / math.log(1.03))
    longest = F.col("n") - F.ceil(F.col("n") * percent / 100 - 1e-9) + 1
    order = Window.partitionBy("rep").orderBy("df", "g")
    prefix = salted_join(each, held, ["g"]).withColumn("r", F.row_number().over(order)).where((F.col("r") <= longest) & (F.col("top") > F.col("of")))
    low, high = size_class(F.col("n") * percent / 100), size_class(F.col("n") * 100 / percent)
    ways = prefix.select("g", F.col("rep").alias("a"), F.col("n").alias("an"), F.col("of").alias("a_of"), "r", F.explode(F.sequence(low - 1, high + 1)).alias("class"))
    ways = ways.where(F.col("r") <= F.col("an") - needed(F.col("an"), F.exp(F.col("class") * math.log(1.03))) + 1)
    index = each.select("g", F.col("rep").alias("b"), "n", "of", size_class(F.col("n")).alias("class"))
    met = ways.join(index, ["g", "class"]).where((F.col("of") > F.col("a_of")) & (F.col("of.of") != F.col("a_of.of")) & (F.col("r") <= F.col("an") - needed(F.col("an"), F.col("n")) + 1))
    return met.select("a", "b")


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80, bins: int = 240, rows: int = 6, rounds: int = 1) -> DataFrame:
    """One row per input row: `id_col`, n_shingles, component_id, kept (its text is the component's first), fp (xxhash64 of its text), copies (equal rows)."""
    keyed = documents_keyed(docs, id_col, text_col).select(*KEYS, F.col("text").cast("binary").alias("text"))
    profile = shared_table(keyed.mapInArrow(_profile(width, bins, rows), "k long, fp long, n long, h1 long, h2 long, bands array<long>"), "minhash-profile")
    known = profile.where("n > 0")
    classes = known.groupBy("h1", "h2").agg(F.min(F.struct(*KEYS)).alias("rep"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    buckets = cut(classes.select("rep", "n", F.explode("bands").alias("bucket")))
    shared = buckets.groupBy("bucket").agg(F.count(F.lit(1)).alias("members")).where("members > 1").select("bucket")
    members = shared_table(salted_join(buckets, shared, ["bucket"], "left_semi"), "minhash-members")
    forget(buckets)
    wanted = members.select("rep.k", "rep.fp").distinct()
    texts = shared_table(keyed.join(wanted, KEYS, "left_semi").dropDuplicates(KEYS), "minhash-texts")

    fits = lambda x, y: F.least(x, y) * 100 >= F.greatest(x, y) * percent
    links, components, rest = None, None, members.withColumn("of", F.col("rep"))
    stale: list[DataFrame] = []
    for turn in range(rounds + 1):
        if turn < rounds:  # stars: every member with one centre of its bucket, another in each round
            order = F.col("rep") if turn == 0 else F.struct(F.xxhash64("bucket", "rep", F.lit(turn)), "rep")
            centres = rest.groupBy("bucket").agg(F.min(F.struct(order.alias("order"), F.col("rep").alias("rep"), F.col("n").alias("n"), F.col("of").alias("of"))).alias("c"))
            met = salted_join(rest, centres, ["bucket"]).where((F.col("of") != F.col("c.of")) & fits(F.col("n"), F.col("c.n"))).select(F.col("c.rep").alias("a"), F.col("rep").alias("b"))
        else:  # what stars have left: members of one bucket in different components
            met = _pairs_left(rest, texts, width, percent)
        met = cut(met.distinct())
        found = cut(_confirmed(met, texts, width, percent))
        forget(met)
        stale.append(found)
        links = found if links is None else links.union(found)
        if turn == 0 or found.limit(1).count():
            forget(components)
            components = connected_components(links)
        if turn == rounds:
            break
        placed = rest.drop("of").join(components.select(F.col("id").alias("rep"), F.col("component").alias("of")), "rep", "left").withColumn("of", F.coalesce("of", "rep"))
        rest = cut(_several_components(cut(placed)))
        stale.append(rest)
        if not rest.limit(1).count():
            break
    forget(texts, members, *stale)

    # A stored table: a class of many copies is then a join that can be salted.
    reps = cut(classes.select("h1", "h2", "rep"))
    owned = salted_join(known.groupBy(*KEYS, "h1", "h2").agg(F.count(F.lit(1)).alias("copies")), reps, ["h1", "h2"])
    placed = owned.join(components.withColumnRenamed("id", "rep"), "rep", "left").select(*KEYS, "copies", F.coalesce("component", "rep").alias("first"))
    first = F.coalesce("first", F.struct(*KEYS))
    null_id = lambda c: F.when(c != NO_ID, c)
    return profile.select(*KEYS, "n").join(placed, KEYS, "left").select(
        null_id(F.col("k")).alias(id_col), F.col("n").alias("n_shingles"), null_id(first["k"]).alias("component_id"), (first == F.struct(*KEYS)).alias("kept"), "fp", F.coalesce("copies", F.lit(1)).alias("copies")
    )
