"""Toxicity: votes of the nearest labelled examples by exact TF-IDF cosine.

Fitting takes a bounded sample of labelled rows (about `positives` + `negatives`, those of least id
hash) and all of its terms: words, and the first 4 and 5 letters of longer words. TF is 1 + ln(count).
A term weighs its IDF times its information gain about the label (TF-IDF-IG, a supervised weighting of
Debole and Sebastiani, 2003), shrunk by n IG / (n IG + PRIOR) towards 0 where few texts speak for it.
No term is left out; vectors are unit length over all terms of the sample.

The examples lie in blocks of a block-max inverted index. Rare terms have posting lists; frequent ones
also the largest weight in each block. A block's upper bound is the best sum from the lists plus the
bounds of its frequent terms; blocks are scored in bound order until none reaches the k-th best
similarity, so the k nearest are exact; a batch of texts is scored against a block at once. Examples
with similarity 0 have no vote.

Votes are weighted by similarity and smoothed by the base rate; a logistic curve fitted on
leave-one-out votes of the sample (taken in tasks) turns them into calibrated scores. `evidence` names
the voters.

Defined cases: null or empty text, or no known term: the score of no votes. No labelled rows, or
labels of one kind: the base rate for all. Ties in similarity (to 12 digits) go to the smaller example
id; equal texts of the sample are one example, toxic if any is labelled so. An id with several texts
gives one example, the text of least hash. Repeated rows get equal results. Very long texts are read
whole. The input row travels in one struct, so its columns may have any names. Empty table: no rows.
"""

from __future__ import annotations

import math
import re
from collections import Counter, defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import class_shares, in_sample, slices

WORD = re.compile(r"[^\W\d_]+")
#: Texts scored at once.
QUERIES = 64
#: Texts that must speak for a term before its information gain counts by half, in nats of evidence.
PRIOR = 10.0


def terms_of(word: str) -> tuple[str, ...]:
    return (word, "4:" + word[:4], "5:" + word[:5]) if len(word) > 5 else (word, "4:" + word[:4]) if len(word) > 4 else (word,)


def information_gain(a: np.ndarray, b: np.ndarray, n1: int, n0: int) -> np.ndarray:
    """Mutual information (nats) of a label with n1 ones and n0 zeros and of a term in a texts of the ones and b of the zeros."""

    def part(joint: np.ndarray, side: np.ndarray, label: float) -> np.ndarray:
        return np.where(joint > 0, joint * np.log(np.maximum(joint, 1e-300) / np.maximum(side * label, 1e-300)), 0.0)

    n = float(n1 + n0)
    a, b = a / n, b / n
    with_term, without = a + b, 1 - a - b
    p1, p0 = n1 / n, n0 / n
    return np.maximum(part(a, with_term, p1) + part(b, with_term, p0) + part(p1 - a, without, p1) + part(p0 - b, without, p0), 0.0)


Vector = tuple[np.ndarray, np.ndarray]


class BlockMaxIndex:
    """Exact k nearest rows by dot product of non-negative sparse vectors, for batches of queries.

    Rows are given as arrays: where each begins in `terms` and `weights`. Terms that at least 1 in `frequent`
    rows hold are frequent: their weights stand in one matrix a block, and their largest ones beside it.
    """

    def __init__(self, begins: np.ndarray, terms: np.ndarray, weights: np.ndarray, n_terms: int, ids: np.ndarray, block: int = 128, frequent: int = 10):
        self.n, self.block = len(begins) - 1, block
        self.blocks = max(1, -(-self.n // block))
        self.ids = np.concatenate((ids, np.zeros(self.blocks * block - self.n, np.int64)))
        row = np.repeat(np.arange(self.n, dtype=np.int32), np.diff(begins))
        held = np.bincount(terms, minlength=n_terms)
        self.dense = np.full(n_terms, -1, np.int32)
        often = np.flatnonzero(held * frequent >= max(self.n, frequent))
        self.dense[often] = np.arange(len(often))
        self.table = np.zeros((self.blocks, len(often), block))
        is_dense = self.dense[terms] >= 0
        r = row[is_dense]
        self.table[r // block, self.dense[terms[is_dense]], r % block] = weights[is_dense]
        self.top = self.table.max(2).T.copy()  # frequent terms x blocks
        order = np.argsort(terms[~is_dense], kind="stable")
        self.rows, self.weights = row[~is_dense][order], weights[~is_dense][order]
        self.ends = np.cumsum(np.where(self.dense >= 0, 0, held)).astype(np.int32)
        self.starts = np.concatenate((np.zeros(1, np.int32), self.ends))[:n_terms]

    def nearest(self, queries: list[Vector], k: int, without: np.ndarray | None = None) -> tuple[list[list[tuple[float, int]]], int]:
        """(Per query, (similarity, row) of its k best rows of positive similarity, best first, ties to the smaller id; query blocks scored)."""
        n, size = len(queries), self.blocks * self.block
        q = np.zeros((n, self.table.shape[1]))
        known = np.zeros((n, self.blocks, self.block))
        for i, (terms, weights) in enumerate(queries):
            at = self.dense[terms]
            q[i, at[at >= 0]] = weights[at >= 0]
            rare = at < 0
            s, e = self.starts[terms[rare]], self.ends[terms[rare]]
            length = e - s
            which = np.repeat(s - (np.cumsum(length) - length), length) + np.arange(length.sum())
            known[i] = np.bincount(self.rows[which], self.weights[which] * np.repeat(weights[rare], length), size).reshape(self.blocks, self.block)
        if without is not None:
            known[np.arange(n), without // self.block, without % self.block] = -np.inf
        bound = q @ self.top + known.max(2)
        scores: list[np.ndarray] = [np.zeros(0)] * n
        rows: list[np.ndarray] = [np.zeros(0, np.int64)] * n
        least, done = np.full(n, 1e-12), 0
        for b in np.argsort(-bound.sum(0), kind="stable").tolist():
            active = np.flatnonzero(bound[:, b] * (1 + 1e-9) + 1e-12 >= least)
            if not len(active):
                continue
            done += len(active)
            made = np.round(known[active, b] + q[active] @ self.table[b], 12)
            for i, found in zip(active.tolist(), made, strict=True):
                j = np.flatnonzero(found >= least[i])
                if not len(j):
                    continue
                x, r = np.concatenate((scores[i], found[j])), np.concatenate((rows[i], j + b * self.block))
                if len(x) >= k:
                    best = np.lexsort((self.ids[r], -x))[:k]
                    x, r = x[best], r[best]
                    least[i] = x[-1]
                scores[i], rows[i] = x, r
        out = []
        for x, r in zip(scores, rows, strict=True):
            best = np.lexsort((self.ids[r], -x))
            out.append(list(zip(x[best].tolist(), r[best].tolist(), strict=True)))
        return out, done


@dataclass
class ToxicityModel:
    """Terms of the sample with their weights, and the examples: where each begins in `terms` and their `counts`."""

    names: pa.Array
    weights: np.ndarray
    ids: np.ndarray
    labels: np.ndarray
    begins: np.ndarray
    terms: np.ndarray
    counts: np.ndarray
    base: float
    k: int = 15
    smooth: float = 0.5
    slope: float = 1.0
    shift: float = 0.0
    index: BlockMaxIndex | None = field(default=None, repr=False)
    places: tuple[dict[str, int], ...] | None = field(default=None, repr=False)

    def __getstate__(self):
        return self.__dict__ | {"index": None, "places": None}

    def vector(self, text: str) -> Vector:
        """Terms and weights of the unit vector of a text; as terms_of, by dictionaries of words and of beginnings."""
        if self.places is None:
            self.places = ({}, {}, {})
            for i, t in enumerate(self.names.to_pylist()):
                kind = {"4:": 1, "5:": 2}.get(t[:2], 0)
                self.places[kind][t[2:] if kind else t] = i
        whole, four, five = (d.get for d in self.places)
        counts: defaultdict[int, int] = defaultdict(int)
        for w, n in Counter(WORD.findall(text.lower())).items():
            if (t := whole(w)) is not None:
                counts[t] += n
            if len(w) > 4:
                if (t := four(w[:4])) is not None:
                    counts[t] += n
                if len(w) > 5 and (t := five(w[:5])) is not None:
                    counts[t] += n
        terms = np.fromiter(counts, np.int64, len(counts))
        order = np.argsort(terms)
        terms = terms[order]
        return terms, unit(terms, np.fromiter(counts.values(), np.float64, len(counts))[order], self.weights)

    def nearest(self, vectors: list[Vector], without: np.ndarray | None = None) -> list[list[tuple[float, int]]]:
        if not len(self.ids):
            return [[] for _ in vectors]
        if self.index is None:
            self.index = BlockMaxIndex(self.begins, self.terms, np.concatenate([self.example(i)[1] for i in range(len(self.ids))]), len(self.names), self.ids)
        return self.index.nearest(vectors, self.k, without)[0]

    def example(self, i: int) -> Vector:
        """The unit vector of an example."""
        terms = self.terms[self.begins[i] : self.begins[i + 1]]
        return terms, unit(terms, self.counts[self.begins[i] : self.begins[i + 1]], self.weights)

    def vote(self, found: list[tuple[float, int]]) -> float:
        """Similarity-weighted share of label 1, drawn to the base rate where similarities are small."""
        return (sum(s for s, i in found if self.labels[i]) + self.smooth * self.base) / (sum(s for s, _ in found) + self.smooth)

    def calibrated(self, vote: float) -> float:
        v = min(1 - 1e-6, max(1e-6, vote))
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, self.slope * math.log(v / (1 - v)) + self.shift))))

    def scores(self, texts: list[str]) -> list[tuple[float, list[tuple[float, int]]]]:
        """Score and voters of each text."""
        return [(self.calibrated(self.vote(found)), found) for found in self.nearest([self.vector(t) for t in texts])]


def unit(terms: np.ndarray, counts: np.ndarray, weights: np.ndarray) -> np.ndarray:
    raw = (1 + np.log(counts)) * weights[terms] if len(terms) else np.zeros(0)
    size = float(np.sqrt((raw * raw).sum()))
    return raw / size if size > 0 else raw


def _logistic(x: np.ndarray, y: np.ndarray, w: np.ndarray, ridge: float = 1.0) -> tuple[float, float]:
    """Slope (drawn to 1) and shift of a weighted logistic fit, by Newton steps."""
    a, b = 1.0, 0.0
    for _ in range(30):
        p = 1 / (1 + np.exp(-np.clip(a * x + b, -50, 50)))
        g = w * (p - y)
        h = w * p * (1 - p) + 1e-9
        grad = np.array([(g * x).sum() + ridge * (a - 1), g.sum() + ridge * b])
        hess = np.array([[(h * x * x).sum() + ridge, (h * x).sum()], [(h * x).sum(), h.sum() + ridge]])
        step = np.linalg.solve(hess, grad)
        a, b = a - step[0], b - step[1]
        if np.abs(step).max() < 1e-8:
            break
    return float(min(8.0, max(0.25, a))), float(b)


def _terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Terms of each text with their counts."""
    for batch in slices(batches):
        terms, counts = [], []
        for text in batch.column("text").to_pylist():
            found: Counter[str] = Counter()
            for w, n in Counter(WORD.findall(text.lower())).items():
                for t in terms_of(w):
                    found[t] += n
            terms.append(list(found))
            counts.append(np.array(list(found.values()), np.int32))
        yield pa.RecordBatch.from_arrays([batch.column("id"), batch.column("y"), pa.array(terms, pa.list_(pa.string())), pa.array(counts, pa.list_(pa.int32()))], names=["id", "y", "terms", "counts"])


def _vote_rows(model: Broadcast):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m = model.value
        for batch in batches:
            votes: list[float] = []
            for part in slices([batch], QUERIES):
                rows = part.column("row").to_numpy()
                votes += map(m.vote, m.nearest([m.example(i) for i in rows.tolist()], rows))
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(votes, pa.float64())], names=["row", "vote"])

    return run


def _empty(base: float) -> ToxicityModel:
    none, whole = np.zeros(0), np.zeros(0, np.int64)
    return ToxicityModel(pa.array([], pa.string()), none, whole, whole, np.zeros(1, np.int64), whole, whole, base, smooth=1.0)


def fit(labelled: DataFrame, docs: DataFrame, label_col: str = "toxic", id_col: str = "doc_id", text_col: str = "text", positives: int = 600, negatives: int = 1800, prior: float = PRIOR) -> ToxicityModel:
    """Fits on about `positives` + `negatives` ids of `labelled` (id, label; all where there are fewer), with their texts from `docs`."""
    spark = docs.sparkSession
    known = labelled.where(F.col(label_col).isin(0, 1) & F.col(id_col).isNotNull()).select(F.col(id_col).alias("id"), F.col(label_col).cast("int").alias("y"))
    shares = class_shares(known, "y", F.col("id"), {1: positives, 0: negatives})
    chosen = known.where(in_sample("y", F.xxhash64("id"), shares)).groupBy("id").agg(F.max("y").alias("y"))
    texts = docs.select(F.col(id_col).alias("id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")).join(F.broadcast(chosen), "id")
    single = texts.groupBy("id", "y").agg(F.min_by("text", F.xxhash64("text")).alias("text"))
    sample = single.groupBy("text").agg(F.min("id").cast("long").alias("id"), F.max("y").alias("y")).select("id", "y", "text")
    rows = sample.mapInArrow(_terms, "id long, y int, terms array<string>, counts array<int>").toArrow().combine_chunks()
    total = {r["y"]: r["n"] for r in known.groupBy("y").agg(F.count(F.lit(1)).alias("n")).collect()}
    ids, labels = rows["id"].to_numpy(), rows["y"].to_numpy().astype(np.int64)
    n1, n0 = int(labels.sum()), int((1 - labels).sum())
    base = total.get(1, 0) / max(1, sum(total.values()))
    if not n1 or not n0:
        return _empty(base if total else 0.0)
    lists = [rows[c].combine_chunks() for c in ("terms", "counts")]
    lists = [x.chunk(0) if isinstance(x, pa.ChunkedArray) else x for x in lists]
    begins = np.asarray(lists[0].offsets).astype(np.int64)
    coded = lists[0].values.dictionary_encode()
    names, which = coded.dictionary, coded.indices.to_numpy().copy()
    counts, row = np.asarray(lists[1].values).astype(np.int32), np.repeat(np.arange(len(ids), dtype=np.int32), np.diff(begins))
    del rows, lists, coded
    a = np.bincount(which, labels[row], len(names))
    both = np.bincount(which, minlength=len(names)).astype(np.float64)
    gain = information_gain(a, both - a, n1, n0)
    evidence = gain * len(ids)
    weights = (np.log((len(ids) + 1) / (both + 1)) + 1) * gain * evidence / (evidence + prior)
    # Examples of like heaviest term share blocks, which tightens the blocks' bounds.
    vectors = [(which[a:b], counts[a:b]) for a, b in zip(begins, begins[1:], strict=False)]
    heaviest = [int(t[np.argmax((1 + np.log(n)) * weights[t])]) if len(t) else -1 for t, n in vectors]
    order = np.lexsort([ids, heaviest])
    empty = np.zeros(0, np.int32)
    model = ToxicityModel(names, weights, ids[order], labels[order], np.concatenate(([0], np.cumsum(np.diff(begins)[order]))), np.concatenate([*(vectors[i][0] for i in order), empty]), np.concatenate([*(vectors[i][1] for i in order), empty]), base)
    del vectors, which, counts, row
    pa.default_memory_pool().release_unused()
    sent = spark.sparkContext.broadcast(model)  # bounded by the sample
    own = spark.range(len(ids)).select(F.col("id").alias("row")).mapInArrow(_vote_rows(sent), "row long, vote double").toArrow()
    votes = np.empty(len(ids))
    votes[own["row"].to_numpy()] = own["vote"].to_numpy()
    sent.unpersist()
    x = np.array([*votes, base, base])
    y = np.array([*model.labels, 1, 0], float)
    each = {1: total[1] / n1, 0: total[0] / n0}
    w = np.array([*(each[int(c)] for c in model.labels), 1.0, 1.0])
    z = np.log(np.clip(x, 1e-6, 1 - 1e-6) / np.clip(1 - x, 1e-6, 1))
    model.slope, model.shift = _logistic(z, y, w)
    return model


def _score(sent: Broadcast, text_col: str, evidence: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = sent.value
        voter = pa.list_(pa.struct([("example", pa.int64()), ("similarity", pa.float64()), ("label", pa.int32())]))
        for batch in slices(batches, QUERIES):
            scores, voters = [], []
            for score, found in model.scores([t or "" for t in batch.column("row").field(text_col).to_pylist()]):
                scores.append(score)
                voters.append([{"example": int(model.ids[i]), "similarity": s, "label": int(model.labels[i])} for s, i in found[:evidence]])
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(scores, pa.float64()), pa.array([int(s >= 0.5) for s in scores], pa.int32()), pa.array(voters, voter)], names=["row", "score", "predicted", "evidence"])

    return run


def score_documents(docs: DataFrame, model: ToxicityModel, text_col: str = "text", evidence: int = 5) -> DataFrame:
    """Per row: row (the input row, as a struct), score, predicted, evidence. One pass, no shuffle; the model, bounded by its sample, is broadcast."""
    rows = docs.select(F.struct(*[F.col(f"`{c}`").cast("string").alias(c) if c == text_col else F.col(f"`{c}`") for c in docs.columns]).alias("row"))
    voter = T.ArrayType(T.StructType([T.StructField("example", T.LongType()), T.StructField("similarity", T.DoubleType()), T.StructField("label", T.IntegerType())]))
    added = [T.StructField("score", T.DoubleType()), T.StructField("predicted", T.IntegerType()), T.StructField("evidence", voter)]
    return rows.mapInArrow(_score(docs.sparkSession.sparkContext.broadcast(model), text_col, evidence), T.StructType([rows.schema["row"], *added]))
