"""Model-backed columns behind small interfaces, and deterministic stand-ins for tests.

Models run in Arrow batches, loaded once per worker. The stand-ins are clearly no real models: they
give fixed functions of the text, so that plans can be run and checked without any download.
The columns are marked as not deterministic, so that no plan copies a model call into expressions above it. Inputs should be stored columns: Spark does not pull a
Python function out of a plan if its argument holds a lambda that uses another lambda's variable.
"""

from __future__ import annotations

import math
import re
import zlib
from collections import Counter
from collections.abc import Callable, Iterator, Sequence
from typing import Protocol

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.lm import SUMS


class Embedder(Protocol):
    def embed(self, texts: Sequence[str]) -> np.ndarray: ...


class SpanEmbedder(Embedder, Protocol):
    """An embedder that can give the vectors of all phrases_of(" ".join(words)) without the phrases themselves, in their order."""

    def embed_spans(self, words: Sequence[str], shortest: int, longest: int) -> np.ndarray: ...


class TokenEmbedder(Protocol):
    def embed_tokens(self, texts: Sequence[str]) -> tuple[list[np.ndarray], list[list[str]]]: ...


class PairScorer(Protocol):
    def score(self, pairs: Sequence[tuple[str, str]]) -> Sequence[float]: ...


class Scorer(Protocol):
    def score(self, texts: Sequence[str]) -> list[dict[str, float]]: ...


class Generator(Protocol):
    def generate(self, conversations: Sequence[list[dict[str, str]]]) -> list[tuple[str, str | None]]: ...


class LanguageId(Protocol):
    def probability(self, text: str, language: str) -> float: ...


def _crc(text: str) -> int:
    return zlib.crc32(text.encode())


class HashEmbedder:
    """Stand-in: unit vectors of hashed words. embed_spans remembers the vectors of some MOST_WORDS words."""

    MOST_WORDS = 50_000

    def __init__(self, dim: int = 32):
        self.dim = dim
        self.known: dict[str, np.ndarray] = {}

    def word(self, word: str) -> np.ndarray:
        v = np.random.default_rng(_crc(word.lower())).standard_normal(self.dim)
        return v / np.linalg.norm(v)

    def embed(self, texts: Sequence[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dim))
        known: dict[str, np.ndarray] = {}
        for i, t in enumerate(texts):
            v = np.zeros(self.dim)
            for w in (t or "").split():
                if w not in known:
                    known[w] = self.word(w)
                v += known[w]
            size = np.linalg.norm(v)
            out[i] = v / size if size else 0.0
        return out

    def embed_spans(self, words: Sequence[str], shortest: int, longest: int) -> np.ndarray:
        if not words:
            return np.zeros((0, self.dim))
        if len(self.known) > self.MOST_WORDS:
            self.known.clear()
        for w in words:
            if w not in self.known:
                self.known[w] = self.word(w)
        each = np.array([self.known[w] for w in words])
        sums, out = each, []  # of n words each: a word more per round, added in the order of embed
        for n in range(1, min(len(words), longest) + 1):
            if n > 1:
                sums = sums[:-1] + each[n - 1 :]
            if n >= min(len(words), shortest):
                out.append(sums)
        made = np.concatenate(out)
        size = np.sqrt(np.einsum("ij,ij->i", made, made))[:, None]
        return np.divide(made, size, out=made, where=size > 0)

    def embed_tokens(self, texts: Sequence[str]) -> tuple[list[np.ndarray], list[list[str]]]:
        tokens = [(t or "").split() for t in texts]
        return [np.stack([self.word(w) for w in ws]) if ws else np.zeros((0, self.dim)) for ws in tokens], tokens


class UnigramScorer:
    """Exact sums of a unigram model with given counts: every position has the same distribution."""

    def __init__(self, counts: dict[str, int], nucleus: float = 0.9, k: int = 10, other: dict[str, int] | None = None):
        total = sum(counts.values()) + 1
        self.lp = {w: math.log(n / total) for w, n in counts.items()}
        self.unknown = math.log(1 / total)
        probs = np.array(sorted([*(n / total for n in counts.values()), 1 / total], reverse=True))
        logs = np.log(probs)
        self.entropy = float(-(probs * logs).sum())
        self.variance = max(0.0, float((probs * logs**2).sum() - self.entropy**2))
        at = int(np.searchsorted(np.cumsum(probs), nucleus))
        self.nucleus, self.kth = float(logs[min(at, len(logs) - 1)]), float(logs[min(k, len(logs)) - 1])
        other = other or counts
        all_other = sum(other.values()) + 1
        self.ce = -sum(n / all_other * self.lp.get(w, self.unknown) for w, n in other.items()) - self.unknown / all_other

    def score(self, texts: Sequence[str]) -> list[dict[str, float]]:
        out = []
        for t in texts:
            words = (t or "").split()
            n = max(0, len(words) - 1)
            lps = [self.lp.get(w, self.unknown) for w in words[1:]]
            out.append({"n": n, "lp": sum(lps), "entropy": n * self.entropy, "variance": n * self.variance, "topp": float(sum(x < self.nucleus - 1e-5 for x in lps)), "topk": float(sum(x < self.kth - 1e-5 for x in lps)), "ce": n * self.ce})
        return out


class StopwordLanguageId:
    """Stand-in: share of a text's function words that are the language's."""

    # Frequent function words.
    WORDS = {
        "en": frozenset("the of and to in is was for that it on as with are be this by at from his her not or an".split()),
        "de": frozenset("der die und das ist nicht ein eine den von zu mit sich auf dem im für als auch es an".split()),
        "fr": frozenset("le la les et des un une est que qui dans pour pas sur au avec du en ce il".split()),
        "es": frozenset("el la los de que y en un una es por con no para las del se lo al su".split()),
    }

    def probability(self, text: str, language: str) -> float:
        words = Counter(re.findall(r"[^\W\d_]+", text.lower()))
        hits = {k: sum(n for w, n in words.items() if w in v) for k, v in self.WORDS.items()}
        total = sum(hits.values())
        return hits.get(language, 0) / total if total else 0.0


class EchoGenerator:
    """Stand-in: answers with a fixed change of the last user message."""

    def __init__(self, change: Callable[[str], str] = str.upper):
        self.change = change

    def generate(self, conversations: Sequence[list[dict[str, str]]]) -> list[tuple[str, str | None]]:
        return [(self.change(c[-1]["content"]), None) if c else ("", "no messages") for c in conversations]


def embed(c: Column, make: Callable[[], Embedder]) -> Column:
    """Text vectors."""

    @F.pandas_udf(T.ArrayType(T.DoubleType()))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = make()
        for texts in batches:
            yield pd.Series(list(np.asarray(model.embed([t or "" for t in texts]), float)))

    return run.asNondeterministic()(c)


def embed_tokens(c: Column, make: Callable[[], TokenEmbedder]) -> Column:
    """struct(tokens, vectors) of each text."""
    kind = T.StructType([T.StructField("tokens", T.ArrayType(T.StringType())), T.StructField("vectors", T.ArrayType(T.ArrayType(T.DoubleType())))])

    @F.pandas_udf(kind)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = make()
        for texts in batches:
            vectors, tokens = model.embed_tokens([t or "" for t in texts])
            yield pd.DataFrame({"tokens": tokens, "vectors": [[list(map(float, v)) for v in m] for m in vectors]})

    return run.asNondeterministic()(c)


def embed_list(c: Column, make: Callable[[], Embedder]) -> Column:
    """Vectors of the texts in an array; a batch embeds each distinct text once."""

    @F.pandas_udf(T.ArrayType(T.ArrayType(T.DoubleType())))
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = make()
        for lists in batches:
            texts = list(dict.fromkeys(t for x in lists if x is not None for t in x))
            made = dict(zip(texts, np.asarray(model.embed(texts), float), strict=True)) if texts else {}
            yield pd.Series([None if x is None else [made[t].tolist() for t in x] for x in lists])

    return run.asNondeterministic()(c)


def phrases_of(text: str | None, shortest: int = 6, longest: int = 12) -> list[str]:
    """distance.phrases of one text."""
    w = (text or "").split()
    return [" ".join(w[i : i + n]) for n in range(min(len(w), shortest), min(len(w), longest) + 1) for i in range(len(w) - n + 1)] if w else []


def phrase_vectors(model: Embedder, pairs: Sequence[tuple[str | None, str | None]]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """Per pair: vectors of the phrases of both texts, and how often each of the second's occurs. A SpanEmbedder gives
    every occurrence its row; any other embeds each distinct phrase of the pairs once."""
    if hasattr(model, "embed_spans"):
        for pair in pairs:
            u, v = (model.embed_spans((t or "").split(), 6, 12) for t in pair)
            yield u, v, np.ones(len(v), int)
        return
    counted = [tuple(Counter(phrases_of(t)) for t in pair) for pair in pairs]
    index = {p: i for i, p in enumerate(dict.fromkeys(p for pair in counted for side in pair for p in side))}
    made = np.asarray(model.embed(list(index)), float) if index else np.zeros((0, 1))
    for source, edit in counted:
        u, v = (made[np.fromiter((index[p] for p in side), int, len(side))] for side in (source, edit))
        yield u, v, np.fromiter(edit.values(), int, len(edit))


def soft_phrase_distance(a: Column, b: Column, make: Callable[[], Embedder], threshold: float = 0.8, rows: int = 100, cells: int = 1 << 20) -> Column:
    """vectors.soft_phrase_distance over all phrases of two texts; `rows` pairs are embedded at once, products go in blocks of `cells`."""

    @F.pandas_udf(T.DoubleType())
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        model = make()
        for x, y in batches:
            out = []
            for at in range(0, len(x), rows):
                for u, v, n in phrase_vectors(model, list(zip(x.iloc[at : at + rows], y.iloc[at : at + rows], strict=True))):
                    if not len(u) or not len(v):
                        out.append(1.0)
                        continue
                    hit = np.zeros(len(v), bool)
                    step = max(1, cells // len(v))
                    for i in range(0, len(u), step):
                        hit |= (u[i : i + step] @ v.T >= threshold).any(0)
                    out.append(1 - int(n[hit].sum()) / int(n.sum()))
            yield pd.Series(out, dtype=float)

    return run.asNondeterministic()(a, b)


def pair_distance(a: Column, b: Column, make: Callable[[], PairScorer], as_distance: bool = True) -> Column:
    """Cross-encoder scores of text pairs, negated as a distance."""

    @F.pandas_udf(T.DoubleType())
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        model = make()
        for x, y in batches:
            scores = np.asarray(model.score(list(zip(x.fillna(""), y.fillna(""), strict=True))), float)
            yield pd.Series(-scores if as_distance else scores)

    return run.asNondeterministic()(a, b)


def score_texts(c: Column, make: Callable[[], Scorer]) -> Column:
    """Per-text language-model sums; longest texts of a batch first, as batched models want them."""
    kind = T._parse_datatype_string(SUMS)

    @F.pandas_udf(kind)
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        model = make()
        for texts in batches:
            order = np.argsort(-texts.fillna("").str.len().to_numpy(), kind="stable")
            made = model.score([texts.iloc[i] or "" for i in order])
            out = pd.DataFrame(made, index=order).sort_index()
            yield out.astype({k: float for k in out.columns if k != "n"}).astype({"n": "int64"})

    return run.asNondeterministic()(c)


def non_english(c: Column, make: Callable[[], LanguageId] = StopwordLanguageId, threshold: float = 0.95) -> Column:
    """True unless the model gives English at least `threshold`; blank texts are true."""

    @F.pandas_udf(T.BooleanType())
    def run(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = make()
        for texts in batches:
            yield pd.Series([not (t and t.strip() and model.probability(t, "en") >= threshold) for t in texts])

    return run.asNondeterministic()(c)


def transport_cost(a: np.ndarray, b: np.ndarray, cost: np.ndarray) -> float:
    """Exact earth mover's distance: successive shortest paths with potentials."""
    n, m = cost.shape
    left, need = a.astype(float).copy(), b.astype(float).copy()
    flow = np.zeros((n, m))
    u, v = np.zeros(n), np.zeros(m)
    total, eps = 0.0, 1e-12
    while left.max(initial=0) > eps and need.max(initial=0) > eps:
        dist_r = np.where(left > eps, 0.0, np.inf)
        dist_c = np.full(m, np.inf)
        from_r, from_c = np.full(n, -1), np.full(m, -1)
        done_r, done_c = np.zeros(n, bool), np.zeros(m, bool)
        end = -1
        while True:
            i = int(np.where(done_r, np.inf, dist_r).argmin())
            j = int(np.where(done_c, np.inf, dist_c).argmin())
            di, dj = (np.inf if done_r[i] else dist_r[i]), (np.inf if done_c[j] else dist_c[j])
            if min(di, dj) == np.inf:
                break
            if dj <= di:
                done_c[j] = True
                if need[j] > eps:
                    end = j
                    break
                back = flow[:, j] > eps
                step = dj + np.maximum(-(cost[:, j] - u - v[j]), 0)
                better = back & ~done_r & (step < dist_r)
                dist_r[better], from_r[better] = step[better], j
            else:
                done_r[i] = True
                step = di + np.maximum(cost[i] - u[i] - v, 0)
                better = ~done_c & (step < dist_c)
                dist_c[better], from_c[better] = step[better], i
        if end < 0:
            break
        reach = dist_c[end]
        u -= np.where(done_r, reach - dist_r, 0) * -1
        v -= np.where(done_c, reach - dist_c, 0)
        path, j = [], end
        while True:
            i = int(from_c[j])
            path.append((i, j))
            if from_r[i] < 0:
                break
            path.append((i, -int(from_r[i]) - 1))
            j = int(from_r[i])
        start = path[-1][0]
        amount = min(left[start], need[end], *(flow[i, -j - 1] for i, j in path if j < 0)) if any(j < 0 for _, j in path) else min(left[start], need[end])
        for i, j in path:
            if j >= 0:
                flow[i, j] += amount
                total += amount * cost[i, j]
            else:
                flow[i, -j - 1] -= amount
                total -= amount * cost[i, -j - 1]
        left[start] -= amount
        need[end] -= amount
    return float(total)


def mover_distance(source: Column, edit: Column, source_weights: Column | None = None, edit_weights: Column | None = None) -> Column:
    """Earth mover's distance of two token matrices with cost sqrt(2 - 2 cos); equal weights if none are given; an empty side: 1."""

    def one(x, y, wx, wy) -> float:
        if x is None or y is None or not len(x) or not len(y):
            return 1.0
        a, b = np.array([np.asarray(r, float) for r in x]), np.array([np.asarray(r, float) for r in y])
        p = np.full(len(a), 1 / len(a)) if wx is None else np.asarray(wx, float)
        q = np.full(len(b), 1 / len(b)) if wy is None else np.asarray(wy, float)
        return transport_cost(p, q, np.sqrt(np.maximum(2 - 2 * (a @ b.T), 0)))

    if source_weights is None or edit_weights is None:

        @F.pandas_udf(T.DoubleType())
        def plain(x: pd.Series, y: pd.Series) -> pd.Series:
            return pd.Series([one(a, b, None, None) for a, b in zip(x, y, strict=True)])

        return plain.asNondeterministic()(source, edit)

    @F.pandas_udf(T.DoubleType())
    def weighted(x: pd.Series, y: pd.Series, p: pd.Series, q: pd.Series) -> pd.Series:
        return pd.Series([one(*row) for row in zip(x, y, p, q, strict=True)])

    return weighted.asNondeterministic()(source, edit, source_weights, edit_weights)


def generate(df: DataFrame, messages: str, make: Callable[[], Generator], eligible: Column, out: str) -> DataFrame:
    """Adds `out` (text, empty where not eligible or failed) and `{out}_error`, in Arrow batches."""
    kind = T.StructType([T.StructField("text", T.StringType()), T.StructField("error", T.StringType())])

    @F.pandas_udf(kind)
    def run(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        model = make()
        for talks, ok in batches:
            rows = [i for i, x in enumerate(ok) if x]
            text, error = [""] * len(ok), [None] * len(ok)
            talk = [[dict(m) if isinstance(m, dict) else {"role": m["role"], "content": m["content"]} for m in talks.iloc[i]] for i in rows]
            for i, (t, e) in zip(rows, model.generate(talk), strict=True):
                failed = e or not (t or "").strip()
                text[i], error[i] = ("" if failed else t), (e or "empty response") if failed else None
            yield pd.DataFrame({"text": text, "error": error})

    made = df.withColumn("_g", run.asNondeterministic()(F.col(messages), eligible))
    return made.withColumn(out, F.col("_g.text")).withColumn(f"{out}_error", F.col("_g.error")).drop("_g")
