"""Exact top-k where many candidates have equal bounds."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.llm import topk


def tied(n=10_000, every=3, dim=8, seed=3):
    """n rows, each `every`-th of them the same vector."""
    x = np.random.default_rng(seed).integers(-300, 300, (n, dim))
    x[::every] = x[0]
    return np.arange(n), x


def brute(ids, x, q_id, q, k):
    scores = x @ q
    return [(int(ids[i]), int(scores[i])) for i in np.lexsort((ids, -scores)) if ids[i] != q_id][:k]


@pytest.mark.parametrize("every", [2, 3, 7])
def test_tied_bounds_in_one_batch(every):
    ids, x = tied(every=every)
    asked = np.array([0, every, 5 * every, 1])
    pivots = topk.choose_pivots(x[:500], 32)
    search = topk.Search(asked, x[asked], pivots, 10)
    search.add(ids, x, topk._distances(x.astype(float), pivots))
    found = search.result()
    for q in asked.tolist():
        assert [(v, s) for i, v, s in found if i == q] == brute(ids, x, q, x[q], 10)
    assert search.taken <= len(asked) * len(x)  # no row is evaluated twice


def test_top_k_of_equal_vectors(spark):
    ids, x = tied(n=2400, every=2)
    df = spark.createDataFrame([(int(i), [float(c) for c in v]) for i, v in zip(ids, x, strict=True)], "vec_id long, embedding array<double>").coalesce(1)
    got = topk.top_k(df, F.col("vec_id") == 0, scale=1).orderBy("rank").collect()
    assert [(r["vec_id"], r["score"]) for r in got] == brute(ids, x, 0, x[0], 10)
