"""Exact medians without a task that gathers the values."""

from __future__ import annotations

import random
import statistics

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.operators import aggregate


def test_digits_keep_the_order():
    v = np.array([-1.5e308, -2.0, -1.0, -5e-324, -0.0, 0.0, 5e-324, 1.0, 1.0, 1.7e308])
    key, n, lo, hi = aggregate.digits_of(np.random.default_rng(1).permutation(v), 0)
    assert list(key) == sorted(set(key)) and n.sum() == len(v) and list(lo) == list(hi) == sorted(set(v))
    for shift in (52, 40, 4):
        key, n, lo, hi = aggregate.digits_of(v, shift)
        assert list(key) == sorted(set(key)) and n.sum() == len(v) and (lo <= hi).all() and (hi[:-1] < lo[1:]).all()
    assert [len(x) for x in aggregate.digits_of(np.empty(0), 52)] == [0] * 4


def test_medians(spark):
    rng = random.Random(2)
    sets = [
        [1.0],
        [2.0, 1.0],
        [1.0, 1.0 + 2**-52],
        [-0.0, 0.0],
        [-1e308, 1e308, 5e-324, -5e-324],
        [rng.choice([0.05, 0.06, 0.07]) for _ in range(300)],
        [rng.gauss(0, 1) * 10 ** rng.randrange(-200, 200) for _ in range(501)],
        [rng.uniform(900, 105000) for _ in range(500)],
        [3.0] * 250 + [4.0] * 250,
        [-7.25] * 400,
        [],
    ]
    bad = [None, float("nan"), float("inf"), -float("inf")]
    cols = [[*s, *bad, *[None] * (501 - len(s))] for s in sets]
    for c in cols:
        rng.shuffle(c)
    df = spark.createDataFrame(list(zip(*cols, strict=True)), ", ".join(f"c{i} double" for i in range(len(sets)))).repartition(5).cache()
    got = aggregate.medians(df, df.columns)
    want = [statistics.median(s) if s else None for s in sets]
    assert [g is None for g in got] == [w is None for w in want]
    old = df.agg(*[F.percentile(aggregate.finite(F.col(c)), 0.5).alias(c) for c in df.columns]).first()
    assert got == list(old)
    assert [g for g in got if g is not None] == pytest.approx([w for w in want if w is not None])
    assert aggregate.medians(df, ["c7", "c7"]) == [got[7]] * 2


def test_no_aggregate_holds_all_values(spark):
    """describe's only aggregation of rows into one task has a fixed size: percentile, which keeps every distinct value, is gone."""
    df = spark.range(1000).select(F.col("id").cast("int").alias("x"), (F.col("id") / 7).cast("decimal(12,4)").alias("y"))
    out = aggregate.describe(df, ["x", "y"])
    assert "percentile" not in out._jdf.queryExecution().executedPlan().toString()
    assert {r.statistic: r.median for r in out.collect()} == {"x": 499.5, "y": pytest.approx(499.5 / 7, abs=1e-4)}
