"""Word n-grams, per text and over all texts."""

from __future__ import annotations

import random
from collections import Counter

import pytest

from corpusmill.operators import aggregate
from corpusmill.plans import queries


def grams(t, n):
    w = (t or "").split()
    return [" ".join(w[i : i + n]) for i in range(len(w) - n + 1)]


@pytest.fixture
def rows():
    rng = random.Random(3)
    texts = [" ".join(f"w{rng.randrange(30)}" for _ in range(rng.randrange(120))) for _ in range(60)]
    texts += ["", None, "one", " a b\x1cc　a b\n", "x " * 300, "\U0001f600 ß \U0001f600 ß"]
    return [(i if i % 9 else None if i % 2 else 4, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("n", [1, 2, 3])
def test_ngrams(spark, rows, n, monkeypatch):
    monkeypatch.setattr(aggregate, "FLUSH_GRAMS", 70)
    df = spark.createDataFrame(rows, "k long, t string")
    assert {r.gram: r.n for r in aggregate.global_ngrams(df, "t", n).collect()} == Counter(g for _, t in rows for g in grams(t, n))
    want = Counter((k, g) for k, t in rows for g in grams(t, n))
    got = [(r.k, r.gram, r.n) for r in aggregate.text_ngrams(df, "k", "t", n).collect()]
    assert len(got) == len(want) and {(k, g): c for k, g, c in got} == want
    monkeypatch.setattr(aggregate, "BROADCAST_ROWS", 0)
    assert sorted(map(str, aggregate.text_ngrams(df, "k", "t", n).collect())) == sorted(f"Row(k={k}, gram={g!r}, n={c})" for k, g, c in got)


def test_invalid_bytes_are_counted(spark):
    df = spark.sql("SELECT 1L AS k, CAST(X'61FF20622061FF2062' AS STRING) AS t")
    assert {r.gram: r.n for r in aggregate.global_ngrams(df, "t", 2).collect()} == {"a� b": 2, "b a�": 1}


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_grams_of_unique_keys_are_not_shuffled(spark, tmp_path):
    """g2 shuffled every (key, gram); now its one exchange holds a row per key and task."""
    spark.createDataFrame([(i, "a b a b c") for i in range(50)], "doc_id long, text string").repartition(3).write.parquet(str(tmp_path / "documents.parquet"))
    docs = spark.read.parquet(str(tmp_path / "documents.parquet"))
    assert "Exchange" not in plan(aggregate.text_ngrams(docs, "doc_id", "text", 2))
    out = queries.QUERIES["g2_text_ngrams"](spark, str(tmp_path))
    assert plan(out).count("Exchange hashpartitioning") == 1 and {tuple(r)[1:] for r in out.collect()} == {(3, 2)}


def test_grams_are_counted_before_the_shuffle(spark, tmp_path):
    """g1 made every occurrence a row by interpreted array functions; now texts of one task hand on each gram once per piece."""
    docs = spark.createDataFrame([("a b a b c",)] * 400, "text string").coalesce(1)
    text = plan(aggregate.global_ngrams(docs, "text", 2))
    assert "MapInArrow" in text and "Generate" not in text
