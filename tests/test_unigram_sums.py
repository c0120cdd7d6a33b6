"""Language-model sums from all words of the corpus."""

from __future__ import annotations

import random
import re
from collections import Counter

import pytest

from corpusmill.operators import aggregate, models
from corpusmill.plans import queries


def test_every_word_counts(spark, tmp_path):
    rng = random.Random(4)
    texts = [" ".join(f"w{rng.choice((rng.randrange(20), rng.randrange(9000)))}" for _ in range(rng.randrange(2, 300))) for _ in range(120)]
    texts += ["", None, "one", " two words ", texts[0], texts[0]]
    rows = [(i % 124, t) for i, t in enumerate(texts)]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(str(tmp_path / "documents.parquet"))
    counts = Counter(w for t in texts for w in (t or "").split())
    assert len(counts) > 4000
    model = models.UnigramScorer(dict(counts))
    want = []
    for (i, _), s in zip(rows, model.score(texts), strict=True):
        curve = (s["lp"] + s["entropy"]) / s["variance"] ** 0.5 if s["variance"] > 1e-6 else 0.0
        want.append((i, s["n"], s["lp"], curve))
    got = [tuple(r) for r in queries.QUERIES["l1_unigram_sums"](spark, str(tmp_path)).collect()]
    assert len(got) == len(want)
    for g, w in zip(sorted(got), sorted(want), strict=True):
        assert g[:2] == w[:2] and g[2:] == pytest.approx(w[2:], abs=2e-6)


@pytest.mark.parametrize("common", [0, 5, 100_000])
def test_texts_are_not_shuffled(spark, common, monkeypatch):
    """All words count, whichever are common; no exchange of the result holds a text, and only rare words are joined."""
    monkeypatch.setattr(aggregate, "COMMON_WORDS", common)
    rng = random.Random(6)
    long = "l" * 99
    texts = [" ".join(rng.choice([f"w{rng.randrange(12)}", f"r{rng.randrange(500)}", long]) for _ in range(rng.randrange(60))) for _ in range(50)] + [None, "", "one"]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    model = models.UnigramScorer(dict(Counter(w for t in texts for w in (t or "").split())))
    for hot in (4, 1000):
        out = aggregate.unigram_sums(df, "text", "s", hot=hot, keep=["doc_id"])
        assert out.columns == ["doc_id", "s"] and aggregate.unigram_sums(df.limit(3), "text", "s").columns == ["doc_id", "text", "s"]
        got = {r.doc_id: tuple(r.s) for r in out.collect()}
        assert len(got) == len(texts)
        for i, s in enumerate(model.score(texts)):
            assert got[i] == pytest.approx((s["n"], s["lp"], s["entropy"], s["variance"]), abs=1e-6)
        plan = out._jdf.queryExecution().optimizedPlan().toString()
        assert "text" not in [f for line in plan.splitlines() if "InMemoryRelation" in line and "_row" in line for f in re.findall(r"\w+(?=#)", line)]
