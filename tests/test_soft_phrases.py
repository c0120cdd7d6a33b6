"""Soft phrase distance over every phrase of 6 to 12 words."""

from __future__ import annotations

import random

import pytest

from corpusmill.operators import models
from corpusmill.plans import queries


def brute(a, b):
    def phrases(t):
        w = (t or "").split()
        return [" ".join(w[i : i + n]) for n in range(min(6, len(w)), min(12, len(w)) + 1) for i in range(len(w) - n + 1)] if w else []

    x, y = phrases(a), phrases(b)
    if not x or not y:
        return 1.0
    u, v = (models.HashEmbedder().embed(p) for p in (x, y))
    return 1 - sum(bool((u @ p >= 0.8).any()) for p in v) / len(v)


def test_shifted_copy_is_found(spark, tmp_path):
    rng = random.Random(8)
    word = lambda: f"w{rng.randrange(400)}"
    source = [word() for _ in range(60)]
    pairs = [(" ".join(source), " ".join([word(), word()] + source[3:40])), (" ".join(source), " ".join(source)), (" ".join(source), " ".join(word() for _ in range(30))), ("one two", "one two"), ("", "a b"), (None, None), ("a b c d e f g " * 3, "a b c d e f g " * 2)]
    rows = [(c, t, r, x) for c, (a, b) in enumerate(pairs) for t, r, x in ((0, "user", a), (1, "assistant", b))]
    spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").write.parquet(str(tmp_path / "conversations.parquet"))
    got = {r["row_id"] // 1000: r["d"] for r in queries.QUERIES["v8_soft_phrases"](spark, str(tmp_path)).collect()}
    assert got == {c: pytest.approx(brute(a, b), abs=2e-6) for c, (a, b) in enumerate(pairs)}
    assert got[0] < 0.35 and got[1] == 0


def test_phrases_equal_the_column(spark):
    from corpusmill.functions import distance

    texts = ["", None, "a", "a b c d e f", " a  b c d e f g\th ", "x " * 20]
    df = spark.createDataFrame([(t,) for t in texts], "t string").select("t", distance.phrases("t").alias("p"))
    assert all(r["p"] == models.phrases_of(r["t"]) for r in df.collect())


def test_no_phrase_is_built_or_embedded(spark, tmp_path, monkeypatch):
    """The embedder gives the vectors of all phrases from a text's words: the work is that of its words, not of its phrases' words."""
    rng = random.Random(9)
    model = models.HashEmbedder()
    texts = ["", "one", "a b a b a b", " ".join(rng.choice("abcdefgh") for _ in range(11)), " ".join(f"w{rng.randrange(40)}" for _ in range(300))]
    for t in texts:
        phrases = models.phrases_of(t)
        assert model.embed_spans(t.split(), 6, 12) == pytest.approx(model.embed(phrases).reshape(len(phrases), 32), abs=1e-12)
    monkeypatch.setattr(models.HashEmbedder, "MOST_WORDS", 20)
    model, asked = models.HashEmbedder(), []
    monkeypatch.setattr(models.HashEmbedder, "word", lambda self, w, f=models.HashEmbedder.word: asked.append(w) or f(self, w))
    monkeypatch.setattr(models.HashEmbedder, "embed", lambda *_: pytest.fail("phrases were embedded one by one"))
    pairs = [(a, b) for a in texts for b in texts]
    assert len(list(models.phrase_vectors(model, pairs))) == len(pairs)
    assert len(model.known) <= 20 + 40 and len(asked) <= 2 * sum(len(set(a.split())) + len(set(b.split())) for a, b in pairs)


def test_plain_embedders_give_the_same(spark):
    class Plain:
        def embed(self, texts):
            return models.HashEmbedder().embed(texts)

    rng = random.Random(10)
    source = [f"w{rng.randrange(30)}" for _ in range(50)]
    rows = [(" ".join(source), " ".join(source[5:30] + ["x"])), ("a b", "b a"), ("", "a"), (None, None), ("a b c " * 9, "c b a " * 9)]
    df = spark.createDataFrame(rows, "a string, b string")
    got = df.select(*[models.soft_phrase_distance(df.a, df.b, m).alias(k) for k, m in (("x", models.HashEmbedder), ("y", Plain))]).collect()
    assert [r.x for r in got] == pytest.approx([r.y for r in got], abs=1e-12)
