"""The pipeline on a small corpus with planted cases."""

from __future__ import annotations

import random

import pytest

pytest.importorskip("corpusmill.llm")
pipeline = pytest.importorskip("corpus_pipeline")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    rng = random.Random(23)
    word = lambda: "".join(rng.choice(("ka", "lo", "mi", "ran", "te", "vo", "du")) for _ in range(rng.randrange(2, 5)))
    text = lambda n: " ".join(word() for _ in range(n))
    item, passage = text(40), text(70)
    rows = [(i, text(120)) for i in range(300)]
    rows += [(400 + i, text(30) + " vile scummy wretch " + text(30)) for i in range(60)]
    w = rows[5][1].split()
    rows += [(500, rows[3][1]), (501, rows[3][1]), (502, " ".join([*w[:60], "changed", *w[61:]])), (503, text(50) + " " + item + " " + text(50)), (504, text(60) + " " + passage), (505, passage + " " + text(60)), (506, passage), (507, None), (508, "")]
    path = tmp_path_factory.mktemp("sf")
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame([(i, 1, int(400 <= i < 500)) for i, _ in rows[:350]], "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame([(0, item)], "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return str(path)


def test_stages(spark, folder):
    docs = spark.read.parquet(f"{folder}/documents.parquet")
    columns, seen = docs.columns, {}
    for i, (name, stage) in enumerate(pipeline.STAGES):
        docs = stage(spark, docs, folder)
        if i < 4:
            assert docs.columns == columns
        path = f"{folder}/out{i}"
        docs.write.parquet(path)
        docs = spark.read.parquet(path)
        seen[name] = {r["doc_id"]: r for r in docs.collect()}
    toxic, near, cut, clean, ids = seen.values()
    assert not [i for i in toxic if 400 <= i < 460] and len(toxic) == 309
    assert not {500, 501, 502} & set(near) and set(toxic) - set(near) == {500, 501, 502, 508} - {508}
    assert len(cut[505]["text"].split()) == 60 and cut[505]["n_chars"] == len(cut[505]["text"]) and 506 not in cut
    assert set(cut) - set(clean) == {503}
    assert set(ids) == set(clean) and all(r["n_tokens"] == len(r["ids"]) for r in ids.values())


def test_run_equals_the_stages(spark, folder):
    assert pipeline.run(spark, folder).count() == 304
    assert pipeline.ORACLE_SQL is None
