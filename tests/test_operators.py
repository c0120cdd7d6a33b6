from __future__ import annotations

import itertools
import json
import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from corpusmill.operators import aggregate, conditions, evaluate, joins, models, prompts, rank
from corpusmill.plans import stages
from corpusmill.sources import files, shards
from corpusmill.streaming import shards as streaming


def test_conditions(spark):
    df = spark.createDataFrame([(1, 0.1, True, "alpha", 1.0), (2, 0.5, False, "beta", None), (3, float("nan"), True, "7", 3.0)], "id int, score double, flag boolean, name string, maybe double")
    ids = lambda *c, mode="AND": [r.id for r in conditions.apply_conditions(df, list(c), mode).collect()]
    assert ids() == [1, 2, 3] and ids(("score", ">", 0.2)) == [2] and ids(("score", "!=", 0.5)) == [1, 3]
    assert ids(("flag", "==", True)) == ids(("flag", "==", 1)) == [1, 3] and ids(("name", "==", 7)) == [] and ids(("name", ">=", "7")) == [3]
    assert ids(("maybe", "!=", 1.0)) == [3] and ids(("gone", "!=", 1)) == [] and ids(("score", "~", 1)) == [] and ids(("score", ">", "x")) == []
    assert ids(("score", "<", 0.2), ("name", "==", "beta"), mode="or") == [1, 2]
    with pytest.raises(ValueError, match="filter type"):
        conditions.apply_conditions(df, [("score", ">", 0)], "XOR")
    kept, trashed = conditions.split_by_reason(df, conditions.joined_reasons({"a": F.col("id") > 1, "b": F.col("flag")}))
    assert kept.count() == 0 and [r.rejected_for for r in trashed.orderBy("id").collect()] == ["b", "a", "a, b"]
    with pytest.raises(KeyError):
        conditions.checked_select(df, ["id", "gone"])
    with pytest.raises(Exception, match="null in column maybe"):
        conditions.checked_select(df, ["id", "maybe", "id"]).collect()
    assert conditions.split_available(df, ["id", "x"]) == (["id"], ["x"]) and conditions.with_missing(df, {"id": F.lit(9), "n": F.lit(1)}).first().id == 1
    assert conditions.without_buckets([{"name": "A bucket"}, {"name": "B", "suffix": "_s"}]) == [{"name": "B", "suffix": "_s"}]


def test_ranks(spark):
    rng = random.Random(1)
    values = [rng.choice((1.0, 2.0, 2.5, rng.random())) for _ in range(300)]
    df = spark.createDataFrame(list(enumerate(values)), "id long, v double")
    got = {r.id: r.q for r in rank.quantile(df, "v", "q").collect()}
    for i, v in enumerate(values):
        below, same = sum(x < v for x in values), values.count(v)
        assert got[i] == pytest.approx((below + (same + 1) / 2) / len(values))
    assert [r.q for r in rank.quantile(df.limit(1), "v", "q").collect()] == [1.0] and rank.quantile(df.limit(0), "v", "q").count() == 0
    assert {r.m for r in rank.min_max(df.withColumn("v", F.lit(3.0)), "v", "m").collect()} == {0.0}
    pos = {r.id: r.p for r in rank.row_positions(df.withColumn("id", F.col("id") * 3), "id", "p").collect()}
    assert pos == {3 * i: i for i in range(300)}
    lists = spark.createDataFrame([(1, [3.0, 1.0]), (2, []), (3, [3.0, 2.0]), (4, None)], "id long, v array<double>")
    assert {r.id: r.q for r in rank.chunk_quantile(lists, "id", "v", "q").collect()} == {1: [0.875, 0.25], 2: [], 3: [0.875, 0.5], 4: None}
    assert {r.id: r.m for r in rank.chunk_min_max(lists, "v", "m").collect()} == {1: [1.0, 0.0], 2: [], 3: [1.0, 0.5], 4: None}
    dup = spark.createDataFrame([(1, "A  b", "x"), (2, "a b ", "x"), (3, "a b", "y"), (4, None, "y"), (5, "", "y")], "id long, t string, g string")
    assert [r.is_duplicate for r in rank.mark_duplicates(dup, "t", "id").orderBy("id").collect()] == [False, True, True, False, True]
    assert [r.is_duplicate for r in rank.mark_duplicates(dup, "t", "id", "g").orderBy("id").collect()] == [False, True, False, False, True]


def brute_points(s, y, flip, budget):
    cuts = [np.nextafter(min(s), -np.inf), *sorted(set(s))]
    out = []
    for t in cuts:
        hit = [(v <= t) if flip else (v > t) for v in s]
        tpr = sum(h and a for h, a in zip(hit, y, strict=True)) / max(1, sum(y))
        fpr = sum(h and not a for h, a in zip(hit, y, strict=True)) / max(1, len(y) - sum(y))
        if fpr <= budget:
            out.append((t, tpr, fpr))
    return out[-1] if flip else out[0]


@pytest.mark.parametrize("flip", [False, True])
def test_evaluation(spark, flip):
    rng = random.Random(5)
    y = [rng.random() < 0.4 for _ in range(400)]
    s = [round(rng.gauss(1.0 if a else 0.0, 1.0), 1) for a in y]
    df = spark.createDataFrame([("c", i, a, v, abs(v)) for i, (a, v) in enumerate(zip(y, s, strict=True))], "classifier string, row_id long, is_ai boolean, value double, d double")
    won = np.mean([(0.5 if a == b else float(a > b)) for a, b in itertools.product([v for v, t in zip(s, y, strict=True) if t], [v for v, t in zip(s, y, strict=True) if not t])])
    assert evaluate.auroc(df, ["classifier"], flip).first().auroc == pytest.approx(1 - won if flip else won)
    assert math.isnan(evaluate.auroc(df.where("is_ai"), ["classifier"]).first().auroc)
    for r in evaluate.operating_points(df, ["classifier"], flip).collect():
        assert (r.threshold, r.tpr, r.fpr) == pytest.approx(brute_points(s, y, flip, evaluate.BUDGETS[r.budget]))
    steps = {r.step: r for r in evaluate.sweep(df, ["classifier"], flip, 50).collect()}
    grid = np.linspace(min(s), max(s), 50)
    for i, t in enumerate(grid):
        hit = [(v <= t) if flip else (v > t) for v in s]
        assert steps[i].threshold == pytest.approx(t)
        if min(abs(v - t) for v in s) > 1e-9:
            assert steps[i].tpr == pytest.approx(sum(h and a for h, a in zip(hit, y, strict=True)) / sum(y))
    m = evaluate.classifier_metrics(df, ["classifier"], 0.5, flip).first()
    assert m.tp + m.fp + m.tn + m.fn == 400 and m.recall == pytest.approx(m.tp / (m.tp + m.fn)) and m.fnr == pytest.approx(1 - m.recall)
    kept = evaluate.tpr_by_min_distance(df.where("is_ai"), "d", {"t": 0.5}, flip, 20).orderBy("step").collect()
    assert kept[0].kept == sum(y) and kept[-1].kept >= 25 and all(a.kept >= b.kept for a, b in zip(kept, kept[1:], strict=False))
    rep = evaluate.report(df, ["classifier"], "is_ai", flip).collect()
    assert {r.n for r in rep} == {sum(y), 400 - sum(y)}
    h = evaluate.histogram(df, "is_ai", "value", 20).toPandas()
    assert h.groupby("series").density.sum().values * (max(s) - min(s)) / 20 == pytest.approx([1.0, 1.0])


def test_statistics(spark):
    rng = np.random.default_rng(3)
    x = rng.normal(size=60)
    z = 2 * x + rng.normal(size=60)
    rows = [(float(a), float(b), 1.0) for a, b in zip(x, z, strict=True)] + [(float("nan"), 5.0, 1.0), (None, 1.0, 1.0), (float("inf"), 2.0, 1.0)]
    df = spark.createDataFrame(rows, "x double, z double, c double")
    d = {r.statistic: r for r in aggregate.describe(df, ["x", "z"]).collect()}
    assert d["x"].n == 63 and d["x"].invalid == 3 and d["x"].std == pytest.approx(x.std()) and d["x"].median == pytest.approx(np.median(x))
    r = {(q.x, q.y): q.r for q in aggregate.correlations(df, ["x", "z", "c"]).collect()}
    assert r["x", "z"] == r["z", "x"] == pytest.approx(np.corrcoef(x, z)[0, 1]) and math.isnan(r["x", "c"]) and len(r) == 9
    assert aggregate.describe(df.limit(0), ["x"]).first().n == 0
    v = spark.createDataFrame([(1, [1.0, 0.0]), (2, [0.0, 1.0]), (3, [1.0, 0.0])], "id long, e array<double>")
    assert [q.s for q in aggregate.mean_similarity_to_others(v, "id", "e", "s").orderBy("id").collect()] == [0.5, 0.0, 0.5]
    assert [q.s for q in aggregate.mean_similarity_to(v, "e", v.limit(0), "e", "s").collect()] == [0.0] * 3


def test_joins(spark):
    rows = spark.range(5).withColumnRenamed("id", "row_id")
    table = prompts.prompt_table(spark, prompts.prompts_of([["p0"], ["p1"]]))
    assert [r.chat_turns[0] for r in joins.assign_prompts(rows, table, offset=1).orderBy("row_id").collect()] == ["p1", "p0", "p1", "p0", "p1"]
    got = spark.createDataFrame([(0, "a", None, 2), (0, "b", None, 1), (1, None, "bad", 1)], "row_id long, text string, error string, received int")
    out = {r.row_id: (r.text, r.error) for r in joins.scatter_results(rows, got).collect()}
    assert out == {0: ("b", None), 1: ("", "bad"), **{i: ("", "no result returned") for i in (2, 3, 4)}}
    assert joins.rejected(rows, rows.where("row_id < 2"), "row_id").count() == 3 and joins.union_all(rows, table).count() == 7


def test_prompt_builders(spark):
    rng = random.Random(42)
    items = [[str(i)] for i in range(5)]
    mine = list(items)
    rng.shuffle(mine)
    assert prompts.shuffled(items) == mine and prompts.split(items, 0.5) == (items[:2], items[2:])
    assert len(prompts.resize(items, 13)) == 13 and sorted(prompts.resize(items, 10)) == sorted(items * 2) and prompts.resize(items, 3, shuffle=False) == items[:3]
    assert all(1 <= len(c) <= 2 for c in prompts.partial_stack([items, items], 1, 2))
    df = spark.createDataFrame([(["a", "b"],)], "c array<string>")
    first = lambda c: df.select(c.alias("c")).first().c
    assert first(prompts.reformat(F.col("c"), "<{{TEXT}}>", True)) == ["<a>", "b"] and first(prompts.recursive_format(F.col("c"), "last")) == ["a", "b\n{{RESP_0}}"]
    table = prompts.with_example(prompts.with_metadata(prompts.prompt_table(spark, prompts.prompts_of([["<<lang>>: {{DOC}}"]] * 4)), "PROMPT_TYPE", "x"), "q", "a")
    r = table.first()
    assert r.metadata == {"PROMPT_TYPE": "x"} and r.examples == [["q", "a"]]
    cursor = prompts.PromptCursor(table)
    cursor.split_test(0.25)
    assert cursor.part("train").count() == 3 and cursor.part("test").first().prompt_pos == 0
    rows = spark.createDataFrame([(0, "see <<lang>>", "en"), (1, "y", None)], "row_id long, t string, lang string")
    filled = prompts.fill_prompts(cursor.take(rows, 2), "t", ["lang"])
    assert filled.where("row_id = 0").first().chat_turns == ["en: see <<lang>>"]
    with pytest.raises(Exception, match="null in column lang"):
        filled.collect()
    assert [p.chat_turns[-1] for p in prompts.final_variants(prompts.prompts_of(items), ["v"])] == [f"{i}\nv" for i in range(5)]


def test_shards_and_files(spark, tmp_path):
    base = str(tmp_path / "data")
    df = shards.round_robin(spark.range(10).withColumnRenamed("id", "row_id"), 3)
    shards.write_shards(df, base)
    shards.push_shard(spark.createDataFrame([(99,)], "row_id long"), base, 1, shards.TRASHED)
    assert sorted(r.row_id for r in shards.load_shard(spark, base, 1).collect()) == [1, 4, 7]
    shards.push_shard(spark.createDataFrame([(5,)], "row_id long"), base, 1)
    assert [r.row_id for r in shards.load_shard(spark, base, 1).collect()] == [5] and shards.load_all_shards(spark, base).count() == 8 and shards.load_all_shards(spark, base, None).count() == 9
    with pytest.raises(FileNotFoundError):
        shards.load_shard(spark, base, 7)
    plain = str(tmp_path / "plain")
    spark.range(3).write.parquet(plain)
    assert shards.load_shard(spark, plain, 0).count() == 3
    with pytest.raises(FileNotFoundError):
        shards.load_shard(spark, plain, 1)
    with pytest.raises(ValueError, match="length"):
        shards.table_from_columns(spark, {"a": [1], "b": []})
    p = [prompts.Prompt(["a"], True, [("q", "r")], {"k": "v"})]
    files.save_prompts(p, str(tmp_path / "p.json"))
    assert files.load_prompts([str(tmp_path / "p.json")] * 2) == p * 2
    for bad in ({}, [1], [{"chat_turns": []}]):
        (tmp_path / "bad.json").write_text(json.dumps(bad))
        with pytest.raises(ValueError, match="root|object|lacks"):
            files.load_prompts([str(tmp_path / "bad.json")])
    (tmp_path / "README.md").write_text("---\na: 1\n---\nold")
    assert files.update_readme(str(tmp_path), "README.md", "new").read_text() == "---\na: 1\n---\nnew"
    waits, calls = [], []
    act = lambda: calls.append(1) or (1 / 0 if len(calls) < 3 else "ok")
    assert files.with_retries(act, lambda e: isinstance(e, ZeroDivisionError), sleep=waits.append) == "ok" and waits == [15, 30]
    log = files.TurnLog(spark, str(tmp_path / "log"), "f1")
    rows = spark.range(4).withColumnRenamed("id", "row_id")
    log.append(rows.where("row_id < 2").selectExpr("row_id", "'t' AS text", "cast(null AS string) AS error", "1L AS prompt_tokens", "1L AS completion_tokens"), 0)
    assert sorted(r.row_id for r in log.pending(rows, 0).collect()) == [2, 3] and log.pending(rows, 1).count() == 4 and files.TurnLog(spark, log.path, "f2").pending(rows, 0).count() == 4
    state = files.BatchState(str(tmp_path / "s" / "b.json"))
    state.mark(0, job="x")
    assert files.BatchState.load(state.path).jobs == {"0": {"job": "x"}}


def test_stages(spark, tmp_path):
    body = " ".join(f"word{i}" for i in range(60))
    rows = spark.createDataFrame([(i, f"{body} {i}") for i in range(6)], "row_id long, original string")
    table = prompts.prompt_table(spark, prompts.prompts_of([["R: {{DOC}}"], ["S: {{DOC}}", "{{RESP_0}} more"]]))
    asked = prompts.fill_prompts(joins.assign_prompts(rows, table), "original")
    sent = []
    log = files.TurnLog(spark, str(tmp_path / "log"), "f")
    built = stages.build_dataset(asked, 2, models.EchoGenerator, log=log)
    got = {r.row_id: r.final_response for r in built.collect()}
    assert got[0] == f"R: {body} 0".upper() and got[1] == f"S: {body} 1 MORE".upper() and not sent
    assert log.pending(rows, 0).count() == 0 and log.pending(rows, 1).count() == 3
    kept, trashed, counts = stages.generate_stage(built)
    assert kept.count() == 6 and trashed.count() == 0 and kept.columns[-1] == "final_response" and {r.n for r in counts.collect()} == {0}
    with pytest.raises(RuntimeError, match="failed"):
        stages.build_dataset(asked, 1, lambda: models.EchoGenerator(lambda t: ""))
    out = stages.distance_stage(kept.select("row_id", "original", "final_response"), embedder=models.HashEmbedder)
    r = out.first()
    assert set(out.columns) >= {"jaccard_3", "levenshtein", "cosdist", "softngram", "bertscore", "moverscore"} and 0 <= r.jaccard_1 <= 1 and r.moverscore >= 0
    k, t = stages.filter_stage(spark.createDataFrame([(1, "The cat sat on the mat and it was good", "the CAT sat"), (2, "x y z", "q"), (3, "a b c d", "b c")], "row_id long, s string, r string"), "s", "r", [("is_loose_subset", "==", True)])
    assert [(x.row_id, x.collected_subset) for x in k.collect()] == [(1, "The cat sat")] and {x.row_id: x.rejected_for for x in t.collect()} == {2: "filter conditions", 3: "not English"}


def test_transport_against_permutations():
    rng = np.random.default_rng(0)
    for _ in range(50):
        n = int(rng.integers(1, 6))
        cost, w = rng.random((n, n)), np.full(n, 1 / n)
        assert models.transport_cost(w, w, cost) == pytest.approx(min(sum(cost[i, p[i]] for i in range(n)) / n for p in itertools.permutations(range(n))))
    # Uneven weights, split into equal small parts.
    cost = rng.random((3, 2))
    whole = np.repeat(np.repeat(cost, [1, 2, 3], 0), [2, 4], 1)
    want = min(sum(whole[i, p[i]] for i in range(6)) / 6 for p in itertools.permutations(range(6)))
    assert models.transport_cost(np.array([1, 2, 3]) / 6, np.array([2, 4]) / 6, cost) == pytest.approx(want)


def test_streaming(spark, tmp_path):
    source, out = str(tmp_path / "in"), str(tmp_path / "out")
    df = spark.createDataFrame([(1, "A b"), (2, "a  b"), (3, "c")], "row_id long, text string").withColumn("ts", F.timestamp_seconds("row_id"))
    df.write.parquet(source)
    new = streaming.new_rows(spark, source, df.schema)
    first = streaming.first_texts(new, "text", "ts", "1 hour")
    streaming.kept_rows(first, lambda d: d.withColumn("rejected_for", F.when(F.col("text") == "c", "short")), out, str(tmp_path / "c1")).awaitTermination()
    got = spark.read.parquet(out).collect()
    assert len(got) == 2 and {(r.kind, r.text.lower().split()[0]) for r in got} == {("kept", "a"), ("trashed", "c")}
    log = files.TurnLog(spark, str(tmp_path / "log"), "f")
    answer = lambda d: d.selectExpr("row_id", "upper(text) AS text", "cast(null AS string) AS error", "0L AS prompt_tokens", "0L AS completion_tokens")
    streaming.respond(new, log, answer, str(tmp_path / "c2")).awaitTermination()
    assert log.cached(0).count() == 3
