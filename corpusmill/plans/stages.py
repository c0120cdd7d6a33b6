"""The stages as plans: shard, filter, generate, distance and language-model statistics, analysis."""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence
from typing import Any

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import clean, distance, flags
from ..functions.text import as_text
from ..operators import conditions as cond
from ..operators import evaluate, models
from ..operators.joins import union_all
from ..operators.prompts import messages
from ..operators.rank import quantile
from ..sources.files import TurnLog


def build_dataset(rows: DataFrame, turns: int, make: Callable[[], models.Generator], model: str = "model", params: dict[str, Any] | None = None, max_failures: float = 0.25, log: TurnLog | None = None, persist: Callable[[DataFrame], DataFrame] = lambda df: df) -> DataFrame:
    """Runs prompts turn by turn: adds response_0.., final_response, generator_model, generation_params.

    A row takes part in a turn that its prompt has while no earlier response of it is empty. After
    each turn the share of failures is checked. With a log, rows found there are not sent again.
    `persist` should materialise a turn's rows, as a lazy plan would call the model again.
    """
    clash = {"original", "prompt", "final_response", "generator_model", "generation_params", *(f"response_{t}" for t in range(turns))} & set(rows.columns)
    if clash - {"original"}:
        raise ValueError(f"column names are taken: {sorted(clash)}")
    done: list[str] = []
    for t in range(turns):
        name = f"response_{t}"
        earlier = F.lit(True)
        for r in done:
            earlier = earlier & (F.col(r) != "")
        eligible = (F.size("chat_turns") > t) & earlier
        asked = rows.withColumn("_eligible", eligible).withColumn("_messages", messages(t, done))
        if log is None:
            made = models.generate(asked, "_messages", make, F.col("_eligible"), name)
        else:
            sent = models.generate(log.pending(asked.where("_eligible"), t), "_messages", make, F.lit(True), name)
            log.append(sent.select("row_id", F.col(name).alias("text"), F.col(f"{name}_error").alias("error"), F.lit(0).cast("long").alias("prompt_tokens"), F.lit(0).cast("long").alias("completion_tokens")), t)
            got = log.cached(t).select("row_id", F.col("text").alias(name), F.col("error").alias(f"{name}_error"))
            made = asked.join(got, "row_id", "left").withColumn(name, F.coalesce(name, F.lit("")))
        made = persist(made.drop("_messages"))
        tried, failed = made.agg(F.count(F.when(F.col("_eligible"), 1)), F.count(F.when(F.col("_eligible") & F.col(f"{name}_error").isNotNull(), 1))).first()
        if tried and failed / tried > max_failures:
            raise RuntimeError(f"turn {t}: {failed} of {tried} generations failed")
        rows = made.drop("_eligible", f"{name}_error")
        done.append(name)
    final = F.lit("")
    for t, r in enumerate(done):
        final = F.when(F.size("chat_turns") == t + 1, F.col(r)).otherwise(final)
    return rows.withColumns({"final_response": final, "generator_model": F.lit(model), "generation_params": F.lit(json.dumps(params or {}))})


def with_filter_metrics(df: DataFrame, source: str, response: str) -> DataFrame:
    """Deviations, subset flags and the slice of the source that a response names."""
    made = {}
    for unit, f in (("lines", distance.deviated_lines), ("words", distance.deviated_words), ("characters", distance.deviated_characters)):
        made[f"_{unit}"] = f(source, response)
    out = df.withColumns(made | {"_loose": flags.loose_subset(source, response)})
    cols: dict[str, Column] = {}
    for unit in ("lines", "words", "characters"):
        cols |= {f"deviated_{unit}": F.col(f"_{unit}.count"), f"deviated_{unit}_proportion": F.col(f"_{unit}.proportion")}
    cols |= {"is_loose_subset": F.col("_loose.found"), "collected_subset": F.col("_loose.slice"), "is_strict_subset": flags.is_strict_subset(source, response)}
    return out.withColumns(cols).drop("_lines", "_words", "_characters", "_loose")


def filter_stage(df: DataFrame, source: str, response: str, conditions: Sequence[tuple[str, str, Any]], mode: str = "AND", language: Callable[[], models.LanguageId] | None = models.StopwordLanguageId) -> tuple[DataFrame, DataFrame]:
    """(kept, trashed) of one shard; quantiles are taken over all its rows before any is dropped."""
    # Read by every quantile and by both outputs: kept on the executors' disks, made anew if one is lost.
    out = with_filter_metrics(df, source, response).persist(StorageLevel.DISK_ONLY)
    for unit in ("lines", "words", "characters"):
        out = quantile(out, f"deviated_{unit}_proportion", f"deviated_{unit}_proportion_quantile")
    foreign = None if language is None else models.non_english(F.col("collected_subset"), language)
    return cond.split_by_reason(out, cond.filter_reason(out, conditions, foreign, mode))


def generation_flags(df: DataFrame, original: str = "original", response: str = "final_response", instruction: str = "instruction") -> dict[str, Column]:
    return flags.rejection_reasons(original, response, instruction)


def generate_stage(df: DataFrame, original: str = "original", response: str = "final_response", turns: str = "chat_turns") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(kept, trashed, counts by reason) of generated rows, responses cleaned and last."""
    cleaned = df.withColumn("_clean", clean.clean_responses(response, original)).withColumn("_told", clean.instruction_text(F.col(turns)))
    cleaned = cleaned.drop(response).withColumnRenamed("_clean", response)
    named = {n: f"_flag{i}" for i, n in enumerate(flags.REASONS)}
    made = generation_flags(cleaned, original, response, "_told")
    marked = cleaned.withColumns({named[n]: c for n, c in made.items()})
    columns = {n: F.col(c) for n, c in named.items()}
    order = [c for c in cleaned.columns if c not in (response, "_told")] + [response]
    kept, trashed = cond.split_by_reason(marked, cond.joined_reasons(columns))
    return kept.select(*order), trashed.select(*order, "rejected_for"), cond.reason_counts(marked, columns)


def distance_stage(df: DataFrame, a: str = "original", b: str = "final_response", embedder: Callable[[], Any] | None = None, chunk: int = 100, row: str = "row_id") -> DataFrame:
    """Adds jaccard_1..3, levenshtein, and with an embedder cosdist, softngram, bertscore…, moverscore; what is there stays.

    Token weights are taken per `chunk` rows and side, by row id, or over all rows if chunk is 0.
    """
    out = cond.with_missing(df, {"jaccard_1": distance.jaccard(a, b, 1), "jaccard_2": distance.jaccard(a, b, 2), "jaccard_3": distance.jaccard(a, b, 3), "levenshtein": distance.edit_distance(a, b)})
    if embedder is None:
        return out
    from ..functions.vectors import bert_score, cosine_distance, idf_weights, soft_phrase_distance
    from ..operators.aggregate import idf

    have = set(out.columns)
    # Model outputs are read several times below: each model runs once, its columns stay on the executors' disks.
    ready = out.withColumns({"_fa": distance.phrases(a), "_fb": distance.phrases(b)}).persist(StorageLevel.DISK_ONLY)
    made = ready.withColumns(
        {"_va": models.embed(as_text(a), embedder), "_vb": models.embed(as_text(b), embedder), "_ta": models.embed_tokens(as_text(a), embedder), "_tb": models.embed_tokens(as_text(b), embedder), "_pa": models.embed_list(F.col("_fa"), embedder), "_pb": models.embed_list(F.col("_fb"), embedder)}
    ).persist(StorageLevel.DISK_ONLY)
    made = made.withColumn("_chunk", F.floor(F.col(row) / chunk) if chunk else F.lit(0))
    for side in ("a", "b"):
        per = idf(made.select("_chunk", F.col(f"_t{side}.tokens").alias("tokens")), "tokens", ["_chunk"])
        maps = per.groupBy("_chunk").agg(F.map_from_entries(F.collect_list(F.struct("token", "idf"))).alias(f"_idf{side}"))
        made = made.join(maps, "_chunk", "left").withColumn(f"_w{side}", idf_weights(f"_t{side}.tokens", F.coalesce(f"_idf{side}", F.create_map().cast("map<string,double>"))))
    made = made.withColumns({"_bert": bert_score("_ta.vectors", "_tb.vectors", F.col("_wa"), F.col("_wb")), "_mover": models.mover_distance(F.col("_ta.vectors"), F.col("_tb.vectors"), F.col("_wa"), F.col("_wb"))})
    new = {"cosdist": cosine_distance("_va", "_vb"), "softngram": soft_phrase_distance("_pa", "_pb"), "bertscore_precision": F.col("_bert.precision"), "bertscore_recall": F.col("_bert.recall"), "bertscore": F.col("_bert.f1"), "moverscore": F.col("_mover")}
    added = cond.with_missing(made, new, together=[("bertscore_precision", "bertscore_recall", "bertscore")])
    return added.select(*[c for c in added.columns if c in have or c in new])


def analysis_stage(df: DataFrame, classifiers: Sequence[dict[str, Any]], row: str = "row_id", subsets: dict[str, Column] | None = None) -> DataFrame:
    """Leaderboard rows (classifier, subset, n, auroc, TPR at each budget) of every classifier whose columns exist.

    A classifier: name, columns [(column, is_ai)], flip. Subsets: name to label column; Overall is added.
    """
    labels = df.select(row, F.explode(F.array(F.lit("Overall"), *[F.concat(F.lit(f"{n}: "), c) for n, c in (subsets or {}).items()])).alias("subset"))
    out = None
    for c in classifiers:
        sources = [(n, ai) for n, ai in c["columns"] if n in df.columns]
        if len(sources) < len(c["columns"]):
            continue
        scores = evaluate.long_scores(df, row, sources, c["name"])
        # Thresholds come from all rows of a classifier, each once; subsets only read them.
        points = evaluate.operating_points(scores, ["classifier"], c.get("flip", False)).groupBy("classifier").pivot("budget", list(evaluate.BUDGETS)).agg(F.first("threshold"))
        long = scores.join(labels.withColumnRenamed(row, "row_id"), "row_id")
        at = long.join(F.broadcast(points.select("classifier", *[F.col(b).alias(f"_{b}") for b in evaluate.BUDGETS])), "classifier")
        rates = at.groupBy("classifier", "subset").agg(*[evaluate.ratio(F.count(F.when(F.col("is_ai") & evaluate.called(F.col(f"_{b}"), c.get("flip", False)), 1)), F.count(F.when(F.col("is_ai"), 1))).alias(f"tpr_at_{b}") for b in evaluate.BUDGETS])
        part = evaluate.auroc(long, ["classifier", "subset"], c.get("flip", False)).join(rates, ["classifier", "subset"])
        out = part if out is None else union_all(out, part)
    if out is None:
        raise ValueError("no classifier has its columns")
    return out
