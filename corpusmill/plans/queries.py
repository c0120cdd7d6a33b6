"""Registered queries of the corpus and evaluation operators over the driver tables, with their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import buckets, clean, distance, flags, lm, vectors
from ..functions.text import transliterate, words
from ..operators import aggregate, conditions, evaluate, joins, models, prompts, rank
from ..sources import shards
from . import stages

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def r6(c: Column | str) -> Column:
    return F.round(F.col(c) if isinstance(c, str) else c, 6)


def quoted(pattern: str) -> str:
    return "'" + pattern.replace("'", "''") + "'"


# Pairs of texts: a user turn and the assistant turn after it; documents and a fixed change of each.
CONV_SQL = """(SELECT conv_id * 1000 + turn AS row_id, text AS original, next_text AS final_response FROM (
    SELECT *, lead(text) OVER (PARTITION BY conv_id ORDER BY turn) AS next_text, lead(role) OVER (PARTITION BY conv_id ORDER BY turn) AS next_role FROM conversations)
    WHERE role = 'user' AND next_role = 'assistant')"""
INSTRUCTION = "'Rewrite the following text in plain words and keep every fact that it states:' || chr(10) || 'short line'"
CHANGED = f"""CASE doc_id % 12
    WHEN 0 THEN text
    WHEN 1 THEN 'Sure, here is the text:' || chr(10) || text
    WHEN 2 THEN 'I cannot assist with this request. ' || text
    WHEN 3 THEN text || ' [insert name here]'
    WHEN 4 THEN 'The original text says: ' || text
    WHEN 5 THEN translate(text, 'aeiou', 'AEIOU')
    WHEN 6 THEN {INSTRUCTION} || chr(10) || text
    WHEN 7 THEN 'lorem ipsum ' || text
    WHEN 8 THEN substr(text, 1, 30)
    WHEN 9 THEN 'thinking about it </think> ' || text
    WHEN 10 THEN '# Title' || chr(10) || '**' || text || '** [a](b) `code`'
    ELSE replace(text, ' ', '  ') || chr(10) || chr(10) || 'end' END"""
CHANGED_SQL = f"(SELECT doc_id AS row_id, text AS original, {CHANGED} AS final_response, {INSTRUCTION} AS instruction FROM documents)"
WORDS = lambda c: rf"list_filter(string_split_regex({c}, '\s+'), lambda w: w <> '')"
ASCII = lambda c: f"replace(strip_accents({c}), 'ß', 'ss')"


def conv_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    from pyspark.sql import Window

    w = Window.partitionBy("conv_id").orderBy("turn")
    turns = read(spark, sf_dir, "conversations").select("*", F.lead("text").over(w).alias("next_text"), F.lead("role").over(w).alias("next_role"))
    return turns.where("role = 'user' AND next_role = 'assistant'").select((F.col("conv_id") * 1000 + F.col("turn")).alias("row_id"), F.col("text").alias("original"), F.col("next_text").alias("final_response"))


def changed_pairs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read(spark, sf_dir, "documents").selectExpr("doc_id AS row_id", "text AS original", f"{CHANGED} AS final_response", f"{INSTRUCTION} AS instruction")


# Scores of documents with labels: a text statistic each, toxic documents standing for the AI side.
SCORES_SQL = """(SELECT d.doc_id AS row_id, d.lang, d.source, l.toxic = 1 AS is_ai, CAST(d.n_chars % 997 AS DOUBLE) / 7 AS value, CAST(d.n_chars % 101 AS DOUBLE) / 100 AS distance FROM documents d JOIN labels l ON l.doc_id = d.doc_id)"""


def scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    d, lab = read(spark, sf_dir, "documents"), read(spark, sf_dir, "labels")
    return d.join(lab, "doc_id").select(F.col("doc_id").alias("row_id"), "lang", "source", (F.col("toxic") == 1).alias("is_ai"), ((F.col("n_chars") % 997).cast("double") / 7).alias("value"), ((F.col("n_chars") % 101).cast("double") / 100).alias("distance"))


# Sources, shards, limits


@query("SELECT CAST(doc_id % 7 AS INTEGER) AS shard, count(*) AS n, min(doc_id) AS lo, max(doc_id) AS hi, CAST(sum(n_chars) AS BIGINT) AS chars FROM documents GROUP BY 1")
def a7_round_robin_shards(spark, sf_dir):
    dealt = shards.round_robin(read(spark, sf_dir, "documents"), 7, "doc_id")
    return dealt.groupBy("shard").agg(F.count(F.lit(1)).alias("n"), F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"), F.sum("n_chars").alias("chars"))


@query("SELECT doc_id, lang FROM documents ORDER BY doc_id LIMIT 100")
def a6_first_rows(spark, sf_dir):
    return shards.read_capped(spark, f"{sf_dir}/documents.parquet", 100, "doc_id").select("doc_id", "lang")


@query("SELECT event_id, row_number() OVER (ORDER BY event_id) - 1 AS row_index FROM events")
def w8_row_index(spark, sf_dir):
    return rank.row_positions(read(spark, sf_dir, "events").select("event_id"), "event_id")


# Conditions and splits


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity >= 30 AND l_discount < 0.05 AND l_returnflag = 'N'")
def b1_conditions_and(spark, sf_dir):
    df = read(spark, sf_dir, "lineitem")
    return conditions.apply_conditions(df, [("l_quantity", ">=", 30), ("l_discount", "<", "0.05"), ("l_returnflag", "==", "N")]).select("l_orderkey", "l_linenumber")


@query("SELECT l_orderkey, l_linenumber FROM lineitem WHERE l_quantity = 50 OR l_tax > 0.07 OR l_linestatus <> l_linestatus")
def b1_conditions_or(spark, sf_dir):
    df = read(spark, sf_dir, "lineitem")
    return conditions.apply_conditions(df, [("l_quantity", "==", 50), ("l_tax", ">", 0.07), ("no_such_column", "==", 1), ("l_linestatus", "~", "x")], "or").select("l_orderkey", "l_linenumber")


@query(f"SELECT doc_id FROM documents WHERE len({WORDS('text')}) <= 300 ORDER BY doc_id LIMIT 50")
def b2_length_filter_cap(spark, sf_dir):
    return conditions.first_fitting(read(spark, sf_dir, "documents"), "doc_id", "text", 300, 50).select("doc_id")


@query("""SELECT coalesce(rejected_for, 'kept') AS rejected_for, count(*) AS n FROM (
    SELECT CASE WHEN NOT (n_chars > 500 AND lang <> 'de') THEN 'filter conditions' WHEN lang <> 'en' THEN 'not English' END AS rejected_for FROM documents) GROUP BY 1""")
def b4_kept_and_trashed(spark, sf_dir):
    df = read(spark, sf_dir, "documents")
    kept, trashed = conditions.split_by_reason(df, conditions.filter_reason(df, [("n_chars", ">", 500), ("lang", "!=", "de")], F.col("lang") != "en"))
    return joins.union_all(kept.withColumn("rejected_for", F.lit("kept")), trashed).groupBy("rejected_for").agg(F.count(F.lit(1)).alias("n"))


def _jaccard_sql(a: str, b: str, n: int) -> str:
    grams = lambda c: WORDS(c) if n == 1 else f"list_transform(generate_series(1, len({WORDS(c)}) - {n - 1}), lambda i: array_to_string(list_slice({WORDS(c)}, i, i + {n - 1}), ' '))"
    return f"list_distinct({grams(a)}), list_distinct({grams(b)})"


def _jaccard_cte(source: str, n: int) -> str:
    """(row_id, d): Jaccard distance by relational set operations."""
    g = lambda c: f"(SELECT DISTINCT row_id, array_to_string(list_slice(w, i, i + {n - 1}), ' ') AS g FROM (SELECT row_id, w, unnest(generate_series(1, len(w) - {n - 1})) AS i FROM (SELECT row_id, {WORDS(c)} AS w FROM {source}) WHERE len(w) >= {n}))"
    return f"""(SELECT p.row_id, CASE WHEN coalesce(a.n, 0) = 0 AND coalesce(b.n, 0) = 0 THEN CASE WHEN trim(original, ' ' || chr(10)) = trim(final_response, ' ' || chr(10)) THEN 0.0 ELSE 1.0 END
        WHEN coalesce(a.n, 0) = 0 OR coalesce(b.n, 0) = 0 THEN 1.0 ELSE 1.0 - coalesce(c.n, 0)::DOUBLE / (a.n + b.n - coalesce(c.n, 0)) END AS d
        FROM {source} AS p
        LEFT JOIN (SELECT row_id, count(*) AS n FROM {g('original')} GROUP BY 1) a ON a.row_id = p.row_id
        LEFT JOIN (SELECT row_id, count(*) AS n FROM {g('final_response')} GROUP BY 1) b ON b.row_id = p.row_id
        LEFT JOIN (SELECT x.row_id, count(*) AS n FROM {g('original')} x JOIN {g('final_response')} y ON x.row_id = y.row_id AND x.g = y.g GROUP BY 1) c ON c.row_id = p.row_id)"""


REASON_SQL = {
    "empty or too short": r"len(trim(final_response, ' ' || chr(10))) < 50",
    "refusal": f"regexp_matches(final_response, {quoted(flags.REFUSAL)})",
    "filler output": f"(regexp_matches(final_response, {quoted(flags.FILLER)}) AND NOT regexp_matches(original, {quoted(flags.FILLER)}))",
    "unfilled placeholder": f"(regexp_matches(final_response, {quoted(flags.PLACEHOLDER)}) AND NOT regexp_matches(original, {quoted(flags.PLACEHOLDER)}))",
    "task meta-commentary": f"(regexp_matches(final_response, {quoted(flags.META_COMMENTARY)}) AND NOT regexp_matches(original, {quoted(flags.META_COMMENTARY)}))",
    "echoed instruction": "contains(final_response, string_split(instruction, chr(10))[1])",
    "near-verbatim source": "(j1.d <= 0.025 AND j2.d <= 0.05)",
    "identical to source": "final_response = original",
}
FLAGGED_SQL = f"""(SELECT p.row_id, {', '.join(f'{v} AS f{i}' for i, v in enumerate(REASON_SQL.values()))}
    FROM {CHANGED_SQL} AS p JOIN {_jaccard_cte(CHANGED_SQL, 1)} AS j1 ON j1.row_id = p.row_id JOIN {_jaccard_cte(CHANGED_SQL, 2)} AS j2 ON j2.row_id = p.row_id)"""


@query("SELECT row_id, coalesce(nullif(array_to_string(list_filter([" + ", ".join(f"CASE WHEN f{i} THEN '{n}' END" for i, n in enumerate(REASON_SQL)) + f"], lambda x: x IS NOT NULL), ', '), ''), 'kept') AS rejected_for FROM {FLAGGED_SQL}")
def b5_rejection_reasons(spark, sf_dir):
    df = changed_pairs(spark, sf_dir)
    return df.select("row_id", F.coalesce(conditions.joined_reasons(stages.generation_flags(df)), F.lit("kept")).alias("rejected_for"))


@query("SELECT * FROM (" + " UNION ALL ".join(f"SELECT '{n}' AS reason, CAST(sum(f{i}::INTEGER) AS BIGINT) AS n FROM {FLAGGED_SQL}" for i, n in enumerate(REASON_SQL)) + ")")
def b7_reason_counts(spark, sf_dir):
    df = changed_pairs(spark, sf_dir)
    return conditions.reason_counts(df, stages.generation_flags(df))


@query(r"SELECT doc_id FROM documents WHERE n_chars % 2 = 0 AND len(regexp_extract_all(text, '[\p{L}\p{N}_]+')) >= 100")
def b10_training_rows(spark, sf_dir):
    df = read(spark, sf_dir, "documents").withColumn("score", F.when(F.col("n_chars") % 2 == 0, 1.0))
    return conditions.keep_for_training(df, "score", "text", 100).select("doc_id")


@query("SELECT coalesce(lang, 'Unknown') AS label, count(*) AS n FROM documents GROUP BY 1")
def b13_dimension(spark, sf_dir):
    df = read(spark, sf_dir, "documents")
    label, _ = conditions.dimension(df, "LANGUAGE", ("Lang",))
    return df.groupBy(label.alias("label")).agg(F.count(F.lit(1)).alias("n"))


@query("""SELECT label, count(*) AS n FROM (SELECT CASE WHEN source IS NULL OR source = '' THEN 'Unknown' ELSE 'm-' || source END || ' (Temp: ' || CASE WHEN doc_id % 3 = 0 THEN 'Unknown' ELSE CAST(doc_id % 3 AS VARCHAR) || '.5' END || ')' AS label FROM documents) GROUP BY 1""")
def m1_model_label(spark, sf_dir):
    df = read(spark, sf_dir, "documents").select(F.concat(F.lit("org/m-"), "source").alias("generator_model"), F.when(F.col("doc_id") % 3 == 0, F.lit("{}")).otherwise(F.concat(F.lit('{"temperature": '), F.col("doc_id") % 3, F.lit('.5, "x": {"y": 1}}'))).alias("generation_params"))
    return df.groupBy(conditions.model_label(df).alias("label")).agg(F.count(F.lit(1)).alias("n"))


# Joins


@query("SELECT d.doc_id, b.item_id FROM documents d JOIN (SELECT item_id, row_number() OVER (ORDER BY item_id) - 1 AS pos FROM benchmark) b ON b.pos = (d.doc_id + 5) % (SELECT count(*) FROM benchmark)")
def j2_prompt_assignment(spark, sf_dir):
    items = rank.row_positions(read(spark, sf_dir, "benchmark").select("item_id"), "item_id", "prompt_pos")
    return joins.assign_prompts(read(spark, sf_dir, "documents").select("doc_id"), items, "doc_id", 5).select("doc_id", "item_id")


@query("SELECT doc_id FROM documents WHERE doc_id NOT IN (SELECT doc_id FROM labels)")
def j3_pending_rows(spark, sf_dir):
    return joins.pending(read(spark, sf_dir, "documents").select("doc_id"), read(spark, sf_dir, "labels"), "doc_id")


@query("""SELECT d.doc_id AS row_id, coalesce(q.text, '') AS text, CASE WHEN q.text IS NULL THEN 'no result returned' END AS error FROM documents d LEFT JOIN (
    SELECT o_custkey AS row_id, o_orderpriority AS text FROM (SELECT *, row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderkey) AS r FROM orders) WHERE r = 1) q ON q.row_id = d.doc_id""")
def j5_scatter_results(spark, sf_dir):
    rows = read(spark, sf_dir, "documents").select(F.col("doc_id").alias("row_id"))
    got = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("row_id"), F.col("o_orderpriority").alias("text"), F.lit(None).cast("string").alias("error"), F.col("o_orderkey").alias("received"))
    return joins.scatter_results(rows, got)


@query("SELECT event_type, count(*) AS n FROM events WHERE event_id NOT IN (SELECT event_id FROM events WHERE value > 50) GROUP BY 1")
def j4_rejected_rows(spark, sf_dir):
    e = read(spark, sf_dir, "events")
    return joins.rejected(e, e.where("value > 50"), "event_id").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


IDF_SQL = f"""(SELECT token, ln(((SELECT count(*) FROM documents) + 1)::DOUBLE / (count(*) + 1)) AS idf FROM (SELECT DISTINCT doc_id, unnest({WORDS('text')}) AS token FROM documents) GROUP BY token)"""


@query(f"SELECT token, round(idf, 6) AS idf FROM {IDF_SQL}")
def g13_idf(spark, sf_dir):
    return aggregate.idf(read(spark, sf_dir, "documents").select(words("text").alias("tokens")), "tokens").select("token", r6("idf").alias("idf"))


@query(f"SELECT item_id, round(sum(coalesce(idf, 0)), 6) AS weight, count(*) AS n FROM (SELECT item_id, unnest({WORDS('text')}) AS token FROM benchmark) t LEFT JOIN {IDF_SQL} i ON i.token = t.token GROUP BY 1")
def j7_token_weights(spark, sf_dir):
    table = aggregate.idf(read(spark, sf_dir, "documents").select(words("text").alias("tokens")), "tokens")
    tokens = read(spark, sf_dir, "benchmark").select("item_id", F.explode(words("text")).alias("token"))
    return joins.token_weights(tokens, table).groupBy("item_id").agg(r6(F.sum("idf")).alias("weight"), F.count(F.lit(1)).alias("n"))


# Aggregations


GRAM2_SQL = f"(SELECT doc_id, array_to_string(list_slice(w, i, i + 1), ' ') AS gram FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 1)) AS i FROM (SELECT doc_id, {WORDS('text')} AS w FROM documents) WHERE len(w) >= 2))"


@query(f"SELECT gram, count(*) AS n FROM {GRAM2_SQL} GROUP BY 1")
def g1_global_ngrams(spark, sf_dir):
    return aggregate.global_ngrams(read(spark, sf_dir, "documents"), "text", 2)


@query(f"SELECT doc_id, count(*) AS grams, max(n) AS most FROM (SELECT doc_id, gram, count(*) AS n FROM {GRAM2_SQL} GROUP BY 1, 2) GROUP BY 1")
def g2_text_ngrams(spark, sf_dir):
    return aggregate.text_ngrams(read(spark, sf_dir, "documents"), "doc_id", "text", 2).groupBy("doc_id").agg(F.count(F.lit(1)).alias("grams"), F.max("n").alias("most"))


STATS_SQL = "(SELECT CAST(l_quantity AS DOUBLE) AS quantity, CAST(l_extendedprice AS DOUBLE) AS price, CASE WHEN l_linenumber = 3 THEN 'NaN'::DOUBLE ELSE CAST(l_discount AS DOUBLE) END AS discount, CASE WHEN l_linenumber = 5 THEN NULL ELSE CAST(l_tax AS DOUBLE) END AS tax FROM lineitem)"


def _stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    d = read(spark, sf_dir, "lineitem")
    return d.select(F.col("l_quantity").cast("double").alias("quantity"), F.col("l_extendedprice").cast("double").alias("price"), F.when(F.col("l_linenumber") == 3, F.lit(float("nan"))).otherwise(F.col("l_discount").cast("double")).alias("discount"), F.when(F.col("l_linenumber") != 5, F.col("l_tax").cast("double")).alias("tax"))


@query(" UNION ALL ".join(f"SELECT '{c}' AS statistic, count(*) AS n, round(avg(v), 6) AS mean, round(median(v), 6) AS median, round(stddev_pop(v), 6) AS std, round(min(v), 6) AS min, round(max(v), 6) AS max, count(*) - count(v) AS invalid FROM (SELECT CASE WHEN isfinite({c}) THEN {c} END AS v FROM {STATS_SQL})" for c in ("quantity", "price", "discount", "tax")))
def g3_describe(spark, sf_dir):
    out = aggregate.describe(_stats(spark, sf_dir), ["quantity", "price", "discount", "tax"])
    return out.select("statistic", "n", *[r6(c).alias(c) for c in ("mean", "median", "std", "min", "max")], "invalid")


@query(" UNION ALL ".join(f"SELECT '{a}' AS x, '{b}' AS y, round(corr({a}, {b}), 6) AS r FROM {STATS_SQL} WHERE isfinite({a}) AND isfinite({b})" for a in ("quantity", "price", "discount", "tax") for b in ("quantity", "price", "discount", "tax")))
def g4_correlations(spark, sf_dir):
    return aggregate.correlations(_stats(spark, sf_dir), ["quantity", "price", "discount", "tax"]).select("x", "y", r6("r").alias("r"))


@query(f"SELECT row_id, round(avg(value) FILTER (NOT is_ai), 6) AS human_mean, round(avg(value) FILTER (is_ai), 6) AS ai_mean FROM {SCORES_SQL} GROUP BY 1")
def g5_class_means(spark, sf_dir):
    return aggregate.class_means(scores(spark, sf_dir)).select("row_id", r6("human_mean").alias("human_mean"), r6("ai_mean").alias("ai_mean"))


@query("SELECT CASE WHEN grouping(lang) = 1 THEN 'ALL' ELSE lang END AS lang, CASE WHEN grouping(source) = 1 THEN 'ALL' ELSE source END AS source, round(avg(n_chars), 6) AS mean FROM documents GROUP BY CUBE (lang, source)")
def g7_group_grid(spark, sf_dir):
    return aggregate.group_grid(read(spark, sf_dir, "documents"), F.col("n_chars"), "lang", "source").select("lang", "source", r6("mean").alias("mean"))


@query("SELECT lang, count(*) AS n, round(count(*)::DOUBLE / (SELECT count(*) FROM documents), 6) AS share FROM documents GROUP BY 1")
def g8_frequencies(spark, sf_dir):
    return aggregate.frequencies(read(spark, sf_dir, "documents"), "lang").select("lang", "n", r6("share").alias("share"))


@query("""SELECT p.source, p.n, p.shape, round(p.n_chars, 6) AS n_chars, m.lang AS category FROM (
    SELECT source, count(*) AS n, CASE WHEN max(doc_id % 3) <= 1 THEN 'single' WHEN min(doc_id % 3) > 1 THEN 'multi' ELSE 'mixed' END AS shape, avg(n_chars) AS n_chars FROM documents GROUP BY 1) p
    JOIN (SELECT source, lang FROM (SELECT source, lang, row_number() OVER (PARTITION BY source ORDER BY count(*) DESC, lang) AS r FROM documents GROUP BY 1, 2) WHERE r = 1) m ON m.source = p.source""")
def g9_message_table(spark, sf_dir):
    df = read(spark, sf_dir, "documents").withColumn("turns", F.col("doc_id") % 3)
    return aggregate.message_table(df, "source", "lang", "turns", ["n_chars"]).withColumn("n_chars", r6("n_chars"))


@query("SELECT lang, count(*) AS n, count(*) FILTER (doc_id % 3 <= 1) AS single, count(*) FILTER (doc_id % 3 > 1) AS multi, count(DISTINCT source) AS messages FROM documents GROUP BY 1")
def g10_prompt_cards(spark, sf_dir):
    return aggregate.prompt_cards(read(spark, sf_dir, "documents").withColumn("turns", F.col("doc_id") % 3), "lang", "source", "turns")


MESSAGE = "'Rewrite for ' || source || chr(10) || '<document>' || chr(10) || 'Only in a document' || chr(10) || '</document>' || chr(10) || '  Reply with the text only. ' || CASE WHEN length(source) > 4 THEN chr(10) || 'Be brief.' ELSE '' END"


@query(f"""SELECT line FROM (SELECT DISTINCT m, trim(unnest(string_split(regexp_replace(m, '(?s)<document>.*?</document>', '', 'g'), chr(10)))) AS line FROM (SELECT DISTINCT {MESSAGE} AS m FROM documents))
    WHERE line <> '' GROUP BY 1 HAVING count(*) >= 0.6 * (SELECT count(DISTINCT source) FROM documents) AND (SELECT count(DISTINCT source) FROM documents) >= 3""")
def g11_boilerplate(spark, sf_dir):
    return aggregate.boilerplate(read(spark, sf_dir, "documents").selectExpr(f"{MESSAGE} AS message"), "message")


@query("SELECT lang, n, source, n_chars, round(n::DOUBLE / sum(n) OVER (), 6) AS share FROM (SELECT lang, count(*) AS n, arg_min(source, doc_id) AS source, arg_min(n_chars, doc_id) AS n_chars FROM documents GROUP BY 1)")
def g12_generator_table(spark, sf_dir):
    return aggregate.generator_table(read(spark, sf_dir, "documents"), "lang", "source", "n_chars", "doc_id").withColumn("share", r6("share"))


@query("SELECT CAST(sum(o_custkey) AS BIGINT) AS prompt_tokens, CAST(sum(o_orderkey) AS BIGINT) AS completion_tokens, count(*) FILTER (o_orderpriority = '1-URGENT') AS failures FROM orders")
def g14_token_totals(spark, sf_dir):
    df = read(spark, sf_dir, "orders").select(F.col("o_custkey").alias("prompt_tokens"), F.col("o_orderkey").alias("completion_tokens"), F.when(F.col("o_orderpriority") == "1-URGENT", F.lit("timeout")).alias("error"))
    return aggregate.token_totals(df)


@query("SELECT o_orderpriority AS error, count(*) AS n FROM orders WHERE o_orderpriority <> '5-LOW' GROUP BY 1")
def g16_failures(spark, sf_dir):
    return aggregate.failures(read(spark, sf_dir, "orders").select(F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderpriority")).alias("error")))


@query("""SELECT class, round(coalesce(hit / nullif(called, 0), 0), 6) AS precision, round(coalesce(hit / nullif(support, 0), 0), 6) AS recall, round(coalesce(2 * hit / nullif(called + support, 0), 0), 6) AS f1, CAST(support AS BIGINT) AS support FROM (
    SELECT class, sum(l)::DOUBLE AS support, sum(p)::DOUBLE AS called, sum(h)::DOUBLE AS hit FROM (
        SELECT quality AS class, 1 AS l, 0 AS p, 0 AS h FROM labels UNION ALL SELECT toxic, 0, 1, CASE WHEN toxic = quality THEN 1 ELSE 0 END FROM labels) GROUP BY 1)""")
def g17_class_report(spark, sf_dir):
    out = aggregate.class_report(read(spark, sf_dir, "labels"), "quality", "toxic")
    return out.select("class", *[r6(c).alias(c) for c in ("precision", "recall", "f1")], F.col("support").cast("long"))


# Ranks


@query("SELECT event_id, round((2 * rank() OVER (ORDER BY value) + count(*) OVER (PARTITION BY value) - 1) / (2.0 * count(*) OVER ()), 6) AS q FROM events")
def w1_quantile(spark, sf_dir):
    return rank.quantile(read(spark, sf_dir, "events").select("event_id", "value"), "value", "q").select("event_id", r6("q").alias("q"))


@query("""SELECT vec_id, array_to_string(list(CAST(CAST(round(q * 1000000) AS BIGINT) AS VARCHAR) ORDER BY pos), ',') AS q FROM (
    SELECT vec_id, pos, (2 * rank() OVER (ORDER BY v) + count(*) OVER (PARTITION BY v) - 1) / (2.0 * count(*) OVER ()) AS q FROM (
        SELECT vec_id, unnest(generate_series(1, len(embedding))) AS pos, unnest(embedding) AS v FROM embeddings)) GROUP BY 1""")
def w2_chunk_quantile(spark, sf_dir):
    out = rank.chunk_quantile(read(spark, sf_dir, "embeddings").select("vec_id", "embedding"), "vec_id", "embedding", "q")
    return out.select("vec_id", F.array_join(F.transform("q", lambda x: F.round(x * 1000000).cast("long").cast("string")), ",").alias("q"))


@query("SELECT event_id, round((value - (SELECT min(value) FROM events)) / ((SELECT max(value) FROM events) - (SELECT min(value) FROM events)), 6) AS v FROM events")
def w3_min_max(spark, sf_dir):
    return rank.min_max(read(spark, sf_dir, "events").select("event_id", "value"), "value", "v").select("event_id", r6("v").alias("v"))


@query("SELECT vec_id, round(sum((v - lo) / (hi - lo)), 4) AS total FROM (SELECT vec_id, unnest(embedding)::DOUBLE AS v FROM embeddings), (SELECT min(list_min(embedding))::DOUBLE AS lo, max(list_max(embedding))::DOUBLE AS hi FROM embeddings) GROUP BY 1")
def w4_chunk_min_max(spark, sf_dir):
    out = rank.chunk_min_max(read(spark, sf_dir, "embeddings").select("vec_id", F.transform("embedding", lambda v: v.cast("double")).alias("e")), "e", "m")
    return out.select("vec_id", F.round(F.aggregate("m", F.lit(0.0), lambda s, x: s + x), 4).alias("total"))


@query(r"SELECT doc_id, row_number() OVER (PARTITION BY source, trim(regexp_replace(lower(text), '\s+', ' ', 'g')) ORDER BY doc_id) > 1 AS is_duplicate FROM documents")
def w5_duplicates_in_group(spark, sf_dir):
    return rank.mark_duplicates(read(spark, sf_dir, "documents"), "text", "doc_id", "source").select("doc_id", "is_duplicate")


@query(r"SELECT doc_id, row_number() OVER (PARTITION BY trim(regexp_replace(lower(text), '\s+', ' ', 'g')) ORDER BY doc_id) > 1 AS is_duplicate FROM documents")
def w5_duplicates(spark, sf_dir):
    return rank.mark_duplicates(read(spark, sf_dir, "documents"), "text", "doc_id").select("doc_id", "is_duplicate")


# Cleaners and flags


@query(rf"SELECT row_id, sha256(regexp_replace(final_response, '(?is)^.*</\s*think\s*>\s*', '')) AS clean FROM {CHANGED_SQL}")
def h1_strip_reasoning_trace(spark, sf_dir):
    return changed_pairs(spark, sf_dir).select("row_id", F.sha2(clean.strip_reasoning_trace("final_response"), 256).alias("clean"))


@query(rf"SELECT row_id, sha256(trim(regexp_replace(regexp_replace(final_response, '[^\S\n]+', ' ', 'g'), '\s*\n\s*', chr(10), 'g'), ' ' || chr(10))) AS clean FROM {CHANGED_SQL}")
def h2_normalize_whitespace(spark, sf_dir):
    return changed_pairs(spark, sf_dir).select("row_id", F.sha2(clean.normalize_whitespace("final_response"), 256).alias("clean"))


@query()
def h3_strip_wrapper(spark, sf_dir):
    return changed_pairs(spark, sf_dir).select("row_id", F.sha2(clean.strip_wrapper_boilerplate("final_response", "original"), 256).alias("clean"))


@query(rf"""SELECT row_id, sha256(CASE WHEN regexp_matches(final_response, {quoted(clean.TITLE_LINE)}) AND NOT regexp_matches(original, {quoted(clean.TITLE_LINE)})
    THEN ltrim(regexp_replace(ltrim(regexp_replace(final_response, {quoted(clean.TITLE_LINE)}, ''), ' ' || chr(10)), '^-{{3,}}[ \t]*\n', ''), ' ' || chr(10)) ELSE final_response END) AS clean FROM {CHANGED_SQL}""")
def h4_strip_added_title(spark, sf_dir):
    return changed_pairs(spark, sf_dir).select("row_id", F.sha2(clean.strip_added_title("final_response", "original"), 256).alias("clean"))


@query(rf"""SELECT row_id, sha256(regexp_replace(regexp_replace(regexp_replace(replace(regexp_replace(final_response, '(?m)^\s*```[^\n]*\n?', '', 'g'), '`', ''), '\[([^\]\n]+)\]\([^)\n]*\)', '\1', 'g'), '(?m)^[ \t]*#{{1,6}}[ \t]*', '', 'g'), '\*\*|__', '', 'g')) AS clean FROM {CHANGED_SQL}""")
def h5_strip_markdown(spark, sf_dir):
    return changed_pairs(spark, sf_dir).select("row_id", F.sha2(clean.strip_markdown("final_response"), 256).alias("clean"))


@query(f"SELECT row_id, sha256(replace(original, chr(10), ' ')) AS clean FROM {CONV_SQL}")
def h6_strip_emoji(spark, sf_dir):
    df = conv_pairs(spark, sf_dir).withColumn("t", F.replace("original", F.lit("\n"), F.lit(" 😀👍🏽"[:1])))
    return df.select("row_id", F.sha2(clean.strip_emoji(F.concat(F.lit("😀"), "t", F.lit("👩‍👩‍👧🇩🇪1️⃣"))), 256).alias("clean"))


@query(r"SELECT doc_id, sha256(replace(replace(text, '\n', chr(10)), '\t', chr(9))) AS clean FROM documents")
def h7_fix_encoding(spark, sf_dir):
    # Each text is first damaged as if its UTF-8 bytes were Latin-1.
    df = read(spark, sf_dir, "documents")
    damaged = F.decode(F.encode("text", "UTF-8"), "ISO-8859-1")
    cp1252 = F.translate(damaged, "".join(map(chr, clean.CP1252_BYTES)), clean.CP1252)
    whole = ~cp1252.rlike(r"[\x{80}-\x{9f}]") & cp1252.rlike(clean.MOJIBAKE)
    return df.select("doc_id", F.sha2(F.when(whole, clean.fix_encoding(cp1252)).otherwise(clean.fix_encoding("text")), 256).alias("clean"))


@query(r"SELECT doc_id, sha256(lower(trim(regexp_replace(text, '\s+', ' ', 'g')))) AS clean FROM documents")
def h8_detector_input(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", F.sha2(clean.clean_detector_input(F.concat(F.lit("<think>a\nb</think>"), "text")), 256).alias("clean"))


@query(f"""SELECT DISTINCT source, '[source text] Rewrite for ' || source || CASE WHEN length(source) > 4 THEN ' Be brief.' ELSE '' END AS told FROM documents""")
def h10_prompt_instruction(spark, sf_dir):
    df = read(spark, sf_dir, "documents").selectExpr("source", f"'{{{{DOC}}}}' || chr(10) || {MESSAGE} AS message").distinct()
    return df.select("source", clean.prompt_instruction("message", F.array(F.lit("Reply with the text only."))).alias("told"))


@query("SELECT DISTINCT event_type, upper(trim(regexp_replace('_a ' || event_type || '--x', '[^a-zA-Z0-9]+', '_', 'g'), '_')) AS name FROM events")
def h11_safe_name(spark, sf_dir):
    return read(spark, sf_dir, "events").select("event_type", clean.safe_name(F.concat(F.lit("_a "), "event_type", F.lit("--x"))).alias("name")).distinct()


FLAG_SQL = ", ".join(f'{v} AS "{k}"' for k, v in {
    "empty": REASON_SQL["empty or too short"], "refusal": REASON_SQL["refusal"], "filler": REASON_SQL["filler output"], "placeholder": REASON_SQL["unfilled placeholder"], "meta": REASON_SQL["task meta-commentary"], "echo": REASON_SQL["echoed instruction"],
    "unchanged": REASON_SQL["identical to source"], "odd_length": "NOT (CASE WHEN len(original) = 0 THEN 0.0 ELSE len(final_response)::DOUBLE / len(original) END BETWEEN 0.1 AND 5.0)", "damaged": "contains(final_response, chr(65533))", "subset": "(final_response <> '' AND contains(original, final_response))",
}.items())


@query(f"SELECT row_id, {FLAG_SQL} FROM {CHANGED_SQL}")
def h14_flags(spark, sf_dir):
    a, b = "original", "final_response"
    made = {"empty": flags.is_empty(b), "refusal": flags.has_refusal(b), "filler": flags.has_filler_output(b, a), "placeholder": flags.has_placeholder(b, a), "meta": flags.has_meta_commentary(b, a), "echo": flags.has_prompt_echo(b, "instruction"), "unchanged": flags.is_unchanged(b, a), "odd_length": flags.has_length_anomaly(a, b), "damaged": flags.has_encoding_damage(b), "subset": flags.is_strict_subset(a, b)}
    return changed_pairs(spark, sf_dir).select("row_id", *[c.alias(n) for n, c in made.items()])


@query(f"SELECT p.row_id, 1 - j.d >= 0.9 AS near, j.d <= 0.025 AND k.d <= 0.05 AS too_close FROM {CHANGED_SQL} p JOIN {_jaccard_cte(CHANGED_SQL, 1)} j ON j.row_id = p.row_id JOIN {_jaccard_cte(CHANGED_SQL, 2)} k ON k.row_id = p.row_id")
def h21_near_duplicate_pairs(spark, sf_dir):
    return changed_pairs(spark, sf_dir).select("row_id", flags.is_near_duplicate("original", "final_response").alias("near"), flags.has_insufficient_jaccard_distance("original", "final_response").alias("too_close"))


@query(r"""SELECT row_id, len(w) > 0 AND len(list_intersect(w, v))::DOUBLE / greatest(len(w), 1) >= 0.25 AS flagged FROM (
    SELECT row_id, list_distinct(regexp_extract_all(lower(final_response), '[\p{L}\p{N}_]+')) AS w, list_distinct(regexp_extract_all(lower(original), '[\p{L}\p{N}_]+')) AS v FROM """ + CONV_SQL + ")")
def h24_instruction_vocabulary(spark, sf_dir):
    return conv_pairs(spark, sf_dir).select("row_id", flags.has_instruction_vocabulary("final_response", "original").alias("flagged"))


@query()
def h26_non_english(spark, sf_dir):
    return read(spark, sf_dir, "documents").select("doc_id", models.non_english(F.col("text"), threshold=0.5).alias("non_english"))


CANON = lambda c: rf"regexp_replace(lower({ASCII(c)}), '\s+', '', 'g')"


@query(f"SELECT row_id, {CANON('final_response')} <> '' AND contains({CANON('original')}, {CANON('final_response')}) AS found, CASE WHEN {CANON('final_response')} <> '' AND contains({CANON('original')}, {CANON('final_response')}) THEN {CANON('final_response')} ELSE '' END AS slice FROM {CHANGED_SQL}")
def h28_loose_subset(spark, sf_dir):
    out = changed_pairs(spark, sf_dir).select("row_id", flags.loose_subset("original", "final_response").alias("s"))
    return out.select("row_id", "s.found", F.lower(F.regexp_replace(transliterate(F.col("s.slice")), r"\s+", "")).alias("slice"))


# Distances and chunks


@query(f"SELECT a.row_id, round(a.d, 6) AS j1, round(b.d, 6) AS j2, round(c.d, 6) AS j3 FROM {_jaccard_cte(CONV_SQL, 1)} a JOIN {_jaccard_cte(CONV_SQL, 2)} b ON b.row_id = a.row_id JOIN {_jaccard_cte(CONV_SQL, 3)} c ON c.row_id = a.row_id")
def d1_jaccards(spark, sf_dir):
    return conv_pairs(spark, sf_dir).select("row_id", *[r6(distance.jaccard("original", "final_response", n)).alias(f"j{n}") for n in (1, 2, 3)])


@query(f"SELECT row_id, levenshtein({ASCII('original')}, {ASCII('final_response')})::DOUBLE AS d FROM {CONV_SQL}")
def d2_levenshtein(spark, sf_dir):
    return conv_pairs(spark, sf_dir).select("row_id", distance.edit_distance(transliterate(F.col("original")), transliterate(F.col("final_response"))).alias("d"))


def _deviation_sql(name: str, f: Callable[[str], str]) -> str:
    a, b = f(ASCII("original")), f(ASCII("final_response"))
    return f"abs({a} - {b})::BIGINT AS {name}, round(CASE WHEN greatest({a}, {b}) = 0 THEN 0 ELSE abs({a} - {b})::DOUBLE / greatest({a}, {b}) END, 6) AS {name}_proportion"


LINES = lambda c: f"CASE WHEN {c} = '' THEN 0 ELSE len(string_split(regexp_replace({c}, '\\n$', ''), chr(10))) END"


@query(f"SELECT row_id, {_deviation_sql('deviated_lines', lambda c: f'({LINES(c)})')}, {_deviation_sql('deviated_words', lambda c: f'len({WORDS(c)})')}, {_deviation_sql('deviated_characters', lambda c: f'len({c})')} FROM {CHANGED_SQL}")
def d3_deviations(spark, sf_dir):
    df = changed_pairs(spark, sf_dir)
    return df.select("row_id", distance.deviations("original", "final_response").alias("d")).select("row_id", "d.*").select("row_id", *[c for n in ("lines", "words", "characters") for c in (F.col(f"{n}.count").alias(f"deviated_{n}"), r6(f"{n}.proportion").alias(f"deviated_{n}_proportion"))])


@query(f"""SELECT row_id, len(c) AS chunks, sha256(array_to_string(c, '|')) AS digest FROM (
    SELECT row_id, list_transform(generate_series(1, len(w), 7), lambda i: array_to_string(list_slice(w, i, i + 9), ' ')) AS c FROM (SELECT row_id, {WORDS('final_response')} AS w FROM {CONV_SQL}))""")
def d8_window_chunks(spark, sf_dir):
    out = conv_pairs(spark, sf_dir).select("row_id", distance.window_chunks("final_response", 10, 7).alias("c"))
    return out.select("row_id", F.size("c").cast("long").alias("chunks"), F.sha2(F.array_join("c", "|"), 256).alias("digest"))


CHUNKS_SQL = f"(SELECT row_id, " + ", ".join(f"list_transform(generate_series(1, len({c}), 20), lambda i: list_slice({c}, i, i + 19)) AS {c}" for c in "ab") + f" FROM (SELECT row_id, {WORDS('original')} AS a, {WORDS('final_response')} AS b FROM {CONV_SQL}))"
CHUNK_JACCARDS_SQL = "list_transform(a, lambda x: 1 - len(list_intersect(list_distinct(x), list_distinct(y)))::DOUBLE / len(list_distinct(list_concat(x, y))))"


def _per_chunk(reduce: str, alone: str) -> str:
    return f"array_to_string(list_transform(b, lambda y: CAST(round(CASE WHEN len(a) = 0 THEN {alone} ELSE {reduce} END, 6) AS VARCHAR)), ',')"


@query("SELECT row_id, " + ", ".join(f'{_per_chunk(f"list_{f}({CHUNK_JACCARDS_SQL})", "1.0")} AS "{n}"' for n, f in (("max", "max"), ("min", "min"), ("mean", "avg"))) + f" FROM {CHUNKS_SQL}")
def d6_chunked_jaccards(spark, sf_dir):
    df = conv_pairs(spark, sf_dir).select("row_id", distance.window_chunks("original", 20, 20).alias("a"), distance.window_chunks("final_response", 20, 20).alias("b"))
    return df.select("row_id", *[F.array_join(F.transform(distance.chunked_jaccards("a", "b", 1, op), lambda x: F.round(x, 6).cast("string")), ",").alias(op) for op in ("max", "min", "mean")])


@query()
def d7_chunked_levenshteins(spark, sf_dir):
    df = conv_pairs(spark, sf_dir).select("row_id", distance.window_chunks("original", 20, 20).alias("a"), distance.window_chunks("final_response", 20, 20).alias("b"))
    return df.select("row_id", F.array_join(F.transform(distance.chunked_levenshteins("a", "b", "min"), lambda x: x.cast("string")), ",").alias("least"))


@query(f"""SELECT row_id, count(p)::BIGINT AS phrases, coalesce(sum(len(p)), 0)::BIGINT AS chars FROM (
    SELECT row_id, CASE WHEN i + n - 1 <= len(w) THEN array_to_string(list_slice(w, i, i + n - 1), ' ') END AS p FROM (
        SELECT row_id, w, n, unnest(generate_series(1, greatest(len(w), 1))) AS i FROM (SELECT row_id, w, unnest(generate_series(least(6, greatest(len(w), 1)), 12)) AS n FROM (SELECT row_id, {WORDS('final_response')} AS w FROM {CONV_SQL})))) GROUP BY 1""")
def d9_phrases(spark, sf_dir):
    out = conv_pairs(spark, sf_dir).select("row_id", distance.phrases("final_response").alias("p"))
    return out.select("row_id", F.size("p").cast("long").alias("phrases"), F.coalesce(F.aggregate(F.transform("p", F.char_length), F.lit(0).cast("long"), lambda s, x: s + x), F.lit(0)).alias("chars"))


# Vectors and language-model statistics


@query("SELECT a.vec_id, round(1 - list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[]), 6) AS d FROM embeddings a JOIN embeddings b ON b.vec_id = a.vec_id + 1")
def v1_cosine_distance(spark, sf_dir):
    e = read(spark, sf_dir, "embeddings")
    other = e.select((F.col("vec_id") - 1).alias("vec_id"), F.col("embedding").alias("next"))
    return e.join(other, "vec_id").select("vec_id", r6(vectors.cosine_distance("embedding", "next")).alias("d"))


@query("SELECT a.vec_id, round((sum(list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[])) - 1) / ((SELECT count(*) FROM embeddings) - 1), 6) AS s FROM embeddings a, embeddings b GROUP BY 1")
def v2_similarity_to_others(spark, sf_dir):
    return aggregate.mean_similarity_to_others(read(spark, sf_dir, "embeddings"), "vec_id", "embedding", "s").select("vec_id", r6("s").alias("s"))


@query("SELECT a.vec_id, round(avg(list_dot_product(a.embedding::DOUBLE[], b.embedding::DOUBLE[])), 6) AS s FROM (SELECT * FROM embeddings WHERE label = 0) a, (SELECT * FROM embeddings WHERE label <> 0) b GROUP BY 1")
def v3_similarity_to_set(spark, sf_dir):
    e = read(spark, sf_dir, "embeddings")
    return aggregate.mean_similarity_to(e.where("label = 0"), "embedding", e.where("label <> 0"), "embedding", "s").select("vec_id", r6("s").alias("s"))


def _parts(spark: SparkSession, sf_dir: str) -> DataFrame:
    cut = lambda lo: F.transform(F.sequence(F.lit(lo), F.lit(lo + 24), F.lit(8)), lambda i: F.transform(F.slice("embedding", i, 8), lambda x: x.cast("double")))
    return read(spark, sf_dir, "embeddings").select("vec_id", cut(1).alias("a"), cut(33).alias("b"))


PARTS_SQL = "(SELECT vec_id, " + ", ".join(f"list_transform(generate_series({lo}, {lo + 24}, 8), lambda i: list_slice(embedding, i, i + 7)::DOUBLE[]) AS {n}" for n, lo in (("a", 1), ("b", 33))) + " FROM embeddings)"


@query(f"""SELECT vec_id, round(1 - p, 6) AS precision, round(1 - r, 6) AS recall, round(1 - CASE WHEN p + r > 0 THEN 2 * p * r / (p + r) ELSE 0 END, 6) AS f1 FROM (
    SELECT vec_id, list_avg(list_transform(b, lambda y: list_max(list_transform(a, lambda x: list_dot_product(x, y))))) AS p, list_avg(list_transform(a, lambda x: list_max(list_transform(b, lambda y: list_dot_product(x, y))))) AS r FROM {PARTS_SQL})""")
def v5_bert_score(spark, sf_dir):
    return _parts(spark, sf_dir).select("vec_id", vectors.bert_score("a", "b").alias("s")).select("vec_id", *[r6(f"s.{c}").alias(c) for c in ("precision", "recall", "f1")])


@query()
def v6_mover_distance(spark, sf_dir):
    return _parts(spark, sf_dir).select("vec_id", r6(models.mover_distance(F.col("a"), F.col("b"))).alias("d"))


@query("SELECT vec_id, " + ", ".join(f'{_per_chunk(f"list_{f}(list_transform(a, lambda x: 1 - list_dot_product(x, y)))", "1.0")} AS "{n}"' for n, f in (("max", "max"), ("min", "min"), ("mean", "avg"))) + f" FROM {PARTS_SQL}")
def v7_cosine_chunks(spark, sf_dir):
    return _parts(spark, sf_dir).select("vec_id", *[F.array_join(F.transform(vectors.cosine_distance_chunked("a", "b", op), lambda x: F.round(x, 6).cast("string")), ",").alias(op) for op in ("max", "min", "mean")])


@query()
def v8_soft_phrases(spark, sf_dir):
    return conv_pairs(spark, sf_dir).select("row_id", r6(models.soft_phrase_distance(F.col("original"), F.col("final_response"), models.HashEmbedder)).alias("d"))


SUMS_SQL = "(SELECT event_id, n, -value * n / 40 AS lp, value * n / 50 AS entropy, CASE WHEN event_id % 11 = 0 THEN 0.0 ELSE value * n / 70 + 0.25 END AS variance, floor(n / 5)::DOUBLE AS topp, floor(n / 7)::DOUBLE AS topk, CASE WHEN event_id % 13 = 0 THEN 0.0 ELSE value * n / 30 + 0.5 END AS ce FROM (SELECT event_id, abs(value) AS value, event_id % 60 AS n FROM events))"


@query(f"""SELECT event_id, coalesce(round(CASE WHEN n > 0 THEN exp(-lp / n) END, 4), -1) AS perplexity, round(CASE WHEN n > 0 THEN entropy / n ELSE 0 END, 6) AS entropy, coalesce(round(CASE WHEN n > 0 THEN topp / n END, 6), -1) AS topp, coalesce(round(CASE WHEN n > 0 THEN topk / n END, 6), -1) AS topk,
    round(CASE WHEN variance > 1e-6 THEN (lp + entropy) / sqrt(variance) ELSE 0 END, 6) AS fastdetect, round(CASE WHEN ce > 1e-6 THEN -lp / ce ELSE 0 END, 6) AS ratio FROM {SUMS_SQL}""")
def l2_lm_statistics(spark, sf_dir):
    e = read(spark, sf_dir, "events").select("event_id", F.abs("value").alias("v"), (F.col("event_id") % 60).alias("n"))
    v, n = F.col("v"), F.col("n")
    s = F.struct(n.cast("long").alias("n"), (-v * n / 40).alias("lp"), (v * n / 50).alias("entropy"), F.when(F.col("event_id") % 11 == 0, 0.0).otherwise(v * n / 70 + 0.25).alias("variance"), F.floor(n / 5).cast("double").alias("topp"), F.floor(n / 7).cast("double").alias("topk"), F.when(F.col("event_id") % 13 == 0, 0.0).otherwise(v * n / 30 + 0.5).alias("ce"))
    known = lambda c, d: F.when(F.isnan(c), F.lit(-1.0)).otherwise(F.round(c, d))
    e = e.select("event_id", s.alias("s"))
    return e.select("event_id", known(lm.perplexity("s"), 4).alias("perplexity"), r6(lm.mean_entropy("s")).alias("entropy"), known(lm.outlier_share("s", "topp"), 6).alias("topp"), known(lm.outlier_share("s", "topk"), 6).alias("topk"), r6(lm.curvature("s")).alias("fastdetect"), r6(lm.cross_ratio("s")).alias("ratio"))


@query()
def l1_unigram_sums(spark, sf_dir):
    out = aggregate.unigram_sums(read(spark, sf_dir, "documents").select("doc_id", "text"), "text", "s", keep=["doc_id"])
    return out.select("doc_id", "s.n", r6("s.lp").alias("lp"), r6(lm.curvature("s")).alias("fastdetect"))


@query("""SELECT vec_id, list_position(e, list_max(e))::INTEGER - 1 AS bucket, round((e[2] + 2 * e[3] + 3 * e[4]) / list_sum(e) / 3, 6) AS score FROM (SELECT vec_id, list_transform(embedding[1:4]::DOUBLE[], lambda x: exp(x)) AS e FROM embeddings)""")
def l8_graded_score(spark, sf_dir):
    e = read(spark, sf_dir, "embeddings").select("vec_id", lm.graded_score(F.slice("embedding", 1, 4)).alias("g"))
    return e.select("vec_id", "g.bucket", r6("g.score").alias("score"))


# Evaluation


AUROC_SQL = "round((sum(CASE WHEN is_ai THEN r END) - count(*) FILTER (is_ai) * (count(*) FILTER (is_ai) + 1) / 2.0) / (count(*) FILTER (is_ai) * count(*) FILTER (NOT is_ai)), 6)"


@query(f"SELECT lang, count(*) AS n, CASE WHEN count(*) FILTER (is_ai) * count(*) FILTER (NOT is_ai) > 0 THEN {AUROC_SQL} ELSE -1 END AS auroc FROM (SELECT *, rank() OVER (PARTITION BY lang ORDER BY value) + (count(*) OVER (PARTITION BY lang, value) - 1) / 2.0 AS r FROM {SCORES_SQL}) GROUP BY 1")
def e1_auroc(spark, sf_dir):
    out = evaluate.auroc(scores(spark, sf_dir), ["lang"])
    return out.select("lang", "n", F.when(F.isnan("auroc"), F.lit(-1.0)).otherwise(r6("auroc")).alias("auroc"))


CONFUSION_SQL = f"""(SELECT t.threshold, count(*) FILTER (is_ai AND value > t.threshold) AS tp, count(*) FILTER (NOT is_ai AND value > t.threshold) AS fp, count(*) FILTER (NOT is_ai AND value <= t.threshold) AS tn, count(*) FILTER (is_ai AND value <= t.threshold) AS fn
    FROM (SELECT DISTINCT value AS threshold FROM {SCORES_SQL}) t, {SCORES_SQL} s GROUP BY 1)"""


@query(f"SELECT round(threshold, 6) AS threshold, tp, fp, tn, fn FROM {CONFUSION_SQL}")
def e2_confusion(spark, sf_dir):
    out = evaluate.confusion(scores(spark, sf_dir).withColumn("classifier", F.lit("a")), ["classifier"])
    return out.select(r6("threshold").alias("threshold"), "tp", "fp", "tn", "fn")


@query(" UNION ALL ".join(f"SELECT '{n}' AS budget, '{k}' AS side, round({f}(threshold), 6) AS threshold FROM {CONFUSION_SQL} WHERE {fp} <= {b} * (fp + tn)" for n, b in evaluate.BUDGETS.items() for k, f, fp in (("above", "min", "fp"),)))
def e3_operating_points(spark, sf_dir):
    out = evaluate.operating_points(scores(spark, sf_dir).withColumn("classifier", F.lit("a")), ["classifier"])
    return out.select("budget", F.lit("above").alias("side"), r6("threshold").alias("threshold"))


@query(f"SELECT lang, count(*) AS n, count(*) FILTER (is_ai AND value > 70) AS tp, count(*) FILTER (NOT is_ai AND value > 70) AS fp, count(*) FILTER (NOT is_ai AND value <= 70) AS tn, count(*) FILTER (is_ai AND value <= 70) AS fn, round(avg(CASE WHEN is_ai = (value > 70) THEN 1.0 ELSE 0.0 END), 6) AS accuracy FROM {SCORES_SQL} GROUP BY 1")
def e4_classifier_metrics(spark, sf_dir):
    return evaluate.classifier_metrics(scores(spark, sf_dir), ["lang"], 70.0).select("lang", "n", "tp", "fp", "tn", "fn", r6("accuracy").alias("accuracy"))


REPORT_POINTS = {n: f"(SELECT min(threshold) FROM {CONFUSION_SQL} WHERE fp <= {b} * (fp + tn))" for n, b in evaluate.BUDGETS.items()}


@query(f"SELECT lang, count(*) AS n, " + ", ".join(f"round(coalesce(count(*) FILTER (is_ai AND value > {p})::DOUBLE / nullif(count(*) FILTER (is_ai), 0), 0), 6) AS tpr_at_{n}" for n, p in REPORT_POINTS.items()) + f" FROM {SCORES_SQL} GROUP BY 1")
def e7_subset_report(spark, sf_dir):
    out = evaluate.report(scores(spark, sf_dir).withColumn("classifier", F.lit("a")), ["classifier"], "lang")
    return out.select("lang", "n", *[r6(f"tpr_at_{b}").alias(f"tpr_at_{b}") for b in evaluate.BUDGETS])


@query(f"""WITH s AS (SELECT * FROM {SCORES_SQL}), e AS (SELECT min(value) AS lo, max(value) AS hi FROM s), g AS (SELECT i AS step, lo + (hi - lo) * i / 239 AS t FROM e, range(240) AS x(i))
    SELECT step::INTEGER AS step, round(any_value(t), 6) AS threshold, round(count(*) FILTER (is_ai AND value > t)::DOUBLE / count(*) FILTER (is_ai), 6) AS tpr, round(count(*) FILTER (NOT is_ai AND value > t)::DOUBLE / count(*) FILTER (NOT is_ai), 6) AS fpr FROM g, s GROUP BY 1""")
def e8_sweep(spark, sf_dir):
    out = evaluate.sweep(scores(spark, sf_dir).withColumn("classifier", F.lit("a")), ["classifier"])
    return out.select(F.col("step").cast("int"), r6("threshold").alias("threshold"), r6("tpr").alias("tpr"), r6("fpr").alias("fpr"))


@query(f"""WITH s AS (SELECT * FROM {SCORES_SQL} WHERE is_ai), e AS (SELECT least(0.0, min(distance)) AS lo, (SELECT min(distance) FROM (SELECT distance FROM s ORDER BY distance DESC LIMIT 25)) AS hi FROM s), g AS (SELECT i AS step, lo + (hi - lo) * i / 159 AS t FROM e, range(160) AS x(i))
    SELECT step::INTEGER AS step, round(any_value(t), 6) AS cutoff, count(*) FILTER (distance >= t) AS kept, round(count(*) FILTER (distance >= t AND value > 70)::DOUBLE / count(*) FILTER (distance >= t), 6) AS tpr FROM g, s GROUP BY 1""")
def e9_tpr_by_min_distance(spark, sf_dir):
    out = evaluate.tpr_by_min_distance(scores(spark, sf_dir).where("is_ai"), "distance", {"tpr": 70.0})
    return out.select(F.col("step").cast("int"), r6("cutoff").alias("cutoff"), F.col("kept").cast("long"), r6("tpr").alias("tpr"))


@query("""SELECT 'c' AS classifier, event_id AS row_id, base, is_ai, round(value, 6) AS value FROM (
    SELECT event_id, 'original_score' AS base, false AS is_ai, CASE WHEN event_id % 9 = 0 THEN NULL ELSE value END AS value FROM events UNION ALL SELECT event_id, 'response_score', true, value * 2 FROM events) WHERE value IS NOT NULL""")
def e10_long_scores(spark, sf_dir):
    e = read(spark, sf_dir, "events").select("event_id", F.when(F.col("event_id") % 9 == 0, F.lit(float("nan"))).otherwise(F.col("value")).alias("original_score"), (F.col("value") * 2).alias("response_score"))
    return evaluate.long_scores(e, "event_id", [("original_score", False), ("response_score", True)], "c").withColumn("value", r6("value"))


@query(f"""WITH m AS (SELECT lang, source, avg(value) FILTER (NOT is_ai) AS h, avg(value) FILTER (is_ai) AS a FROM {SCORES_SQL} GROUP BY row_id, lang, source)
    SELECT panel, CASE WHEN grouping(lang) = 1 THEN 'ALL' ELSE lang END AS lang, CASE WHEN grouping(source) = 1 THEN 'ALL' ELSE source END AS source, round(avg(v), 6) AS mean FROM (
        SELECT 'human' AS panel, lang, source, h AS v FROM m UNION ALL SELECT 'ai', lang, source, a FROM m UNION ALL SELECT 'difference', lang, source, abs(a - h) FROM m)
    GROUP BY GROUPING SETS ((panel, lang, source), (panel, lang), (panel, source), (panel))""")
def e14_score_grids(spark, sf_dir):
    s = scores(spark, sf_dir)
    out = evaluate.score_grids(s, s.select("row_id", "lang", "source").distinct(), "lang", "source")
    return out.select("panel", "lang", "source", r6("mean").alias("mean"))


@query("""WITH e AS (SELECT min(value) AS lo, max(value) AS hi FROM events), b AS (SELECT event_type, least(floor((value - lo) / ((hi - lo) / 70)), 69)::INTEGER AS bin, count(*) AS n FROM events, e GROUP BY 1, 2), t AS (SELECT event_type, count(*) AS c FROM events GROUP BY 1)
    SELECT t.event_type AS series, i::INTEGER AS bin, round(lo + (hi - lo) / 70 * (i + 0.5), 6) AS centre, round(coalesce(n, 0) / (c * (hi - lo) / 70), 6) AS density FROM t CROSS JOIN e CROSS JOIN range(70) AS x(i) LEFT JOIN b ON b.event_type = t.event_type AND b.bin = i""")
def e15_histogram(spark, sf_dir):
    out = evaluate.histogram(read(spark, sf_dir, "events"), "event_type", "value")
    return out.select("series", "bin", r6("centre").alias("centre"), r6("density").alias("density"))


@query(f"SELECT source FROM (SELECT source, lang, avg(value) AS v FROM {SCORES_SQL} GROUP BY 1, 2) GROUP BY 1 ORDER BY max(v), source LIMIT 1")
def t3_hardest_subset(spark, sf_dir):
    per = scores(spark, sf_dir).groupBy("source", "lang").agg(F.avg("value").alias("v"))
    return evaluate.hardest_subset(per, "source", "v").select("source")


@query(f"SELECT lang, arg_max(source, v) AS best, arg_min(source, v) AS worst FROM (SELECT source, lang, avg(value) + ascii(source) / 1e6 AS v FROM {SCORES_SQL} GROUP BY 1, 2) GROUP BY 1")
def t4_best_and_worst(spark, sf_dir):
    per = scores(spark, sf_dir).groupBy("source", "lang").agg((F.avg("value") + F.ascii("source") / 1e6).alias("v"))
    return evaluate.best_and_worst(per, ["lang"], "source", "v")


@query(f"""SELECT rank, lang FROM (SELECT lang, CAST(row_number() OVER (ORDER BY v DESC NULLS LAST, lang) AS INTEGER) AS rank FROM (SELECT lang, CASE WHEN lang = 'fr' THEN NULL ELSE avg(value) END AS v FROM {SCORES_SQL} GROUP BY 1))""")
def t1_leaderboard(spark, sf_dir):
    per = scores(spark, sf_dir).groupBy("lang").agg(F.when(F.col("lang") == "fr", F.lit(float("nan"))).otherwise(F.avg("value")).alias("auroc"))
    known = F.when(F.isnan("auroc"), F.lit(None)).otherwise(F.col("auroc"))
    return rank.ranked(evaluate.leaderboard(per, "lang"), known.desc_nulls_last(), F.col("lang")).select("rank", "lang")


# Buckets


@query("""SELECT event_id, CASE WHEN s <= lo THEN 0 WHEN s >= hi THEN 4 ELSE 1 + floor((s - lo) / (hi - lo) * 3)::INTEGER END AS banded, least(floor(s * 5)::INTEGER, 4) AS even, CASE WHEN s <= 0 THEN 0 ELSE 1 + least(floor(s * 4)::INTEGER, 3) END AS human,
    CASE WHEN s <= 0 THEN 0 WHEN s <= lo THEN 1 WHEN s >= hi THEN 4 ELSE 2 + floor((s - lo) / (hi - lo) * 2)::INTEGER END AS human_banded FROM (SELECT event_id, (event_id % 101)::DOUBLE / 100 AS s, 0.2::DOUBLE AS lo, 0.8::DOUBLE AS hi FROM events)""")
def k1_buckets(spark, sf_dir):
    e = read(spark, sf_dir, "events").select("event_id", ((F.col("event_id") % 101).cast("double") / 100).alias("s"))
    return e.select("event_id", *[buckets.bucketer(k, "s", 5, 0.2, 0.8).alias(k) for k in ("banded", "even", "human", "human_banded")])


@query("""WITH s AS (SELECT event_id, greatest(value, 0)::DOUBLE AS s FROM events), e AS (SELECT unnest(quantile_cont(s, [0.25, 0.5, 0.75])) AS edge FROM s WHERE s > 0 AND event_id % 2 = 0)
    SELECT event_id, CASE WHEN s <= 0 THEN 0 ELSE 1 + (SELECT count(*) FROM e WHERE edge <= s) END::INTEGER AS bucket FROM s""")
def k6_sized_buckets(spark, sf_dir):
    e = read(spark, sf_dir, "events").select("event_id", F.greatest(F.col("value"), F.lit(0)).cast("double").alias("s"))
    edges = buckets.size_edges(e.where("event_id % 2 = 0"), "s", 5)
    return e.select("event_id", buckets.bucketer("human_size", "s", 5, edges=edges).alias("bucket"))


# Prompts


@query(f"SELECT row_id, 'Rewrite: ' || original AS first, CASE WHEN final_response IS NOT NULL THEN '{{{{RESP_0}}}}' || chr(10) || 'Rewrite: ' || final_response END AS second FROM {CONV_SQL}")
def p5_reformat_chats(spark, sf_dir):
    made = conv_pairs(spark, sf_dir).select("row_id", prompts.recursive_format(prompts.reformat(F.array("original", "final_response"), "Rewrite: {{TEXT}}")).alias("c"))
    return made.select("row_id", F.get("c", F.lit(0)).alias("first"), F.get("c", F.lit(1)).alias("second"))


@query("""SELECT d.doc_id, CASE d.doc_id % 2 WHEN 0 THEN 'Rewrite this ' || lang || ' text: ' || text ELSE 'Shorten: ' || text || ' (from ' || source || ')' END AS turn FROM documents d""")
def p9_fill_prompts(spark, sf_dir):
    made = prompts.prompt_table(spark, prompts.prompts_of([["Rewrite this <<lang>> text: {{DOC}}"], ["Shorten: {{DOC}} (from <<source>>)"]]))
    rows = prompts.PromptCursor(made).take(read(spark, sf_dir, "documents"), 0, key="doc_id")
    return prompts.fill_prompts(rows, "text", ["lang", "source"]).select("doc_id", F.get("chat_turns", F.lit(0)).alias("turn"))


@query(f"SELECT row_id, 6::BIGINT AS messages, 'again: ' || original || ' / ' || final_response AS last FROM {CONV_SQL}")
def p11_messages(spark, sf_dir):
    df = conv_pairs(spark, sf_dir).select("row_id", "final_response", F.array(F.col("original"), F.concat(F.lit("again: "), "original", F.lit(" / {{RESP_0}}"))).alias("chat_turns"), F.lit(True).alias("use_multiturn"), F.array(F.array(F.lit("q"), F.lit("a"))).alias("examples"))
    made = df.select("row_id", F.concat(F.array(F.struct(F.lit("system").alias("role"), F.lit("be plain").alias("content"))), prompts.messages(1, ["final_response"])).alias("m"))
    return made.select("row_id", F.size("m").cast("long").alias("messages"), F.element_at("m", -1)["content"].alias("last"))


# Operators that other queries use as parts


@query("SELECT d.doc_id, d.n_chars, l.quality FROM documents d JOIN labels l ON l.doc_id = d.doc_id")
def j1_by_position(spark, sf_dir):
    return joins.by_position(read(spark, sf_dir, "documents").select("doc_id", "n_chars"), read(spark, sf_dir, "labels").select("doc_id", "quality"), "doc_id")


@query("SELECT doc_id, text, NULL AS lang FROM documents UNION ALL SELECT item_id, text, 'item' FROM benchmark")
def u1_union_all(spark, sf_dir):
    items = read(spark, sf_dir, "benchmark").select(F.col("item_id").alias("doc_id"), "text", F.lit("item").alias("lang"))
    return joins.union_all(read(spark, sf_dir, "documents").select("doc_id", "text"), items)


@query(f"SELECT DISTINCT gram AS phrase FROM {GRAM2_SQL}")
def u5_distinct_phrases(spark, sf_dir):
    return aggregate.global_ngrams(read(spark, sf_dir, "documents"), "text", 2).select(F.col("gram").alias("phrase"))


@query("SELECT o_orderkey, o_totalprice, o_custkey FROM orders")
def b3_checked_select(spark, sf_dir):
    return conditions.checked_select(read(spark, sf_dir, "orders"), ["o_orderkey", "o_totalprice", "o_orderkey", "o_custkey"])


@query("SELECT doc_id, n_chars, length(text) AS n_code_points, lang || '/' || source AS place FROM documents")
def b9_skip_present(spark, sf_dir):
    have = read(spark, sf_dir, "documents").select("doc_id", "n_chars", "text", "lang", "source")
    made = {"n_chars": F.lit(-1), "n_code_points": F.char_length("text").cast("long"), "place": F.concat("lang", F.lit("/"), "source")}
    return conditions.with_missing(have, made).select("doc_id", "n_chars", "n_code_points", "place")


@query(f"SELECT sum(invalid)::BIGINT AS invalid FROM ({' UNION ALL '.join(f'SELECT count(*) - count(*) FILTER (isfinite({c})) AS invalid FROM {STATS_SQL}' for c in ('quantity', 'price', 'discount', 'tax'))})")
def g15_invalid_total(spark, sf_dir):
    return aggregate.invalid_total(aggregate.describe(_stats(spark, sf_dir), ["quantity", "price", "discount", "tax"], exact=False))


@query(f"SELECT round(avg(discount) FILTER (isfinite(discount)), 6) AS discount, round(avg(tax) FILTER (isfinite(tax)), 6) AS tax FROM {STATS_SQL}")
def g6_finite_mean(spark, sf_dir):
    return _stats(spark, sf_dir).agg(*[r6(aggregate.finite_mean(F.col(c))).alias(c) for c in ("discount", "tax")])


@query(f"SELECT row_id, final_response <> '' AND contains(original, final_response) AS is_subset, original <> '' AND contains(final_response, original) AS holds FROM {CHANGED_SQL}")
def h27_strict_subset(spark, sf_dir):
    return changed_pairs(spark, sf_dir).select("row_id", flags.is_strict_subset("original", "final_response").alias("is_subset"), flags.is_strict_subset("final_response", "original").alias("holds"))


@query(f"""SELECT source, CAST(row_number() OVER (ORDER BY a ASC NULLS LAST, b ASC NULLS LAST, source) AS INTEGER) AS rank FROM (
    SELECT source, CASE WHEN source < 'c' THEN NULL ELSE round(avg(value), 6) END AS a, max(distance) AS b FROM {SCORES_SQL} GROUP BY 1)""")
def t2_prompt_order(spark, sf_dir):
    per = scores(spark, sf_dir).groupBy("source").agg(F.when(F.col("source") < "c", F.lit(float("nan"))).otherwise(r6(F.avg("value"))).alias("tpr_at_fpr_1pct"), F.max("distance").alias("tpr_at_fpr_0_1pct"))
    known = F.when(F.isnan("tpr_at_fpr_1pct"), F.lit(None)).otherwise(F.col("tpr_at_fpr_1pct"))
    return rank.ranked(evaluate.prompt_order(per, "source"), known.asc_nulls_last(), F.col("tpr_at_fpr_0_1pct").asc_nulls_last(), F.col("source")).select("source", "rank")


@query(f"""SELECT (SELECT {AUROC_SQL} FROM (SELECT *, rank() OVER (ORDER BY value) + (count(*) OVER (PARTITION BY value) - 1) / 2.0 AS r FROM {SCORES_SQL})) AS auroc, """ + ", ".join(f"(SELECT round(coalesce(count(*) FILTER (is_ai AND value > {p})::DOUBLE / nullif(count(*) FILTER (is_ai), 0), 0), 6) FROM {SCORES_SQL}) AS tpr_at_{n}" for n, p in REPORT_POINTS.items()))
def e6_detector_metrics(spark, sf_dir):
    out = evaluate.report(scores(spark, sf_dir).withColumns({"classifier": F.lit("a"), "every": F.lit("all")}), ["classifier"], "every")
    return out.select(r6("auroc").alias("auroc"), *[r6(f"tpr_at_{b}").alias(f"tpr_at_{b}") for b in evaluate.BUDGETS])


@query("SELECT doc_id, CASE doc_id % 3 WHEN 0 THEN 'train a' WHEN 1 THEN 'train b' ELSE 'train c' END AS train_turn, 'test d' AS test_turn FROM documents")
def p10_train_and_test_prompts(spark, sf_dir):
    cursor = prompts.PromptCursor(prompts.prompt_table(spark, prompts.prompts_of([["train a"], ["train b"], ["train c"], ["test d"]])))
    cursor.split_test(0.25)
    docs = read(spark, sf_dir, "documents").select("doc_id")
    first = lambda part, name: cursor.take(docs, 0, part, "doc_id").select("doc_id", F.get("chat_turns", F.lit(0)).alias(name))
    return first("train", "train_turn").join(first("test", "test_turn"), "doc_id")


# Stages


@query()
def s1_filter_stage(spark, sf_dir):
    df = conv_pairs(spark, sf_dir)
    kept, trashed = stages.filter_stage(df, "original", "final_response", [("deviated_words_proportion_quantile", "<=", 0.9), ("is_loose_subset", "==", False)], language=None)
    return joins.union_all(kept.withColumn("rejected_for", F.lit("kept")), trashed).select("row_id", "rejected_for", r6("deviated_words_proportion_quantile").alias("q"))


@query(None)
def s2_generate_stage(spark, sf_dir):
    made = prompts.prompt_table(spark, prompts.prompts_of([["Rewrite: {{DOC}}"], ["Shorten: {{DOC}}", "{{RESP_0}} once more"]]))
    rows = prompts.fill_prompts(joins.assign_prompts(conv_pairs(spark, sf_dir).select("row_id", "original"), made), "original")
    built = stages.build_dataset(rows, 2, models.EchoGenerator)
    kept, trashed, _ = stages.generate_stage(built)
    return joins.union_all(kept.withColumn("rejected_for", F.lit("kept")), trashed).select("row_id", "rejected_for", F.sha2("final_response", 256).alias("response"))


@query()
def s3_distance_stage(spark, sf_dir):
    out = stages.distance_stage(conv_pairs(spark, sf_dir))
    return out.select("row_id", *[r6(c).alias(c) for c in ("jaccard_1", "jaccard_2", "jaccard_3", "levenshtein")])


@query()
def s4_analysis_stage(spark, sf_dir):
    s = scores(spark, sf_dir).select("row_id", "lang", F.when(F.col("is_ai"), F.col("value")).alias("ai_score"), F.when(~F.col("is_ai"), F.col("value")).alias("human_score"))
    out = stages.analysis_stage(s, [{"name": "chars", "columns": [("human_score", False), ("ai_score", True)]}, {"name": "absent", "columns": [("nope", True)]}], subsets={"Lang": F.col("lang")})
    return out.select("classifier", "subset", "n", *[r6(c).alias(c) for c in ("tpr_at_fpr_1pct", "tpr_at_fpr_0_1pct")])

