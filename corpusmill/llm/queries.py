"""The thin queries over the ten operators, and DuckDB SQL where SQL can express them."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from . import bpe, chat, decontaminate, html, langid, minhash, substring, topk, toxicity, urlfilter
from .common import table

RULES = tuple(
    urlfilter.Rule(v, h, p)
    for v, h, p in (
        ("block", "com", "/en/"),
        ("allow", "example.com", "/en/7"),
        ("allow", "net", "/de/"),
        ("block", "example.net", "/de/8"),
        ("block", "org", "/es/"),
    )
)


def remainder(id_col: str, by: int) -> Column:
    """crc32 of the id as text, modulo `by`."""
    return F.crc32(F.col(id_col).cast("string").cast("binary")) % by


def op1_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    return urlfilter.judge_urls(table(spark, sf_dir, "pages"), RULES)


def op2_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.word_repeats(table(spark, sf_dir, "documents"), length=20)


def op3_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html.main_text(table(spark, sf_dir, "pages"))


def op4_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_duplicates(table(spark, sf_dir, "documents"), width=2, percent=80).drop("fp", "copies")


def op5_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contamination(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).drop("items", "fp")


def op6_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    held = F.coalesce(remainder("doc_id", 4) == 2, F.lit(False))
    model = langid.fit(docs.where(~held))
    out = langid.identify(docs.select("doc_id", "text"), model, {"doc_id": "long"})
    return out.select("doc_id", held.alias("held_out"), "lang_pred", "score")


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_documents(table(spark, sf_dir, "documents"))


def toxicity_model(spark: SparkSession, docs: DataFrame, sf_dir: str) -> toxicity.ToxicityModel:
    held = F.coalesce(remainder("doc_id", 5) == 0, F.lit(True))
    return toxicity.fit(table(spark, sf_dir, "labels").where(~held), docs)


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    out = toxicity.score_documents(docs.select("doc_id", "text"), toxicity_model(spark, docs, sf_dir)).select("row.doc_id", "score", "predicted")
    return out.select("doc_id", F.coalesce(remainder("doc_id", 5) == 0, F.lit(True)).alias("held_out"), "score", "predicted")


def op9_exact_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 100 == 0)


def op10_chat_format(spark: SparkSession, sf_dir: str) -> DataFrame:
    own = spark.sql("SELECT * FROM VALUES (-1L, 0L, 'user', '</s>[INST] ok [/INST]'), (-1L, 1L, 'assistant', '</s>[INST] ok [/INST]') AS t(conv_id, turn, role, text)")
    turns = table(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text").unionByName(own)
    out = chat.format_conversations(turns)
    parsed = F.transform(chat.parse(F.col("formatted")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    masked = F.transform("spans", lambda s: chat.unescape_text(F.substr(F.col("formatted"), (s["start"] + 1).cast("int"), (s["end"] - s["start"]).cast("int")), chat.Template()))
    read = out.select("conv", "n_turns", "formatted", "valid", F.size(parsed).cast("long").alias("n_read"), F.array_join(parsed, "").alias("turns"), F.array_join(masked, "").alias("masked"))
    return read.select(
        F.col("conv").alias("conv_id"), F.col("n_read").alias("n_turns"), F.sha2("turns", 256).alias("turns_sha256"), F.char_length("masked").cast("long").alias("loss_chars"), F.sha2("masked", 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"), "valid",
    )


QUERIES = {
    f.__name__: f
    for f in (op1_url_filter, op2_substring_dedup, op3_main_text, op4_near_duplicates, op5_decontamination, op6_language, op7_bpe, op8_toxicity, op9_exact_top_k, op10_chat_format)
}

ORACLES = {
    "op2_substring_dedup": r"""
        WITH w AS (
            SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
        ), win AS (
            SELECT doc_id, unnest(generate_series(1, len(ws) - 19)) AS s, ws FROM w WHERE len(ws) >= 20
        ), keyed AS (
            SELECT doc_id, s, array_to_string(list_slice(ws, s, s + 19), ' ') AS k FROM win
        ), rep AS (
            SELECT doc_id, s FROM (SELECT doc_id, s, row_number() OVER (PARTITION BY k ORDER BY doc_id, s) AS r FROM keyed) WHERE r > 1
        ), gone AS (
            SELECT DISTINCT doc_id, p FROM (SELECT doc_id, unnest(generate_series(s, s + 19)) AS p FROM rep)
        ), kept AS (
            SELECT w.doc_id, string_agg(u.word, ' ' ORDER BY u.p) AS t
            FROM w, LATERAL (SELECT unnest(ws) AS word, unnest(generate_series(1, len(ws))) AS p) AS u
            LEFT JOIN gone ON gone.doc_id = w.doc_id AND gone.p = u.p WHERE gone.p IS NULL GROUP BY w.doc_id
        ), n AS (
            SELECT doc_id, count(*) AS c FROM gone GROUP BY doc_id
        )
        SELECT w.doc_id, len(ws)::BIGINT AS n_words, coalesce(n.c, 0)::BIGINT AS n_removed, sha256(coalesce(kept.t, '')) AS kept_sha256
        FROM w LEFT JOIN n ON n.doc_id = w.doc_id LEFT JOIN kept ON kept.doc_id = w.doc_id""",
    "op4_near_duplicates": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
        ), sh AS (
            SELECT DISTINCT doc_id, k FROM (
                SELECT doc_id, unnest(CASE WHEN len(ws) >= 2 THEN list_transform(generate_series(1, len(ws) - 1), lambda i: ws[i] || ' ' || ws[i + 1]) WHEN len(ws) = 1 THEN ws ELSE [] END) AS k FROM w)
        ), n AS (
            SELECT doc_id, count(*) AS n FROM sh GROUP BY doc_id
        ), pairs AS (
            SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM sh a JOIN sh b ON a.k = b.k AND a.doc_id < b.doc_id GROUP BY ALL
        ), links AS (
            SELECT x, y FROM pairs JOIN n AS nx ON nx.doc_id = x JOIN n AS ny ON ny.doc_id = y WHERE 100 * c >= 80 * (nx.n + ny.n - c)
        ), edges AS (
            SELECT x, y FROM links UNION ALL SELECT y, x FROM links
        ), reach AS (
            SELECT doc_id AS x, doc_id AS y FROM w UNION SELECT reach.x, edges.y FROM reach JOIN edges ON edges.x = reach.y
        ), comp AS (
            SELECT x AS doc_id, min(y) AS component_id FROM reach GROUP BY x
        )
        SELECT w.doc_id, coalesce(n.n, 0)::BIGINT AS n_shingles, component_id, w.doc_id = component_id AS kept
        FROM w JOIN comp ON comp.doc_id = w.doc_id LEFT JOIN n ON n.doc_id = w.doc_id""",
    "op5_decontamination": r"""
        WITH d AS (
            SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM documents
        ), b AS (
            SELECT item_id::VARCHAR AS item, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws FROM benchmark
        ), bw AS (
            SELECT DISTINCT item, n, k FROM (
                SELECT item, least(len(ws), 10) AS n, unnest(list_transform(generate_series(1, greatest(len(ws) - 9, 1)), lambda i: array_to_string(list_slice(ws, i, i + 9), ' '))) AS k FROM b WHERE len(ws) > 0)
        ), sizes AS (
            SELECT DISTINCT n FROM bw
        ), dw AS (
            SELECT doc_id, n, unnest(generate_series(1, len(ws) - n + 1)) AS s, ws FROM d, sizes WHERE len(ws) >= n
        ), hits AS (
            SELECT doc_id, s, x.n, item FROM (SELECT doc_id, n, s, array_to_string(list_slice(ws, s, s + n - 1), ' ') AS k FROM dw) AS x JOIN bw ON bw.k = x.k AND bw.n = x.n
        ), words AS (
            SELECT doc_id, count(DISTINCT p) AS c FROM (SELECT doc_id, unnest(generate_series(s, s + n - 1)) AS p FROM hits) GROUP BY doc_id
        ), items AS (
            SELECT doc_id, count(*) AS c, string_agg(item, ',' ORDER BY item) AS l FROM (SELECT DISTINCT doc_id, item FROM hits) GROUP BY doc_id
        )
        SELECT d.doc_id, len(ws)::BIGINT AS n_words, coalesce(words.c, 0)::BIGINT AS n_hit, coalesce(items.c, 0)::BIGINT AS n_items, sha256(coalesce(items.l, '')) AS items_sha256, words.c IS NOT NULL AS contaminated
        FROM d LEFT JOIN words ON words.doc_id = d.doc_id LEFT JOIN items ON items.doc_id = d.doc_id""",
    "op9_exact_top_k": r"""
        WITH x AS (
            SELECT vec_id, list_transform(embedding, lambda c: floor(1024 * c::DOUBLE)::BIGINT) AS v FROM embeddings
            WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
        ), s AS (
            SELECT q.vec_id AS query_id, x.vec_id, list_dot_product(q.v::DOUBLE[], x.v::DOUBLE[])::BIGINT AS score FROM x AS q, x WHERE q.vec_id % 100 = 0 AND q.vec_id <> x.vec_id AND len(q.v) = len(x.v)
        )
        SELECT query_id, r::INTEGER AS rank, vec_id, score FROM (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM s) WHERE r <= 10""",
    "op10_chat_format": r"""
        WITH t AS (
            SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
            UNION ALL SELECT * FROM (VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]'))
        ), e AS (
            SELECT *, regexp_replace(regexp_replace(text, '(<)(\\*)(/?s>|</?SYS>>|</?ROLE>>|</TURN>>)', '\1\\\2\3', 'g'), '(\[)(\\*)(/?INST\])', '\1\\\2\3', 'g') AS x,
                CASE role WHEN 'system' THEN 15 WHEN 'user' THEN 13 WHEN 'assistant' THEN 7 ELSE 27 + len(role) END AS marks,
                coalesce(lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text), 'START') AS state,
                row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS pos
            FROM t
        )
        SELECT conv_id, count(*)::BIGINT AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY pos)) AS turns_sha256,
            coalesce(sum(len(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars, sha256(coalesce(string_agg(text, '' ORDER BY pos) FILTER (role = 'assistant'), '')) AS loss_sha256,
            sum(len(x) + marks)::BIGINT AS formatted_chars,
            bool_and(state || '>' || role IN ('START>system', 'START>user', 'system>user', 'user>assistant', 'assistant>user')) AND last(role ORDER BY pos) = 'assistant' AS valid
        FROM e GROUP BY conv_id""",
}
