"""The training-data pipeline: toxicity, near-duplicates, repeated passages, benchmark passages, BPE.

Every stage takes all that its predecessor kept. The first four return the columns of documents:
toxic documents go; of each group of near-duplicates (five-word shingles, similarity 0.8) the one of
smallest id stays; passages of 50 words and more that stand earlier in the corpus are cut from the
text (a document that consists of them goes); documents with benchmark passages go. The last
returns the token ids.

Defined cases, in every stage: rows travel in one struct, so extra columns of any name pass through; null ids
are an id that sorts last; an empty table gives no rows. What a stage does with null texts and repeats
stands in its docstring.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusmill.llm import bpe, decontaminate, minhash, substring, toxicity
from corpusmill.llm.common import KEYS, documents_keyed, shared_table, table
from corpusmill.llm.queries import toxicity_model

PASSAGE_WORDS = 50


def unwrap(rows: DataFrame, columns: list[str]) -> DataFrame:
    """The input rows that travelled in the struct `row`."""
    return rows.select(*[F.col(f"row.`{c}`").alias(c) for c in columns])


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the votes do not call toxic. Null and empty texts have no votes and the base rate, so they stay."""
    scored = toxicity.score_documents(docs, toxicity_model(spark, docs, sf_dir))
    return unwrap(scored.where("predicted = 0"), docs.columns)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first document, by id and text, of each group. Texts that share an id but nothing else stay, each; of equal rows one."""
    found = minhash.near_duplicates(docs, width=5, percent=80)
    key = F.coalesce(F.col("doc_id"), F.lit(minhash.NO_ID)).alias("k")
    gone = found.where(~F.col("kept")).select(key, "fp").distinct()
    several = found.where(F.col("kept") & (F.col("copies") > 1)).select(key, "fp").distinct()
    rows = documents_keyed(docs).select(*KEYS, "row").join(gone, KEYS, "left_anti")
    one_of = rows.join(several, KEYS, "left_semi").groupBy(*KEYS).agg(F.min_by("row", F.to_json("row")).alias("row"))
    return unwrap(rows.join(several, KEYS, "left_anti").unionByName(one_of), docs.columns)


def cut_repeated_passages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the passages that stand earlier in the corpus; null and blank texts stay as they are."""
    cut = substring.remove_repeats(docs, length=PASSAGE_WORDS).where("has_words or n_removed = 0")
    new = {"text": F.when(F.col("n_removed") > 0, F.col("text")).otherwise(F.col("row.text"))}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.col("n_removed") > 0, F.char_length("text").cast(docs.schema["n_chars"].dataType)).otherwise(F.col("row.n_chars"))
    return cut.select(*[new.get(c, F.col(f"row.`{c}`")).alias(c) for c in docs.columns])


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without any benchmark passage. Rows of one id are told apart by their texts."""
    bad = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark")).where("contaminated").select(F.coalesce("doc_id", F.lit(minhash.NO_ID)).alias("k"), "fp").distinct()
    return unwrap(documents_keyed(docs).select(*KEYS, "row").join(bad, KEYS, "left_anti"), docs.columns)


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, lang, source and the token ids of every row; null text has none."""
    return bpe.encode_documents(docs, id_cols={"doc_id": "long", "lang": "string", "source": "string"}, with_ids=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("minhash near-dedup", drop_near_duplicates),
    ("substring dedup", cut_repeated_passages),
    ("benchmark decontamination", drop_contaminated),
    ("bpe", encode),
]

#: Toxicity votes of a fitted model and BPE have no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for i, (name, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if i < len(STAGES) - 1:
            docs = shared_table(docs, f"pipeline-{i}")
    return docs
