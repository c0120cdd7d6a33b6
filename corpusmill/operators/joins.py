"""Joins by position, cursor and key that align a corpus with prompts, results and logs."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

#: Prompt sets up to so many rows are broadcast.
BROADCAST_ROWS = 200_000


def small(df: DataFrame, rows: int | None = None) -> DataFrame:
    """Broadcasts a table whose size was checked; larger ones are left to the planner."""
    rows = df.count() if rows is None else rows
    return F.broadcast(df) if rows <= BROADCAST_ROWS else df


def by_position(left: DataFrame, right: DataFrame, key: str = "row_id") -> DataFrame:
    """Aligned columns of two tables; rows that one side lacks go."""
    return left.join(right, key)


def assign_prompts(rows: DataFrame, prompts: DataFrame, key: str = "row_id", offset: int = 0, pos: str = "prompt_pos") -> DataFrame:
    """Row r takes prompt (offset + r) mod their number."""
    n = prompts.count()
    if not n:
        raise ValueError("no prompts")
    return rows.withColumn(pos, F.pmod(F.col(key) + offset, F.lit(n)).cast("long")).join(small(prompts.withColumn(pos, F.col(pos).cast("long")), n), pos)


def pending(rows: DataFrame, log: DataFrame, key: str = "row_id") -> DataFrame:
    """Rows without a record in the log."""
    return rows.join(log.select(key).distinct(), key, "left_anti")


def scatter_results(rows: DataFrame, results: DataFrame, key: str = "row_id", order: str = "received", missing: str = "no result returned") -> DataFrame:
    """Results back on their rows: the first of several wins, a missing one is an error."""
    first = results.withColumn("_r", F.row_number().over(Window.partitionBy(key).orderBy(order))).where("_r = 1").drop("_r", order)
    out = rows.join(first, key, "left")
    return out.withColumn("error", F.when(F.col("text").isNull() & F.col("error").isNull(), F.lit(missing)).otherwise(F.col("error"))).withColumn("text", F.coalesce("text", F.lit("")))


def rejected(everything: DataFrame, kept: DataFrame, key: str = "row_index") -> DataFrame:
    """All rows less the kept ones."""
    return everything.join(kept.select(key), key, "left_anti")


def token_weights(tokens: DataFrame, idf: DataFrame, token: str = "token") -> DataFrame:
    """IDF of each token row; unknown ones weigh 0."""
    return tokens.join(idf, token, "left").withColumn("idf", F.coalesce("idf", F.lit(0.0)))


def embed_once(phrases: DataFrame, embedded: DataFrame, phrase: str = "phrase") -> DataFrame:
    """Vectors of distinct phrases back on all their occurrences."""
    return phrases.join(embedded, phrase)


def union_all(*tables: DataFrame) -> DataFrame:
    """All rows of tables whose columns may differ."""
    out = tables[0]
    for t in tables[1:]:
        out = out.unionByName(t, allowMissingColumns=True)
    return out
