"""Positions, ranks and normalisations without a single-task window over all rows.

`running` computes prefix sums: rows are dealt to ranges of the order column, windows run inside the
ranges, and the ranges' totals (one row each) give the offsets.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.text import as_text, squeeze


def _ranges(df: DataFrame, order: str, parts: int | None) -> Column:
    """Number of the range of `order` a row falls in; 0 for null and NaN."""
    parts = parts or int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    probs = [i / parts for i in range(1, parts)]
    # The error follows the number of ranges, so that many ranges can be told apart.
    bounds = sorted(set(df.where(F.col(order).isNotNull()).approxQuantile(order, probs, min(0.01, 1 / (4 * parts))))) if probs else []
    bounds = [b for b in bounds if b == b]
    if not bounds:
        return F.lit(0)
    c = F.col(order)
    # A tree of comparisons: log2(parts) per row.

    def tree(lo: int, hi: int) -> Column:
        if lo == hi:
            return F.lit(lo)
        mid = (lo + hi) // 2
        return F.when(c <= F.lit(bounds[mid]), tree(lo, mid)).otherwise(tree(mid + 1, hi))

    return tree(0, len(bounds))


def running(df: DataFrame, keys: Sequence[str], order: str, sums: dict[str, Column], parts: int | None = None, descending: bool = False) -> DataFrame:
    """Adds running sums in order of a numeric column whose values are distinct within the keys."""
    dealt = df.withColumn("_range", _ranges(df, order, parts))
    inner = Window.partitionBy(*keys, "_range").orderBy(F.desc(order) if descending else F.col(order)).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    totals = dealt.groupBy(*keys, "_range").agg(*[F.sum(c).alias(f"_t_{n}") for n, c in sums.items()])
    before = Window.partitionBy(*keys).orderBy(F.desc("_range") if descending else F.col("_range")).rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(*keys, "_range", *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_o_{n}") for n in sums])
    marked = dealt.select("*", *[F.sum(c).over(inner).alias(f"_r_{n}") for n, c in sums.items()])
    cond = [F.col(f"m.{k}").eqNullSafe(F.col(f"o.{k}")) for k in [*keys, "_range"]]
    joined = marked.alias("m").join(F.broadcast(offsets.alias("o")) if not keys else offsets.alias("o"), cond)
    return joined.select(*[F.col(f"m.{c}").alias(c) for c in df.columns], *[(F.col(f"m._r_{n}") + F.col(f"o._o_{n}")).alias(n) for n in sums])


def row_positions(df: DataFrame, order: str, name: str = "row_index") -> DataFrame:
    """0, 1, 2, … in order of a numeric column of distinct values."""
    return running(df, [], order, {name: F.lit(1)}).withColumn(name, (F.col(name) - 1).cast("long"))


#: Up to so many first rows are taken by a bounded heap per task; more by their positions.
HEAP_ROWS = 100_000


def first_rows(df: DataFrame, order: str, rows: int) -> DataFrame:
    """The first rows in order of a numeric column of distinct values."""
    if rows <= HEAP_ROWS:
        return df.orderBy(order).limit(rows)
    return row_positions(df, order, "_pos").where(F.col("_pos") < rows).drop("_pos")


def quantile(df: DataFrame, value: str, name: str, keys: Sequence[str] = ()) -> DataFrame:
    """Average rank over number of rows: in (0, 1], ties share; a single row gets 1. Null values get null.

    Equal values are counted first, so the ranked rows are the distinct values only.
    """
    counts = df.where(F.col(value).isNotNull()).groupBy(*keys, value).agg(F.count(F.lit(1)).alias("_n"))
    upto = running(counts, list(keys), value, {"_upto": F.col("_n")})
    totals = counts.groupBy(*keys).agg(F.sum("_n").alias("_all"))
    ranked = upto.join(totals, list(keys)) if keys else upto.crossJoin(F.broadcast(totals))
    rank = ranked.select(*keys, value, ((2 * (F.col("_upto") - F.col("_n")) + 1 + F.col("_n")) / (2.0 * F.col("_all"))).alias(name))
    return df.join(rank, [*keys, value], "left").select(*df.columns, name)


def min_max(df: DataFrame, value: str, name: str) -> DataFrame:
    """(v - min) / (max - min); 0 where all are equal. The extremes are one broadcast row."""
    ends = df.agg(F.min(value).cast("double").alias("_lo"), F.max(value).cast("double").alias("_hi"))
    out = F.when(F.col("_hi") > F.col("_lo"), (F.col(value) - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))).when(F.col(value).isNotNull(), F.lit(0.0))
    return df.crossJoin(F.broadcast(ends)).withColumn(name, out).drop("_lo", "_hi")


def chunk_quantile(df: DataFrame, key: str, values: str, name: str) -> DataFrame:
    """`quantile` pooled over the arrays of all rows, in their shape; `key` is unique."""
    each = df.select(key, F.posexplode(values).alias("_pos", "_v"))
    ranked = quantile(each, "_v", "_q").groupBy(key).agg(F.transform(F.array_sort(F.collect_list(F.struct("_pos", "_q"))), lambda x: x["_q"]).alias(name))
    return df.join(ranked, key, "left").withColumn(name, F.coalesce(name, F.when(F.col(values).isNotNull(), F.array().cast("array<double>"))))


def chunk_min_max(df: DataFrame, values: str, name: str) -> DataFrame:
    """`min_max` pooled over the arrays of all rows."""
    ends = df.agg(F.min(F.array_min(values)).cast("double").alias("_lo"), F.max(F.array_max(values)).cast("double").alias("_hi"))
    out = F.transform(values, lambda v: F.when(F.col("_hi") > F.col("_lo"), (v - F.col("_lo")) / (F.col("_hi") - F.col("_lo"))).otherwise(F.lit(0.0)))
    return df.crossJoin(F.broadcast(ends)).withColumn(name, out).drop("_lo", "_hi")


def mark_duplicates(df: DataFrame, text: str, order: str, group: str | None = None, name: str = "is_duplicate") -> DataFrame:
    """True for every repeat of a text (case and white space aside), in its group; the first by `order` stays.

    The first place of each text comes from a partial minimum on a 128-bit digest, so a text that a
    third of the rows repeat does not gather in one task; digests join back to the rows.
    """
    normal = F.lower(squeeze(as_text(text)))
    marked = df.withColumn("_key", F.md5(F.concat(F.lit("" if group is None else "g"), F.coalesce(F.col(group).cast("string"), F.lit("")) if group else F.lit(""), F.lit("\x00"), normal)))
    first = marked.groupBy("_key").agg(F.min(order).alias("_first"))
    return marked.join(first, "_key").withColumn(name, F.col(order) > F.col("_first")).select(*df.columns, name)


def ranked(df: DataFrame, *order: Column, name: str = "rank") -> DataFrame:
    """1, 2, 3, … of a report's rows (few: one task)."""
    return df.withColumn(name, F.row_number().over(Window.orderBy(*order)))
