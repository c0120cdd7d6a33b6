"""Vector expressions over arrays of numbers."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .distance import reduce_chunks
from .text import col, let


def dot(a, b) -> Column:
    products = F.zip_with(col(a), col(b), lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda s, x: s + x)


def cosine_distance(a, b) -> Column:
    """1 - dot, for vectors of unit length."""
    return F.lit(1.0) - dot(a, b)


def cosine_distance_chunked(a, b, operation: str = "max") -> Column:
    """For each vector of b: its distances to all vectors of a, reduced. None in a: 1. Null b: empty."""
    none = F.array().cast("array<array<double>>")
    reduce_chunks(F.array(F.lit(0.0)), operation)

    def told(p: Column) -> Column:
        x, y = p["x"], p["y"]
        return F.transform(y, lambda v: F.when(F.size(x) == 0, F.lit(1.0)).otherwise(reduce_chunks(F.transform(x, lambda u: cosine_distance(u, v)), operation)))

    return let(F.struct(F.coalesce(col(a), none).alias("x"), F.coalesce(col(b), none).alias("y")), told)


def idf_weights(tokens, idf: Column) -> Column:
    """Weights of a text's tokens from a map of IDF values: unknown 0, negative 0, summing to 1; all zero: equal."""

    def scaled(w: Column) -> Column:
        total = F.aggregate(w, F.lit(0.0), lambda s, x: s + x)
        return F.when(total <= 1e-12, F.transform(w, lambda _: F.lit(1.0) / F.size(w))).otherwise(F.transform(w, lambda x: x / total))

    return let(F.transform(col(tokens), lambda t: F.greatest(F.coalesce(F.element_at(idf, t), F.lit(0.0)), F.lit(0.0))), scaled)


def bert_score(source, edit, source_weights: Column | None = None, edit_weights: Column | None = None) -> Column:
    """struct(precision, recall, f1) as distances, of two token matrices; an empty side: 1 each."""
    def best(rows: Column, others: Column) -> Column:
        return F.transform(rows, lambda r: F.array_max(F.transform(others, lambda o: dot(r, o))))

    def mean(values: Column, weights: Column | None) -> Column:
        if weights is None:
            return F.aggregate(values, F.lit(0.0), lambda s, v: s + v) / F.size(values)
        return F.aggregate(F.zip_with(values, weights, lambda v, w: v * w), F.lit(0.0), lambda s, v: s + v)

    def parts(p: Column) -> Column:
        total = p["p"] + p["r"]
        f1 = F.when(total > 0, 2 * p["p"] * p["r"] / total).otherwise(F.lit(0.0))
        return F.struct((1 - p["p"]).alias("precision"), (1 - p["r"]).alias("recall"), (1 - f1).alias("f1"))

    def told(q: Column) -> Column:
        x, y = q["x"], q["y"]
        weights = (None if edit_weights is None else q["wy"], None if source_weights is None else q["wx"])
        empty = (F.coalesce(F.size(x), F.lit(0)) <= 0) | (F.coalesce(F.size(y), F.lit(0)) <= 0)
        made = F.struct(mean(best(y, x), weights[0]).alias("p"), mean(best(x, y), weights[1]).alias("r"))
        return F.when(empty, one).otherwise(let(made, parts))

    one = F.struct(F.lit(1.0).alias("precision"), F.lit(1.0).alias("recall"), F.lit(1.0).alias("f1"))
    fields = [col(source).alias("x"), col(edit).alias("y")]
    fields += [] if source_weights is None else [source_weights.alias("wx")]
    fields += [] if edit_weights is None else [edit_weights.alias("wy")]
    return let(F.struct(*fields), told)


def soft_phrase_distance(source, edit, threshold: float = 0.8) -> Column:
    """1 - the share of edit phrase vectors with a source phrase vector of cosine >= threshold; a side without any: 1."""

    def told(p: Column) -> Column:
        x, y = p["x"], p["y"]
        hits = F.size(F.filter(y, lambda v: F.exists(x, lambda u: dot(u, v) >= threshold)))
        return F.when((F.coalesce(F.size(x), F.lit(0)) <= 0) | (F.coalesce(F.size(y), F.lit(0)) <= 0), F.lit(1.0)).otherwise(1 - hits / F.size(y))

    return let(F.struct(col(source).alias("x"), col(edit).alias("y")), told)
