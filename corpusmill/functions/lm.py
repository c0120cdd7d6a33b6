"""Statistics of per-text language-model sums: n, lp, entropy, variance, topp, topk, ce."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import col, let

SUMS = "struct<n:bigint,lp:double,entropy:double,variance:double,topp:double,topk:double,ce:double>"
NAN = float("nan")


def perplexity(s) -> Column:
    """exp(-lp / n); NaN without positions."""
    s = col(s)
    return F.when(s["n"] > 0, F.exp(-s["lp"] / s["n"])).otherwise(F.lit(NAN))


def mean_entropy(s) -> Column:
    s = col(s)
    return F.when(s["n"] > 0, s["entropy"] / s["n"]).otherwise(F.lit(0.0))


def outlier_share(s, field: str) -> Column:
    """Share of positions outside the nucleus (`topp`) or the k likeliest (`topk`)."""
    s = col(s)
    return F.when(s["n"] > 0, s[field] / s["n"]).otherwise(F.lit(NAN))


def curvature(s) -> Column:
    """(lp + entropy) / sqrt(variance); 0 where there is hardly any variance."""
    s = col(s)
    return F.when(s["variance"] > 1e-6, (s["lp"] + s["entropy"]) / F.sqrt(s["variance"])).otherwise(F.lit(0.0))


def cross_ratio(s) -> Column:
    """-lp / ce of the performer's sums; 0 where ce is hardly any."""
    s = col(s)
    return F.when(s["ce"] > 1e-6, -s["lp"] / s["ce"]).otherwise(F.lit(0.0))


METRICS = {"perplexity": perplexity, "entropy": mean_entropy, "topp_outliers": lambda s: outlier_share(s, "topp"), "topk_outliers": lambda s: outlier_share(s, "topk"), "fastdetect": curvature}


def metric_columns(have: list[str], sums: dict[str, list[str]], suffixes: list[str], metrics: tuple[str, ...] = tuple(METRICS), ratio: bool = True) -> dict[str, Column]:
    """Columns `{text}_{metric}{suffix}` for each text's sums per model, and `{text}_ratio` from the second model; names in `have` are skipped."""
    out = {}
    for text, per_model in sums.items():
        for i, s in enumerate(per_model):
            for m in metrics:
                name = f"{text}_{m}{suffixes[i]}"
                if name not in have:
                    out[name] = METRICS[m](s)
        if ratio and len(per_model) > 1 and f"{text}_ratio" not in have:
            out[f"{text}_ratio"] = cross_ratio(per_model[1])
    return out


def graded_score(logits) -> Column:
    """struct(bucket, score) of class logits: likeliest class, and sum of i p_i over the top index (0 for one class)."""

    def soft(x: Column) -> Column:
        e = F.transform(x, lambda v: F.exp(v - F.array_max(x)))
        return F.transform(e, lambda v: v / F.aggregate(e, F.lit(0.0), lambda s, w: s + w))

    def read(p: Column) -> Column:
        mean = F.aggregate(F.transform(p, lambda v, i: v * i), F.lit(0.0), lambda s, v: s + v)
        return F.struct((F.array_position(p, F.array_max(p)) - 1).cast("int").alias("bucket"), F.when(F.size(p) > 1, mean / (F.size(p) - 1)).otherwise(F.lit(0.0)).alias("score"))

    return let(F.transform(col(logits), lambda v: v.cast("double")), lambda x: let(soft(x), read))
