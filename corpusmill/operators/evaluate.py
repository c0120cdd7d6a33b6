"""Detector evaluation over long scores (keys..., is_ai, value): AUROC, operating points, sweeps.

All operators work on all groups of `keys` (classifier, subset) at once. Scores are grouped by value
first; running counts over the distinct values are prefix sums over ranges (see rank.running), so no
task holds all scores of a classifier.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType

from .aggregate import finite
from .rank import running

#: The false-positive budgets of reports.
BUDGETS = {"fpr_1pct": 0.01, "fpr_0_1pct": 0.001}
NAN = float("nan")


def ratio(a, b) -> Column:
    """a / b, 0 where b is 0."""
    return F.coalesce(F.try_divide(F.col(a) if isinstance(a, str) else a, F.col(b) if isinstance(b, str) else b), F.lit(0.0))


def long_scores(df: DataFrame, row: str, sources: Sequence[tuple[str, bool | Column]], classifier: str, extra: Sequence[str] = ()) -> DataFrame:
    """(classifier, row, base, is_ai, value, extra…) of the finite scores in several columns, one branch per column."""
    out = None
    for name, is_ai in sources:
        flag = F.lit(is_ai) if isinstance(is_ai, bool) else is_ai
        part = df.select(F.lit(classifier).alias("classifier"), F.col(row).alias("row_id"), F.lit(name).alias("base"), flag.alias("is_ai"), finite(F.col(name)).alias("value"), *extra)
        out = part if out is None else out.unionByName(part)
    return out.where("value is not null and is_ai is not null")


def value_counts(scores: DataFrame, keys: Sequence[str]) -> DataFrame:
    """(keys, value, ai, human, ai_upto, human_upto, ai_all, human_all) of every distinct score."""
    per = scores.groupBy(*keys, "value").agg(F.count(F.when(F.col("is_ai"), 1)).alias("ai"), F.count(F.when(~F.col("is_ai"), 1)).alias("human"))
    upto = running(per, list(keys), "value", {"ai_upto": F.col("ai"), "human_upto": F.col("human")})
    totals = per.groupBy(*keys).agg(F.sum("ai").alias("ai_all"), F.sum("human").alias("human_all"))
    return upto.join(F.broadcast(totals) if not keys else totals, list(keys)) if keys else upto.crossJoin(F.broadcast(totals))


def auroc(scores: DataFrame, keys: Sequence[str], flip: bool = False) -> DataFrame:
    """(keys, n, auroc): ties count half; NaN with one class only."""
    counts = value_counts(scores, keys)
    won = F.sum(F.col("ai") * (F.col("human_upto") - F.col("human") / 2.0))
    per = counts.groupBy(*keys).agg(won.alias("_won"), F.first("ai_all").alias("_a"), F.first("human_all").alias("_h"))
    area = F.col("_won") / (F.col("_a") * F.col("_h"))
    value = F.when((F.col("_a") > 0) & (F.col("_h") > 0), 1 - area if flip else area).otherwise(F.lit(NAN))
    return per.select(*keys, (F.col("_a") + F.col("_h")).alias("n"), value.alias("auroc"))


def confusion(scores: DataFrame, keys: Sequence[str], flip: bool = False) -> DataFrame:
    """(keys, threshold, tp, fp, tn, fn) at every distinct score."""
    c = value_counts(scores, keys)
    tp, fp = ("ai_upto", "human_upto") if flip else (F.col("ai_all") - F.col("ai_upto"), F.col("human_all") - F.col("human_upto"))
    out = c.select(*keys, F.col("value").alias("threshold"), (F.col(tp) if flip else tp).alias("tp"), (F.col(fp) if flip else fp).alias("fp"), "ai_all", "human_all")
    return out.select(*keys, "threshold", "tp", "fp", (F.col("human_all") - F.col("fp")).alias("tn"), (F.col("ai_all") - F.col("tp")).alias("fn"))


@F.pandas_udf(DoubleType())
def _just_below(v: pd.Series) -> pd.Series:
    return pd.Series(np.nextafter(v.to_numpy(float), -np.inf))


def operating_points(scores: DataFrame, keys: Sequence[str], flip: bool = False, budgets: dict[str, float] = BUDGETS) -> DataFrame:
    """(keys, budget, threshold, tpr, fpr): the exact threshold of each budget, from the distinct scores and one below them.

    Not flipped: the lowest threshold within the budget; flipped: the highest.
    """
    c = confusion(scores, keys, flip).withColumn("tpr", ratio("tp", F.col("tp") + F.col("fn"))).withColumn("fpr", ratio("fp", F.col("fp") + F.col("tn")))
    lowest = c.groupBy(*keys).agg(F.min("threshold").alias("_min"), F.first(F.col("tp") + F.col("fn")).alias("_a"), F.first(F.col("fp") + F.col("tn")).alias("_h"))
    # One candidate below all scores: nothing lies below it.
    under = lowest.select(*keys, _just_below("_min").alias("threshold"), F.lit(0.0).alias("tpr") if flip else F.when(F.col("_a") > 0, 1.0).otherwise(0.0).alias("tpr"), F.lit(0.0).alias("fpr") if flip else F.when(F.col("_h") > 0, 1.0).otherwise(0.0).alias("fpr"))
    every = c.select(*keys, "threshold", "tpr", "fpr").unionByName(under)
    out = None
    for name, budget in budgets.items():
        point = F.struct("threshold", "tpr", "fpr")
        picked = every.where(F.col("fpr") <= budget).groupBy(*keys).agg((F.max(point) if flip else F.min(point)).alias("p"))
        part = picked.select(*keys, F.lit(name).alias("budget"), "p.threshold", "p.tpr", "p.fpr")
        out = part if out is None else out.unionByName(part)
    return out


def called(threshold: Column, flip: bool) -> Column:
    return F.col("value") <= threshold if flip else F.col("value") > threshold


def classifier_metrics(scores: DataFrame, keys: Sequence[str], threshold: float, flip: bool = False) -> DataFrame:
    """Counts and rates at a fixed threshold."""
    hit = called(F.lit(threshold), flip)
    n = lambda c: F.count(F.when(c, 1))
    per = scores.groupBy(*keys).agg(F.count(F.lit(1)).alias("n"), n(hit & F.col("is_ai")).alias("tp"), n(hit & ~F.col("is_ai")).alias("fp"), n(~hit & ~F.col("is_ai")).alias("tn"), n(~hit & F.col("is_ai")).alias("fn"))
    return with_rates(per)


def with_rates(per: DataFrame) -> DataFrame:
    """Adds precision, recall, f1, fpr, tnr, fnr and accuracy to confusion counts."""
    tp, fp, tn, fn = map(F.col, ("tp", "fp", "tn", "fn"))
    precision, recall = ratio(tp, tp + fp), ratio(tp, tp + fn)
    return per.select("*", precision.alias("precision"), recall.alias("recall"), ratio(2 * precision * recall, precision + recall).alias("f1"), ratio(fp, fp + tn).alias("fpr"), ratio(tn, fp + tn).alias("tnr"), ratio(fn, tp + fn).alias("fnr"), ratio(tp + tn, tp + fp + tn + fn).alias("accuracy"))


def report(scores: DataFrame, keys: Sequence[str], subset: str, flip: bool = False, budgets: dict[str, float] = BUDGETS) -> DataFrame:
    """(keys, subset, n, auroc, tpr_at_…) of every subset at the thresholds fitted on all rows of the keys."""
    points = operating_points(scores, keys, flip, budgets).groupBy(*keys).pivot("budget", list(budgets)).agg(F.first("threshold"))
    points = points.select(*keys, *[F.col(b).alias(f"_{b}") for b in budgets])
    # One row per group of keys, with fixed columns.
    with_points = scores.join(F.broadcast(points), list(keys)) if keys else scores.crossJoin(F.broadcast(points))
    rates = with_points.groupBy(*keys, subset).agg(*[ratio(F.count(F.when(F.col("is_ai") & called(F.col(f"_{b}"), flip), 1)), F.count(F.when(F.col("is_ai"), 1))).alias(f"tpr_at_{b}") for b in budgets])
    return auroc(scores, [*keys, subset], flip).join(rates, [*keys, subset])


def grid(df: DataFrame, lo: Column, hi: Column, steps: int) -> Column:
    """steps evenly spaced values from lo to hi, with their numbers."""
    return F.transform(F.sequence(F.lit(0), F.lit(steps - 1)), lambda i: F.struct(i.alias("step"), (lo + (hi - lo) * i / (steps - 1)).alias("at")))


def sweep(scores: DataFrame, keys: Sequence[str], flip: bool = False, steps: int = 240) -> DataFrame:
    """(keys, step, threshold, tpr, fpr) on an even grid between the extreme scores.

    Every score is dealt to the grid step that first includes it, so running counts go over `steps`
    rows per group.
    """
    ends = scores.groupBy(*keys).agg(F.min("value").alias("_lo"), F.max("value").alias("_hi"))
    pad = F.when(F.col("_lo") == F.col("_hi"), F.abs("_lo") * 1e-6 + 1e-6).otherwise(0.0)
    steps_of = ends.select(*keys, F.inline(grid(ends, F.col("_lo") - pad, F.col("_hi") + pad, steps)))
    bounds = ends.select(*keys, (F.col("_lo") - pad).alias("_lo"), (F.col("_hi") + pad).alias("_hi"))
    at = lambda i: F.col("_lo") + (F.col("_hi") - F.col("_lo")) * i / (steps - 1)
    dealt = (scores.join(F.broadcast(bounds), list(keys)) if keys else scores.crossJoin(F.broadcast(bounds)))
    # The guess can be one off by rounding; the comparison with the grid itself decides.
    guess = F.ceil((F.col("value") - F.col("_lo")) / (F.col("_hi") - F.col("_lo")) * (steps - 1)).cast("int")
    dealt = dealt.withColumn("_g", F.greatest(guess - 1, F.lit(0)))
    step = F.when(F.col("value") <= at(F.col("_g")), F.col("_g")).when(F.col("value") <= at(F.col("_g") + 1), F.col("_g") + 1).otherwise(F.col("_g") + 2)
    per = dealt.groupBy(*keys, F.least(step, F.lit(steps - 1)).alias("step")).agg(F.count(F.when(F.col("is_ai"), 1)).alias("ai"), F.count(F.when(~F.col("is_ai"), 1)).alias("human"))
    from pyspark.sql import Window

    w = Window.partitionBy(*keys).orderBy("step").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    whole = Window.partitionBy(*keys)
    joined = steps_of.join(per, [*keys, "step"], "left").select(*keys, "step", F.col("at").alias("threshold"), F.coalesce(F.sum("ai").over(w), F.lit(0)).alias("a"), F.coalesce(F.sum("human").over(w), F.lit(0)).alias("h"), F.sum("ai").over(whole).alias("aa"), F.sum("human").over(whole).alias("hh"))
    tpr, fpr = ratio("a", "aa"), ratio("h", "hh")
    return joined.select(*keys, "step", "threshold", (tpr if flip else F.when(F.col("aa") > 0, 1 - tpr).otherwise(0.0)).alias("tpr"), (fpr if flip else F.when(F.col("hh") > 0, 1 - fpr).otherwise(0.0)).alias("fpr"))


def tpr_by_min_distance(ai_scores: DataFrame, distance: str, thresholds: dict[str, float], flip: bool = False, steps: int = 160, min_kept: int = 25) -> DataFrame:
    """(step, cutoff, kept, one TPR per threshold) as AI rows nearer than a rising cutoff are dropped."""
    rows = ai_scores.select("value", finite(F.col(distance)).alias("d")).where("d is not null")
    least = rows.orderBy(F.desc("d")).limit(min_kept).agg(F.min("d").alias("_hi"))
    ends = rows.agg(F.least(F.lit(0.0), F.min("d")).alias("_lo")).crossJoin(least).where("_hi is not null")
    steps_of = ends.select("_lo", "_hi", F.inline(grid(ends, F.col("_lo"), F.col("_hi"), steps)))
    width = F.col("_hi") - F.col("_lo")
    at = lambda i: F.col("_lo") + width * i / (steps - 1)
    # The last step whose cutoff is not above the row's distance.
    guess = F.when(width > 0, F.floor((F.col("d") - F.col("_lo")) / width * (steps - 1)).cast("int")).otherwise(steps - 1)
    dealt = rows.crossJoin(F.broadcast(ends)).withColumn("_g", F.least(F.greatest(guess + 1, F.lit(0)), F.lit(steps - 1)))
    step = F.when(F.col("d") >= at(F.col("_g")), F.col("_g")).when(F.col("d") >= at(F.col("_g") - 1), F.col("_g") - 1).otherwise(F.col("_g") - 2)
    per = dealt.groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n"), *[F.count(F.when(called(F.lit(t), flip), 1)).alias(f"_{name}") for name, t in thresholds.items()])
    from pyspark.sql import Window

    tail = Window.orderBy(F.desc("step")).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    joined = steps_of.join(per, "step", "left").select("step", F.col("at").alias("cutoff"), F.coalesce(F.sum("n").over(tail), F.lit(0)).alias("kept"), *[F.coalesce(F.sum(f"_{n}").over(tail), F.lit(0)).alias(f"_{n}") for n in thresholds])
    return joined.select("step", "cutoff", "kept", *[ratio(f"_{n}", "kept").alias(n) for n in thresholds])


def histogram(df: DataFrame, series: str, value: str, bins: int = 70) -> DataFrame:
    """(series, bin, centre, density, smooth): densities on bins shared by all series, and their Gaussian 9-point mean."""
    rows = df.select(F.col(series).alias("series"), finite(F.col(value)).alias("v")).where("v is not null")
    ends = rows.agg(F.min("v").alias("_lo"), F.max("v").alias("_hi"))
    pad = F.when(F.col("_lo") == F.col("_hi"), F.abs("_lo") * 1e-6 + 1e-6).otherwise(0.0)
    ends = ends.select((F.col("_lo") - pad).alias("_lo"), (F.col("_hi") + pad).alias("_hi"))
    size = (F.col("_hi") - F.col("_lo")) / bins
    binned = rows.crossJoin(F.broadcast(ends)).groupBy("series", F.least(F.floor((F.col("v") - F.col("_lo")) / size).cast("int"), F.lit(bins - 1)).alias("bin")).agg(F.count(F.lit(1)).alias("n"))
    every = rows.groupBy("series").agg(F.count(F.lit(1)).alias("_all")).crossJoin(F.broadcast(ends)).select("*", F.explode(F.sequence(F.lit(0), F.lit(bins - 1))).alias("bin"))
    full = every.join(binned, ["series", "bin"], "left").select("series", "bin", (F.col("_lo") + size * (F.col("bin") + 0.5)).alias("centre"), (F.coalesce("n", F.lit(0)) / (F.col("_all") * size)).alias("density"))
    weights = np.exp(-0.5 * (np.arange(-4, 5) / 1.35) ** 2)
    weights = (weights / weights.sum()).tolist()
    lists = full.groupBy("series").agg(F.array_sort(F.collect_list(F.struct("bin", "centre", "density"))).alias("b"))
    edge = lambda b, i: F.get(b, F.least(F.greatest(i, F.lit(0)), F.lit(bins - 1)))["density"]
    smooth = lambda b, i: sum((edge(b, i + k - 4) * w for k, w in enumerate(weights)), F.lit(0.0))
    return lists.select("series", F.inline(F.transform("b", lambda x, i: F.struct(x["bin"].alias("bin"), x["centre"].alias("centre"), x["density"].alias("density"), smooth(F.col("b"), i).alias("smooth")))))


def score_grids(scores: DataFrame, labels: DataFrame, row_group: str, column_group: str) -> DataFrame:
    """(panel, row_group, column_group, mean): human, AI and |AI - human| means with marginals."""
    from .aggregate import class_means, group_grid

    rows = labels.join(class_means(scores), "row_id", "left")
    panels = {"human": F.col("human_mean"), "ai": F.col("ai_mean"), "difference": F.abs(F.col("ai_mean") - F.col("human_mean"))}
    out = None
    for name, value in panels.items():
        part = group_grid(rows, value, row_group, column_group).withColumn("panel", F.lit(name))
        out = part if out is None else out.unionByName(part)
    return out


def leaderboard(reports: DataFrame, name: str = "classifier") -> DataFrame:
    """Best AUROC first, undefined ones last, then by name."""
    return reports.orderBy(F.when(F.isnan("auroc"), F.lit(None)).otherwise(F.col("auroc")).desc_nulls_last(), name)


def hardest_subset(reports: DataFrame, subset: str, tpr: str) -> DataFrame:
    """The subset whose best detector does worst; ties by label."""
    return reports.groupBy(subset).agg(F.max(tpr).alias(tpr)).orderBy(tpr, subset).limit(1)


def best_and_worst(reports: DataFrame, keys: Sequence[str], subset: str, value: str) -> DataFrame:
    return reports.groupBy(*keys).agg(F.max_by(subset, value).alias("best"), F.min_by(subset, value).alias("worst"))


def prompt_order(table: DataFrame, message: str, first: str = "tpr_at_fpr_1pct", second: str = "tpr_at_fpr_0_1pct", most: int | None = None) -> DataFrame:
    """Prompts that are hardest to detect first; undefined rates last."""
    known = lambda c: F.when(F.isnan(c), F.lit(None)).otherwise(F.col(c))
    out = table.orderBy(known(first).asc_nulls_last(), known(second).asc_nulls_last(), message)
    return out if most is None else out.limit(most)
