"""Aggregations of corpora and of statistic columns."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Iterable, Iterator, Sequence
from itertools import combinations_with_replacement

import numpy as np
import pyarrow as pa
from pyspark import StorageLevel
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.clean import message_lines
from ..functions.text import as_text
from .joins import BROADCAST_ROWS

NAN = float("nan")


def finite(c: Column) -> Column:
    """The value as double, or null where it is null, NaN or infinite."""
    d = c.cast("double")
    return F.when(~F.isnan(d) & (F.abs(d) != float("inf")), d)


#: Rows whose texts a worker takes up at once; grams and characters of text after which it hands counts on.
SLICE_ROWS, FLUSH_GRAMS, FLUSH_CHARS = 500, 50_000, 1 << 22
#: So many times both for counts over many texts, where longer pieces repeat more.
PIECES = 4
#: Bytes of keys up to which a table of keys is broadcast.
BROADCAST_KEY_BYTES = 1 << 23


def texts_of(column: pa.Array) -> list[str]:
    """The texts of a string column, null as empty; bytes that are no UTF-8 become replacement characters."""
    try:
        return [t or "" for t in column.to_pylist()]
    except UnicodeDecodeError:
        return [(t or b"").decode(errors="replace") for t in column.cast(pa.large_binary() if pa.types.is_large_string(column.type) else pa.binary()).to_pylist()]


def grams_of(w: list[str], n: int) -> Iterable[str]:
    """text.grams of a list of words."""
    return w if n == 1 else map(" ".join, zip(*(w[i:] for i in range(n)), strict=False))


def row_ngrams(df: DataFrame, key: str, text: str, n: int) -> DataFrame:
    """(key, gram, n): word n-grams of each row, counted before they leave it."""
    kind = T.StructType([T.StructField(key, df.schema[key].dataType), T.StructField("gram", T.StringType()), T.StructField("n", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for start in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(start, SLICE_ROWS)
                at, grams, counts, chars = [], [], [], 0

                def made(at: list[int], grams: list[str], counts: list[int], keys: pa.Array = batch.column(0)) -> Iterator[pa.RecordBatch]:
                    for i in range(0, len(grams), FLUSH_GRAMS):
                        yield pa.RecordBatch.from_arrays([keys.take(pa.array(at[i : i + FLUSH_GRAMS], pa.int32())), pa.array(grams[i : i + FLUSH_GRAMS], pa.string()), pa.array(counts[i : i + FLUSH_GRAMS], pa.int64())], [key, "gram", "n"])

                for i, t in enumerate(texts_of(batch.column(1))):
                    c = Counter(grams_of(t.split(), n))
                    at += [i] * len(c)
                    grams += c
                    counts += c.values()
                    chars += len(t)
                    if len(grams) >= FLUSH_GRAMS or chars >= FLUSH_CHARS:
                        yield from made(at, grams, counts)
                        at, grams, counts, chars = [], [], [], 0
                yield from made(at, grams, counts)

    return df.select(key, as_text(text).alias("_text")).mapInArrow(run, kind)


def global_ngrams(df: DataFrame, text: str, n: int) -> DataFrame:
    """(gram, n): word n-grams over all texts, counted within pieces of a task's rows first.

    From two words on, the workers' counts stand for the partial aggregation: such grams hardly repeat beyond them and are
    dealt out at once.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts, chars = Counter(), 0
        made = lambda c: pa.RecordBatch.from_arrays([pa.array(list(c), pa.string()), pa.array(list(c.values()), pa.int64())], ["gram", "n"])
        for whole in batches:
            for start in range(0, whole.num_rows, SLICE_ROWS):
                for t in texts_of(whole.column(0).slice(start, SLICE_ROWS)):
                    counts.update(grams_of(t.split(), n))
                    chars += len(t)
                    if len(counts) >= PIECES * FLUSH_GRAMS or chars >= PIECES * FLUSH_CHARS:
                        yield made(counts)
                        counts, chars = Counter(), 0
        if counts:
            yield made(counts)

    counted = df.select(as_text(text).alias("_text")).mapInArrow(run, "gram string, n bigint")
    return (counted if n == 1 else counted.repartition("gram")).groupBy("gram").agg(F.sum("n").alias("n"))


def text_ngrams(df: DataFrame, key: str, text: str, n: int) -> DataFrame:
    """(key, gram, n): word n-grams of each text; the texts of a repeated key count as one.

    Only the grams of repeated keys are grouped across rows, so a table of unique keys is not shuffled by its grams.
    """
    repeated = df.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(key)
    size = repeated.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length(F.col(key).cast("string"))), F.lit(0)).alias("bytes")).first()
    if not size["n"]:
        return row_ngrams(df, key, text, n)
    if size["n"] > BROADCAST_ROWS or size["bytes"] > BROADCAST_KEY_BYTES:
        return row_ngrams(df, key, text, n).groupBy(key, "gram").agg(F.sum("n").alias("n"))
    again = F.broadcast(repeated.withColumnRenamed(key, "_key"))
    same = F.col(key).eqNullSafe(F.col("_key"))
    more = row_ngrams(df.join(again, same, "left_semi"), key, text, n).groupBy(key, "gram").agg(F.sum("n").alias("n"))
    return row_ngrams(df.join(again, same, "left_anti"), key, text, n).unionByName(more)


#: Up to so many of the most frequent words, of up to so many bytes each, go to every worker.
COMMON_WORDS, COMMON_BYTES = 100_000, 64


def common_words(model: DataFrame, total: int, hot: int) -> Column:
    """Whether a word of the model (gram, n) is common: in the most frequent of COMMON_WORDS, by steps of a factor 2**(1/8)
    of the count, or one of the fewer than `hot` words with more than 1/hot of all occurrences."""
    step = F.floor(F.log2(F.col("n").cast("double")) * 8)
    short = F.octet_length("gram") <= COMMON_BYTES
    least, words = None, 0
    for r in sorted(model.where(short).groupBy(step.alias("step")).agg(F.count(F.lit(1)).alias("n")).collect(), reverse=True):
        words += r["n"]
        if words > COMMON_WORDS:
            break
        least = r["step"]
    frequent = F.col("n") * hot > total
    return frequent if least is None else frequent | (short & (step >= least))


def unigram_sums(df: DataFrame, text: str, out: str, hot: int = 1000, keep: Sequence[str] | None = None) -> DataFrame:
    """Adds struct(n, lp, entropy, variance): sums of the unigram model of all words of `text`, over every word but a text's first.

    The model stays a table. Its common words (common_words) go to every worker, which sums them up within each row;
    the other words of a row leave it counted and are joined to the model, so texts are not shuffled. `keep`: the columns
    of the result besides (all, if None). As in models.UnigramScorer, one more occurrence stands for unknown words.
    """
    keep = list(df.columns if keep is None else keep)
    model = global_ngrams(df, text, 1).persist(StorageLevel.DISK_ONLY)
    log = F.log(F.col("n").cast("double"))
    sums = model.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("n"), *[F.coalesce(F.sum(F.col("n") * x), F.lit(0.0)).alias(k) for k, x in (("x", log), ("xx", log * log))]).first()
    total = sums["n"] + 1
    unknown = -math.log(total)
    mean = (sums["x"] + unknown * sums["n"] + unknown) / total
    square = (sums["xx"] + 2 * unknown * sums["x"] + unknown**2 * sums["n"] + unknown**2) / total
    entropy, variance = -mean, max(0.0, square - mean**2)

    is_common = common_words(model, sums["n"], hot)
    known = df.sparkSession.sparkContext.broadcast({r["gram"]: math.log(r["n"]) + unknown for r in model.where(is_common).collect()})
    kind = T.StructType([*(df.schema[c] for c in keep), *T._parse_datatype_string("_words bigint, _lp double, _rest array<struct<gram:string,c:bigint>>")])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lp_of = known.value.get
        for whole in batches:
            for start in range(0, whole.num_rows, SLICE_ROWS):
                batch = whole.slice(start, SLICE_ROWS)
                words, lps, ends, grams, counts = [], [], [0], [], []
                for t in texts_of(batch.column(len(keep))):
                    w, lp = t.split(), 0.0
                    words.append(max(0, len(w) - 1))
                    for gram, c in Counter(w[1:]).items():
                        x = lp_of(gram)
                        if x is None:
                            grams.append(gram)
                            counts.append(c)
                        else:
                            lp += c * x
                    lps.append(lp)
                    ends.append(len(grams))
                rest = pa.StructArray.from_arrays([pa.array(grams, pa.string()), pa.array(counts, pa.int64())], ["gram", "c"])
                made = [pa.array(words, pa.int64()), pa.array(lps, pa.float64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), rest)]
                yield pa.RecordBatch.from_arrays([*batch.columns[: len(keep)], *made], kind.names)

    rows = df.select(*keep, as_text(text).alias("_text")).mapInArrow(run, kind).withColumn("_row", F.monotonically_increasing_id()).persist(StorageLevel.DISK_ONLY)
    rest = rows.select("_row", F.inline("_rest")).join(model.where(~is_common), "gram")
    lp = rest.groupBy("_row").agg(F.sum(F.col("c") * (log + unknown)).alias("_rest_lp"))
    n = F.col("_words")
    made = F.struct(n.alias("n"), (F.col("_lp") + F.coalesce("_rest_lp", F.lit(0.0))).alias("lp"), (n * entropy).alias("entropy"), (n * variance).alias("variance"))
    return rows.drop("_rest").join(lp, "_row", "left").withColumn(out, made).drop("_row", "_words", "_lp", "_rest_lp")


#: Bits of a double by which one pass of `medians` splits a range: up to 2**DIGIT rows a column and task leave it.
DIGIT = 12


def digits_of(values: np.ndarray, shift: int) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of finite doubles: the bits from `shift` on of their order-preserving integers that occur (with all higher ones),
    and for each the number, least and greatest of its values."""
    v = np.sort(values + 0.0)  # no negative zero
    bits = v.view(np.int64)
    key = np.where(bits < 0, bits ^ np.int64(0x7FFFFFFFFFFFFFFF), bits) >> np.int64(shift)
    at = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1]))) if len(v) else np.empty(0, np.int64)
    to = np.append(at[1:], len(v))
    return key[at], to - at, v[at], v[to - 1] if len(at) else v


def medians(df: DataFrame, columns: Sequence[str]) -> list[float | None]:
    """Exact medians of the finite values, None without any: the mean of the two middle values.

    No task gathers the values. A pass counts them by their next DIGIT bits and keeps the range of the lower middle
    value, until all of it are equal: at most 6 passes, each over what lies in the last one's ranges.
    """
    found: dict[str, float | None] = dict.fromkeys(columns)
    rank, ends, after = {}, {}, {}  # of the lower middle value in its range; the range; the next greater value, and whether it is the upper one
    kind = "i int, digit bigint, n bigint, lo double, hi double"
    left = list(found)
    for shift in [*range(64 - DIGIT, 0, -DIGIT), 0]:
        if not left:
            break

        def run(batches: Iterator[pa.RecordBatch], shift: int = shift) -> Iterator[pa.RecordBatch]:
            for batch in batches:
                for i, column in enumerate(batch.columns):
                    digit, n, lo, hi = digits_of(column.drop_null().to_numpy(zero_copy_only=False), shift)
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(n), i, np.int32)), pa.array(digit), pa.array(n), pa.array(lo), pa.array(hi)], ["i", "digit", "n", "lo", "hi"])

        inside = [finite(F.col(c)) if c not in ends else F.when(finite(F.col(c)).between(*ends[c]), finite(F.col(c))) for c in left]
        values = df.select(*[v.alias(f"_{i}") for i, v in enumerate(inside)])
        values = values.where(" OR ".join(f"_{i} IS NOT NULL" for i in range(len(left))))
        per: dict[str, list] = {c: [] for c in left}
        for r in values.mapInArrow(run, kind).groupBy("i", "digit").agg(F.sum("n").alias("n"), F.min("lo").alias("lo"), F.max("hi").alias("hi")).collect():
            per[left[r["i"]]].append((r["lo"], r["hi"], r["n"]))
        for c, bins in per.items():
            if not bins and c not in ends:
                left = [x for x in left if x != c]
                continue
            total = sum(n for *_, n in bins)
            if c not in ends:
                rank[c], after[c] = (total - 1) // 2, (None, total % 2 == 0)
            r = rank[c]
            bins.sort()
            for k, (lo, hi, n) in enumerate(bins):
                if r < n:
                    break
                r -= n
            else:
                raise ValueError(f"column {c} changes from one reading to the next")
            if k + 1 < len(bins):
                after[c] = (bins[k + 1][0], after[c][1])
            rank[c], ends[c] = r, (lo, hi)
            if lo == hi:
                upper, even = after[c]
                found[c] = lo if not even or r + 1 < n else 0.5 * lo + 0.5 * upper
                left = [x for x in left if x != c]
    return [found[c] for c in columns]


def describe(df: DataFrame, columns: Sequence[str], exact: bool = True) -> DataFrame:
    """Per column: n (all rows), mean, median, std (population), min, max over finite values, and invalid. One pass; exact medians are found before."""
    aggs = []
    middle = medians(df, columns) if exact else [None] * len(columns)
    for c, m in zip(columns, middle, strict=True):
        v = finite(F.col(c))
        median = F.lit(m) if exact else F.percentile_approx(v, 0.5, 10000)
        stats = {"mean": F.avg(v), "median": median, "std": F.stddev_pop(v), "min": F.min(v), "max": F.max(v)}
        aggs.append(F.struct(F.lit(c).alias("statistic"), F.count(F.lit(1)).alias("n"), *[F.coalesce(x.cast("double"), F.lit(NAN)).alias(k) for k, x in stats.items()], (F.count(F.lit(1)) - F.count(v)).alias("invalid")).alias(c))
    return df.agg(*aggs).select(F.inline(F.array(*[F.col(c) for c in columns])))


def correlations(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(x, y, r): Pearson correlation of every pair over the rows where both are finite; NaN without variance or rows.

    One aggregation of pairwise sums over centred columns.
    """
    means = df.agg(*[F.avg(finite(F.col(c))).alias(f"_m{i}") for i, c in enumerate(columns)])
    data = df.crossJoin(F.broadcast(means)).select(*[(finite(F.col(c)) - F.col(f"_m{i}")).alias(f"_v{i}") for i, c in enumerate(columns)])
    aggs, pairs = [], list(combinations_with_replacement(range(len(columns)), 2))
    for i, j in pairs:
        a, b = F.col(f"_v{i}"), F.col(f"_v{j}")
        both = a.isNotNull() & b.isNotNull()
        sums = {"n": F.count(F.when(both, 1)).cast("double"), "a": F.sum(F.when(both, a)), "b": F.sum(F.when(both, b)), "ab": F.sum(a * b), "aa": F.sum(F.when(both, a * a)), "bb": F.sum(F.when(both, b * b))}
        aggs.append(F.struct(F.lit(columns[i]).alias("x"), F.lit(columns[j]).alias("y"), *[F.coalesce(v, F.lit(0.0)).alias(k) for k, v in sums.items()]).alias(f"p{i}_{j}"))
    rows = data.agg(*aggs).select(F.inline(F.array(*[F.col(f"p{i}_{j}") for i, j in pairs])))
    n = F.col("n")
    va, vb = F.col("aa") - F.col("a") * F.col("a") / n, F.col("bb") - F.col("b") * F.col("b") / n
    r = F.when((n > 1) & (va > 0) & (vb > 0), (F.col("ab") - F.col("a") * F.col("b") / n) / F.sqrt(va * vb)).otherwise(F.lit(NAN))
    half = rows.where("n > 0").select("x", "y", r.alias("r")).unionByName(rows.where("n = 0").select("x", "y", F.lit(NAN).alias("r")))
    return half.unionByName(half.where("x != y").select(F.col("y").alias("x"), F.col("x").alias("y"), "r"))


def class_means(scores: DataFrame, row: str = "row_id", is_ai: str = "is_ai", value: str = "value") -> DataFrame:
    """(row, human_mean, ai_mean): null where a side has no score."""
    return scores.groupBy(row).agg(F.avg(F.when(~F.col(is_ai), F.col(value))).alias("human_mean"), F.avg(F.when(F.col(is_ai), F.col(value))).alias("ai_mean"))


def finite_mean(c: Column) -> Column:
    """Aggregate: mean of the finite values, NaN if there are none."""
    return F.coalesce(F.avg(finite(c)), F.lit(NAN))


def group_grid(df: DataFrame, value: Column, row_group: str, column_group: str) -> DataFrame:
    """(row_group, column_group, mean): means of all cells, with marginals over rows; ALL marks a marginal."""
    data = df.select(F.col(row_group).alias("r"), F.col(column_group).alias("c"), finite(value).alias("v"))
    cube = data.cube("r", "c").agg(F.avg("v").alias("mean"), F.grouping("r").alias("gr"), F.grouping("c").alias("gc"))
    return cube.select(F.when(F.col("gr") == 1, F.lit("ALL")).otherwise(F.col("r")).alias(row_group), F.when(F.col("gc") == 1, F.lit("ALL")).otherwise(F.col("c")).alias(column_group), "mean")


def frequencies(df: DataFrame, label: str) -> DataFrame:
    """(label, n, share), the most frequent first."""
    counts = df.groupBy(label).agg(F.count(F.lit(1)).alias("n"))
    total = counts.agg(F.sum("n").alias("_all"))
    return counts.crossJoin(F.broadcast(total)).select(label, "n", (F.col("n") / F.col("_all")).alias("share")).orderBy(F.desc("n"), label)


def majority(df: DataFrame, keys: Sequence[str], label: str, name: str) -> DataFrame:
    """Per key the most frequent label, ties to the first by name."""
    counts = df.groupBy(*keys, label).agg(F.count(F.lit(1)).alias("_n"))
    return counts.groupBy(*keys).agg(F.min(F.struct((-F.col("_n")).alias("a"), F.col(label).alias("b"))).alias("_best")).select(*keys, F.col("_best.b").alias(name))


def message_table(df: DataFrame, message: str, category: str, turns: str, means: Sequence[str] = ()) -> DataFrame:
    """Per first message: rows, majority category, turn shape, and means of columns."""
    per = df.groupBy(message).agg(F.count(F.lit(1)).alias("n"), F.when(F.max(turns) <= 1, F.lit("single")).when(F.min(turns) > 1, F.lit("multi")).otherwise(F.lit("mixed")).alias("shape"), *[finite_mean(F.col(m)).alias(m) for m in means])
    return per.join(majority(df, [message], category, "category"), message)


def prompt_cards(df: DataFrame, kind: str, message: str, turns: str) -> DataFrame:
    """Per prompt type: rows, single-turn and multi-turn rows, distinct messages."""
    return df.groupBy(kind).agg(F.count(F.lit(1)).alias("n"), F.count(F.when(F.col(turns) <= 1, 1)).alias("single"), F.count(F.when(F.col(turns) > 1, 1)).alias("multi"), F.count_distinct(message).alias("messages"))


def boilerplate(df: DataFrame, message: str, share: float = 0.6, least: int = 3) -> DataFrame:
    """(line): lines in at least `share` of the distinct messages, where there are `least` of them."""
    distinct = df.where(F.col(message) != "Unknown").select(message).distinct()
    total = distinct.agg(F.count(F.lit(1)).alias("_all"))
    each = distinct.select(F.explode(F.array_distinct(message_lines(F.col(message)))).alias("line")).groupBy("line").agg(F.count(F.lit(1)).alias("_n"))
    return each.crossJoin(F.broadcast(total)).where((F.col("_all") >= least) & (F.col("_n") >= share * F.col("_all"))).select("line")


def generator_table(df: DataFrame, label: str, model: str, params: str, order: str) -> DataFrame:
    """Per model label: model and parameters of its first row, rows and share."""
    per = df.groupBy(label).agg(F.min_by(model, order).alias(model), F.min_by(params, order).alias(params), F.count(F.lit(1)).alias("n"))
    return per.crossJoin(F.broadcast(per.agg(F.sum("n").alias("_all")))).withColumn("share", F.col("n") / F.col("_all")).drop("_all")


def idf(df: DataFrame, tokens: str, keys: Sequence[str] = ()) -> DataFrame:
    """(keys, token, idf): ln((N + 1) / (df + 1)) over the texts, or over those of each key (a chunk of rows, a side)."""
    texts = df.groupBy(*keys).agg(F.greatest(F.count(F.lit(1)), F.lit(1)).alias("_all"))
    counts = df.select(*keys, F.explode(F.array_distinct(tokens)).alias("token")).groupBy(*keys, "token").agg(F.count(F.lit(1)).alias("_df"))
    joined = counts.join(texts, list(keys)) if keys else counts.crossJoin(F.broadcast(texts))
    return joined.select(*keys, "token", F.log((F.col("_all") + 1) / (F.col("_df") + 1)).alias("idf"))


def token_totals(df: DataFrame, prompt: str = "prompt_tokens", completion: str = "completion_tokens", error: str = "error") -> DataFrame:
    return df.agg(F.coalesce(F.sum(prompt), F.lit(0)).alias("prompt_tokens"), F.coalesce(F.sum(completion), F.lit(0)).alias("completion_tokens"), F.count(F.when(F.col(error).isNotNull(), 1)).alias("failures"))


def failures(df: DataFrame, error: str = "error") -> DataFrame:
    return df.where(F.col(error).isNotNull()).groupBy(error).agg(F.count(F.lit(1)).alias("n"))


def invalid_total(described: DataFrame) -> DataFrame:
    return described.agg(F.sum("invalid").alias("invalid"))


def class_report(df: DataFrame, label: str, predicted: str) -> DataFrame:
    """(class, precision, recall, f1, support) of every class that occurs on either side."""
    counts = df.groupBy(F.col(label).alias("_l"), F.col(predicted).alias("_p")).agg(F.count(F.lit(1)).alias("_n"))
    sides = counts.select(F.col("_l").alias("class"), F.col("_n").alias("support"), F.lit(0).alias("called"), F.when(F.col("_l") == F.col("_p"), F.col("_n")).otherwise(0).alias("hit"))
    sides = sides.unionByName(counts.select(F.col("_p").alias("class"), F.lit(0).cast("long").alias("support"), F.col("_n").alias("called"), F.lit(0).cast("long").alias("hit")))
    per = sides.groupBy("class").agg(*[F.sum(c).alias(c) for c in ("support", "called", "hit")])
    zero = lambda c: F.coalesce(c, F.lit(0.0))
    p, r = zero(F.try_divide("hit", "called")), zero(F.try_divide("hit", "support"))
    return per.select("class", p.alias("precision"), r.alias("recall"), zero(F.try_divide(2 * p * r, p + r)).alias("f1"), "support")


def mean_similarity_to_others(df: DataFrame, key: str, vector: str, name: str) -> DataFrame:
    """Mean dot product with all other rows: (v . sum - 1) / (n - 1); 0 for a single row.

    The sum vector makes it linear in the rows; it is one row, and broadcast.
    """
    from ..functions.vectors import dot

    total = df.select(F.posexplode(vector).alias("_i", "_x")).groupBy("_i").agg(F.sum(F.col("_x").cast("double")).alias("_x"))
    whole = total.agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", "_x"))), lambda x: x["_x"]).alias("_sum")).crossJoin(df.agg(F.count(F.lit(1)).alias("_all")))
    return df.crossJoin(F.broadcast(whole)).select(*df.columns, F.when(F.col("_all") > 1, (dot(vector, "_sum") - 1) / (F.col("_all") - 1)).otherwise(F.lit(0.0)).alias(name))


def mean_similarity_to(df: DataFrame, vector: str, other: DataFrame, other_vector: str, name: str) -> DataFrame:
    """Mean dot product with all rows of another set; 0 if that is empty."""
    from ..functions.vectors import dot

    mean = other.select(F.posexplode(other_vector).alias("_i", "_x")).groupBy("_i").agg(F.avg(F.col("_x").cast("double")).alias("_x"))
    whole = mean.agg(F.transform(F.array_sort(F.collect_list(F.struct("_i", "_x"))), lambda x: x["_x"]).alias("_mean"))
    return df.crossJoin(F.broadcast(whole)).select(*df.columns, F.when(F.size("_mean") > 0, dot(vector, "_mean")).otherwise(F.lit(0.0)).alias(name))

