"""Benchmark decontamination with a stored positional inverted index, in DataFrame operations only.

`build_index` stores the postings (term, k, fp, pos) of the training tokens (k, fp: the document's
keys), of all terms or of the test terms only. `phrase_matches` answers phrases from the index
alone: the terms of each phrase are ranked by their number of postings; the postings of the rarest,
less its offset in the phrase, are the candidate starts; the list of the second, adjusted by its
offset, is intersected with them, then those of all other terms, which leaves exact occurrences
only. `proximity_matches` answers from the same index.

The tables of test terms and phrases are broadcast only within `BROADCAST_ROWS` and `BROADCAST_BYTES`,
both measured; beyond, the join on the term is salted, so a very common term is dealt to many tasks.
Starts are spread by document and position in all later joins.

Defined cases: null text or no words: n_words 0, never hit. Null or wordless items have no windows.
Equal rows of `documents` give equal results, one each; rows of one id but different texts are
documents of their own; null ids are kept. Very long texts are tokenised whole. Extra columns are
ignored. An empty table gives no rows; no items hit nothing.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import KEYS, NO_ID, cut, key_columns, salted_join, shared_table

#: A table of terms or windows is sent to all executors up to so many rows and bytes of text.
BROADCAST_ROWS, BROADCAST_BYTES = 500_000, 64 << 20
NOT_WORD = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: The same for texts with A-Z still in them.
NOT_WORD_ANY_CASE = r"[\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"


def tokens(c: Column) -> Column:
    """Words of a text: A-Z lower-cased, runs of ASCII letters and digits and of all non-ASCII characters."""
    low = F.translate(F.coalesce(c.cast("string"), F.lit("")), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return _split(low, NOT_WORD)


def n_words(c: Column) -> Column:
    """How many words `tokens` finds; no text is lower-cased for it."""
    return F.size(_split(F.coalesce(c.cast("string"), F.lit("")), NOT_WORD_ANY_CASE)).cast("long")


def _split(c: Column, between: str) -> Column:
    # With white space at its ends, a text splits into an empty piece, its words, and an empty piece.
    parts = F.split(F.concat(F.lit(" "), c, F.lit(" ")), between)
    return F.slice(parts, 2, F.greatest(F.size(parts) - 2, F.lit(0)))


def is_small(df: DataFrame, text: Column) -> bool:
    """Whether a stored table may be broadcast, by its rows and the bytes of its text."""
    size = df.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.sum(F.octet_length(text)), F.lit(0)).alias("bytes")).first()
    return size["n"] <= BROADCAST_ROWS and size["bytes"] + 40 * size["n"] <= BROADCAST_BYTES


def windows_of(items: DataFrame, id_col: str = "item_id", text_col: str = "text", length: int = 10) -> DataFrame:
    """(window, items): every distinct run of `length` words of an item (all its words, if fewer)."""
    words = items.select(F.col(id_col).cast("string").alias("item"), tokens(F.col(text_col)).alias("words")).where(F.size("words") > 0)
    starts = F.sequence(F.lit(1), F.greatest(F.size("words") - (length - 1), F.lit(1)))
    return words.select("item", F.explode(F.transform(starts, lambda i: F.slice("words", i, length))).alias("window")).groupBy("window").agg(F.collect_set("item").alias("items"))


def build_index(docs: DataFrame, terms: DataFrame | None = None, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Stored postings (term, k, fp, pos) of all tokens, or of the given distinct terms only."""
    # The keys are columns before the words are exploded; in one step the text would be hashed again for every word.
    postings = docs.select(*key_columns(id_col, text_col), tokens(F.col(text_col)).alias("words")).select(*KEYS, F.posexplode("words").alias("pos", "term"))
    if terms is not None:
        terms = cut(terms)
        postings = postings.join(F.broadcast(terms) if is_small(terms, F.col("term")) else terms, "term", "left_semi")
    return shared_table(postings.select("term", *KEYS, "pos"), "postings")


def _ranked_terms(index: DataFrame, windows: DataFrame) -> DataFrame:
    """(wid, length, terms): the terms of each window with their offsets, rarest first; windows with a term that has no postings go."""
    counts = index.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    each = windows.select("wid", F.size("window").alias("length"), F.posexplode("window").alias("before", "term")).join(counts, "term")
    found = each.groupBy("wid", "length").agg(F.array_sort(F.collect_list(F.struct("n", "before", "term"))).alias("terms"))
    return found.where(F.size("terms") == F.col("length"))


def _intersect(starts: DataFrame, index: DataFrame, ranked: DataFrame, broadcast: bool, begin: int, count: int) -> DataFrame:
    """The starts (wid, k, fp, start) at which the terms of ranks begin, …, begin + count - 1 stand at their offsets as well."""
    wanted = ranked.select("wid", F.slice("terms", begin, count).alias("terms")).where(F.size("terms") > 0)
    known = ranked.where(F.size("terms") < begin).select("wid")
    side = (lambda df: F.broadcast(df)) if broadcast else (lambda df: df)
    # Only the postings of these terms in documents that have a start are read on. Documents with a start grow with
    # the corpus, so they are never sent to all executors, whatever the planner makes of a small input.
    lists = index.join(side(wanted.select(F.explode("terms.term").alias("term")).distinct()), "term", "left_semi").join(starts.select(*KEYS).distinct().hint("merge"), KEYS, "left_semi")
    needed = starts.join(side(wanted), "wid").select("wid", *KEYS, "start", F.size("terms").alias("need"), F.explode("terms").alias("t")).select("wid", *KEYS, "start", "need", (F.col("start") + F.col("t.before")).alias("pos"), F.col("t.term").alias("term"))
    # Windows overlap; each word of a document is looked up once for all starts that need it there.
    place = [*KEYS, "pos", "term"]
    asked = needed.groupBy(*place).agg(F.collect_list(F.struct("wid", "start", "need")).alias("by"))
    held = asked.join(lists, place, "left_semi").select(*KEYS, F.explode("by").alias("s"))
    met = held.groupBy("s.wid", *KEYS, "s.start", "s.need").agg(F.count(F.lit(1)).alias("n")).where("n = need").select("wid", *KEYS, "start")
    return met.unionByName(starts.join(side(known), "wid", "left_semi").select("wid", *KEYS, "start"))


def phrase_matches(index: DataFrame, windows: DataFrame) -> DataFrame:
    """(k, fp, start, length, items) of every exact occurrence of the windows (window, items) in the indexed documents."""
    windows = cut(windows.withColumn("wid", F.monotonically_increasing_id()))
    ranked = cut(_ranked_terms(index, windows))
    broadcast = is_small(ranked, F.concat_ws(" ", "terms.term"))
    rarest = ranked.select("wid", F.col("terms")[0]["term"].alias("term"), F.col("terms")[0]["before"].alias("before"))
    seeds = index.join(F.broadcast(rarest), "term") if broadcast else _dealt(index, rarest)
    starts = cut(seeds.select("wid", *KEYS, (F.col("pos") - F.col("before")).alias("start")).where("start >= 0").distinct())
    starts = cut(_intersect(starts, index, ranked, broadcast, 2, 1))
    starts = _intersect(starts, index, ranked, broadcast, 3, 1_000_000)
    return starts.join(windows, "wid").select(*KEYS, "start", F.size("window").alias("length"), "items")


def _dealt(index: DataFrame, rarest: DataFrame) -> DataFrame:
    """Postings joined to the windows they start; windows of one term travel as one row, so that side has one row a term."""
    grouped = rarest.groupBy("term").agg(F.collect_list(F.struct("wid", "before")).alias("w"))
    return salted_join(index, grouped, ["term"]).select("*", F.explode("w").alias("one")).select("term", *KEYS, "pos", "one.wid", "one.before")


def proximity_matches(index: DataFrame, phrases: DataFrame, slop: int) -> DataFrame:
    """(phrase_id, doc_id, fp, start, end) of the tightest spans, from each posting of a phrase's rarest
    term, that hold all terms of the phrase within len + slop words.

    `index` as from build_index, `phrases` as (phrase_id, words array).
    """
    doc = ["phrase_id", *KEYS]
    terms = phrases.select("phrase_id", F.array_distinct("words").alias("set"), F.size("words").alias("len"))
    each = terms.select("phrase_id", "len", F.size("set").alias("distinct"), F.explode("set").alias("term"))
    n = index.groupBy("term").agg(F.count(F.lit(1)).alias("n"))
    ranked = each.join(n, "term", "left").withColumn("r", F.row_number().over(Window.partitionBy("phrase_id").orderBy(F.coalesce("n", F.lit(0)), "term")))
    seeds = ranked.where("r = 1 and n > 0").join(index, "term").select(*doc, F.col("pos").alias("seed"), "len", "distinct")
    rest = ranked.where("r > 1").select("phrase_id", "term").join(index, "term").select(*doc, "term", "pos")
    reach = F.col("len") + slop
    near = seeds.join(rest, doc, "left").where(F.col("pos").isNull() | (F.abs(F.col("pos") - F.col("seed")) < reach))
    # Of each other term, its nearest positions on either side of the seed.
    sides = near.groupBy(*doc, "seed", "len", "distinct", "term").agg(F.max(F.when(F.col("pos") <= F.col("seed"), F.col("pos"))).alias("left"), F.min(F.when(F.col("pos") >= F.col("seed"), F.col("pos"))).alias("right"))
    held = sides.groupBy(*doc, "seed", "len", "distinct").agg(F.count("term").alias("others"), F.collect_list(F.struct("left", "right")).alias("sides"))
    # A span starts at the seed or at some left position; the rest must end as early as possible.
    starts = F.array_distinct(F.concat(F.array(F.col("seed")), F.filter(F.transform("sides", lambda s: s["left"]), lambda x: x.isNotNull())))
    end_for = lambda a: F.aggregate(F.col("sides"), F.col("seed"), lambda acc, s: F.greatest(acc, F.when(s["left"] >= a, s["left"]).otherwise(F.coalesce(s["right"], F.lit(2147483647)))))
    best = F.array_min(F.transform(starts, lambda a: F.struct((end_for(a) - a).alias("width"), a.alias("start"))))
    out = held.where(F.col("others") == F.col("distinct") - 1).select(*doc, "len", best.alias("best")).where(F.col("best.width") < F.col("len") + slop)
    return out.select("phrase_id", F.when(F.col("k") != NO_ID, F.col("k")).alias("doc_id"), "fp", F.col("best.start").alias("start"), (F.col("best.start") + F.col("best.width")).alias("end")).distinct()


def contamination(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 10) -> DataFrame:
    """Per input row: id, fp (xxhash64 of its text), n_words, n_hit, n_items, items (sorted), items_sha256, contaminated."""
    windows = cut(windows_of(items, text_col=text_col, length=length))
    index = build_index(docs, windows.select(F.explode("window").alias("term")).distinct(), id_col, text_col)
    per = phrase_matches(index, windows).groupBy(*KEYS).agg(F.collect_set(F.struct("start", "length")).alias("spots"), F.array_sort(F.array_distinct(F.flatten(F.collect_set("items")))).alias("items"))
    hit = F.array_distinct(F.flatten(F.transform("spots", lambda s: F.sequence(s["start"], s["start"] + s["length"] - 1))))
    found = per.select(*KEYS, F.size(hit).cast("long").alias("n_hit"), "items")
    rows = docs.select(*key_columns(id_col, text_col), n_words(F.col(text_col)).alias("n_words")).join(found, KEYS, "left")
    items_of = F.coalesce("items", F.array().cast("array<string>"))
    return rows.select(
        F.when(F.col("k") != NO_ID, F.col("k")).alias(id_col), "fp", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"), F.size(items_of).cast("long").alias("n_items"), items_of.alias("items"),
        F.sha2(F.array_join(items_of, ","), 256).alias("items_sha256"), F.col("n_hit").isNotNull().alias("contaminated"),
    )


__all__ = ["build_index", "contamination", "phrase_matches", "proximity_matches", "tokens", "windows_of"]
