"""URL filtering: path rules, then a naive Bayes verdict over segmented host and path words.

Hosts are concatenated names ("cheappillsonline"), so each host label is split into words by a
unigram Viterbi search, and a multinomial naive Bayes model scores the words of host and path.
The unigram costs follow Zipf's law over the whole words of a public vocabulary file, in the file's
order (most frequent first); its path is a parameter. The Bayes model is fitted on short topical
word lists below, or on rows given by the caller. A word that both lists lack says nothing.

A rule is (verdict, host, path): it fits its host and all subdomains where the URL's path starts
with the rule's path. Of several fitting rules the longest string host + path decides.

Defined cases: null, or no `://`: host and path empty, no rule; the method then has only its prior,
which allows. Extra columns are kept out of the result. Rows are judged one by one, repeats alike;
equally long rules: the first given. Very long urls are judged whole, in time linear in their length.
Empty table: no rows.
"""

from __future__ import annotations

import functools
import json
import math
import re
from collections import Counter
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Words of sites to block (1) and to allow (0), by topic; more can be passed to fit().
TOPICS: tuple[tuple[int, str], ...] = (
    (1, "casino betting porn adult viagra pharmacy spam ads tracker warez torrent malware phishing scam"),  # the kinds themselves
    (1, "casino casinos poker roulette blackjack baccarat slots jackpot bet bets betting bettor bookmaker gamble gambling wager lottery lotto bingo sportsbook"),
    (1, "porn porno xxx sex sexy nude nudes naked erotic escort escorts adult fetish hentai milf camgirls webcams hookup"),
    (1, "viagra cialis levitra pill pills pharmacy steroids tramadol xanax meds"),
    (1, "spam spammer spamming backlinks clickbait followers bulkmail doorway"),
    (1, "ads adserver advert adverts advertising banner banners popup popunder tracker trackers track tracking telemetry beacon affiliate"),
    (1, "warez crack cracks cracked keygen serials torrent torrents pirate pirated nulled"),
    (1, "phishing malware ransomware trojan spyware botnet exploit hack hacked stolen"),
    (1, "payday loan loans forex ponzi doubler scam fraud fake counterfeit replica"),
    (0, "news daily times herald post journal press magazine weather report sports football rugby tennis league club"),
    (0, "science research physics chemistry biology nature university college school library academy learning education teacher students"),
    (0, "health hospital clinic doctor medicine nursing care dental family children parents baby garden dairy flowers"),
    (0, "cooking recipes kitchen food bread wine restaurant cafe travel hotel tours island beach mountain railway airport"),
    (0, "music film theatre museum gallery art painting photo history archive heritage books poetry writers language dictionary"),
    (0, "government council city law court police tax election parliament church community charity volunteers"),
    (0, "software developer code data math engineering robotics computer network cloud security open source project"),
    (0, "bike car motor train bank insurance job careers estate house home furniture shoes fashion market"),
)
#: Labels that say nothing about a site: top-level domains, kinds of host, file endings.
PLAIN = frozenset("www m com org net edu gov io co uk de fr es en html htm php index example blog forum shop mail docs support static cdn api wiki".split())
WORD = re.compile(r"[a-z]+")
TOKEN = re.compile(r"[a-z0-9]+")


def vocabulary_words(path: str | None = None) -> list[str]:
    """Whole words of letters a-z in the vocabulary file, most frequent first; of two letters only the first 30."""
    if path is None:
        import public_tokenizers

        path = public_tokenizers.path("word_bpe_49k.json")
    with open(path, encoding="utf-8") as f:
        model = json.load(f)["model"]
    end = model["end_of_word_suffix"]
    words = [w.removesuffix(end) for w, _ in sorted(model["vocab"].items(), key=lambda x: x[1]) if w.endswith(end)]
    words = [w for w in words if len(w) > 1 and w.isascii() and w.isalpha()]
    short = frozenset([w for w in words if len(w) == 2][:30])
    return [w for w in words if len(w) > 2 or w in short]


@dataclass
class UrlModel:
    """Unigram word costs for the segmentation, and naive Bayes weights of words (log odds of block)."""

    cost: dict[str, float]
    unknown: float
    odds: dict[str, float]
    prior: float
    longest: int
    memo: dict[str, list[str]] = field(default_factory=dict, repr=False, compare=False)

    def split(self, name: str) -> list[str]:
        """The cheapest segmentation of a run of letters; letters outside known words cost `unknown` each."""
        found = self.memo.get(name)
        if found is not None:
            return found
        n = len(name)
        best, back = [0.0] + [math.inf] * n, [(0, False)] * (n + 1)
        for i in range(n):
            at = best[i]
            if at + self.unknown < best[i + 1]:
                best[i + 1], back[i + 1] = at + self.unknown, (i, False)
            for j in range(i + 1, min(n, i + self.longest) + 1):
                c = self.cost.get(name[i:j])
                if c is not None and at + c < best[j]:
                    best[j], back[j] = at + c, (i, True)
        words: list[str] = []
        loose: list[str] = []
        j = n
        while j:
            i, known = back[j]
            if known:
                if loose:
                    words.append("".join(reversed(loose)))
                    loose = []
                words.append(name[i:j])
            else:
                loose.append(name[i:j])
            j = i
        if loose:
            words.append("".join(reversed(loose)))
        words.reverse()
        if n < 100:
            if len(self.memo) >= 100_000:
                self.memo.clear()
            self.memo[name] = words
        return words

    def words(self, host: str, path: str) -> list[str]:
        out = []
        for token in [*TOKEN.findall(host), *TOKEN.findall(path.lower())]:
            if token not in PLAIN:
                for run in WORD.findall(token):
                    out += self.split(run)
        return out

    def score(self, host: str, path: str) -> float:
        """Probability that a URL is to be blocked."""
        z = self.prior + sum(self.odds.get(w, 0.0) for w in self.words(host, path))
        return 1 / (1 + math.exp(-max(-700.0, min(700.0, z))))


@functools.lru_cache(maxsize=8)
def fit(examples: tuple[tuple[int, str], ...] = TOPICS, prior_block: float = 0.1, smooth: float = 0.1, vocabulary: str | None = None) -> UrlModel:
    """Fits the Bayes model on (label, words), and the unigram costs on the vocabulary file and the words of the examples."""
    by = {0: Counter(), 1: Counter()}
    for label, text in examples:
        by[label].update(WORD.findall(text.lower()))
    counts = by[0] + by[1]
    words = vocabulary_words(vocabulary)
    # Zipf: the word of rank r has probability 1 / (r H). Example words outside the file come last.
    ranked = list(dict.fromkeys([*words, *sorted(w for w in counts if len(w) > 1)]))
    harmonic = math.log(len(ranked) + 1) + 0.5772
    cost = {w: math.log(r * harmonic) for r, w in enumerate(ranked, 1)}
    sums = {y: sum(c.values()) + smooth * len(counts) for y, c in by.items()}
    odds = {w: math.log((by[1][w] + smooth) / sums[1]) - math.log((by[0][w] + smooth) / sums[0]) for w in counts}
    return UrlModel(cost, max(cost.values()) * 0.75, odds, math.log(prior_block / (1 - prior_block)), max(map(len, cost)))


@dataclass(frozen=True)
class Rule:
    verdict: str
    host: str
    path: str = "/"

    @property
    def text(self) -> str:
        return self.host + self.path


def url_parts(df: DataFrame, url_col: str = "url") -> DataFrame:
    """Adds host (A-Z lower-cased) and path."""
    url = F.coalesce(F.col(url_col).cast("string"), F.lit(""))
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    host = F.translate(F.regexp_extract(url, pattern, 1), "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    return df.withColumns({"host": host, "path": F.regexp_extract(url, pattern, 2)})


def _judge(model: UrlModel, rules: tuple[Rule, ...], cut: float):
    by_host: dict[str, list[Rule]] = {}
    for rule in rules:
        by_host.setdefault(rule.host, []).append(rule)

    def rule_of(host: str, path: str) -> Rule | None:
        best, at = None, 0
        while True:  # the host and each of its parent domains
            for rule in by_host.get(host[at:], ()):
                if path.startswith(rule.path) and (best is None or len(rule.text) > len(best.text)):
                    best = rule
            dot = host.find(".", at)
            if dot < 0:
                return best
            at = dot + 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, verdicts, scores, words = [], [], [], []
            for host, path in zip(batch.column("host").to_pylist(), batch.column("path").to_pylist(), strict=True):
                rule, p = rule_of(host, path), model.score(host, path)
                names.append(rule.text if rule else None)
                verdicts.append(rule.verdict if rule else "block" if p >= cut else "allow")
                scores.append(p)
                words.append(" ".join(model.words(host, "")))
            added = [pa.array(names, pa.string()), pa.array(verdicts, pa.string()), pa.array(scores, pa.float64()), pa.array(words, pa.string())]
            yield pa.RecordBatch.from_arrays([*batch.columns, *added], names=[*batch.schema.names, "rule", "verdict", "score", "host_words"])

    return run


def judge_urls(pages: DataFrame, rules: Iterable[Rule] = (), model: UrlModel | None = None, id_col: str = "page_id", url_col: str = "url", cut: float = 0.5) -> DataFrame:
    """Per row: id, host, path, rule, verdict, score (of the method), host_words. One pass, no shuffle."""
    parts = url_parts(pages.select(F.col(id_col).alias("page"), F.col(url_col).alias("url")), "url").select("page", "host", "path")
    kind = parts.schema["page"].dataType.simpleString()
    out = parts.mapInArrow(_judge(model or fit(), tuple(rules), cut), f"page {kind}, host string, path string, rule string, verdict string, score double, host_words string")
    return out.withColumnRenamed("page", id_col)
