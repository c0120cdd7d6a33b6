"""Main-text extraction: gradient-boosted trees over DOM nodes, decoded along the tree.

A page is parsed into its block elements (inline markup is merged into the block around it). Trees
score every block from its subtree density, link share, attribute tokens, depth, position and
sibling statistics. Decoding picks the best set of blocks that is closed under ancestors: a block
is kept only with all its ancestors, and a subtree goes as a whole where that scores better, so
no choice contradicts that of an ancestor or descendant.

The trees are fitted on generated pages (`training_pages`, a fixed number from a fixed seed) of
many layouts: no labelled pages are needed. Nothing of a page is cut off or capped; only the insides
of script, style, title, noscript, textarea, iframe, svg and template elements are no text.

Defined cases: null or empty html: text empty. Unclosed or stray tags are handled as browsers do
in the common cases. Repeated rows are rows of their own. Equal values of a subtree and of nothing:
the subtree goes. Very long and very deep pages are parsed in time linear in their length. Extra
columns are ignored, whatever their names. Empty table: no rows.
"""

from __future__ import annotations

import functools
import html as entities
import math
import random
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import boosting
from .common import slices

TAG = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>"']++|"[^"]*"|'[^']*')*+)>|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)""", re.S)
ATTRIBUTE = re.compile(r"""\b(?:class|id|role|aria-label|itemprop)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
LETTERS = re.compile(r"[a-z]+")
CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
RAW = frozenset("script style title noscript textarea iframe svg template".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var br wbr img label object canvas audio video math mi mn mo ms mrow mfrac msup msub msubsup msqrt mroot mtext mtable mtr mtd mover munder semantics".split())
IGNORED = frozenset("html head body".split())
#: An open element of the first kind is closed by a start tag of the second, unless a stopper stands between.
CLOSES = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
}
KINDS = "body p heading li list div section article main nav header footer aside form table cell figure quote control other".split()
KIND_OF = {k: i for i, k in enumerate(KINDS)} | {
    t: KINDS.index(k)
    for k, tags in {"heading": "h1 h2 h3 h4 h5 h6 hgroup", "list": "ul ol dl menu", "li": "li dt dd", "table": "table tbody thead tfoot tr caption", "cell": "td th", "figure": "figure figcaption picture", "quote": "blockquote pre", "control": "button select option fieldset legend input dialog details summary", "nav": "nav"}.items()
    for t in tags.split()
}
OTHER = KINDS.index("other")
PUNCTUATION = re.compile(r"[.,;!?]")


class Nodes:
    """Blocks of some pages in document order, and the runs of text in them."""

    def __init__(self, weights: dict[str, float] | None = None):
        self.weights = weights or {}
        self.parent, self.kind, self.depth, self.end, self.tokens, self.attr, self.least, self.above = [], [], [], [], [], [], [], []
        self.run_node, self.run_text, self.run_link = [], [], []
        self.roots, self.run_from = [], []

    def open(self, parent: int, kind: int, tokens: tuple[str, ...]) -> int:
        i = len(self.parent)
        score = sum(self.weights.get(t, 0.0) for t in tokens)
        self.parent.append(parent)
        self.kind.append(kind)
        self.depth.append(self.depth[parent] + 1 if parent >= 0 else 0)
        self.end.append(i + 1)
        self.tokens.append(tokens)
        self.attr.append(score)
        self.least.append(min(score, self.least[parent]) if parent >= 0 else score)
        self.above.append(self.above[parent] | 1 << self.kind[parent] if parent >= 0 else 0)
        return i

    def add(self, page: str) -> None:
        """Parses one page."""
        root = self.open(-1, 0, ())
        self.roots.append(root)
        self.run_from.append(len(self.run_node))
        stack: list[tuple[str, int]] = [("body", root)]
        places: dict[str, list[int]] = {}  # of each tag, where it stands open in the stack
        endless: set[str] = set()  # raw elements without an end tag from here on
        link = 0
        pieces: list[str] = []
        links = 0
        at = 0
        place = lambda names: max((places[x][-1] for x in names if places.get(x)), default=0)

        def flush() -> None:
            nonlocal links
            if pieces:
                text = "".join(pieces)
                text = " ".join((entities.unescape(text) if "&" in text else text).split())
                if text:
                    self.run_node.append(stack[-1][1])
                    self.run_text.append(text)
                    self.run_link.append(min(links, len(text)))
                pieces.clear()
                links = 0

        def pop() -> None:
            self.end[stack[-1][1]] = len(self.parent)
            name, _ = stack.pop()
            if stack:
                places[name].pop()

        for m in TAG.finditer(page):
            if m.start() < at:  # inside a raw element
                continue
            if m.start() > at:
                piece = page[at : m.start()]
                pieces.append(piece)
                if link:
                    links += len(piece)
            at = m.end()
            name = m[2] or m[5]
            if name is None:
                continue
            name = name.lower()
            closing = m[1] or m[4]
            if name in INLINE:
                if name == "a":
                    link = 0 if closing else 1
                elif name == "br":
                    pieces.append(" ")
                continue
            if closing:
                if name in IGNORED:
                    continue
                if d := place((name,)):
                    flush()
                    while len(stack) > d:
                        pop()
                    link = 0
                continue
            if name in RAW:
                if not (m[3] or m[6] or "").rstrip().endswith("/"):
                    found = None if name in endless else re.compile(rf"</{re.escape(name)}[\s/>]", re.I).search(page, at)
                    if found is None:
                        endless.add(name)
                    if found:
                        close = page.find(">", found.start())
                        at = len(page) if close < 0 else close + 1
                    elif name != "svg":
                        at = len(page)
                continue
            if name in IGNORED:
                continue
            if name in VOID:
                pieces.append(" ")
                if name == "hr":
                    flush()
                continue
            flush()
            link = 0
            shut, stop = CLOSES.get(name, (None, None))
            if shut is None:
                shut, stop = {"p"}, {"td", "th", "button", "table", "article", "section", "div", "li", "blockquote"}
            if (d := place(shut)) > place(stop):
                while len(stack) > d:
                    pop()
            attributes = m[3] or m[6]
            tokens: tuple[str, ...] = ()
            if attributes and "=" in attributes:
                tokens = tuple(t for a in ATTRIBUTE.finditer(attributes) for t in LETTERS.findall(CAMEL.sub(" ", a[1] or a[2] or a[3] or "").lower()))
            places.setdefault(name, []).append(len(stack))
            stack.append((name, self.open(stack[-1][1], KIND_OF.get(name, OTHER), tokens)))
        if at < len(page):
            pieces.append(page[at:])
        flush()
        while stack:
            pop()

    def features(self) -> tuple[np.ndarray, np.ndarray]:
        """Features of every block, and characters of text below it."""
        n = len(self.parent)
        parent, kind, depth, end = (np.array(x, np.int64) for x in (self.parent, self.kind, self.depth, self.end))
        run = np.array(self.run_node, np.int64)
        size = np.array([len(t) for t in self.run_text], np.int64)
        sums = lambda w: np.bincount(run, w, n) if len(run) else np.zeros(n)
        own, links, marks = sums(size), sums(np.array(self.run_link)), sums(np.array([len(PUNCTUATION.findall(t)) for t in self.run_text]))
        upto = lambda v: np.concatenate(([0.0], np.cumsum(v)))
        i = np.arange(n)
        below = lambda v: (c := upto(v))[end] - c[i]
        chars, link_chars, mark_chars, long_text = below(own), below(links), below(marks), below(own * (own >= 80))
        root = np.zeros(n, np.int64)
        root[self.roots] = self.roots
        root = np.maximum.accumulate(root)
        page = np.maximum(chars[root], 1)
        before = upto(own)[i] - upto(own)[root]
        has = parent >= 0
        up = np.where(has, parent, 0)
        children = np.bincount(parent[has], minlength=n)
        same = np.zeros(n)
        key, inverse, count = np.unique(up * len(KINDS) + kind, return_inverse=True, return_counts=True)
        same = count[inverse]
        child_chars = np.bincount(parent[has], chars[has], n)
        siblings = np.maximum(children[up], 1)
        mean = child_chars[up] / siblings
        above = np.array(self.above, np.int64)
        bit = lambda *names: ((above[:, None] >> np.array([KINDS.index(x) for x in names])) & 1).max(1)
        cols = [
            depth, np.log1p(chars), np.log1p(own), link_chars / np.maximum(chars, 1), chars / (end - i), chars / page, before / page, (before + chars) / page,
            np.log1p(siblings), np.log1p(same), np.log1p(children), np.log1p(mean), (chars - mean) / np.maximum(mean, 1), mark_chars / np.maximum(chars, 1), long_text / np.maximum(chars, 1),
            np.array(self.attr), np.array(self.least), np.array(self.attr)[up], bit("nav", "header", "footer", "aside", "form", "control"), bit("article", "main"), bit("list"), bit("table"),
            *[(kind == k) for k in range(len(KINDS))],
        ]
        return np.stack([np.asarray(c, np.float32) for c in cols], 1), chars


@dataclass
class Extractor:
    weights: dict[str, float]
    trees: boosting.Trees

    def keep(self, nodes: Nodes) -> np.ndarray:
        """Whether each block is kept: the best ancestor-closed choice on every page."""
        x, chars = nodes.features()
        score = np.clip(self.trees.logits(x), -4, 4) * (1 + np.log1p(chars))
        value = score.tolist()
        parent = nodes.parent
        for i in range(len(value) - 1, -1, -1):  # children come after their parents
            p = parent[i]
            if p >= 0 and value[i] > 0:
                value[p] += value[i]
        kept = [False] * len(value)
        for i, p in enumerate(parent):
            kept[i] = p < 0 or (kept[p] and value[i] > 0)
        return np.array(kept, bool)

    def texts(self, pages: list[str]) -> list[str]:
        nodes = Nodes(self.weights)
        for page in pages:
            nodes.add(page)
        if not pages:
            return []
        kept = self.keep(nodes)
        out = []
        bounds = [*nodes.run_from, len(nodes.run_node)]
        for a, b in zip(bounds, bounds[1:], strict=False):
            out.append("\n".join(nodes.run_text[j] for j in range(a, b) if kept[nodes.run_node[j]]))
        return out


#: What authors of pages call the parts that are not main text, and those that are: class names and ids in wide use.
JUNK_NAMES = {
    "nav": "nav navbar menu main-menu navigation breadcrumb breadcrumbs topnav pagination pager site-nav tabs",
    "header": "header masthead site-header banner topbar logo branding top",
    "footer": "footer site-footer copyright colophon legal bottom imprint",
    "aside": "sidebar side widget related recent-posts secondary trending recommended popular rail more-stories",
    "ad": "ad ads advert advertisement ad-slot ad-box sponsored sponsor promo promotion adsense commercial",
    "notice": "cookie cookie-notice notice alert consent gdpr popup modal newsletter subscribe paywall warning disclaimer overlay",
    "form": "search search-form signup login contact-form subscribe-form poll",
    "comments": "comments comment-list discussion responses thread reader-comments replies feedback",
    "share": "share social sharing tags toolbar follow-us actions meta-links",
}
MAIN_NAMES = "content main-content post entry entry-content article-body story article text post-body page-content body-copy story-body prose"


def training_pages(n: int = 400, seed: int = 7) -> list[str]:
    """`n` generated pages of random layout; the parts that are not main text stand between \\x01 and \\x02."""
    rng = random.Random(seed)
    pick, chance, some = rng.choice, lambda p: rng.random() < p, rng.randint
    word = lambda: "".join(pick("bdfgklmnprstvz") + pick(("a", "e", "i", "o", "u", "ai", "ø")) + pick(("", "", "n", "l", "r")) for _ in range(some(1, 4)))

    def sentence(lo: int, hi: int) -> str:
        out = [word() + pick(("", "", "", "", "", "", ",", ";", ":")) for _ in range(some(lo, hi))]
        return " ".join(out).rstrip(",;:").capitalize() + pick((".", ".", ".", "!", "?", ""))

    prose = lambda sentences: " ".join(sentence(3, 22) for _ in range(sentences))
    link = lambda lo, hi: f'<a href="/{word()}">{sentence(lo, hi).rstrip(".!?")}</a>'

    def named(kind: str) -> str:
        """A class or id (or both) that tells the kind, with or without further names."""
        name = pick(JUNK_NAMES[kind].split())
        name = pick((name, name, f"{word()} {name}", f"{name} {name}-{word()}", f"{name}{some(1, 9)}", f"{name}_{word()}"))
        return pick((f'class="{name}"', f'id="{name}"', f"class={name.split()[0]}", f'data-x="{word()}" class="{name}"'))

    def links(k: int) -> str:
        each = [link(1, 3) for _ in range(k)]
        return pick((
            "<ul>" + "".join(f"<li>{x}</li>" for x in each) + "</ul>", "<ul>" + "".join(f"<li>{x}" for x in each) + "</ul>", " | ".join(each), " ".join(each), "<p>" + ", ".join(each) + "</p>",
            "".join(f"<div>{x}</div>" for x in each), "<table><tr>" + "".join(f"<td>{x}</td>" for x in each) + "</tr></table>", "<ol>" + "".join(f"<li>{x}</li>" for x in each) + "</ol>",
        ))

    def box(kind: str, tags: str, inner: str) -> str:
        tag = pick(tags.split())
        own = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form"}.get(kind)
        if own and chance(0.5):
            return f"<{own}{pick(('', ' ' + named(kind)))}>{inner}</{own}>"
        return f"<{tag} {named(kind)}>{inner}</{tag}>"

    def junk(kind: str) -> str:
        heading = pick(("", f"<h3>{sentence(1, 3)}</h3>", f"<h2>{sentence(1, 3)}</h2>", f"<strong>{sentence(1, 3)}</strong>"))
        if kind == "nav":
            return box(kind, "div div ul section", links(some(2, 10)))
        if kind == "header":
            return box(kind, "div div section", pick((f"<h2>{sentence(1, 4)}</h2>", f"<p>{sentence(2, 10)}</p>", link(1, 3) + links(4), sentence(2, 10), f"<h1>{link(1, 3)}</h1><p>{sentence(2, 8)}</p>")))
        if kind == "footer":
            mark = pick(("&copy; 2019 ", "Copyright ", "(c) ", "&#169; ", ""))
            return box(kind, "div div section", pick((mark + sentence(3, 25), f"<p>{mark}{sentence(3, 20)}</p>", links(6), links(5) + f"<p>{mark}{sentence(5, 15)}</p>", f"<p>{prose(2)}</p>", f"<address>{sentence(3, 9)}</address>{mark}{word()}")))
        if kind == "aside":
            return box(kind, "div div section", heading + pick((links(5), "".join(f"<p>{prose(some(1, 2))}</p>" for _ in range(some(1, 3))), f"<p>{prose(1)}</p>" + links(3))))
        if kind == "ad":
            return box(kind, "div div section aside p span", pick((sentence(3, 30), sentence(3, 12) + " " + link(1, 3), link(2, 6), prose(2))))
        if kind == "notice":
            return box(kind, "div div section", pick((sentence(6, 30), f"<p>{prose(2)}</p><button>{word()}</button>", f"<p>{sentence(8, 25)}</p>", f"{sentence(5, 20)} {link(1, 2)}")))
        if kind == "form":
            return box(kind, "div section", f"<form action=x><label>{sentence(1, 3)}</label><input name=q>" + pick(("", f"<p>{sentence(4, 15)}</p>", f"<select><option>{word()}<option>{word()}</select>")) + f"<button>{word()}</button></form>")
        if kind == "comments":
            tag = pick(("div", "li", "article", "section"))
            one = lambda: f'<{tag} class="{pick(("comment", "reply", "comment-body", "response"))}">{pick(("", "<b>" + word() + "</b> "))}<p>{prose(some(1, 4))}</p></{tag}>'
            bare = lambda: f"<p>{prose(some(1, 4))}</p>"
            each = pick((one, one, bare))
            return box(kind, "div div section", heading + "".join(each() for _ in range(some(1, 8))))
        return box("share", "div div p ul", links(some(2, 5)))

    def paragraph() -> str:
        p = prose(pick((1, 1, 2, 3, 5, 8)))
        if chance(0.2):
            p += " " + link(1, 4) + " " + sentence(3, 10)
        if chance(0.15):
            tag = pick(("em", "b", "i", "strong", "span", "code"))
            p = f"<{tag}>{sentence(1, 6)}</{tag}> {p}" if chance(0.8) else f"<{tag}>{p}"  # now and then left open
        if chance(0.1):
            p = p.replace(" ", "<br>", 1)
        return p

    def article() -> str:
        out = [f"<h{some(1, 2)}>{sentence(2, 12)}</h1>"] if chance(0.8) else []
        if chance(0.2):
            out.append(f'<p class="{pick(("byline", "meta-author", "lead", "intro", "standfirst", "dek"))}">{sentence(3, 12)}</p>')
        tag = pick(("p", "p", "p", "p", "div"))
        closed = chance(0.8)
        for _ in range(pick((1, 1, 2, 3, 4, 6, 9, 14))):
            out.append(f"<{tag}>{paragraph()}" + (f"</{tag}>" if closed or tag == "div" else ""))
            if chance(0.1):
                out.append("<h{0}>{1}</h{0}>".format(some(2, 4), sentence(1, 8)))
            if chance(0.08):
                out.append("<ul>" + "".join(f"<li>{sentence(2, 25)}</li>" for _ in range(some(2, 7))) + "</ul>")
            if chance(0.05):
                out.append(f"<blockquote><p>{prose(2)}</p></blockquote>")
            if chance(0.04):
                out.append(f"<pre>{sentence(5, 40)}</pre>")
            if chance(0.04):
                out.append("<table>" + "".join(f"<tr><td>{sentence(1, 4)}</td><td>{sentence(1, 4)}</td></tr>" for _ in range(some(2, 6))) + "</table>")
            if chance(0.04):
                out.append(f"<figure><img src=x><figcaption>{sentence(4, 15)}</figcaption></figure>")
            if chance(0.07):
                out.append("\x01" + junk(pick(("ad", "share", "aside", "notice", "form"))) + "\x02")
        return "".join(out)

    def wrapped(inner: str) -> str:
        """The article in zero to three containers, some of which say what they hold."""
        plain = chance(0.85)
        for depth in range(pick((1, 1, 2, 3)) if plain else 0):
            tag = pick(("article", "article", "main", "section", "div", "div")) if depth == 0 else pick(("div", "div", "main", "section"))
            name = "" if tag in ("article", "main") and chance(0.6) else pick((f' class="{pick(MAIN_NAMES.split())}"', f' id="{pick(MAIN_NAMES.split())}"', f' class="{pick(MAIN_NAMES.split())} {word()}"', ""))
            inner = f"<{tag}{name}>{inner}</{tag}>"
        return inner if plain else f"<div>{inner}</div>"

    def page() -> str:
        part = lambda *kinds: "\x01" + junk(pick(kinds)) + "\x02"
        top = [part("nav", "header", "ad", "notice", "form", "nav", "share") for _ in range(some(0, 4))]
        low = [part("comments", "aside", "ad", "share", "form", "notice", "comments", "nav") for _ in range(some(0, 4))]
        if chance(0.8):
            low.append(part("footer"))
        middle = wrapped(article())
        if chance(0.2):  # columns
            side = part("aside", "nav", "ad")
            middle = pick((f'<table><tr><td>{side}</td><td>{middle}</td></tr></table>', f'<div class="row"><div class="col">{middle}</div><div class="col">{side}</div></div>'))
        body = "".join(top) + middle + "".join(low)
        for _ in range(pick((0, 0, 0, 1, 2))):
            body = f'<div {pick(("class", "id"))}="{pick(("page", "wrap", "wrapper", "container", "root", "layout", "site", "outer"))}">{body}</div>'
        return body

    return [page() for _ in range(n)]


@functools.lru_cache(maxsize=2)
def default_extractor(pages: int = 400, seed: int = 7) -> Extractor:
    """Fits attribute-token weights and trees on `pages` generated pages."""
    made = training_pages(pages, seed)
    marked, plain = Nodes(), Nodes()
    junk: list[np.ndarray] = []
    for page in made:
        at = len(marked.parent)
        marked.add(page.replace("\x01", "<x-junk>").replace("\x02", "</x-junk>"))
        plain.add(page.replace("\x01", "").replace("\x02", ""))
        junk.append(np.array(_inside(marked, at)))
    bad = np.concatenate(junk).astype(bool)
    if len(bad) != len(plain.parent):
        raise ValueError("generated pages parse differently with and without their marks")
    seen = {0: Counter(), 1: Counter()}
    for tokens, b in zip(plain.tokens, bad.tolist(), strict=True):
        seen[int(b)].update(set(tokens))
    weights = {t: math.log((seen[0][t] + 0.5) / (seen[1][t] + 0.5)) for t in {*seen[0], *seen[1]} if seen[0][t] + seen[1][t] >= 3}
    nodes = Nodes(weights)
    for page in made:
        nodes.add(page.replace("\x01", "").replace("\x02", ""))
    x, _ = nodes.features()
    return Extractor(weights, boosting.fit(x, (~bad).astype(float)))


def _inside(marked: Nodes, at: int) -> list[bool]:
    """For the blocks of the page from `at` on, but the marks themselves: whether they stand in a marked part."""
    out, until = [], -1
    for i in range(at, len(marked.parent)):
        if marked.kind[i] == OTHER and i >= until:
            until = marked.end[i]
            continue
        out.append(i < until)
    return out


def _extract(model: Extractor):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            pages = batch.column("html").to_pylist()
            texts: list[str] = []
            group, size = [], 0
            for page in pages:  # some 2 million characters at a time
                group.append(page)
                size += len(page)
                if size > 2_000_000:
                    texts += model.texts(group)
                    group, size = [], 0
            texts += model.texts(group)
            yield pa.RecordBatch.from_arrays([batch.column("page"), batch.column("url"), pa.array(texts, pa.string())], names=["page", "url", "text"])

    return run


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html", model: Extractor | None = None) -> DataFrame:
    """Per row: id, url, text (blocks joined by a line feed). One pass, no shuffle."""
    rows = pages.select(F.col(id_col).alias("page"), F.col(url_col).cast("string").alias("url"), F.coalesce(F.col(html_col).cast("string"), F.lit("")).alias("html"))
    kind = rows.schema["page"].dataType.simpleString()
    out = rows.mapInArrow(_extract(model or default_extractor()), f"page {kind}, url string, text string")
    return out.select(F.col("page").alias(id_col), F.col("url").alias(url_col), "text", F.char_length("text").cast("long").alias("n_chars"))
