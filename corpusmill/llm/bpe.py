"""BPE encoding and decoding with a public vocabulary file.

A word's symbols form a doubly linked list; a priority queue holds its adjacent pairs by merge rank
(then place). The pair of lowest rank is merged, its neighbours are relinked and their new pairs
queued; entries whose symbols have changed since are stale and skipped. Decoding joins the
vocabulary strings of the ids as the file's library does without a decoder: with spaces.

The file's own rules are followed: special tokens are cut out of the raw text first, then the text
is normalised (NFC, white space, lower case), split into words, and each word is written in the
byte alphabet with the end-of-word suffix on its last symbol. Encodings of words and of
space-separated pieces are memoised up to a fixed number of entries per worker, then afresh.

Defined cases: null or empty text: no ids. Empty table: no rows. Repeated rows are encoded each, alike;
pairs of equal rank are merged from the left. Very long texts are encoded whole, word by word; the ids
stand once in memory. Columns not named in `id_cols` are ignored, whatever their names. Vocabulary
files are read by path and never copied; each worker loads the file once.
"""

from __future__ import annotations

import functools
import hashlib
import heapq
import json
import unicodedata
from array import array
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Entries kept by each memo of a worker.
MEMO = 200_000


def default_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def byte_alphabet() -> list[str]:
    """The printable character that stands for each byte: itself where printable, else the next from U+0100."""
    shown = {*range(33, 127), *range(161, 173), *range(174, 256)}
    spare = iter(range(256, 512))
    return [chr(b) if b in shown else chr(next(spare)) for b in range(256)]


def merge_word(symbols: list[int], ranks: dict[tuple[int, int], tuple[int, int]]) -> list[int]:
    """Applies the merges of `ranks` (pair to rank and merged id) to a word, lowest rank first, leftmost on ties."""
    n = len(symbols)
    if n < 2:
        return symbols
    sym = list(symbols)
    left, right = list(range(-1, n - 1)), list(range(1, n + 1))
    right[-1] = -1
    queue = []
    for i in range(n - 1):
        found = ranks.get((sym[i], sym[i + 1]))
        if found:
            queue.append((found[0], i, found[1]))
    heapq.heapify(queue)
    while queue:
        rank, i, made = heapq.heappop(queue)
        j = right[i]
        if sym[i] < 0 or j < 0:
            continue
        now = ranks.get((sym[i], sym[j]))
        if now is None or now[0] != rank:  # stale: one of the two has changed since
            continue
        sym[i], sym[j] = made, -1
        after = right[j]
        right[i] = after
        if after >= 0:
            left[after] = i
            found = ranks.get((made, sym[after]))
            if found:
                heapq.heappush(queue, (found[0], i, found[1]))
        before = left[i]
        if before >= 0:
            found = ranks.get((sym[before], made))
            if found:
                heapq.heappush(queue, (found[0], before, found[1]))
    return [s for s in sym if s >= 0]


class WordBpe:
    """Encoder and decoder of one vocabulary file of the word kind."""

    def __init__(self, path: str):
        import regex

        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        self.vocab: dict[str, int] = model["vocab"]
        self.suffix = model.get("end_of_word_suffix") or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.strings = {i: s for s, i in self.vocab.items()} | {i: s for s, i in self.special.items()}
        self.ranks = {}
        for rank, pair in enumerate(model["merges"]):
            a, b = pair if isinstance(pair, list) else pair.split(" ")
            self.ranks[self.vocab[a], self.vocab[b]] = (rank, self.vocab[a + b])
        self.symbol = [self.vocab[c] for c in byte_alphabet()]
        self.final = [self.vocab[c + self.suffix] for c in byte_alphabet()]
        pattern = next(p["pattern"]["Regex"] for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")
        self.words = regex.compile(pattern)
        self.cut = regex.compile("(" + "|".join(regex.escape(s) for s in sorted(self.special, key=len, reverse=True)) + ")") if self.special else None
        self.space = regex.compile("[\\t-\\r \\x85\\xa0\\u1680\\u2000-\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000]+")
        self.odd_space = regex.compile("[\\x1c-\\x1f]")
        self.word_memo: dict[str, list[int]] = {}
        self.piece_memo: dict[str, list[int]] = {}

    def word(self, word: str) -> list[int]:
        ids = self.word_memo.get(word)
        if ids is None:
            raw = word.encode("utf-8", "replace")
            ids = merge_word([*[self.symbol[b] for b in raw[:-1]], self.final[raw[-1]]], self.ranks)
            if len(word) < 100:
                if len(self.word_memo) >= MEMO:
                    self.word_memo.clear()
                self.word_memo[word] = ids
        return ids

    def piece(self, piece: str) -> list[int]:
        """Ids of a piece without white space."""
        ids: list[int] = []
        for w in self.words.findall(piece):
            ids += self.word(w)
        if len(piece) < 100:
            if len(self.piece_memo) >= MEMO:
                self.piece_memo.clear()
            self.piece_memo[piece] = ids
        return ids

    def _plain(self, text: str, out: array) -> None:
        if not text.isascii():
            text = unicodedata.normalize("NFC", text)
            if "Σ" in text:  # lower case is taken character by character
                text = text.replace("Σ", "σ")
        text = text.lower()
        pieces = self.space.split(text) if self.odd_space.search(text) else text.split()
        known, piece = self.piece_memo, self.piece
        for p in pieces:
            ids = known.get(p)
            out.extend(piece(p) if ids is None else ids)

    def encode(self, text: str) -> array:
        out = array("I")
        if any(t in text for t in self.special):
            for part in self.cut.split(text):
                if part in self.special:
                    out.append(self.special[part])
                else:
                    self._plain(part, out)
        else:
            self._plain(text, out)
        return out

    def decode(self, ids) -> str:
        strings = self.strings
        return " ".join([strings[i] for i in ids])


@functools.lru_cache(maxsize=4)
def load(path: str) -> WordBpe:
    return WordBpe(path)


def _encode(path: str, with_ids: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = load(path)
        for batch in batches:
            kept = [c for c in batch.schema.names if c != "text"]
            texts = batch.column("text")
            for at in range(0, max(1, batch.num_rows), 1000):
                n, sha, back, lists = [], [], [], []
                for text in texts.slice(at, 1000).to_pylist():
                    ids = bpe.encode(text)
                    n.append(len(ids))
                    sha.append(hashlib.sha256(ids.tobytes()).hexdigest())
                    back.append(hashlib.sha256(bpe.decode(ids).encode()).hexdigest())
                    if with_ids:
                        lists.append(ids)
                cols = [*[batch.column(c).slice(at, 1000) for c in kept], pa.array(n, pa.int64()), pa.array(sha, pa.string()), pa.array(back, pa.string())]
                names = [*kept, "n_tokens", "ids_sha256", "decoded_sha256"]
                if with_ids:
                    cols.append(pa.array(lists, pa.list_(pa.int32())))
                    names.append("ids")
                yield pa.RecordBatch.from_arrays(cols, names=names)

    return run


def encode_documents(docs: DataFrame, path: str | None = None, id_cols: dict[str, str] | None = None, text_col: str = "text", with_ids: bool = False) -> DataFrame:
    """Per row: `id_cols` (name to type), n_tokens, ids_sha256, decoded_sha256, and ids if asked for. One pass, no shuffle."""
    id_cols = id_cols or {"doc_id": "long"}
    rows = docs.select(*id_cols, F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"))
    schema = ", ".join(f"`{n}` {t}" for n, t in id_cols.items()) + ", n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return rows.mapInArrow(_encode(path or default_path(), with_ids), schema)


def decode_ids(df: DataFrame, path: str | None = None, ids_col: str = "ids") -> DataFrame:
    """Adds `decoded`: the text of each row's ids."""
    path = path or default_path()

    @F.pandas_udf("string")
    def decoded(ids):
        bpe = load(path)
        return ids.map(lambda x: None if x is None else bpe.decode(x))

    return df.withColumn("decoded", decoded(ids_col))
