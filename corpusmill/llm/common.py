"""Shared parts of the training-data operators: shared storage, keys, word digests, salted joins, bounded samples."""

from __future__ import annotations

import atexit
import functools
import tempfile
import uuid
from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

U64 = np.uint64
#: Key of documents without an id; they sort after all others.
NO_ID = 9223372036854775807
#: Bytes of text handled at once; bounds the scratch arrays.
PIECE = 1 << 19
#: Rows of an Arrow batch that a worker takes up at once; texts are long, and scratch grows with them.
SLICE_ROWS = 1000


def checkpoint_dir(spark: SparkSession) -> str:
    """The shared folder of the cluster. Only a single-machine session (tests) gets one of its own where none is set."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        current = spark.sparkContext._jsc.sc().getCheckpointDir()
        if current.isDefined():
            return current.get()
        master = spark.sparkContext.master
        if master != "local" and not master.startswith("local["):
            raise ValueError("spark.checkpoint.dir is not set: intermediate tables need a folder that all executors share")
        path = tempfile.mkdtemp(prefix="corpusmill-checkpoint-")
    if spark.sparkContext._jsc.sc().getCheckpointDir().isEmpty():
        spark.sparkContext.setCheckpointDir(path)
    return path


def _delete(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(where, True)


@functools.cache
def _run_folder(application: str) -> str:
    """Name of the folder of this driver's tables."""
    return f"corpusmill/run-{uuid.uuid4().hex}"


@functools.cache
def _delete_at_exit(spark: SparkSession, folder: str) -> None:
    """Tables of this driver that a result may still read go when the driver ends."""
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(folder)
    conf = spark.sparkContext._jsc.hadoopConfiguration()

    def clean() -> None:
        try:
            where.getFileSystem(conf).delete(where, True)
        except Exception:  # noqa: BLE001 - the JVM may be gone already; nothing else depends on this
            pass

    atexit.register(clean)


def shared_path(spark: SparkSession, name: str) -> str:
    """Where a new table in the shared checkpoint folder goes. All tables of a driver lie in one folder, deleted at its end."""
    folder = f"{checkpoint_dir(spark).rstrip('/')}/{_run_folder(spark.sparkContext.applicationId)}"
    _delete_at_exit(spark, folder)
    return f"{folder}/{name}-{uuid.uuid4().hex}"


def shared_table(df: DataFrame, name: str) -> DataFrame:
    """Cuts the lineage through a compressed Parquet table in the shared checkpoint folder.

    Unlike a checkpoint it also resets the planner's size estimates, which otherwise multiply from
    round to round of an iterative plan.
    """
    spark = df.sparkSession
    path = shared_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    out = spark.read.schema(df.schema).parquet(path)
    out._shared_path = path
    return out


def cut(df: DataFrame) -> DataFrame:
    return shared_table(df, "cut")


def forget(*tables: DataFrame | None) -> None:
    """Deletes shared tables that nothing reads any more."""
    for df in tables:
        if df is not None and (path := getattr(df, "_shared_path", None)):
            _delete(df.sparkSession, path)


def slices(batches: Iterator[pa.RecordBatch], rows: int = SLICE_ROWS) -> Iterator[pa.RecordBatch]:
    """The batches in slices of at most `rows` rows, so a worker's scratch does not depend on the session's batch size."""
    for batch in batches:
        for at in range(0, batch.num_rows, rows):
            yield batch.slice(at, rows)


def hot_keys(df: DataFrame, on: list[str], least: int = 1000, share: float = 1 / 2000) -> list[int]:
    """Hashes of the keys that hold over `share` of the rows (so fewer than 1/share of them) and over `least` rows.

    One pass with a frequent-items sketch per task; `df` is best a stored table.
    """
    found = df.agg(F.expr(f"approx_top_k(xxhash64({', '.join(f'`{c}`' for c in on)}), 1000, 20000)").alias("top"), F.count(F.lit(1)).alias("n")).first()
    return [r["item"] for r in found["top"] or [] if r["count"] > max(least, share * found["n"])]


def salted_join(left: DataFrame, right: DataFrame, on: list[str], how: str = "inner", salts: int = 32) -> DataFrame:
    """left.join(right, on, how) for a right side with few rows per key: rows of hot keys of `left` are dealt to
    `salts` groups, and the right rows of just those keys are repeated in each. `how`: inner, left, left_semi or left_anti."""
    hot = hot_keys(left, on)
    if not hot:
        return left.join(right, on, how)
    is_hot = F.xxhash64(*on).isin(hot)
    dealt = left.withColumn("_salt", F.when(is_hot, F.pmod(F.xxhash64(F.lit(7), *left.columns), F.lit(salts))).otherwise(F.lit(0)).cast("int"))
    repeated = right.withColumn("_salt", F.explode(F.when(is_hot, F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))))
    return dealt.join(repeated, [*on, "_salt"], how).drop("_salt")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Columns that identify a text: its id (NO_ID where null) and a fingerprint, so rows of one id but different texts stay apart.
KEYS = ["k", "fp"]


def key_columns(id_col: str = "doc_id", text_col: str = "text") -> list[Column]:
    return [F.coalesce(F.col(id_col).cast("long"), F.lit(NO_ID)).alias("k"), F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("fp")]


def documents_keyed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(k, fp, text, row): keys, text with null as empty, and the input row as one struct, whose columns can clash with nothing.

    Equal rows share their keys and get equal results.
    """
    return docs.select(*key_columns(id_col, text_col), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text"), F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("row"))


def mix(h: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (splitmix64)."""
    h = h.astype(U64, copy=True)
    h ^= h >> U64(30)
    h *= U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(27)
    h *= U64(0x94D049BB133111EB)
    h ^= h >> U64(31)
    return h


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, U64)
    out[0] = 1
    done = 1
    while done < n:  # doubling: out[done:2*done] = out[:done] * base**done
        step = min(done, n - done)
        out[done : done + step] = out[:step] * U64(pow(base, done, 1 << 64))
        done += step
    return out


@functools.lru_cache(maxsize=16)
def powers(base: int, log: int) -> tuple[np.ndarray, np.ndarray]:
    """base**j and base**-j modulo 2**64 for j below 2**log."""
    return _powers(base, 1 << log), _powers(pow(base, -1, 1 << 64), 1 << log)


def range_hash(values: np.ndarray, starts: np.ndarray, ends: np.ndarray, base: int) -> np.ndarray:
    """Polynomial hash modulo 2**64 of values[start:end], for each pair."""
    log = max(10, int(len(values)).bit_length())
    up, down = powers(base, log)
    total = np.empty(len(values) + 1, U64)
    total[0] = 0
    np.cumsum(values * up[: len(values)], out=total[1:])
    return (total[ends] - total[starts]) * down[starts]


BASE_A = 0xD1342543DE82EF95 | 1


class WordTable(dict):
    """Index of every word seen, and the words not digested yet."""

    def __init__(self):
        super().__init__()
        self.fresh: list[bytes] = []

    def __missing__(self, word: bytes) -> int:
        i = len(self)
        self[word] = i
        self.fresh.append(word)
        return i


class WordDigests:
    """128-bit BLAKE2b digests of words, remembered for some 400,000 words or 32 MB of them."""

    MOST_WORDS, MOST_BYTES = 400_000, 1 << 25

    def __init__(self):
        self.clear()

    def clear(self) -> None:
        self.table, self.bytes = WordTable(), 0
        self.digests = np.empty((1 << 12, 2), U64)

    def __call__(self, words: list[bytes]) -> np.ndarray:
        """An array of len(words) x 2."""
        if len(self.table) > self.MOST_WORDS or self.bytes > self.MOST_BYTES:
            self.clear()
        at = len(self.table)
        which = np.fromiter(map(self.table.__getitem__, words), np.int64, len(words))
        if fresh := self.table.fresh:
            need = at + len(fresh)
            if need > len(self.digests):
                self.digests = np.concatenate((self.digests, np.empty((max(need - len(self.digests), len(self.digests)), 2), U64)))
            made = b"".join([blake2b(w, digest_size=16).digest() for w in fresh])
            self.digests[at:need] = np.frombuffer(made, "<u8").reshape(-1, 2)
            self.bytes += sum(map(len, fresh))
            self.table.fresh = []
        return self.digests[which]


@functools.lru_cache(maxsize=1)
def word_digests() -> WordDigests:
    return WordDigests()


def text_pieces(text: bytes) -> Iterator[bytes]:
    """A text in pieces of some PIECE bytes that end at white space."""
    at, n = 0, len(text)
    while n - at > PIECE:
        to = at + PIECE
        while to < n and text[to] not in b" \t\n\x0b\x0c\r":
            to += 1
        yield text[at:to]
        at = to
    yield text[at:]


def text_digests(text: bytes, fold: bool) -> np.ndarray:
    """Digests of the words (runs of bytes other than space and 09-0D; A-Z as a-z if fold) of a text."""
    digest = word_digests()
    parts = [digest((p.lower() if fold else p).split()) for p in text_pieces(text)]
    return parts[0] if len(parts) == 1 else np.concatenate(parts)


def run_digests(words: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """128-bit BLAKE2b digest of each run of words (of their digests), as an array of runs x 2."""
    data = memoryview(np.ascontiguousarray(words)).cast("B") if len(words) else memoryview(b"")
    made = b"".join([blake2b(data[a:b], digest_size=16).digest() for a, b in zip((starts * 16).tolist(), (ends * 16).tolist(), strict=True)])
    return np.frombuffer(made, "<u8").reshape(-1, 2).astype(U64)


def binary_parts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and bytes of a binary or string Arrow column without nulls."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    large = pa.types.is_large_binary(column.type) or pa.types.is_large_string(column.type)
    _, offsets, data = column.buffers()
    off = np.frombuffer(offsets, np.int64 if large else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return off, raw


def text_chunks(off: np.ndarray, most: int = PIECE) -> Iterator[tuple[int, int]]:
    """Ranges of rows of up to `most` bytes in all (a longer text alone)."""
    at, n = 0, len(off) - 1
    while at < n:
        to = int(np.searchsorted(off, off[at] + most, side="right")) - 1
        to = min(n, max(at + 1, to))
        yield at, to
        at = to


def chunk_words(off: np.ndarray, raw: np.ndarray, fold: bool) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Per range of rows: first row, end row, word digests (words x 2), and where each row's words start (one more than rows)."""
    for a, b in text_chunks(off):
        each = [text_digests(raw[off[i] : off[i + 1]].tobytes(), fold) for i in range(a, b)]
        yield a, b, np.concatenate(each), np.concatenate(([0], np.cumsum([len(x) for x in each])))


def signed(a: np.ndarray) -> pa.Array:
    return pa.array(a.view(np.int64))


def class_shares(df: DataFrame, label: str, key: Column, want: dict[object, int] | int, most: int = 4096) -> dict[object, float]:
    """Per label value, the share of its distinct keys that leaves about the wanted number of them.

    Labels are classes: more than `most` distinct values is an error, never a cut.
    """
    rows = df.groupBy(label).agg(F.approx_count_distinct(key, 0.02).alias("n")).limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"column {label} has more than {most} values; it does not hold classes")
    return {r[0]: min(1.0, (want if isinstance(want, int) else want.get(r[0], 0)) / max(1, r["n"])) for r in rows}


def in_sample(label: str, key_hash: Column, shares: dict[object, float]) -> Column:
    """Whether a row's key hash falls below its label's share; all rows of one key and label answer alike."""
    share = F.lit(0.0)
    for value, s in shares.items():
        share = F.when(F.col(label).eqNullSafe(F.lit(value)), F.lit(s)).otherwise(share)
    return F.pmod(key_hash, F.lit(2_147_483_647)) / 2_147_483_647.0 < share
