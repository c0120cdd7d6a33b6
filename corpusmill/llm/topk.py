"""Exact top-k search by inner product, with a pivot table for elimination.

The distances of all vectors to a fixed number of pivots are computed beforehand and stored. For a
query q and a candidate x, |d(q,p) - d(x,p)| over all pivots p gives a lower bound of their
distance, hence an upper bound of their inner product, (|q|^2 + |x|^2 - bound^2) / 2. Candidates are
evaluated in order of that bound and a query stops as soon as the next bound is below its k-th best
score: the result is exact whatever the pivots are. A query starts from its k-th best score in the
pivot sample, and keeps its best through all batches of a task.

Queries go out in blocks of some QUERY_BLOCK rows, one block after the other: only the block in hand
is on the driver and in the tasks. Every candidate partition returns its k best per query; these are
merged, and a block's result is appended to a table in the shared folder before the next one starts.

Vectors are integers: floor(scale * component). Those that are null or hold a null or non-finite
component take no part, nor do rows without an id; only vectors of equal length are compared. A
query's candidates are the rows of other ids. Repeated rows are candidates of their own and one
query. Extra columns are ignored; an empty table, or no query, gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import shared_path, shared_table

QUERY_BLOCK = 4096
#: Above this, a component's products could leave the exact range of float64.
EXACT = 1 << 22
RESULT = "query_id long, vec_id long, score long"


def whole_vector(c: Column, scale: int = 1024) -> Column:
    """The integer vector, or null where it takes no part."""
    doubles = F.transform(c, lambda x: x.cast("double"))
    bad = F.exists(doubles, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.when(c.isNotNull() & ~bad, F.transform(doubles, lambda x: F.floor(x * scale).cast("long")))


def _matrix(column: pa.Array) -> np.ndarray:
    """Vectors of one length as rows."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    return np.asarray(column.flatten(), np.int64).reshape(len(column), -1)


def _exact(x: np.ndarray) -> np.ndarray:
    """float64 where sums of products stay exact, else Python integers."""
    return x.astype(np.float64) if not x.size or np.abs(x).max() <= EXACT else x.astype(object)


def choose_pivots(sample: np.ndarray, n: int) -> np.ndarray:
    """Farthest-first from the row nearest to the mean."""
    if not len(sample):
        return sample
    x = sample.astype(np.float64)
    at = int(((x - x.mean(0)) ** 2).sum(1).argmin())
    out, far = [at], np.full(len(x), np.inf)
    while len(out) < min(n, len(x)):
        far = np.minimum(far, ((x - x[out[-1]]) ** 2).sum(1))
        at = int(far.argmax())
        if far[at] <= 0:
            break
        out.append(at)
    return x[out]


def _distances(x: np.ndarray, pivots: np.ndarray) -> np.ndarray:
    sq = (x * x).sum(1)[:, None] + (pivots * pivots).sum(1)[None, :] - 2 * (x @ pivots.T)
    return np.sqrt(np.maximum(sq, 0))


class Search:
    """The k best rows for each query of a block, over any number of candidate batches."""

    def __init__(self, q_ids: np.ndarray, q: np.ndarray, pivots: np.ndarray, k: int, step: int = 64, sample: tuple[np.ndarray, np.ndarray] | None = None):
        self.ids, self.k, self.step, self.pivots = q_ids, k, step, pivots
        self.q, self.qf = _exact(q), q.astype(np.float64)
        self.mine = _distances(self.qf, pivots)
        self.norms = (self.qf * self.qf).sum(1)
        self.best: list[list[tuple[int, int]]] = [[] for _ in range(len(q))]
        self.least: list[int | None] = [None] * len(q)
        self.taken = 0
        if sample is not None and len(sample[0]) > k:
            ids, x = sample
            xs = _exact(x)
            for i in range(len(q)):  # the k-th best of some rows is a floor of the k-th best of all
                scores = (xs @ self.q[i])[ids != q_ids[i]]
                if len(scores) >= k:
                    self.least[i] = int(np.sort(scores)[-k])

    def add(self, ids: np.ndarray, x: np.ndarray, table: np.ndarray) -> None:
        """Takes up candidates with their distances to the pivots."""
        xs, xf = _exact(x), x.astype(np.float64)
        sizes = (xf * xf).sum(1)
        for i in range(len(self.ids)):
            low = np.abs(table - self.mine[i]).max(1) if table.shape[1] else np.zeros(len(x))
            low = np.maximum(low - 1e-9 * (low + 1), 0)
            bound = (self.norms[i] + sizes - low * low) / 2 + 1e-7 * (self.norms[i] + sizes) + 1  # the last terms cover rounding
            open_ = ids != self.ids[i]
            if self.least[i] is not None:
                open_ &= bound >= self.least[i]
            rows = np.flatnonzero(open_)
            rows = rows[np.argsort(-bound[rows], kind="stable")]
            for at in range(0, len(rows), self.step):
                chunk = rows[at : at + self.step]
                if self.least[i] is not None:
                    if bound[chunk[0]] < self.least[i]:
                        break
                    chunk = chunk[bound[chunk] >= self.least[i]]
                self.taken += len(chunk)
                made = zip((-int(v) for v in xs[chunk] @ self.q[i]), (int(v) for v in ids[chunk]), strict=True)
                self.best[i] = sorted([*self.best[i], *made])[: self.k]
                if len(self.best[i]) == self.k:
                    worst = -self.best[i][-1][0]
                    self.least[i] = worst if self.least[i] is None else max(self.least[i], worst)

    def result(self) -> list[tuple[int, int, int]]:
        """(query id, row id, score)."""
        return [(int(q), x, -s) for q, found in zip(self.ids, self.best, strict=True) for s, x in found]


Block = dict[int, tuple[np.ndarray, np.ndarray]]


def _by_length(rows) -> Block:
    """Ids and vectors by length of vector, of rows (vec_id, v)."""
    lists: dict[int, tuple[list, list]] = {}
    for r in rows:
        ids, vectors = lists.setdefault(len(r["v"]), ([], []))
        ids.append(r["vec_id"])
        vectors.append(r["v"])
    return {d: (np.array(ids, np.int64), np.array(vectors, np.int64).reshape(len(ids), d)) for d, (ids, vectors) in lists.items()}


def _groups(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, pa.RecordBatch]]:
    for batch in batches:
        lengths = np.asarray(batch.column("dim"))
        for d in np.unique(lengths).tolist():
            yield d, batch.filter(pa.array(lengths == d))


def _pivot_table(pivots: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for d, rows in _groups(batches):
            table = _distances(_matrix(rows.column("v")).astype(np.float64), pivots.get(d, np.zeros((0, d))))
            at = pa.array(np.arange(len(table) + 1, dtype=np.int32) * table.shape[1])
            yield pa.RecordBatch.from_arrays([*rows.columns, pa.ListArray.from_arrays(at, pa.array(table.reshape(-1)))], names=[*rows.schema.names, "far"])

    return run


def _search(block: Block, pivots: dict[int, np.ndarray], samples: Block, k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        searches: dict[int, Search] = {}
        for d, rows in _groups(batches):
            if d not in block:
                continue
            if d not in searches:
                searches[d] = Search(*block[d], pivots.get(d, np.zeros((0, d))), k, sample=samples.get(d))
            far = np.asarray(rows.column("far").flatten()).reshape(rows.num_rows, -1)
            searches[d].add(rows.column("vec_id").to_numpy(), _matrix(rows.column("v")), far)
        for search in searches.values():
            if found := search.result():
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], names=["query_id", "vec_id", "score"])

    return run


def top_k(vectors: DataFrame, is_query: Column, k: int = 10, id_col: str = "vec_id", vector_col: str = "embedding", scale: int = 1024, pivots: int = 32, pivot_sample: int = 2000, query_block: int = QUERY_BLOCK) -> DataFrame:
    """query_id, rank (from 1), vec_id, score: the k best of the other rows for every row where `is_query`; ties to the smaller id.

    Pivots come from at most `pivot_sample` rows, those of least id hash; any pivots give the same result.
    """
    spark = vectors.sparkSession
    x = vectors.where(F.col(id_col).isNotNull()).select(F.col(id_col).cast("long").alias("vec_id"), whole_vector(F.col(vector_col), scale).alias("v"), F.coalesce(is_query, F.lit(False)).alias("q")).where("v is not null").withColumn("dim", F.size("v"))
    samples = _by_length(x.orderBy(F.xxhash64("vec_id"), "vec_id", "v").limit(pivot_sample).select("vec_id", "v").collect())
    chosen = {d: choose_pivots(rows, pivots) for d, (_, rows) in samples.items()}
    table = shared_table(x.mapInArrow(_pivot_table(chosen), "vec_id long, v array<long>, q boolean, dim int, far array<double>"), "pivots")
    asked = table.where("q").select("vec_id", "v").dropDuplicates()
    blocks = max(1, -(-asked.count() // query_block))
    asked = shared_table(asked.withColumn("block", F.pmod(F.xxhash64("vec_id"), F.lit(blocks))), "queries")
    best = Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id")
    path = shared_path(spark, "topk")
    for i in range(blocks):
        block = _by_length(asked.where(F.col("block") == i).select("vec_id", "v").collect())  # some query_block rows
        found = table.select("vec_id", "v", "dim", "far").mapInArrow(_search(block, chosen, samples, k), RESULT) if block else spark.createDataFrame([], RESULT)
        ranked = found.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")
        if blocks == 1:
            return ranked
        ranked.write.mode("append").parquet(path)
    return spark.read.parquet(path)
