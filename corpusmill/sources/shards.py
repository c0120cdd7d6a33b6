"""Sharded datasets on shared storage: base/shard=<i>/kind=<kept|trashed>/part-*.parquet."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.rank import first_rows

KEPT, TRASHED = "kept", "trashed"


def shard_name(i: int) -> str:
    return f"shard_{i}"


def shard_path(base: str, i: int) -> str:
    return f"{base.rstrip('/')}/shard={i}"


def read_capped(spark: SparkSession, path: str, rows: int | None, order: str) -> DataFrame:
    """A source and its first rows, in order of a numeric column."""
    df = spark.read.parquet(path)
    return df if rows is None else first_rows(df, order, rows)


def round_robin(df: DataFrame, shards: int, row_id: str = "row_id") -> DataFrame:
    """Row r goes to shard r mod `shards`."""
    return df.withColumn("shard", F.pmod(F.col(row_id), F.lit(shards)).cast("int"))


def write_shards(df: DataFrame, base: str, kind: str = KEPT, max_records: int = 2_000_000) -> None:
    """Writes rows with a `shard` column; each shard and kind that occurs is replaced, no other is touched.

    Rows of a shard are spread over tasks, so no shard is one task.
    """
    out = df.withColumn("kind", F.lit(kind))
    writer = out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").option("maxRecordsPerFile", max_records)
    writer.partitionBy("shard", "kind").parquet(base)


def push_shard(df: DataFrame, base: str, i: int, kind: str = KEPT) -> None:
    """Replaces one shard of one kind."""
    write_shards(df.withColumn("shard", F.lit(i)), base, kind)


def _exists(spark: SparkSession, path: str) -> bool:
    try:
        spark.read.parquet(path).schema  # noqa: B018
        return True
    except AnalysisException as e:
        if "PATH_NOT_FOUND" in str(e) or "UNABLE_TO_INFER_SCHEMA" in str(e):
            return False
        raise


def load_shard(spark: SparkSession, base: str, i: int | None, kind: str = KEPT) -> DataFrame:
    """Exactly shard i; an unsharded dataset counts as shard 0; never another shard. None: the dataset as it is."""
    if i is None:
        return spark.read.parquet(base)
    path = f"{shard_path(base, i)}/kind={kind}"
    if _exists(spark, path):
        return spark.read.parquet(path)
    if i == 0 and _exists(spark, base) and "shard" not in spark.read.parquet(base).columns:
        return spark.read.parquet(base)
    raise FileNotFoundError(f"{base} has no {shard_name(i)} of kind {kind}")


def load_all_shards(spark: SparkSession, base: str, kind: str | None = KEPT) -> DataFrame:
    """All shards of a kind; None: trashed rows too. Partition pruning reads only the kind asked for."""
    df = spark.read.option("mergeSchema", "true").parquet(base)
    return df if kind is None or "kind" not in df.columns else df.where(F.col("kind") == kind).drop("kind")


def table_from_columns(spark: SparkSession, columns: dict[str, list], schema: str | None = None) -> DataFrame:
    """A table of equally long columns."""
    lengths = {len(v) for v in columns.values()}
    if len(lengths) > 1:
        raise ValueError(f"columns differ in length: { {k: len(v) for k, v in columns.items()} }")
    return spark.createDataFrame(list(zip(*columns.values(), strict=True)), schema or list(columns))


def dataset_names(base: str, stages: Iterable[str] = ("raw", "filtered", "gen", "stat"), kinds: Iterable[str] = ("train", "val", "test")) -> list[str]:
    """Names of all datasets but the raw one; gen and stat come in every kind."""
    out = []
    for stage in stages:
        if stage == "raw":
            continue
        out += [f"{base}-{stage}-{k}" for k in kinds] if stage in ("gen", "stat") else [f"{base}-{stage}"]
    return out


def kind_of(config_folder: str) -> str:
    """train, val or test, from the folder a configuration lies in."""
    found = re.search(r"(?:^|/)(train|val|test)/?$", config_folder)
    if not found:
        raise ValueError(f"no dataset kind in {config_folder}")
    return found[1]


def read_splits(spark: SparkSession, base: str, seed: int, splits: Iterable[str] = ("train", "val")) -> list[DataFrame]:
    """Training splits in a seeded random order: dealt to tasks and sorted in each by a seeded hash of the row."""

    def shuffled(df: DataFrame) -> DataFrame:
        mixed = df.withColumn("_order", F.xxhash64(F.lit(seed), *[F.col(f"`{c}`") for c in df.columns]))
        return mixed.repartition("_order").sortWithinPartitions("_order").drop("_order")

    return [shuffled(spark.read.parquet(f"{base}/{s}")) for s in splits]


def delete_dataset(spark: SparkSession, path: str, confirmed: bool) -> bool:
    """Deletes one dataset folder if that was confirmed; says whether it was there."""
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    files = where.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return bool(confirmed and files.exists(where) and files.delete(where, True))
