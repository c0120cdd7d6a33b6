"""Incremental work on growing shard folders: new files only, first text of each kind, resumable responses."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from ..functions.text import as_text, squeeze
from ..sources.files import TurnLog


def new_rows(spark: SparkSession, path: str, schema: StructType, files_per_trigger: int = 64) -> DataFrame:
    """Rows of Parquet files as they arrive."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", files_per_trigger).parquet(path)


def first_texts(rows: DataFrame, text: str, time: str, delay: str) -> DataFrame:
    """Drops repeats of a text (case and white space aside) that come within `delay`; state is bounded by the watermark."""
    keyed = rows.withColumn("_key", F.md5(F.lower(squeeze(as_text(text)))))
    return keyed.withWatermark(time, delay).dropDuplicatesWithinWatermark(["_key"]).drop("_key")


def respond(rows: DataFrame, log: TurnLog, answer: Callable[[DataFrame], DataFrame], checkpoint: str) -> StreamingQuery:
    """Answers rows that the log lacks, batch by batch, and appends them; a repeated batch sends nothing twice."""

    def step(batch: DataFrame, _: int) -> None:
        log.append(answer(log.pending(batch, 0)), 0)

    return rows.writeStream.foreachBatch(step).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def kept_rows(rows: DataFrame, reason: Callable[[DataFrame], DataFrame], path: str, checkpoint: str) -> StreamingQuery:
    """Writes rows with their reason (null: kept), partitioned by whether they are kept."""
    marked = reason(rows).withColumn("kind", F.when(F.col("rejected_for").isNull(), "kept").otherwise("trashed"))
    return marked.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).partitionBy("kind").trigger(availableNow=True).start()
