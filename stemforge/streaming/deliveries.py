"""Streaming extensions: deliveries as a stream (not part of the batch parity).

Repeated events are dropped within the watermark, and each micro-batch is written as a part of its own, named by its
number. A batch that is run again after a failure replaces its own part and nothing is counted twice; nothing else is
rewritten, and the current rows are the last of each key over all parts.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from stemforge.operators.snapshots import latest_rows


def once(events: DataFrame, key: str, at: str, delay: str = "1 day") -> DataFrame:
    """The first of each key within the delay; later copies that come in time are dropped."""
    return events.withWatermark(at, delay).dropDuplicatesWithinWatermark([key])


def windowed_scores(events: DataFrame, at: str, delay: str = "1 hour", width: str = "1 day") -> DataFrame:
    """(window, qid, n, hits) per tumbling window; late rows beyond the delay are left out."""
    return events.withWatermark(at, delay).groupBy(F.window(at, width), "qid").agg(F.count("*").alias("n"), F.count_if("correct").alias("hits"))


def upsert_stream(events: DataFrame, path: str, key: str, order: list[str], checkpoint: str) -> StreamingQuery:
    """Upsert each micro-batch into the parquet table at ``path``, which ``current`` reads: of a batch, the last row of each key."""

    def batch(df: DataFrame, number: int) -> None:
        latest_rows(df.where(F.col(key).isNotNull()), [key], order).write.mode("overwrite").parquet(f"{path}/batch={number}")

    return events.writeStream.foreachBatch(batch).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def current(spark: SparkSession, path: str, key: str, order: list[str]) -> DataFrame:
    """The last row of each key over all batches, by ``order`` and then the batch."""
    return latest_rows(spark.read.parquet(path), [key], [*order, "batch"]).drop("batch")
