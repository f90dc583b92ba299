"""Thin wrappers that start streaming queries."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

EVERY_30_SECONDS = {"processingTime": "30 seconds"}
ONCE_THROUGH = {"availableNow": True}


def to_parquet(
    df: DataFrame,
    path: str,
    checkpoint: str,
    *,
    partition_by: Sequence[str] = (),
    trigger: dict = EVERY_30_SECONDS,
) -> StreamingQuery:
    """Append a stream to a Parquet folder, exactly once per checkpoint."""
    return (
        df.writeStream.format("parquet")
        .option("path", path)
        .option("checkpointLocation", checkpoint)
        .partitionBy(*partition_by)
        .outputMode("append")
        .trigger(**trigger)
        .start()
    )


def for_each_batch(
    df: DataFrame,
    handle: Callable[[DataFrame, int], None],
    checkpoint: str,
    *,
    output_mode: str = "append",
    trigger: dict = EVERY_30_SECONDS,
) -> StreamingQuery:
    """Hand every micro-batch to ``handle``, which must be idempotent per batch id."""
    return (
        df.writeStream.foreachBatch(handle)
        .option("checkpointLocation", checkpoint)
        .outputMode(output_mode)
        .trigger(**trigger)
        .start()
    )


def to_console(df: DataFrame, checkpoint: str, *, trigger: dict = EVERY_30_SECONDS) -> StreamingQuery:
    """Print changed rows of every trigger."""
    return (
        df.writeStream.format("console")
        .option("truncate", "false")
        .option("checkpointLocation", checkpoint)
        .outputMode("update")
        .trigger(**trigger)
        .start()
    )


@contextmanager
def state_partitions(spark: SparkSession, partitions: int) -> Iterator[None]:
    """Shuffle width of stateful queries started inside; their first run fixes it for good, so it
    is chosen for the feed and not taken from the cores at hand."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(partitions))
    try:
        yield
    finally:
        spark.conf.set(key, before)
