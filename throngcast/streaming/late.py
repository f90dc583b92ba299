"""Late rows kept: every batch of one input is published with a mark on the rows that windows drop.

Spark drops late rows silently. Here the newest event time up to each batch is kept beside the
rows, and a row is late when its window had closed by it. An input has its own marks; where several
are joined, the session's watermark policy (``min``) waits for the slowest, so no input makes
another's rows late.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from throngcast.sources.files import delete_folder
from throngcast.sources.writers import BATCH_COLUMN, append_batch, batch_table, publish_batch, read_snapshot, snapshot_ids
from throngcast.streaming.runner import EVERY_30_SECONDS, for_each_batch

LATE = "is_late"
MARK = T.StructType([T.StructField("newest", T.TimestampType())])


def mark_late(
    df: DataFrame,
    time: str,
    path: str,
    checkpoint: str,
    *,
    width: str = "10 seconds",
    lateness: str = "30 seconds",
    behind: int = 2,
    trigger: dict = EVERY_30_SECONDS,
) -> StreamingQuery:
    """Publish each batch below ``path/rows`` with ``LATE``; read it back with ``late_rows`` and ``rows_in_time``.

    A row is late when its window of ``width`` ends at or before the newest event time, less
    ``lateness``, of all batches up to ``behind`` ago. Two is what windows of the same feed drop
    by while every trigger has rows: a trigger uses the watermark that the one before it began
    with. A row without a time is late, as no window takes it. A retried batch meets the marks it met
    before, and a published one stays.
    """
    rows, marks = f"{path}/rows", f"{path}/marks"
    # below the rows a stream of them would meet the marks' files too, so these lie beside

    def handle(batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        kept = snapshot_ids(spark, marks)
        passed = [n for n in kept if n <= batch_id - behind]
        closed = read_snapshot(spark, marks, MARK, passed[-1]).select("newest").first()["newest"] if passed else None
        end = F.window(time, width)["end"]
        late = F.col(time).isNull()
        if closed is not None:
            late = late | (end <= F.lit(closed) - F.expr(f"INTERVAL {lateness}"))
        publish_batch(batch.withColumn(LATE, late), batch_id, rows)

        before = [n for n in kept if n < batch_id]
        own = read_snapshot(spark, rows, batch.schema, batch_id).select(F.col(time).cast("timestamp").alias("newest"))
        if before:
            own = own.unionByName(read_snapshot(spark, marks, MARK, before[-1]))
        append_batch(own.agg(F.max("newest").alias("newest")), batch_id, marks)
        for old in before[: max(0, len(before) - behind - 1)]:
            delete_folder(spark, f"{marks}/{BATCH_COLUMN}={old}")

    return for_each_batch(df, handle, checkpoint, trigger=trigger)


def _marked(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return batch_table(spark, f"{path}/rows", T.StructType([*schema.fields, T.StructField(LATE, T.BooleanType())]))


def late_rows(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows that came too late for their window, with the batch that brought them."""
    return _marked(spark, path, schema).where(LATE).drop(LATE)


def rows_in_time(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    return _marked(spark, path, schema).where(~F.col(LATE)).drop(LATE)
