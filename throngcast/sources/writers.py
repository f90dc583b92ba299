"""Batch sinks, micro-batch sinks and retention."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from throngcast.operators.dedupe import latest_by_key
from throngcast.sources.files import complete_numbers, delete_folder, exists, rename

BATCH_COLUMN = "batch_id"


def write_parquet(df: DataFrame, path: str, *, mode: str = "overwrite", partition_by: Sequence[str] = ()) -> None:
    """Parquet sink; overwriting a partitioned table replaces only touched partitions.

    A partitioned write is rebalanced first: tasks then hold few partition values each,
    which keeps the file count low, and adaptive execution splits large values.
    """
    if partition_by:
        df = df.hint("rebalance", *partition_by)
    df.write.mode(mode).partitionBy(*partition_by).parquet(path)


def write_keyed_store(
    df: DataFrame, table: str, *, fmt: str = "parquet", mode: str = "append", keys: Sequence[str] = (), **options: str
) -> None:
    """Keyed table through its connector; overwriting confirms the truncation.

    The Parquet table standing in for it keeps one row per key where ``keys`` are given:
    appended rows replace stored ones with their key.
    """
    if fmt == "parquet":
        if keys and mode == "append":
            spark = df.sparkSession
            ids = snapshot_ids(spark, table)
            merge_batch(df, ids[-1] + 1 if ids else 0, table, keys)
        elif keys:
            ids = snapshot_ids(df.sparkSession, table)
            append_batch(df, ids[-1] + 1 if ids else 0, table)
        else:
            write_parquet(df, table, mode=mode)
        return
    if mode == "overwrite":
        options = {"confirm.truncate": "true", **options}
    df.write.format(fmt).options(table=table, **options).mode(mode).save()


def parse_sinks(spec: str) -> list[str]:
    """Names in a comma list, blanks dropped, first mention kept."""
    return list(dict.fromkeys(name for name in map(str.strip, spec.split(",")) if name))


def write_table(
    df: DataFrame, sinks: str, targets: Mapping[str, str], *, mode: str = "overwrite", **options: str
) -> None:
    """Write one frame to every sink of a comma list.

    The Parquet target, when named, is written first and feeds the others, so
    the plan of ``df`` runs once however many sinks there are.
    """
    names = parse_sinks(sinks)
    unknown = [name for name in names if name not in targets]
    if unknown:
        raise ValueError(f"no target for sinks {unknown}; known are {sorted(targets)}")
    source = df
    if "parquet" in names:
        write_parquet(df, targets["parquet"], mode=mode)
        source = df.sparkSession.read.schema(df.schema).parquet(targets["parquet"])
    for name in names:
        if name != "parquet":
            write_keyed_store(source, targets[name], fmt=name, mode=mode, **options)


def write_documents(df: DataFrame, sink: str, *, path: str | None = None, **options: str) -> None:
    """Append scored rows to a document store, to Parquet, or show them."""
    if sink == "console":
        df.show(truncate=False)
    elif sink == "parquet":
        write_parquet(df, path, mode="append")
    elif sink == "mongodb":
        df.write.format("mongodb").options(**options).mode("append").save()
    else:
        raise ValueError(f"unsupported sink {sink!r}")


def append_batch(df: DataFrame, batch_id: int, path: str) -> None:
    """Write one micro-batch as its own partition of ``path``.

    The partition's folder is overwritten as a whole, so a retry replaces all rows of the
    first attempt, also by none.
    """
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(f"{path}/{BATCH_COLUMN}={int(batch_id)}")


def publish_batch(df: DataFrame, batch_id: int, path: str) -> bool:
    """Write one micro-batch as its own partition of ``path``, once: false where it is there already.

    The folder is renamed into place when it is whole, and a retry leaves it alone, so a stream that
    reads ``path`` meets each file once.
    """
    spark, name = df.sparkSession, f"{BATCH_COLUMN}={int(batch_id)}"
    if exists(spark, f"{path}/{name}"):
        return False
    staged = f"{path}/_staging/{name}"
    df.write.mode("overwrite").option("partitionOverwriteMode", "static").parquet(staged)
    rename(spark, staged, f"{path}/{name}")
    return True


def publish_snapshot(df: DataFrame, path: str, *, keep: int = 3) -> int:
    """Write a table anew as the newest snapshot of ``path`` and return its number.

    Readers go on with the snapshot they have, ``keep`` of which stay. A table has one writer.
    """
    spark = df.sparkSession
    ids = snapshot_ids(spark, path)
    number = ids[-1] + 1 if ids else 0
    append_batch(df, number, path)
    for old in ids[: max(0, len(ids) + 1 - keep)]:
        delete_folder(spark, f"{path}/{BATCH_COLUMN}={old}")
    return number


def batch_table(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """The complete batches below ``path`` with ``BATCH_COLUMN``; empty before the first one, and where all are empty."""
    full = T.StructType([*schema.fields, T.StructField(BATCH_COLUMN, T.LongType())])
    paths = [f"{path}/{BATCH_COLUMN}={n}" for n in snapshot_ids(spark, path)]
    if not paths:
        return spark.createDataFrame([], full)
    return spark.read.schema(full).option("basePath", path).parquet(*paths)


def keyed_view(
    spark: SparkSession, path: str, schema: T.StructType, keys: Sequence[str], order_by: Sequence[str] = ()
) -> DataFrame:
    """Latest row per key of a table written by ``append_batch``."""
    stored = batch_table(spark, path, schema)
    return latest_by_key(stored, keys, [*order_by, BATCH_COLUMN]).drop(BATCH_COLUMN)


def merge_batch(
    df: DataFrame, batch_id: int, path: str, keys: Sequence[str], order_by: Sequence[str] = (), *, keep: int = 3
) -> DataFrame:
    """Fold a micro-batch into the newest earlier snapshot and write the result as its own.

    Each snapshot holds the latest row per key, so a reader or the next batch needs only the
    newest one, however long the stream has run; older ones than ``keep`` are deleted. Returns
    the snapshot before the batch. A retried batch starts from the same earlier snapshot.
    """
    spark = df.sparkSession
    earlier = [n for n in snapshot_ids(spark, path) if n < batch_id]
    before = read_snapshot(spark, path, df.schema, earlier[-1] if earlier else None)
    newest = latest_by_key(before.withColumn("_n", F.lit(0)).unionByName(df.withColumn("_n", F.lit(1))), keys, [*order_by, "_n"])
    append_batch(newest.drop("_n"), batch_id, path)
    for old in earlier[: max(0, len(earlier) + 1 - keep)]:
        delete_folder(spark, f"{path}/{BATCH_COLUMN}={old}")
    return before


def snapshot_ids(spark: SparkSession, path: str) -> list[int]:
    """Numbers of the complete batches below ``path``, in order: as many names as batches are kept."""
    return complete_numbers(spark, path, BATCH_COLUMN)


def read_snapshot(spark: SparkSession, path: str, schema: T.StructType, batch_id: int | None = None) -> DataFrame:
    """The snapshot of a batch, by default the newest; empty where there is none."""
    ids = snapshot_ids(spark, path) if batch_id is None else [batch_id]
    if not ids:
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(f"{path}/{BATCH_COLUMN}={ids[-1]}")


def expire(spark: SparkSession, path: str, schema: T.StructType, as_of: Column, *, column: str = "inserted_at", hours: int = 24) -> int:
    """Delete the oldest batches of a micro-batch table whose rows have all expired; returns how many.

    Batches are tested from the oldest on, up to the first with a row still valid. That one stays
    whole and is filtered by ``within_retention`` when read.
    """
    gone = 0
    for batch_id in snapshot_ids(spark, path):
        rows = read_snapshot(spark, path, schema, batch_id)
        if not within_retention(rows, as_of, column=column, hours=hours).isEmpty():
            break
        delete_folder(spark, f"{path}/{BATCH_COLUMN}={batch_id}")
        gone += 1
    return gone


def within_retention(df: DataFrame, as_of: Column, *, column: str = "inserted_at", hours: int = 24) -> DataFrame:
    """Rows that have not expired at the as-of time."""
    return df.where(F.col(column) >= as_of - F.expr(f"INTERVAL {int(hours)} HOURS"))


def with_row_count(df: DataFrame, name: str, **extra: Column) -> tuple[DataFrame, Observation]:
    """Count rows in the pass that consumes the frame instead of in a second job."""
    metrics = [F.count(F.lit(1)).alias("rows"), *[value.alias(key) for key, value in extra.items()]]
    observation = Observation(name)
    return df.observe(observation, *metrics), observation


def route_messages(df: DataFrame, *, key: Column, value: Column, topic: Column, partition: Column) -> DataFrame:
    """Rows in the column layout of a keyed, partition-routed message sink."""
    return df.select(
        key.alias("key"), value.alias("value"), topic.alias("topic"), partition.cast("int").alias("partition")
    )
