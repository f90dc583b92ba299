"""Batch and streaming sources."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from throngcast.sources.writers import BATCH_COLUMN, snapshot_ids


def read_csv_files(spark: SparkSession, paths: Sequence[str]) -> DataFrame:
    """All-string CSV files with headers, united by column name.

    Each path (a file, folder or glob sharing one header) is read on its own: a
    single call over several paths would bind every file to the first header by
    position. Columns missing from a file become null.
    """
    frames = [spark.read.csv(path, header=True, inferSchema=False) for path in paths]
    return reduce(lambda left, right: left.unionByName(right, allowMissingColumns=True), frames)


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    reader = spark.read if schema is None else spark.read.schema(schema)
    return reader.parquet(path)


def read_keyed_store(spark: SparkSession, table: str, *, fmt: str = "parquet", **options: str) -> DataFrame:
    """A keyed table through its connector, or the Parquet table standing in for it."""
    if fmt == "parquet":
        ids = snapshot_ids(spark, table)
        return spark.read.parquet(f"{table}/{BATCH_COLUMN}={ids[-1]}" if ids else table)
    return spark.read.format(fmt).options(table=table, **options).load()


def load_batch_views(
    spark: SparkSession, baseline: str, station_max: str, *, source: str = "parquet", **options: str
) -> tuple[DataFrame, DataFrame]:
    """Baseline and maxima from Parquet paths or from the tables of a keyed store."""
    return (
        read_keyed_store(spark, baseline, fmt=source, **options),
        read_keyed_store(spark, station_max, fmt=source, **options),
    )


def kafka_options(
    bootstrap: str,
    topic: str,
    *,
    starting_offsets: str = "latest",
    max_offsets_per_trigger: int | None = None,
    group_prefix: str | None = None,
) -> dict[str, str]:
    """Options of the message source; ``max_offsets_per_trigger`` bounds a trigger where it is given."""
    options = {
        "kafka.bootstrap.servers": bootstrap,
        "subscribe": topic,
        "startingOffsets": starting_offsets,
    }
    if max_offsets_per_trigger is not None:
        options["maxOffsetsPerTrigger"] = str(max_offsets_per_trigger)
    if group_prefix is not None:
        options["groupIdPrefix"] = group_prefix
    return options


def kafka_stream(spark: SparkSession, **kwargs) -> DataFrame:
    return spark.readStream.format("kafka").options(**kafka_options(**kwargs)).load()


def file_stream(
    spark: SparkSession,
    path: str,
    schema: T.StructType,
    *,
    max_files_per_trigger: int | None = None,
    latest_first: bool = False,
) -> DataFrame:
    """A growing Parquet folder as a stream, with optional back-pressure."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    if latest_first:
        reader = reader.option("latestFirst", "true")
    return reader.parquet(path)


def incremental_extract(
    df: DataFrame,
    columns: Sequence[str],
    order_by: Sequence[str],
    *,
    since: str | None = None,
    limit: int | None = None,
    offset: int | None = None,
) -> DataFrame:
    """Projected rows at or after ``since`` in order, optionally one page of them.

    ``order_by`` starts with the time column the page is cut on; further columns
    make pages reproducible.
    """
    if since is not None:
        df = df.where(F.col(order_by[0]) >= F.lit(since).cast("timestamp"))
    page = df.select(*columns).orderBy(*order_by)
    if offset:
        page = page.offset(offset)
    return page if limit is None else page.limit(limit)


def load_baseline(spark: SparkSession, path: str) -> DataFrame:
    """A stored baseline with the column types of the keyed table."""
    from throngcast.schemas import CAPACITY_BASELINE

    stored = spark.read.parquet(path)
    return stored.select(*[F.col(f.name).cast(f.dataType).alias(f.name) for f in CAPACITY_BASELINE])
