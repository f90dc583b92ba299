"""Tables laid out for point lookups: folders by a hash of the key, rows in order of the key.

A lookup reads the folder of its key's bucket and no other; inside it, row groups are skipped by the
range and the bloom filter of the key. Readers go on with the snapshot they have while a new one is
published. Rows without a key are stored, but no lookup finds them.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from throngcast.sources.files import delete_folder, folder_names
from throngcast.sources.writers import BATCH_COLUMN, snapshot_ids

BUCKETS, BUCKET = "key_buckets", "key_bucket"


def bucket_of(key: Column, buckets: int) -> Column:
    return F.pmod(F.crc32(key.cast("string").cast("binary")), F.lit(buckets)).cast("int")


def publish_lookup(df: DataFrame, path: str, key: str, *, buckets: int = 64, keep: int = 3) -> int:
    """Write a table anew as the newest snapshot of ``path`` and return its number.

    The write is rebalanced by bucket, so a bucket is few files, and adaptive execution splits one
    that a hot key fills. ``buckets`` should leave each about one file's worth of rows; it is part
    of the layout, so snapshots may differ in it. A table has one writer.
    """
    spark = df.sparkSession
    ids = snapshot_ids(spark, path)
    number = ids[-1] + 1 if ids else 0
    laid_out = df.withColumns({BUCKETS: F.lit(buckets), BUCKET: bucket_of(F.col(key), buckets)})
    (
        laid_out.hint("rebalance", BUCKET)
        .sortWithinPartitions(BUCKET, key)
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .option(f"parquet.bloom.filter.enabled#{key}", "true")
        .partitionBy(BUCKETS, BUCKET)
        .parquet(f"{path}/{BATCH_COLUMN}={number}")
    )
    for old in ids[: max(0, len(ids) + 1 - keep)]:
        delete_folder(spark, f"{path}/{BATCH_COLUMN}={old}")
    return number


def find_keys(spark: SparkSession, path: str, schema: T.StructType, key: str, values: Sequence[str]) -> DataFrame:
    """Rows of the newest snapshot with one of a few keys; empty for unknown keys and before the first snapshot."""
    ids = snapshot_ids(spark, path)
    newest = f"{path}/{BATCH_COLUMN}={ids[-1]}" if ids else path
    layout = [n for n in folder_names(spark, newest) if n.startswith(f"{BUCKETS}=")] if ids else []
    if not layout or not values:
        return spark.createDataFrame([], schema)
    buckets = int(layout[0].split("=", 1)[1])
    full = T.StructType([*schema.fields, T.StructField(BUCKETS, T.IntegerType()), T.StructField(BUCKET, T.IntegerType())])
    held = F.col(BUCKET).isin(*[bucket_of(F.lit(value), buckets) for value in values])
    return spark.read.schema(full).parquet(newest).where(held & F.col(key).isin(*values)).drop(BUCKETS, BUCKET)
