"""Session settings every job relies on, and the shared scratch folder."""

from __future__ import annotations

import uuid

from pyspark.sql import SparkSession

# Runtime settings that decide results or that keep wide plans healthy.
SESSION_DEFAULTS = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.sources.partitionOverwriteMode": "dynamic",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Joins carry no broadcast hints: a side is broadcast when the planner or the
    # adaptive run finds it below the threshold. File sizes are compressed sizes, so
    # they are scaled before that check.
    "spark.sql.sources.fileCompressionFactor": "3.0",
    # Stream state lives off the heap, spills to local disk and is logged to the checkpoint.
    "spark.sql.streaming.stateStore.providerClass": (
        "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
    ),
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    # Joined inputs wait for the slowest feed; the other policy would drop its rows as late.
    "spark.sql.streaming.multipleWatermarkPolicy": "min",
}


def configure(spark: SparkSession) -> SparkSession:
    """Apply the runtime defaults to an existing session and return it."""
    for key, value in SESSION_DEFAULTS.items():
        if spark.conf.get(key, None) != value:
            spark.conf.set(key, value)
    return spark


def build_session(app_name: str, master: str | None = None, **conf: str) -> SparkSession:
    builder = SparkSession.builder.appName(app_name)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return configure(builder.getOrCreate())


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh folder below the shared checkpoint folder of the cluster.

    Where ``spark.checkpoint.dir`` is unset the warehouse serves, which executors share too.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.conf.get("spark.sql.warehouse.dir")
    return f"{base.rstrip('/')}/throngcast/{name}-{uuid.uuid4().hex}"
