"""Sliding-window averages in two levels."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from throngcast.operators.intervals import MICROS, time_slot


def sliding_average(
    df: DataFrame,
    keys: Sequence[str],
    time: str,
    total: Column,
    weight: Column,
    *,
    window_secs: int = 600,
    slide_secs: int = 30,
    end_column: str = "event_timestamp",
    value_column: str = "average",
) -> DataFrame:
    """``sum(total) / sum(weight)`` per key and sliding window, labelled by window end.

    Rows are first summed per slide-wide slot; only those sums are copied into the
    windows covering the slot. The copies thus scale with keys and time rather than
    with rows, and no average of averages is taken. Windows are aligned to the epoch.
    """
    if window_secs % slide_secs:
        raise ValueError("window_secs must be a multiple of slide_secs")
    slots = (
        df.withColumn("_slot", time_slot(F.col(time), slide_secs))
        .groupBy(*keys, "_slot")
        .agg(F.sum(total).alias("_total"), F.sum(weight).alias("_weight"))
    )
    ends = F.sequence(F.col("_slot") + 1, F.col("_slot") + window_secs // slide_secs)
    return (
        slots.withColumn("_end", F.explode(ends))
        .groupBy(*keys, "_end")
        .agg(F.try_divide(F.sum("_total"), F.sum("_weight")).alias(value_column))
        .select(
            *keys,
            F.timestamp_micros(F.col("_end") * slide_secs * MICROS).alias(end_column),
            value_column,
        )
    )
