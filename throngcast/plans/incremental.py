"""Baseline and audit from states per day that merge, so that a new day reads that day only.

A state holds what merges without the rows: counts, means with sums of squared deviations, maxima,
and sketches. Quantiles come from KLL sketches: exact for a cell of at most ``KLL_K`` hours, beyond
that within about 0.7 % of rank. Distinct counts come from HyperLogLog sketches: a relative
standard error of 1.6 % at most, far less for few values.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from throngcast.plans.baseline import CELL, counted_hours, lookback, with_cell
from throngcast.sources.files import delete_folder, exists

KLL_K, HLL_LG_K = 400, 12


def _write_days(states: DataFrame, path: str, days: Sequence[str] | None) -> None:
    """Replace the states of the days that occur; of ``days`` that no longer do, delete them."""
    states.hint("rebalance", "date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("date").parquet(path)
    spark = states.sparkSession
    for day in days or ():
        place = f"{path}/date={day}"
        if exists(spark, place) and states.where(F.col("date") == F.lit(day).cast("date")).isEmpty():
            delete_folder(spark, place)


def _of_days(df: DataFrame, days: Sequence[str] | None) -> DataFrame:
    return df if days is None else df.where(F.col("date").isin(*[F.lit(day).cast("date") for day in days]))


# --- baseline ----------------------------------------------------------------


def baseline_states(ridership: DataFrame, weather: DataFrame | None = None, *, days: Sequence[str] | None = None) -> DataFrame:
    """One row per day and cell: hours, their mean, squared deviations, maximum and sketch."""
    placed = _of_days(with_cell(ridership, weather), days)
    entries = F.col("entries")
    return counted_hours(placed, "date").where(F.col("date").isNotNull()).groupBy("date", *CELL).agg(
        F.count(entries).alias("hours"),
        F.avg(entries).alias("mean"),
        (F.var_pop(entries) * F.count(entries)).alias("deviations"),
        F.max(entries).alias("most"),
        F.kll_sketch_agg_double(entries, KLL_K).alias("sketch"),
    )


def add_baseline_days(
    ridership: DataFrame, path: str, weather: DataFrame | None = None, *, days: Sequence[str] | None = None
) -> None:
    """Write the states of some days (all by default), replacing those stored. A table partitioned by
    date is read for these days only."""
    _write_days(baseline_states(ridership, weather, days=days), path, days)


def _merged_moments(parts: Column) -> Column:
    """Hours, mean and squared deviations of all parts, added pairwise, which loses no digits."""
    start = F.struct(F.lit(0.0).alias("n"), F.lit(0.0).alias("mean"), F.lit(0.0).alias("deviations"))

    def add(a: Column, b: Column) -> Column:
        n, apart = a["n"] + b["n"], b["mean"] - a["mean"]
        return F.struct(
            n.alias("n"),
            (a["mean"] + apart * b["n"] / n).alias("mean"),
            (a["deviations"] + b["deviations"] + apart * apart * a["n"] * b["n"] / n).alias("deviations"),
        )

    return F.aggregate(F.array_sort(parts), start, add)


def baseline_from_states(
    states: DataFrame, *, lookback_days: int = 90, max_over_all_history: bool = False
) -> tuple[DataFrame, DataFrame]:
    """``build_baseline`` from stored states: as many rows per cell as the look-back has days."""
    recent = lookback(states, lookback_days)
    part = F.struct("date", F.col("hours").cast("double").alias("n"), "mean", "deviations")
    merged = recent.groupBy(*CELL).agg(
        _merged_moments(F.collect_list(part)).alias("all"), F.kll_merge_agg_double("sketch", KLL_K).alias("sketch")
    )
    cells = merged.select(
        *CELL,
        F.col("all.mean").alias("avg_entries"),
        F.when(F.col("all.n") > 1, F.sqrt(F.col("all.deviations") / (F.col("all.n") - 1))).alias("std_entries"),
        F.kll_sketch_get_quantile_double("sketch", F.lit(0.95)).alias("p95_entries"),
    )
    days = states if max_over_all_history else recent
    return cells, days.groupBy("station_complex_id").agg(F.max("most").alias("max_hourly_entries"))


# --- audit -------------------------------------------------------------------


def audit_states(staged: DataFrame, distinct: Sequence[str], *, date: str = "event_date", days: Sequence[str] | None = None) -> DataFrame:
    """One row per day: rows, nulls and a sketch of the distinct values of each column, and the time span."""
    dated = _of_days(staged.withColumn("date", F.col(date)), days)
    sketches = {
        name: [F.hll_sketch_agg(F.col(name).cast("string"), HLL_LG_K).alias(f"{name}_sketch"), F.count_if(F.col(name).isNull()).alias(f"{name}_nulls")]
        for name in distinct
    }
    return dated.groupBy("date").agg(
        F.count(F.lit(1)).alias("rows"),
        *[c for own in sketches.values() for c in own],
        F.min("event_timestamp").alias("earliest_event"),
        F.max("event_timestamp").alias("latest_event"),
    )


def add_audit_days(
    staged: DataFrame, path: str, distinct: Sequence[str], *, date: str = "event_date", days: Sequence[str] | None = None
) -> None:
    """Write the audit states of some days (all by default), replacing those stored."""
    _write_days(audit_states(staged, distinct, date=date, days=days), path, days)


def read_states(spark: SparkSession, path: str, since: str | None = None, until: str | None = None) -> DataFrame:
    """Stored states, of a range of days only when given; others are pruned."""
    states = spark.read.parquet(path)
    if since is not None:
        states = states.where(F.col("date") >= F.lit(since).cast("date"))
    return states if until is None else states.where(F.col("date") <= F.lit(until).cast("date"))


def audit_vehicles_from_states(states: DataFrame) -> DataFrame:
    """``audit_vehicles`` from states with sketches of ``station_complex_id`` and ``route_id``, one row."""
    estimate = lambda name: F.coalesce(F.hll_sketch_estimate(F.hll_union_agg(f"{name}_sketch")), F.lit(0))
    rows, nulls = F.coalesce(F.sum("rows"), F.lit(0)), F.coalesce(F.sum("station_complex_id_nulls"), F.lit(0))
    return states.agg(
        rows.alias("rows"),
        estimate("station_complex_id").alias("distinct_stations"),
        estimate("route_id").alias("distinct_routes"),
        nulls.alias("null_station_complex_id"),
        F.round(F.try_divide(nulls * F.lit(100.0), rows), 2).alias("null_station_complex_id_pct"),
        F.min("earliest_event").alias("earliest_event"),
        F.max("latest_event").alias("latest_event"),
    )
