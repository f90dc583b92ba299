"""Audit, calibration and back-test."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from throngcast.functions import scoring as rules
from throngcast.operators.quantiles import exact_quantiles
from throngcast.plans.scoring import with_scores

# Floors of the suggested endpoints and the tolerance for keeping the current ones.
MIN_GRACE_SECS = 30.0
MIN_SATURATION_SECS = 240.0
ENDPOINT_TOLERANCE = 0.15
ENDPOINT_QUANTILES = {"p50": 0.50, "p95": 0.95}
QUANTILES = {"delay_p50": 0.50, "delay_p95": 0.95, "delay_p99": 0.99}


def bucket_counts(df: DataFrame, column: str) -> DataFrame:
    return df.groupBy(column).agg(F.count(F.lit(1)).alias("rows"))


def percent_null(column: str) -> Column:
    share = F.try_divide(F.count_if(F.col(column).isNull()) * F.lit(100.0), F.count(F.lit(1)))
    return F.round(share, 2)


def _distinct(df: DataFrame, column: str) -> Column:
    """Number of distinct non-null values, counted in two steps on its own.

    Several exact distinct counts in one aggregate would copy every row once per count.
    """
    values = df.where(F.col(column).isNotNull()).select(column).distinct()
    return values.agg(F.count(F.lit(1)).alias("n")).scalar()


def audit_vehicles(vehicles: DataFrame) -> DataFrame:
    """Volume, coverage and time span of staged vehicle positions, one row."""
    return vehicles.agg(
        F.count(F.lit(1)).alias("rows"),
        _distinct(vehicles, "station_complex_id").alias("distinct_stations"),
        _distinct(vehicles, "route_id").alias("distinct_routes"),
        F.count_if(F.col("station_complex_id").isNull()).alias("null_station_complex_id"),
        percent_null("station_complex_id").alias("null_station_complex_id_pct"),
        F.min("event_timestamp").alias("earliest_event"),
        F.max("event_timestamp").alias("latest_event"),
    )


def audit_delays(delays: DataFrame) -> DataFrame:
    """Volume, coverage, span and exact delay distribution of staged trip delays, one row."""
    counts = delays.agg(
        F.count(F.lit(1)).alias("rows"),
        _distinct(delays, "trip_id").alias("distinct_trips"),
        _distinct(delays, "stop_id").alias("distinct_stops"),
        F.count_if(F.col("arrival_delay_secs").isNull()).alias("null_arrival_delay_secs"),
        percent_null("arrival_delay_secs").alias("null_arrival_delay_secs_pct"),
        F.min("arrival_delay_secs").alias("delay_min"),
        F.max("arrival_delay_secs").alias("delay_max"),
        F.min("event_timestamp").alias("earliest_event"),
        F.max("event_timestamp").alias("latest_event"),
    )
    quantiles = exact_quantiles(delays, "arrival_delay_secs", QUANTILES).select(
        F.struct(*[F.col(name).cast("int").alias(name) for name in QUANTILES]).alias("q")
    )
    return counts.withColumn("_q", quantiles.scalar()).select(
        *counts.columns, *[F.col(f"_q.{name}") for name in QUANTILES]
    )


def _per_station(df: DataFrame, key: str) -> DataFrame:
    return df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count(F.lit(1)).alias("rows"))


def skew_ratio(df: DataFrame, key: str = "station_complex_id") -> DataFrame:
    """Largest and median rows per key and their ratio.

    The exact median counts distinct group sizes, of which ``n`` rows have fewer than ``sqrt(2n)``.
    """
    sizes = _per_station(df, key).agg(
        F.max("rows").alias("max_rows"), F.median("rows").cast("bigint").alias("median_rows")
    )
    ratio = F.round(F.try_divide(F.col("max_rows"), F.col("median_rows")), 2)
    return sizes.withColumn("skew_ratio", ratio)


def top_stations(df: DataFrame, n: int = 20, key: str = "station_complex_id") -> DataFrame:
    """Busiest keys by rows."""
    return _per_station(df, key).orderBy(F.desc("rows"), key).limit(n)


def calibrate_service(delays: DataFrame) -> DataFrame:
    """Suggested grace and saturation endpoints from the observed delays, one row.

    The endpoints are exact: the delays are read twice, for their number and for their quantiles.
    """
    quantiles = exact_quantiles(delays, "arrival_delay_secs", ENDPOINT_QUANTILES, discrete=True)
    counted = delays.agg(F.count(F.lit(1)).alias("row_count"))
    found = quantiles.select(F.struct(*ENDPOINT_QUANTILES).alias("q")).scalar()
    observed = counted.withColumn("_q", found).select(
        "row_count",
        *[F.coalesce(F.col(f"_q.{name}").cast("double"), F.lit(0.0)).alias(name) for name in ENDPOINT_QUANTILES],
    )
    suggested = observed.withColumns(
        {
            "suggested_grace": F.greatest(F.lit(MIN_GRACE_SECS), "p50"),
            "suggested_saturation": F.greatest(F.lit(MIN_SATURATION_SECS), "p95"),
        }
    )

    def close(column: str, current: float) -> Column:
        return F.abs(F.col(column) - current) / current < ENDPOINT_TOLERANCE

    confirmed = close("suggested_grace", rules.SERVICE_GRACE_SECS) & close(
        "suggested_saturation", rules.SERVICE_SATURATION_SECS
    )
    return suggested.withColumn(
        "status", F.when(confirmed, F.lit("CONFIRMED")).otherwise(F.lit("REVISED_CANDIDATE"))
    )


def backtest_thresholds(events: DataFrame) -> DataFrame:
    """Score labelled events and compare the level with the expected one; blank expects nothing."""
    inputs = ("avg_arrival_delay_secs", "avg_entries", "max_hourly_entries")
    scored = with_scores(events, *[F.col(name).try_cast("double") for name in inputs])
    expected = F.nullif(F.col("expected_level"), F.lit(""))
    rounded = ("service_deficit", "demand_intensity", "congestion_score")
    return scored.withColumns(
        {
            **{name: F.round(name, 4) for name in rounded},
            "passes_expected": expected.isNull() | (F.col("alert_level") == expected),
        }
    ).select(*events.columns, *rounded, "alert_level", "passes_expected")


def topic_offsets(log: DataFrame) -> DataFrame:
    """Next offset per topic and partition."""
    return log.groupBy("topic", "partition").agg((F.max("offset") + 1).alias("next_offset"))


def topic_totals(log: DataFrame, baseline: DataFrame, keys: Sequence[str] = ("topic",)) -> DataFrame:
    """Messages per topic and how many came since a recorded baseline."""
    totals = topic_offsets(log).groupBy(*keys).agg(F.sum("next_offset").alias("total"))
    before = baseline.select(*keys, F.col("total").alias("_before"))
    delta = F.col("total") - F.coalesce("_before", F.lit(0))
    return totals.join(before, list(keys), "left").select(*keys, "total", delta.alias("delta"))
