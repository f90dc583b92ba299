"""Live delay against the batch baseline."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from throngcast.functions import scoring as rules
from throngcast.functions.weather import BUCKETS, DEFAULT_BUCKET
from throngcast.plans.baseline import CELL
from throngcast.plans.ridership import with_calendar
from throngcast.schemas import SCORED

# Freshness limit of the current condition and its scope.
CONDITION_MAX_AGE_SECS = 3600
CONDITION_SCOPE = "nyc"


def current_bucket(
    conditions: DataFrame,
    as_of: Column,
    *,
    scope: str = CONDITION_SCOPE,
    max_age_secs: int = CONDITION_MAX_AGE_SECS,
) -> DataFrame:
    """One row with the bucket to score with.

    The newest condition of the scope counts when it is a known bucket and younger
    than the limit; missing, stale and unknown ones mean clear.
    """
    newest = conditions.where(F.col("scope") == scope).agg(
        F.max(F.struct("updated_at", "weather_bucket")).alias("last")
    )
    updated, bucket = F.col("last.updated_at"), F.col("last.weather_bucket")
    age_micros = F.unix_micros(as_of) - F.unix_micros(updated)
    usable = bucket.isin(*BUCKETS) & (age_micros < F.lit(max_age_secs * 1_000_000))
    return newest.select(
        F.lit(scope).alias("scope"),
        F.when(usable, bucket).otherwise(F.lit(DEFAULT_BUCKET)).alias("weather_bucket"),
    )


def complex_names(bridge: DataFrame) -> DataFrame:
    """One name per complex."""
    return (
        bridge.where(F.col("station_complex_id").isNotNull())
        .groupBy("station_complex_id")
        .agg(F.min("complex_name").alias("complex_name"))
    )


def score(
    signal: DataFrame,
    baseline: DataFrame,
    station_max: DataFrame,
    bridge: DataFrame,
    *,
    weather_bucket: str | Column = DEFAULT_BUCKET,
    inserted_at: Column | None = None,
    calendar_tz: str = "UTC",
    with_flags: bool = False,
) -> DataFrame:
    """Congestion score, delay forecast and alert level per row of the signal.

    A constant bucket filters the baseline before the join. A station hour without
    a baseline has demand 0 and stays NORMAL; ``with_flags`` adds the column
    ``baseline_missing`` that tells such rows apart.
    """
    cells = baseline.select(*CELL, "avg_entries")
    if isinstance(weather_bucket, str):
        cells = cells.where(F.col("weather_bucket") == weather_bucket)
        weather_bucket = F.lit(weather_bucket)
    joined = (
        with_calendar(signal, "event_timestamp", calendar_tz=calendar_tz)
        .withColumn("weather_bucket", weather_bucket)
        .join(cells, list(CELL), "left")
        .join(station_max.select("station_complex_id", "max_hourly_entries"), "station_complex_id", "left")
        .join(complex_names(bridge), "station_complex_id", "left")
    )
    return with_scores(joined).select(
        *[
            (F.current_timestamp() if inserted_at is None else inserted_at).alias(name)
            if name == "inserted_at"
            else F.col(name)
            for name in SCORED.fieldNames()
        ],
        *([F.col("avg_entries").isNull().alias("baseline_missing")] if with_flags else []),
    )


def with_scores(
    df: DataFrame,
    delay_secs: Column | None = None,
    avg_entries: Column | None = None,
    max_hourly_entries: Column | None = None,
) -> DataFrame:
    """Add the scores; inputs not given are the columns named like them."""
    delay = F.col("avg_arrival_delay_secs") if delay_secs is None else delay_secs
    usual = F.col("avg_entries") if avg_entries is None else avg_entries
    busiest = F.col("max_hourly_entries") if max_hourly_entries is None else max_hourly_entries
    deficit, demand = F.col("service_deficit"), F.col("demand_intensity")
    return (
        df.withColumns(
            {
                "service_deficit": rules.service_deficit(delay),
                "demand_intensity": rules.demand_intensity(usual, busiest),
            }
        )
        .withColumns(
            {
                "congestion_score": rules.congestion_score(deficit, demand),
                "predicted_delay_mins": rules.predicted_delay_mins(delay, demand),
            }
        )
        .withColumn("alert_level", rules.alert_level(F.col("congestion_score")))
    )
