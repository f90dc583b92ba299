"""Congestion score, alert level and rider-facing labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Endpoints in seconds, score thresholds, label texts.
SERVICE_GRACE_SECS = 60.0
SERVICE_SATURATION_SECS = 300.0
MODERATE_THRESHOLD = 0.20
SEVERE_THRESHOLD = 0.50
CROWDING_FLOOR = 0.05
ALERT_LEVELS = ("SEVERE", "MODERATE", "NORMAL")
UNRANKED_LEVEL = 99


def clamp(value: Column, lower: float = 0.0, upper: float = 1.0) -> Column:
    """Bound a value; null gives the lower bound because ``greatest`` skips nulls."""
    return F.least(F.lit(upper), F.greatest(F.lit(lower), value))


def service_deficit(
    delay_secs: Column,
    grace_secs: float = SERVICE_GRACE_SECS,
    saturation_secs: float = SERVICE_SATURATION_SECS,
) -> Column:
    if saturation_secs <= grace_secs:
        raise ValueError(f"delays saturate at {saturation_secs} s, which is not above the grace of {grace_secs} s")
    return clamp((delay_secs - F.lit(float(grace_secs))) / F.lit(float(saturation_secs - grace_secs)))


def demand_intensity(avg_entries: Column, max_hourly_entries: Column) -> Column:
    """Share of the busiest hour; zero without a usable maximum or baseline."""
    share = F.when(max_hourly_entries > 0, avg_entries / max_hourly_entries)
    return clamp(share)


def congestion_score(deficit: Column, demand: Column) -> Column:
    return deficit * demand


def predicted_delay_mins(delay_secs: Column, demand: Column) -> Column:
    return delay_secs / F.lit(60.0) * (F.lit(1.0) + demand)


def alert_level(
    score: Column, moderate: float = MODERATE_THRESHOLD, severe: float = SEVERE_THRESHOLD
) -> Column:
    return F.when(score >= severe, F.lit("SEVERE")).when(score >= moderate, F.lit("MODERATE")).otherwise(F.lit("NORMAL"))


def severity_rank(level: Column) -> Column:
    """Position of a level in ``ALERT_LEVELS``; unknown levels sort last."""
    position = F.array_position(F.array(*[F.lit(name) for name in ALERT_LEVELS]), level)
    return F.when(position > 0, (position - 1).cast("int")).otherwise(F.lit(UNRANKED_LEVEL))


def crowding_label(score: Column) -> Column:
    return (
        F.when(score >= SEVERE_THRESHOLD, F.lit("Very Busy"))
        .when(score >= MODERATE_THRESHOLD, F.lit("Busy"))
        .when(score >= CROWDING_FLOOR, F.lit("Moderate"))
        .otherwise(F.lit("Quiet"))
    )


def delay_label(delay_secs: Column) -> Column:
    """Short text for a delay; whole minutes are rounded half to even."""
    minutes = F.bround(delay_secs / F.lit(60.0), 0).cast("bigint").cast("string")
    return (
        F.when(delay_secs.isNull() | F.isnan(delay_secs) | (delay_secs <= 30), F.lit("On time"))
        .when(delay_secs < 60, F.lit("<1 min"))
        .when(delay_secs < 600, F.concat(F.lit("~"), minutes, F.lit(" min")))
        .otherwise(F.concat(minutes, F.lit(" min")))
    )


def marker_radius(score: Column) -> Column:
    return clamp(F.lit(100.0) + F.coalesce(score, F.lit(0.0)) * F.lit(300.0), 100.0, 400.0)
