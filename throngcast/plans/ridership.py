"""Hourly ridership: cleaning, weather join, membership check."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from throngcast.functions.times import LOCAL_TIMEZONE, parse_timestamp
from throngcast.functions.weather import DEFAULT_BUCKET
from throngcast.operators.dedupe import first_by_key
from throngcast.operators.sets import with_membership
from throngcast.sources.columns import HeaderLookup

# Accepted header names and the kept transit mode.
TIMESTAMP_NAMES = ("transit_timestamp", "Transit Timestamp", "timestamp")
STATION_NAMES = ("station_complex_id", "Station Complex ID", "Complex ID")
ENTRY_NAMES = ("entries", "ridership", "Ridership")
MODE_NAMES = ("transit_mode", "Transit Mode")
COMPLEX_NAMES = ("station_complex", "Station Complex", "complex_name")
KEPT_MODE = "subway"


def with_calendar(df: DataFrame, timestamp: str, *, calendar_tz: str = "UTC") -> DataFrame:
    """Add date, hour and day of week (Sunday is 1) as seen in ``calendar_tz``."""
    moment = F.col(timestamp)
    if calendar_tz != "UTC":
        moment = F.from_utc_timestamp(moment, calendar_tz)
    return df.withColumns(
        {"date": F.to_date(moment), "hour_of_day": F.hour(moment), "day_of_week": F.dayofweek(moment)}
    )


def typed_ridership(raw: DataFrame, *, source_timezone: str = LOCAL_TIMEZONE) -> DataFrame:
    """Rows of the kept mode with a station and entries >= 0; an unreadable time is null."""
    named = HeaderLookup(raw)
    if MODE_NAMES in named:
        raw = raw.where(F.lower(named.need(*MODE_NAMES)) == KEPT_MODE)
    entries = F.replace(named.need(*ENTRY_NAMES).cast("string"), F.lit(","), F.lit(""))
    typed = raw.select(
        named.need(*STATION_NAMES).cast("string").alias("station_complex_id"),
        named.want("string", *COMPLEX_NAMES).cast("string").alias("station_complex_name"),
        F.to_utc_timestamp(
            parse_timestamp(named.need(*TIMESTAMP_NAMES).cast("string")), source_timezone
        ).alias("transit_timestamp"),
        entries.try_cast("double").alias("entries"),
    )
    return typed.where(F.col("station_complex_id").isNotNull() & (F.col("entries") >= 0))


def clean_ridership(
    raw: DataFrame, *, source_timezone: str = LOCAL_TIMEZONE, calendar_tz: str = "UTC"
) -> DataFrame:
    """Entries per station and hour; fare and payment rows are summed, unreadable times dropped.

    The drop is stated on a count of the group. As a filter on the timestamp it would
    move below the aggregation and parse every text twice.
    """
    hourly = (
        typed_ridership(raw, source_timezone=source_timezone)
        .groupBy("station_complex_id", "station_complex_name", "transit_timestamp")
        .agg(F.sum("entries").alias("entries"), F.count("transit_timestamp").alias("_timed"))
        .where(F.col("_timed") > 0)
    )
    return with_calendar(hourly, "transit_timestamp", calendar_tz=calendar_tz).select(
        "station_complex_id",
        "station_complex_name",
        "transit_timestamp",
        "date",
        "hour_of_day",
        "day_of_week",
        "entries",
    )


def join_weather(ridership: DataFrame, weather: DataFrame) -> DataFrame:
    """Daily weather bucket per ridership row; days without weather are flagged and clear."""
    daily = first_by_key(weather.select("date", "weather_bucket"), ["date"])
    bucket = F.col("weather_bucket")
    return ridership.join(daily, "date", "left").withColumns(
        {"weather_join_missing": bucket.isNull(), "weather_bucket": F.coalesce(bucket, F.lit(DEFAULT_BUCKET))}
    )


def validate_against_bridge(ridership: DataFrame, bridge: DataFrame) -> DataFrame:
    """Flag the rows whose station the bridge knows."""
    return with_membership(ridership, bridge, ["station_complex_id"], "bridge_resolved")
