"""Identifier and name normalisation."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Patterns the results depend on.
DIRECTION_SUFFIX = r"[NS]$"
TRIP_DIRECTION_PREFIX = r"^(.+\.\.[NSEW])"
SHAPE_SEPARATOR = ".."
FEED_SEPARATOR = "_"


def strip_blank(value: Column) -> Column:
    return F.regexp_replace(value, r"^\s+|\s+$", "")


def stop_base_id(value: Column) -> Column:
    """Drop one trailing direction letter; null stays null and blanks are kept."""
    return F.regexp_replace(value, DIRECTION_SUFFIX, "")


def normalize_stop_id(value: Column) -> Column:
    """Trimmed base id of a stop; null becomes the empty string."""
    return stop_base_id(strip_blank(F.coalesce(value, F.lit(""))))


def normalize_station_name(value: Column) -> Column:
    """Lower-case words of letters and digits separated by single blanks."""
    spelled = F.replace(F.lower(F.coalesce(value, F.lit(""))), F.lit("&"), F.lit(" and "))
    return F.trim(F.regexp_replace(spelled, r"[^a-z0-9]+", " "))


def trip_prefix(trip_id: Column) -> Column:
    """Trip id up to the direction letter, empty when there is none."""
    return F.regexp_extract(trip_id, TRIP_DIRECTION_PREFIX, 1)


def realtime_trip_id(static_trip_id: Column) -> Column:
    """Part of a static trip id after its first separator, which the live feed publishes."""
    return F.substr(static_trip_id, F.locate(FEED_SEPARATOR, static_trip_id) + 1)


def schedule_prefix(trip_id: Column) -> Column:
    """Trip id up to the letter after the separator; ids of another shape are returned unchanged."""
    at = F.locate(SHAPE_SEPARATOR, trip_id)
    end = at + len(SHAPE_SEPARATOR)
    return F.when((at > 0) & (F.length(trip_id) >= end), F.substring(trip_id, F.lit(1), end)).otherwise(trip_id)


def clock_to_seconds(clock: Column) -> Column:
    """HH:MM:SS to seconds of the service day; hours may pass 24, bad text gives null."""
    part = F.split(clock, ":")
    hours, minutes, seconds = (F.get(part, F.lit(i)).try_cast("int") for i in range(3))
    return hours * 3600 + minutes * 60 + seconds
