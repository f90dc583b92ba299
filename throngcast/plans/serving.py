"""Views over scored rows, baseline and bridge."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from throngcast.functions import scoring as rules
from throngcast.functions.times import STALE_AFTER_SECS, age_label, age_seconds, freshness_label, iso_string
from throngcast.functions.weather import DEFAULT_BUCKET
from throngcast.operators.dedupe import latest_by_key
from throngcast.operators.history import with_previous

# Levels that alert and the text shown without a status.
ALERTING_LEVELS = ("MODERATE", "SEVERE")
NO_STATUS = "N/A"
HISTORY_COLUMNS = ("event_timestamp", "congestion_score", "avg_arrival_delay_secs", "alert_level")
RECENCY = ("event_timestamp", "inserted_at")


def latest_per_station(scored: DataFrame) -> DataFrame:
    """Newest row per station by event time, then by insertion time."""
    return latest_by_key(scored, ["station_complex_id"], RECENCY)


def alerts(scored: DataFrame) -> DataFrame:
    """Stations whose newest row alerts, highest score first.

    The level is tested after the reduction: an older alert must not outlive a newer calm row.
    """
    newest = latest_per_station(scored)
    return newest.where(F.col("alert_level").isin(*ALERTING_LEVELS)).orderBy(
        F.desc("congestion_score"), "station_complex_id"
    )


def station_current(scored: DataFrame, station: str) -> DataFrame:
    """Newest row of one station, ties broken by all columns."""
    return latest_per_station(scored.where(F.col("station_complex_id") == station))


def station_history(scored: DataFrame, station: str, as_of: Column, *, hours: int = 24) -> DataFrame:
    """Rows of one station inserted in the last hours, oldest event first."""
    if not 1 <= hours <= 48:
        raise ValueError("hours must be between 1 and 48")
    since = as_of - F.expr(f"INTERVAL {hours} HOURS")
    return (
        scored.where((F.col("station_complex_id") == station) & (F.col("inserted_at") >= since))
        .select(*HISTORY_COLUMNS)
        .orderBy(*HISTORY_COLUMNS)
    )


def serialized(df: DataFrame) -> DataFrame:
    """Timestamps as ISO-8601 text."""
    stamps = [name for name, dtype in df.dtypes if dtype == "timestamp"]
    return df.withColumns({name: iso_string(F.col(name)) for name in stamps})


def forecast_next_hour(
    baseline: DataFrame, as_of: Column, *, station: str | None = None, calendar_tz: str = "UTC"
) -> DataFrame:
    """Expected entries of the next clear hour, on the as-of day of week.

    Hour and day follow the zone and numbering the baseline was built with.
    """
    local = F.from_utc_timestamp(as_of, calendar_tz)
    cell = (
        (F.col("weather_bucket") == DEFAULT_BUCKET)
        & (F.col("day_of_week") == F.dayofweek(local))
        & (F.col("hour_of_day") == (F.hour(local) + 1) % 24)
    )
    if station is not None:
        cell = cell & (F.col("station_complex_id") == station)
    return baseline.where(cell).select(
        "station_complex_id",
        F.col("hour_of_day").alias("next_hour"),
        "day_of_week",
        "avg_entries",
        "p95_entries",
    )


def hourly_profile(baseline: DataFrame, *, weather_bucket: str = DEFAULT_BUCKET) -> DataFrame:
    """Unweighted mean over days of week of the cell means, per station and hour."""
    return (
        baseline.where(F.col("weather_bucket") == weather_bucket)
        .groupBy("station_complex_id", "hour_of_day")
        .agg(F.avg("avg_entries").alias("avg_entries"))
    )


def station_profile(baseline: DataFrame, station: str, *, weather_bucket: str = DEFAULT_BUCKET) -> DataFrame:
    """Cells of one station in one bucket; empty when the station is unknown."""
    wanted = (F.col("station_complex_id") == station) & (F.col("weather_bucket") == weather_bucket)
    return baseline.where(wanted).select("hour_of_day", "avg_entries")


def forecast_delta(baseline: DataFrame, as_of: Column, *, calendar_tz: str = "UTC") -> DataFrame:
    """Expected entries of this hour and the next per station, and their difference."""
    this_hour = F.hour(F.from_utc_timestamp(as_of, calendar_tz))
    hours = {"current": this_hour, "next": (this_hour + 1) % 24}
    hour = F.col("hour_of_day")
    near = baseline.where((hour == hours["current"]) | (hour == hours["next"]))
    mean = F.col("avg_entries")
    expected = hourly_profile(near).groupBy("station_complex_id").agg(
        *[F.max(F.when(hour == at, mean)).cast("bigint").alias(f"{name}_entries") for name, at in hours.items()]
    )
    return expected.withColumns(
        {
            "current_hour": hours["current"],
            "next_hour": hours["next"],
            "delta": F.col("next_entries") - F.col("current_entries"),
        }
    )


def station_directory(bridge: DataFrame) -> DataFrame:
    """Name, mean place and the united routes of every complex.

    Routes are taken apart before they are collected, so a group holds each route of
    the network at most once. Both sides are partitioned by complex and join in place.
    """
    known = bridge.where(F.col("station_complex_id").isNotNull())
    places = known.groupBy("station_complex_id").agg(
        F.min("complex_name").alias("name"), F.avg("lat").alias("lat"), F.avg("lon").alias("lon")
    )
    routes = (
        known.select("station_complex_id", F.explode(F.split("daytime_routes", r"\s+")).alias("route"))
        .where(F.col("route") != "")
        .groupBy("station_complex_id")
        .agg(F.array_join(F.array_sort(F.collect_set("route")), " ").alias("daytime_routes"))
    )
    return places.join(routes, "station_complex_id", "left")


def route_list(directory: DataFrame) -> DataFrame:
    """Every route served, sorted."""
    return (
        directory.select(F.explode(F.split("daytime_routes", r"\s+")).alias("route"))
        .where(F.col("route") != "")
        .distinct()
        .orderBy("route")
    )


def station_status_board(directory: DataFrame, latest: DataFrame) -> DataFrame:
    """Every station with its live status, or defaults where it has none, and display labels."""
    status = latest.select("station_complex_id", "alert_level", "congestion_score", "avg_arrival_delay_secs")
    score = F.col("congestion_score")
    return (
        directory.join(status, "station_complex_id", "left")
        .fillna({"alert_level": NO_STATUS, "congestion_score": 0.0})
        .withColumns(
            {
                "radius": rules.marker_radius(score),
                "crowding": rules.crowding_label(score),
                "delay": rules.delay_label(F.col("avg_arrival_delay_secs")),
            }
        )
    )


def filter_by_routes(df: DataFrame, routes: Sequence[str]) -> DataFrame:
    """Rows serving any of the routes; no selection keeps every row."""
    if not routes:
        return df
    served = F.split("daytime_routes", r"\s+")
    return df.where(F.arrays_overlap(served, F.array(*[F.lit(route) for route in routes])))


def kpi_counts(latest: DataFrame) -> DataFrame:
    """Stations in total and per alert level."""
    return latest.agg(
        F.count(F.lit(1)).alias("stations_monitored"),
        *[F.count_if(F.col("alert_level") == level).alias(level.lower()) for level in rules.ALERT_LEVELS],
    )


def freshness(latest: DataFrame, as_of: Column) -> DataFrame:
    """Age of the newest insertion; no insertion at all is stale."""
    age = F.col("age_secs")
    return (
        latest.agg(F.max("inserted_at").alias("last_inserted_at"))
        .withColumn("age_secs", age_seconds(F.col("last_inserted_at"), as_of))
        .withColumns({"label": freshness_label(age), "is_stale": F.coalesce(age > STALE_AFTER_SECS, F.lit(True))})
    )


def escalations(scored: DataFrame, *, slice_width: str = "HOUR") -> DataFrame:
    """Rows on which a station turns SEVERE, its first row included."""
    history = with_previous(
        scored,
        ["station_complex_id"],
        [*RECENCY, "congestion_score"],
        "alert_level",
        slice_by=F.date_trunc(slice_width, F.col("event_timestamp")),
        output="previous_level",
    )
    was_severe = F.coalesce(F.col("previous_level") == "SEVERE", F.lit(False))
    return history.where((F.col("alert_level") == "SEVERE") & ~was_severe)


def newly_severe(previous: DataFrame, current: DataFrame) -> DataFrame:
    """Stations SEVERE in one snapshot and not in the snapshot before."""
    before = previous.where(F.col("alert_level") == "SEVERE").select("station_complex_id")
    return current.where(F.col("alert_level") == "SEVERE").join(before, "station_complex_id", "left_anti")


def severity_sorted(latest: DataFrame, as_of: Column) -> DataFrame:
    """Status table, most severe first, with age and labels."""
    level = F.col("alert_level")
    return latest.select(
        "station_complex_id",
        "complex_name",
        "alert_level",
        rules.severity_rank(level).alias("severity_rank"),
        "congestion_score",
        rules.crowding_label(F.col("congestion_score")).alias("crowding"),
        rules.delay_label(F.col("avg_arrival_delay_secs")).alias("delay"),
        age_label(F.col("event_timestamp"), as_of).alias("age"),
        "weather_bucket",
    ).orderBy("severity_rank", "station_complex_id")
