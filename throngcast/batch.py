"""File-to-file batch jobs, from raw CSV to the stored batch views.

Each job runs its plan once, writes its tables and returns the row counts observed
during the write; nothing is counted in a second pass.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from throngcast.functions.times import LOCAL_TIMEZONE
from throngcast.operators.profile import profile_columns, sample_rows
from throngcast.plans import baseline, quality, ridership, schedule, weather
from throngcast.plans.bridge import build_bridge
from throngcast.sources.readers import read_csv_files, read_table
from throngcast.sources.writers import with_row_count, write_parquet, write_table


def _written(df: DataFrame, path: str, *, partition_by: Sequence[str] = (), **metrics) -> dict[str, int]:
    observed, seen = with_row_count(df, "written", **metrics)
    write_parquet(observed, path, partition_by=partition_by)
    return seen.get


def clean_ridership_job(
    spark: SparkSession,
    inputs: Sequence[str],
    output: str,
    *,
    bridge: str | None = None,
    source_timezone: str = LOCAL_TIMEZONE,
) -> dict[str, int]:
    """Raw ridership files to station hours by date, flagged against the bridge when given."""
    raw, read = with_row_count(read_csv_files(spark, inputs), "read")
    clean = ridership.clean_ridership(raw, source_timezone=source_timezone)
    metrics = {}
    if bridge is not None:
        clean = ridership.validate_against_bridge(clean, read_table(spark, bridge))
        metrics["resolved"] = F.count_if("bridge_resolved")
    written = _written(clean, output, partition_by=["date"], **metrics)
    return {"rows_before": read.get["rows"], **written}


def clean_weather_job(spark: SparkSession, inputs: Sequence[str], output: str, **scales: float) -> dict[str, int]:
    """A raw weather report to classified days, counted per bucket."""
    days = weather.clean_weather(read_csv_files(spark, inputs), **scales)
    per_bucket = {name: F.count_if(F.col("weather_bucket") == name) for name in ("clear", "rain", "snow")}
    return _written(days, output, **per_bucket)


def join_weather_job(spark: SparkSession, ridership_path: str, weather_path: str, output: str) -> dict[str, int]:
    """Ridership with its daily bucket; ``missing_weather`` counts the rows that had none."""
    joined = ridership.join_weather(read_table(spark, ridership_path), read_table(spark, weather_path))
    return _written(joined, output, partition_by=["date"], missing_weather=F.count_if("weather_join_missing"))


def baseline_job(
    spark: SparkSession,
    ridership_weather_path: str,
    targets: dict[str, dict[str, str]],
    *,
    sinks: str = "parquet",
    lookback_days: int = 90,
    **options: str,
) -> None:
    """Baseline and maxima to every sink of the comma list.

    ``targets`` maps ``baseline`` and ``station_max`` to a target per sink.
    """
    views = baseline.build_baseline(read_table(spark, ridership_weather_path), lookback_days=lookback_days)
    for name, view in zip(("baseline", "station_max"), views):
        write_table(view, sinks, targets[name], **options)


def weather_coefficients_job(
    spark: SparkSession, ridership_weather_path: str, targets: dict[str, str], *, sinks: str = "parquet", **options: str
) -> None:
    write_table(baseline.weather_coefficients(read_table(spark, ridership_weather_path)), sinks, targets, **options)


def bridge_job(spark: SparkSession, stations: Sequence[str], stops: Sequence[str], output: str, **limits) -> dict[str, int]:
    """Stop table with its complexes, counted per tier."""
    table = build_bridge(read_csv_files(spark, stations), read_csv_files(spark, stops), **limits)
    unresolved = F.count_if(F.col("station_complex_id").isNull())
    return _written(table, output, unresolved=unresolved)


def schedule_job(spark: SparkSession, stop_times: Sequence[str], full: str, prefix: str) -> dict[str, int]:
    """Scheduled arrivals by trip, unique per stop, and their medians by trip prefix."""
    arrivals = schedule.schedule_full(read_csv_files(spark, stop_times))
    by_trip = _written(schedule.unique_schedule(arrivals), full)
    by_prefix = _written(schedule.schedule_by_prefix(arrivals), prefix)
    return {"full_rows": by_trip["rows"], "prefix_rows": by_prefix["rows"]}


def audit_job(spark: SparkSession, vehicles: str, delays: str, output: str) -> dict[str, int]:
    """Audits of both staged tables and the skew of the vehicles, one JSON line each."""
    staged = {"vehicles": read_table(spark, vehicles), "delays": read_table(spark, delays)}
    reports = {
        "vehicles": quality.audit_vehicles(staged["vehicles"]),
        "delays": quality.audit_delays(staged["delays"]),
        "skew": quality.skew_ratio(staged["vehicles"]),
        "top_stations": quality.top_stations(staged["vehicles"]),
    }
    for name, report in reports.items():
        report.write.mode("overwrite").json(f"{output}/{name}")
    return {"reports": len(reports)}


def calibration_job(spark: SparkSession, delays: str, output: str) -> dict[str, int]:
    """Delay quantiles and the grace and saturation they suggest, from staged delays."""
    return _written(quality.calibrate_service(read_table(spark, delays)), output)


def backtest_job(spark: SparkSession, events: Sequence[str], output: str) -> dict[str, int]:
    """Labelled events scored with the current thresholds, with the number that agree."""
    return _written(quality.backtest_thresholds(read_csv_files(spark, events)), output)


def profile_job(spark: SparkSession, inputs: Sequence[str], output: str, *, rows: int = 5) -> dict[str, int]:
    """Fill and range per column of raw files, and a few sample rows beside it."""
    raw = read_csv_files(spark, inputs)
    sample_rows(raw, rows, raw.columns).write.mode("overwrite").json(f"{output}/sample")
    return _written(profile_columns(raw), f"{output}/columns")
