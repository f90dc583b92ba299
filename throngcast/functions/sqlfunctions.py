"""The scalar rules as temporary SQL functions, for users who write SQL."""

from __future__ import annotations

from pyspark.sql import SparkSession

from throngcast.functions import geo, scoring, weather

_CHORD = (
    "pow(sin(radians(lat2 - lat1) / 2), 2D) + cos(radians(lat1)) * cos(radians(lat2)) * pow(sin(radians(lon2 - lon1) / 2), 2D)"
)

SQL_FUNCTIONS = {
    "normalize_stop_id(v STRING) RETURNS STRING": (
        r"regexp_replace(regexp_replace(coalesce(v, ''), r'^\s+|\s+$', ''), r'[NS]$', '')"
    ),
    "normalize_station_name(v STRING) RETURNS STRING": (
        r"trim(regexp_replace(replace(lower(coalesce(v, '')), '&', ' and '), r'[^a-z0-9]+', ' '))"
    ),
    "haversine_meters(lat1 DOUBLE, lon1 DOUBLE, lat2 DOUBLE, lon2 DOUBLE) RETURNS DOUBLE": (
        f"CASE WHEN lat1 + lon1 + lat2 + lon2 IS NOT NULL THEN {2 * geo.EARTH_RADIUS_M}D "
        f"* atan2(sqrt(least(1D, {_CHORD})), sqrt(1D - least(1D, {_CHORD}))) END"
    ),
    "classify_weather(prcp_in DOUBLE, snow_in DOUBLE) RETURNS STRING": (
        f"CASE WHEN snow_in > {weather.SNOW_THRESHOLD_IN}D THEN 'snow' "
        f"WHEN prcp_in > {weather.RAIN_THRESHOLD_IN}D THEN 'rain' ELSE '{weather.DEFAULT_BUCKET}' END"
    ),
    "service_deficit(delay_secs DOUBLE) RETURNS DOUBLE": (
        f"least(1D, greatest(0D, (delay_secs - {scoring.SERVICE_GRACE_SECS}D) "
        f"/ {scoring.SERVICE_SATURATION_SECS - scoring.SERVICE_GRACE_SECS}D))"
    ),
    "demand_intensity(avg_entries DOUBLE, max_entries DOUBLE) RETURNS DOUBLE": (
        "least(1D, greatest(0D, CASE WHEN max_entries > 0 THEN avg_entries / max_entries END))"
    ),
    "alert_level(score DOUBLE) RETURNS STRING": (
        f"CASE WHEN score >= {scoring.SEVERE_THRESHOLD}D THEN 'SEVERE' "
        f"WHEN score >= {scoring.MODERATE_THRESHOLD}D THEN 'MODERATE' ELSE 'NORMAL' END"
    ),
}


def register_sql_functions(spark: SparkSession) -> None:
    for signature, body in SQL_FUNCTIONS.items():
        spark.sql(f"CREATE OR REPLACE TEMPORARY FUNCTION {signature} RETURN {body}")
