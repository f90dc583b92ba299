"""Weather classification."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bucket names, thresholds in inches, keywords and unit factors.
BUCKETS = ("clear", "rain", "snow")
DEFAULT_BUCKET = "clear"
RAIN_THRESHOLD_IN = 0.1
SNOW_THRESHOLD_IN = 0.1
SNOW_KEYWORDS = ("snow", "sleet", "ice")
MM_PER_INCH = 25.4


def weather_bucket(prcp_in: Column, snow_in: Column) -> Column:
    """Snow beats rain beats clear; a missing measure counts as zero."""
    return (
        F.when(snow_in > SNOW_THRESHOLD_IN, F.lit("snow"))
        .when(prcp_in > RAIN_THRESHOLD_IN, F.lit("rain"))
        .otherwise(F.lit(DEFAULT_BUCKET))
    )


def scaled_or_zero(measure: Column, scale: float) -> Column:
    return F.coalesce(measure * F.lit(float(scale)), F.lit(0.0))


def observation_columns(text: Column, prcp_mm: Column, temp_c: Column) -> dict[str, Column]:
    """Bucket and imperial measures of one station report."""
    prcp_in = F.coalesce(prcp_mm / F.lit(MM_PER_INCH), F.lit(0.0))
    mentions_snow = F.coalesce(F.lower(text).rlike("|".join(SNOW_KEYWORDS)), F.lit(False))
    snowing = mentions_snow & F.coalesce(temp_c < 0.0, F.lit(False))
    return {
        "weather_bucket": F.when(snowing, F.lit("snow"))
        .when(prcp_in > RAIN_THRESHOLD_IN, F.lit("rain"))
        .otherwise(F.lit(DEFAULT_BUCKET)),
        "prcp_in": prcp_in,
        "snow_in": F.when(snowing, prcp_in).otherwise(F.lit(0.0)),
        "tmax_f": temp_c * F.lit(9.0) / F.lit(5.0) + F.lit(32.0),
    }
