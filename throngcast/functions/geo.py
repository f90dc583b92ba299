"""Great-circle distance."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: sphere radius in metres.
EARTH_RADIUS_M = 6_371_000.0


def haversine_meters(lat1: Column, lon1: Column, lat2: Column, lon2: Column) -> Column:
    """Distance on the sphere in metres, null when a coordinate is null.

    Rounding may lift the squared half chord above 1 at opposite points, so it is clamped.
    """
    half_lat = F.radians(lat2 - lat1) / 2
    half_lon = F.radians(lon2 - lon1) / 2
    chord = F.pow(F.sin(half_lat), F.lit(2.0)) + F.cos(F.radians(lat1)) * F.cos(F.radians(lat2)) * F.pow(
        F.sin(half_lon), F.lit(2.0)
    )
    within = F.when(chord.isNotNull(), F.least(F.lit(1.0), chord))
    return F.lit(2 * EARTH_RADIUS_M) * F.atan2(F.sqrt(within), F.sqrt(F.lit(1.0) - within))
