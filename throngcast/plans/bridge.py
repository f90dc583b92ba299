"""Stop ids to station complexes: by key, by name, by place."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from throngcast.functions.text import normalize_station_name, normalize_stop_id
from throngcast.operators.dedupe import first_by_key
from throngcast.operators.similarity import closest_name, nearest_within
from throngcast.sources.columns import HeaderLookup

# Tier names, default limits and accepted header names.
DIRECT, BY_NAME, BY_PLACE, UNRESOLVED = "TIER1_DIRECT", "TIER2_NAME", "TIER3_GEO", "UNRESOLVED"
NAME_THRESHOLD = 4
RADIUS_M = 100.0
STATION_STOP_NAMES = ("GTFS Stop ID", "gtfs_stop_id")
STATION_COMPLEX_NAMES = ("Station Complex ID", "Complex ID", "Complex MRN")
STATION_TITLE_NAMES = ("Complex Name", "Stop Name", "Station Name")
STATION_LAT_NAMES = ("GTFS Latitude", "Latitude", "lat")
STATION_LON_NAMES = ("GTFS Longitude", "Longitude", "lon", "lng")
STOP_LAT_NAMES = ("stop_lat", "GTFS Latitude", "Latitude")
STOP_LON_NAMES = ("stop_lon", "GTFS Longitude", "Longitude")

STATION = ("station_complex_id", "complex_name", "lat", "lon", "borough", "daytime_routes")
BRIDGE = ("gtfs_stop_id", "source_stop_id", *STATION, "match_tier", "match_distance")


def station_seed(stations: DataFrame) -> DataFrame:
    """One row per base stop id and complex."""
    named = HeaderLookup(stations)
    seed = stations.select(
        normalize_stop_id(named.need(*STATION_STOP_NAMES).cast("string")).alias("gtfs_stop_id"),
        named.need(*STATION_COMPLEX_NAMES).cast("string").alias("station_complex_id"),
        named.need(*STATION_TITLE_NAMES).cast("string").alias("complex_name"),
        named.need(*STATION_LAT_NAMES).try_cast("double").alias("lat"),
        named.need(*STATION_LON_NAMES).try_cast("double").alias("lon"),
        named.want("string", "Borough").cast("string").alias("borough"),
        named.want("string", "Daytime Routes").cast("string").alias("daytime_routes"),
    ).where(F.col("gtfs_stop_id") != "")
    return first_by_key(seed, ["gtfs_stop_id", "station_complex_id"])


def base_stops(stops: DataFrame) -> DataFrame:
    """One row per base stop id, the smallest source id representing its platforms."""
    named = HeaderLookup(stops)
    base = stops.select(
        normalize_stop_id(named.need("stop_id").cast("string")).alias("gtfs_stop_id"),
        named.need("stop_id").cast("string").alias("source_stop_id"),
        named.need("stop_name").cast("string").alias("stop_name"),
        named.need(*STOP_LAT_NAMES).try_cast("double").alias("stop_lat"),
        named.need(*STOP_LON_NAMES).try_cast("double").alias("stop_lon"),
    ).where(F.col("gtfs_stop_id") != "")
    return first_by_key(base, ["gtfs_stop_id"], ["source_stop_id"])


@dataclass(frozen=True)
class Bridge:
    """The matching cascade over one set of stations and stops.

    ``table`` looks each stop up directly, by distinct name and by distinct place, and gives
    it the first tier that answered, in one pass. The later tiers are read off that table;
    the first two can be had without the lookups behind them.
    """

    seed: DataFrame
    stops: DataFrame
    name_threshold: int = NAME_THRESHOLD
    radius_m: float = RADIUS_M

    @classmethod
    def of(cls, stations: DataFrame, stops: DataFrame, **limits) -> Bridge:
        return cls(station_seed(stations), base_stops(stops), **limits)

    def _looked_up(self) -> DataFrame:
        """Stops with their listed complexes; a listing without a complex is no answer."""
        listed = self.seed.where(F.col("station_complex_id").isNotNull())
        return self.stops.join(listed, "gtfs_stop_id", "left")

    def unmatched(self) -> DataFrame:
        """Stops without a direct complex."""
        return self._looked_up().where(F.col("station_complex_id").isNull()).select(*self.stops.columns)

    def _name_matches(self, stops: DataFrame) -> DataFrame:
        """Best station per distinct stop name; stations sharing a name are reduced first."""
        targets = (
            self.seed.withColumn("_target", normalize_station_name(F.col("complex_name")))
            .groupBy("_target")
            .agg(F.min(F.struct(*STATION)).alias("by_name"))
        )
        return closest_name(
            stops.select("_name").distinct(),
            targets,
            probe="_name",
            target="_target",
            payload="by_name",
            threshold=self.name_threshold,
        ).withColumnRenamed("distance", "name_distance")

    def _place_matches(self, stops: DataFrame) -> DataFrame:
        """Best station per distinct stop place; stations sharing a place are reduced first."""
        targets = (
            self.seed.select(F.col("lat").alias("_lat"), F.col("lon").alias("_lon"), F.struct(*STATION).alias("s"))
            .groupBy("_lat", "_lon")
            .agg(F.min("s").alias("by_place"))
        )
        return nearest_within(
            stops.select("stop_lat", "stop_lon").distinct(),
            targets,
            point=("stop_lat", "stop_lon"),
            target=("_lat", "_lon"),
            payload="by_place",
            radius_m=self.radius_m,
        ).withColumnRenamed("distance", "place_distance")

    @staticmethod
    def _named(stops: DataFrame) -> DataFrame:
        return stops.withColumn("_name", normalize_station_name(F.col("stop_name")))

    @staticmethod
    def _rows(df: DataFrame, station: dict[str, Column], tier: Column, distance: Column) -> DataFrame:
        return df.select(
            "gtfs_stop_id",
            "source_stop_id",
            *[station[name].alias(name) for name in STATION],
            tier.alias("match_tier"),
            distance.cast("double").alias("match_distance"),
        )

    @staticmethod
    def _station(prefix: str = "") -> dict[str, Column]:
        return {name: F.col(prefix + name) for name in STATION}

    @staticmethod
    def _stop_as_station() -> dict[str, Column]:
        nothing = F.lit(None).cast("string")
        return {
            "station_complex_id": nothing,
            "complex_name": F.col("stop_name"),
            "lat": F.col("stop_lat"),
            "lon": F.col("stop_lon"),
            "borough": nothing,
            "daytime_routes": nothing,
        }

    def direct(self) -> DataFrame:
        """Stops whose base id a station lists; one row per complex."""
        found = self._looked_up().where(F.col("station_complex_id").isNotNull())
        return self._rows(found, self._station(), F.lit(DIRECT), F.lit(None))

    def by_name(self) -> DataFrame:
        """Unmatched stops whose name is within the edit distance of a station's."""
        stops = self._named(self.unmatched())
        found = stops.join(self._name_matches(stops), "_name")
        return self._rows(found, self._station("by_name."), F.lit(BY_NAME), F.col("name_distance"))

    def by_place(self) -> DataFrame:
        """Stops left over by name with a station inside the radius."""
        return self.table().where(F.col("match_tier") == BY_PLACE)

    def matched_keys(self) -> DataFrame:
        """Stops that any tier answered, once each."""
        return self.table().where(F.col("match_tier") != UNRESOLVED).select("gtfs_stop_id").distinct()

    def unresolved(self) -> DataFrame:
        """Stops no tier answered, described by their own name and place."""
        return self.table().where(F.col("match_tier") == UNRESOLVED)

    def table(self) -> DataFrame:
        """Every stop with its complex, tier and distance."""
        full = self._named(self._looked_up())
        open_stops = full.where(F.col("station_complex_id").isNull())
        places = self._place_matches(open_stops)
        found = full.join(self._name_matches(open_stops), "_name", "left").join(
            places, ["stop_lat", "stop_lon"], "left"
        )
        direct = F.col("station_complex_id").isNotNull()
        named, placed = F.col("by_name").isNotNull(), F.col("by_place").isNotNull()
        own, fallback = self._station(), self._stop_as_station()

        def first_answer(name: str) -> Column:
            return (
                F.when(direct, own[name])
                .when(named, F.col(f"by_name.{name}"))
                .when(placed, F.col(f"by_place.{name}"))
                .otherwise(fallback[name])
            )

        tier = F.when(direct, DIRECT).when(named, BY_NAME).when(placed, BY_PLACE).otherwise(UNRESOLVED)
        distance = F.when(direct, None).when(named, F.col("name_distance")).when(placed, F.col("place_distance"))
        return self._rows(found, {name: first_answer(name) for name in STATION}, tier, distance)


def build_bridge(stations: DataFrame, stops: DataFrame, **limits) -> DataFrame:
    return Bridge.of(stations, stops, **limits).table()


def bridge_summary(bridge: DataFrame) -> DataFrame:
    """Stops per tier and the unresolved rate, in one row."""
    def in_tier(tier: str) -> Column:
        return F.count_if(F.col("match_tier") == tier)

    return bridge.agg(
        F.count(F.lit(1)).alias("total_stops"),
        in_tier(DIRECT).alias("tier1_direct"),
        in_tier(BY_NAME).alias("tier2_name"),
        in_tier(BY_PLACE).alias("tier3_geo"),
        in_tier(UNRESOLVED).alias("unresolved"),
        F.coalesce(F.try_divide(in_tier(UNRESOLVED), F.count(F.lit(1))), F.lit(0.0)).alias("unresolved_rate"),
    )
