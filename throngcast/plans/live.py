"""Live messages to staged vehicle positions and trip delays.

All functions are stateless, so the same plan serves a batch and a stream. They
read the message layout ``value, timestamp`` of a broker.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from throngcast.functions.text import stop_base_id, trip_prefix
from throngcast.functions.times import LOCAL_TIMEZONE, event_time, service_day_epoch
from throngcast.schemas import TRIP_DELAYS, TRIP_UPDATE_MESSAGE, VEHICLE_MESSAGE, VEHICLE_POSITIONS


def _parsed(messages: DataFrame, schema) -> DataFrame:
    """Message fields as columns next to the arrival time; malformed text gives nulls.

    The parsed struct is generated rather than projected. Catalyst moves filters, also
    those it infers from later joins, below a projection and would parse once more for
    each of them; below a generator it does not.
    """
    parsed = F.from_json(F.col("value").cast("string"), schema)
    return messages.select(F.col("timestamp").alias("kafka_ts"), F.inline(F.array(parsed)))


def parse_vehicles(messages: DataFrame) -> DataFrame:
    """Flat vehicle positions; a malformed message leaves a row of nulls with its arrival time."""
    moment = event_time(F.col("timestamp").try_cast("bigint"), F.col("kafka_ts"))
    return _parsed(messages, VEHICLE_MESSAGE).select(
        F.col("trip.trip_id").alias("trip_id"),
        F.coalesce("route_id", "trip.route_id").alias("route_id"),
        F.col("vehicle.id").alias("vehicle_id"),
        "stop_id",
        stop_base_id(F.col("stop_id")).alias("stop_id_base"),
        "current_status",
        "current_stop_sequence",
        moment.alias("event_timestamp"),
        F.to_date(moment).alias("event_date"),
    )


def stop_lookup(bridge: DataFrame) -> DataFrame:
    """One complex per base stop id, resolved rows first."""
    columns = ("station_complex_id", "complex_name", "lat", "lon")
    typed = bridge.select(
        F.col("gtfs_stop_id").cast("string").alias("stop_id_base"),
        F.struct(
            F.col("station_complex_id").isNull().alias("open"),
            F.col("station_complex_id").cast("string").alias("station_complex_id"),
            "complex_name",
            "lat",
            "lon",
        ).alias("complex"),
    )
    best = typed.groupBy("stop_id_base").agg(F.min("complex").alias("complex"))
    return best.select("stop_id_base", *[f"complex.{name}" for name in columns])


def enrich_vehicles(parsed: DataFrame, bridge: DataFrame) -> DataFrame:
    """Vehicle positions with their station complex, null where the bridge has none."""
    joined = parsed.join(stop_lookup(bridge), "stop_id_base", "left")
    return joined.select(*VEHICLE_POSITIONS.fieldNames())


def parse_trip_updates(messages: DataFrame) -> DataFrame:
    """One row per announced stop; an update without stops keeps one row with a null stop."""
    stops = _parsed(messages, TRIP_UPDATE_MESSAGE).select(
        F.col("trip.trip_id").alias("trip_id"),
        F.coalesce("route_id", "trip.route_id").alias("route_id"),
        F.col("trip.start_date").alias("start_date"),
        F.col("timestamp").try_cast("bigint").alias("event_unix_ts"),
        "kafka_ts",
        F.explode_outer("stop_time_update").alias("stop"),
    )
    return stops.select(
        "trip_id",
        "route_id",
        "start_date",
        "stop.stop_id",
        "stop.stop_sequence",
        F.col("stop.arrival.delay").alias("arrival_delay_native"),
        F.col("stop.departure.delay").alias("departure_delay_secs"),
        F.col("stop.arrival.time").try_cast("bigint").alias("arrival_time_epoch"),
        "event_unix_ts",
        "kafka_ts",
    )


def _scheduled(stops: DataFrame, lookup: DataFrame | None, key: str, on: str, output: str) -> DataFrame:
    if lookup is None:
        return stops.withColumn(output, F.lit(None).cast("bigint"))
    seconds = lookup.select(F.col(key).alias(on), "stop_id", F.col("sched_arr_secs").alias(output))
    return stops.join(seconds, [on, "stop_id"], "left")


def trip_delays(
    parsed: DataFrame,
    full: DataFrame | None = None,
    prefix: DataFrame | None = None,
    *,
    service_tz: str = LOCAL_TIMEZONE,
    noon_minus_12h: bool = False,
) -> DataFrame:
    """Arrival delay per trip and stop: announced, else announced time minus schedule.

    ``full`` is unique on (trip_id_suffix, stop_id) and ``prefix`` on (prefix, stop_id);
    the full trip id wins over the prefix, and a lookup left out answers nothing. Rows
    without stop or delay are left out.
    """
    # below the joins, where no filter copies the parsing
    day = service_day_epoch(F.col("start_date"), service_tz, noon_minus_12h).alias("_day")
    stops = parsed.where(F.col("stop_id").isNotNull()).select("*", day)
    stops = _scheduled(stops, full, "trip_id_suffix", "trip_id", "_by_trip")
    stops = stops.withColumn("_prefix", trip_prefix(F.col("trip_id")))
    stops = _scheduled(stops, prefix, "prefix", "_prefix", "_by_prefix")
    scheduled = F.col("_day") + F.coalesce("_by_trip", "_by_prefix")
    native = F.col("arrival_delay_native")
    computed = (F.col("arrival_time_epoch") - F.col("scheduled_arrival_unix")).try_cast("int")
    moment = event_time(F.col("event_unix_ts"), F.col("kafka_ts"))
    return (
        stops.withColumn("scheduled_arrival_unix", scheduled)
        .withColumns(
            {
                "arrival_delay_secs": F.coalesce(native, computed),
                "delay_source": F.when(native.isNotNull(), "native")
                .when(computed.isNotNull(), "computed")
                .otherwise("missing"),
                "event_timestamp": moment,
                "event_date": F.to_date(moment),
            }
        )
        .where(F.col("arrival_delay_secs").isNotNull())
        .select(*TRIP_DELAYS.fieldNames())
    )
