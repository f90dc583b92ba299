"""Row types of messages, staged streams and batch tables."""

from __future__ import annotations

from pyspark.sql import types as T

STRING, INT, BIGINT, DOUBLE = T.StringType(), T.IntegerType(), T.LongType(), T.DoubleType()
DATE, TIMESTAMP = T.DateType(), T.TimestampType()


def struct(**fields: T.DataType) -> T.StructType:
    return T.StructType([T.StructField(name, dtype) for name, dtype in fields.items()])


# Message fields carrying 64-bit integers arrive as JSON strings and are cast after parsing.
_HEADER = {"feed": STRING, "feed_timestamp": STRING, "entity_id": STRING, "route_id": STRING}
_TRIP = struct(trip_id=STRING, route_id=STRING, start_date=STRING, start_time=STRING)
_STOP_EVENT = struct(time=STRING, delay=INT)
_VEHICLE = {
    "trip": _TRIP,
    "vehicle": struct(id=STRING),
    "stop_id": STRING,
    "current_status": STRING,
    "current_stop_sequence": INT,
    "timestamp": STRING,
}
_TRIP_UPDATE = {
    "trip": _TRIP,
    "stop_time_update": T.ArrayType(
        struct(stop_id=STRING, stop_sequence=INT, arrival=_STOP_EVENT, departure=_STOP_EVENT)
    ),
    "timestamp": STRING,
}
_ALERT = {
    "active_period": T.ArrayType(struct(start=STRING, end=STRING)),
    "informed_entity": T.ArrayType(struct(route_id=STRING, stop_id=STRING)),
    "cause": STRING,
    "effect": STRING,
    "header_text": STRING,
    "description_text": STRING,
}

VEHICLE_MESSAGE = struct(**_HEADER, **_VEHICLE)
TRIP_UPDATE_MESSAGE = struct(**_HEADER, **_TRIP_UPDATE)
FEED_ENTITY = struct(id=STRING, vehicle=struct(**_VEHICLE), trip_update=struct(**_TRIP_UPDATE), alert=struct(**_ALERT))
FEED_FRAME = struct(feed=STRING, feed_timestamp=STRING, entity=T.ArrayType(FEED_ENTITY))
OBSERVATION_MESSAGE = struct(
    textDescription=STRING, precipitationLastHour=struct(value=DOUBLE), temperature=struct(value=DOUBLE)
)

VEHICLE_POSITIONS = struct(
    trip_id=STRING,
    route_id=STRING,
    vehicle_id=STRING,
    stop_id=STRING,
    stop_id_base=STRING,
    current_status=STRING,
    current_stop_sequence=INT,
    event_timestamp=TIMESTAMP,
    station_complex_id=STRING,
    complex_name=STRING,
    lat=DOUBLE,
    lon=DOUBLE,
    event_date=DATE,
)
TRIP_DELAYS = struct(
    trip_id=STRING,
    route_id=STRING,
    start_date=STRING,
    stop_id=STRING,
    stop_sequence=INT,
    arrival_delay_secs=INT,
    departure_delay_secs=INT,
    arrival_time_epoch=BIGINT,
    scheduled_arrival_unix=BIGINT,
    delay_source=STRING,
    event_unix_ts=BIGINT,
    kafka_ts=TIMESTAMP,
    event_timestamp=TIMESTAMP,
    event_date=DATE,
)
DELAY_SIGNAL = struct(station_complex_id=STRING, event_timestamp=TIMESTAMP, avg_arrival_delay_secs=DOUBLE)
CAPACITY_BASELINE = struct(
    station_complex_id=STRING,
    day_of_week=INT,
    hour_of_day=INT,
    weather_bucket=STRING,
    avg_entries=DOUBLE,
    std_entries=DOUBLE,
    p95_entries=DOUBLE,
)
STATION_MAX = struct(station_complex_id=STRING, max_hourly_entries=DOUBLE)
CURRENT_CONDITION = struct(
    scope=STRING, weather_bucket=STRING, prcp_in=DOUBLE, snow_in=DOUBLE, tmax_f=DOUBLE, updated_at=TIMESTAMP
)
WINDOW_COUNT = struct(start=TIMESTAMP, end=TIMESTAMP, msg_count=BIGINT)
SCORED = struct(
    station_complex_id=STRING,
    complex_name=STRING,
    event_timestamp=TIMESTAMP,
    avg_arrival_delay_secs=DOUBLE,
    service_deficit=DOUBLE,
    demand_intensity=DOUBLE,
    congestion_score=DOUBLE,
    predicted_delay_mins=DOUBLE,
    alert_level=STRING,
    weather_bucket=STRING,
    inserted_at=TIMESTAMP,
)
