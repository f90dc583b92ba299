"""Message envelopes: routes, partitions, keys and dead letters."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Topics, partition counts and the partition of each known route.
TOPIC_VEHICLE = "gtfs-vehicle"
TOPIC_TRIPS = "gtfs-trips"
TOPIC_ALERTS = "gtfs-alerts"
TOPIC_DEAD_LETTER = "gtfs-dlq"
TOPIC_WEATHER = "weather-feed"
ROUTE_PARTITIONS = 12
ALERT_PARTITIONS = 2
NO_ROUTE_PARTITION = 11
PARTITION_OF_ROUTE = {
    "A": 0, "C": 0, "E": 0,
    "B": 1, "D": 1, "F": 1, "M": 1,
    "G": 2,
    "J": 3, "Z": 3,
    "L": 4,
    "N": 5, "Q": 5, "R": 5, "W": 5,
    "1": 6, "2": 6, "3": 6,
    "4": 7, "5": 7, "6": 7,
    "7": 8,
    "S": 9, "FS": 9, "GS": 9, "H": 9,
    "SIR": 10, "SI": 10,
}


def first_route(*candidates: Column) -> Column:
    """First route id that is neither null nor empty."""
    return F.coalesce(*[F.nullif(candidate, F.lit("")) for candidate in candidates])


def first_informed_route(informed_entities: Column) -> Column:
    """Route of the first informed entity that names one."""
    named = F.filter(informed_entities, lambda entity: F.nullif(entity["route_id"], F.lit("")).isNotNull())
    return F.get(named, F.lit(0))["route_id"]


def partition_for_route(route_id: Column) -> Column:
    """Partition of a route: known lines by table, no route last, others by checksum."""
    known = F.create_map(*[F.lit(item) for pair in PARTITION_OF_ROUTE.items() for item in pair])
    named = F.nullif(route_id, F.lit(""))
    hashed = (F.crc32(named.cast("binary")) % ROUTE_PARTITIONS).cast("int")
    return F.when(named.isNull(), F.lit(NO_ROUTE_PARTITION)).otherwise(F.coalesce(known[named], hashed))


def partition_for_topic(topic: Column, route_id: Column) -> Column:
    partition = partition_for_route(route_id)
    return F.when(topic == TOPIC_ALERTS, partition % ALERT_PARTITIONS).otherwise(partition)


def dead_letter_json(feed: Column, error: Column, received_at: Column, raw: Column) -> Column:
    """Envelope of a rejected payload; an empty payload is kept as null."""
    encoded = F.when(F.octet_length(raw) > 0, F.base64(raw))
    return F.to_json(
        F.struct(
            feed.alias("feed"),
            error.alias("error"),
            F.unix_seconds(received_at).alias("received_at"),
            encoded.alias("raw_b64"),
        ),
        {"ignoreNullFields": "false"},
    )
