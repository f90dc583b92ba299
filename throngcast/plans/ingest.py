"""Feed frames to routed messages, dead letters and weather conditions."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from throngcast.functions import messages as rules
from throngcast.functions.weather import observation_columns
from throngcast.schemas import FEED_ENTITY, FEED_FRAME, OBSERVATION_MESSAGE, STRING
from throngcast.sources.writers import route_messages

CORRUPT = "_corrupt_record"
FETCH_FAILED = "fetch_failed"
PARSE_ERROR = "parse_error: malformed JSON"


def parse_frames(raw: DataFrame) -> DataFrame:
    """Parse raw payloads (``feed, value, timestamp``); rejected ones keep an error and no frame."""
    checked = T.StructType([*FEED_FRAME.fields, T.StructField(CORRUPT, STRING)])
    parsed = F.from_json(
        F.col("value").cast("string"), checked, {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": CORRUPT}
    )
    empty = F.coalesce(F.octet_length("value"), F.lit(0)) == 0
    broken = F.col("frame").isNull() | F.col(f"frame.{CORRUPT}").isNotNull()
    # Generated, not projected, so that no later filter parses the payload again.
    return raw.select("*", F.explode(F.array(parsed)).alias("frame")).withColumn(
        "error", F.when(empty, F.lit(FETCH_FAILED)).when(broken, F.lit(PARSE_ERROR))
    )


def dead_letters(parsed: DataFrame) -> DataFrame:
    """Rejected payloads as messages of the dead-letter topic."""
    rejected = parsed.where(F.col("error").isNotNull())
    return rejected.select(
        F.col("feed").alias("key"),
        rules.dead_letter_json(F.col("feed"), F.col("error"), F.col("timestamp"), F.col("value")).alias("value"),
        F.lit(rules.TOPIC_DEAD_LETTER).alias("topic"),
    )


def fan_out(parsed: DataFrame) -> DataFrame:
    """Accepted frames as keyed, partition-routed messages, one per part of an entity.

    An entity may carry a vehicle, a trip update and an alert at once; each part
    becomes a message of its own topic under the same header.
    """
    entities = parsed.where(F.col("error").isNull()).select(
        F.col("frame.feed").alias("feed"),
        F.col("frame.feed_timestamp").alias("feed_timestamp"),
        F.explode("frame.entity").alias("e"),
    )
    route = rules.first_route(
        F.col("e.trip_update.trip.route_id"),
        F.col("e.vehicle.trip.route_id"),
        rules.first_informed_route(F.col("e.alert.informed_entity")),
    )

    def part(topic: str, name: str) -> Column:
        header = [F.col("feed"), F.col("feed_timestamp"), F.col("e.id").alias("entity_id"), F.col("route_id")]
        body = [F.col(f"e.{name}")[f.name].alias(f.name) for f in FEED_ENTITY[name].dataType]
        message = F.struct(F.lit(topic).alias("topic"), F.to_json(F.struct(*header, *body)).alias("value"))
        return F.when(F.col(f"e.{name}").isNotNull(), message)

    parts = F.array_compact(
        F.array(
            part(rules.TOPIC_VEHICLE, "vehicle"),
            part(rules.TOPIC_TRIPS, "trip_update"),
            part(rules.TOPIC_ALERTS, "alert"),
        )
    )
    sent = entities.withColumn("route_id", route).withColumn("m", F.explode(parts))
    return route_messages(
        sent,
        key=F.coalesce("route_id", "feed"),
        value=F.col("m.value"),
        topic=F.col("m.topic"),
        partition=rules.partition_for_topic(F.col("m.topic"), F.col("route_id")),
    )


def classify_observations(messages: DataFrame) -> DataFrame:
    """Weather reports (``scope, value, timestamp``) as current conditions.

    A report that cannot be parsed yields no row, so the last good condition stands.
    """
    report = F.from_json(F.col("value").cast("string"), OBSERVATION_MESSAGE)
    parsed = messages.select("scope", "timestamp", F.explode(F.array(report)).alias("o"))
    fields = observation_columns(
        F.col("o.textDescription"), F.col("o.precipitationLastHour.value"), F.col("o.temperature.value")
    )
    readable = F.coalesce("o.textDescription", F.to_json("o.precipitationLastHour"), F.to_json("o.temperature"))
    return parsed.where(readable.isNotNull()).select(
        "scope", *[value.alias(name) for name, value in fields.items()], F.col("timestamp").alias("updated_at")
    )
