"""Test tables as the entities of this domain; plain projections, streamable where stateless."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from throngcast.schemas import BIGINT, DOUBLE, STRING, struct

EVENTS_SCHEMA = struct(
    event_id=BIGINT, ts=T.TimestampNTZType(), user_id=BIGINT, event_type=STRING, value=DOUBLE, props=STRING
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _instant(df: DataFrame) -> DataFrame:
    return df.withColumn("ts", F.col("ts").cast("timestamp"))


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _instant(table(spark, sf_dir, "events"))


def events_stream(spark: SparkSession, sf_dir: str) -> DataFrame:
    # As a glob the path may be one file or a folder of files.
    reader = spark.readStream.schema(EVENTS_SCHEMA)
    return _instant(reader.parquet(f"{sf_dir}/events.parque[t]"))


def raw_ridership(ev: DataFrame) -> DataFrame:
    return ev.withColumn("h", F.date_trunc("HOUR", "ts")).selectExpr(
        "CASE WHEN event_id % 2 = 1 THEN date_format(h, 'MM/dd/yyyy hh:mm:ss a') "
        "ELSE date_format(h, \"yyyy-MM-dd'T'HH:mm:ss.SSS\") END AS transit_timestamp",
        "CASE WHEN event_type = 'error' THEN 'bus' WHEN event_id % 3 = 0 THEN 'Subway' ELSE 'subway' END AS transit_mode",
        "CAST(user_id % 20 AS STRING) AS station_complex_id",
        "concat('Complex ', user_id % 20) AS station_complex",
        "event_type AS payment_method",
        "format_number(floor(value * 10), 0) AS ridership",
    )


def long_weather(ev: DataFrame) -> DataFrame:
    return ev.selectExpr(
        "date_format(ts, 'yyyy-MM-dd') AS DATE",
        "CASE event_type WHEN 'click' THEN 'prcp' WHEN 'view' THEN 'SNOW' WHEN 'signup' THEN 'TMAX' "
        "WHEN 'purchase' THEN 'TMIN' ELSE 'WIND' END AS DATATYPE",
        "CASE WHEN event_type = 'signup' AND day(ts) % 3 = 0 THEN '' ELSE CAST(value AS STRING) END AS VALUE",
    )


def wide_weather(ev: DataFrame) -> DataFrame:
    return ev.selectExpr(
        "date_format(ts, 'yyyy-MM-dd') AS DATE",
        "CASE WHEN event_type = 'click' THEN CAST(value AS STRING) END AS PRCP",
        "CASE WHEN event_type = 'view' THEN CAST(value AS STRING) END AS SNOW",
        "CASE WHEN event_type = 'signup' AND day(ts) % 3 <> 0 THEN CAST(value AS STRING) END AS TMAX",
        "CASE WHEN event_type = 'purchase' THEN CAST(value AS STRING) END AS TMIN",
    )


def raw_stations(part: DataFrame) -> DataFrame:
    return part.selectExpr(
        # the stations of two thirds of the stops go by an id that no stop has
        "CASE WHEN p_partkey % 3 = 0 THEN CAST(p_partkey AS STRING) ELSE concat('P', p_partkey) END AS `GTFS Stop ID`",
        "CAST(p_partkey % 400 AS STRING) AS `Complex ID`",
        "p_name AS `Stop Name`",
        "CAST(40.5D + (p_partkey % 5) / 50D AS STRING) AS `GTFS Latitude`",
        "CAST(-74.25D + (p_partkey % 4) / 8D AS STRING) AS `GTFS Longitude`",
        "concat(p_brand, ' ', p_type) AS `Daytime Routes`",
    )


def raw_stops(part: DataFrame) -> DataFrame:
    return part.selectExpr("*", "explode(array('N', 'S')) AS side").selectExpr(
        "concat(' ', p_partkey, side, ' ') AS stop_id",
        "CASE WHEN p_partkey % 7 = 0 THEN concat('Unlisted Place Number ', p_partkey) "
        "ELSE replace(p_name, 'a', 'e') END AS stop_name",
        "CAST(40.5D + (p_partkey % 5) / 50D + CASE WHEN p_partkey % 14 = 0 THEN 0.002D "
        "ELSE (p_partkey % 3) * 0.0003D END AS STRING) AS stop_lat",
        "CAST(-74.25D + (p_partkey % 4) / 8D AS STRING) AS stop_lon",
    )


def bridge(supplier: DataFrame) -> DataFrame:
    return supplier.selectExpr(
        "CAST(s_suppkey AS STRING) AS gtfs_stop_id",
        "concat(s_suppkey, 'N') AS source_stop_id",
        "CASE WHEN s_suppkey % 17 <> 16 THEN CAST(s_suppkey % 20 AS STRING) END AS station_complex_id",
        "s_name AS complex_name",
        "40.5D + (s_suppkey % 50) / 100D AS lat",
        "-74.25D + (s_suppkey % 40) / 100D AS lon",
        "CASE WHEN s_suppkey % 3 > 0 THEN concat('R', s_nationkey, ' R', s_suppkey % 7) END AS daytime_routes",
        "CASE WHEN s_suppkey % 17 = 16 THEN 'UNRESOLVED' WHEN s_suppkey % 5 = 4 THEN 'TIER2_NAME' "
        "WHEN s_suppkey % 5 = 3 THEN 'TIER3_GEO' ELSE 'TIER1_DIRECT' END AS match_tier",
    )


def stop_times(lineitem: DataFrame) -> DataFrame:
    return lineitem.selectExpr(
        "concat('X-1-Day-00_', lpad(CAST(l_orderkey DIV 10 AS STRING), 8, '0'), '_1..N0', l_linenumber, 'R') AS trip_id",
        "CAST(l_suppkey AS STRING) AS stop_id",
        "CASE WHEN l_partkey % 50 = 0 THEN '' ELSE concat(lpad(CAST(l_partkey % 28 AS STRING), 2, '0'), ':', "
        "lpad(CAST(l_orderkey % 60 AS STRING), 2, '0'), ':', lpad(CAST(l_linenumber * 7 AS STRING), 2, '0')) "
        "END AS arrival_time",
    )


def _messages(df: DataFrame) -> DataFrame:
    """Encode ``json`` as a broker message."""
    return df.select(F.col("json").cast("binary").alias("value"), "timestamp")


def vehicle_messages(ev: DataFrame) -> DataFrame:
    typed = ev.where("event_type NOT IN ('error', 'purchase')").selectExpr(
        "event_id",
        "to_json(named_struct('feed', 'main', 'feed_timestamp', CAST(unix_seconds(ts) AS STRING), "
        "'entity_id', concat('v', event_id), 'route_id', CASE WHEN user_id % 4 > 0 THEN 'A' END, "
        "'trip', named_struct('trip_id', concat('T', user_id DIV 50), 'route_id', 'C', "
        "'start_date', date_format(ts, 'yyyyMMdd'), 'start_time', date_format(ts, 'HH:mm:ss')), "
        "'vehicle', named_struct('id', concat('car', user_id)), "
        "'stop_id', concat(user_id DIV 50, 'N'), 'current_status', 'STOPPED_AT', "
        "'current_stop_sequence', CAST(user_id % 30 AS INT), "
        "'timestamp', CASE WHEN event_id % 13 > 0 THEN CAST(unix_seconds(ts) AS STRING) END)) AS json",
        "ts AS timestamp",
    )
    return _messages(typed)


def delay_messages(ev: DataFrame) -> DataFrame:
    typed = ev.where("event_type IN ('error', 'purchase')").selectExpr(
        "event_id",
        "to_json(named_struct('feed', 'main', 'feed_timestamp', CAST(unix_seconds(ts) AS STRING), "
        "'entity_id', concat('t', event_id), 'route_id', 'A', "
        "'trip', named_struct('trip_id', concat('T', user_id DIV 50), 'route_id', 'A', "
        "'start_date', date_format(ts, 'yyyyMMdd'), 'start_time', '00:00:00'), "
        "'stop_time_update', array(named_struct('stop_id', concat(user_id DIV 50, 'N'), "
        "'stop_sequence', CAST(user_id % 30 AS INT), "
        "'arrival', named_struct('time', CAST(unix_seconds(ts) AS STRING), 'delay', CAST(floor(value * 5) AS INT)), "
        "'departure', named_struct('time', CAST(unix_seconds(ts) AS STRING), 'delay', CAST(0 AS INT)))), "
        "'timestamp', CASE WHEN event_id % 13 > 0 THEN CAST(unix_seconds(ts) AS STRING) END)) AS json",
        "ts AS timestamp",
    )
    return _messages(typed)


def closing_messages(ev: DataFrame) -> dict[str, DataFrame]:
    """One message per live topic two days after the last event, of trips nothing else mentions."""
    last = ev.agg(F.max("ts").alias("ts")).selectExpr("timestampadd(DAY, 2, ts) AS timestamp")

    def message(trip: str, extra: str) -> DataFrame:
        return last.selectExpr(
            f"CAST(to_json(named_struct('trip', named_struct('trip_id', '{trip}'), {extra}, "
            "'timestamp', CAST(unix_seconds(timestamp) AS STRING))) AS BINARY) AS value",
            "timestamp",
        )

    stop = "named_struct('stop_id', '0N', 'arrival', named_struct('delay', 0))"
    return {
        "vehicles": message("end-of-vehicles", "'stop_id', '0N'"),
        "delays": message("end-of-delays", f"'stop_time_update', array({stop})"),
    }


def trip_messages(lineitem: DataFrame, *, malformed: bool = False) -> DataFrame:
    """Trip updates; ``malformed`` sends a broken second copy after some of them."""
    key = "lpad(CAST(l_orderkey DIV 10 AS STRING), 8, '0')"

    def stop(step: int) -> str:
        arrival = (
            "named_struct('time', CASE WHEN l_suppkey % 11 > 0 THEN CAST(1704067200 + 18000 "
            f"+ (l_partkey % 28) * 90000 + (l_orderkey * 7) % 900 + {step} * 60 AS STRING) END, "
            "'delay', CASE WHEN l_linenumber = 1 THEN CAST(l_quantity * 10 AS INT) END)"
        )
        departure = "named_struct('time', CAST(NULL AS STRING), 'delay', CAST(l_linenumber * 3 AS INT))"
        return (
            f"named_struct('stop_id', CAST(l_suppkey + {step} AS STRING), 'stop_sequence', "
            f"CAST(l_linenumber + {step} AS INT), 'arrival', {arrival}, 'departure', {departure})"
        )

    typed = lineitem.selectExpr(
        "l_partkey",
        "to_json(named_struct('feed', 'main', 'feed_timestamp', '1704067200', "
        "'entity_id', concat(l_orderkey, '-', l_linenumber), "
        "'route_id', CASE WHEN l_partkey % 4 > 0 THEN concat('Q', l_partkey % 4) END, "
        f"'trip', named_struct('trip_id', CASE l_orderkey % 3 WHEN 0 THEN concat({key}, '_1..N0', l_linenumber, 'R') "
        f"WHEN 1 THEN concat({key}, '_1..N') ELSE 'unscheduled' END, 'route_id', 'L', "
        "'start_date', date_format(date_add(DATE'2024-01-01', CAST(l_partkey % 28 AS INT)), 'yyyyMMdd'), "
        "'start_time', '00:00:00'), "
        f"'stop_time_update', CASE WHEN l_partkey % 25 > 0 THEN array({stop(0)}, {stop(1)}) END, "
        "'timestamp', CASE WHEN l_partkey % 9 > 0 THEN CAST(1704067200 + (l_partkey % 28) * 86400 + l_orderkey % 3600 "
        "AS STRING) END)) AS json",
        "CAST(l_shipdate AS TIMESTAMP) AS timestamp",
    )
    sent = _messages(typed)
    if not malformed:
        return sent
    broken = typed.where("l_partkey % 50 = 7").withColumn("json", F.substring("json", 1, 60))
    return sent.unionByName(_messages(broken))


def feed_frames(ev: DataFrame, *, malformed: bool = False) -> DataFrame:
    trip = (
        "named_struct('trip_id', concat('T', user_id), 'route_id', "
        "CASE user_id % 6 WHEN 0 THEN 'A' WHEN 1 THEN '1' WHEN 2 THEN '7' WHEN 3 THEN 'GS' WHEN 4 THEN '' END)"
    )
    entity = (
        "named_struct('id', concat('e', event_id), "
        f"'vehicle', CASE WHEN event_type IN ('view', 'click') THEN named_struct('trip', {trip}, "
        "'stop_id', concat(user_id, 'N'), 'timestamp', CAST(unix_seconds(ts) AS STRING)) END, "
        f"'trip_update', CASE WHEN event_type IN ('error', 'click') THEN named_struct('trip', {trip}, "
        "'timestamp', CAST(unix_seconds(ts) AS STRING)) END, "
        "'alert', CASE WHEN event_type = 'signup' THEN named_struct('informed_entity', array("
        "named_struct('route_id', '', 'stop_id', 'x'), "
        "named_struct('route_id', CASE WHEN user_id % 5 > 0 THEN 'L' END, 'stop_id', 'y')), 'cause', 'WEATHER') END)"
    )
    feed = "CASE user_id % 3 WHEN 0 THEN 'ace' WHEN 1 THEN 'g' ELSE 'main' END"
    framed = ev.selectExpr(
        "event_id",
        f"{feed} AS feed",
        f"to_json(named_struct('feed', {feed}, 'feed_timestamp', CAST(unix_seconds(ts) AS STRING), "
        f"'entity', array({entity}))) AS json",
        "ts AS timestamp",
    )
    if not malformed:
        return framed.selectExpr("feed", "CAST(json AS BINARY) AS value", "timestamp")
    # a failed fetch and a broken copy come after some of the frames
    copies = framed.selectExpr(
        "*",
        "explode(array_compact(array(json, CASE WHEN event_id % 97 = 0 THEN '' END, "
        "CASE WHEN event_id % 50 = 0 THEN substring(json, 1, 36) END))) AS sent",
    )
    return copies.selectExpr("feed", "CAST(sent AS BINARY) AS value", "timestamp")


def observations(ev: DataFrame) -> DataFrame:
    return ev.selectExpr(
        "CASE WHEN user_id % 2 = 0 THEN 'nyc' ELSE concat('zone', user_id % 5) END AS scope",
        "to_json(named_struct('textDescription', CASE event_id % 5 WHEN 0 THEN 'Light Snow' WHEN 1 THEN 'Freezing Sleet' "
        "WHEN 2 THEN 'Rain' WHEN 3 THEN 'Cloudy' END, "
        "'precipitationLastHour', named_struct('value', CASE WHEN event_id % 7 > 0 THEN value / 10 END), "
        "'temperature', named_struct('value', CASE WHEN event_id % 11 > 0 THEN CAST(user_id % 20 - 10 AS DOUBLE) END))) AS value",
        "ts AS timestamp",
    )


def scored_history(ev: DataFrame) -> DataFrame:
    return ev.selectExpr(
        "CAST(user_id % 20 AS STRING) AS station_complex_id",
        "concat('Complex ', user_id % 20) AS complex_name",
        "ts AS event_timestamp",
        "value * 5 AS avg_arrival_delay_secs",
        "least(1D, value / 100) AS service_deficit",
        "1D AS demand_intensity",
        "least(1D, value / 100) AS congestion_score",
        "value * 5 / 60 * 2 AS predicted_delay_mins",
        "CASE WHEN value / 100 >= 0.5D THEN 'SEVERE' WHEN value / 100 >= 0.2D THEN 'MODERATE' ELSE 'NORMAL' END AS alert_level",
        "'clear' AS weather_bucket",
        "timestampadd(SECOND, CAST(event_id % 90 AS INT), ts) AS inserted_at",
    )


def message_log(ev: DataFrame) -> DataFrame:
    return ev.selectExpr(
        "event_type AS topic", "CAST(user_id % 12 AS INT) AS partition", "event_id AS offset", "ts AS timestamp"
    )


def topic_baseline(region: DataFrame) -> DataFrame:
    return region.selectExpr(
        "CASE r_regionkey WHEN 0 THEN 'click' WHEN 1 THEN 'view' ELSE lower(r_name) END AS topic",
        "100 * (r_regionkey + 1) AS total",
    )


def labelled_events(orders: DataFrame) -> DataFrame:
    return orders.selectExpr(
        "concat('order-', o_orderkey) AS event_name",
        "CAST(o_custkey % 20 AS STRING) AS station_complex_id",
        "CAST(CAST(floor(o_totalprice) AS BIGINT) % 600 AS STRING) AS avg_arrival_delay_secs",
        "CAST(o_custkey % 101 AS STRING) AS avg_entries",
        "CASE WHEN o_custkey % 9 = 0 THEN '0' ELSE '97' END AS max_hourly_entries",
        "CASE substring(o_orderpriority, 1, 1) WHEN '1' THEN 'SEVERE' WHEN '2' THEN 'MODERATE' "
        "WHEN '5' THEN 'NORMAL' ELSE '' END AS expected_level",
    )


def profile_input(customer: DataFrame) -> DataFrame:
    return customer.selectExpr(
        "CAST(c_custkey AS STRING) AS c_custkey",
        "CASE WHEN c_custkey % 10 = 0 THEN '  ' ELSE c_name END AS c_name",
        "CASE WHEN c_custkey % 7 > 0 THEN concat(' ', CAST(c_acctbal AS STRING)) END AS c_acctbal",
        "CASE WHEN c_custkey % 50 = 3 THEN 'n/a' ELSE CAST(c_nationkey AS STRING) END AS c_nationkey",
    )
