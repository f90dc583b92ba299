"""The registered queries as DuckDB SQL, written against the raw tables.

Nothing is shared with the Spark side but the rules of the entities: messages,
text layouts and number formats are left out, their typed content is used.
"""

from __future__ import annotations

import re

NORM = "trim(regexp_replace(replace(lower({0}), '&', ' and '), '[^a-z0-9]+', ' ', 'g'))"
# least() skips nulls, so the coordinates are added once more with weight 0
CHORD = (
    "(least(1.0::DOUBLE, pow(sin(radians({2} - {0}) / 2), 2) + cos(radians({0})) * cos(radians({2})) "
    "* pow(sin(radians({3} - {1}) / 2), 2)) + 0 * ({0} + {1} + {2} + {3}))"
)
HAVERSINE = f"2 * 6371000.0::DOUBLE * atan2(sqrt({CHORD}), sqrt(1 - {CHORD}))"
DELAY_LABEL = (
    "CASE WHEN {0} IS NULL OR {0} <= 30 THEN 'On time' WHEN {0} < 60 THEN '<1 min' "
    "WHEN {0} < 600 THEN '~' || round_even({0} / 60, 0)::BIGINT || ' min' "
    "ELSE round_even({0} / 60, 0)::BIGINT || ' min' END"
)
CROWDING = "CASE WHEN {0} >= 0.5 THEN 'Very Busy' WHEN {0} >= 0.2 THEN 'Busy' WHEN {0} >= 0.05 THEN 'Moderate' ELSE 'Quiet' END"
AS_OF = "TIMESTAMP '2024-01-31 00:05:00'"
AGE = (
    "CASE WHEN {0} < 60 THEN {0} || 's ago' WHEN {0} < 3600 THEN ({0} // 60) || 'm ago' "
    "ELSE ({0} // 3600) || 'h ago' END"
)
ISO = "CASE WHEN epoch_us({0}) % 1000000 = 0 THEN strftime({0}, '%Y-%m-%dT%H:%M:%S') ELSE strftime({0}, '%Y-%m-%dT%H:%M:%S.%f') END"
TRIP_KEY = "lpad((l_orderkey // 10)::VARCHAR, 8, '0')"

CTES: dict[str, str] = {
    "ridership_clean": """
        SELECT station_complex_id, station_complex_name, transit_timestamp,
               CAST(transit_timestamp AS DATE) AS date, hour(transit_timestamp)::INTEGER AS hour_of_day,
               (dayofweek(transit_timestamp) + 1)::INTEGER AS day_of_week, entries
        FROM (SELECT (user_id % 20)::VARCHAR AS station_complex_id, 'Complex ' || (user_id % 20) AS station_complex_name,
                     date_trunc('hour', ts) + INTERVAL 5 HOUR AS transit_timestamp, sum(floor(value * 10)) AS entries
              FROM events WHERE event_type <> 'error' GROUP BY ALL)""",
    "weather_long": """
        SELECT CAST(ts AS DATE) AS date,
               CASE event_type WHEN 'click' THEN 'PRCP' WHEN 'view' THEN 'SNOW' WHEN 'signup' THEN 'TMAX'
                    WHEN 'purchase' THEN 'TMIN' ELSE 'WIND' END AS kind,
               CASE WHEN event_type = 'signup' AND day(ts) % 3 = 0 THEN NULL ELSE value END AS value
        FROM events""",
    "weather_max": """
        SELECT date, max(value) FILTER (kind = 'PRCP') AS prcp, max(value) FILTER (kind = 'SNOW') AS snow,
               max(value) FILTER (kind = 'TMAX') AS tmax, max(value) FILTER (kind = 'TMIN') AS tmin
        FROM weather_long GROUP BY date""",
    "weather_mean": """
        SELECT date, max(value) FILTER (kind = 'PRCP') AS prcp, max(value) FILTER (kind = 'SNOW') AS snow,
               avg(value) FILTER (kind = 'TMAX') AS tmax, avg(value) FILTER (kind = 'TMIN') AS tmin
        FROM weather_long GROUP BY date""",
    "weather_clean": """
        SELECT *, CASE WHEN snow_in > 0.1 THEN 'snow' WHEN prcp_in > 0.1 THEN 'rain' ELSE 'clear' END AS weather_bucket
        FROM (SELECT date, coalesce(prcp * 0.0005::DOUBLE, 0) AS prcp_in, coalesce(snow * 0.0005::DOUBLE, 0) AS snow_in,
                     last_value(tmax IGNORE NULLS) OVER w AS tmax_f, last_value(tmin IGNORE NULLS) OVER w AS tmin_f
              FROM weather_max
              WINDOW w AS (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW))""",
    "ridership_weather": """
        SELECT r.*, coalesce(weather_bucket, 'clear') AS weather_bucket
        FROM ridership_clean r LEFT JOIN weather_clean USING (date)""",
    "baseline_input": """
        SELECT * FROM ridership_weather WHERE date >= (SELECT max(date) FROM ridership_clean) - 20""",
    "baseline": """
        SELECT station_complex_id, day_of_week, hour_of_day, weather_bucket, avg(entries) AS avg_entries,
               stddev_samp(entries) AS std_entries, quantile_disc(entries, 0.95) AS p95_entries
        FROM baseline_input GROUP BY ALL""",
    "maxima": """
        SELECT station_complex_id, max(entries) AS max_hourly_entries FROM baseline_input GROUP BY ALL""",
    "seed": """
        SELECT CASE WHEN p_partkey % 3 = 0 THEN '' ELSE 'P' END || p_partkey AS gtfs_stop_id, (p_partkey % 400)::VARCHAR AS station_complex_id, p_name AS complex_name,
               40.5::DOUBLE + (p_partkey % 5) / 50 AS lat, -74.25::DOUBLE + (p_partkey % 4) / 8 AS lon,
               NULL::VARCHAR AS borough, p_brand || ' ' || p_type AS daytime_routes
        FROM part""",
    "stops": """
        SELECT p_partkey::VARCHAR AS gtfs_stop_id, ' ' || p_partkey || 'N ' AS source_stop_id,
               CASE WHEN p_partkey % 7 = 0 THEN 'Unlisted Place Number ' || p_partkey ELSE replace(p_name, 'a', 'e') END AS stop_name,
               40.5::DOUBLE + (p_partkey % 5) / 50 + CASE WHEN p_partkey % 14 = 0 THEN 0.002::DOUBLE
                    ELSE (p_partkey % 3) * 0.0003::DOUBLE END AS stop_lat,
               -74.25::DOUBLE + (p_partkey % 4) / 8 AS stop_lon
        FROM part""",
    "tier1": """
        SELECT gtfs_stop_id, source_stop_id, station_complex_id, complex_name, lat, lon, borough, daytime_routes,
               'TIER1_DIRECT' AS match_tier, NULL::DOUBLE AS match_distance
        FROM stops JOIN seed USING (gtfs_stop_id)""",
    "unmatched": "SELECT * FROM stops WHERE gtfs_stop_id NOT IN (SELECT gtfs_stop_id FROM seed)",
    "tier2": f"""
        SELECT gtfs_stop_id, source_stop_id, station_complex_id, complex_name, lat, lon, borough, daytime_routes,
               'TIER2_NAME' AS match_tier, dist::DOUBLE AS match_distance
        FROM (SELECT u.*, s.* EXCLUDE (gtfs_stop_id, norm), levenshtein(u.norm, s.norm) AS dist,
                     row_number() OVER (PARTITION BY u.gtfs_stop_id ORDER BY levenshtein(u.norm, s.norm),
                         station_complex_id, complex_name, lat, lon, daytime_routes) AS rn
              FROM (SELECT *, {NORM.format('stop_name')} AS norm FROM unmatched) u,
                   (SELECT *, {NORM.format('complex_name')} AS norm FROM seed) s
              WHERE levenshtein(u.norm, s.norm) <= 4)
        WHERE rn = 1""",
    "tier3": f"""
        SELECT gtfs_stop_id, source_stop_id, station_complex_id, complex_name, lat, lon, borough, daytime_routes,
               'TIER3_GEO' AS match_tier, dist AS match_distance
        FROM (SELECT *, row_number() OVER (PARTITION BY gtfs_stop_id ORDER BY round(dist, 6), station_complex_id,
                     complex_name, lat, lon, daytime_routes) AS rn
              FROM (SELECT u.*, s.* EXCLUDE (gtfs_stop_id), {HAVERSINE.format('stop_lat', 'stop_lon', 'lat', 'lon')} AS dist
                    FROM (SELECT * FROM unmatched WHERE gtfs_stop_id NOT IN (SELECT gtfs_stop_id FROM tier2)) u, seed s)
              WHERE dist < 100)
        WHERE rn = 1""",
    "matched": """
        SELECT gtfs_stop_id FROM tier1 UNION SELECT gtfs_stop_id FROM tier2 UNION SELECT gtfs_stop_id FROM tier3""",
    "unresolved": """
        SELECT gtfs_stop_id, source_stop_id, NULL::VARCHAR AS station_complex_id, stop_name AS complex_name,
               stop_lat AS lat, stop_lon AS lon, NULL::VARCHAR AS borough, NULL::VARCHAR AS daytime_routes,
               'UNRESOLVED' AS match_tier, NULL::DOUBLE AS match_distance
        FROM unmatched WHERE gtfs_stop_id NOT IN (SELECT gtfs_stop_id FROM matched)""",
    "tiers": """
        SELECT * FROM tier1 UNION ALL SELECT * FROM tier2 UNION ALL SELECT * FROM tier3 UNION ALL SELECT * FROM unresolved""",
    "schedule": f"""
        SELECT {TRIP_KEY} || '_1..N0' || l_linenumber || 'R' AS trip_id_suffix, {TRIP_KEY} || '_1..N' AS prefix,
               l_suppkey::VARCHAR AS stop_id,
               ((l_partkey % 28) * 3600 + (l_orderkey % 60) * 60 + l_linenumber * 7)::INTEGER AS sched_arr_secs
        FROM lineitem WHERE l_partkey % 50 <> 0""",
    "schedule_unique": """
        SELECT trip_id_suffix, stop_id, min(sched_arr_secs) AS sched_arr_secs FROM schedule GROUP BY ALL""",
    "schedule_median": """
        SELECT prefix, stop_id, trunc(median(sched_arr_secs))::BIGINT AS sched_arr_secs FROM schedule GROUP BY ALL""",
    "bridge": """
        SELECT s_suppkey::VARCHAR AS gtfs_stop_id, CASE WHEN s_suppkey % 17 <> 16 THEN (s_suppkey % 20)::VARCHAR END AS station_complex_id,
               s_name AS complex_name, 40.5::DOUBLE + (s_suppkey % 50) / 100 AS lat, -74.25::DOUBLE + (s_suppkey % 40) / 100 AS lon,
               CASE WHEN s_suppkey % 3 > 0 THEN 'R' || s_nationkey || ' R' || (s_suppkey % 7) END AS daytime_routes
        FROM supplier""",
    "vehicles": """
        SELECT 'T' || (user_id // 50) AS trip_id, CASE WHEN user_id % 4 > 0 THEN 'A' ELSE 'C' END AS route_id,
               'car' || user_id AS vehicle_id, (user_id // 50) || 'N' AS stop_id, e.stop_id_base, 'STOPPED_AT' AS current_status,
               (user_id % 30)::INTEGER AS current_stop_sequence,
               event_timestamp, b.station_complex_id, b.complex_name, b.lat, b.lon,
               CAST(event_timestamp AS DATE) AS event_date
        FROM (SELECT *, (user_id // 50)::VARCHAR AS stop_id_base,
                     CASE WHEN event_id % 13 = 0 THEN ts ELSE date_trunc('second', ts) END AS event_timestamp
              FROM events WHERE event_type NOT IN ('error', 'purchase')) e
        LEFT JOIN bridge b ON b.gtfs_stop_id = e.stop_id_base""",
    "delays": """
        SELECT 'T' || (user_id // 50) AS trip_id, (user_id // 50) || 'N' AS stop_id,
               floor(value * 5)::INTEGER AS arrival_delay_secs,
               CASE WHEN event_id % 13 = 0 THEN ts ELSE date_trunc('second', ts) END AS event_timestamp
        FROM events WHERE event_type IN ('error', 'purchase')""",
    "pairs": """
        SELECT v.trip_id, v.stop_id, v.station_complex_id, v.event_timestamp AS vehicle_timestamp,
               d.arrival_delay_secs::DOUBLE AS arrival_delay_secs, d.event_timestamp AS trip_timestamp
        FROM vehicles v JOIN delays d ON v.trip_id = d.trip_id AND v.stop_id = d.stop_id
             AND d.event_timestamp BETWEEN v.event_timestamp - INTERVAL 5 MINUTE AND v.event_timestamp + INTERVAL 5 MINUTE
        WHERE v.station_complex_id IS NOT NULL""",
    "signal": """
        SELECT station_complex_id, make_timestamp((epoch_us(vehicle_timestamp) // 30000000 + 1 + k) * 30000000) AS event_timestamp,
               avg(arrival_delay_secs) AS avg_arrival_delay_secs
        FROM pairs, (SELECT unnest(range(0, 20)) AS k) GROUP BY ALL""",
    "score_input": """
        SELECT s.*, b.avg_entries, m.max_hourly_entries, n.complex_name
        FROM signal s
        LEFT JOIN baseline b ON b.station_complex_id = s.station_complex_id AND b.weather_bucket = 'clear'
             AND b.day_of_week = dayofweek(s.event_timestamp) + 1 AND b.hour_of_day = hour(s.event_timestamp)
        LEFT JOIN maxima m ON m.station_complex_id = s.station_complex_id
        LEFT JOIN (SELECT station_complex_id, min(complex_name) AS complex_name FROM bridge GROUP BY ALL) n
             ON n.station_complex_id = s.station_complex_id""",
    "congestion": """
        SELECT station_complex_id, complex_name, event_timestamp, avg_arrival_delay_secs, deficit AS service_deficit,
               demand AS demand_intensity, deficit * demand AS congestion_score,
               avg_arrival_delay_secs / 60 * (1 + demand) AS predicted_delay_mins,
               CASE WHEN deficit * demand >= 0.5 THEN 'SEVERE' WHEN deficit * demand >= 0.2 THEN 'MODERATE' ELSE 'NORMAL' END AS alert_level,
               avg_entries IS NULL AS baseline_missing
        FROM (SELECT *, least(1, greatest(0, (avg_arrival_delay_secs - 60) / 240)) AS deficit,
                     CASE WHEN max_hourly_entries > 0 THEN coalesce(least(1, greatest(0, avg_entries / max_hourly_entries)), 0)
                          ELSE 0 END AS demand
              FROM score_input)""",
    "conditions": """
        SELECT scope, CASE WHEN snowing THEN 'snow' WHEN prcp_in > 0.1 THEN 'rain' ELSE 'clear' END AS weather_bucket,
               prcp_in, CASE WHEN snowing THEN prcp_in ELSE 0 END AS snow_in, temp * 9 / 5 + 32 AS tmax_f, updated_at
        FROM (SELECT CASE WHEN user_id % 2 = 0 THEN 'nyc' ELSE 'zone' || (user_id % 5) END AS scope, ts AS updated_at,
                     CASE WHEN event_id % 7 > 0 THEN value / 10 / 25.4 ELSE 0 END AS prcp_in,
                     CASE WHEN event_id % 11 > 0 THEN (user_id % 20 - 10)::DOUBLE END AS temp,
                     event_id % 5 < 2 AND event_id % 11 > 0 AND user_id % 20 < 10 AS snowing
              FROM events)""",
    "frames": """
        SELECT *, CASE user_id % 3 WHEN 0 THEN 'ace' WHEN 1 THEN 'g' ELSE 'main' END AS feed,
               floor(epoch(ts))::BIGINT AS secs
        FROM events""",
    "scored": """
        SELECT (user_id % 20)::VARCHAR AS station_complex_id, 'Complex ' || (user_id % 20) AS complex_name,
               ts AS event_timestamp, value * 5 AS avg_arrival_delay_secs, least(1::DOUBLE, value / 100) AS service_deficit,
               1::DOUBLE AS demand_intensity, least(1::DOUBLE, value / 100) AS congestion_score,
               value * 5 / 60 * 2 AS predicted_delay_mins,
               CASE WHEN value / 100 >= 0.5 THEN 'SEVERE' WHEN value / 100 >= 0.2 THEN 'MODERATE' ELSE 'NORMAL' END AS alert_level,
               'clear' AS weather_bucket, ts + to_seconds(event_id % 90) AS inserted_at
        FROM events""",
    "latest": """
        SELECT * EXCLUDE (rn) FROM (
            SELECT *, row_number() OVER (PARTITION BY station_complex_id ORDER BY event_timestamp DESC, inserted_at DESC,
                   congestion_score DESC) AS rn FROM scored)
        WHERE rn = 1""",
    "directory": """
        SELECT station_complex_id, min(complex_name) AS name, avg(lat) AS lat, avg(lon) AS lon,
               nullif(array_to_string(list_sort(list_distinct(flatten(list(string_split(daytime_routes, ' '))
                   FILTER (daytime_routes IS NOT NULL)))), ' '), '') AS daytime_routes
        FROM bridge WHERE station_complex_id IS NOT NULL GROUP BY station_complex_id""",
    "board": f"""
        SELECT d.*, alert_level_or AS alert_level, score AS congestion_score, delay_secs AS avg_arrival_delay_secs,
               least(400, greatest(100, 100 + score * 300)) AS radius, {CROWDING.format('score')} AS crowding,
               {DELAY_LABEL.format('delay_secs')} AS delay
        FROM directory d JOIN (
            SELECT d2.station_complex_id, coalesce(l.alert_level, 'N/A') AS alert_level_or,
                   coalesce(l.congestion_score, 0) AS score, l.avg_arrival_delay_secs AS delay_secs
            FROM directory d2 LEFT JOIN latest l
                 USING (station_complex_id)) s USING (station_complex_id)""",
    "updates": f"""
        SELECT CASE l_orderkey % 3 WHEN 0 THEN {TRIP_KEY} || '_1..N0' || l_linenumber || 'R' WHEN 1 THEN {TRIP_KEY} || '_1..N'
                    ELSE 'unscheduled' END AS trip_id,
               CASE WHEN l_partkey % 4 > 0 THEN 'Q' || (l_partkey % 4) ELSE 'L' END AS route_id,
               strftime(DATE '2024-01-01' + (l_partkey % 28)::INTEGER, '%Y%m%d') AS start_date,
               CASE WHEN l_partkey % 9 > 0 THEN 1704067200 + (l_partkey % 28) * 86400 + l_orderkey % 3600 END AS event_unix_ts,
               CAST(l_shipdate AS TIMESTAMP) AS kafka_ts, *
        FROM lineitem""",
    "parsed_updates": """
        SELECT trip_id, route_id, start_date, (l_suppkey + step)::VARCHAR AS stop_id, (l_linenumber + step)::INTEGER AS stop_sequence,
               CASE WHEN l_linenumber = 1 THEN trunc(l_quantity * 10)::INTEGER END AS arrival_delay_native,
               (l_linenumber * 3)::INTEGER AS departure_delay_secs,
               CASE WHEN l_suppkey % 11 > 0 THEN 1704085200 + (l_partkey % 28) * 90000 + (l_orderkey * 7) % 900 + step * 60
                    END AS arrival_time_epoch, event_unix_ts, kafka_ts, l_partkey
        FROM updates, (SELECT unnest([0, 1]) AS step) WHERE l_partkey % 25 > 0
        UNION ALL
        SELECT trip_id, route_id, start_date, NULL, NULL, NULL, NULL, NULL, event_unix_ts, kafka_ts, l_partkey
        FROM updates WHERE l_partkey % 25 = 0""",
    "scheduled_delays": """
        SELECT trip_id, route_id, start_date, stop_id, stop_sequence,
               coalesce(arrival_delay_native, computed)::INTEGER AS arrival_delay_secs, departure_delay_secs, arrival_time_epoch,
               scheduled_arrival_unix, CASE WHEN arrival_delay_native IS NOT NULL THEN 'native' ELSE 'computed' END AS delay_source,
               event_unix_ts, kafka_ts, event_timestamp, CAST(event_timestamp AS DATE) AS event_date
        FROM (SELECT *, arrival_time_epoch - scheduled_arrival_unix AS computed
              FROM (SELECT p.*, coalesce(make_timestamp(event_unix_ts * 1000000), kafka_ts) AS event_timestamp,
                           1704067200 + (l_partkey % 28) * 86400 + 18000 + coalesce(f.sched_arr_secs, m.sched_arr_secs) AS scheduled_arrival_unix
                    FROM parsed_updates p
                    LEFT JOIN schedule_unique f ON f.trip_id_suffix = p.trip_id AND f.stop_id = p.stop_id
                    LEFT JOIN schedule_median m ON m.prefix = regexp_extract(p.trip_id, '^(.+\\.\\.[NSEW])', 1) AND m.stop_id = p.stop_id
                    WHERE p.stop_id IS NOT NULL))
        WHERE arrival_delay_native IS NOT NULL OR computed IS NOT NULL""",
    "profiled": """
        SELECT CASE WHEN c_custkey % 10 = 0 THEN NULL ELSE c_name END AS name,
               CASE WHEN c_custkey % 7 > 0 THEN c_acctbal END AS acctbal, c_custkey, c_nationkey FROM customer""",
}


def _with(select: str) -> str:
    """Prefix a query with the CTEs it needs, in their order of definition."""
    needed: set[str] = set()
    pending = [select]
    while pending:
        words = set(re.findall(r"\w+", pending.pop()))
        for name in CTES.keys() & words - needed:
            needed.add(name)
            pending.append(CTES[name])
    parts = [f"{name} AS ({CTES[name].strip()})" for name in CTES if name in needed]
    return f"WITH {', '.join(parts)} {select}" if parts else select


def _r(*names: str) -> str:
    return ", ".join(f"round({name}, 6) AS {name}" for name in names)


BRIDGE_COLUMNS = (
    "gtfs_stop_id, source_stop_id, station_complex_id, complex_name, " + _r("lat", "lon") + ", borough, daytime_routes, "
    "match_tier, " + _r("match_distance")
)
SCORE_COLUMNS = (
    "station_complex_id, complex_name, event_timestamp, "
    + _r("avg_arrival_delay_secs", "service_deficit", "demand_intensity", "congestion_score", "predicted_delay_mins")
    + ", alert_level"
)
INSERTED = "TIMESTAMP '2024-02-01 00:00:00' AS inserted_at"
CONDITION_COLUMNS = "scope, weather_bucket, " + _r("prcp_in", "snow_in", "tmax_f") + ", updated_at"
BASELINE_COLUMNS = "station_complex_id, day_of_week, hour_of_day, weather_bucket, " + _r("avg_entries", "std_entries", "p95_entries")
SCORED_COLUMNS = SCORE_COLUMNS + ", weather_bucket, inserted_at"
DIRECTORY_COLUMNS = "station_complex_id, name, " + _r("lat", "lon") + ", daytime_routes"
BOARD_COLUMNS = DIRECTORY_COLUMNS + ", alert_level, " + _r("congestion_score", "avg_arrival_delay_secs", "radius") + ", crowding, delay"
PAIR_COLUMNS = "trip_id, stop_id, station_complex_id, vehicle_timestamp, arrival_delay_secs, trip_timestamp"
SIGNAL_QUERY = f"SELECT station_complex_id, event_timestamp, {_r('avg_arrival_delay_secs')} FROM signal"
SCORE_QUERY = f"SELECT {SCORE_COLUMNS}, 'clear' AS weather_bucket, {INSERTED} FROM congestion"


def _bucket_at(moment: str, scope: str) -> str:
    return (
        f"coalesce((SELECT CASE WHEN TIMESTAMP '{moment}' - max(updated_at) < INTERVAL 60 MINUTE "
        f"THEN arg_max(weather_bucket, updated_at) END FROM conditions WHERE scope = '{scope}'), 'clear')"
    )


def _profile(name: str, filled: str, number: str | None) -> str:
    bounds = f"min({number}), max({number})" if number else "NULL::DOUBLE, NULL::DOUBLE"
    return f"SELECT '{name}', count(*), count(*) - count({filled}), {bounds} FROM profiled"


_SELECTS: dict[str, str] = {
    # sources and sinks
    "scan_partitioned": "SELECT event_date, count(*) AS rows, count(station_complex_id) AS resolved_rows FROM vehicles "
    "WHERE event_date >= DATE '2024-01-10' GROUP BY event_date",
    "scan_csv_union": "SELECT c_custkey::VARCHAR AS c_custkey, c_name, CASE WHEN c_custkey % 2 = 0 THEN c_mktsegment END AS c_mktsegment, "
    "CASE WHEN c_custkey % 2 = 1 THEN c_nationkey::VARCHAR END AS c_nationkey FROM customer",
    "sink_partitioned_roundtrip": f"SELECT * REPLACE ({_r('entries')}) FROM ridership_clean",
    "baseline_bulk_load": f"SELECT {BASELINE_COLUMNS} FROM baseline",
    "incremental_extract": f"SELECT ts, event_id, user_id, {_r('value')} FROM events WHERE ts >= TIMESTAMP '2024-01-15' "
    "ORDER BY ts, event_id LIMIT 500 OFFSET 100",
    "route_messages": """
        SELECT coalesce(route_id, feed) AS key, topic,
               (CASE WHEN topic = 'gtfs-alerts' THEN part % 2 ELSE part END)::INTEGER AS partition,
               'e' || event_id AS entity_id, route_id, secs::VARCHAR AS feed_timestamp
        FROM (SELECT *, CASE route_id WHEN 'A' THEN 0 WHEN '1' THEN 6 WHEN '7' THEN 8 WHEN 'GS' THEN 9 WHEN 'L' THEN 4 ELSE 11 END AS part
              FROM (SELECT *, CASE WHEN event_type = 'signup' THEN CASE WHEN user_id % 5 > 0 THEN 'L' END
                                   ELSE CASE user_id % 6 WHEN 0 THEN 'A' WHEN 1 THEN '1' WHEN 2 THEN '7' WHEN 3 THEN 'GS' END END AS route_id,
                           unnest(CASE event_type WHEN 'view' THEN ['gtfs-vehicle'] WHEN 'error' THEN ['gtfs-trips']
                                  WHEN 'click' THEN ['gtfs-vehicle', 'gtfs-trips'] WHEN 'signup' THEN ['gtfs-alerts'] ELSE [] END) AS topic
                    FROM frames))""",
    "dead_letters": """
        SELECT feed AS key, 'gtfs-dlq' AS topic, feed, error, secs AS received_at,
               CASE WHEN error <> 'fetch_failed' THEN base64(encode(substr('{"feed":"' || feed || '","feed_timestamp":"' || secs || '"', 1, 36)))
               END AS raw_b64
        FROM (SELECT *, unnest([CASE WHEN event_id % 97 = 0 THEN 'fetch_failed' END,
              CASE WHEN event_id % 50 = 0 THEN 'parse_error: malformed JSON' END]) AS error FROM frames)
        WHERE error IS NOT NULL""",
    "topic_offsets": "SELECT event_type AS topic, (user_id % 12)::INTEGER AS partition, max(event_id) + 1 AS next_offset FROM events GROUP BY ALL",
    "topic_totals": """
        SELECT topic, total, total - CASE topic WHEN 'click' THEN 100 WHEN 'view' THEN 200 ELSE 0 END AS delta
        FROM (SELECT topic, sum(n)::BIGINT AS total FROM (
              SELECT event_type AS topic, user_id % 12 AS p, max(event_id) + 1 AS n FROM events GROUP BY ALL) GROUP BY topic)""",
    "topic_throughput": "SELECT date_trunc('minute', ts) AS window_start, event_type AS topic, count(*) AS msgs_per_min FROM events GROUP BY ALL",
    # projections and scalar rules
    "resolve_columns": "SELECT CASE WHEN p_partkey % 3 = 0 THEN '' ELSE 'P' END || p_partkey AS stop_id, (p_partkey % 400)::VARCHAR AS complex_id, "
    "p_brand || ' ' || p_type AS routes, NULL::VARCHAR AS borough FROM part",
    "normalize_stop_ids": "SELECT ' ' || p_partkey || side || ' ' AS stop_id, p_partkey::VARCHAR AS normalized, "
    "' ' || p_partkey || side || ' ' AS untrimmed_base, '' AS of_null FROM part, (SELECT unnest(['N', 'S']) AS side)",
    "normalize_names": f"SELECT name, {NORM.format('name')} AS normalized FROM "
    "(SELECT '  ' || c_name || ' & ' || c_mktsegment || '-42  St. ' AS name FROM customer)",
    "haversine": f"""
        SELECT c_custkey, round({HAVERSINE.format('lat1', 'lon1', 'lat2', 'lon2')} / 1000, 6) AS km
        FROM (SELECT c_custkey, (c_custkey % 170 - 85)::DOUBLE AS lat1, (c_custkey % 340 - 170)::DOUBLE AS lon1,
                     c_acctbal / 200 AS lat2, CASE WHEN c_custkey % 11 > 0 THEN c_acctbal / 100 END AS lon2 FROM customer
              UNION ALL
              SELECT -c_custkey, (c_custkey % 170 - 85)::DOUBLE, (c_custkey % 340 - 170)::DOUBLE, -(c_custkey % 170 - 85)::DOUBLE,
                     (c_custkey % 340 - 170)::DOUBLE + 180 FROM customer)""",
    "weather_bucket": f"""
        SELECT event_id, {_r('prcp_in', 'snow_in')},
               CASE WHEN snow_in > 0.1 THEN 'snow' WHEN prcp_in > 0.1 THEN 'rain' ELSE 'clear' END AS bucket
        FROM (SELECT event_id, CASE WHEN event_id % 5 > 0 THEN value / 500 END AS prcp_in,
                     CASE WHEN event_id % 3 = 0 THEN value / 700 END AS snow_in FROM events)""",
    "clamp_scores": """
        SELECT event_id, round(coalesce(least(1, greatest(0, raw)), 0), 6) AS unit,
               round(coalesce(least(0.75::DOUBLE, greatest(0.25::DOUBLE, raw)), 0.25), 6) AS narrow,
               round(least(400, greatest(100, 100 + coalesce(raw, 0) * 300)), 6) AS radius,
               round(coalesce(least(1, greatest(0, (raw * 300 - 60) / 240)), 0), 6) AS deficit
        FROM (SELECT event_id, CASE WHEN event_id % 7 > 0 THEN value / 50 - 0.5 END AS raw FROM events)""",
    "parse_timestamps": """
        SELECT event_id, parsed, parsed + INTERVAL 5 HOUR AS parsed_utc
        FROM (SELECT event_id, CASE WHEN event_id % 7 = 0 THEN date_trunc('milliseconds', ts) WHEN event_id % 7 < 5 THEN date_trunc('second', ts)
                     WHEN event_id % 7 = 5 THEN date_trunc('day', ts) END AS parsed FROM events)""",
    "parse_iso": "SELECT event_id, CASE event_id % 5 WHEN 0 THEN date_trunc('second', ts) WHEN 1 THEN date_trunc('second', ts) - INTERVAL 2 HOUR "
    "WHEN 2 THEN date_trunc('second', ts) END AS parsed FROM events",
    "calendar_parts": """
        SELECT event_id, CAST(ts AS DATE) AS date, hour(ts)::INTEGER AS hour_of_day, (dayofweek(ts) + 1)::INTEGER AS day_of_week,
               CAST(ts - INTERVAL 5 HOUR AS DATE) AS local_date, hour(ts - INTERVAL 5 HOUR)::INTEGER AS local_hour,
               (dayofweek(ts - INTERVAL 5 HOUR) + 1)::INTEGER AS local_day FROM events""",
    "trip_prefix": f"""
        SELECT DISTINCT {TRIP_KEY} || '_1..N0' || l_linenumber || 'R' AS trip_id, {TRIP_KEY} || '_1..N' AS prefix,
               {TRIP_KEY} || '_1..N' AS static_prefix, '' AS no_prefix FROM lineitem""",
    "classify_observation": f"SELECT {CONDITION_COLUMNS} FROM conditions",
    "age_labels": f"""
        SELECT station_complex_id, event_timestamp, {AGE.format('secs')} AS age,
               CASE WHEN secs < 60 THEN secs || 's ago' ELSE (secs // 60) || 'm ' || (secs % 60) || 's ago' END AS freshness,
               {ISO.format('event_timestamp')} AS iso
        FROM (SELECT *, datesub('second', event_timestamp, TIMESTAMP '2024-01-30 23:59:59') AS secs FROM scored)""",
    # ridership, weather, baseline
    "clean_ridership": f"SELECT * REPLACE ({_r('entries')}) FROM ridership_clean",
    "weather_pivot": 'SELECT date, round(prcp, 6) AS "PRCP", round(snow, 6) AS "SNOW", round(tmax, 6) AS "TMAX", round(tmin, 6) AS "TMIN" FROM weather_max',
    "weather_daily": "SELECT date, round(prcp, 6) AS prcp_raw, round(snow, 6) AS snow_raw, round(tmax, 6) AS tmax_raw, round(tmin, 6) AS tmin_raw FROM weather_mean",
    "weather_multi_station": 'SELECT date, round(coalesce(prcp, 0), 6) AS "PRCP", round(coalesce(snow, 0), 6) AS "SNOW", round(tmax, 6) AS "TMAX", round(tmin, 6) AS "TMIN" FROM weather_mean',
    "weather_forward_fill": """
        SELECT date, round(last_value(tmax IGNORE NULLS) OVER w, 6) AS tmax_raw, round(last_value(tmin IGNORE NULLS) OVER w, 6) AS tmin_raw
        FROM weather_mean WINDOW w AS (ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "clean_weather": f"SELECT date, {_r('prcp_in', 'snow_in', 'tmax_f', 'tmin_f')}, weather_bucket FROM weather_clean",
    "clean_weather_wide": """
        SELECT c.date, round(prcp_in, 6) AS prcp_in, round(snow_in, 6) AS snow_in,
               round(last_value(m.tmax IGNORE NULLS) OVER w, 6) AS tmax_f, round(last_value(m.tmin IGNORE NULLS) OVER w, 6) AS tmin_f, weather_bucket
        FROM weather_clean c JOIN weather_mean m USING (date)
        WINDOW w AS (ORDER BY c.date ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)""",
    "join_weather": f"""
        SELECT r.* REPLACE ({_r('entries')}), coalesce(w.weather_bucket, 'clear') AS weather_bucket, w.weather_bucket IS NULL AS weather_join_missing
        FROM ridership_clean r LEFT JOIN weather_clean w USING (date)""",
    "bridge_validate": f"""
        SELECT r.* REPLACE ({_r('entries')}), station_complex_id IN (SELECT station_complex_id FROM bridge
               WHERE station_complex_id IS NOT NULL) AS bridge_resolved FROM ridership_clean r""",
    "lookback_filter": f"SELECT * REPLACE ({_r('entries')}) FROM ridership_clean WHERE date >= (SELECT max(date) FROM ridership_clean) - 7",
    "capacity_baseline": f"SELECT {BASELINE_COLUMNS} FROM baseline",
    "station_max": f"SELECT station_complex_id, {_r('max_hourly_entries')} FROM maxima",
    "weather_coefficients": """
        SELECT a.station_complex_id, a.weather_bucket, round(a.m / c.m, 6) AS multiplier
        FROM (SELECT station_complex_id, weather_bucket, avg(entries) AS m FROM ridership_weather GROUP BY ALL) a
        JOIN (SELECT station_complex_id, avg(entries) AS m FROM ridership_weather WHERE weather_bucket = 'clear' GROUP BY ALL) c
             ON a.station_complex_id = c.station_complex_id AND c.m > 0""",
    "bucket_counts": """
        SELECT 'weather_bucket' AS counted, weather_bucket AS value, count(*) AS rows FROM weather_clean GROUP BY ALL
        UNION ALL
        SELECT 'bridge_resolved', known::VARCHAR, count(*) FROM (SELECT station_complex_id IN (SELECT station_complex_id FROM bridge
            WHERE station_complex_id IS NOT NULL) AS known FROM ridership_clean) GROUP BY ALL""",
    # bridge and schedule
    "bridge_tier1": f"SELECT {BRIDGE_COLUMNS} FROM tier1",
    "bridge_tier2_name": f"SELECT {BRIDGE_COLUMNS} FROM tier2",
    "bridge_tier3_geo": f"SELECT {BRIDGE_COLUMNS} FROM tier3",
    "bridge_unresolved": f"SELECT {BRIDGE_COLUMNS} FROM unresolved",
    "matched_keys": "SELECT gtfs_stop_id FROM matched",
    "stop_keys_union": "SELECT gtfs_stop_id FROM stops UNION SELECT gtfs_stop_id FROM seed",
    "stop_keys_unlisted": "SELECT gtfs_stop_id, stop_name FROM unmatched",
    "bridge_tiered": f"SELECT {BRIDGE_COLUMNS} FROM tiers",
    "bridge_summary": """
        SELECT count(*) AS total_stops, count(*) FILTER (match_tier = 'TIER1_DIRECT') AS tier1_direct,
               count(*) FILTER (match_tier = 'TIER2_NAME') AS tier2_name, count(*) FILTER (match_tier = 'TIER3_GEO') AS tier3_geo,
               count(*) FILTER (match_tier = 'UNRESOLVED') AS unresolved,
               round(count(*) FILTER (match_tier = 'UNRESOLVED') / count(*), 6) AS unresolved_rate FROM tiers""",
    "schedule_full": "SELECT trip_id_suffix, stop_id, sched_arr_secs FROM schedule",
    "schedule_prefix": "SELECT prefix, stop_id, sched_arr_secs FROM schedule_median",
    "dedupe_by_key": "SELECT trip_id_suffix, stop_id, sched_arr_secs FROM schedule_unique",
    "first_whole_row": """
        SELECT l_orderkey, l_linenumber, l_partkey, l_suppkey, round(l_quantity, 6) AS l_quantity FROM (
            SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY l_partkey, l_suppkey, l_quantity) AS rn FROM lineitem)
        WHERE rn = 1""",
    # live path
    "enrich_vehicles": f"SELECT * REPLACE ({_r('lat', 'lon')}) FROM vehicles",
    "parse_trip_updates": "SELECT * EXCLUDE (l_partkey) FROM parsed_updates UNION ALL "
    "SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, kafka_ts FROM updates WHERE l_partkey % 50 = 7",
    "trip_delays": "SELECT * FROM scheduled_delays",
    "interval_join": f"SELECT {PAIR_COLUMNS} FROM pairs",
    "sliding_delay_avg": """
        SELECT (user_id % 20)::VARCHAR AS station_complex_id, make_timestamp((epoch_us(ts) // 30000000 + 1 + k) * 30000000) AS event_timestamp,
               round(avg(value), 6) AS avg_arrival_delay_secs
        FROM events, (SELECT unnest(range(0, 20)) AS k) GROUP BY ALL""",
    "delay_signal": SIGNAL_QUERY,
    "score_congestion": SCORE_QUERY,
    "score_with_current_condition": f"""
        SELECT {SCORE_COLUMNS}, 'clear' AS weather_bucket, {INSERTED}, baseline_missing FROM congestion""",
    "current_bucket": f"""
        SELECT 'fresh' AS state, 'nyc' AS scope, {_bucket_at('2024-01-31 00:00:00', 'nyc')} AS weather_bucket
        UNION ALL SELECT 'stale', 'nyc', {_bucket_at('2024-02-03 00:00:00', 'nyc')}
        UNION ALL SELECT 'absent', 'elsewhere', {_bucket_at('2024-01-31 00:05:00', 'elsewhere')}""",
    # serving
    "latest_per_station": f"SELECT {SCORED_COLUMNS} FROM latest",
    "alerts": f"SELECT {SCORED_COLUMNS} FROM latest WHERE alert_level IN ('MODERATE', 'SEVERE') ORDER BY congestion_score DESC, station_complex_id",
    "station_current": f"SELECT * REPLACE ({ISO.format('event_timestamp')} AS event_timestamp, {ISO.format('inserted_at')} AS inserted_at) "
    f"FROM (SELECT {SCORED_COLUMNS} FROM latest) WHERE station_complex_id = '7'",
    "station_history": f"""
        SELECT event_timestamp, {_r('congestion_score', 'avg_arrival_delay_secs')}, alert_level FROM scored
        WHERE station_complex_id = '7' AND inserted_at >= {AS_OF} - INTERVAL 48 HOUR""",
    "forecast_next_hour": f"SELECT station_complex_id, hour_of_day AS next_hour, day_of_week, {_r('avg_entries', 'p95_entries')} FROM baseline "
    "WHERE weather_bucket = 'clear' AND day_of_week = dayofweek(DATE '2024-01-30') + 1 AND hour_of_day = 9",
    "forecast_lookup": f"SELECT station_complex_id, hour_of_day AS next_hour, day_of_week, {_r('avg_entries', 'p95_entries')} FROM baseline "
    "WHERE station_complex_id = '7' AND weather_bucket = 'clear' AND day_of_week = dayofweek(DATE '2024-01-30') + 1 AND hour_of_day = 9",
    "baseline_profile": "SELECT station_complex_id, hour_of_day, round(avg(avg_entries), 6) AS avg_entries FROM baseline WHERE weather_bucket = 'clear' GROUP BY ALL",
    "station_profile": f"SELECT hour_of_day, {_r('avg_entries')} FROM baseline WHERE weather_bucket = 'clear' AND station_complex_id = '7'",
    "forecast_delta": """
        SELECT station_complex_id, current_entries, next_entries, 23::INTEGER AS current_hour, 0::INTEGER AS next_hour, next_entries - current_entries AS delta
        FROM (SELECT station_complex_id, trunc(max(a) FILTER (hour_of_day = 23))::BIGINT AS current_entries,
                     trunc(max(a) FILTER (hour_of_day = 0))::BIGINT AS next_entries
              FROM (SELECT station_complex_id, hour_of_day, avg(avg_entries) AS a FROM baseline WHERE weather_bucket = 'clear' GROUP BY ALL)
              WHERE hour_of_day IN (23, 0) GROUP BY ALL)""",
    "station_directory": f"SELECT {DIRECTORY_COLUMNS} FROM directory",
    "route_list": "SELECT DISTINCT unnest(string_split(daytime_routes, ' ')) AS route FROM bridge WHERE station_complex_id IS NOT NULL ORDER BY route",
    "station_status_board": f"SELECT {BOARD_COLUMNS} FROM board",
    "filter_by_routes": f"SELECT {BOARD_COLUMNS} FROM board WHERE list_has_any(string_split(daytime_routes, ' '), ['R3', 'R5'])",
    "kpi_counts": """
        SELECT count(*) AS stations_monitored, count(*) FILTER (alert_level = 'SEVERE') AS severe,
               count(*) FILTER (alert_level = 'MODERATE') AS moderate, count(*) FILTER (alert_level = 'NORMAL') AS normal FROM latest""",
    "freshness": f"""
        SELECT last_inserted_at, age_secs, CASE WHEN age_secs < 60 THEN age_secs || 's ago'
               ELSE (age_secs // 60) || 'm ' || (age_secs % 60) || 's ago' END AS label, age_secs > 90 AS is_stale
        FROM (SELECT max(inserted_at) AS last_inserted_at, datesub('second', max(inserted_at), {AS_OF}) AS age_secs FROM latest)""",
    "escalations": f"""
        SELECT {SCORED_COLUMNS}, previous_level FROM (
            SELECT *, lag(alert_level) OVER (PARTITION BY station_complex_id ORDER BY event_timestamp, inserted_at, congestion_score) AS previous_level
            FROM scored) WHERE alert_level = 'SEVERE' AND previous_level IS DISTINCT FROM 'SEVERE'""",
    "severity_sorted": f"""
        SELECT station_complex_id, complex_name, alert_level,
               CASE alert_level WHEN 'SEVERE' THEN 0 WHEN 'MODERATE' THEN 1 WHEN 'NORMAL' THEN 2 ELSE 99 END::INTEGER AS severity_rank,
               {_r('congestion_score')}, {CROWDING.format('congestion_score')} AS crowding,
               {DELAY_LABEL.format('avg_arrival_delay_secs')} AS delay, {AGE.format('secs')} AS age, weather_bucket
        FROM (SELECT *, datesub('second', event_timestamp, {AS_OF}) AS secs FROM latest)""",
    "retention_filter": f"SELECT {SCORED_COLUMNS} FROM scored WHERE inserted_at >= {AS_OF} - INTERVAL 24 HOUR",
    # quality
    "calibrate_service": """
        SELECT row_count, p50, p95, greatest(30, p50) AS suggested_grace, greatest(240, p95) AS suggested_saturation,
               CASE WHEN abs(greatest(30, p50) - 60) / 60 < 0.15 AND abs(greatest(240, p95) - 300) / 300 < 0.15
                    THEN 'CONFIRMED' ELSE 'REVISED_CANDIDATE' END AS status
        FROM (SELECT count(*) AS row_count, quantile_disc(arrival_delay_secs, 0.5)::DOUBLE AS p50,
                     quantile_disc(arrival_delay_secs, 0.95)::DOUBLE AS p95 FROM delays)""",
    "audit_vehicles": """
        SELECT count(*) AS rows, count(DISTINCT station_complex_id) AS distinct_stations, count(DISTINCT route_id) AS distinct_routes,
               count(*) - count(station_complex_id) AS null_station_complex_id,
               round(100.0 * (count(*) - count(station_complex_id)) / count(*), 2) AS null_station_complex_id_pct,
               min(event_timestamp) AS earliest_event, max(event_timestamp) AS latest_event FROM vehicles""",
    "audit_delays": """
        SELECT count(*) AS rows, count(DISTINCT trip_id) AS distinct_trips, count(DISTINCT stop_id) AS distinct_stops,
               count(*) - count(arrival_delay_secs) AS null_arrival_delay_secs,
               round(100.0 * (count(*) - count(arrival_delay_secs)) / count(*), 2) AS null_arrival_delay_secs_pct,
               min(arrival_delay_secs) AS delay_min, max(arrival_delay_secs) AS delay_max, min(event_timestamp) AS earliest_event,
               max(event_timestamp) AS latest_event, trunc(quantile_cont(arrival_delay_secs, 0.5))::INTEGER AS delay_p50,
               trunc(quantile_cont(arrival_delay_secs, 0.95))::INTEGER AS delay_p95,
               trunc(quantile_cont(arrival_delay_secs, 0.99))::INTEGER AS delay_p99 FROM scheduled_delays""",
    "skew_ratio": """
        SELECT max(n) AS max_rows, trunc(median(n))::BIGINT AS median_rows, round(max(n) / trunc(median(n)), 2) AS skew_ratio
        FROM (SELECT count(*) AS n FROM scored GROUP BY station_complex_id)""",
    "top_stations": "SELECT l_partkey::VARCHAR AS station_complex_id, count(*) AS rows FROM lineitem GROUP BY 1 ORDER BY rows DESC, 1 LIMIT 20",
    "profile_columns": "SELECT * FROM ("
    + " UNION ALL ".join(
        [
            _profile("c_custkey", "c_custkey", "c_custkey::DOUBLE").replace(
                "SELECT 'c_custkey', count(*), count(*) - count(c_custkey)",
                "SELECT 'c_custkey' AS column_name, count(*) AS row_count, count(*) - count(c_custkey) AS null_count",
            ),
            _profile("c_name", "name", None),
            _profile("c_acctbal", "acctbal", "acctbal"),
            _profile("c_nationkey", "c_nationkey", None),
        ]
    )
    + ") AS t(column_name, row_count, null_count, numeric_min, numeric_max)",
    "profile_sample": """
        SELECT c_custkey::VARCHAR AS c_custkey, CASE WHEN c_custkey % 10 = 0 THEN '  ' ELSE c_name END AS c_name,
               CASE WHEN c_custkey % 7 > 0 THEN ' ' || c_acctbal::VARCHAR END AS c_acctbal,
               CASE WHEN c_custkey % 50 = 3 THEN 'n/a' ELSE c_nationkey::VARCHAR END AS c_nationkey
        FROM customer ORDER BY c_custkey::VARCHAR LIMIT 5""",
    "backtest_thresholds": """
        SELECT 'order-' || o_orderkey AS event_name, (o_custkey % 20)::VARCHAR AS station_complex_id, d::VARCHAR AS avg_arrival_delay_secs,
               e::VARCHAR AS avg_entries, m::VARCHAR AS max_hourly_entries, expected_level, round(deficit, 4) AS service_deficit,
               round(demand, 4) AS demand_intensity, round(deficit * demand, 4) AS congestion_score, level AS alert_level,
               expected_level = '' OR expected_level = level AS passes_expected
        FROM (SELECT *, CASE WHEN deficit * demand >= 0.5 THEN 'SEVERE' WHEN deficit * demand >= 0.2 THEN 'MODERATE' ELSE 'NORMAL' END AS level
              FROM (SELECT *, least(1, greatest(0, (d::DOUBLE - 60) / 240)) AS deficit,
                           CASE WHEN m > 0 THEN least(1, e::DOUBLE / m) ELSE 0 END AS demand
                    FROM (SELECT *, floor(o_totalprice)::BIGINT % 600 AS d, o_custkey % 101 AS e, CASE WHEN o_custkey % 9 = 0 THEN 0 ELSE 97 END AS m,
                                 CASE o_orderpriority[1] WHEN '1' THEN 'SEVERE' WHEN '2' THEN 'MODERATE' WHEN '5' THEN 'NORMAL' ELSE '' END AS expected_level
                          FROM orders)))""",
    # streams
    "stream_interval_join": f"SELECT {PAIR_COLUMNS} FROM pairs",
    "stream_delay_signal": SIGNAL_QUERY,
    "stream_score_foreachbatch": SCORE_QUERY,
    "stream_late_data": """
        SELECT window_start, (n * CASE WHEN epoch_ms(window_start) + 10000 > epoch_ms((SELECT max(ts) FROM events)) - 30000
               THEN 3 ELSE 2 END)::BIGINT AS msg_count
        FROM (SELECT make_timestamp(epoch_us(ts) // 10000000 * 10000000) AS window_start, count(*) AS n FROM events GROUP BY ALL)""",
    "stream_late_rows": """
        SELECT window_start, n AS late_count
        FROM (SELECT make_timestamp(epoch_us(ts) // 10000000 * 10000000) AS window_start, count(*) AS n FROM events GROUP BY ALL)
        WHERE epoch_ms(window_start) + 10000 <= epoch_ms((SELECT max(ts) FROM events)) - 30000""",
    "stream_escalations": f"""
        SELECT {SCORED_COLUMNS}, (2 - rn)::BIGINT AS batch_id FROM (
            SELECT *, row_number() OVER w AS rn, lead(alert_level) OVER w AS previous_level FROM scored
            WINDOW w AS (PARTITION BY station_complex_id ORDER BY event_timestamp DESC, inserted_at DESC, congestion_score DESC))
        WHERE rn <= 2 AND alert_level = 'SEVERE' AND (rn = 2 OR previous_level IS DISTINCT FROM 'SEVERE')""",
    "stream_tumbling_count": "SELECT make_timestamp(epoch_us(ts) // 10000000 * 10000000) AS window_start, count(*) AS msg_count FROM events GROUP BY ALL",
    "upsert_latest": f"SELECT {CONDITION_COLUMNS} FROM (SELECT *, row_number() OVER (PARTITION BY scope ORDER BY updated_at DESC) AS rn FROM conditions) WHERE rn = 1",
}

# Queries with the answer of another one.
for _name, _other in (
    ("stream_escalations_state", "escalations"),
    ("baseline_incremental", "capacity_baseline"),
    ("station_max_incremental", "station_max"),
    ("audit_vehicles_incremental", "audit_vehicles"),
    ("incremental_page", "incremental_extract"),
    ("station_profile_lookup", "station_profile"),
    ("busiest_parts", "top_stations"),
):
    _SELECTS[_name] = _SELECTS[_other]

ORACLE_SQL: dict[str, str] = {name: _with(select) for name, select in _SELECTS.items()}
