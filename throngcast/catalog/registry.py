"""Every registered query: ``(spark, sf_dir) -> DataFrame`` over the whole test tables.

Doubles are rounded to six places here, and only here, because sums taken in another
order may differ in the last bit.
"""

from __future__ import annotations

from collections.abc import Callable
from functools import wraps

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from throngcast.catalog import adapters as A
from throngcast.functions import geo, scoring, text, times, weather
from throngcast.operators import sets
from throngcast.operators.dedupe import first_by_key
from throngcast.operators.heavy import busiest_keys
from throngcast.operators.history import forward_fill
from throngcast.operators.profile import profile_columns, sample_rows
from throngcast.operators.sliding import sliding_average
from throngcast.plans import baseline as B
from throngcast.plans import incremental, ingest, live, quality, ridership, schedule, serving
from throngcast.plans import scoring as scores
from throngcast.plans import signal as signals
from throngcast.plans import weather as daily_weather
from throngcast.plans.bridge import Bridge, bridge_summary
from throngcast.schemas import CAPACITY_BASELINE, SCORED
from throngcast.session import configure, scratch_path
from throngcast.sources import files, lookup, paging, readers, writers
from throngcast.sources.columns import HeaderLookup
from throngcast.streaming import jobs, late
from throngcast.streaming.runner import ONCE_THROUGH, state_partitions, to_parquet

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Parameters shared with the SQL counterparts.
AS_OF = "2024-01-31 00:05:00"
INSERTED_AT = "2024-02-01 00:00:00"
WEATHER_SCALE = 1 / 2000
LOOKBACK_DAYS = 20
STATION = "7"
STATE_WIDTH = 8
FILES_A_TRIGGER = 24
SELECTED_ROUTES = ("R3", "R5")


def as_of(moment: str = AS_OF) -> Column:
    return F.lit(moment).cast("timestamp")


def query(build: Query, name: str | None = None) -> Query:
    """Register a function under its own name or the given one."""

    @wraps(build)
    def run(spark: SparkSession, sf_dir: str) -> DataFrame:
        df = build(configure(spark), sf_dir)
        doubles = {name: F.round(F.col(name), 6) for name, dtype in df.dtypes if dtype == "double"}
        return df.withColumns(doubles) if doubles else df

    QUERIES[name or build.__name__] = run
    return build


# --- shared inputs -----------------------------------------------------------


def _stored(spark, df, name):
    """The frame written to a shared table, for plans that read it several times."""
    path = scratch_path(spark, name)
    writers.write_parquet(df, path)
    return readers.read_table(spark, path, df.schema)


def _ridership(spark, d):
    return ridership.clean_ridership(A.raw_ridership(A.events(spark, d)))


def _weather(spark, d):
    return daily_weather.clean_weather(
        A.long_weather(A.events(spark, d)), prcp_scale=WEATHER_SCALE, snow_scale=WEATHER_SCALE
    )


def _joined(spark, d):
    return ridership.join_weather(_ridership(spark, d), _weather(spark, d))


def _newest_day(spark, d):
    """Newest ridership date, taken before the aggregation that leaves it unchanged."""
    typed = ridership.typed_ridership(A.raw_ridership(A.events(spark, d)))
    return typed.agg(F.to_date(F.max("transit_timestamp")).alias("date"))


def _baseline(spark, d):
    """Baseline and maxima over the stored join, as the batch layer hands it on."""
    joined = _stored(spark, _joined(spark, d), "ridership-weather")
    return B.build_baseline(joined, lookback_days=LOOKBACK_DAYS)


def _bridge(spark, d):
    return A.bridge(A.table(spark, d, "supplier"))


def _cascade(spark, d):
    part = A.table(spark, d, "part")
    return Bridge.of(A.raw_stations(part), A.raw_stops(part))


def _schedule(spark, d):
    return schedule.schedule_full(A.stop_times(A.table(spark, d, "lineitem")))


def _vehicles(spark, d):
    parsed = live.parse_vehicles(A.vehicle_messages(A.events(spark, d)))
    return live.enrich_vehicles(parsed, _bridge(spark, d))


def _delays_of(messages, spark, d):
    full = _schedule(spark, d)
    return live.trip_delays(
        live.parse_trip_updates(messages), schedule.unique_schedule(full), schedule.schedule_by_prefix(full)
    )


def _announced(spark, d):
    """Delays of the live feed; every message announces its delay, so no schedule is looked up."""
    return live.trip_delays(live.parse_trip_updates(A.delay_messages(A.events(spark, d))))


def _signal(spark, d):
    return signals.delay_signal(_vehicles(spark, d), _announced(spark, d))


def _scored(spark, d):
    return A.scored_history(A.events(spark, d))


# --- sources and sinks -------------------------------------------------------


@query
def scan_partitioned(spark, d):
    path = scratch_path(spark, "partitioned")
    writers.write_parquet(_vehicles(spark, d), path, partition_by=["event_date"])
    staged = readers.read_table(spark, path)
    return staged.where(F.col("event_date") >= F.lit("2024-01-10").cast("date")).groupBy("event_date").agg(
        F.count(F.lit(1)).alias("rows"), F.count("station_complex_id").alias("resolved_rows")
    )


@query
def scan_csv_union(spark, d):
    """CSV files with different headers, written from the customers and united by name."""
    source, folder = A.table(spark, d, "customer"), scratch_path(spark, "csv")
    low = source.where("c_custkey % 2 = 0").select("c_custkey", "c_name", "c_mktsegment")
    high = source.where("c_custkey % 2 = 1").select("c_nationkey", "c_custkey", "c_name")
    for name, part in (("low", low), ("high", high)):
        part.write.csv(f"{folder}/{name}", header=True)
    return readers.read_csv_files(spark, [f"{folder}/low", f"{folder}/high"])


@query
def sink_partitioned_roundtrip(spark, d):
    path = scratch_path(spark, "ridership")
    writers.write_parquet(_ridership(spark, d), path, partition_by=["date"])
    return readers.read_table(spark, path).select(_ridership(spark, d).columns)


@query
def baseline_bulk_load(spark, d):
    path = scratch_path(spark, "baseline")
    cells, _ = _baseline(spark, d)
    loose = cells.withColumns({name: F.col(name).cast("string") for name in ("day_of_week", "hour_of_day")})
    writers.write_parquet(loose, path)
    return readers.load_baseline(spark, path)


@query
def incremental_extract(spark, d):
    return readers.incremental_extract(
        A.events(spark, d),
        ["ts", "event_id", "user_id", "value"],
        ["ts", "event_id"],
        since="2024-01-15 00:00:00",
        limit=500,
        offset=100,
    )


@query
def route_messages(spark, d):
    sent = ingest.fan_out(ingest.parse_frames(A.feed_frames(A.events(spark, d))))
    return sent.select(
        "key",
        "topic",
        "partition",
        F.get_json_object("value", "$.entity_id").alias("entity_id"),
        F.get_json_object("value", "$.route_id").alias("route_id"),
        F.get_json_object("value", "$.feed_timestamp").alias("feed_timestamp"),
    )


@query
def dead_letters(spark, d):
    rejected = ingest.dead_letters(ingest.parse_frames(A.feed_frames(A.events(spark, d), malformed=True)))
    return rejected.select(
        "key",
        "topic",
        *[F.get_json_object("value", f"$.{name}").alias(name) for name in ("feed", "error", "raw_b64")],
        F.get_json_object("value", "$.received_at").cast("bigint").alias("received_at"),
    )


@query
def topic_offsets(spark, d):
    return quality.topic_offsets(A.message_log(A.events(spark, d)))


@query
def topic_totals(spark, d):
    return quality.topic_totals(A.message_log(A.events(spark, d)), A.topic_baseline(A.table(spark, d, "region")))


@query
def topic_throughput(spark, d):
    window = F.window("timestamp", "60 seconds")
    counts = A.message_log(A.events(spark, d)).groupBy(window.alias("w"), "topic").agg(
        F.count(F.lit(1)).alias("msgs_per_min")
    )
    return counts.select(F.col("w.start").alias("window_start"), "topic", "msgs_per_min")


# --- projections and scalar rules --------------------------------------------


@query
def resolve_columns(spark, d):
    stations = A.raw_stations(A.table(spark, d, "part"))
    named = HeaderLookup(stations)
    return stations.select(
        named.need("gtfs_stop_id").alias("stop_id"),
        named.need("station complex id", "complex id").alias("complex_id"),
        named.need("DAYTIME-ROUTES").alias("routes"),
        named.want("string", "Borough").alias("borough"),
    )


@query
def normalize_stop_ids(spark, d):
    return A.raw_stops(A.table(spark, d, "part")).select(
        "stop_id",
        text.normalize_stop_id(F.col("stop_id")).alias("normalized"),
        text.stop_base_id(F.col("stop_id")).alias("untrimmed_base"),
        text.normalize_stop_id(F.lit(None).cast("string")).alias("of_null"),
    )


@query
def normalize_names(spark, d):
    raw = A.table(spark, d, "customer").selectExpr("concat('  ', c_name, ' & ', c_mktsegment, '-42  St. ') AS name")
    return raw.select("name", text.normalize_station_name(F.col("name")).alias("normalized"))


@query
def haversine(spark, d):
    points = A.table(spark, d, "customer").selectExpr(
        "c_custkey",
        "CAST(c_custkey % 170 - 85 AS DOUBLE) AS lat1",
        "CAST(c_custkey % 340 - 170 AS DOUBLE) AS lon1",
        "c_acctbal / 200 AS lat2",
        "CASE WHEN c_custkey % 11 > 0 THEN c_acctbal / 100 END AS lon2",
    )
    # the opposite point of each first one
    opposite = points.selectExpr("-c_custkey AS c_custkey", "lat1", "lon1", "-lat1 AS lat2", "lon1 + 180 AS lon2")
    return points.unionByName(opposite).select("c_custkey", (geo.haversine_meters(*map(F.col, ("lat1", "lon1", "lat2", "lon2"))) / 1000).alias("km"))


@query
def weather_bucket(spark, d):
    measures = A.events(spark, d).selectExpr(
        "event_id",
        "CASE WHEN event_id % 5 > 0 THEN value / 500 END AS prcp_in",
        "CASE WHEN event_id % 3 = 0 THEN value / 700 END AS snow_in",
    )
    return measures.withColumn("bucket", weather.weather_bucket(F.col("prcp_in"), F.col("snow_in")))


@query
def clamp_scores(spark, d):
    values = A.events(spark, d).selectExpr("event_id", "CASE WHEN event_id % 7 > 0 THEN value / 50 - 0.5D END AS raw")
    return values.select(
        "event_id",
        scoring.clamp(F.col("raw")).alias("unit"),
        scoring.clamp(F.col("raw"), 0.25, 0.75).alias("narrow"),
        scoring.marker_radius(F.col("raw")).alias("radius"),
        scoring.service_deficit(F.col("raw") * 300).alias("deficit"),
    )


@query
def parse_timestamps(spark, d):
    layouts = {n: f'date_format(ts, "{layout}")' for n, layout in enumerate(times.TIMESTAMP_FORMATS)}
    cases = " ".join(f"WHEN {n} THEN {layout}" for n, layout in layouts.items())
    raw = A.events(spark, d).selectExpr(
        "event_id", f"CASE event_id % 7 {cases} WHEN 5 THEN date_format(ts, 'yyyy-MM-dd') ELSE 'not a time' END AS raw"
    )
    parsed = times.parse_timestamp(F.col("raw"))
    return raw.select(
        "event_id", parsed.alias("parsed"), F.to_utc_timestamp(parsed, times.LOCAL_TIMEZONE).alias("parsed_utc")
    )


@query
def parse_iso(spark, d):
    raw = A.events(spark, d).selectExpr(
        "event_id",
        "CASE event_id % 5 WHEN 0 THEN date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'Z'\") "
        "WHEN 1 THEN date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss'+02:00'\") "
        "WHEN 2 THEN date_format(ts, \"yyyy-MM-dd'T'HH:mm:ss\") WHEN 3 THEN '' END AS raw",
    )
    return raw.select("event_id", times.parse_iso(F.col("raw")).alias("parsed"))


@query
def calendar_parts(spark, d):
    dated = ridership.with_calendar(A.events(spark, d).select("event_id", "ts"), "ts")
    local = ridership.with_calendar(dated.select("*", F.col("ts").alias("t")), "t", calendar_tz=times.LOCAL_TIMEZONE)
    return dated.join(
        local.select(
            "event_id",
            F.col("date").alias("local_date"),
            F.col("hour_of_day").alias("local_hour"),
            F.col("day_of_week").alias("local_day"),
        ),
        "event_id",
    ).drop("ts")


@query
def trip_prefix(spark, d):
    trips = A.stop_times(A.table(spark, d, "lineitem")).select(
        text.realtime_trip_id(F.col("trip_id")).alias("trip_id")
    ).distinct()
    return trips.select(
        "trip_id",
        text.trip_prefix(F.col("trip_id")).alias("prefix"),
        text.schedule_prefix(F.col("trip_id")).alias("static_prefix"),
        text.trip_prefix(F.upper(F.replace("trip_id", F.lit(".."), F.lit("--")))).alias("no_prefix"),
    )


@query
def classify_observation(spark, d):
    return ingest.classify_observations(A.observations(A.events(spark, d)))


@query
def age_labels(spark, d):
    moment = F.col("event_timestamp")
    recent = as_of("2024-01-30 23:59:59")
    return _scored(spark, d).select(
        "station_complex_id",
        "event_timestamp",
        times.age_label(moment, recent).alias("age"),
        times.freshness_label(times.age_seconds(moment, recent)).alias("freshness"),
        times.iso_string(moment).alias("iso"),
    )


# --- ridership, weather, baseline --------------------------------------------


@query
def clean_ridership(spark, d):
    return _ridership(spark, d)


@query
def weather_pivot(spark, d):
    return daily_weather.pivot_measures(daily_weather.long_reports(A.long_weather(A.events(spark, d))))


@query
def weather_daily(spark, d):
    return daily_weather.daily_measures(daily_weather.wide_reports(A.wide_weather(A.events(spark, d))))


@query
def weather_multi_station(spark, d):
    return daily_weather.merge_station_reports(daily_weather.long_reports(A.long_weather(A.events(spark, d))))


@query
def weather_forward_fill(spark, d):
    wide = daily_weather.daily_measures(daily_weather.wide_reports(A.wide_weather(A.events(spark, d))))
    return forward_fill(wide.select("date", "tmax_raw", "tmin_raw"), ["tmax_raw", "tmin_raw"], "date")


@query
def clean_weather(spark, d):
    return _weather(spark, d)


@query
def clean_weather_wide(spark, d):
    return daily_weather.clean_weather(
        A.wide_weather(A.events(spark, d)), prcp_scale=WEATHER_SCALE, snow_scale=WEATHER_SCALE
    )


@query
def join_weather(spark, d):
    return ridership.join_weather(_ridership(spark, d), _weather(spark, d))


@query
def bridge_validate(spark, d):
    return ridership.validate_against_bridge(_ridership(spark, d), _bridge(spark, d))


@query
def lookback_filter(spark, d):
    return B.lookback(_ridership(spark, d), 7, latest=_newest_day(spark, d))


@query
def capacity_baseline(spark, d):
    return _baseline(spark, d)[0]


@query
def station_max(spark, d):
    return _baseline(spark, d)[1]


@query
def weather_coefficients(spark, d):
    return B.weather_coefficients(_joined(spark, d))


@query
def bucket_counts(spark, d):
    days = quality.bucket_counts(_weather(spark, d), "weather_bucket").select(
        F.lit("weather_bucket").alias("counted"), F.col("weather_bucket").alias("value"), "rows"
    )
    flags = quality.bucket_counts(bridge_validate(spark, d), "bridge_resolved").select(
        F.lit("bridge_resolved").alias("counted"), F.col("bridge_resolved").cast("string").alias("value"), "rows"
    )
    return days.unionByName(flags)


# --- bridge and schedule -----------------------------------------------------


@query
def bridge_tier1(spark, d):
    return _cascade(spark, d).direct()


@query
def bridge_tier2_name(spark, d):
    return _cascade(spark, d).by_name()


@query
def bridge_tier3_geo(spark, d):
    return _cascade(spark, d).by_place()


@query
def bridge_unresolved(spark, d):
    return _cascade(spark, d).unresolved()


@query
def matched_keys(spark, d):
    return _cascade(spark, d).matched_keys()


@query
def stop_keys_union(spark, d):
    """Keys of stops and of listed stations, once each."""
    cascade = _cascade(spark, d)
    return sets.union_distinct(cascade.stops.select("gtfs_stop_id"), cascade.seed.select("gtfs_stop_id"))


@query
def stop_keys_unlisted(spark, d):
    """Stops that no station lists."""
    cascade = _cascade(spark, d)
    return sets.missing_from(cascade.stops.select("gtfs_stop_id", "stop_name"), cascade.seed, ["gtfs_stop_id"])


@query
def bridge_tiered(spark, d):
    return _cascade(spark, d).table()


query(lambda spark, d: bridge_summary(_cascade(spark, d).table()), "bridge_summary")


@query
def schedule_full(spark, d):
    return _schedule(spark, d)


@query
def schedule_prefix(spark, d):
    return schedule.schedule_by_prefix(_schedule(spark, d))


@query
def dedupe_by_key(spark, d):
    return schedule.unique_schedule(_schedule(spark, d))


@query
def first_whole_row(spark, d):
    """Whole-row choice per key under a total order."""
    items = A.table(spark, d, "lineitem").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")
    return first_by_key(items, ["l_orderkey", "l_linenumber"], ["l_partkey"])


# --- live path ---------------------------------------------------------------


@query
def enrich_vehicles(spark, d):
    return _vehicles(spark, d)


@query
def parse_trip_updates(spark, d):
    return live.parse_trip_updates(A.trip_messages(A.table(spark, d, "lineitem"), malformed=True))


@query
def trip_delays(spark, d):
    return _delays_of(A.trip_messages(A.table(spark, d, "lineitem")), spark, d)


@query
def interval_join(spark, d):
    return signals.vehicle_delay_pairs(_vehicles(spark, d), _announced(spark, d))


@query
def sliding_delay_avg(spark, d):
    rows = A.events(spark, d).select(
        (F.col("user_id") % 20).cast("string").alias("station_complex_id"), "ts", "value"
    )
    return sliding_average(
        rows, ["station_complex_id"], "ts", F.col("value"), F.lit(1), value_column="avg_arrival_delay_secs"
    )


@query
def delay_signal(spark, d):
    return _signal(spark, d)


@query
def score_congestion(spark, d):
    cells, maxima = _baseline(spark, d)
    return scores.score(
        _signal(spark, d), cells, maxima, _bridge(spark, d), weather_bucket="clear", inserted_at=as_of(INSERTED_AT)
    )


@query
def score_with_current_condition(spark, d):
    cells, maxima = _baseline(spark, d)
    conditions = ingest.classify_observations(A.observations(A.events(spark, d)))
    bucket = scores.current_bucket(conditions, as_of("2024-01-31 00:00:00")).select("weather_bucket")
    return scores.score(
        _signal(spark, d),
        cells,
        maxima,
        _bridge(spark, d),
        weather_bucket=bucket.scalar(),
        inserted_at=as_of(INSERTED_AT),
        with_flags=True,
    )


@query
def current_bucket(spark, d):
    conditions = ingest.classify_observations(A.observations(A.events(spark, d)))
    fresh = scores.current_bucket(conditions, as_of("2024-01-31 00:00:00")).select(
        F.lit("fresh").alias("state"), "scope", "weather_bucket"
    )
    stale = scores.current_bucket(conditions, as_of("2024-02-03 00:00:00")).select(
        F.lit("stale").alias("state"), "scope", "weather_bucket"
    )
    absent = scores.current_bucket(conditions, as_of(), scope="elsewhere").select(
        F.lit("absent").alias("state"), "scope", "weather_bucket"
    )
    return fresh.unionByName(stale).unionByName(absent)


# --- serving -----------------------------------------------------------------


@query
def latest_per_station(spark, d):
    return serving.latest_per_station(_scored(spark, d))


@query
def alerts(spark, d):
    return serving.alerts(_scored(spark, d))


@query
def station_current(spark, d):
    return serving.serialized(serving.station_current(_scored(spark, d), STATION))


@query
def station_history(spark, d):
    return serving.station_history(_scored(spark, d), STATION, as_of(), hours=48)


@query
def forecast_next_hour(spark, d):
    return serving.forecast_next_hour(_baseline(spark, d)[0], as_of("2024-01-30 08:15:00"))


@query
def baseline_profile(spark, d):
    return serving.hourly_profile(_baseline(spark, d)[0])


@query
def station_profile(spark, d):
    return serving.station_profile(_baseline(spark, d)[0], STATION)


@query
def forecast_delta(spark, d):
    return serving.forecast_delta(_baseline(spark, d)[0], as_of("2024-01-30 23:15:00"))


@query
def station_directory(spark, d):
    return serving.station_directory(_bridge(spark, d))


@query
def route_list(spark, d):
    return serving.route_list(serving.station_directory(_bridge(spark, d)))


def _board(spark, d):
    newest = serving.latest_per_station(_scored(spark, d))
    return serving.station_status_board(serving.station_directory(_bridge(spark, d)), newest)


@query
def station_status_board(spark, d):
    return _board(spark, d)


@query
def filter_by_routes(spark, d):
    return serving.filter_by_routes(_board(spark, d), SELECTED_ROUTES)


@query
def kpi_counts(spark, d):
    return serving.kpi_counts(serving.latest_per_station(_scored(spark, d)))


@query
def freshness(spark, d):
    return serving.freshness(serving.latest_per_station(_scored(spark, d)), as_of())


@query
def escalations(spark, d):
    return serving.escalations(_scored(spark, d))


@query
def severity_sorted(spark, d):
    return serving.severity_sorted(serving.latest_per_station(_scored(spark, d)), as_of())


@query
def retention_filter(spark, d):
    return writers.within_retention(_scored(spark, d), as_of())


# --- quality -----------------------------------------------------------------


@query
def calibrate_service(spark, d):
    return quality.calibrate_service(_stored(spark, _announced(spark, d), "delays"))


@query
def audit_vehicles(spark, d):
    return quality.audit_vehicles(_stored(spark, _vehicles(spark, d), "vehicles"))


@query
def audit_delays(spark, d):
    staged = _stored(spark, _delays_of(A.trip_messages(A.table(spark, d, "lineitem")), spark, d), "delays")
    return quality.audit_delays(staged)


@query
def skew_ratio(spark, d):
    return quality.skew_ratio(_scored(spark, d))


@query
def top_stations(spark, d):
    by_part = A.table(spark, d, "lineitem").select(F.col("l_partkey").cast("string").alias("station_complex_id"))
    return quality.top_stations(by_part)


query(lambda spark, d: profile_columns(A.profile_input(A.table(spark, d, "customer"))), "profile_columns")


@query
def profile_sample(spark, d):
    return sample_rows(A.profile_input(A.table(spark, d, "customer")), 5, ["c_custkey"])


@query
def backtest_thresholds(spark, d):
    return quality.backtest_thresholds(A.labelled_events(A.table(spark, d, "orders")))


# --- states that merge, pages ------------------------------------------------


@query
def baseline_incremental(spark, d):
    """Baseline from states per day: all days but the newest written first, then that one added."""
    table, states = scratch_path(spark, "ridership-by-date"), scratch_path(spark, "baseline-states")
    writers.write_parquet(_joined(spark, d), table, partition_by=["date"])
    stored = readers.read_table(spark, table)
    newest = stored.agg(F.max("date")).first()[0]
    incremental.add_baseline_days(stored.where(F.col("date") < F.lit(newest)), states)
    if newest is not None:
        incremental.add_baseline_days(stored, states, days=[str(newest)])
    return incremental.baseline_from_states(readers.read_table(spark, states), lookback_days=LOOKBACK_DAYS)[0]


@query
def station_max_incremental(spark, d):
    states = scratch_path(spark, "baseline-states")
    incremental.add_baseline_days(_joined(spark, d), states)
    return incremental.baseline_from_states(readers.read_table(spark, states), lookback_days=LOOKBACK_DAYS)[1]


@query
def audit_vehicles_incremental(spark, d):
    """The audit from one row per day; distinct counts are estimates, exact for as few values as here."""
    states = scratch_path(spark, "vehicle-audit")
    incremental.add_audit_days(_vehicles(spark, d), states, ["station_complex_id", "route_id"])
    return incremental.audit_vehicles_from_states(incremental.read_states(spark, states))


@query
def incremental_page(spark, d):
    """The page of ``incremental_extract`` from files in order."""
    path, order = scratch_path(spark, "events-in-order"), ["ts", "event_id"]
    paging.write_clustered(A.events(spark, d), path, order, files=16)
    return paging.read_page(
        spark, path, ["ts", "event_id", "user_id", "value"], order, since="2024-01-15 00:00:00", limit=500, offset=100
    )


def _cells_of_station(spark, d) -> DataFrame:
    """The baseline laid out by station, and the cells of one read from its bucket."""
    path = scratch_path(spark, "baseline-by-station")
    lookup.publish_lookup(_baseline(spark, d)[0], path, "station_complex_id", buckets=16)
    return lookup.find_keys(spark, path, CAPACITY_BASELINE, "station_complex_id", [STATION])


@query
def forecast_lookup(spark, d):
    return serving.forecast_next_hour(_cells_of_station(spark, d), as_of("2024-01-30 08:15:00"), station=STATION)


@query
def station_profile_lookup(spark, d):
    return serving.station_profile(_cells_of_station(spark, d), STATION)


@query
def busiest_parts(spark, d):
    by_part = A.table(spark, d, "lineitem").select(F.col("l_partkey").cast("string").alias("station_complex_id"))
    return busiest_keys(by_part)


# --- streams -----------------------------------------------------------------


def _staged(spark, d) -> tuple[str, str]:
    """Run the two staging streams over the event table and return their folders.

    The feed ends with one far-future message per topic, so that every real window
    passes the watermark.
    """
    closing = A.closing_messages(A.events(spark, d))
    running, folders = [], []
    for name, messages in (("vehicles", A.vehicle_messages), ("delays", A.delay_messages)):
        tail, out = scratch_path(spark, f"end-of-{name}"), scratch_path(spark, name)
        writers.write_parquet(closing[name], tail)
        feed = messages(A.events_stream(spark, d)).unionByName(
            readers.file_stream(spark, tail, closing[name].schema)
        )
        if name == "vehicles":
            start = jobs.stage_vehicles(feed, _bridge(spark, d), out, f"{out}-checkpoint", trigger=ONCE_THROUGH)
        else:
            start = jobs.stage_trip_delays(feed, None, None, out, f"{out}-checkpoint", trigger=ONCE_THROUGH)
        running.append(start)
        folders.append(out)
    for stream in running:
        stream.awaitTermination()
    return folders[0], folders[1]


def _signal_stream(spark, d) -> str:
    """Run the whole speed path as streams and return the folder of the signal."""
    vehicles, delays = _staged(spark, d)
    out = scratch_path(spark, "signal")
    with state_partitions(spark, STATE_WIDTH):
        # one trigger reads the whole feed
        jobs.stage_delay_signal(
            spark, vehicles, delays, out, f"{out}-checkpoint", trigger=ONCE_THROUGH, slots=True
        ).awaitTermination()
    return out


@query
def stream_interval_join(spark, d):
    vehicles, delays = _staged(spark, d)
    pairs = signals.delay_pairs_stream(
        readers.file_stream(spark, vehicles, jobs.VEHICLE_POSITIONS),
        readers.file_stream(spark, delays, jobs.TRIP_DELAYS),
        slots=True,
    )
    out = scratch_path(spark, "pairs")
    with state_partitions(spark, STATE_WIDTH):
        to_parquet(pairs, out, f"{out}-checkpoint", trigger=ONCE_THROUGH).awaitTermination()
    return spark.read.schema(pairs.schema).parquet(out)


@query
def stream_delay_signal(spark, d):
    return spark.read.schema(jobs.DELAY_SIGNAL).parquet(_signal_stream(spark, d))


@query
def stream_score_foreachbatch(spark, d):
    staged = _signal_stream(spark, d)
    tables = {name: scratch_path(spark, name) for name in ("baseline", "station_max")}
    for path, df in zip(tables.values(), _baseline(spark, d)):
        writers.write_parquet(df, path)

    def load_views(session):
        return (*readers.load_batch_views(session, tables["baseline"], tables["station_max"]), _bridge(session, d))

    out = scratch_path(spark, "scored")
    jobs.score_signal(
        readers.file_stream(spark, staged, jobs.DELAY_SIGNAL),
        load_views,
        out,
        f"{out}-checkpoint",
        weather_bucket=lambda session: "clear",
        inserted_at=as_of(INSERTED_AT),
        trigger=ONCE_THROUGH,
    ).awaitTermination()
    return writers.keyed_view(spark, out, SCORED, ["station_complex_id", "event_timestamp"])


@query
def stream_tumbling_count(spark, d):
    out = scratch_path(spark, "counts")
    with state_partitions(spark, STATE_WIDTH):
        counts = jobs.windowed_counts(A.events_stream(spark, d), "ts")
        jobs.keep_counts(counts, out, f"{out}-checkpoint", trigger=ONCE_THROUGH).awaitTermination()
    return jobs.current_counts(spark, out).select(F.col("start").alias("window_start"), "msg_count")


@query
def upsert_latest(spark, d):
    out = scratch_path(spark, "conditions")
    conditions = ingest.classify_observations(A.observations(A.events_stream(spark, d)))
    jobs.upsert_conditions(conditions, out, f"{out}-checkpoint", trigger=ONCE_THROUGH).awaitTermination()
    return jobs.current_conditions(spark, out)


def _files_in_turn(spark, name, *parts: DataFrame) -> DataFrame:
    """A stream over the given frames in order, a trigger each.

    Triggers take files by age, so every frame is written as the same number of files: in parallel,
    and filled up with empty ones where it has fewer rows.
    """
    path = scratch_path(spark, name)
    for number, part in enumerate(parts, 1):
        part.repartition(FILES_A_TRIGGER).write.mode("append").parquet(path)
        while len(files.data_files(spark, path)) < number * FILES_A_TRIGGER:
            part.limit(0).coalesce(1).write.mode("append").parquet(path)
    return readers.file_stream(spark, path, parts[0].schema, max_files_per_trigger=FILES_A_TRIGGER)


@query
def stream_late_data(spark, d):
    """All events three times over: rows of windows that the watermark has passed are dropped.

    A trigger drops by the watermark it was planned with, which the first one has not moved yet,
    so the second copy still counts and the third does not but for the open windows.
    """
    events = A.events(spark, d).select("ts")
    feed = _files_in_turn(spark, "late-events", events, events, events)
    out = scratch_path(spark, "late-counts")
    with state_partitions(spark, STATE_WIDTH):
        counts = jobs.windowed_counts(feed, "ts")
        jobs.keep_counts(counts, out, f"{out}-checkpoint", trigger=ONCE_THROUGH).awaitTermination()
    return jobs.current_counts(spark, out).select(F.col("start").alias("window_start"), "msg_count")


@query
def stream_late_rows(spark, d):
    """Per window, the rows that ``stream_late_data`` drops from the same feed."""
    events = A.events(spark, d).select("ts")
    feed = _files_in_turn(spark, "late-events", events, events, events)
    out = scratch_path(spark, "late-rows")
    late.mark_late(feed, "ts", out, f"{out}-checkpoint", trigger=ONCE_THROUGH).awaitTermination()
    window = F.window("ts", "10 seconds").alias("window")
    dropped = late.late_rows(spark, out, events.schema).groupBy(window).agg(F.count(F.lit(1)).alias("late_count"))
    return dropped.select(F.col("window.start").alias("window_start"), "late_count")


@query
def stream_escalations(spark, d):
    """Live escalations: the history up to each station's last row but one, then the last rows."""
    scored = _scored(spark, d)
    keys = ["station_complex_id", *serving.RECENCY, "congestion_score"]
    newest = serving.latest_per_station(scored).select(*keys, F.lit(True).alias("newest"))
    flagged = scored.join(newest, keys, "left").select(*SCORED.fieldNames(), "newest")
    rows = (flagged.where(F.col("newest").isNull()).drop("newest"), flagged.where("newest").drop("newest"))
    state, out = scratch_path(spark, "station-state"), scratch_path(spark, "escalations")
    feed = _files_in_turn(spark, "scored", *rows)
    jobs.watch_escalations(feed, state, out, f"{out}-checkpoint", trigger=ONCE_THROUGH).awaitTermination()
    return writers.batch_table(spark, out, SCORED)


@query
def stream_escalations_state(spark, d):
    """All changes to SEVERE by keyed state; a row two days later moves the watermark past the rest."""
    closing, out = scratch_path(spark, "end-of-scored"), scratch_path(spark, "escalations")
    last = A.events(spark, d).agg((F.max("ts") + F.expr("INTERVAL 2 DAYS")).alias("event_timestamp"))
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in SCORED if f.name != "event_timestamp"]
    writers.write_parquet(last.select("event_timestamp", *missing).fillna({"station_complex_id": "end"}).select(SCORED.fieldNames()), closing)
    feed = A.scored_history(A.events_stream(spark, d)).unionByName(readers.file_stream(spark, closing, SCORED))
    with state_partitions(spark, STATE_WIDTH):
        jobs.track_escalations(feed, out, f"{out}-checkpoint", trigger=ONCE_THROUGH).awaitTermination()
    return spark.read.schema(T.StructType([*SCORED.fields, T.StructField("previous_level", T.StringType())])).parquet(out)
