from __future__ import annotations

import json
from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from throngcast.catalog import adapters as A
from throngcast.catalog.registry import QUERIES
from throngcast.plans import baseline, bridge, ingest, live, quality, ridership, schedule, scoring, serving, signal, weather
from tests.conftest import SF_DIR


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


# --- weather and ridership ---------------------------------------------------


def test_wide_weather_classifies(rows):
    raw = rows(
        "DATE string, PRCP string, SNOW string, TMAX string, TMIN string",
        ("2026-01-01", "0", "0", "40", "30"),
        ("2026-01-02", "0.2", "0", "", "31"),
        ("2026-01-03", "0.2", "0.5", "35", "bad"),
        ("not a day", "9", "9", "9", "9"),
    )
    got = weather.clean_weather(raw).orderBy("date").collect()
    assert [r.weather_bucket for r in got] == ["clear", "rain", "snow"]
    assert [r.tmax_f for r in got] == [40, 40, 35] and [r.tmin_f for r in got] == [30, 31, 31]


def test_long_weather_takes_maxima(rows):
    raw = rows(
        "date string, datatype string, value string",
        ("2026-01-01", "prcp", "10"), ("2026-01-01", "PRCP", "30"), ("2026-01-01", "TMAX", "1"),
        ("2026-01-01", "TMAX", "3"), ("2026-01-01", "WIND", "99"),
    )
    assert tuple(weather.clean_weather(raw, prcp_scale=0.01).first()) == (date(2026, 1, 1), 0.3, 0.0, 3.0, None, "rain")


def test_station_reports_average_temperatures(rows):
    reports = rows("date date, datatype string, value double", *[(date(2026, 1, 1), k, v) for k, v in (("TMAX", 1.0), ("TMAX", 3.0), ("PRCP", 2.0))])
    assert tuple(weather.merge_station_reports(reports).first()) == (date(2026, 1, 1), 2.0, 0.0, 2.0, None)


def test_clean_ridership(rows):
    raw = rows(
        "`Transit Timestamp` string, transit_mode string, station_complex_id string, ridership string",
        ("05/23/2025 12:00:00 AM", "Subway", "1", "1,200"),
        ("2025-05-23T00:00:00.000", "subway", "1", "5"),
        ("2025-05-23T00:00:00.000", "tram", "1", "7"),
        ("unreadable", "subway", "1", "7"),
        ("2025-05-23T01:00:00", "subway", None, "7"),
        ("2025-05-23T01:00:00", "subway", "1", "-1"),
        ("2025-05-23T01:00:00", "subway", "1", "many"),
    )
    got = ridership.clean_ridership(raw).collect()
    assert [tuple(r) for r in got] == [("1", None, at("2025-05-23 04:00:00"), date(2025, 5, 23), 4, 6, 1205.0)]
    local = ridership.clean_ridership(raw, calendar_tz="America/New_York").first()
    assert (local.date, local.hour_of_day) == (date(2025, 5, 23), 0)


def test_join_weather_flags_missing_days(rows):
    days = rows("station_complex_id string, date date, entries double", ("1", date(2025, 1, 1), 1.0), ("1", date(2025, 1, 2), 2.0))
    known = rows("date date, weather_bucket string", (date(2025, 1, 1), "rain"), (date(2025, 1, 1), "rain"))
    got = {r.date.day: (r.weather_bucket, r.weather_join_missing) for r in ridership.join_weather(days, known).collect()}
    assert got == {1: ("rain", False), 2: ("clear", True)}


def test_baseline_of_two_hours(rows):
    riders = rows(
        "station_complex_id string, transit_timestamp timestamp, entries double",
        ("613", at("2026-04-01 08:00:00"), 100.0),
        ("613", at("2026-04-08 08:00:00"), 200.0),
    )
    cells, maxima = baseline.build_baseline(riders, lookback_days=0)
    cell = cells.first()
    assert tuple(cell)[:5] == ("613", 4, 8, "clear", 150.0)
    assert cell.std_entries == pytest.approx(70.710678) and maxima.first().max_hourly_entries == 200.0


def test_lookback_keeps_both_ends(rows):
    riders = rows(
        "station_complex_id string, transit_timestamp timestamp, date date, entries double",
        *[("1", at(f"2026-04-{d:02d} 08:00:00"), date(2026, 4, d), float(100 - d)) for d in range(1, 11)],
    )
    assert baseline.lookback(riders, 3).count() == 4
    assert baseline.lookback(riders, 0).count() == 10
    assert baseline.build_baseline(riders, lookback_days=3)[1].first().max_hourly_entries == 93.0
    assert baseline.build_baseline(riders, lookback_days=3, max_over_all_history=True)[1].first().max_hourly_entries == 99.0


def test_weather_coefficients_need_a_clear_mean(rows):
    df = rows(
        "station_complex_id string, weather_bucket string, entries double",
        ("a", "clear", 10.0), ("a", "clear", 30.0), ("a", "rain", 10.0), ("b", "rain", 5.0), ("c", "clear", 0.0), ("c", "snow", 1.0),
    )
    got = {(r.station_complex_id, r.weather_bucket): r.multiplier for r in baseline.weather_coefficients(df).collect()}
    assert got == {("a", "clear"): 1.0, ("a", "rain"): 0.5}


# --- bridge and schedule -----------------------------------------------------


def test_bridge_cascade(rows):
    stations = rows(
        "`GTFS Stop ID` string, `Complex ID` string, `Stop Name` string, `GTFS Latitude` string, `GTFS Longitude` string, Borough string",
        ("127", "611", "Times Sq-42 St", "40.7553", "-73.9872", "M"),
        ("127", "612", "Times Sq-42 St", "40.7553", "-73.9872", "M"),
        ("900", "10", "Canal St", "40.72", "-74.0", "M"),
        ("901", "9", "Canal St", "40.72", "-74.0", "M"),
        ("902", "8", "Faraway", "40.8000", "-73.9", "Q"),
        ("", "7", "Nameless", "0", "0", "Q"),
    )
    stops = rows(
        "stop_id string, stop_name string, stop_lat string, stop_lon string",
        ("127S", "Times Sq", "40.7", "-73.9"), ("127N", "Times Sq", "40.7", "-73.9"),
        ("A1N", "Canal Street", "0", "0"), ("B1", "Somewhere Quite Else", "40.8005", "-73.9"),
        ("C1", "Somewhere Quite Else", "41.0", "-73.9"), ("D1", "No Place Known At All", None, None),
    )
    cascade = bridge.Bridge.of(stations, stops)
    table = cascade.table()
    got = sorted((r.gtfs_stop_id, r.station_complex_id, r.match_tier) for r in table.select("*").collect() if r.gtfs_stop_id != "D1")
    assert got == [
        ("127", "611", "TIER1_DIRECT"), ("127", "612", "TIER1_DIRECT"), ("A1", "10", "TIER2_NAME"),
        ("B1", "8", "TIER3_GEO"), ("C1", None, "UNRESOLVED"),
    ]
    assert table.where("gtfs_stop_id = '127'").first().source_stop_id == "127N"
    assert table.where("gtfs_stop_id = 'A1'").first().match_distance == 4.0
    assert table.where("gtfs_stop_id = 'C1'").first().complex_name == "Somewhere Quite Else"
    assert table.where("gtfs_stop_id = 'D1'").first().match_tier == "UNRESOLVED"
    summary = bridge.bridge_summary(table).first()
    assert tuple(summary) == (6, 2, 1, 1, 2, pytest.approx(2 / 6))


def test_one_pass_table_equals_the_union_of_tiers(spark):
    part = A.table(spark, SF_DIR, "part")
    cascade = bridge.Bridge.of(A.raw_stations(part), A.raw_stops(part))
    tiers = cascade.direct().unionByName(cascade.by_name()).unionByName(cascade.by_place()).unionByName(cascade.unresolved())
    table = cascade.table()
    assert table.exceptAll(tiers).count() == 0 and tiers.exceptAll(table).count() == 0


def test_schedule_median_is_exact(rows):
    times = rows(
        "trip_id string, stop_id string, arrival_time string",
        ("S_1_A..N01", "x", "00:00:01"), ("S_1_A..N02", "x", "00:00:02"), ("S_1_A..N02", "x", "25:00:00"), ("S_1_A..N03", "y", ""),
        ("S_1_A..N04", "z", "00:00:01"), ("S_1_A..N05", "z", "00:00:02"),
    )
    full = schedule.schedule_full(times)
    assert full.count() == 5
    assert {(r.prefix, r.stop_id, r.sched_arr_secs) for r in schedule.schedule_by_prefix(full).collect()} == {
        ("1_A..N", "x", 2), ("1_A..N", "z", 1),
    }
    assert schedule.unique_schedule(full).where("trip_id_suffix = '1_A..N02'").first().sched_arr_secs == 2


# --- live path ---------------------------------------------------------------


def message(rows, *payloads):
    return rows(
        "value binary, timestamp timestamp",
        *[((p if isinstance(p, str) else json.dumps(p)).encode(), at("2025-01-15 12:00:00")) for p in payloads],
    )


def test_trip_delays_prefer_native_then_full_then_prefix(rows):
    def update(trip, **stop):
        return {"trip": {"trip_id": trip, "route_id": "L", "start_date": "20250115"}, "stop_time_update": [stop], "timestamp": "1736942400"}

    midnight = 1736917200  # 05:00 UTC
    parsed = live.parse_trip_updates(
        message(
            rows,
            update("1_A..N01", stop_id="x", arrival={"time": str(midnight + 130), "delay": 7}),
            update("1_A..N01", stop_id="x", arrival={"time": str(midnight + 130)}),
            update("1_A..N", stop_id="x", arrival={"time": str(midnight + 130)}, departure={"delay": 3}),
            update("9_Z..S", stop_id="x", arrival={"time": str(midnight + 130)}),
            update("1_A..N01", arrival={"delay": 1}),
            {"trip": {"trip_id": "none"}},
            '{"trip": {"trip_id": "cut',
        )
    )
    assert parsed.count() == 7
    full = rows("trip_id_suffix string, stop_id string, sched_arr_secs int", ("1_A..N01", "x", 100))
    prefix = rows("prefix string, stop_id string, sched_arr_secs bigint", ("1_A..N", "x", 90))
    got = live.trip_delays(parsed, full, prefix).select("arrival_delay_secs", "delay_source", "departure_delay_secs").collect()
    assert sorted(map(tuple, got), key=str) == [(30, "computed", None), (40, "computed", 3), (7, "native", None)]


def test_malformed_vehicle_keeps_a_row_of_nulls(rows):
    stops = rows("gtfs_stop_id string, station_complex_id string, complex_name string, lat double, lon double", ("A1", None, "n", 1.0, 2.0), ("A1", "5", "m", 1.0, 2.0))
    got = live.enrich_vehicles(
        live.parse_vehicles(message(rows, {"stop_id": "A1N", "timestamp": "5", "route_id": "Q"}, "{broken")), stops
    ).orderBy("event_timestamp").collect()
    assert (got[0].station_complex_id, got[0].stop_id, got[0].event_date) == ("5", "A1N", date(1970, 1, 1))
    assert got[1].stop_id is None and got[1].event_timestamp == at("2025-01-15 12:00:00")


def live_rows(rows):
    vehicles = rows(
        "trip_id string, stop_id string, station_complex_id string, event_timestamp timestamp",
        ("trip-1", "A01N", "611", at("2026-04-29 08:00:00")),
        ("trip-2", "A01N", None, at("2026-04-29 08:00:00")),
    )
    delays = rows(
        "trip_id string, stop_id string, arrival_delay_secs int, event_timestamp timestamp",
        ("trip-1", "A01N", 90, at("2026-04-29 08:01:00")),
        ("trip-1", "A01N", 30, at("2026-04-29 08:04:00")),
        ("trip-2", "A01N", 30, at("2026-04-29 08:04:00")),
        ("trip-1", "A01N", None, at("2026-04-29 08:04:00")),
        ("trip-1", "A01N", 900, at("2026-04-29 08:05:01")),
    )
    return vehicles, delays


def test_delay_signal(rows):
    got = signal.delay_signal(*live_rows(rows)).collect()
    assert {r.station_complex_id for r in got} == {"611"} and {r.avg_arrival_delay_secs for r in got} == {60.0}
    assert len(got) == 20 and min(r.event_timestamp for r in got) == at("2026-04-29 08:00:30")


def test_repeated_polls_weigh_in(rows):
    vehicles, delays = live_rows(rows)
    repeated = delays.unionByName(delays.where("arrival_delay_secs = 90"))
    doubled = vehicles.unionByName(vehicles)
    assert {r.avg_arrival_delay_secs for r in signal.delay_signal(doubled, repeated).collect()} == {70.0}
    for slots in (False, True):
        stream_form = signal.delay_signal_stream(doubled, repeated, slots=slots)
        assert {r.avg_arrival_delay_secs for r in stream_form.collect()} == {70.0}


def test_score_invariants(spark):
    got = QUERIES["score_congestion"](spark, SF_DIR)
    assert got.count() > 0
    wrong = got.where(
        "service_deficit NOT BETWEEN 0 AND 1 OR demand_intensity NOT BETWEEN 0 AND 1 "
        "OR congestion_score > least(service_deficit, demand_intensity) + 1e-6"
    )
    assert wrong.count() == 0
    assert got.groupBy("station_complex_id", "event_timestamp").count().where("count > 1").count() == 0


def test_score_without_baseline_is_normal(rows):
    live_signal = rows("station_complex_id string, event_timestamp timestamp, avg_arrival_delay_secs double", ("1", at("2025-01-15 12:00:00"), 9000.0))
    cells = rows("station_complex_id string, day_of_week int, hour_of_day int, weather_bucket string, avg_entries double", ("1", 4, 12, "rain", 80.0))
    maxima = rows("station_complex_id string, max_hourly_entries double", ("1", 100.0))
    names = rows("station_complex_id string, complex_name string", ("1", "b"), ("1", "a"), (None, "c"))
    clear = scoring.score(live_signal, cells, maxima, names, with_flags=True).first()
    assert (clear.demand_intensity, clear.alert_level, clear.baseline_missing, clear.complex_name) == (0.0, "NORMAL", True, "a")
    rain = scoring.score(live_signal, cells, maxima, names, weather_bucket="rain").first()
    assert (rain.congestion_score, rain.alert_level) == (0.8, "SEVERE") and rain.predicted_delay_mins == pytest.approx(270)
    by_column = scoring.score(live_signal, cells, maxima, names, weather_bucket=F.lit("rain")).first()
    assert by_column.congestion_score == 0.8


@pytest.mark.parametrize(
    ("bucket", "minutes", "expected"), [("snow", 59, "snow"), ("snow", 60, "clear"), ("hail", 1, "clear")]
)
def test_current_bucket(rows, bucket, minutes, expected):
    conditions = rows("scope string, weather_bucket string, updated_at timestamp", ("nyc", bucket, at("2025-01-01 12:00:00")), ("nyc", "rain", at("2025-01-01 11:00:00")))
    now = F.timestamp_seconds(F.lit(1735732800 + 60 * minutes))
    assert scoring.current_bucket(conditions, now).first().weather_bucket == expected
    assert scoring.current_bucket(conditions.limit(0), now).first().weather_bucket == "clear"


# --- ingest ------------------------------------------------------------------


def test_fan_out_and_dead_letters(spark, rows):
    frame = {
        "feed": "ace",
        "feed_timestamp": "5",
        "entity": [
            {"id": "1", "vehicle": {"trip": {"route_id": "A"}, "stop_id": "x"}, "trip_update": {"trip": {"route_id": "7X"}}},
            {"id": "2", "alert": {"informed_entity": [{"route_id": ""}, {"route_id": "L"}]}},
            {"id": "3"},
        ],
    }
    raw = rows(
        "feed string, value binary, timestamp timestamp",
        *[("ace", bytearray(v.encode()), at("2025-01-01 00:00:00")) for v in (json.dumps(frame), '{"feed": "ac', "")],
    )
    parsed = ingest.parse_frames(raw)
    sent = {(r.topic, r.key, r.partition, json.loads(r.value)["entity_id"]) for r in ingest.fan_out(parsed).collect()}
    unknown = ("gtfs-vehicle", "7X"), ("gtfs-trips", "7X")
    assert {(t, k) for t, k, _, _ in sent} == {*unknown, ("gtfs-alerts", "L")}
    assert ("gtfs-alerts", "L", 0, "2") in sent and len(sent) == 3
    letters = {json.loads(r.value)["error"]: json.loads(r.value)["raw_b64"] for r in ingest.dead_letters(parsed).collect()}
    assert letters == {"parse_error: malformed JSON": "eyJmZWVkIjogImFj", "fetch_failed": None}


def test_unreadable_report_keeps_the_last_condition(rows):
    reports = rows("scope string, value string, timestamp timestamp", ("nyc", "{oops", at("2025-01-01 00:00:00")), ("nyc", '{"textDescription": "Clear"}', at("2025-01-01 00:00:00")))
    assert [r.weather_bucket for r in ingest.classify_observations(reports).collect()] == ["clear"]


# --- serving and quality -----------------------------------------------------


def scored(rows, *values):
    return rows(
        "station_complex_id string, event_timestamp timestamp, inserted_at timestamp, congestion_score double, alert_level string",
        *[(s, at(f"2025-01-01 {e}"), at(f"2025-01-01 {i}"), c, level) for s, e, i, c, level in values],
    )


def test_alerts_look_at_the_newest_row_only(rows):
    df = scored(
        rows,
        ("a", "10:00:00", "10:00:01", 0.9, "SEVERE"), ("a", "10:05:00", "10:05:01", 0.1, "NORMAL"),
        ("b", "10:05:00", "10:05:01", 0.3, "MODERATE"), ("b", "10:04:00", "11:00:00", 0.9, "SEVERE"),
        ("c", "10:00:00", "10:00:02", 0.6, "SEVERE"), ("c", "10:00:00", "10:00:01", 0.1, "NORMAL"),
    )
    assert [(r.station_complex_id, r.congestion_score) for r in serving.alerts(df).collect()] == [("c", 0.6), ("b", 0.3)]


def test_escalations_start_and_restart(rows):
    df = scored(
        rows,
        ("a", "10:00:00", "10:00:00", 0.9, "SEVERE"), ("a", "10:59:00", "10:59:00", 0.9, "SEVERE"),
        ("a", "11:01:00", "11:01:00", 0.9, "SEVERE"), ("a", "11:02:00", "11:02:00", 0.1, "NORMAL"), ("a", "12:00:00", "12:00:00", 0.8, "SEVERE"),
    )
    assert [r.event_timestamp.hour for r in serving.escalations(df).orderBy("event_timestamp").collect()] == [10, 12]


def test_history_limits(rows):
    df = scored(rows).withColumn("avg_arrival_delay_secs", F.lit(1.0))
    with pytest.raises(ValueError, match="48"):
        serving.station_history(df, "a", F.current_timestamp(), hours=49)


def test_empty_views(rows):
    empty = scored(rows)
    assert serving.kpi_counts(empty).first().stations_monitored == 0
    fresh = serving.freshness(empty, F.current_timestamp()).first()
    assert fresh.label == "—" and fresh.is_stale
    assert serving.filter_by_routes(empty, []) is empty


def test_directory_unites_routes(rows):
    stops = rows(
        "station_complex_id string, complex_name string, lat double, lon double, daytime_routes string",
        ("1", None, 1.0, 2.0, "A C"), ("1", "n", 3.0, 4.0, "C 2"), ("2", "m", 0.0, 0.0, None), (None, "x", 0.0, 0.0, "Z"),
    )
    got = {r.station_complex_id: tuple(r)[1:] for r in serving.station_directory(stops).collect()}
    assert got == {"1": ("n", 2.0, 3.0, "2 A C"), "2": ("m", 0.0, 0.0, None)}
    assert [r.route for r in serving.route_list(serving.station_directory(stops)).collect()] == ["2", "A", "C"]
    assert serving.filter_by_routes(serving.station_directory(stops), ["C"]).count() == 1


def test_calibration_of_nothing(rows):
    got = quality.calibrate_service(rows("arrival_delay_secs int")).first()
    assert tuple(got) == (0, 0.0, 0.0, 30.0, 240.0, "REVISED_CANDIDATE")
    kept = quality.calibrate_service(rows("arrival_delay_secs int", *[(58,)] * 95, *[(290,)] * 10)).first()
    assert kept.status == "CONFIRMED"


def test_backtest_blank_expectation_passes(rows):
    events = rows(
        "event_name string, avg_arrival_delay_secs string, avg_entries string, max_hourly_entries string, expected_level string",
        ("one", "300", "60", "100", "SEVERE"), ("two", "300", "60", "100", ""), ("three", "", "60", "100", "SEVERE"), ("four", "180", "50", "100", None),
    )
    got = {r.event_name: (r.alert_level, r.passes_expected) for r in quality.backtest_thresholds(events).collect()}
    assert got == {"one": ("SEVERE", True), "two": ("SEVERE", True), "three": ("NORMAL", False), "four": ("MODERATE", True)}


def test_skew_and_percent(rows):
    df = rows("station_complex_id string", *[("a",)] * 10, ("b",), ("b",), ("c",), (None,))
    assert tuple(quality.skew_ratio(df).first()) == (10, 2, 5.0)
    assert df.select(quality.percent_null("station_complex_id").alias("p")).first().p == pytest.approx(7.14)
    assert [r.station_complex_id for r in quality.top_stations(df, 2).collect()] == ["a", "b"]
