from __future__ import annotations

import math
import zlib
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from throngcast.functions import geo, messages, scoring, sqlfunctions, text, times, weather


def lit(value, dtype="string"):
    return F.lit(value).cast(dtype)


@pytest.mark.parametrize(
    ("raw", "expected"),
    [("127N", "127"), ("127S", "127"), (" L06 ", "L06"), ("S", ""), (None, ""), ("\tA01N\n", "A01"), ("12NS", "12N")],
)
def test_normalize_stop_id(evaluate, raw, expected):
    assert evaluate(text.normalize_stop_id(lit(raw))) == expected


def test_stop_base_id_keeps_blanks_and_null(evaluate):
    assert evaluate(text.stop_base_id(lit("A01N "))) == "A01N "
    assert evaluate(text.stop_base_id(lit(None))) is None


@pytest.mark.parametrize(
    ("raw", "expected"),
    [
        ("Times Sq-42 St", "times sq 42 st"),
        ("Jay St-MetroTech", "jay st metrotech"),
        ("  A&B  (x) ", "a and b x"),
        (None, ""),
        ("--", ""),
    ],
)
def test_normalize_station_name(evaluate, raw, expected):
    assert evaluate(text.normalize_station_name(lit(raw))) == expected


@pytest.mark.parametrize(
    ("trip", "live", "prefix", "shape"),
    [
        ("AFA-1-Sunday-00_000600_1..S03R", "000600_1..S03R", "000600_1..S", "000600_1..S"),
        ("X_088750_L..S", "088750_L..S", "088750_L..S", "088750_L..S"),
        ("noseparator", "noseparator", "", "noseparator"),
        ("X_end..", "end..", "", "end.."),
        ("X_a..b..N1", "a..b..N1", "a..b..N", "a..b"),
    ],
)
def test_trip_ids(evaluate, trip, live, prefix, shape):
    live_id = text.realtime_trip_id(lit(trip))
    assert evaluate(live_id) == live
    assert evaluate(text.trip_prefix(live_id)) == prefix
    assert evaluate(text.schedule_prefix(live_id)) == shape


@pytest.mark.parametrize(("clock", "secs"), [("00:00:01", 1), ("25:10:00", 90600), ("bad", None), ("1:2", None)])
def test_clock_to_seconds(evaluate, clock, secs):
    assert evaluate(text.clock_to_seconds(lit(clock))) == secs


def test_haversine(evaluate):
    def distance(*points):
        return evaluate(geo.haversine_meters(*[lit(p, "double") for p in points]))

    assert distance(40.7558, -73.9878, 40.7558, -73.9878) < 0.1
    assert distance(40.7558, -73.9878, 40.7527, -73.9772) > 900
    assert distance(0.0, 0.0, 0.0, 180.0) == pytest.approx(math.pi * geo.EARTH_RADIUS_M)
    assert distance(0.0, None, 0.0, 180.0) is None


@pytest.mark.parametrize(
    ("prcp", "snow", "bucket"),
    [(0, 0, "clear"), (0.2, 0, "rain"), (0.2, 0.2, "snow"), (0.1, 0.1, "clear"), (None, None, "clear"), (None, 1, "snow")],
)
def test_weather_bucket(evaluate, prcp, snow, bucket):
    assert evaluate(weather.weather_bucket(lit(prcp, "double"), lit(snow, "double"))) == bucket


def test_observation(spark):
    def classify(description, prcp, temp):
        fields = weather.observation_columns(lit(description), lit(prcp, "double"), lit(temp, "double"))
        return spark.range(1).select(*[c.alias(n) for n, c in fields.items()]).first().asDict()

    assert classify("Ice Pellets", 5.08, -1.0) == {
        "weather_bucket": "snow", "prcp_in": pytest.approx(0.2), "snow_in": pytest.approx(0.2), "tmax_f": pytest.approx(30.2),
    }
    assert classify("Light Snow", 5.08, 1.0)["weather_bucket"] == "rain"
    assert classify("Light Snow", None, None) == {
        "weather_bucket": "clear", "prcp_in": 0.0, "snow_in": 0.0, "tmax_f": None,
    }


@pytest.mark.parametrize(
    ("delay", "deficit"), [(30, 0), (60, 0), (60.24, 0.001), (180, 0.5), (300, 1), (600, 1), (None, 0), (-50, 0)]
)
def test_service_deficit(evaluate, delay, deficit):
    assert evaluate(scoring.service_deficit(lit(delay, "double"))) == pytest.approx(deficit)


def test_service_deficit_rejects_inverted_endpoints():
    with pytest.raises(ValueError, match="above"):
        scoring.service_deficit(F.lit(1), 300, 60)


@pytest.mark.parametrize(
    ("usual", "most", "share"), [(50, 0, 0), (50, 100, 0.5), (150, 100, 1), (None, 100, 0), (50, None, 0), (-1, 10, 0)]
)
def test_demand_intensity(evaluate, usual, most, share):
    assert evaluate(scoring.demand_intensity(lit(usual, "double"), lit(most, "double"))) == pytest.approx(share)


def test_score_and_forecast(evaluate):
    assert evaluate(scoring.congestion_score(F.lit(0.6), F.lit(0.5))) == pytest.approx(0.3)
    assert evaluate(scoring.predicted_delay_mins(F.lit(180.0), F.lit(0.5))) == pytest.approx(4.5)
    assert evaluate(scoring.predicted_delay_mins(F.lit(-60.0), F.lit(0.0))) == pytest.approx(-1.0)


@pytest.mark.parametrize(
    ("score", "level", "crowding"),
    [
        (0.0, "NORMAL", "Quiet"),
        (0.05, "NORMAL", "Moderate"),
        (math.nextafter(0.2, 0), "NORMAL", "Moderate"),
        (0.2, "MODERATE", "Busy"),
        (math.nextafter(0.5, 0), "MODERATE", "Busy"),
        (0.5, "SEVERE", "Very Busy"),
        (None, "NORMAL", "Quiet"),
    ],
)
def test_levels(evaluate, score, level, crowding):
    assert evaluate(scoring.alert_level(lit(score, "double"))) == level
    assert evaluate(scoring.crowding_label(lit(score, "double"))) == crowding


@pytest.mark.parametrize(("level", "rank"), [("SEVERE", 0), ("MODERATE", 1), ("NORMAL", 2), ("N/A", 99), (None, 99)])
def test_severity_rank(evaluate, level, rank):
    assert evaluate(scoring.severity_rank(lit(level))) == rank


@pytest.mark.parametrize(
    ("secs", "label"),
    [
        (None, "On time"), (-10, "On time"), (30, "On time"), (31, "<1 min"), (60, "~1 min"), (150, "~2 min"),
        (210, "~4 min"), (599, "~10 min"), (600, "10 min"), (3660, "61 min"),
    ],
)
def test_delay_label(evaluate, secs, label):
    assert evaluate(scoring.delay_label(lit(secs, "double"))) == label


@pytest.mark.parametrize(("score", "radius"), [(None, 100), (-1, 100), (0.5, 250), (2, 400)])
def test_marker_radius(evaluate, score, radius):
    assert evaluate(scoring.marker_radius(lit(score, "double"))) == radius


@pytest.mark.parametrize(
    ("raw", "moment"),
    [
        ("2025-05-23T00:00:00.000", datetime(2025, 5, 23)),
        ("2025-05-23T13:00:00", datetime(2025, 5, 23, 13)),
        ("05/23/2025 12:00:00 AM", datetime(2025, 5, 23)),
        ("05/23/2025 01:30:00 pm", datetime(2025, 5, 23, 13, 30)),
        ("05/23/2025 13:30:00", datetime(2025, 5, 23, 13, 30)),
        ("2025-05-23 04:05:06", datetime(2025, 5, 23, 4, 5, 6)),
        ("2025-05-23", datetime(2025, 5, 23)),
        ("23.05.2025", None),
        ("", None),
        (None, None),
    ],
)
def test_parse_timestamp(evaluate, raw, moment):
    assert evaluate(times.parse_timestamp(lit(raw)).cast("timestamp_ntz")) == moment


def test_timestamp_guard_agrees_with_plain_attempts(spark):
    texts = ["2025-01-02T03:04:05.678", "2025-01-02T03:04:05", "01/02/2025 03:04:05 PM", "01/02/2025 15:04:05",
             "2025-01-02 03:04:05", "1/2/2025 3:04:05 PM", "2025-13-02 03:04:05", "T-:.", "/ : am"]
    df = spark.createDataFrame([(t,) for t in texts], "t string")
    plain = F.coalesce(*[F.try_to_timestamp("t", F.lit(f)) for f in times.TIMESTAMP_FORMATS], F.try_to_timestamp("t"))
    assert df.where(~times.parse_timestamp(F.col("t")).eqNullSafe(plain)).count() == 0


def test_parse_iso(evaluate):
    def iso(raw):
        return evaluate(times.parse_iso(lit(raw)).cast("timestamp_ntz"))

    assert iso("2026-01-01T00:00:00Z") == datetime(2026, 1, 1)
    assert iso("2026-01-01T00:00:00-05:00") == datetime(2026, 1, 1, 5)
    assert iso("2026-01-01T00:00:00") == datetime(2026, 1, 1)
    assert iso("") is None and iso(None) is None


def test_event_time_falls_back_to_arrival(evaluate):
    arrival = F.lit("2025-01-01 00:00:00").cast("timestamp")
    assert evaluate(F.unix_seconds(times.event_time(F.lit(5), arrival))) == 5
    assert evaluate(F.unix_seconds(times.event_time(lit(None, "bigint"), arrival))) == 1735689600


def test_service_day_on_the_day_the_clock_changes(evaluate):
    day = lit("20250309")
    midnight = evaluate(times.service_day_epoch(day))
    assert midnight == 1741496400  # 05:00 UTC
    assert evaluate(times.service_day_epoch(day, noon_minus_12h=True)) == midnight - 3600
    assert evaluate(times.service_day_epoch(lit("not a day"))) is None


@pytest.mark.parametrize(
    ("secs", "age", "fresh"),
    [(5, "5s ago", "5s ago"), (59, "59s ago", "59s ago"), (60, "1m ago", "1m 0s ago"), (3725, "1h ago", "62m 5s ago")],
)
def test_ages(evaluate, secs, age, fresh):
    as_of = F.lit("2025-01-01 12:00:00").cast("timestamp")
    moment = F.timestamp_seconds(F.unix_seconds(as_of) - secs)
    assert evaluate(times.age_label(moment, as_of)) == age
    assert evaluate(times.freshness_label(times.age_seconds(moment, as_of))) == fresh


def test_iso_string(evaluate):
    assert evaluate(times.iso_string(F.lit("2025-01-01 01:02:03").cast("timestamp"))) == "2025-01-01T01:02:03"
    assert evaluate(times.iso_string(F.lit("2025-01-01 01:02:03.5").cast("timestamp"))) == "2025-01-01T01:02:03.500000"


@pytest.mark.parametrize("route", ["A", "7", "SIR", "GS", "H"])
def test_known_routes(evaluate, route):
    assert evaluate(messages.partition_for_route(lit(route))) == messages.PARTITION_OF_ROUTE[route]


def test_unknown_and_missing_routes(evaluate):
    assert evaluate(messages.partition_for_route(lit("7X"))) == zlib.crc32(b"7X") % 12
    assert evaluate(messages.partition_for_route(lit(""))) == 11
    assert evaluate(messages.partition_for_route(lit(None))) == 11
    assert evaluate(messages.partition_for_topic(F.lit("gtfs-alerts"), lit("L"))) == 0
    assert evaluate(messages.partition_for_topic(F.lit("gtfs-alerts"), lit(None))) == 1


def test_dead_letter(evaluate):
    at = F.timestamp_seconds(F.lit(7))
    letter = messages.dead_letter_json(F.lit("ace"), F.lit("broken"), at, lit("ab", "binary"))
    assert evaluate(letter) == '{"feed":"ace","error":"broken","received_at":7,"raw_b64":"YWI="}'
    empty = messages.dead_letter_json(F.lit("ace"), F.lit("fetch_failed"), at, lit("", "binary"))
    assert evaluate(empty) == '{"feed":"ace","error":"fetch_failed","received_at":7,"raw_b64":null}'


def test_sql_functions_agree_with_columns(spark):
    sqlfunctions.register_sql_functions(spark)
    row = spark.sql(
        "SELECT normalize_stop_id(' 127N ') a, normalize_station_name('A&B-c') b, "
        "haversine_meters(40.7558D, -73.9878D, 40.7527D, -73.9772D) c, classify_weather(0.2D, NULL) d, "
        "service_deficit(180D) e, demand_intensity(50D, 100D) f, alert_level(0.2D) g, demand_intensity(50D, 0D) h"
    ).first()
    expected = spark.range(1).select(
        geo.haversine_meters(*[F.lit(x) for x in (40.7558, -73.9878, 40.7527, -73.9772)]).alias("c")
    ).first()
    assert row["c"] == pytest.approx(expected["c"])
    assert tuple(row[k] for k in "abdefgh") == ("127", "a and b c", "rain", 0.5, 0.5, "MODERATE", 0.0)
