from __future__ import annotations

from throngcast import batch


def test_batch_layer_from_files(spark, tmp_path):
    def file(name, *lines):
        (tmp_path / name).write_text("\n".join(lines) + "\n")
        return [str(tmp_path / name)]

    def path(name):
        return str(tmp_path / name)

    stations = file(
        "stations.csv",
        "GTFS Stop ID,Complex ID,Stop Name,Borough,Daytime Routes,GTFS Latitude,GTFS Longitude",
        "127,611,Times Sq,M,1 2,40.75,-73.98",
    )
    stops = file("stops.csv", "stop_id,stop_name,stop_lat,stop_lon", "127N,Times Sq,40.75,-73.98", "X1,Elsewhere Far,0,0")
    assert batch.bridge_job(spark, stations, stops, path("bridge")) == {"rows": 2, "unresolved": 1}

    old = file("old.csv", "transit_timestamp,transit_mode,station_complex_id,station_complex,ridership",
               "2025-01-06T08:00:00.000,subway,611,Times Sq,\"1,000\"", "2025-01-06T08:00:00.000,bus,611,Times Sq,5")
    new = file("new.csv", "station_complex_id,ridership,transit_timestamp,transit_mode",
               "611,500,01/07/2025 08:00:00 AM,subway", "9,7,01/08/2025 08:00:00 AM,subway", "611,x,bad,subway")
    counts = batch.clean_ridership_job(spark, old + new, path("ridership"), bridge=path("bridge"))
    assert counts == {"rows_before": 5, "rows": 3, "resolved": 2}

    weather = file("weather.csv", "DATE,PRCP,SNOW", "2025-01-06,0.2,0", "2025-01-07,0.0,0.3")
    assert batch.clean_weather_job(spark, weather, path("weather")) == {"rows": 2, "clear": 0, "rain": 1, "snow": 1}
    assert batch.join_weather_job(spark, path("ridership"), path("weather"), path("joined")) == {
        "rows": 3, "missing_weather": 1,
    }

    targets = {name: {"parquet": path(name), "noop": name} for name in ("baseline", "station_max", "coefficients")}
    batch.baseline_job(spark, path("joined"), targets, sinks="parquet,noop", lookback_days=0)
    cells = {(r.station_complex_id, r.weather_bucket): r.avg_entries for r in spark.read.parquet(path("baseline")).collect()}
    assert cells == {("611", "rain"): 1000.0, ("611", "snow"): 500.0, ("9", "clear"): 7.0}
    assert spark.read.parquet(path("station_max")).count() == 2
    batch.weather_coefficients_job(spark, path("joined"), targets["coefficients"])
    assert [r.multiplier for r in spark.read.parquet(path("coefficients")).collect()] == [1.0]

    times = file("stop_times.csv", "trip_id,stop_id,arrival_time", "S_1_A..N01,x,00:00:05", "S_1_A..N01,x,00:00:04", "S_1_A..N02,x,25:00:00")
    assert batch.schedule_job(spark, times, path("full"), path("prefix")) == {"full_rows": 2, "prefix_rows": 1}


def test_reports_from_staged_tables(spark, rows, tmp_path):
    vehicles, delays, out = (str(tmp_path / n) for n in ("vehicles", "delays", "out"))
    rows("station_complex_id string, route_id string, event_timestamp timestamp", ("1", "A", None), ("1", None, None), (None, "A", None)).write.parquet(vehicles)
    rows("trip_id string, stop_id string, arrival_delay_secs int, event_timestamp timestamp, delay_source string",
         ("t", "s", 30, None, "native"), ("t", "u", 90, None, "computed")).write.parquet(delays)
    assert batch.audit_job(spark, vehicles, delays, out) == {"reports": 4}
    audit = spark.read.json(f"{out}/vehicles").first()
    assert (audit.rows, audit.distinct_stations, audit.distinct_routes) == (3, 1, 1)
    assert spark.read.json(f"{out}/delays").first().distinct_stops == 2
    assert batch.calibration_job(spark, delays, f"{out}/calibration")["rows"] == spark.read.parquet(f"{out}/calibration").count()

    (tmp_path / "events.csv").write_text(
        "event_name,station_complex_id,avg_arrival_delay_secs,avg_entries,max_hourly_entries,expected_level\n"
        "late,1,600,90,100,SEVERE\ncalm,1,0,90,100,NORMAL\n"
    )
    files = [str(tmp_path / "events.csv")]
    assert batch.backtest_job(spark, files, f"{out}/backtest")["rows"] == spark.read.parquet(f"{out}/backtest").count()
    assert batch.profile_job(spark, files, f"{out}/profile", rows=1)["rows"] == 6
    assert spark.read.json(f"{out}/profile/sample").count() == 1
