from __future__ import annotations

from datetime import datetime, timedelta
from types import SimpleNamespace

import pytest
from pyspark.sql import functions as F

from throngcast.plans import signal
from throngcast.schemas import DELAY_SIGNAL, SCORED, TRIP_DELAYS, VEHICLE_POSITIONS
from throngcast.session import scratch_path
from throngcast.sources.readers import file_stream
from throngcast.sources.writers import read_snapshot
from throngcast.streaming import jobs
from throngcast.streaming.runner import ONCE_THROUGH, state_partitions, to_console, to_parquet

START = datetime(2025, 1, 1, 8)


def partial(spark, schema, values):
    """Rows with the given fields, other columns null."""
    names = set().union(*values)
    typed = spark.createDataFrame([tuple(v.get(n) for n in sorted(names)) for v in values], ", ".join(
        f"{n} {schema[n].dataType.simpleString()}" for n in sorted(names)
    ))
    return typed.select(*[
        (F.col(f.name) if f.name in names else F.lit(None)).cast(f.dataType).alias(f.name) for f in schema
    ])


def vehicle(minute, trip="t"):
    return {"trip_id": trip, "stop_id": "s", "station_complex_id": "611", "event_timestamp": START + timedelta(minutes=minute)}


def delay(minute, secs, trip="t"):
    return {"trip_id": trip, "stop_id": "s", "arrival_delay_secs": secs, "event_timestamp": START + timedelta(minutes=minute)}


class Feed:
    """Two staged folders and the signal job over them."""

    def __init__(self, spark, tmp_path):
        self.spark, self.paths = spark, [str(tmp_path / n) for n in ("v", "d", "out", "mark")]

    def add(self, vehicles, delays):
        for path, schema, values in zip(self.paths, (VEHICLE_POSITIONS, TRIP_DELAYS), (vehicles, delays)):
            partial(self.spark, schema, values).coalesce(1).write.mode("append").parquet(path)

    def run(self, **source):
        with state_partitions(self.spark, 2):
            query = jobs.stage_delay_signal(self.spark, *self.paths, trigger=ONCE_THROUGH, **source)
            query.awaitTermination()
        return query

    def signal(self):
        got = self.spark.read.schema(DELAY_SIGNAL).parquet(self.paths[2]).collect()
        return {r.event_timestamp: r.avg_arrival_delay_secs for r in got}, len(got)


END = [vehicle(600, "end-v")], [delay(600, 0, "end-d")]


def test_signal_waits_for_the_watermark_then_emits_once(spark, tmp_path):
    feed = Feed(spark, tmp_path)
    feed.add([vehicle(0)], [delay(1, 90), delay(4, 30)])
    feed.run()
    assert feed.signal() == ({}, 0)
    feed.add(*END)
    feed.run()
    windows, n = feed.signal()
    assert n == 20 and set(windows.values()) == {60.0} and min(windows) == START + timedelta(seconds=30)
    feed.run()  # a restart without new data repeats nothing
    assert feed.signal()[1] == 20


@pytest.mark.parametrize("provider", ["HDFSBackedStateStoreProvider", "RocksDBStateStoreProvider"])
def test_late_rows_are_dropped(spark, tmp_path, provider):
    key = "spark.sql.streaming.stateStore.providerClass"
    before = spark.conf.get(key)
    spark.conf.set(key, f"org.apache.spark.sql.execution.streaming.state.{provider}")
    try:
        feed = Feed(spark, tmp_path)
        feed.add([vehicle(0), vehicle(120, "x")], [delay(1, 90), delay(120, 0, "y")])
        feed.run()
        feed.add([vehicle(1)], [delay(2, 900)])  # two hours behind the watermark
        feed.run()
        feed.add(*END)
        feed.run(max_files_per_trigger=1, latest_first=False)
        windows, n = feed.signal()
        assert n == 20 and set(windows.values()) == {90.0}
    finally:
        spark.conf.set(key, before)


@pytest.mark.parametrize("slots", [False, True])
def test_pairs_stream_equals_batch(spark, tmp_path, slots):
    vehicles = partial(spark, VEHICLE_POSITIONS, [vehicle(i, f"t{i % 3}") for i in range(30)])
    delays = partial(spark, TRIP_DELAYS, [delay(i * 0.7, i, f"t{i % 3}") for i in range(40)])
    paths = [str(tmp_path / n) for n in ("v", "d", "out")]
    vehicles.write.parquet(paths[0])
    delays.write.parquet(paths[1])
    pairs = signal.delay_pairs_stream(
        file_stream(spark, paths[0], VEHICLE_POSITIONS), file_stream(spark, paths[1], TRIP_DELAYS), slots=slots
    )
    with state_partitions(spark, 2):
        stream = to_parquet(pairs, paths[2], paths[2] + "-mark", trigger=ONCE_THROUGH)
        stream.awaitTermination()
    # a delay is kept once, and once for each of three slots where they are asked for
    kept = max(p["stateOperators"][0]["numRowsTotal"] for p in stream.recentProgress if p["stateOperators"])
    assert kept == 30 + 40 * (3 if slots else 1)
    got, expected = spark.read.schema(pairs.schema).parquet(paths[2]), signal.vehicle_delay_pairs(vehicles, delays)
    assert got.exceptAll(expected.select(got.columns)).count() == 0 and got.count() == expected.count() > 50


def test_scoring_twice_replaces_the_batch(spark, rows, tmp_path):
    path, out = str(tmp_path / "s"), str(tmp_path / "scored")
    rows("station_complex_id string, event_timestamp timestamp, avg_arrival_delay_secs double", ("1", START, 300.0)).write.parquet(path)
    cells = rows("station_complex_id string, day_of_week int, hour_of_day int, weather_bucket string, avg_entries double", ("1", 4, 8, "rain", 60.0))
    maxima = rows("station_complex_id string, max_hourly_entries double", ("1", 100.0))
    names = rows("station_complex_id string, complex_name string", ("1", "a"))
    for attempt in range(2):
        jobs.score_signal(
            file_stream(spark, path, DELAY_SIGNAL),
            lambda session: (cells, maxima, names),
            out,
            str(tmp_path / f"mark{attempt}"),
            weather_bucket=lambda session: "rain",
            trigger=ONCE_THROUGH,
        ).awaitTermination()
    got = spark.read.parquet(out)
    assert got.count() == 1 and got.first().alert_level == "SEVERE"
    assert set(SCORED.fieldNames()) < set(got.columns)


def test_counts_are_updated_across_batches(spark, rows, tmp_path):
    path, out = str(tmp_path / "e"), str(tmp_path / "counts")
    for second in (1, 5, 12):
        rows("ts timestamp", (START + timedelta(seconds=second),)).coalesce(1).write.mode("append").parquet(path)
    stream = file_stream(spark, path, spark.read.parquet(path).schema, max_files_per_trigger=1)
    with state_partitions(spark, 2):
        jobs.keep_counts(jobs.windowed_counts(stream, "ts"), out, f"{out}-mark", trigger=ONCE_THROUGH).awaitTermination()
    assert sorted(r.msg_count for r in jobs.current_counts(spark, out).collect()) == [1, 2]
    for _ in range(2):  # a restart without new rows changes nothing
        assert jobs.current_counts(spark, out).count() == 2


def test_conditions_keep_the_newest(spark, rows, tmp_path):
    path, out = str(tmp_path / "c"), str(tmp_path / "cond")
    for bucket, minute in (("rain", 5), ("snow", 3), ("clear", 9)):
        rows("scope string, weather_bucket string, updated_at timestamp", ("nyc", bucket, START + timedelta(minutes=minute))).coalesce(1).write.mode("append").parquet(path)
    stream = file_stream(spark, path, spark.read.parquet(path).schema, max_files_per_trigger=1)
    jobs.upsert_conditions(stream, out, f"{out}-mark", trigger=ONCE_THROUGH).awaitTermination()
    assert [r.weather_bucket for r in jobs.current_conditions(spark, out).collect()] == ["clear"]


def test_escalations_compare_snapshots(spark, tmp_path):
    path, state, out = (str(tmp_path / n) for n in ("s", "state", "out"))

    def run(*values):
        scored = [
            {"station_complex_id": s, "alert_level": level, "event_timestamp": START + timedelta(minutes=m), "inserted_at": START}
            for s, level, m in values
        ]
        partial(spark, SCORED, scored).coalesce(1).write.mode("append").parquet(path)
        jobs.watch_escalations(
            file_stream(spark, path, SCORED), state, out, f"{out}-mark", trigger=ONCE_THROUGH
        ).awaitTermination()
        found = spark.read.parquet(out)
        newest = found.agg(F.max("batch_id")).first()[0]
        return sorted(r.station_complex_id for r in found.where(F.col("batch_id") == newest).collect())

    assert run(("a", "SEVERE", 1), ("b", "NORMAL", 1)) == ["a"]
    assert run(("a", "SEVERE", 2), ("b", "SEVERE", 2)) == ["b"]
    assert run(("a", "NORMAL", 3), ("b", "SEVERE", 1), ("c", "SEVERE", 3)) == ["c"]
    assert run(("a", "SEVERE", 4)) == ["a"]
    assert read_snapshot(spark, state, SCORED).count() == 3


def test_console_sink_runs(spark, rows, tmp_path):
    path = str(tmp_path / "e")
    rows("ts timestamp", (START,)).write.parquet(path)
    stream = file_stream(spark, path, spark.read.parquet(path).schema)
    to_console(stream, str(tmp_path / "mark"), trigger=ONCE_THROUGH).awaitTermination()


def test_scratch_stays_below_the_shared_folder(spark):
    assert scratch_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))


def test_scratch_without_the_setting_lies_in_the_warehouse():
    session = SimpleNamespace(conf={"spark.sql.warehouse.dir": "store://shared/warehouse/"})
    first, second = (scratch_path(session, "x") for _ in range(2))
    assert first != second and first.startswith("store://shared/warehouse/throngcast/x-")
