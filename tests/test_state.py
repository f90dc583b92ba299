"""Keyed state and tables that outlive a trigger: escalations, keyed tables, documents, reloaded lookups."""

from __future__ import annotations

from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.test_streams import START, partial
from throngcast.plans import serving
from throngcast.schemas import DELAY_SIGNAL, SCORED
from throngcast.sources import documents, files, writers
from throngcast.sources.keyed import KeyedTable
from throngcast.sources.readers import file_stream
from throngcast.streaming import jobs, state
from throngcast.streaming.runner import ONCE_THROUGH, for_each_batch, state_partitions


def at(minute):
    return START + timedelta(minutes=minute)


class Scored:
    """A folder of scored rows and the tracking job over it."""

    def __init__(self, spark, tmp_path):
        self.spark, self.paths = spark, [str(tmp_path / n) for n in ("scored", "out", "mark")]
        self.sent = []

    def run(self, *values, **tracking):
        rows = [
            {"station_complex_id": s, "alert_level": level, "event_timestamp": at(m), "inserted_at": at(m), "congestion_score": m / 10}
            for s, level, m in values
        ]
        self.sent += rows
        partial(self.spark, SCORED, rows).coalesce(1).write.mode("append").parquet(self.paths[0])
        with state_partitions(self.spark, 2):
            jobs.track_escalations(
                file_stream(self.spark, self.paths[0], SCORED), self.paths[1], self.paths[2], trigger=ONCE_THROUGH, **tracking
            ).awaitTermination()

    def found(self):
        rows = self.spark.read.parquet(self.paths[1]).collect()
        return sorted((r.station_complex_id, (r.event_timestamp - START) // timedelta(minutes=1), r.previous_level) for r in rows)

    def batch(self):
        rows = serving.escalations(partial(self.spark, SCORED, self.sent)).collect()
        return sorted((r.station_complex_id, (r.event_timestamp - START) // timedelta(minutes=1), r.previous_level) for r in rows)


def test_every_change_is_tracked_across_restarts(spark, tmp_path):
    feed = Scored(spark, tmp_path)
    feed.run(("a", "SEVERE", 1), ("a", "NORMAL", 2), ("a", "SEVERE", 3), ("b", "NORMAL", 2), ("b", "SEVERE", 1))
    assert feed.found() == []  # the watermark has not passed them
    feed.run(("a", "SEVERE", 20), ("b", "MODERATE", 14), ("b", "SEVERE", 16), ("end", "NORMAL", 40))
    feed.run(("a", "NORMAL", 35), ("a", "SEVERE", 36), ("end", "NORMAL", 90))  # the same checkpoint, a new run
    assert feed.found() == feed.batch()
    assert [x for x in feed.found() if x[0] == "a"] == [("a", 1, None), ("a", 3, "NORMAL"), ("a", 36, "NORMAL")]
    before = feed.found()
    feed.run(("a", "SEVERE", 0), ("end", "NORMAL", 200))  # far behind the watermark
    assert feed.found() == before


def test_silent_stations_are_forgotten(spark, tmp_path):
    feed = Scored(spark, tmp_path)
    feed.run(("a", "SEVERE", 1), ("b", "SEVERE", 1), ("b", "SEVERE", 50), ("end", "NORMAL", 300), forget_hours=1)
    feed.run(("a", "SEVERE", 300), ("b", "SEVERE", 295), ("end", "NORMAL", 900), forget_hours=1)
    assert feed.found() == [("a", 1, None), ("a", 300, None), ("b", 1, None), ("b", 295, None)]


# --- keyed tables ------------------------------------------------------------


def test_a_trigger_writes_only_its_keys(spark, rows, tmp_path):
    """Fifty triggers of ten new windows each: the last writes no more than the first, and days gone
    by are not written again."""
    path = str(tmp_path / "counts")
    table, written, known = jobs.counts_table(path), [], {}
    for batch_id in range(50):
        first = START + timedelta(hours=3 * batch_id)
        windows = [(first + timedelta(minutes=k), first + timedelta(minutes=k + 1), batch_id + k) for k in range(10)]
        again = (START, START + timedelta(minutes=1), 1000 + batch_id) if batch_id < 5 else windows[0]
        df = rows("start timestamp, end timestamp, msg_count long", *dict.fromkeys([*windows[1:], again]))
        table.upsert(df, batch_id, compact_every=10)
        known.update({w[0]: w[2] for w in [*windows[1:], again]})
        written.append(files.total_bytes(spark, f"{path}/delta/batch_id={batch_id}"))
    assert max(w for w in written if w) < 1.5 * min(w for w in written if w)
    got = {r.start: r.msg_count for r in table.read(spark).collect()}
    assert got == known
    versions = files.complete_numbers(spark, f"{path}/versions", "upto")
    assert versions == [39, 49]
    days = {n: files.folder_names(spark, f"{path}/base/{n}") for n in files.folder_names(spark, f"{path}/base") if "=" in n}
    # a day keeps the folder of its last compaction
    assert len(days) == 7 and days["keyed_part=2025-01-02"] == ["upto=19"] and days["keyed_part=2025-01-07"] == ["upto=49"]
    one = jobs.current_counts(spark, path, ["2025-01-02"])
    assert {f.split("keyed_part=")[1].split("/")[0] for f in one.inputFiles()} == {"2025-01-02"}
    assert {r.start for r in one.collect()} == {s for s in known if s.date().isoformat() == "2025-01-02"}


def test_keyed_table_keeps_the_newest_and_survives_retries(spark, rows, tmp_path):
    path, shape = str(tmp_path / "t"), "k string, t int, v string"
    schema = spark.createDataFrame([], shape).schema
    table = KeyedTable(path, schema, ["k"], ["t"], part=F.col("k"))
    assert table.read(spark).count() == 0
    for batch_id, row in enumerate([("a", 5, "x"), ("a", 3, "old"), (None, 1, "n"), ("b/c", 1, "y")]):
        table.upsert(rows(shape, row), batch_id)
    assert sorted(r.v for r in table.read(spark).collect()) == ["n", "x", "y"]
    assert table.compact(spark) == 3 and table.compact(spark) is None
    table.upsert(rows(shape, ("a", 9, "first try")), 4)
    table.upsert(rows(shape, ("a", 9, "second try")), 4)
    table.upsert(rows(shape, ("b/c", 1, "tie")), 5)
    assert sorted(r.v for r in table.read(spark).collect()) == ["n", "second try", "tie"]
    # a batch whose write did not end, and a compaction that did not
    rows(shape, ("a", 99, "half")).write.parquet(f"{path}/delta/batch_id=6/keyed_part=a")
    rows(shape, ("a", 99, "half")).write.parquet(f"{path}/base/keyed_part=a/upto=5")
    assert sorted(r.v for r in table.read(spark).collect()) == ["n", "second try", "tie"]
    assert table.compact(spark) == 5
    assert sorted(r.v for r in table.read(spark).collect()) == ["n", "second try", "tie"]
    assert [r.v for r in table.read(spark, ["b_c"]).collect()] == ["tie"]


# --- documents ---------------------------------------------------------------


def _views(rows):
    cells = rows("station_complex_id string, day_of_week int, hour_of_day int, weather_bucket string, avg_entries double", ("1", 4, 8, "rain", 60.0))
    maxima = rows("station_complex_id string, max_hourly_entries double", ("1", 100.0))
    return lambda session: (cells, maxima, rows("station_complex_id string, complex_name string", ("1", "a")))


def test_documents_of_a_retried_batch_appear_once(spark, rows, tmp_path, monkeypatch):
    """The first attempt ends after the write and before the ledger; the second after the ledger and
    before the checkpoint; each computes the insertion time anew."""
    path, out, mark = (str(tmp_path / n) for n in ("signal", "docs", "mark"))
    shape = "station_complex_id string, event_timestamp timestamp, avg_arrival_delay_secs double"
    rows(shape, ("1", START, 300.0), ("1", at(1), 200.0), (None, at(2), 100.0)).coalesce(1).write.parquet(path)

    def run():
        jobs.score_signal(
            file_stream(spark, path, DELAY_SIGNAL), _views(rows), out, mark, weather_bucket=lambda session: "rain",
            inserted_at=F.lit(datetime.now()), sink="documents", trigger=ONCE_THROUGH,
        ).awaitTermination()

    commit, attempts = documents.CommitLedger.commit, []

    def broken(self, session, batch_id):
        attempts.append(batch_id)
        if len(attempts) == 1:
            raise RuntimeError("lost before the ledger")
        commit(self, session, batch_id)
        if len(attempts) == 2:
            raise RuntimeError("lost before the checkpoint")

    monkeypatch.setattr(documents.CommitLedger, "commit", broken)
    for _ in range(2):
        with pytest.raises(Exception, match="lost before"):
            run()
    run()
    table = documents.document_table(out, SCORED)
    stored = table.read(spark).collect()
    assert sorted(str(r.event_timestamp) for r in stored) == [str(at(m)) for m in (0, 1, 2)]
    assert attempts == [0, 0] and documents.CommitLedger(f"{mark}/documents", mark).newest(spark) == 0
    rows(shape, ("1", START, 300.0)).coalesce(1).write.mode("append").parquet(path)  # a new batch adds a document of its own
    run()
    assert table.read(spark).count() == 4


def test_ledger_keeps_the_newest_batch_only(spark, rows, tmp_path):
    ledger = documents.CommitLedger(str(tmp_path / "ledger"), "q")
    assert not ledger.holds(spark, 0)
    for batch_id in (0, 1, 7):
        ledger.commit(spark, batch_id)
    assert ledger.holds(spark, 7) and ledger.holds(spark, 3) and not ledger.holds(spark, 8)
    assert files.folder_names(spark, ledger.path).count("batch=7") == 1 and len([n for n in files.folder_names(spark, ledger.path) if n.startswith("batch=")]) == 1
    with pytest.raises(ValueError, match="paper"):
        documents.write_documents_once(rows("station_complex_id string, event_timestamp timestamp", ("1", START)), 8, "paper", ledger)


def test_document_ids_tell_null_from_empty(rows):
    df = rows("station_complex_id string, event_timestamp timestamp", (None, None), ("", None), ("?", START))
    ids = df.select(documents.document_id("q", 1, documents.ID_COLUMNS).alias("i")).distinct()
    assert ids.count() == 3
    assert df.select(documents.document_id("q", 2, documents.ID_COLUMNS).alias("i")).intersect(ids).count() == 0


# --- lookups that change -----------------------------------------------------

MESSAGE = '{{"trip":{{"trip_id":"{0}"}},"stop_id":"7N","timestamp":"1735718400"}}'


def _message(spark, path, trip):
    df = spark.createDataFrame([(MESSAGE.format(trip).encode(), START)], "value binary, timestamp timestamp")
    df.coalesce(1).write.mode("append").parquet(path)


def _bridge(rows, complex_id):
    return rows("gtfs_stop_id string, source_stop_id string, station_complex_id string, complex_name string, lat double, lon double", ("7", "7N", complex_id, "x", 1.0, 2.0))


def test_a_rebuilt_bridge_counts_from_the_next_trigger(spark, rows, tmp_path):
    feed, bridge, out, mark = (str(tmp_path / n) for n in ("feed", "bridge", "out", "mark"))
    _message(spark, feed, "t1")
    schema = spark.read.parquet(feed).schema
    shape = _bridge(rows, "1").schema
    assert writers.publish_snapshot(_bridge(rows, "1"), bridge) == 0
    query = jobs.stage_vehicles_reloading(
        file_stream(spark, feed, schema), lambda session: writers.read_snapshot(session, bridge, shape), out, mark,
        trigger={"processingTime": "0 seconds"},
    )
    try:
        query.processAllAvailable()
        assert writers.publish_snapshot(_bridge(rows, "2"), bridge) == 1
        _message(spark, feed, "t2")
        query.processAllAvailable()
    finally:
        query.stop()
    got = spark.read.parquet(out).collect()
    assert sorted((r.trip_id, r.station_complex_id) for r in got) == [("t1", "1"), ("t2", "2")]


def test_a_published_batch_is_not_replaced(spark, rows, tmp_path):
    """A stream over the published folders meets each row once, whatever is retried."""
    path, out = str(tmp_path / "p"), []
    assert writers.publish_batch(rows("v int", (1,)), 0, path)
    assert not writers.publish_batch(rows("v int", (2,)), 0, path)
    writers.publish_batch(rows("v int", (3,)), 1, path)
    stream = file_stream(spark, path, rows("v int").schema)
    for _ in range(2):
        for_each_batch(stream, lambda b, _: out.extend(r.v for r in b.collect()), str(tmp_path / "mark"), trigger=ONCE_THROUGH).awaitTermination()
    assert sorted(out) == [1, 3]


def test_snapshots_are_kept_for_running_readers(spark, rows, tmp_path):
    path = str(tmp_path / "s")
    for k in range(5):
        assert writers.publish_snapshot(rows("v int", (k,)), path, keep=2) == k
    assert writers.snapshot_ids(spark, path) == [3, 4]
    assert writers.read_snapshot(spark, path, rows("v int").schema).first().v == 4


def test_stations_are_shared_by_slices(spark, tmp_path):
    """Keyed state sees a row per slice of a station, however many rows the slice has."""
    feed = Scored(spark, tmp_path)
    values = [("a", ("SEVERE", "NORMAL")[k % 2], k / 60) for k in range(400)]
    rows = [{"station_complex_id": s, "alert_level": v, "event_timestamp": at(m), "inserted_at": at(m), "congestion_score": m} for s, v, m in values]
    rows += [{**rows[0], "station_complex_id": "end", "event_timestamp": at(90), "alert_level": "NORMAL"}]
    partial(spark, SCORED, rows).write.parquet(feed.paths[0])
    with state_partitions(spark, 2):
        found = state.escalation_stream(file_stream(spark, feed.paths[0], SCORED))
        query = jobs.to_parquet(found, feed.paths[1], feed.paths[2], trigger=ONCE_THROUGH)
        query.awaitTermination()
    assert feed.spark.read.parquet(feed.paths[1]).count() == 200
    operators = [op for p in query.recentProgress for op in p["stateOperators"] if op["operatorName"].startswith("transformWithState")]
    assert sum(op["numRowsUpdated"] for op in operators) < 10
