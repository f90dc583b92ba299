from __future__ import annotations

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from throngcast.schemas import CAPACITY_BASELINE
from throngcast.sources import columns, readers, writers


def test_headers_are_found_by_their_words(rows):
    df = rows("`Transit Timestamp` string, `GTFS-Stop.ID` string, x string, xy string", ("t", "s", "1", "2"))
    named = columns.HeaderLookup(df)
    assert named.first_of("transit_timestamp") == "Transit Timestamp"
    assert named.first_of("nope", "gtfs stop id") == "GTFS-Stop.ID"
    assert named.first_of("nope", "x y") is None and ("nope", "X") in named and "nope" not in named
    assert df.select(named.need("gtfs stop id")).first()[0] == "s"
    with pytest.raises(ValueError, match="nope or never; the file has Transit"):
        named.need("nope", "never")


def test_wanted_columns_are_typed(rows):
    df = rows("`A b` string", ("v",))
    named = columns.HeaderLookup(df)
    assert df.select(named.need("a_b").alias("x"), named.want("double", "z").alias("y")).dtypes == [("x", "string"), ("y", "double")]
    columns.require_columns(df, ["A b"], "frame")
    with pytest.raises(ValueError, match="frame lacks"):
        columns.require_columns(df, ["q"], "frame")
    assert columns.complete_columns(df, **{"A b": F.lit("other"), "n": F.lit(1)}).first() == ("v", 1)


def test_csv_files_unite_by_name(spark, tmp_path):
    (tmp_path / "one.csv").write_text("id,name,extra\n1,a,x\n")
    (tmp_path / "two.csv").write_text("name,id\nb,2\n")
    df = readers.read_csv_files(spark, [str(tmp_path / "one.csv"), str(tmp_path / "two.csv")])
    assert {tuple(r) for r in df.select("id", "name", "extra").collect()} == {("1", "a", "x"), ("2", "b", None)}
    assert set(dict(df.dtypes).values()) == {"string"}


def test_incremental_extract(rows):
    df = rows("t timestamp, id int", *[(datetime(2025, 1, d), d) for d in range(1, 11)])
    page = readers.incremental_extract(df, ["id"], ["t"], since="2025-01-03", limit=3, offset=2)
    assert [r.id for r in page.collect()] == [5, 6, 7]
    assert readers.incremental_extract(df, ["id"], ["t"]).count() == 10


def test_kafka_options():
    options = readers.kafka_options(
        "h:9092", "gtfs-trips", starting_offsets="earliest", max_offsets_per_trigger=5000, group_prefix="trips"
    )
    assert options == {
        "kafka.bootstrap.servers": "h:9092",
        "subscribe": "gtfs-trips",
        "startingOffsets": "earliest",
        "maxOffsetsPerTrigger": "5000",
        "groupIdPrefix": "trips",
    }
    assert "maxOffsetsPerTrigger" not in readers.kafka_options("h", "t")


def test_partitioned_overwrite_replaces_touched_dates_only(spark, rows, tmp_path):
    path = str(tmp_path / "t")
    writers.write_parquet(rows("d string, v int", ("a", 1), ("b", 2)), path, partition_by=["d"])
    writers.write_parquet(rows("d string, v int", ("b", 3)), path, partition_by=["d"])
    assert {(r.d, r.v) for r in spark.read.parquet(path).collect()} == {("a", 1), ("b", 3)}


def test_write_table_dispatches_and_computes_once(spark, tmp_path):
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(len(batch))
            yield batch

    df = spark.range(5).mapInPandas(count, "id long")
    path = str(tmp_path / "t")
    writers.write_table(df, "parquet, noop,parquet", {"parquet": path, "noop": "anywhere"})
    assert seen.value == 5 and spark.read.parquet(path).count() == 5
    with pytest.raises(ValueError, match="unknown|no target"):
        writers.write_table(df, "cassandra", {"parquet": path})


def test_keyed_store_and_documents(spark, rows, tmp_path, capsys):
    path = str(tmp_path / "k")
    df = rows("k string, v int", ("a", 1))
    writers.write_keyed_store(df, path, mode="overwrite")
    assert readers.read_keyed_store(spark, path).count() == 1
    writers.write_documents(df, "parquet", path=path)
    assert readers.load_batch_views(spark, path, path)[0].count() == 2
    writers.write_documents(df, "console")
    assert "|a  |1  |" in capsys.readouterr().out
    with pytest.raises(ValueError, match="unsupported"):
        writers.write_documents(df, "paper")


def test_append_batch_is_idempotent(spark, rows, tmp_path):
    path = str(tmp_path / "b")
    for batch_id, value in ((0, 1), (1, 2), (1, 2)):
        writers.append_batch(rows("k string, v int", ("a", value), (f"only{batch_id}", 0)), batch_id, path)
    assert spark.read.parquet(path).count() == 4
    schema = rows("k string, v int").schema
    view = {r.k: r.v for r in writers.keyed_view(spark, path, schema, ["k"]).collect()}
    assert view == {"a": 2, "only0": 0, "only1": 0}
    writers.append_batch(rows("k string, v int"), 1, path)  # a retry without rows
    assert {r.k for r in writers.keyed_view(spark, path, schema, ["k"]).collect()} == {"a", "only0"}


def test_tables_of_empty_batches_can_be_read(spark, rows, tmp_path):
    path, empty = str(tmp_path / "b"), rows("k string, v int")
    assert writers.keyed_view(spark, path, empty.schema, ["k"]).count() == 0
    writers.append_batch(empty, 0, path)
    assert writers.keyed_view(spark, path, empty.schema, ["k"]).count() == 0


def test_snapshots_stay_few_and_hold_the_latest(spark, rows, tmp_path):
    path, shape = str(tmp_path / "s"), "k string, v int, t int"
    for batch_id in range(12):
        writers.merge_batch(rows(shape, (f"k{batch_id % 3}", batch_id, batch_id)), batch_id, path, ["k"], ["t"])
    writers.merge_batch(rows(shape, ("k2", 99, 11)), 11, path, ["k"], ["t"])  # a retry
    assert writers.snapshot_ids(spark, path) == [9, 10, 11]
    found = {r.k: r.v for r in writers.read_snapshot(spark, path, rows(shape).schema).collect()}
    assert found == {"k0": 9, "k1": 10, "k2": 99}
    older = writers.merge_batch(rows(shape, ("k0", 1, 1)), 12, path, ["k"], ["t"])
    assert older.count() == 3 and writers.read_snapshot(spark, path, rows(shape).schema).where("k = 'k0'").first().v == 9


def test_expired_batches_are_deleted(spark, rows, tmp_path):
    path, shape = str(tmp_path / "e"), "k string, inserted_at timestamp"
    for batch_id, day in ((0, 1), (1, 2), (2, 5)):
        writers.append_batch(rows(shape, ("a", datetime(2025, 1, day))), batch_id, path)
    as_of = F.lit("2025-01-03 00:00:00").cast("timestamp")
    assert writers.expire(spark, path, rows(shape).schema, as_of, hours=24) == 1
    assert writers.snapshot_ids(spark, path) == [1, 2]


def test_keyed_table_keeps_one_row_per_key(spark, rows, tmp_path):
    path = str(tmp_path / "k")
    for value in (1, 2):
        writers.write_keyed_store(rows("k string, v int", ("a", value), (f"b{value}", 0)), path, keys=["k"])
    assert {(r.k, r.v) for r in readers.read_keyed_store(spark, path).collect()} == {("a", 2), ("b1", 0), ("b2", 0)}


def test_bulk_load_coerces_types(spark, tmp_path):
    path = str(tmp_path / "base")
    spark.range(1).selectExpr(
        "1 AS station_complex_id", "'3' AS day_of_week", "4L AS hour_of_day", "'clear' AS weather_bucket",
        "1 AS avg_entries", "CAST(NULL AS FLOAT) AS std_entries", "'2.5' AS p95_entries",
    ).write.parquet(path)
    loaded = readers.load_baseline(spark, path)
    assert [f.dataType for f in loaded.schema] == [f.dataType for f in CAPACITY_BASELINE]
    assert tuple(loaded.first()) == ("1", 3, 4, "clear", 1.0, None, 2.5)


def test_retention_is_inclusive(rows):
    now = F.lit("2025-01-02 00:00:00").cast("timestamp")
    df = rows("inserted_at timestamp", (datetime(2025, 1, 1),), (datetime(2024, 12, 31, 23, 59, 59),))
    assert writers.within_retention(df, now).count() == 1


def test_row_count_rides_along(spark):
    df, seen = writers.with_row_count(spark.range(7), "written", evens=F.count_if(F.col("id") % 2 == 0))
    df.write.format("noop").mode("overwrite").save()
    assert seen.get == {"rows": 7, "evens": 4}
