"""Point lookups, busiest keys, late rows and newest-first catch-up."""

from __future__ import annotations

import os
from datetime import datetime, timedelta
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from throngcast.operators.heavy import busiest_keys, key_cells
from throngcast.plans import quality
from throngcast.sources.lookup import BUCKET, bucket_of, find_keys, publish_lookup
from throngcast.sources.readers import file_stream
from throngcast.streaming.late import late_rows, mark_late, rows_in_time
from throngcast.streaming.runner import ONCE_THROUGH, for_each_batch

START = datetime(2025, 1, 1, 8)


def cells_of(spark):
    station = F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 50 != 1, F.concat(F.lit("s"), F.col("id") % 40))
    return spark.range(600).select(station.alias("station"), F.col("id").alias("n"))


def test_a_lookup_reads_only_the_bucket_of_its_key(spark, tmp_path):
    path, table = str(tmp_path / "cells"), cells_of(spark)
    publish_lookup(table, path, "station", buckets=8)
    wanted = spark.range(1).select(bucket_of(F.lit("hot"), 8)).first()[0]
    spoilt = 0
    for file in Path(path).rglob("*.parquet"):
        if f"{BUCKET}={wanted}/" not in str(file):
            file.write_bytes(b"no table")
            spoilt += 1
    found = find_keys(spark, path, table.schema, "station", ["hot"])
    assert spoilt > 3 and found.columns == ["station", "n"]
    assert sorted(r.n for r in found.collect()) == list(range(0, 600, 3))


def test_lookups_of_several_unknown_and_null_keys(spark, tmp_path):
    path, table = str(tmp_path / "cells"), cells_of(spark)
    assert find_keys(spark, path, table.schema, "station", ["hot"]).count() == 0
    publish_lookup(table, path, "station", buckets=8)
    got = find_keys(spark, path, table.schema, "station", ["s1", "hot", "nowhere"])
    expected = table.where(F.col("station").isin("s1", "hot"))
    assert got.exceptAll(expected).count() == 0 and got.count() == expected.count()
    assert find_keys(spark, path, table.schema, "station", []).count() == 0
    publish_lookup(table.limit(0), path, "station", buckets=4)
    assert find_keys(spark, path, table.schema, "station", ["hot"]).count() == 0


def test_a_new_snapshot_may_have_other_buckets(spark, tmp_path):
    path, table = str(tmp_path / "cells"), cells_of(spark)
    for number, buckets in enumerate((8, 3, 5, 7)):
        assert publish_lookup(table.withColumn("n", F.col("n") + number), path, "station", buckets=buckets) == number
    assert find_keys(spark, path, table.schema, "station", ["hot"]).agg(F.min("n")).first()[0] == 3
    assert len(list(Path(path).iterdir())) == 3


def keys(spark, kind):
    n = F.col("id")
    key = {
        "skewed": F.when(n % 3 == 0, 7).otherwise(F.pmod(F.xxhash64("id"), F.floor(1 + n / 4) + 1)),
        "even": n % 500,
        "few": n % 3,
        "none": F.lit(None),
    }[kind]
    return spark.range(4000).select(F.when(n % 97 != 0, key).cast("string").alias("k"))


@pytest.mark.parametrize("kind", ["skewed", "even", "few", "none"])
@pytest.mark.parametrize("cells", [1, 16, 1 << 16])
def test_busiest_keys_are_exact(spark, kind, cells):
    table = keys(spark, kind)
    expected = [tuple(r) for r in quality.top_stations(table, 5, "k").collect()]
    assert [tuple(r) for r in busiest_keys(table, 5, "k", cells=cells).collect()] == expected


def test_busiest_keys_from_cells_stored_by_day(spark):
    table = keys(spark, "skewed").withColumn("day", F.col("k").cast("int") % 4)
    days = [key_cells(table.where(F.col("day") == d), "k") for d in range(4)]
    counts = days[0].unionByName(days[1]).unionByName(days[2]).unionByName(days[3])
    expected = quality.top_stations(table, 5, "k").collect()
    assert busiest_keys(table, 5, "k", counts=counts).collect() == expected


def feed(spark, path, *batches):
    """One file per batch, each newer than the one before."""
    for k, minutes in enumerate(batches):
        before = set(Path(path).glob("*.parquet")) if Path(path).exists() else set()
        values = [(None if m is None else START + timedelta(minutes=m), k) for m in minutes]
        spark.createDataFrame(values, "ts timestamp, n int").coalesce(1).write.mode("append").parquet(path)
        for file in set(Path(path).glob("*.parquet")) - before:
            os.utime(file, (1_700_000_000 + 60 * k,) * 2)
    return spark.read.parquet(path).schema


def test_late_rows_are_kept_apart(spark, tmp_path):
    path, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    schema = feed(spark, path, [0, 60], [1, None], [2, 59.9, 61], [])
    for _ in range(2):  # a restart adds nothing
        stream = file_stream(spark, path, schema, max_files_per_trigger=1)
        mark_late(stream, "ts", out, mark, trigger=ONCE_THROUGH).awaitTermination()
    late = sorted((r.batch_id, r.ts) for r in late_rows(spark, out, schema).collect() if r.ts is not None)
    # the second batch goes by the marks before the first one: its row of minute 1 is still in time
    assert late == [(2, START + timedelta(minutes=2))]
    assert late_rows(spark, out, schema).count() == 2 and rows_in_time(spark, out, schema).count() == 5


def test_a_batch_lost_after_its_rows_are_published_is_marked_once(spark, tmp_path, monkeypatch):
    from throngcast.streaming import late

    path, out, mark = (str(tmp_path / n) for n in ("in", "out", "mark"))
    schema = feed(spark, path, [0, 60], [1], [2], [3])
    whole = late.append_batch

    def lost(df, batch_id, target):
        if batch_id == 2:
            raise OSError("executor lost")
        whole(df, batch_id, target)

    monkeypatch.setattr(late, "append_batch", lost)
    with pytest.raises(Exception, match="executor lost"):
        stream = file_stream(spark, path, schema, max_files_per_trigger=1)
        mark_late(stream, "ts", out, mark, trigger=ONCE_THROUGH).awaitTermination()
    monkeypatch.setattr(late, "append_batch", whole)
    stream = file_stream(spark, path, schema, max_files_per_trigger=1)
    mark_late(stream, "ts", out, mark, trigger=ONCE_THROUGH).awaitTermination()
    assert sorted(r.ts.minute for r in late_rows(spark, out, schema).collect()) == [2, 3]
    assert rows_in_time(spark, out, schema).count() == 3


@pytest.mark.parametrize("newest_first", [False, True])
def test_one_file_a_trigger_from_the_chosen_end(spark, tmp_path, newest_first):
    path, seen = str(tmp_path / "in"), []
    schema = feed(spark, path, [0], [1], [2])
    stream = file_stream(spark, path, schema, max_files_per_trigger=1, latest_first=newest_first)
    handle = lambda batch, batch_id: seen.append((batch_id, [r.n for r in batch.collect()]))
    for_each_batch(stream, handle, str(tmp_path / "mark"), trigger=ONCE_THROUGH).awaitTermination()
    order = [2, 1, 0] if newest_first else [0, 1, 2]
    assert seen == [(k, [n]) for k, n in enumerate(order)]


def test_watermark_policy_waits_for_the_slowest_input(spark):
    assert spark.conf.get("spark.sql.streaming.multipleWatermarkPolicy") == "min"
