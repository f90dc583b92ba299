"""Triggers that read days of a feed at once."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from tests.test_streams import Feed, delay, vehicle
from throngcast.catalog import registry


def state_gets(query) -> int:
    """Look-ups in the state of the join."""
    operators = [op for p in query.recentProgress for op in p["stateOperators"] if op["operatorName"] == "symmetricHashJoin"]
    return sum(op["customMetrics"]["rocksdbGetCount"] for op in operators)


def test_a_long_feed_of_one_trip_is_joined_in_linear_time(spark, tmp_path):
    gets = []
    for n in (300, 600):
        feed = Feed(spark, tmp_path / str(n))
        feed.add([vehicle(7 * k) for k in range(n)], [delay(7 * k, 60) for k in range(n)])
        gets.append(state_gets(feed.run(slots=True)))
    assert 0 < gets[1] < 2.5 * gets[0]


@pytest.mark.parametrize("name, owner, step", [
    ("stream_interval_join", registry.signals, "delay_pairs_stream"),
    ("stream_delay_signal", registry.jobs, "delay_signal_stream"),
    ("stream_score_foreachbatch", registry.jobs, "delay_signal_stream"),
])
def test_queries_over_a_whole_feed_ask_for_slots(spark, monkeypatch, name, owner, step):
    class Seen(Exception):
        pass

    def record(*frames, **options):
        assert options.get("slots")
        raise Seen

    monkeypatch.setattr(registry, "_staged", lambda spark, d: (d + "/events.parquet", d + "/events.parquet"))
    monkeypatch.setattr(owner, step, record)
    with pytest.raises(Seen):
        registry.QUERIES[name](spark, "/root/testdata/sf0.001")


def test_frames_in_turn_are_written_in_parallel_and_read_a_trigger_each(spark, tmp_path):
    parts = [spark.range(0, 4000, 1, 4), spark.range(4000, 4003), spark.range(0), spark.range(5000, 9000, 1, 2)]
    feed, seen, largest = registry._files_in_turn(spark, "in-turn", *parts), [], []

    def handle(batch, batch_id):
        seen.append(sorted(r.id for r in batch.collect()))
        largest.append(max((r["count"] for r in batch.groupBy(F.input_file_name()).count().collect()), default=0))

    feed = feed.writeStream.foreachBatch(handle).option("checkpointLocation", str(tmp_path)).trigger(availableNow=True)
    feed.start().awaitTermination()
    assert seen == [list(range(4000)), [4000, 4001, 4002], [], list(range(5000, 9000))]
    assert max(largest) < 400  # no task writes or reads a frame as a whole
