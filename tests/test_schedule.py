from __future__ import annotations

import random
from statistics import median

from pyspark.sql import functions as F

from throngcast.functions.times import service_day_epoch
from throngcast.plans.schedule import schedule_by_prefix


def test_prefix_medians_are_exact_and_native(rows):
    rng = random.Random(3)
    runs = [(f"{p:03}_1..N{k:02}R", f"s{s}", rng.choice([None, rng.randrange(90_000), 60])) for p in range(9) for s in range(4) for k in range(p + 1)]
    got = schedule_by_prefix(rows("trip_id_suffix string, stop_id string, sched_arr_secs int", *runs))
    expected = {}
    for trip, stop, secs in runs:
        expected.setdefault((trip[:8], stop), []).extend([] if secs is None else [secs])
    assert {(r.prefix[:8], r.stop_id): r.sched_arr_secs for r in got.collect()} == {
        key: int(median(values)) if values else None for key, values in expected.items()
    }
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "ObjectHashAggregate" not in plan and "SortAggregate" not in plan


def test_service_days_read_as_by_their_layout(rows):
    days = ["20240101", "20240229", "20230229", "20241301", "20240100", "00000101", "01000101", "99991231", "2024010", "202401011", "20240101 ", "", "x", None]
    df = rows("day string", *[(d,) for d in days])
    midnight = F.try_to_timestamp("day", F.lit("yyyyMMdd"))
    old = F.unix_seconds(F.to_utc_timestamp(midnight, "America/New_York"))
    got = df.select("day", service_day_epoch(F.col("day")).alias("new"), old.alias("old")).collect()
    assert [r.new for r in got] == [r.old for r in got] and sum(r.new is not None for r in got) >= 4
