from __future__ import annotations

import contextlib
import io
import re
from collections import Counter
from pathlib import Path

import pytest
from pyspark.sql import functions as F

from throngcast.catalog import adapters as A
from throngcast.catalog.registry import QUERIES
from throngcast.plans.baseline import lookback
from throngcast.sources.writers import write_parquet
from tests.conftest import SF_DIR

LIBRARY = Path(__file__).parents[1] / "throngcast"


def plan_of(df) -> str:
    text = io.StringIO()
    with contextlib.redirect_stdout(text):
        df.explain("formatted")
    return text.getvalue()


@pytest.mark.parametrize("name", [name for name in QUERIES if not name.startswith("stream_")])
def test_no_pairwise_or_python_operators(spark, name):
    plan = plan_of(QUERIES[name](spark, SF_DIR))
    for operator in ("CartesianProduct", "BroadcastNestedLoopJoin", "EvalPython", "InPandas", "InArrow"):
        assert operator not in plan


def test_library_stays_on_the_cluster():
    banned = re.compile(
        r"\.collect\(|toPandas|crossJoin|localCheckpoint|\budf\(|pandas_udf|\.toLocalIterator|mapPartitions|SparkContext\."
        r"|\.rdd\b|tempfile|defaultParallelism"
    )
    # the optional training-data operators are checked by tests of their own
    for path in (p for p in LIBRARY.rglob("*.py") if p.parent.name != "llm"):
        assert not banned.search(path.read_text()), path


def test_only_needed_columns_and_rows_are_read(spark):
    plan = plan_of(QUERIES["station_history"](spark, SF_DIR))
    assert re.search(r"ReadSchema: struct<event_id:bigint,ts:timestamp_ntz,user_id:bigint,value:double>", plan)
    vehicles = plan_of(A.vehicle_messages(A.events(spark, SF_DIR)))
    assert re.search(r"PushedFilters: \[.*event_type", vehicles) and "value:double" not in vehicles


def test_lookback_prunes_partitions(spark, tmp_path):
    path = str(tmp_path / "t")
    dated = spark.range(30).select(F.date_add(F.lit("2025-01-01").cast("date"), F.col("id").cast("int")).alias("date"), "id")
    write_parquet(dated, path, partition_by=["date"])
    recent = lookback(spark.read.parquet(path), 3)
    assert recent.count() == 4
    filters = re.findall(r"PartitionFilters: \[(.*)\]", plan_of(recent))
    assert any("date_sub" in text for text in filters)


def test_payloads_are_parsed_once(spark):
    for name in ("delay_signal", "route_messages", "classify_observation"):
        nodes = [line for line in plan_of(QUERIES[name](spark, SF_DIR)).splitlines() if "from_json" in line]
        assert not any(line.lstrip().startswith("Condition") for line in nodes)


def test_reductions_precede_shuffles(spark):
    plan = plan_of(QUERIES["latest_per_station"](spark, SF_DIR))
    assert "partial_max" in plan and "Window" not in plan
    plan = plan_of(QUERIES["alerts"](spark, SF_DIR))
    assert plan.index("partial_max") > 0


@pytest.mark.parametrize("name", ["clean_ridership", "enrich_vehicles", "parse_trip_updates", "trip_delays", "score_congestion"])
def test_one_plan_at_every_size(spark, name):
    """Apart from the kind of join, which Spark chooses by size, plans are the same."""

    def operators(sf_dir):
        nodes = re.findall(r"^\(\d+\) (\w+)", plan_of(QUERIES[name](spark, sf_dir)), re.M)
        return Counter(n for n in nodes if not re.search("Join|Exchange|Sort", n))

    assert operators(SF_DIR) == operators(SF_DIR.replace("sf0.001", "sf0.1"))


def test_tiers_are_read_off_one_pass(spark):
    whole = plan_of(QUERIES["bridge_tiered"](spark, SF_DIR))
    for name in ("matched_keys", "bridge_unresolved", "bridge_tier3_geo"):
        assert plan_of(QUERIES[name](spark, SF_DIR)).count("Scan parquet") <= whole.count("Scan parquet")


def test_distinct_counts_do_not_copy_rows(spark):
    assert "Expand" not in plan_of(QUERIES["audit_vehicles"](spark, SF_DIR))
