"""States that merge, pages by key, and the fill by prefix scan."""

from __future__ import annotations

import re
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tests.test_physical_plans import plan_of
from throngcast.operators.history import forward_fill
from throngcast.plans import incremental, quality
from throngcast.plans.baseline import build_baseline
from throngcast.sources import paging, readers
from throngcast.sources.writers import write_parquet

DAY = date(2025, 3, 1)


@pytest.fixture
def ridership(spark, tmp_path):
    """Forty days of hours, partitioned by date; the last cell of a station has one hour only."""
    path = str(tmp_path / "ridership")
    hours = spark.range(40 * 24 * 6).selectExpr(
        "date_add(DATE'2025-03-01', CAST(id DIV 144 AS INT)) AS date",
        "timestampadd(HOUR, CAST(id % 24 AS INT), CAST(date_add(DATE'2025-03-01', CAST(id DIV 144 AS INT)) AS TIMESTAMP)) AS transit_timestamp",
        "CASE WHEN id % 97 = 0 THEN NULL ELSE CAST(id % 5 AS STRING) END AS station_complex_id",
        "CASE WHEN id % 89 = 0 THEN NULL ELSE CAST((id * 7919) % 1000 + 1e6 AS DOUBLE) END AS entries",
        "CASE WHEN id % 3 = 0 THEN 'rain' ELSE 'clear' END AS weather_bucket",
    )
    write_parquet(hours, path, partition_by=["date"])
    return path


def rounded(df):
    doubles = [n for n, t in df.dtypes if t == "double"]
    return sorted(map(tuple, df.withColumns({n: F.round(n, 5) for n in doubles}).collect()), key=repr)


@pytest.mark.parametrize(("days", "whole"), [(20, False), (90, True), (0, False)])
def test_states_give_the_baseline(spark, ridership, tmp_path, days, whole):
    stored, path = spark.read.parquet(ridership), str(tmp_path / "states")
    early = [str(DAY + timedelta(days=k)) for k in range(39)]
    incremental.add_baseline_days(stored, path, days=early)
    incremental.add_baseline_days(stored, path, days=[str(DAY + timedelta(days=39)), early[5]])  # a day written again counts once
    got = incremental.baseline_from_states(spark.read.parquet(path), lookback_days=days, max_over_all_history=whole)
    expected = build_baseline(stored, lookback_days=days, max_over_all_history=whole)
    for a, b in zip(got, expected):
        assert a.columns == b.columns and rounded(a) == rounded(b)


def test_a_new_day_reads_that_day(spark, ridership, tmp_path):
    stored = spark.read.parquet(ridership)
    added = incremental.baseline_states(stored, days=["2025-03-30"])
    assert re.search(r"PartitionFilters: \[.*date.* = 2025-03-30", plan_of(added))
    scan = added._jdf.queryExecution().executedPlan()
    assert added.count() and "2025-03-30" in scan.toString()
    path = str(tmp_path / "states")
    incremental.add_baseline_days(stored, path, days=["2025-03-30", "2025-03-31"])
    incremental.add_baseline_days(stored.where("date < DATE'2025-03-31'"), path, days=["2025-03-31"])  # nothing is left of that day
    assert [str(r.date) for r in spark.read.parquet(path).select("date").distinct().collect()] == ["2025-03-30"]
    cells, _ = incremental.baseline_from_states(spark.read.parquet(path))
    assert cells.count() > 0


def test_large_cells_have_quantiles_within_the_stated_error(spark):
    hours = spark.range(200_000).selectExpr(
        "date_add(DATE'2025-01-01', CAST(id % 50 AS INT)) AS date", "TIMESTAMP'2025-01-01 08:00:00' AS transit_timestamp",
        "'1' AS station_complex_id", "CAST((id * 7919) % 200000 AS DOUBLE) AS entries", "'clear' AS weather_bucket",
        "1 AS day_of_week", "8 AS hour_of_day",
    )
    cells, _ = incremental.baseline_from_states(incremental.baseline_states(hours))
    row = cells.first()
    assert abs(row.p95_entries / 200_000 - 0.95) < 0.014  # two standard errors
    assert row.avg_entries == pytest.approx(99_999.5) and row.std_entries == pytest.approx(57_735.17, rel=1e-6)


def test_audit_merges_days(spark, rows, tmp_path):
    n = 60_000
    staged = spark.range(n).selectExpr(
        "CASE WHEN id % 10 = 0 THEN NULL ELSE CAST(id % 20011 AS STRING) END AS station_complex_id", "CAST(id % 7 AS STRING) AS route_id",
        "timestampadd(MINUTE, CAST(id AS INT), TIMESTAMP'2025-01-01') AS event_timestamp",
        "to_date(timestampadd(MINUTE, CAST(id AS INT), TIMESTAMP'2025-01-01')) AS event_date",
    )
    path = str(tmp_path / "audit")
    incremental.add_audit_days(staged, path, ["station_complex_id", "route_id"])
    for bounds in ((None, None), ("2025-01-03", "2025-01-20")):
        got = incremental.audit_vehicles_from_states(incremental.read_states(spark, path, *bounds)).first()
        part = staged if bounds[0] is None else staged.where(F.col("event_date").between(*[F.lit(b).cast("date") for b in bounds]))
        exact = quality.audit_vehicles(part).first()
        for name in exact.asDict():
            if name == "distinct_stations":
                assert abs(got[name] / exact[name] - 1) < 0.05  # three standard errors
            else:
                assert got[name] == exact[name]
    few = incremental.read_states(spark, path, "2025-01-03", "2025-01-04")
    assert re.search(r"PartitionFilters: \[.*2025-01-0", plan_of(few))
    nothing = incremental.audit_vehicles_from_states(incremental.read_states(spark, path, "2030-01-01")).first()
    assert (nothing["rows"], nothing["distinct_stations"], nothing["null_station_complex_id_pct"]) == (0, 0, None)


# --- pages -------------------------------------------------------------------


@pytest.fixture
def ordered(spark, tmp_path):
    """Rows with ties and a null time, in eight files."""
    df = spark.range(4000).selectExpr(
        "CASE WHEN id % 1000 = 1 THEN NULL ELSE timestampadd(MINUTE, CAST((id * 7919) % 4000 DIV 40 AS INT), TIMESTAMP'2025-01-01') END AS ts", "id", "id * 2 AS v"
    )
    path = str(tmp_path / "ordered")
    paging.write_clustered(df, path, ["ts", "id"], files=8)
    return df, path


@pytest.mark.parametrize("since", [None, "2025-01-01 00:00:00", "2025-01-01 00:33:00", "2025-01-01 01:05:30", "2026-01-01 00:00:00"])
@pytest.mark.parametrize(("offset", "limit"), [(0, 50), (130, 700), (1900, 2500), (9000, 10)])
def test_pages_equal_the_extract(spark, ordered, since, offset, limit):
    df, path = ordered
    order = ["ts", "id"]
    got = paging.read_page(spark, path, ["ts", "id", "v"], order, since=since, limit=limit, offset=offset)
    expected = readers.incremental_extract(df, ["ts", "id", "v"], order, since=since, limit=limit, offset=offset)
    assert got.collect() == expected.collect()


def test_a_page_reads_its_files_only(spark, ordered):
    _, path = ordered
    plan = plan_of(paging.read_page(spark, path, ["id"], ["ts", "id"], limit=20, offset=1500))
    low, high = (
        datetime.fromisoformat(re.search(rf"PushedFilters: .*{side}\(ts,([^)]*)\)", plan)[1].rstrip("Z"))
        for side in ("GreaterThanOrEqual", "LessThanOrEqual")
    )
    ranges = spark.read.parquet(f"{path}/ranges").collect()
    read = [r for r in ranges if r["last"]["ts"] >= low and (r["first"]["ts"] is None or r["first"]["ts"] <= high)]
    assert len(ranges) == 8 and len(read) <= 3  # the page's file, and neighbours that end or begin at the same time


# --- forward fill ------------------------------------------------------------


def filled(values):
    out, last = [], {}
    for key, *row in sorted(values, key=lambda r: (r[0] is not None, r[0])):
        for k, v in enumerate(row):
            last[k] = v if v is not None else last.get(k)
        out.append((key, *[last[k] for k in range(len(row))]))
    return out


@pytest.mark.parametrize(
    ("kind", "key"),
    [
        ("date", lambda k: date(1969, 1, 1) + timedelta(days=k * k % 9973)), ("bigint", lambda k: (k - 300) * 10**15 + k),
        ("int", lambda k: k * 7001 - 2_000_000_000), ("timestamp", lambda k: datetime(1960, 5, 1) + timedelta(minutes=53 * k)),
    ],
)
def test_fill_by_prefix_scan(rows, kind, key):
    keys = list(dict.fromkeys(key(k) for k in range(600)))
    values = [(x, k if k % 41 == 7 else None, str(k) if 300 < k < 310 else None) for k, x in enumerate(keys)]
    values.append((None, -1 if kind == "date" else None, None))  # a null comes before all
    df = rows(f"t {kind}, a int, b string", *values)
    got = forward_fill(df.repartition(7), ["a", "b"], "t")
    assert got.columns == ["t", "a", "b"]
    assert sorted(map(tuple, got.collect()), key=lambda r: (r[0] is not None, r[0])) == filled(values)


def test_fill_has_no_single_task(spark, rows):
    df = spark.range(100).selectExpr("date_add(DATE'2020-01-01', CAST(id AS INT)) AS d", "IF(id % 9 = 0, id, NULL) AS v")
    assert "SinglePartition" not in plan_of(forward_fill(df, ["v"], "d"))
    assert forward_fill(df.limit(0), ["v"], "d").count() == 0
    with pytest.raises(ValueError, match="partition_by"):
        forward_fill(rows("t string, v int", ("a", 1)), ["v"], "t")
