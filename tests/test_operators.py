from __future__ import annotations

import itertools
import random
from datetime import datetime, timedelta

import numpy as np
import pytest
from pyspark.sql import Window
from pyspark.sql import functions as F

from throngcast.functions.geo import haversine_meters
from throngcast.operators.dedupe import first_by_key, latest_by_key
from throngcast.operators.history import forward_fill, with_previous
from throngcast.operators.intervals import interval_join
from throngcast.operators.profile import profile_columns, sample_rows
from throngcast.operators.quantiles import exact_quantiles
from throngcast.operators.sets import missing_from, union_distinct, with_membership
from throngcast.operators.similarity import closest_name, nearest_within
from throngcast.operators.sliding import sliding_average

START = datetime(2025, 1, 1)


def edit_distance(a: str, b: str) -> int:
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        diagonal, row[0] = row[0], i
        for j, y in enumerate(b, 1):
            diagonal, row[j] = row[j], min(row[j] + 1, row[j - 1] + 1, diagonal + (x != y))
    return row[-1]


def random_names(rng, n, alphabet="abc ", longest=14):
    return sorted({"".join(rng.choices(alphabet, k=rng.randint(0, longest))) for _ in range(n)})


@pytest.mark.parametrize("threshold", [1, 4])
def test_closest_name_loses_no_pair(spark, threshold):
    rng = random.Random(threshold)
    targets = random_names(rng, 60)
    probes = random_names(rng, 80)
    for name in targets[:30]:  # near copies with a few edits
        edited = list(name)
        for _ in range(rng.randint(0, threshold + 1)):
            at = rng.randint(0, len(edited))
            edited[at : at + rng.randint(0, 1)] = rng.choices("abc ", k=rng.randint(0, 1))
        probes.append("".join(edited))
    # short names with and without a character in common
    targets = sorted({*targets, *random_names(rng, 12, "xy", 4)})
    probes = sorted({*probes, *random_names(rng, 30, "xyz", 6), *random_names(rng, 10, "é𝒳", 5)})
    found = closest_name(
        spark.createDataFrame([(p,) for p in probes], "p string"),
        spark.createDataFrame([(t, i) for i, t in enumerate(targets)], "t string, id int"),
        probe="p",
        target="t",
        payload="id",
        threshold=threshold,
        salts=3,
    )
    expected = {}
    for probe in probes:
        best = min(((edit_distance(probe, t), i) for i, t in enumerate(targets)), default=None)
        if best and best[0] <= threshold:
            expected[probe] = best
    assert {r["p"]: (r["distance"], r["id"]) for r in found.collect()} == expected


def test_short_names_without_a_common_character_are_not_compared(spark):
    """2,000 by 2,000 short names over two alphabets: each probe meets the first target of a length only."""
    letters = [[chr(ord(first) + k) for k in range(7)] for first in "ah"]
    names = [["".join(p) for p in itertools.islice(itertools.product(own, repeat=4), 2_000)] for own in letters]
    found = closest_name(
        spark.createDataFrame([(p,) for p in names[0]], "p string"),
        spark.createDataFrame([(t, i) for i, t in enumerate(names[1])], "t string, id int"),
        probe="p", target="t", payload="id", threshold=4, salts=1,
    )
    assert found.count() == 2_000 and found.where("distance <> 4 or id <> 0").isEmpty()
    rows = []
    nodes = [found._jdf.queryExecution().executedPlan()]
    found.collect()
    while nodes:
        node = nodes.pop()
        name = node.nodeName()
        if name == "AdaptiveSparkPlan":
            nodes.append(node.executedPlan())
        elif "QueryStage" in name:
            nodes.append(node.plan())
        else:
            if "Join" in name:
                rows.append(node.metrics().apply("numOutputRows").value())
            children = node.children()
            nodes += [children.apply(k) for k in range(children.size())]
    assert rows and max(rows) <= 2_000


def test_nearest_within_matches_brute_force(spark):
    rng = random.Random(5)
    around = [(40.7, -74.0), (89.9995, 10.0), (0.0, 179.9998), (-60.0, 20.0)]

    def scatter(n):
        return [
            (lat + rng.uniform(-0.002, 0.002), ((lon + rng.uniform(-0.002, 0.002)) + 180) % 360 - 180)
            for lat, lon in rng.choices(around, k=n)
        ]

    points = [(min(lat, 90.0), lon) for lat, lon in scatter(120)] + [(None, 1.0)]
    targets = [(min(lat, 90.0), lon, i) for i, (lat, lon) in enumerate(scatter(80))]
    left = spark.createDataFrame(points, "lat double, lon double")
    right = spark.createDataFrame(targets, "tlat double, tlon double, id int")
    found = nearest_within(
        left, right, point=("lat", "lon"), target=("tlat", "tlon"), payload="id", radius_m=100.0, salts=2
    )
    distance = haversine_meters(*map(F.col, ("lat", "lon", "tlat", "tlon")))
    brute = (
        left.crossJoin(right)
        .withColumn("d", distance)
        .where("d < 100")
        .groupBy("lat", "lon")
        .agg(F.min(F.struct("d", "id")).alias("b"))
        .select("lat", "lon", F.col("b.d").alias("distance"), "b.id")
    )
    assert found.exceptAll(brute).count() == 0 and brute.exceptAll(found).count() == 0
    assert brute.count() > 20


def test_interval_join_with_a_hot_key(spark):
    rng = random.Random(1)
    moments = [START + timedelta(seconds=rng.randint(0, 4000)) for _ in range(150)] + [START, START + timedelta(seconds=300)]
    left = [("hot" if i % 3 else f"k{i % 5}", t) for i, t in enumerate(moments)]
    right = [("hot" if i % 2 else f"k{i % 5}", t) for i, t in enumerate(reversed(moments))]
    joined = interval_join(
        spark.createDataFrame(left, "k string, lt timestamp"),
        spark.createDataFrame(right, "k string, rt timestamp"),
        ["k"],
        "lt",
        "rt",
    )
    expected = sorted(
        (k, a, b) for (k, a), (j, b) in itertools.product(left, right) if k == j and abs((a - b).total_seconds()) <= 300
    )
    assert sorted(map(tuple, joined.collect())) == expected


def test_interval_bounds_are_inclusive(rows):
    left = rows("k int, lt timestamp", (1, START))
    right = rows(
        "k int, rt timestamp",
        *[(1, START + timedelta(seconds=s, microseconds=u)) for s, u in ((300, 0), (-300, 0), (300, 1), (-301, 999999))],
    )
    assert interval_join(left, right, ["k"], "lt", "rt").count() == 2


def test_sliding_average_equals_window_function(spark):
    rng = random.Random(2)
    values = [("a" if rng.random() < 0.8 else "b", START + timedelta(seconds=rng.randint(0, 3000)), rng.random()) for _ in range(300)]
    df = spark.createDataFrame(values, "k string, t timestamp, v double")
    ours = sliding_average(df, ["k"], "t", F.col("v"), F.lit(1))
    theirs = (
        df.groupBy("k", F.window("t", "600 seconds", "30 seconds").alias("w"))
        .agg(F.avg("v").alias("average"))
        .select("k", F.col("w.end").alias("event_timestamp"), "average")
    )
    key = ["k", "event_timestamp"]
    both = ours.join(theirs.withColumnRenamed("average", "other"), key, "full")
    assert both.where("abs(average - other) > 1e-9 OR average IS NULL OR other IS NULL").count() == 0
    assert ours.count() == theirs.count()


def test_sliding_average_needs_whole_slides(rows):
    with pytest.raises(ValueError, match="multiple"):
        sliding_average(rows("k int", (1,)), ["k"], "t", F.lit(1), F.lit(1), window_secs=100, slide_secs=30)


@pytest.mark.parametrize("n", [1, 2, 3, 1000])
def test_exact_quantiles(spark, n):
    rng = np.random.default_rng(n)
    values = np.concatenate([rng.integers(-200_000, 200_000, n), rng.integers(0, 5, n)])
    probabilities = {"p0": 0.0, "p50": 0.5, "p95": 0.95, "p99": 0.99, "p100": 1.0}
    df = spark.createDataFrame([(int(v),) for v in values] + [(None,)], "v int")
    got = exact_quantiles(df, "v", probabilities).first().asDict()
    for name, p in probabilities.items():
        assert got[name] == pytest.approx(np.quantile(values, p), abs=1e-6)


def test_quantiles_of_nothing_are_null(rows):
    assert exact_quantiles(rows("v int", (None,)), "v", {"p50": 0.5}).first()["p50"] is None


def test_previous_across_slices_equals_plain_lag(spark):
    rng = random.Random(3)
    data = [(rng.choice("xxxxy"), START + timedelta(minutes=7 * i), rng.choice(["A", "B", None])) for i in range(200)]
    df = spark.createDataFrame(data, "k string, t timestamp, v string")
    ours = with_previous(df, ["k"], ["t"], "v", slice_by=F.date_trunc("HOUR", "t"))
    plain = df.withColumn("previous", F.lag("v").over(Window.partitionBy("k").orderBy("t")))
    assert ours.exceptAll(plain).count() == 0 and plain.exceptAll(ours).count() == 0


def test_forward_fill_keeps_leading_nulls(rows):
    df = rows("r string, d int, v double", ("a", 1, None), ("a", 2, 5.0), ("a", 3, None), ("b", 3, None), ("b", 4, 1.0))
    one = {(r.r, r.d): r.v for r in forward_fill(df, ["v"], "d", partition_by=["r"]).collect()}
    assert one == {("a", 1): None, ("a", 2): 5.0, ("a", 3): 5.0, ("b", 3): None, ("b", 4): 1.0}


def test_dedupe_orders_and_breaks_ties(rows):
    df = rows("k int, a int, b string", (1, 2, "x"), (1, 1, "z"), (1, 1, "y"), (2, None, "q"), (2, 3, "p"), (None, 1, "n"))
    first = {r.k: (r.a, r.b) for r in first_by_key(df, ["k"], ["a"]).collect()}
    assert first == {1: (1, "y"), 2: (None, "q"), None: (1, "n")}
    latest = {r.k: (r.a, r.b) for r in latest_by_key(df, ["k"], ["a"]).collect()}
    assert latest == {1: (2, "x"), 2: (3, "p"), None: (1, "n")}
    assert first_by_key(df.select("k"), ["k"]).count() == 3
    assert latest_by_key(df, ["k"], ["a"]).columns == df.columns


def test_set_operators(rows):
    df, known = rows("k string, v int", ("a", 1), ("b", 2), (None, 3)), rows("k string", ("a",), ("a",), (None,))
    assert {(r.k, r.seen) for r in with_membership(df, known, ["k"], "seen").collect()} == {("a", True), ("b", False), (None, False)}
    assert {r.v for r in missing_from(df, known, ["k"]).collect()} == {2, 3}
    assert union_distinct(known, known).count() == 2


def test_profile(rows):
    df = rows("a string, b string, c string", ("1", " ", "x"), (" 2.5 ", None, "3"), ("-1e2", "", "4"), ("nan", "7", None))
    got = {r.column_name: tuple(r)[1:] for r in profile_columns(df.where("a <> 'nan'")).collect()}
    assert got["a"] == (3, 0, -100.0, 2.5)
    assert got["b"] == (3, 3, None, None)
    assert got["c"] == (3, 0, None, None)
    assert sample_rows(df, 2, ["a"]).count() == 2


def test_discrete_quantiles_are_exact_where_sketches_are_not(spark):
    """The sketch of ``percentile_approx`` is off by up to one rank in ten thousand."""
    n = 300_000
    df = spark.range(0, n, 1, 6).select(F.pmod(F.hash("id"), F.lit(1_000_003)).alias("v"))
    values = sorted(r.v for r in df.collect())
    got = exact_quantiles(df, "v", {"low": 0.0, "p50": 0.5, "p95": 0.95, "top": 1.0}, discrete=True).first()
    assert tuple(got) == (values[0], values[n // 2 - 1], values[n * 95 // 100 - 1], values[-1])
    from throngcast.plans.quality import calibrate_service

    found = calibrate_service(df.select(F.col("v").alias("arrival_delay_secs"))).first()
    assert (found.row_count, found.p50, found.p95) == (n, values[n // 2 - 1], values[n * 95 // 100 - 1])
