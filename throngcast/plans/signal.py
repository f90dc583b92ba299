"""Rolling arrival delay per station from vehicle positions and trip delays."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from throngcast.operators.intervals import interval_join, time_slot
from throngcast.operators.sliding import sliding_average

# Watermark, join bound, window and slide in seconds.
WATERMARK_SECS = 300
JOIN_BOUND_SECS = 300
WINDOW_SECS = 600
SLIDE_SECS = 30


def usable_vehicles(vehicles: DataFrame) -> DataFrame:
    return vehicles.where(F.col("station_complex_id").isNotNull()).select(
        "trip_id", "stop_id", "station_complex_id", F.col("event_timestamp").alias("vehicle_timestamp")
    )


def usable_delays(delays: DataFrame) -> DataFrame:
    return delays.where(F.col("arrival_delay_secs").isNotNull()).select(
        "trip_id",
        "stop_id",
        F.col("arrival_delay_secs").cast("double").alias("arrival_delay_secs"),
        F.col("event_timestamp").alias("trip_timestamp"),
    )


def vehicle_delay_pairs(vehicles: DataFrame, delays: DataFrame) -> DataFrame:
    """Every vehicle report with every delay of its trip and stop within five minutes."""
    return interval_join(
        usable_vehicles(vehicles),
        usable_delays(delays),
        ["trip_id", "stop_id"],
        "vehicle_timestamp",
        "trip_timestamp",
        within_secs=JOIN_BOUND_SECS,
    )


def delay_signal(vehicles: DataFrame, delays: DataFrame) -> DataFrame:
    """Average delay per station over sliding windows of vehicle time, labelled by window end.

    Equal rows are counted before the join. Feeds stamp whole seconds, so a trip and
    stop contributes at most one weighted row per second and side, however often it is
    polled or however hot it is, and the join stays linear in the data.
    """
    reports = (
        usable_vehicles(vehicles)
        .groupBy("trip_id", "stop_id", "station_complex_id", "vehicle_timestamp")
        .agg(F.count(F.lit(1)).alias("reports"))
    )
    announced = (
        usable_delays(delays)
        .groupBy("trip_id", "stop_id", "trip_timestamp")
        .agg(F.sum("arrival_delay_secs").alias("delay_sum"), F.count(F.lit(1)).alias("delays"))
    )
    pairs = interval_join(
        reports,
        announced,
        ["trip_id", "stop_id"],
        "vehicle_timestamp",
        "trip_timestamp",
        within_secs=JOIN_BOUND_SECS,
    )
    return sliding_average(
        pairs,
        ["station_complex_id"],
        "vehicle_timestamp",
        F.col("delay_sum") * F.col("reports"),
        F.col("delays") * F.col("reports"),
        window_secs=WINDOW_SECS,
        slide_secs=SLIDE_SECS,
        value_column="avg_arrival_delay_secs",
    )


def delay_pairs_stream(vehicles: DataFrame, delays: DataFrame, *, slots: bool = False) -> DataFrame:
    """The pairs of two streams; state is dropped once both watermarks pass the bound.

    Trip and stop are a fine key: one vehicle at one place, with the rows of some minutes in state.
    But a row is compared with all rows of its key, and a trigger that catches up on days holds them
    all: its time grows with the square of a key's rows. For such a trigger, or a hot key, ``slots``
    puts the five-minute slot into the key as the batch form does, so a row meets rows of its own
    time only. A delay is then kept in the slots around its own: three times that side's state.
    """
    lag = f"{WATERMARK_SECS} seconds"
    left, right, keys = usable_vehicles(vehicles), usable_delays(delays), ["trip_id", "stop_id"]
    if slots:
        near = time_slot(F.col("trip_timestamp"), JOIN_BOUND_SECS)
        left = left.withColumn("slot", time_slot(F.col("vehicle_timestamp"), JOIN_BOUND_SECS))
        right = right.withColumn("slot", F.explode(F.array(near - 1, near, near + 1)))
        keys.append("slot")
    left = left.withWatermark("vehicle_timestamp", lag).alias("v")
    right = right.withWatermark("trip_timestamp", lag).alias("d")
    bound = F.expr(f"INTERVAL {JOIN_BOUND_SECS} SECONDS")
    reported, announced = F.col("v.vehicle_timestamp"), F.col("d.trip_timestamp")
    same_key = [F.col(f"v.{name}") == F.col(f"d.{name}") for name in keys]
    return left.join(right, [*same_key, announced.between(reported - bound, reported + bound)]).select(
        "v.trip_id",
        "v.stop_id",
        "station_complex_id",
        "vehicle_timestamp",
        "arrival_delay_secs",
        "trip_timestamp",
    )


def delay_signal_stream(vehicles: DataFrame, delays: DataFrame, *, slots: bool = False) -> DataFrame:
    """The signal of two streams: interval join, sums per slide, then windows over the sums.

    Only the sums, one row per station and slide, are copied into the windows that cover them.
    In append mode a window is emitted when later rows have moved the watermark past its end; the
    last windows of a feed that falls silent stay open.
    """
    slide = f"{SLIDE_SECS} seconds"
    sums = (
        delay_pairs_stream(vehicles, delays, slots=slots)
        .groupBy(F.window("vehicle_timestamp", slide).alias("slide"), "station_complex_id")
        .agg(F.sum("arrival_delay_secs").alias("total"), F.count(F.lit(1)).alias("pairs"))
    )
    window = F.window("slide", f"{WINDOW_SECS} seconds", slide)
    return (
        sums.groupBy(window.alias("window"), "station_complex_id")
        .agg((F.sum("total") / F.sum("pairs")).alias("avg_arrival_delay_secs"))
        .select("station_complex_id", F.col("window.end").alias("event_timestamp"), "avg_arrival_delay_secs")
    )
