"""Scheduled arrivals by trip and by trip prefix."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from throngcast.functions.text import clock_to_seconds, realtime_trip_id, schedule_prefix


def schedule_full(stop_times: DataFrame) -> DataFrame:
    """Arrival second per live trip id and stop; rows without a time are left out."""
    return stop_times.where(F.col("arrival_time") != "").select(
        realtime_trip_id(F.col("trip_id")).alias("trip_id_suffix"),
        F.col("stop_id"),
        clock_to_seconds(F.col("arrival_time")).alias("sched_arr_secs"),
    )


def schedule_by_prefix(full: DataFrame) -> DataFrame:
    """Median arrival second, cut to whole seconds, over the runs of a prefix.

    Runs are counted per second of the service day first, and the middle is found in the running
    counts: exact for any number of runs, with no more rows than seconds to order per prefix and
    stop. ``median`` would keep a map per prefix and stop, of which a schedule has very many.
    """
    keys, secs = ["prefix", "stop_id"], F.col("sched_arr_secs")
    counted = full.groupBy(schedule_prefix(F.col("trip_id_suffix")).alias("prefix"), "stop_id", secs).agg(
        F.count(secs).alias("_n")
    )
    own = Window.partitionBy(*keys)
    running = own.orderBy("sched_arr_secs").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = counted.withColumns({"_upto": F.sum("_n").over(running), "_all": F.sum("_n").over(own)})

    def at(rank: Column) -> Column:
        return F.max(F.when((rank < F.col("_upto")) & (rank >= F.col("_upto") - F.col("_n")), secs))

    lower, upper = at(F.floor((F.col("_all") - 1) / 2)), at(F.floor(F.col("_all") / 2))
    return ranked.groupBy(*keys).agg(((lower + upper) / 2).cast("bigint").alias("sched_arr_secs"))


def unique_schedule(full: DataFrame) -> DataFrame:
    """One arrival per trip and stop, the earliest where service days differ."""
    return full.groupBy("trip_id_suffix", "stop_id").agg(F.min("sched_arr_secs").alias("sched_arr_secs"))
