"""Exact quantiles of an integer column, interpolated or as one of its values."""

from __future__ import annotations

from collections.abc import Mapping
from decimal import Decimal

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

LOW_BITS = 16


def exact_quantiles(
    df: DataFrame, column: str, probabilities: Mapping[str, float], *, discrete: bool = False
) -> DataFrame:
    """One row with an exact, linearly interpolated quantile per name.

    ``discrete`` gives the smallest value that at least this share of the rows does not exceed
    instead; its rank is found in decimals. The column is a 32-bit integer. Rows are counted per value in one distributed
    pass. The counts are then summed by the high half of the value, which locates the
    half-word each wanted rank falls in, and only that half-word is ranked value by
    value. No ranking step holds more than 65,536 counters per quantile, however many
    rows or distinct values there are.
    """
    value = F.col(column).cast("int")
    coded = (
        df.where(value.isNotNull())
        .groupBy(value.alias("_value"))
        .agg(F.count(F.lit(1)).alias("_n"))
        .withColumn("_high", F.shiftright("_value", LOW_BITS))
    )

    running = Window.orderBy("_high").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    everything = Window.orderBy("_high").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    high = (
        coded.groupBy("_high")
        .agg(F.sum("_n").alias("_n"))
        .withColumns({"_upto": F.sum("_n").over(running), "_all": F.sum("_n").over(everything)})
    )

    def place(p: float):
        if discrete:
            return F.greatest(F.ceil(F.lit(Decimal(str(p))) * F.col("_all")).cast("bigint") - 1, F.lit(0))
        return F.lit(float(p)) * (F.col("_all") - 1)

    wanted = [
        F.struct(
            F.lit(name).alias("name"),
            F.lit(part).alias("part"),
            part_of(place(p)).cast("bigint").alias("rank"),
            place(p).cast("double").alias("position"),
        )
        for name, p in probabilities.items()
        for part, part_of in (("below", F.floor), ("above", F.ceil))
    ]
    targets = (
        high.withColumn("_want", F.explode(F.array(*wanted)))
        .select("_high", (F.col("_upto") - F.col("_n")).alias("_before"), "_n", "_want.*")
        .where((F.col("rank") >= F.col("_before")) & (F.col("rank") < F.col("_before") + F.col("_n")))
        .select("_high", "name", "part", "position", (F.col("rank") - F.col("_before")).alias("_rank"))
    )

    # At most two rows per quantile, so broadcasting them is safe at any scale.
    halves = F.broadcast(targets.select("_high").distinct())
    inside = Window.partitionBy("_high").orderBy("_value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    low = coded.join(halves, "_high", "left_semi").withColumn("_upto", F.sum("_n").over(inside))
    found = low.join(F.broadcast(targets), "_high").where(
        (F.col("_rank") < F.col("_upto")) & (F.col("_rank") >= F.col("_upto") - F.col("_n"))
    )

    def quantile(name: str):
        def pick(part: str, field: str):
            return F.max(F.when((F.col("name") == name) & (F.col("part") == part), F.col(field)))

        below, above = pick("below", "_value"), pick("above", "_value")
        position = pick("below", "position")
        return (below + (above - below) * (position - F.floor(position))).alias(name)

    return found.agg(*[quantile(name) for name in probabilities])
