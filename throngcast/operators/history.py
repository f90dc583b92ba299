"""Values carried along time: previous value per key and forward fill."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def with_previous(
    df: DataFrame,
    keys: Sequence[str],
    order_by: Sequence[str],
    value: str,
    *,
    slice_by: Column,
    output: str = "previous",
) -> DataFrame:
    """Value of the preceding row of the same key.

    ``slice_by`` cuts a key's history into runs that follow the order (an hour, a
    day). The window works inside a run, so a hot key is shared by many tasks; the
    last value of each run, one row per run, is carried to the start of the next.
    """
    sliced = df.withColumn("_slice", slice_by)
    inside = Window.partitionBy(*keys, "_slice").orderBy(*order_by)
    across = Window.partitionBy(*keys).orderBy("_slice")
    carried = (
        sliced.groupBy(*keys, "_slice")
        .agg(F.max(F.struct(*order_by, F.col(value).alias("_value"))).alias("_last"))
        .select(*keys, "_slice", F.lag("_last._value").over(across).alias("_carried"))
    )
    return (
        sliced.withColumns({"_first": F.row_number().over(inside) == 1, output: F.lag(value).over(inside)})
        .join(carried, [*keys, "_slice"], "left")
        .withColumn(output, F.when(F.col("_first"), F.col("_carried")).otherwise(F.col(output)))
        .drop("_slice", "_first", "_carried")
    )


#: Rows of a run that share a slice: days, microseconds and whole numbers are cut by these powers of two.
SLICE_BITS = {"date": 6, "timestamp": 32, "int": 12, "bigint": 12}
#: Slice numbers have fewer bits; places begin at one, nulls being in slice zero.
LEVELS = 62
_ORIGIN = {"date": 1 << 22, "timestamp": 1 << 58, "int": 1 << 32, "bigint": 0}


def _slice_number(df: DataFrame, order_by: str) -> Column:
    """A number that follows the order and that neighbouring rows share; zero for null."""
    kind = dict(df.dtypes)[order_by]
    if kind not in SLICE_BITS:
        raise ValueError(f"cannot slice {order_by}, a {kind}; give partition_by")
    place = {"date": F.unix_date, "timestamp": F.unix_micros}.get(kind, lambda c: c.cast("long"))(F.col(order_by))
    number = F.shiftright(place, SLICE_BITS[kind]) + F.lit((_ORIGIN[kind] >> SLICE_BITS[kind]) or 1 << 52)
    return F.coalesce(number, F.lit(0).cast("long"))


def carried_in(slices: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """For each slice, the value of each column in the nearest earlier slice that has one.

    A prefix scan by dyadic intervals. Every slice reports to the interval of each power of two that
    it lies in, and these are summed up to their latest values. All that comes before a slice is a
    union of such intervals, at most one of each size: those left of it on its path to the top. So
    a slice asks for one interval per bit of its number, and no task sees more than its share.
    """
    values = [F.max(F.when(F.col(c).isNotNull(), F.struct("_slice", c))).alias(c) for c in columns]
    levels = F.explode(F.sequence(F.lit(0), F.lit(LEVELS))).alias("_level")
    nodes = (
        slices.select(*keys, "_slice", *columns, levels)
        .groupBy(*keys, "_level", F.expr("shiftright(_slice, _level)").alias("_node"))
        .agg(*values)
    )
    asked = (
        slices.select(*keys, "_slice", levels)
        .where(F.expr("shiftright(_slice, _level) % 2 = 1"))
        .select(*keys, F.col("_slice").alias("_asking"), "_level", F.expr("shiftright(_slice, _level) - 1").alias("_node"))
    )
    latest = [F.max(c)[c].alias(f"_carried_{k}") for k, c in enumerate(columns)]
    return asked.join(nodes, [*keys, "_level", "_node"]).groupBy(*keys, F.col("_asking").alias("_slice")).agg(*latest)


def forward_fill(
    df: DataFrame, columns: Sequence[str], order_by: str, *, partition_by: Sequence[str] = ()
) -> DataFrame:
    """Replace nulls by the last known value; leading nulls stay.

    With ``partition_by`` each run is filled by one window. Without it the frame is one ordered run
    of any length: it is cut into slices along ``order_by`` (a date, timestamp or whole number), the
    windows work inside slices, and the value from before a slice is carried in by a prefix scan.
    """
    order = Window.partitionBy(*partition_by, *([] if partition_by else ["_slice"])).orderBy(order_by)
    frame = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = {name: F.last(name, ignorenulls=True).over(frame) for name in columns}
    if partition_by:
        return df.withColumns(filled)
    sliced = df.withColumn("_slice", _slice_number(df, order_by))
    last = [F.max(F.when(F.col(c).isNotNull(), F.struct(order_by, F.col(c).alias("_v"))))["_v"].alias(c) for c in columns]
    carried = carried_in(sliced.groupBy("_slice").agg(*last), [], columns)
    own = {name: F.coalesce(F.col(name), F.col(f"_carried_{k}")) for k, name in enumerate(columns)}
    return sliced.withColumns(filled).join(carried, "_slice", "left").withColumns(own).select(*df.columns)
