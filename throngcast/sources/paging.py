"""Pages of a table in order, each read from the files that hold it.

``write_clustered`` sorts a table into files of neighbouring ranges and notes each file's first and
last key and its rows. ``read_page`` finds the files of a page there; the rest are skipped by their
statistics, however far into the table the page lies.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F


def write_clustered(df: DataFrame, path: str, order_by: Sequence[str], *, files: int) -> None:
    """Write the table as about ``files`` files in order, and the list of their ranges."""
    df.repartitionByRange(files, *order_by).sortWithinPartitions(*order_by).write.mode("overwrite").parquet(f"{path}/data")
    key = F.struct(*order_by)
    stored = df.sparkSession.read.schema(df.schema).parquet(f"{path}/data")
    ranges = stored.groupBy(F.input_file_name().alias("file")).agg(
        F.min(key).alias("first"), F.max(key).alias("last"), F.count(F.lit(1)).alias("rows")
    )
    ranges.write.mode("overwrite").parquet(f"{path}/ranges")


def _literal(row, schema) -> Column:
    """A key as a constant; a null field keeps its type."""
    return F.struct(*[F.lit(row[f.name]).cast(f.dataType).alias(f.name) for f in schema])


def _between(order_by: Sequence[str], schema, low, high) -> Column:
    """Keys from ``low`` to ``high``. The first column is compared on its own too, for the files' statistics."""
    key, lead = F.struct(*order_by), order_by[0]
    inside = (key >= _literal(low, schema)) & (key <= _literal(high, schema))
    if low[lead] is None or high[lead] is None:
        return inside
    return inside & (F.col(lead) >= F.lit(low[lead])) & (F.col(lead) <= F.lit(high[lead]))


def read_page(
    spark: SparkSession,
    path: str,
    columns: Sequence[str],
    order_by: Sequence[str],
    *,
    since: str | None = None,
    limit: int,
    offset: int = 0,
) -> DataFrame:
    """Rows ``offset`` to ``offset + limit`` of those at or after ``since``, in order.

    The same rows as ``incremental_extract``. The list of ranges has one row per file; from it
    comes the range of keys that holds the page, and only the file in which ``since`` falls is read
    to count the rows before it.
    """
    stored = spark.read.parquet(f"{path}/data")
    ranges = spark.read.parquet(f"{path}/ranges")
    lead, schema = order_by[0], ranges.schema["first"].dataType
    skipped = 0
    if since is not None:
        moment = F.lit(since).cast("timestamp")
        late = F.col(f"last.{lead}") >= moment
        early = F.coalesce(F.col(f"first.{lead}") < moment, F.lit(True))
        counted = ranges.agg(
            F.coalesce(F.sum(F.when(~F.coalesce(late, F.lit(False)), F.col("rows"))), F.lit(0)).alias("before"),
            F.min(F.when(late & early, F.col("first"))).alias("low"),
            F.max(F.when(late & early, F.col("last"))).alias("high"),
        ).first()
        skipped = counted["before"]
        if counted["high"] is not None:
            straddling = stored.where(_between(order_by, schema, counted["low"], counted["high"]))
            skipped += straddling.where(F.coalesce(F.col(lead) < moment, F.lit(True))).count()
    upto = Window.orderBy("first", "last", "file").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    begins = F.sum("rows").over(upto) - F.col("rows")
    begin, end = skipped + offset, skipped + offset + limit
    holding = ranges.withColumn("begins", begins).where((F.col("begins") < end) & (F.col("begins") + F.col("rows") > begin))
    found = holding.agg(F.min("first").alias("low"), F.max("last").alias("high"), F.min("begins").alias("begins")).first()
    if found["low"] is None:
        return stored.select(*columns).limit(0)
    page = stored.where(_between(order_by, schema, found["low"], found["high"]))
    return page.select(*columns).orderBy(*order_by).offset(begin - found["begins"]).limit(limit)
