"""One-pass column profile of a raw text table."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from throngcast.functions.text import strip_blank

NUMBER = r"(?i)^[+-]?((\d+\.?\d*|\.\d+)(e[+-]?\d+)?|nan|inf(inity)?)$"


def profile_columns(df: DataFrame) -> DataFrame:
    """Rows, blanks and numeric range per column.

    A range is given only when every non-blank value of the column is a number.
    """
    measures = []
    for name in df.columns:
        text = strip_blank(F.col(f"`{name}`").cast("string"))
        filled = F.nullif(text, F.lit(""))
        number = F.when(filled.rlike(NUMBER), filled.try_cast("double"))
        measures.append(
            F.struct(
                F.lit(name).alias("column_name"),
                F.count(F.lit(1)).alias("row_count"),
                F.count_if(filled.isNull()).alias("null_count"),
                F.count(filled).alias("_filled"),
                F.count(number).alias("_numbers"),
                F.min(number).alias("_min"),
                F.max(number).alias("_max"),
            )
        )
    whole = F.col("_filled") == F.col("_numbers")
    return (
        df.agg(F.array(*measures).alias("_columns"))
        .select(F.inline("_columns"))
        .select(
            "column_name",
            "row_count",
            "null_count",
            F.when(whole, F.col("_min")).alias("numeric_min"),
            F.when(whole, F.col("_max")).alias("numeric_max"),
        )
    )


def sample_rows(df: DataFrame, n: int = 5, order_by: Sequence[str] = ()) -> DataFrame:
    """The first ``n`` rows, in the given order when one is named."""
    return (df.orderBy(*order_by) if order_by else df).limit(n)
