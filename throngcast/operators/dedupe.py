"""One row per key under a total order.

Both operators are plain ``min``/``max`` aggregates over a struct, so rows are
reduced before the shuffle and a hot key never gathers in one task. Columns that
are not named in the order break ties, which makes the kept row reproducible.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _extreme_row(df: DataFrame, keys: Sequence[str], order_by: Sequence[str], pick) -> DataFrame:
    leading = [name for name in order_by if name not in keys]
    rest = [name for name in df.columns if name not in keys and name not in leading]
    if not leading and not rest:
        return df.select(*keys).distinct()
    kept = df.groupBy(*keys).agg(pick(F.struct(*leading, *rest)).alias("_row"))
    return kept.select(*[F.col(name) if name in keys else F.col(f"_row.{name}") for name in df.columns])


def first_by_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str] = ()) -> DataFrame:
    """Smallest row of every key; nulls sort first."""
    return _extreme_row(df, keys, order_by, F.min)


def latest_by_key(df: DataFrame, keys: Sequence[str], order_by: Sequence[str]) -> DataFrame:
    """Largest row of every key; nulls sort last."""
    return _extreme_row(df, keys, order_by, F.max)
