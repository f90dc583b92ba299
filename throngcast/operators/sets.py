"""Set operations by column name."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_all(*frames: DataFrame) -> DataFrame:
    return reduce(DataFrame.unionByName, frames)


def union_distinct(*frames: DataFrame) -> DataFrame:
    return union_all(*frames).distinct()


def missing_from(df: DataFrame, known: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Rows whose key does not occur in ``known``."""
    return df.join(known.select(*keys), list(keys), "left_anti")


def with_membership(df: DataFrame, known: DataFrame, keys: Sequence[str], flag: str) -> DataFrame:
    """Every row once, with whether its key occurs in ``known``."""
    members = known.select(*keys).dropna().distinct().withColumn(flag, F.lit(True))
    return df.join(members, list(keys), "left").fillna({flag: False})
