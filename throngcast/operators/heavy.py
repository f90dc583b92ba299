"""Busiest keys without a count of every key.

Rows are counted per cell, a hash of the key, of which there is a fixed number. A cell's count is a
bound on the count of each of its keys, so the answer lies in the cells that hold as many rows as
the n-th busiest key found so far, and only keys of those are counted one by one. Cell counts add
up, so they may be stored per day and summed.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Cells, and with them what a task hands over and what is broadcast (16 bytes a cell).
CELLS = 1 << 16


def _cell(key: str, cells: int) -> Column:
    return F.pmod(F.xxhash64(F.col(key)), F.lit(cells)).alias("cell")


def key_cells(df: DataFrame, key: str, *, cells: int = CELLS) -> DataFrame:
    """``cell, rows`` of the rows with a key."""
    return df.where(F.col(key).isNotNull()).groupBy(_cell(key, cells)).agg(F.count(F.lit(1)).alias("rows"))


def _counted(df: DataFrame, key: str, cells: int, held: DataFrame) -> DataFrame:
    """Exact rows of the keys in the given cells, at most ``cells`` of them."""
    keyed = df.where(F.col(key).isNotNull()).select(key, _cell(key, cells))
    inside = keyed.join(F.broadcast(held.select("cell")), "cell", "left_semi")
    return inside.groupBy(key).agg(F.count(F.lit(1)).alias("rows"))


def busiest_keys(df: DataFrame, n: int = 20, key: str = "station_complex_id", *, cells: int = CELLS, counts: DataFrame | None = None) -> DataFrame:
    """The ``n`` keys with most rows, ties by key: exact for every distribution of keys.

    ``counts`` are the summed cells of the same rows where they are at hand. The ``n`` fullest cells
    hold ``n`` keys at least; the count of the n-th of them bounds the cells worth counting. With
    even keys all cells are, and the work is that of a plain count.
    """
    cell_rows = key_cells(df, key, cells=cells) if counts is None else counts.groupBy("cell").agg(F.sum("rows").alias("rows"))
    fullest = cell_rows.orderBy(F.desc("rows"), "cell").limit(n)
    known = _counted(df, key, cells, fullest).orderBy(F.desc("rows"), key).limit(n)
    floor = known.agg(F.when(F.count(F.lit(1)) == n, F.min("rows")).otherwise(F.lit(0)).alias("floor"))
    worth = cell_rows.where(F.col("rows") >= floor.scalar())
    return _counted(df, key, cells, worth).orderBy(F.desc("rows"), key).limit(n)
