"""Equi-join with a two-sided time bound."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MICROS = 1_000_000


def time_slot(moment: Column, width_secs: int) -> Column:
    """Index of the fixed-width slot a timestamp falls in."""
    return F.floor(F.unix_micros(moment) / F.lit(width_secs * MICROS))


def interval_join(
    left: DataFrame,
    right: DataFrame,
    on: Sequence[str],
    left_time: str,
    right_time: str,
    *,
    within_secs: int = 300,
) -> DataFrame:
    """Every pair with equal keys and times at most ``within_secs`` apart, ends included.

    The slot of the time joins the key, with the right side copied to the slot
    before and after its own. A hot key is thereby spread over as many join keys
    as it has slots, and a row meets only rows of its own time. ``left`` and
    ``right`` share no column names besides ``on``.
    """
    slot = "_slot"
    own = left.withColumn(slot, time_slot(F.col(left_time), within_secs))
    near = right.withColumn(slot, time_slot(F.col(right_time), within_secs)).withColumn(
        slot, F.explode(F.array(F.col(slot) - 1, F.col(slot), F.col(slot) + 1))
    )
    gap = F.unix_micros(F.col(right_time)) - F.unix_micros(F.col(left_time))
    bound = within_secs * MICROS
    return own.join(near, [*on, slot]).where(gap.between(-bound, bound)).drop(slot)
