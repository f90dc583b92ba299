"""Keyed state per station: every change of level, in event order."""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from throngcast.plans.serving import RECENCY

LEVEL, SEVERE = "alert_level", "SEVERE"
#: A station silent for longer starts anew.
FORGET_AFTER_HOURS = 24 * 30
#: Width of the slices whose rows are compared among themselves.
SLICE = "5 minutes"
_HOUR_MICROS = 3_600_000_000


class SeverityTracker(StatefulProcessor):
    """First rows of slices on which a station turns SEVERE.

    A slice arrives once, when the watermark has passed it, so slices of one trigger are sorted and
    come after all slices before. The last level is one value. It is forgotten once the watermark is
    ``forget`` past it; as a row so much later than the one before is a first row anyway, results
    don't depend on when that happens.

    Times are microseconds, so that nothing here depends on a time zone.
    """

    def __init__(self, key: str, names: Sequence[str], forget: int):
        self.key, self.names, self.forget = key, names, forget

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.last = handle.getValueState("last", "level string, time long")

    def handleInputRows(self, key: Any, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        slices = sorted(rows, key=lambda row: row["_last_at"])
        level, at = self.last.get() if self.last.exists() else (None, None)
        for row in slices:
            if at is not None and row[RECENCY[0]] - at > self.forget:
                level = None
            if row[LEVEL] == SEVERE and level != SEVERE:
                yield Row(**{self.key: key[0]}, **{name: row[name] for name in self.names}, previous_level=level)
            level, at = row["_last_level"], row["_last_at"]
        if slices:
            self.last.update((level, at))
            self.handle.registerTimer((at + self.forget) // 1000)

    def handleExpiredTimer(self, key: Any, timerValues, expiredTimerInfo) -> Iterator[Row]:
        if self.last.exists() and self.last.get()[1] + self.forget < timerValues.getCurrentWatermarkInMs() * 1000:
            self.last.clear()
        return iter(())

    def close(self) -> None:
        pass


def escalation_stream(
    scored: DataFrame,
    *,
    lateness: str = "10 minutes",
    forget_hours: int = FORGET_AFTER_HOURS,
    key: str = "station_complex_id",
    slice_width: str = SLICE,
) -> DataFrame:
    """Streaming form of ``escalations``: rows on which a station turns SEVERE, with ``previous_level``.

    Rows are compared inside slices of a station's time, by Spark's own functions, so a station is
    shared by many tasks; keyed state sees one row per station and slice, its first one and the last
    level. A row is judged once the watermark has passed its slice; rows of slices gone by are
    dropped, and so are rows without an event time. State is one value per station, and in RocksDB
    the rows of open slices.
    """
    times = [f.name for f in scored.schema if isinstance(f.dataType, T.TimestampType)]
    order_by, forget = [*RECENCY, "congestion_score"], forget_hours * _HOUR_MICROS
    names = [*order_by, *[n for n in scored.columns if n not in (key, *order_by)]]
    timed = scored.where(F.col(RECENCY[0]).isNotNull()).withWatermark(RECENCY[0], lateness)
    slices, row = timed.groupBy(key, F.window(RECENCY[0], slice_width).alias("_slice")), F.struct(*names)

    def inside(now: Column, k: Column) -> Column:
        before = F.get("_rows", k - 1)
        gap = F.unix_micros(now[RECENCY[0]]) - F.unix_micros(before[RECENCY[0]])
        return F.struct(
            (k > 0).alias("_follows"), *[now[n].alias(n) for n in names], F.when(gap <= forget, before[LEVEL]).alias("previous_level")
        )

    def turns(r: Column) -> Column:
        return r["_follows"] & (r[LEVEL] == SEVERE) & ~r["previous_level"].eqNullSafe(SEVERE)

    listed = slices.agg(F.sort_array(F.collect_list(row)).alias("_rows"))
    within = listed.select(key, F.inline(F.filter(F.transform("_rows", inside), turns)))

    ends = slices.agg(F.min(row).alias("_first"), F.max(F.struct(*order_by, LEVEL)).alias("_last")).select(
        key,
        "_slice",
        *[(F.unix_micros(f"_first.{n}") if n in times else F.col(f"_first.{n}")).alias(n) for n in names],
        F.col(f"_last.{LEVEL}").alias("_last_level"),
        F.unix_micros(f"_last.{RECENCY[0]}").alias("_last_at"),
    )
    fields = [T.StructField(n, T.LongType() if n in times else scored.schema[n].dataType) for n in names]
    out = T.StructType([scored.schema[key], *fields, T.StructField("previous_level", T.StringType())])
    first = ends.groupBy(key).transformWithState(
        SeverityTracker(key, names, forget), out, outputMode="append", timeMode="EventTime"
    )
    first = first.select(*[F.timestamp_micros(n).alias(n) if n in times else F.col(n) for n in scored.columns], "previous_level")
    return within.select(*scored.columns, "previous_level").unionByName(first)
