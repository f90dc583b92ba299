"""Timestamp parsing, service-day arithmetic and age labels."""

from __future__ import annotations

import re
from collections.abc import Sequence
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Accepted timestamp layouts, tried in this order.
TIMESTAMP_FORMATS = (
    "yyyy-MM-dd'T'HH:mm:ss.SSS",
    "yyyy-MM-dd'T'HH:mm:ss",
    "MM/dd/yyyy hh:mm:ss a",
    "MM/dd/yyyy HH:mm:ss",
    "yyyy-MM-dd HH:mm:ss",
)
LOCAL_TIMEZONE = "America/New_York"
STALE_AFTER_SECS = 90
NO_AGE = "—"


def _can_have_layout(text: Column, layout: str) -> Column:
    """Whether a text has every literal of a layout.

    A parser that fails on a row raises and catches an exception, which costs far more
    than looking for a few characters.
    """
    literals = set(re.sub(r"'([^']*)'|[A-Za-z]", lambda token: token.group(1) or "", layout))
    present = [F.contains(text, F.lit(literal)) for literal in sorted(literals)]
    if layout.endswith("a"):
        present.append(text.rlike(r"(?i)[ap]m"))
    return reduce(Column.__and__, present)


def parse_timestamp(text: Column, formats: Sequence[str] = TIMESTAMP_FORMATS) -> Column:
    """First layout that parses, then Spark's own reading; null when none does."""
    attempts = [
        F.when(_can_have_layout(text, layout), F.try_to_timestamp(text, F.lit(layout))) for layout in formats
    ]
    return F.coalesce(*attempts, F.try_to_timestamp(text))


def parse_iso(text: Column) -> Column:
    """ISO-8601 text to an instant; text without an offset is read as UTC."""
    return F.try_to_timestamp(F.nullif(F.trim(text), F.lit("")))


def event_time(epoch_secs: Column, arrival: Column) -> Column:
    """Producer time when present, else the arrival time of the message."""
    return F.coalesce(F.timestamp_seconds(epoch_secs), arrival)


def service_day_epoch(service_date: Column, tz: str = LOCAL_TIMEZONE, noon_minus_12h: bool = False) -> Column:
    """Epoch second at which a ``yyyyMMdd`` service day starts.

    The default is local midnight. ``noon_minus_12h`` counts back from local noon,
    which differs by an hour on the two days a year the clock changes.
    """
    # a cast reads eight plain digits many times faster than a layout does; all else goes by the layout
    dashed = F.concat_ws("-", *[F.substring(service_date, *cut) for cut in ((1, 4), (5, 2), (7, 2))])
    plain = service_date.rlike("^[1-9][0-9]{7}$")
    by_layout = F.try_to_timestamp(service_date, F.lit("yyyyMMdd"))
    midnight = F.when(plain, dashed.try_cast("timestamp")).otherwise(by_layout)
    if noon_minus_12h:
        noon = F.to_utc_timestamp(midnight + F.expr("INTERVAL 12 HOURS"), tz)
        return F.unix_seconds(noon) - F.lit(12 * 3600)
    return F.unix_seconds(F.to_utc_timestamp(midnight, tz))


def age_seconds(moment: Column, as_of: Column) -> Column:
    """Whole seconds from a moment to the as-of time, negative for the future."""
    return F.timestamp_diff("SECOND", moment, as_of)


def age_label(moment: Column, as_of: Column) -> Column:
    """Age in the largest whole unit of seconds, minutes or hours."""
    age = age_seconds(moment, as_of)
    return (
        F.when(age.isNull(), F.lit(NO_AGE))
        .when(age < 60, F.concat(age.cast("string"), F.lit("s ago")))
        .when(age < 3600, F.concat(F.floor(age / 60).cast("string"), F.lit("m ago")))
        .otherwise(F.concat(F.floor(age / 3600).cast("string"), F.lit("h ago")))
    )


def freshness_label(age: Column) -> Column:
    minutes, seconds = F.floor(age / 60).cast("string"), (age % 60).cast("string")
    return (
        F.when(age.isNull(), F.lit(NO_AGE))
        .when(age < 60, F.concat(age.cast("string"), F.lit("s ago")))
        .otherwise(F.concat(minutes, F.lit("m "), seconds, F.lit("s ago")))
    )


def iso_string(moment: Column) -> Column:
    """ISO-8601 text without an offset; the fraction appears only when non-zero."""
    whole = F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss")
    exact = F.date_format(moment, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.when(F.unix_micros(moment) % 1_000_000 == 0, whole).otherwise(exact)
