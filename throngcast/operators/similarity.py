"""Best match by edit distance and by distance on the ground, without cross joins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from throngcast.functions.geo import EARTH_RADIUS_M, haversine_meters


def _spread(df: DataFrame, copies: int) -> DataFrame:
    return df.withColumn("_salt", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))


def _assign(df: DataFrame, copies: int, *columns: str) -> DataFrame:
    return df.withColumn("_salt", F.pmod(F.xxhash64(*columns), F.lit(copies)).cast("int"))


def _segment(length: Column, index: Column, parts: int) -> tuple[Column, Column]:
    """Start and size of one of ``parts`` near-equal segments; the last ones are longer."""
    base = F.floor(length / parts).cast("int")
    shorter = F.lit(parts) - length % parts
    start = index * base + F.greatest(index - shorter, F.lit(0))
    size = base + F.when(index >= shorter, 1).otherwise(0)
    return start, size


def _characters(text: Column) -> Column:
    """The distinct characters of a text that is not empty."""
    return F.array_distinct(F.transform(F.sequence(F.lit(1), F.length(text)), lambda at: F.substr(text, at, F.lit(1))))


def closest_name(
    probes: DataFrame,
    targets: DataFrame,
    *,
    probe: str,
    target: str,
    payload: str,
    threshold: int,
    salts: int = 8,
) -> DataFrame:
    """Per probe text the target with the smallest (edit distance, payload).

    ``probes`` holds distinct texts, ``targets`` distinct texts with one orderable
    ``payload`` each. A target is cut into ``threshold + 1`` segments. Two texts at
    most ``threshold`` edits apart share a segment verbatim, shifted by ``d`` with
    ``|d| + |length difference - d| <= threshold``, so joining on (length, segment
    number, segment text) loses no pair. A target too short to be cut is compared with
    the texts that have a character of it. From all others it is as far as the longer
    of both is long, so of these only the smallest payload of each length can answer;
    that it may be nearer does no harm, as its own comparison then wins. Salting
    spreads a segment that many texts share. Output columns: ``probe``, ``distance``,
    ``payload``.
    """
    parts = threshold + 1
    cut = targets.withColumn("_n", F.length(target))
    short_targets = cut.where(F.col("_n") < parts)
    whole = short_targets.where(F.col("_n") > 0).select(
        target, payload, "_n", F.lit(-1).alias("_i"), F.explode(_characters(F.col(target))).alias("_text")
    )
    start, size = _segment(F.col("_n"), F.col("_i"), parts)
    pieces = (
        cut.where(F.col("_n") >= parts)
        .withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(threshold))))
        .select(target, payload, "_n", "_i", F.substring(F.col(target), start + 1, size).alias("_text"))
    )
    index = _spread(whole.unionByName(pieces), salts)

    sized = probes.select(probe).withColumn("_len", F.length(probe))
    lengths = sized.withColumn(
        "_n", F.explode(F.sequence(F.greatest(F.col("_len") - threshold, F.lit(0)), F.col("_len") + threshold))
    )
    short_probes = lengths.where(F.col("_n") < parts)
    short = short_probes.where((F.col("_n") > 0) & (F.col("_len") > 0)).select(
        probe, "_n", F.lit(-1).alias("_i"), F.explode(_characters(F.col(probe))).alias("_text")
    )
    # one row per length below the threshold, at most threshold + 1 of them
    first_of_length = F.broadcast(short_targets.groupBy("_n").agg(F.min(payload).alias(payload)))
    apart = short_probes.join(first_of_length, "_n").select(probe, F.greatest("_len", "_n").alias("distance"), payload)
    gap = F.col("_len") - F.col("_n")
    first = F.greatest(start + F.ceil((gap - threshold) / 2).cast("int"), F.lit(0))
    last = F.least(start + F.floor((gap + threshold) / 2).cast("int"), F.col("_len") - size)
    windows = (
        lengths.where(F.col("_n") >= parts)
        .withColumn("_i", F.explode(F.sequence(F.lit(0), F.lit(threshold))))
        .withColumns({"_first": first, "_last": last})
        .where(F.col("_first") <= F.col("_last"))
        .withColumn("_at", F.explode(F.sequence("_first", "_last")))
        .select(probe, "_n", "_i", F.substring(F.col(probe), F.col("_at") + 1, size).alias("_text"))
    )
    search = _assign(short.unionByName(windows), salts, probe)

    distance = F.levenshtein(F.col(probe), F.col(target), threshold)
    compared = (
        search.join(index, ["_n", "_i", "_text", "_salt"])
        .select(probe, distance.alias("distance"), payload)
        .where(F.col("distance") >= 0)
    )
    return (
        compared.union(apart.where(F.col("distance") <= threshold))
        .groupBy(probe)
        .agg(F.min(F.struct("distance", payload)).alias("_best"))
        .select(probe, "_best.distance", f"_best.{payload}")
    )


def _grid_cell(lat: Column, lon: Column, size_m: float) -> dict[str, Column]:
    """Cell of a point in a cubic grid around the globe.

    A straight line is never longer than the arc, so points within ``size_m`` of
    each other are at most one cell apart on every axis, poles and date line included.
    """
    ring = F.cos(F.radians(lat))
    axes = {
        "_x": ring * F.cos(F.radians(lon)),
        "_y": ring * F.sin(F.radians(lon)),
        "_z": F.sin(F.radians(lat)),
    }
    scale = F.lit(EARTH_RADIUS_M / (size_m * (1 + 1e-9) + 1e-6))
    return {name: F.floor(value * scale) for name, value in axes.items()}


def nearest_within(
    points: DataFrame,
    targets: DataFrame,
    *,
    point: tuple[str, str],
    target: tuple[str, str],
    payload: str,
    radius_m: float,
    salts: int = 4,
) -> DataFrame:
    """Per distinct point the target with the smallest (distance, payload) inside a radius.

    ``point`` and ``target`` name latitude and longitude. Targets are copied to the
    27 cells around their own, points stay in one cell. Output columns: the point's
    two, ``distance``, ``payload``.
    """
    lat, lon = map(F.col, point)
    to_lat, to_lon = map(F.col, target)
    offsets = F.array(*[F.lit(step) for step in (-1, 0, 1)])
    near = targets.where(to_lat.isNotNull() & to_lon.isNotNull()).withColumns(_grid_cell(to_lat, to_lon, radius_m))
    for axis in ("_x", "_y", "_z"):
        near = near.withColumn("_step", F.explode(offsets)).withColumn(axis, F.col(axis) + F.col("_step"))
    near = _spread(near.drop("_step"), salts)
    placed = points.select(*point).where(lat.isNotNull() & lon.isNotNull())
    placed = _assign(placed.withColumns(_grid_cell(lat, lon, radius_m)), salts, *point)
    return (
        placed.join(near, ["_x", "_y", "_z", "_salt"])
        .withColumn("distance", haversine_meters(lat, lon, to_lat, to_lon))
        .where(F.col("distance") < F.lit(float(radius_m)))
        .groupBy(*point)
        .agg(F.min(F.struct("distance", payload)).alias("_best"))
        .select(*point, "_best.distance", f"_best.{payload}")
    )
