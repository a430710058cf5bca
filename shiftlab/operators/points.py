"""Telemetry points: requested ones, duplicates, first per minute, wide form.

A point is (site, line_id, _time, _field, _value).
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftlab.functions import times
from shiftlab.operators.controls import requested_names
from shiftlab.operators.sizes import hinted, join_names

POINT = ["site", "line_id", "_time", "_field", "_value"]
LINE = ["site", "line_id"]
KEYED_LINE = ["line_key"]
SEEDS = 16


def requested(points: DataFrame, controls: DataFrame) -> DataFrame:
    """Points of controls the line's configuration names, with the line's shift start.

    Names are compared literally, never as patterns. Each name stands once per
    line, so the inner join is a semi join that also brings the start along: one
    pass over the points, no shuffle while the configuration is small.
    """
    return join_names(points, requested_names(controls), [*LINE, "_field"], ["_time"])


def _key(seed: int, *names: str) -> Column:
    return F.xxhash64(F.lit(seed), *names)


def name_keys(controls: DataFrame) -> tuple[DataFrame, int]:
    """Requested names, with one BIGINT for the line and one for the control, and how many keys there are.

    They stand in for three strings wherever points are shuffled. A hash may be
    used for a name only once a look at all names has shown that no two share
    one; otherwise the next seed is tried. The same look counts the names, which
    decides how they are joined.
    """
    names = requested_names(controls)
    for seed in range(SEEDS):
        keyed = names.withColumns({
            "line_key": _key(seed, "site", "line_id"),
            "control_key": _key(seed, "site", "line_id", "_field"),
        })
        pairs = keyed.select(F.inline(F.array(
            F.struct(F.col("line_key").alias("key"), F.array(*LINE).alias("name")),
            F.struct(F.col("control_key").alias("key"), F.array(*LINE, "_field").alias("name")),
        )))
        shared = pairs.groupBy("key").agg(F.min("name").alias("one"), F.max("name").alias("other"))
        found = shared.agg(
            F.count_if(F.col("one") != F.col("other")).alias("clashes"), F.count("*").alias("keys")).first()
        if found["clashes"] == 0:
            return keyed, found["keys"]
    raise ValueError("names share their keys under every seed")


def keyed_points(points: DataFrame, keys: tuple[DataFrame, int]) -> DataFrame:
    """:func:`requested` points with keys in place of names."""
    wanted = join_names(points, keys[0], [*LINE, "_field"], ["_time"], keys[1])
    return wanted.select("line_key", "control_key", "start_seconds", "_time", "_value")


def named(rows: DataFrame, keys: tuple[DataFrame, int]) -> DataFrame:
    """Names in place of keys again, once rows are few."""
    names = keys[0].select("line_key", "control_key", *LINE, F.col("_field").alias("control"))
    return rows.join(hinted(names, keys[1]), ["line_key", "control_key"]).drop("line_key", "control_key")


def union_distinct(frames: list[DataFrame]) -> DataFrame:
    """All result sets of one fetch as one, exact repeats removed."""
    merged = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)
    return merged.dropDuplicates(POINT)


def duplicate_keys(points: DataFrame) -> DataFrame:
    """(line, time, control) keys with more than one point.

    The wide form has one cell per key, so a second point makes the line's
    report fail; picking one silently would hide it. The grouping key is as fine
    as the data, so no line or control can make a large group, and repeated
    copies are counted before the shuffle.
    """
    return (
        points.groupBy(*LINE, "_time", "_field")
        .agg(F.count("*").alias("copies"))
        .where(F.col("copies") > 1)
    )


def lines_with_duplicates(points: DataFrame) -> DataFrame:
    return duplicate_keys(points).groupBy(*LINE).agg(F.count("*").alias("duplicate_keys"))


def fetched_lines(points: DataFrame) -> DataFrame:
    """Per line with points: how many instants and controls there are, and how many of these more than once."""
    counted = points.groupBy(*LINE, "_time", "_field").agg(F.count("*").alias("copies"))
    return counted.groupBy(*LINE).agg(
        F.count("*").alias("readings"), F.count_if(F.col("copies") > 1).alias("duplicate_keys"))


def unique_points(points: DataFrame) -> DataFrame:
    """One row per (line, control, time), with the number of points behind it.

    ``points`` has these columns, the value and nothing that tells copies apart.

    The grouping of :func:`duplicate_keys`, but the points stay, so that
    reports find duplicates in the one pass they make anyway. Where ``copies``
    is more than one the value is the highest and the report is not to be used.
    """
    keys = [c for c in points.columns if c != "_value"]
    return points.groupBy(*keys).agg(F.max("_value").alias("_value"), F.count("*").alias("copies"))


def first_per_minute(points: DataFrame, bucket: str | None = "minute", line: list[str] = LINE) -> DataFrame:
    """Points at the first instant of each rounded minute of their line.

    The instant is the first over all requested controls of the line: a control
    without a reading at that instant is not filled in from a later one. With
    ``bucket=None`` every instant is its own bucket and all points stay.

    Two levels: the first point per control and minute, which shrinks on both
    sides of its shuffle, and among these the first instant of the minute. The
    second level sees one row per control of the line and minute at most,
    however many readings a busy minute holds. ``copies``, if present, becomes
    the highest of the minute, so a duplicate shows even when its point goes.
    Other columns must belong to the line or control.
    """
    if bucket is None:
        return points.withColumn("minute_level", F.col("_time"))
    if bucket != "minute":
        raise ValueError(f"bucket is 'minute' or None, not {bucket!r}")
    keys = [c for c in points.columns if c not in ("_time", "_value", "copies")]
    counted = ["copies"] if "copies" in points.columns else []
    per_control = (
        points.withColumn("minute", times.minute_seconds(F.col("_time")))
        .groupBy(*keys, "minute")
        .agg(
            F.min("_time").alias("_time"),
            F.min_by("_value", "_time").alias("_value"),
            *[F.max(c).alias(c) for c in counted],
        )
    )
    minute = Window.partitionBy(*line, "minute")
    firsts = per_control.withColumns({
        "first_time": F.min("_time").over(minute), **{c: F.max(c).over(minute) for c in counted}})
    return firsts.where(F.col("_time") == F.col("first_time")).select(
        *keys, "_time", "_value", *counted, times.from_seconds(F.col("minute")).alias("minute_level"))


def widen(points: DataFrame, fields: list[str], time_col: str = "_time") -> DataFrame:
    """One row per line and time, one column per control.

    For display only; reports aggregate the long form. ``fields`` is given, so
    no extra pass looks for the names. Keys are expected to be unique, see
    :func:`duplicate_keys`.
    """
    return points.groupBy(*LINE, time_col).pivot("_field", fields).agg(F.max("_value"))
