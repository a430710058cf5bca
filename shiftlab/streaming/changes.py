"""Incremental shift changes with Structured Streaming."""

from __future__ import annotations

import math
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from shiftlab.functions import numeric, times
from shiftlab.operators.changes import reading_order
from shiftlab.operators.controls import requested_names
from shiftlab.operators.points import LINE
from shiftlab.operators.sizes import sized


def stream_shift_changes(points: DataFrame, dayshift_start: str = times.DEFAULT_START,
                         lateness: str = "1 hour", distinct: bool = False,
                         tiebreak: str | None = None) -> DataFrame:
    """One final row per (line, shift, control) once the shift can get no more data.

    ``points`` is a streaming frame with wall-clock ``_time``. Watermarks reject
    that type, so the time passes through as the instant with the same clock in
    UTC, whatever the session zone. A shift is final when the watermark, the
    latest time seen less ``lateness``, passes its end. Its intervals are
    half-open, and one start serves the whole query. State per open shift is one
    fixed-width row per control, whatever the number of readings.

    Exact repeats change none of the results and need no state. ``distinct``
    drops every later reading of a (line, control, time) that arrives within the
    lateness, also one with another value; it keeps that much time in state.
    ``tiebreak`` orders readings of one instant instead.
    """
    rows = points.withColumns({
        "_value": numeric.missing_if_nan(F.col("_value")),
        "_time": times.utc_to_instant(F.col("_time")),
    })
    rows = rows.withWatermark("_time", lateness)
    if distinct:
        rows = rows.dropDuplicatesWithinWatermark([*LINE, "_field", "_time"])
    value = F.col("_value")
    order = reading_order(F.col("_time"), F.unix_micros("_time"), tiebreak)
    window = times.shift_window(F.col("_time"), dayshift_start)
    grouped = rows.groupBy(window.alias("shift"), *LINE, F.col("_field").alias("control")).agg(
        F.min_by(value, order).alias("start_value"),
        F.max_by(value, order).alias("end_value"),
        F.max(value).alias("high"),
        F.min(value).alias("low"),
    )
    return grouped.select(
        *LINE,
        times.instant_to_utc(F.col("shift.start")).alias("shift_start"),
        times.instant_to_utc(F.col("shift.end")).alias("shift_end"),
        "control", "start_value", "end_value",
        F.coalesce(F.col("end_value") - F.col("start_value"), F.lit(0.0)).alias("delta"),
        F.coalesce(F.col("high") - F.col("low"), F.lit(0.0)).alias("spread"),
    )


#: Shift starts this many seconds apart share one grid of windows.
GRID = 900


def shift_grids(starts: list[int], grid: int = GRID) -> list[tuple[int, int, list[int]]]:
    """(first window, step between windows, starts) of as few sliding windows as hold all starts.

    A window of 12 hours begins at every start that lies on its grid. Starts on the
    quarters of an hour need one grid, of 48 windows at most; a single start is a tumbling window.
    """
    found = []
    for rest in sorted({s % grid for s in starts}):
        own = sorted({s for s in starts if s % grid == rest})
        step = math.gcd(times.SHIFT, *[s - own[0] for s in own])
        found.append((own[0] % step, step, own))
    return found


def stream_line_shifts(points: DataFrame, controls: DataFrame, lateness: str = "1 hour",
                       tiebreak: str | None = None) -> DataFrame:
    """The same for the requested controls, each line's shifts from its own start.

    The configuration is a static side of the join. The watermark runs on the true
    times of all points, so a reading counts as late by its age alone, whatever its
    line's start. A shift needs a window that begins at its line's start: a
    sliding window offers one for every start on a grid, and of these a reading
    keeps the one of its line, so one state and one pass serve all starts on the quarters of
    an hour. Other starts add a state each; with them, a new start needs a new checkpoint.
    """
    starts = F.pmod(F.col("start_seconds"), F.lit(times.SHIFT))
    offsets = [r[0] for r in controls.select(starts.alias("s")).where("s is not null").distinct().collect()]
    timed = points.withColumns({
        "_value": numeric.missing_if_nan(F.col("_value")), "_time": times.utc_to_instant(F.col("_time"))})
    wanted = timed.withWatermark("_time", lateness).join(sized(requested_names(controls)), [*LINE, "_field"])
    rows = wanted.withColumn("_offset", starts)
    value = F.col("_value")
    order = reading_order(F.col("_time"), F.unix_micros("_time"), tiebreak)

    def on_grid(first: int, step: int, own: list[int]) -> DataFrame:
        begins = F.unix_timestamp("shift.start")
        shifted = rows.where(F.col("_offset").isin(own)).withColumn(
            "shift", F.window("_time", "12 hours", f"{step} seconds", f"{first} seconds"))
        shifted = shifted.where(F.pmod(begins - F.col("_offset"), F.lit(times.SHIFT)) == 0)
        return shifted.groupBy("shift", *LINE, F.col("_field").alias("control")).agg(
            F.min_by(value, order).alias("start_value"),
            F.max_by(value, order).alias("end_value"),
            F.max(value).alias("high"),
            F.min(value).alias("low"),
        )
    grouped = reduce(DataFrame.unionByName, [on_grid(*g) for g in shift_grids(offsets or [0])])
    return grouped.select(
        *LINE, times.instant_to_utc(F.col("shift.start")).alias("shift_start"),
        times.instant_to_utc(F.col("shift.end")).alias("shift_end"),
        "control", "start_value", "end_value",
        F.coalesce(F.col("end_value") - F.col("start_value"), F.lit(0.0)).alias("delta"),
        F.coalesce(F.col("high") - F.col("low"), F.lit(0.0)).alias("spread"),
    )


def stream_process_changes(points: DataFrame, controls: DataFrame, lateness: str = "1 hour") -> DataFrame:
    """Changes as reports tell them, from a stream: unique points, first instant per minute, closed shifts.

    Three groupings follow one another on one watermark. The first keeps a control's
    first reading in a rounded minute of its line, and of two at one instant the highest; the second
    the controls read at the first instant of the minute, a list no longer than the
    line's configuration; the third is the shift, in which a minute on a boundary
    counts on both sides. A minute is final when ``lateness`` has passed, a shift soon
    after its last minute; what arrives later is dropped. Rounding is half to even, so an
    instant that rounds down from the half is taken a microsecond early.
    """
    seconds = F.unix_micros("_time") % F.lit(2 * times.MINUTE * 1_000_000)
    early = F.timestamp_add("MICROSECOND", F.when(seconds == 30_000_000, F.lit(-1)).otherwise(F.lit(0)), F.col("_time"))
    timed = points.withColumns({
        "_value": numeric.missing_if_nan(F.col("_value")), "_time": times.utc_to_instant(F.col("_time"))})
    timed = timed.withColumn("_near", early).withWatermark("_near", lateness)
    rows = timed.join(sized(requested_names(controls)), [*LINE, "_field"])
    starts = F.pmod(F.col("start_seconds"), F.lit(times.SHIFT))
    offsets = [r[0] for r in controls.select(starts.alias("s")).where("s is not null").distinct().collect()]
    minute = F.window("_near", "1 minute", "1 minute", "30 seconds")
    first = F.min(F.struct("_time", F.col("_value").isNull().alias("missing"), (-F.col("_value")).alias("negative")))
    firsts = rows.withColumn("_offset", starts).groupBy(minute.alias("minute"), *LINE, "_offset", F.col("_field").alias("control")).agg(
        first.alias("first"))
    read = F.collect_list(F.struct("control", "first"))
    lines = firsts.groupBy("minute", *LINE, "_offset").agg(read.alias("read"), F.min("first._time").alias("instant"))
    kept = lines.withColumn("read", F.explode(F.filter("read", lambda r: r["first"]["_time"] == F.col("instant"))))
    level = F.timestamp_add("SECOND", F.lit(times.MINUTE // 2), F.col("minute.start"))
    kept = kept.select(F.window_time("minute").alias("_at"), *LINE, "_offset", "read.control", "instant", level.alias("level"),
                       (-F.col("read.first.negative")).alias("_value"))

    def on_grid(begin: int, step: int, own: list[int]) -> DataFrame:
        # The time of a minute is its window's last microsecond, so that far behind the minute lie the windows of shifts.
        window = F.window("_at", "12 hours 1 minute", f"{step} seconds", f"{begin} seconds 29999999 microseconds")
        start = F.timestamp_add("MICROSECOND", F.lit(-29_999_999), F.col("shift.start"))
        shifted = kept.where(F.col("_offset").isin(own)).withColumn("shift", window)
        # The extra minute is there for a boundary on the minute; of another one it would hold the minute after.
        own_shift = F.pmod(F.unix_timestamp(start) - F.col("_offset"), F.lit(times.SHIFT)) == 0
        shifted = shifted.where(own_shift & (F.col("level") <= F.timestamp_add("HOUR", F.lit(12), start)))
        order = F.when(F.col("_value").isNotNull(), F.col("instant"))
        return shifted.groupBy("shift", *LINE, "control").agg(
            F.min_by("_value", order).alias("start_value"), F.max_by("_value", order).alias("end_value"),
            F.max("_value").alias("high"), F.min("_value").alias("low"),
            F.min("level").alias("earliest"), F.max("level").alias("latest")).withColumn("start", times.instant_to_utc(start))
    grouped = reduce(DataFrame.unionByName, [on_grid(*g) for g in shift_grids(offsets or [0])])
    return grouped.select(
        *LINE, F.col("start").alias("shift_start"), times.shift_end(F.col("start")).alias("shift_end"), "control", "start_value", "end_value",
        F.coalesce(F.col("end_value") - F.col("start_value"), F.lit(0.0)).alias("delta"),
        F.coalesce(F.col("high") - F.col("low"), F.lit(0.0)).alias("spread"),
        times.instant_to_utc(F.col("earliest")).alias("earliest"), times.instant_to_utc(F.col("latest")).alias("latest"))


def write_stream(changes: DataFrame, path: str, checkpoint: str, once: bool = True) -> StreamingQuery:
    """Append finished shifts to parquet files.

    The file sink and the checkpoint give each row exactly once over restarts.
    ``once`` reads what is there and stops; else a trigger runs every minute.
    """
    writer = changes.writeStream.outputMode("append").format("parquet").option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if once else writer.trigger(processingTime="1 minute")
    return writer.start(path)


def read_stream(spark: SparkSession, path: str, schema, glob: str | None = None,
                max_files: int | None = None) -> DataFrame:
    """Telemetry files as they appear in a folder.

    ``max_files`` cuts a backlog into batches. The watermark moves after each, so
    use it only where files arrive in the order of their times.
    """
    reader = spark.readStream.schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    return reader.parquet(path)
