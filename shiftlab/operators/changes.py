"""Shift changes: where each control began and ended, and how far it ranged."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftlab.functions import times
from shiftlab.operators.points import LINE, requested
from shiftlab.operators.sizes import sized

SHIFT = [*LINE, "shift_start"]
TIEBREAK_SPAN = "18446744073709551616BD"


def assign_shift(rows: DataFrame, time_col: str, dayshift_start: str | None = None,
                 closed: bool = True) -> DataFrame:
    """Add ``shift_start``, the shift or shifts a row belongs to.

    ``dayshift_start`` given: one start for all rows, a plain tumbling window.
    Not given: the row's own ``start_seconds``. With ``closed`` a row exactly on a
    boundary counts in the shift that ends there and in the one that begins
    there; otherwise only in the latter. Rows without a time belong to none.
    """
    ts = F.col(time_col)
    if dayshift_start is not None:
        rows = rows.withColumn("shift_start", times.shift_window(ts, dayshift_start)["start"])
        if not closed:
            return rows
        start = F.col("shift_start")
        both = F.array(start, start - F.expr("INTERVAL 12 HOURS"))
        return rows.withColumn(
            "shift_start", F.explode(F.when(ts == start, both).otherwise(F.array(start)))
        )
    start = times.shift_start_seconds(ts, F.col("start_seconds"))
    rows = rows.where(ts.isNotNull())
    if closed:
        both = F.array(start, start - times.SHIFT)
        on_edge = F.when(times.epoch_seconds(ts) == start, ts == times.from_seconds(start))
        start = F.explode(F.when(on_edge, both).otherwise(F.array(start)))
    return rows.withColumn("shift_start", start)


def with_timestamps(df: DataFrame) -> DataFrame:
    """Turn BIGINT shift starts into timestamps, once rows are few."""
    if dict(df.dtypes)["shift_start"] == "bigint":
        return df.withColumn("shift_start", times.from_seconds(F.col("shift_start")))
    return df


def reading_order(time: Column, micros: Column, tiebreak: str | None) -> Column:
    """What orders the readings of a control; NULL, hence skipped, without a value."""
    order = time
    if tiebreak is not None:
        order = micros.cast("decimal(18,0)") * F.expr(TIEBREAK_SPAN) + F.col(tiebreak).cast("decimal(19,0)")
    return F.when(F.col("_value").isNotNull(), order)


def observed_changes(points: DataFrame, time_col: str = "_time", dayshift_start: str | None = None,
                     closed: bool = True, tiebreak: str | None = None, line: list[str] = LINE,
                     control: str = "_field") -> DataFrame:
    """One row per (line, shift, control) seen, from requested points.

    A single grouping: first and last reading by time, highest, lowest, and the
    first and last instant with any row. Every buffer is fixed-width, so Spark
    hash-aggregates before the shuffle and only one row per group and task
    travels. Ordering by a struct would fall back to sorting all points.

    ``line`` and ``control`` are the columns that tell these, names or keys. Two
    readings of one control at one instant are duplicates, which
    ``duplicate_keys`` reports and ``unique_points`` settles. Where points come
    without that step, ``tiebreak`` names a BIGINT column that orders them, so
    that results repeat; time and tie-break then share one 38-digit decimal,
    still fixed-width, for about half as much time again.
    """
    rows = assign_shift(points, time_col, dayshift_start, closed)
    value = F.col("_value")
    order = reading_order(F.col("_time"), times.epoch_micros(F.col("_time")), tiebreak)
    name = "control" if control == "_field" else control
    grouped = rows.groupBy(*line, "shift_start", F.col(control).alias(name)).agg(
        F.min_by(value, order).alias("start_value"),
        F.max_by(value, order).alias("end_value"),
        F.max(value).alias("high"),
        F.min(value).alias("low"),
        F.min(time_col).alias("earliest"),
        F.max(time_col).alias("latest"),
        *([F.max("copies").alias("copies")] if "copies" in points.columns else []),
    )
    return with_timestamps(grouped)


def coverage(observed: DataFrame) -> DataFrame:
    """Earliest and latest instant with a row, per line and shift.

    Reads the grouped rows, not the points again.
    """
    return observed.groupBy(*SHIFT).agg(
        F.min("earliest").alias("earliest"), F.max("latest").alias("latest")
    )


def complete_changes(observed: DataFrame, controls: DataFrame) -> DataFrame:
    """Every configured control of every (line, shift) that has any row.

    A control without readings has no start and end, and changes of zero. The
    grouped rows of a shift, one per configured control at most, are gathered
    and looked up by the line's list of controls. Joining the grouped rows with
    a frame of expected ones would read the points twice.
    """
    counted = "copies" in observed.columns
    readings = F.struct("start_value", "end_value", "high", "low")
    gathered = observed.groupBy(*SHIFT).agg(
        F.map_from_entries(F.collect_list(F.struct("control", readings))).alias("seen"),
        F.min("earliest").alias("earliest"),
        F.max("latest").alias("latest"),
        *([F.max("copies").alias("copies")] if counted else []),
    )
    looked_up = F.transform("controls", lambda c: F.struct(
        c["kind"].alias("kind"), c["control"].alias("control"), c["control_ordinal"].alias("control_ordinal"),
        F.try_element_at(F.col("seen"), c["control"]).alias("r"),
    ))
    per_line = sized(controls, weight=F.size("controls"))
    rows = gathered.join(per_line, LINE).select(
        *SHIFT, "start_seconds", "threshold", "earliest", "latest", *(["copies"] if counted else []),
        F.explode(looked_up).alias("c"),
    )
    start = F.col("shift_start")
    letter = times.shift_letter_of_start(start, F.col("start_seconds"))
    return rows.select(
        *SHIFT,
        times.shift_end(start).alias("shift_end"),
        times.shift_label(start, letter).alias("shift_label"),
        "threshold", "earliest", "latest", *(["copies"] if counted else []),
        "c.kind", "c.control", "c.control_ordinal", "c.r.start_value", "c.r.end_value",
        F.coalesce(F.col("c.r.end_value") - F.col("c.r.start_value"), F.lit(0.0)).alias("delta"),
        F.coalesce(F.col("c.r.high") - F.col("c.r.low"), F.lit(0.0)).alias("spread"),
    )


def shift_changes(points: DataFrame, controls: DataFrame, time_col: str = "_time",
                  dayshift_start: str | None = None, closed: bool = True,
                  tiebreak: str | None = None) -> DataFrame:
    """Changes of all configured controls, on all lines, in all shifts."""
    wanted = requested(points, controls)
    observed = observed_changes(wanted, time_col, dayshift_start, closed, tiebreak)
    return complete_changes(observed, controls)


def beyond_threshold() -> Column:
    """Heats that moved by more than their line's threshold, either way."""
    return (F.col("kind") == "heat") & (F.abs("delta") > F.col("threshold"))


def over_threshold(changes: DataFrame) -> DataFrame:
    """Heats beyond the threshold, as shown in reports.

    The four shown numbers are cut to whole numbers one by one, toward zero, so
    the shown change may differ from shown end minus shown start.
    """
    shown = [F.col(c).try_cast("bigint").alias(f"shown_{c.removesuffix('_value')}")
             for c in ("start_value", "end_value", "delta", "spread")]
    return changes.where(beyond_threshold()).select("*", *shown)


def by_spread(changes: DataFrame) -> DataFrame:
    """Each report's rows together, widest range first, then in configured order.

    Completed changes already lie by line and shift, so sorting within
    partitions is enough; a total order over all reports would shuffle again.
    """
    return changes.sortWithinPartitions(*SHIFT, "kind", F.desc_nulls_last("spread"), "control_ordinal")


def moved() -> Column:
    """A heat beyond its threshold, or any move of another control."""
    return beyond_threshold() | ((F.col("kind") != "heat") & (F.abs("delta") > 0))


def changed_flag(changes: DataFrame) -> DataFrame:
    """Per line and shift: whether any control moved."""
    return changes.groupBy(*SHIFT, "shift_label").agg(F.bool_or(moved()).alias("changed"))
