"""Report runs: which shift each line reports at which time."""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shiftlab.functions import times


def scheduled_run(lines: DataFrame, as_of: datetime) -> DataFrame:
    """One run of every line at one clock time."""
    return _with_shift(lines.withColumn("run_at", times.wall_clock(as_of)))


def backfill_runs(lines: DataFrame, first: datetime, last: datetime) -> DataFrame:
    """A run every 12 hours from ``first`` to ``last``, for every line."""
    bounds = [times.wall_clock(t) for t in (first, last)]
    runs = F.explode(F.sequence(*bounds, F.expr("INTERVAL 12 HOURS")))
    return _with_shift(lines.withColumn("run_at", runs))


def _with_shift(runs: DataFrame) -> DataFrame:
    shift = times.run_shift(F.col("run_at"), F.col("dayshift_start"))
    return runs.withColumn("shift", shift).select("*", "shift.*").drop("shift")
