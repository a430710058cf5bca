"""Made-up telemetry for trials: a minute grid of plausible readings per control.

Every number is a function of (seed, line, control, minute), not of a random
stream, so a recomputed partition gives the same readings.
"""

from __future__ import annotations

import math
from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftlab.functions import times
from shiftlab.operators.controls import requested_names

# Levels, noise and drift of the two kinds of control.
HEAT_BASE, HEAT_REACH, HEAT_NOISE, HEAT_RAMP = 350.0, 20, 2.0, 15.0
OTHER_BASE, OTHER_REACH, OTHER_NOISE, OTHER_STEP = 100.0, 10, 0.5, 5.0
STEP_CHANCE = 0.3
POINTS = 1441
BLOCK = 60


def uniform(*keys: Column | str) -> Column:
    """A number in (0, 1) that depends on the keys only."""
    digest = F.md5(F.concat_ws("|", *[F.lit(k) if isinstance(k, str) else k.cast("string") for k in keys]))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / float(16 ** 12)


def normal(*keys: Column | str) -> Column:
    """A standard normal number that depends on the keys only (Box-Muller)."""
    radius = F.sqrt(-2.0 * F.log(uniform("r", *keys)))
    return radius * F.cos(2.0 * math.pi * uniform("a", *keys))


def synthetic_telemetry(controls: DataFrame, end: datetime, points: int = POINTS, seed: int = 0) -> DataFrame:
    """``points`` minutes up to ``end`` for each control of each line.

    A control whose name holds "heat" sits near 350 and ramps up by 15 in the
    second half. Any other sits near 100, and some step up by 5 within the
    middle third. Grid points are spread over tasks by control and block of
    minutes, so one large line does not stay in one task.
    """
    key = [F.lit(seed), F.col("line_id"), F.col("control")]
    middle, third = points // 2, points // 3
    names = requested_names(controls).withColumnRenamed("_field", "control")
    per_control = names.select("site", "line_id", "control").withColumns({
        "heat": F.contains(F.lower("control"), F.lit("heat")),
        "level": uniform("level", *key),
        "steps": uniform("steps", *key) < STEP_CHANCE,
        "step_at": F.floor(F.lit(third) + uniform("step", *key) * (2 * points // 3 - third)),
    })
    i = F.col("i")
    noise = normal("noise", *key, i)
    ramp = F.when(i >= middle, (i - middle) * HEAT_RAMP / max(points - middle - 1, 1)).otherwise(0.0)
    step = F.when(F.col("steps") & (i >= F.col("step_at")), F.lit(OTHER_STEP)).otherwise(0.0)
    heat = HEAT_BASE - HEAT_REACH + F.floor(F.col("level") * 2 * HEAT_REACH) + HEAT_NOISE * noise + ramp
    other = OTHER_BASE - OTHER_REACH + F.floor(F.col("level") * 2 * OTHER_REACH) + OTHER_NOISE * noise + step
    begin = times.wall_clock(end)
    blocks = F.explode(F.sequence(F.lit(0), F.lit(points - 1), F.lit(BLOCK)))
    tasks = int(controls.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    spread = per_control.withColumn("block", blocks).repartition(tasks, "line_id", "control", "block")
    end_of_block = F.least(F.col("block") + BLOCK, F.lit(points)) - 1
    grid = spread.withColumn("i", F.explode(F.sequence(F.col("block"), end_of_block)))
    return grid.select(
        "site", "line_id",
        F.timestamp_add("MINUTE", i - (points - 1), begin).alias("_time"),
        F.col("control").alias("_field"),
        F.when(F.col("heat"), heat).otherwise(other).alias("_value"),
    )
