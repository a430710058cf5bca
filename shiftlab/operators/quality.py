"""Quality: the part being made, and the fraction of each test within its limits."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftlab.functions import numeric, text, times
from shiftlab.operators.changes import SHIFT, assign_shift, with_timestamps
from shiftlab.operators.points import LINE
from shiftlab.operators.sizes import sized

DEFAULT_LSL = 0.0
DEFAULT_USL = 100.0
SPEC_KEY = [*LINE, "part_item", "test_cleaned"]


def measurements(quality: DataFrame, lines: DataFrame, site_tz: str = "America/Chicago",
                 closed: bool = True) -> DataFrame:
    """Quality rows of the configured lines with shift, clean test name and number.

    ``datetime`` is UTC; shifts are told apart in ``site_tz``. A line is found
    by its site and its number.
    """
    dim = lines.select(
        *LINE,
        text.table_site(F.col("line_id")).alias("table_site"),
        text.line_number(F.col("line_id")).alias("line_no"),
        "start_seconds",
    )
    rows = quality.withColumnRenamed("site", "table_site").join(sized(dim), ["table_site", "line_no"])
    rows = rows.withColumn("local_time", times.to_zone(F.col("datetime"), "UTC", site_tz))
    return assign_shift(rows, "local_time", closed=closed).select(
        *SHIFT,
        "datetime",
        "part_item",
        text.sanitize_test(F.col("test")).alias("test_cleaned"),
        numeric.to_number(F.col("val")).alias("val"),
    )


def with_limits(rows: DataFrame, specs: DataFrame | None) -> DataFrame:
    """Add ``lsl`` and ``usl``.

    Without a specification row the limits are 0 and 100. A row with a missing
    limit is a one-sided specification and keeps it missing.
    """
    if specs is None:
        return rows.withColumns({"lsl": F.lit(DEFAULT_LSL), "usl": F.lit(DEFAULT_USL)})
    given = specs.select(*SPEC_KEY, F.struct("lsl", "usl").alias("limits"))
    default = F.struct(F.lit(DEFAULT_LSL).alias("lsl"), F.lit(DEFAULT_USL).alias("usl"))
    return (
        rows.join(sized(given), SPEC_KEY, "left")
        .withColumn("limits", F.coalesce("limits", default))
        .withColumns({"lsl": F.col("limits.lsl"), "usl": F.col("limits.usl")})
        .drop("limits")
    )


def good_fraction_of(n: Column, mean: Column, sd: Column, low: Column, high: Column,
                     n_le: Column, below: Column, above: Column, lsl: Column, usl: Column) -> Column:
    """Good fraction from the statistics of one group; NULL where undefined.

    With an upper limit: normal mass within the nearer limit, negative when the
    mean lies outside. Equal values are all good or all bad. With a lower limit
    only: one minus the interpolated share at or below it, where ``n_le`` values
    lie at or below the limit, ``below`` is the largest of these and ``above``
    the smallest beyond it.
    """
    step = F.coalesce((lsl - below) / F.nullif(above - below, F.lit(0.0)), F.lit(0.0))
    lower_only = (
        F.when(lsl.isNull() | (n <= 1), F.lit(None).cast("double"))
        .when(low > lsl, F.lit(1.0))
        .when(high < lsl, F.lit(0.0))
        .otherwise(F.lit(1.0) - (n_le - 1 + step) / F.nullif((n - 1).cast("double"), F.lit(0.0)))
    )
    inside = F.coalesce((lsl <= mean) & (mean <= usl), F.lit(False))
    sigmas = F.least(usl - mean, mean - lsl) / F.nullif(sd, F.lit(0.0))
    two_sided = (
        F.when(n <= 1, F.lit(None).cast("double"))
        .when((low == high) & (F.abs(low) < float("inf")), F.when(inside, F.lit(1.0)).otherwise(F.lit(0.0)))
        .otherwise(numeric.normal_within(sigmas))
    )
    return numeric.missing_if_nan(F.when(usl.isNull(), lower_only).otherwise(two_sided))


def test_statistics(rows: DataFrame) -> DataFrame:
    """One row per (line, shift, part, test), from rows with limits.

    The only pass over the measurements. Counts, moments, extremes and the two
    neighbours of the lower limit are taken together, all with fixed-width
    buffers, so rows shrink before the shuffle whatever line or test is hot.
    """
    val, lsl = F.col("val"), F.col("lsl")
    grouped = rows.groupBy(*SHIFT, "part_item", "test_cleaned", "lsl", "usl").agg(
        F.count("*").alias("n_rows"),
        F.max("datetime").alias("latest"),
        F.count(val).alias("n"),
        F.avg(val).alias("mean"),
        F.stddev_samp(val).alias("sd"),
        F.min(val).alias("low"),
        F.max(val).alias("high"),
        F.count_if(val <= lsl).alias("n_le"),
        F.max(F.when(val <= lsl, val)).alias("below"),
        F.min(F.when(val > lsl, val)).alias("above"),
    )
    return with_timestamps(grouped)


def current_part(rows: DataFrame) -> DataFrame:
    """Part with the most rows per line and shift; on a tie the first by name."""
    counted = (
        rows.where(F.col("part_item").isNotNull())
        .groupBy(*SHIFT, "part_item").agg(F.count("*").alias("n_rows"))
    )
    best = F.min(F.struct((-F.col("n_rows")).alias("order"), "part_item"))
    return counted.groupBy(*SHIFT).agg(best["part_item"].alias("part_item"))


def latest_measurement(stats: DataFrame, site_tz: str = "America/Chicago") -> DataFrame:
    """Last measurement per line and shift over all parts, on the site's clock."""
    return stats.groupBy(*SHIFT).agg(F.max("latest").alias("latest")).withColumn(
        "latest_local", times.to_zone(F.col("latest"), "UTC", site_tz)
    )


def distinct_tests(rows: DataFrame) -> DataFrame:
    return rows.select(*SHIFT, "test_cleaned").distinct()


def ranked_fractions(stats: DataFrame) -> DataFrame:
    """Good fraction of every part and test, and whether it is the part being made.

    The part is picked among the grouped rows of a shift, one per part and test,
    so measurements are neither read nor shuffled a second time.
    """
    fraction = good_fraction_of(*[F.col(c) for c in (
        "n", "mean", "sd", "low", "high", "n_le", "below", "above", "lsl", "usl")])
    rows = stats.select(*SHIFT, "part_item", "test_cleaned", "n_rows", "latest", "n", "lsl", "usl",
                        fraction.alias("good_fraction"))
    per_part = Window.partitionBy(*SHIFT, "part_item")
    most = Window.partitionBy(*SHIFT).orderBy(
        F.col("part_item").isNull(), F.desc("part_rows"), "part_item")
    return rows.withColumn("part_rows", F.sum("n_rows").over(per_part)).withColumn(
        "is_current", (F.rank().over(most) == 1) & F.col("part_item").isNotNull()
    ).drop("part_rows")


def good_fractions(stats: DataFrame, keep_undefined: bool = False, clamp: bool = False) -> DataFrame:
    """Good fraction per test of the part being made.

    ``clamp`` lifts negative fractions to zero.
    """
    found = ranked_fractions(stats).where(F.col("is_current"))
    if not keep_undefined:
        found = found.where(F.col("good_fraction").isNotNull())
    fraction = F.col("good_fraction")
    if clamp:
        fraction = F.greatest(fraction, F.when(fraction.isNotNull(), F.lit(0.0)))
    return found.select(*SHIFT, "part_item", "test_cleaned", "n", "lsl", "usl", fraction.alias("good_fraction"))


def worst_first(fractions: DataFrame) -> DataFrame:
    """Each report's rows together, lowest fraction first.

    The window that picked the part left them by line and shift.
    """
    return fractions.sortWithinPartitions(*SHIFT, "good_fraction", "test_cleaned")
