"""Shift results as partial states that merge.

A state is one short row per shift and control, or per shift, part and test, from
some of the readings. States of any batches merge into a state of the same columns,
and results come from merged states. Readings that arrive days late add their own
rows; nothing read before is read again.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftlab.functions import times
from shiftlab.operators.changes import SHIFT, assign_shift, complete_changes, reading_order, with_timestamps
from shiftlab.operators.points import requested

CONTROL_SHIFT = [*SHIFT, "control"]
TEST_SHIFT = [*SHIFT, "part_item", "test_cleaned", "lsl", "usl"]


def change_states(points: DataFrame, controls: DataFrame, time_col: str = "_time", closed: bool = True,
                  tiebreak: str | None = None) -> DataFrame:
    """State of the changes of the requested controls, from one batch of points.

    Beside what :func:`changes.observed_changes` takes it holds the places of the
    first and last reading, so that a later batch can go before or after them.
    """
    rows = assign_shift(requested(points, controls), time_col, closed=closed)
    value = F.col("_value")
    order = reading_order(F.col("_time"), times.epoch_micros(F.col("_time")), tiebreak)
    grouped = rows.groupBy(*SHIFT, F.col("_field").alias("control")).agg(
        F.min(order).alias("first_at"), F.min_by(value, order).alias("start_value"),
        F.max(order).alias("last_at"), F.max_by(value, order).alias("end_value"),
        F.max(value).alias("high"), F.min(value).alias("low"),
        F.min(time_col).alias("earliest"), F.max(time_col).alias("latest"))
    return with_timestamps(grouped)


def merged_changes(states: DataFrame) -> DataFrame:
    """One state of states; the order in which batches came does not matter.

    Two readings at one place, as when a batch is given twice, are one.
    """
    return states.groupBy(*CONTROL_SHIFT).agg(
        F.min("first_at").alias("first_at"), F.min_by("start_value", "first_at").alias("start_value"),
        F.max("last_at").alias("last_at"), F.max_by("end_value", "last_at").alias("end_value"),
        F.max("high").alias("high"), F.min("low").alias("low"),
        F.min("earliest").alias("earliest"), F.max("latest").alias("latest"))


def changes_of(states: DataFrame, controls: DataFrame) -> DataFrame:
    """Changes of all configured controls from states, as :func:`changes.shift_changes` gives them from points."""
    return complete_changes(merged_changes(states).drop("first_at", "last_at"), controls)


def test_states(rows: DataFrame) -> DataFrame:
    """State of the test statistics, from one batch of measurements with limits.

    The spread is kept as the sum of squares about the batch's own mean, which
    merges without the loss that sums of squares about zero have.
    """
    val, lsl = F.col("val"), F.col("lsl")
    grouped = rows.groupBy(*TEST_SHIFT).agg(
        F.count("*").alias("n_rows"), F.max("datetime").alias("latest"),
        F.count(val).alias("n"), F.avg(val).alias("mean"), (F.var_pop(val) * F.count(val)).alias("squares"),
        F.min(val).alias("low"), F.max(val).alias("high"), F.count_if(val <= lsl).alias("n_le"),
        F.max(F.when(val <= lsl, val)).alias("below"), F.min(F.when(val > lsl, val)).alias("above"))
    return with_timestamps(grouped)


def _both(a: Column, b: Column) -> Column:
    """Count, mean and sum of squares of two batches together."""
    n, apart = a["n"] + b["n"], b["mean"] - a["mean"]
    share = b["n"] / n
    return F.struct(
        n.alias("n"), (a["mean"] + apart * share).alias("mean"),
        (a["squares"] + b["squares"] + apart * apart * a["n"] * share).alias("squares"))


def merged_tests(states: DataFrame) -> DataFrame:
    """One state of states, a row per batch and test at most in a group.

    Means and squares are put together batch by batch in a fixed order, so that results repeat.
    """
    moments = F.struct(F.col("n"), F.col("mean"), F.col("squares"))
    grouped = states.groupBy(*TEST_SHIFT).agg(
        F.sum("n_rows").alias("n_rows"), F.max("latest").alias("latest"),
        F.sort_array(F.collect_list(F.when(F.col("n") > 0, moments))).alias("moments"),
        F.min("low").alias("low"), F.max("high").alias("high"), F.sum("n_le").alias("n_le"),
        F.max("below").alias("below"), F.min("above").alias("above"))
    rest = F.slice("moments", 2, F.greatest(F.size("moments") - 1, F.lit(0)))
    whole = F.aggregate(rest, F.try_element_at("moments", F.lit(1)), _both)
    return grouped.withColumn("whole", whole).select(
        *TEST_SHIFT, "n_rows", "latest", F.coalesce("whole.n", F.lit(0)).cast("long").alias("n"), "whole.mean", "whole.squares",
        "low", "high", "n_le", "below", "above")


def statistics_of(states: DataFrame) -> DataFrame:
    """Test statistics from states, as :func:`quality.test_statistics` gives them from measurements."""
    sd = F.when(F.col("n") > 1, F.sqrt(F.greatest(F.col("squares"), F.lit(0.0)) / (F.col("n") - 1)))
    return merged_tests(states).withColumn("sd", sd).drop("squares")


def write_states(states: DataFrame, path: str, batch: str) -> None:
    """Keep the state of one batch; a batch written again replaces itself and no other."""
    (
        states.withColumn("batch", F.lit(batch)).write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic").partitionBy("batch").parquet(path)
    )


def read_states(spark, path: str, schema) -> DataFrame:
    return spark.read.schema(schema).parquet(path)
