"""Helpers of all operators: shared tables, workers' imports, running sums."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

import shiftlab

#: A word of a text, as a Java and DuckDB pattern.
WORD = r"[^\x20\x09-\x0D]+"

#: Whether Spark removes the shuffle files of a query when it ends, rather than when the driver collects garbage.
CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Let Python workers import this package, wherever they run."""
    app = spark.sparkContext.applicationId
    if app in _shipped:
        return
    root = os.path.dirname(os.path.abspath(shiftlab.__file__))
    target = os.path.join(tempfile.mkdtemp(prefix="shiftlab-code-"), "shiftlab_code.zip")
    with zipfile.ZipFile(target, "w") as out:
        for folder, _, names in os.walk(root):
            for name in names:
                if name.endswith(".py"):
                    path = os.path.join(folder, name)
                    out.write(path, os.path.join("shiftlab", os.path.relpath(path, root)))
    spark.sparkContext.addPyFile(target)
    _shipped.add(app)


def shared_folder(spark: SparkSession) -> str:
    """``spark.checkpoint.dir``, the folder that all executors share.

    Where that is unset, a local master gets a folder of its own; a cluster gets an
    error, since a folder of one machine would be lost with it.
    """
    base = spark.conf.get("spark.checkpoint.dir", None)
    if not base:
        if not spark.sparkContext.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
        base = os.path.join(tempfile.gettempdir(), f"shiftlab-{spark.sparkContext.applicationId}")
        spark.conf.set("spark.checkpoint.dir", base)
    return base.rstrip("/")


def stored(df: DataFrame, purpose: str) -> DataFrame:
    """The frame, written once to the shared folder and read from there.

    What follows starts from those files, so a lost executor repeats one task and
    no earlier stage, and the shuffle files behind them go at once.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/llm-{purpose}-{uuid.uuid4().hex}"
    before = spark.conf.get(CLEANUP)
    spark.conf.set(CLEANUP, "true")
    try:
        df.write.parquet(path)
    finally:
        spark.conf.set(CLEANUP, before)
    return spark.read.schema(df.schema).parquet(path)


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def own_columns(df: DataFrame, **columns: str | Column) -> DataFrame:
    """Only the columns an operator works on, under its own names.

    Further columns of the caller, whatever their names, stay out of its joins.
    """
    return df.select(*[(F.col(f"`{c}`") if isinstance(c, str) else c).alias(name) for name, c in columns.items()])


def running_total(df: DataFrame, group: str, order: list[str], amount: str, out: str) -> DataFrame:
    """``out``: the sum of ``amount`` over the rows of ``group`` before this one in ``order``.

    Rows are ranged over tasks by (group, order), so a group with a third of all
    rows spans many tasks. Each task sums its own part, and one short row per
    group and task carries the sums on. The ranged rows are stored, because the
    parts must not be dealt anew between the two steps.
    """
    parts = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranged = df.repartitionByRange(parts, F.col(group), *[F.col(c) for c in order])
    ranged = stored(ranged.withColumn("_part", F.spark_partition_id()), "ranged")
    inside = Window.partitionBy("_part", group).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(group).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sums = ranged.groupBy(group, "_part").agg(F.sum(amount).alias("_sum"))
    sums = sums.select(F.col(group).alias("_group"), F.col("_part").alias("_of"),
                       F.coalesce(F.sum("_sum").over(before), F.lit(0)).alias("_before"))
    joined = ranged.withColumn("_within", F.coalesce(F.sum(amount).over(inside), F.lit(0))).join(
        sums, F.col(group).eqNullSafe(F.col("_group")) & (F.col("_part") == F.col("_of")))
    return joined.withColumn(out, F.col("_before") + F.col("_within")).drop(
        "_part", "_within", "_before", "_group", "_of")


