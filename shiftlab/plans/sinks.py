"""Writers for documents, history and outgoing mail."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def write_telemetry(points: DataFrame, path: str, mode: str = "append") -> None:
    """Telemetry by site and day, and inside a day by line, control and time.

    Row groups so hold few lines and a short time each, and with their statistics
    and bloom filters a fetch of one line skips the others. Rows are dealt by
    ranges of that order, so that a hot site, day or line spans many tasks and files.
    """
    order = ["site", "date", "line", "_field", "_time"]
    ranged = points.withColumn("date", F.to_date("_time")).repartitionByRange(*order).sortWithinPartitions(*order)
    writer = ranged.write.mode(mode).partitionBy("site", "date")
    for column in ("line", "_field"):
        writer = writer.option(f"parquet.bloom.filter.enabled#{column}", "true")
    writer.parquet(path)


def write_broken_files(broken: DataFrame, path: str, run_id: str) -> DataFrame:
    """Input files that a run set aside, under the run; a repeated run replaces its own."""
    (
        broken.withColumn("run_id", F.lit(run_id))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("run_id").json(path)
    )
    stored = broken.sparkSession.read.schema("kind string, file string, error string, run_id string").json(path)
    return stored.where(F.col("run_id") == run_id)


def write_document_parts(parts: DataFrame, path: str) -> None:
    """Folders ``site=/report_date=/shift_letter=``, each document as text files that read in name order.

    Pieces are spread by range, so a large site fills several tasks and files.
    The order begins with the folder columns, and these are never null, so the
    writer takes it as it is and does not sort again by folder alone.
    """
    folder = ["site", "report_date", "shift_letter"]
    order = [*folder, "run_at", "ordinal", "line_id"]
    named = parts.withColumns({c: F.coalesce(c, F.lit("")) for c in ("site", "shift_letter")})
    (
        named.repartitionByRange(*order).sortWithinPartitions(*order)
        .select(*folder, F.col("html").alias("value"))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("site", "report_date", "shift_letter").text(path)
    )


def write_line_reports(reports: DataFrame, path: str, run_id: str) -> DataFrame:
    """Store line reports under their run and read them back.

    Site documents, history and mail all start from the stored rows, so the
    tables behind them are read once, and a lost executor repeats little.
    """
    (
        reports.withColumn("run_id", F.lit(run_id))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id").parquet(path)
    )
    stored = reports.sparkSession.read.parquet(path)
    return stored.where(F.col("run_id") == run_id).drop("run_id")


def append_history(history: DataFrame, path: str) -> None:
    """Add a run's rows. A repeated run replaces its own rows and no others."""
    (
        history.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id").parquet(path)
    )


def write_outbox(mails: DataFrame, path: str, run_id: str) -> None:
    """Mail to send, under its run; a repeated run replaces its own."""
    (
        mails.withColumn("run_id", F.lit(run_id))
        .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
        .partitionBy("run_id").parquet(path)
    )
