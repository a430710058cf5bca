"""Scans: declared schemas, predicates that reach the files."""

from __future__ import annotations

from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftlab import schemas
from shiftlab.functions import numeric, text, times
from shiftlab.operators.sizes import sized

LOOKBACK = timedelta(hours=24)
#: Clocks of two zones are never further apart.
ZONES = timedelta(days=1)


#: Why a file was set aside.
NOT_READABLE = "not readable as declared"
NO_NAME = "names no {column}"
EMPTY = "empty file"
#: What a row of each kind of file must name.
LINE_NAMES, SITE_NAMES, ALERT_NAMES = ("line",), ("site",), ("site",)
_BROKEN = "_broken"


def read_line_config(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Line configurations; files that are broken stay out, see :func:`broken_files`."""
    return _config(spark, path, fmt, schemas.LINE_CONFIG, LINE_NAMES)


def read_site_config(spark: SparkSession, path: str, fmt: str = "json") -> DataFrame:
    """Site configurations; files that are broken stay out."""
    return _config(spark, path, fmt, schemas.SITE_CONFIG, SITE_NAMES)


def _config(spark: SparkSession, path: str, fmt: str, schema, names: tuple[str, ...]) -> DataFrame:
    return _sound(spark, path, schema, names) if fmt == "json" else spark.read.schema(schema).format(fmt).load(path)


def _with_errors(spark: SparkSession, path: str, schema, names: tuple[str, ...], array_per_file: bool) -> DataFrame:
    """Rows of JSON files with their file and what is wrong with them."""
    kept = T.StructType([*schema, T.StructField(_BROKEN, T.StringType())])
    rows = spark.read.schema(kept).option("multiLine", array_per_file).option("mode", "PERMISSIVE").option(
        "columnNameOfCorruptRecord", _BROKEN).json(path)
    error = F.when(F.col(_BROKEN).isNotNull(), F.lit(NOT_READABLE))
    for name in names:
        error = error.when(F.col(name).isNull(), F.lit(NO_NAME.format(column=name)))
    # A reader that is asked for some columns checks only these; this asks for all, so that no query sees rows that another does not.
    values = F.coalesce(*[F.when(F.col(f.name).cast("string").isNotNull(), F.lit(1)) for f in schema])
    error = error.when(values.isNull(), F.lit(NOT_READABLE))
    return rows.select(*[F.col(f.name) for f in schema], plain_path(F.col("_metadata.file_path")).alias("file"), error.alias("error"))


def plain_path(path: Column) -> Column:
    """A local file's path in the one of its spellings that Spark's metadata uses."""
    return F.regexp_replace(path, "^file:/+", "file:/")


def _sound(spark: SparkSession, path: str, schema, names: tuple[str, ...], array_per_file: bool = True) -> DataFrame:
    return _with_errors(spark, path, schema, names, array_per_file).where("error is null").drop("file", "error")


def broken_files(spark: SparkSession, path: str, kind: str, array_per_file: bool = True) -> DataFrame:
    """kind, file, error of JSON files that are not what they should be, one row per file and reason.

    ``kind`` is ``lines``, ``sites`` or ``alerts``. A file that is cut short, no JSON or of another
    shape than declared gives none of its rows to the readers and one row here; a
    row without its names is left out alone. An empty file is broken, an empty list is not.
    """
    schema, names = {"lines": (schemas.LINE_CONFIG, LINE_NAMES), "sites": (schemas.SITE_CONFIG, SITE_NAMES),
                     "alerts": (schemas.ALERT_HISTORY, ALERT_NAMES)}[kind]
    rows = _with_errors(spark, path, schema, names, array_per_file).groupBy("file", "error").agg(F.count("*").alias("n"))
    listed = spark.createDataFrame([(f,) for f in spark.read.text(path).inputFiles()], "file string").select(plain_path(F.col("file")).alias("file"))
    text_files = spark.read.text(path, wholetext=True).where(F.regexp_like("value", F.lit(r"\S")))
    told = rows.select("file").unionByName(text_files.select(plain_path(F.col("_metadata.file_path")).alias("file")))
    empty = listed.join(told.distinct(), "file", "left_anti").withColumn("error", F.lit(EMPTY))
    found = rows.where("error is not null").select("file", "error").unionByName(empty)
    return found.select(F.lit(kind).alias("kind"), "file", "error")


def spread(table: DataFrame, *keys: str) -> DataFrame:
    """Deal a small table out to all cores before heavy work per row.

    A table that comes in at least as many splits as there are cores is left
    alone, so nothing large is ever shuffled for this.
    """
    cores = table.sparkSession.sparkContext.defaultParallelism
    return table if table.rdd.getNumPartitions() >= cores else table.repartition(cores, *keys)


#: What names of folders may stand for; any other is as found.
_FOLDERS = {f.name: f.dataType for f in (*schemas.TELEMETRY, T.StructField("line_id", T.StringType()), T.StructField("date", T.DateType()))
            if f.name != "_time"}


def read_telemetry(spark: SparkSession, path: str) -> DataFrame:
    """Long telemetry with its declared types, so that a folder ``site=007`` stays a text.

    Lay it out with :func:`shiftlab.plans.sinks.write_telemetry`, by site and date:
    ``telemetry/site=.../date=...``. Columns beyond the declared ones keep the types found.
    """
    found = spark.read.parquet(path).schema
    declared = [T.StructField(f.name, _FOLDERS.get(f.name, f.dataType)) for f in found]
    return spark.read.schema(T.StructType(declared)).parquet(path)


def read_quality(spark: SparkSession, path: str) -> DataFrame:
    """Quality measurements; the site is a partition column, not a table name."""
    return spark.read.schema(schemas.QUALITY).parquet(path)


def read_specs(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.schema(schemas.SPECS).parquet(path)


def read_alerts(spark: SparkSession, path: str, fmt: str = "json", array_per_file: bool = True) -> DataFrame:
    """Alert history; JSON files that are broken stay out, see :func:`broken_files`.

    One JSON array per file is read whole by one task, so keep such files small;
    JSON lines (``array_per_file=False``) and parquet split.
    """
    if fmt == "json":
        return _sound(spark, path, schemas.ALERT_HISTORY, ALERT_NAMES, array_per_file)
    return spark.read.schema(schemas.ALERT_HISTORY).format(fmt).load(path)


def scan_telemetry(telemetry: DataFrame, lines: DataFrame | None = None, as_of: datetime | None = None,
                   lookback: timedelta = LOOKBACK, until: datetime | None = None,
                   measurement: str | None = None, since: datetime | None = None) -> DataFrame:
    """Points of a time range, as (site, line_id, _time, _field, _value).

    ``as_of`` keeps the look-back before it, itself excluded, as a fetch at that
    time would. ``since`` and ``until`` are the first and last times to keep.
    Without any of them the whole history is read. When the table has a ``date`` partition column the same
    bounds prune folders. ``lines`` keeps only points
    of each line's own measurement. NaN readings become missing. A table that
    stores ``line_id`` saves working it out for every point.
    """
    if as_of is not None:
        telemetry = _bounded(telemetry, F.col("_time") < times.wall_clock(as_of), as_of, before=True)
        telemetry = _bounded(telemetry, F.col("_time") >= times.wall_clock(as_of - lookback), as_of - lookback)
    if since is not None:
        telemetry = _bounded(telemetry, F.col("_time") >= times.wall_clock(since), since)
    if until is not None:
        telemetry = _bounded(telemetry, F.col("_time") <= times.wall_clock(until), until, before=True)
    if measurement is not None:
        telemetry = telemetry.where(F.col("measurement") == measurement)
    stored = "line_id" in telemetry.columns
    line_id = F.col("line_id") if stored else text.line_id(F.col("site"), F.col("line"))
    known = ("site", "line", "line_id", "measurement", "date", "_time", "_field", "_value")
    extra = [c for c in telemetry.columns if c not in known]
    points = telemetry.select(
        "site", line_id.alias("line_id"),
        *(["measurement"] if "measurement" in telemetry.columns else []),
        "_time", "_field", numeric.missing_if_nan(F.col("_value")).alias("_value"), *extra,
    )
    if lines is not None:
        own = lines.select("site", "line_id", "measurement")
        points = points.join(sized(own), ["site", "line_id", "measurement"], "left_semi")
    return points.drop("measurement")


def _bounded(telemetry: DataFrame, bound: Column, t: datetime, before: bool = False) -> DataFrame:
    """A time bound, and the same on the date folders if there are any."""
    telemetry = telemetry.where(bound)
    if "date" not in telemetry.columns:
        return telemetry
    day = F.lit(t.date())
    return telemetry.where(F.col("date") <= day if before else F.col("date") >= day)


def scan_quality(quality: DataFrame, left: datetime, right: datetime, line_no: str | None = None,
                 site_tz: str = "America/Chicago") -> DataFrame:
    """Five columns of a closed interval given on the site's clock.

    The bounds move to UTC, not the column, so the filter reaches the files.
    """
    bounds = [times.to_zone(times.wall_clock(t), site_tz, "UTC") for t in (left, right)]
    if "date" in quality.columns:
        quality = quality.where(F.col("date").between(F.lit(left.date() - ZONES), F.lit(right.date() + ZONES)))
    rows = quality.select("site", "line_no", "datetime", "test", "val", "part_item")
    rows = rows.where(F.col("datetime").between(*bounds))
    return rows if line_no is None else rows.where(F.col("line_no") == line_no)
