"""One Spark query per operator of the library, over the whole supplied tables."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime
from functools import partial

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from registry import views
from shiftlab import session
from shiftlab.functions import numeric, text, times
from shiftlab.operators import alerts, changes, controls, partials, points, quality
from shiftlab.operators.sizes import sized
from shiftlab.plans import documents, reports, runs, sinks
from shiftlab.sources import synthetic, tables
from shiftlab.streaming import changes as stream

AS_OF = datetime(2024, 1, 31, 6, 2)
RUN_AT = datetime(2024, 1, 16, 6, 2)
FIRST_RUN = datetime(2024, 1, 1, 6, 2)
RUN_ID = "backfill-1"

REGISTERED: dict[str, Callable[[SparkSession, str], DataFrame]] = {}


def query(fn: Callable[[SparkSession, str], DataFrame]):
    REGISTERED[fn.__name__] = fn
    return fn


def r6(name: str, value: Column | None = None) -> Column:
    """Six decimals, and no negative zero."""
    return (F.round(F.col(name) if value is None else value, 6) + 0.0).alias(name)


def lines(spark: SparkSession) -> DataFrame:
    return controls.line_dim(views.line_config(spark))


def control_dim(spark: SparkSession) -> DataFrame:
    return controls.line_controls(views.line_config(spark))


def scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return tables.scan_telemetry(views.telemetry(spark, sf_dir), measurement="opcua")


def change_columns(df: DataFrame) -> DataFrame:
    return df.select("site", "line_id", "shift_start", "shift_end", "shift_label", "kind", "control",
                     r6("start_value"), r6("end_value"), r6("delta"), r6("spread"))


def half_open(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Changes in half-open shifts; readings at one instant in the order of their ids."""
    return changes.shift_changes(scan(spark, sf_dir), control_dim(spark), closed=False, tiebreak="event_id")


# Telemetry and shift changes

@query
def shift_changes_all(spark, sf_dir):
    """Which controls moved in which shift, on every line."""
    return change_columns(half_open(spark, sf_dir))


@query
def shift_changes_uniform_start(spark, sf_dir):
    """The same with one day-shift start for all lines, as the stream computes it."""
    found = changes.observed_changes(
        points.requested(scan(spark, sf_dir), control_dim(spark)), dayshift_start="07:00:00", closed=False,
        tiebreak="event_id")
    return found.select(
        "site", "line_id", "shift_start", "control", r6("start_value"), r6("end_value"), r6("high"), r6("low"),
        "earliest", "latest")


@query
def shift_changes_closed(spark, sf_dir):
    """Closed shifts on minutes, so that boundary readings count in both."""
    rounded = scan(spark, sf_dir).withColumn("minute_level", times.round_minute(F.col("_time")))
    return change_columns(changes.shift_changes(rounded, control_dim(spark), time_col="minute_level", tiebreak="event_id"))


@query
def shift_changes_tiebreak(spark, sf_dir):
    """Hourly instants, so that most readings share theirs."""
    seconds = times.epoch_seconds(F.col("_time"))
    coarse = scan(spark, sf_dir).withColumn("_time", times.from_seconds(seconds - seconds % 3600))
    return change_columns(changes.shift_changes(
        coarse, control_dim(spark), closed=False, tiebreak="event_id"))


@query
def process_changes(spark, sf_dir):
    """The whole machine part: own measurement, first per minute, closed shifts."""
    rows = tables.scan_telemetry(views.telemetry(spark, sf_dir), lines=lines(spark))
    return change_columns(reports.process_changes(rows, control_dim(spark)))


@query
def process_changes_run(spark, sf_dir):
    """One scheduled run: a 24-hour look-back, and the shift that run reports."""
    rows = tables.scan_telemetry(views.telemetry(spark, sf_dir), as_of=RUN_AT, measurement="opcua")
    found = reports.process_changes(rows, control_dim(spark))
    run = runs.scheduled_run(lines(spark), RUN_AT).select("site", "line_id", "shift_start")
    return change_columns(found.join(run, ["site", "line_id", "shift_start"]))


@query
def assign_shifts(spark, sf_dir):
    """The shift or shifts of every reading, closed."""
    rows = scan(spark, sf_dir).withColumn("minute_level", times.round_minute(F.col("_time")))
    wanted = points.requested(rows, control_dim(spark))
    shifted = changes.with_timestamps(changes.assign_shift(wanted, "minute_level"))
    return shifted.select("event_id", "line_id", "minute_level", "shift_start",
                          times.shift_end(F.col("shift_start")).alias("shift_end"))


@query
def shift_for_run(spark, sf_dir):
    """The shift a run reports, for a clock time and day-shift start per order."""
    start = F.element_at(
        F.array(*[F.lit(s) for s in ("07:00:00", "06:30:00", "00:00:00", "12:15:30", "19:00:00")]),
        (F.col("o_custkey") % 5 + 1).cast("int"))
    run_at = F.timestamp_add("MINUTE", (F.col("o_orderkey") * 7) % 1440, F.col("o_orderdate"))
    shift = times.run_shift(run_at, start)
    rows = views.load(spark, sf_dir, "orders").select("o_orderkey", run_at.alias("run_at"), shift.alias("s"))
    return rows.select("o_orderkey", "run_at", "s.shift_start", "s.shift_end", "s.shift_label",
                       times.shift_letter(F.col("s.shift_label")).alias("shift_letter"))


@query
def heat_over_threshold(spark, sf_dir):
    found = half_open(spark, sf_dir)
    kept = changes.by_spread(changes.over_threshold(found))
    return kept.select("site", "line_id", "shift_label", "control", "threshold", r6("delta"),
                       "shown_start", "shown_end", "shown_delta", "shown_spread")


@query
def change_ranking(spark, sf_dir):
    """Place of each control in its table: widest range first."""
    from pyspark.sql import Window
    found = half_open(spark, sf_dir)
    place = Window.partitionBy(*changes.SHIFT, "kind").orderBy(
        F.desc_nulls_last(F.round("spread", 6)), "control_ordinal")
    return found.select("site", "line_id", "shift_label", "kind", "control",
                        F.row_number().over(place).alias("place"))


@query
def shift_coverage(spark, sf_dir):
    found = changes.observed_changes(points.requested(scan(spark, sf_dir), control_dim(spark)), closed=False)
    return changes.coverage(found)


@query
def changed_flag(spark, sf_dir):
    found = half_open(spark, sf_dir)
    return changes.changed_flag(found).drop("shift_start")


@query
def telemetry_scan(spark, sf_dir):
    """The fetch of one run: 24 hours, each line's own measurement."""
    rows = tables.scan_telemetry(views.telemetry(spark, sf_dir), lines=lines(spark), as_of=RUN_AT)
    return rows.select("event_id", *points.POINT)


@query
def telemetry_clustered(spark, sf_dir):
    """The fetch of one line's 24 hours from telemetry that the library has laid out, sites named by numbers."""
    folder = session.work_folder(spark, "telemetry")
    rows = views.telemetry(spark, sf_dir).withColumn("site", F.replace("site", F.lit("alpha"), F.lit("007")))
    sinks.write_telemetry(rows, folder)
    found = tables.scan_telemetry(tables.read_telemetry(spark, folder).where("line = 'l1'"), as_of=RUN_AT, measurement="opcua")
    return found.select("event_id", *points.POINT)


@query
def minute_rounding(spark, sf_dir):
    return views.load(spark, sf_dir, "events").select("event_id", times.round_minute(F.col("ts")).alias("minute_level"))


@query
def shift_changes_local(spark, sf_dir):
    """Shifts told on the clock of the site, for telemetry stored in UTC."""
    local = times.to_zone(F.col("_time"), "UTC", "America/Chicago")
    rows = scan(spark, sf_dir).withColumn("local_time", local)
    return change_columns(changes.shift_changes(
        rows, control_dim(spark), time_col="local_time", closed=False, tiebreak="event_id"))


@query
def field_semijoin(spark, sf_dir):
    return points.requested(scan(spark, sf_dir), control_dim(spark)).select(
        "event_id", "site", "line_id", "_time", "_field", "_value")


@query
def minute_dedup(spark, sf_dir):
    wanted = points.requested(scan(spark, sf_dir).drop("event_id"), control_dim(spark))
    return points.first_per_minute(wanted).select(*points.POINT, "minute_level")


@query
def minute_dedup_off(spark, sf_dir):
    """Every instant is its own bucket."""
    wanted = points.requested(scan(spark, sf_dir), control_dim(spark))
    return points.first_per_minute(wanted, bucket=None).select(
        "event_id", "site", "line_id", "_time", "_field", "_value", "minute_level")


@query
def wide_minutes(spark, sf_dir):
    wanted = points.requested(scan(spark, sf_dir).drop("event_id"), control_dim(spark))
    return points.widen(points.first_per_minute(wanted), views.FIELDS, "minute_level")


@query
def dup_key_guard(spark, sf_dir):
    rows = scan(spark, sf_dir).select(*points.POINT)
    again = rows.where(F.col("_field") == "heat_3").withColumn("_value", F.col("_value") + 1)
    return points.duplicate_keys(rows.unionByName(again))


@query
def dup_key_lines(spark, sf_dir):
    rows = scan(spark, sf_dir).select(*points.POINT)
    again = rows.where(F.col("_field") == "heat_3").withColumn("_value", F.col("_value") + 1)
    return points.lines_with_duplicates(rows.unionByName(again))


@query
def union_dedup(spark, sf_dir):
    rows = scan(spark, sf_dir).select(*points.POINT)
    return points.union_distinct([rows, rows])


@query
def synthetic_telemetry(spark, sf_dir):
    """Made-up readings for the controls of every supplier, summed up per control."""
    made = synthetic.synthetic_telemetry(
        controls.line_controls(views.supplier_lines(spark, sf_dir)), AS_OF)
    first = F.col("_time") < times.wall_clock(datetime(2024, 1, 30, 18, 2))
    return made.groupBy("site", "line_id", "_field").agg(
        F.count("*").alias("n"), F.min("_time").alias("begins"), F.max("_time").alias("ends"),
        r6("low", F.min("_value")), r6("high", F.max("_value")),
        r6("first_half", F.avg(F.when(first, F.col("_value")))),
        r6("second_half", F.avg(F.when(~first, F.col("_value")))))


# Configuration

@query
def expand_controls(spark, sf_dir):
    return controls.expand_controls(controls.line_controls(views.supplier_lines(spark, sf_dir)))


@query
def line_settings(spark, sf_dir):
    """Defaults and precedence of thresholds, starts, look-backs and measurements."""
    return controls.line_dim(views.supplier_lines(spark, sf_dir)).select(
        "site", "line_id", "dayshift_start", "threshold", "lookback", "measurement")


@query
def site_inherit(spark, sf_dir):
    found = controls.resolve_sites(views.supplier_sites(spark, sf_dir), views.site_lines(spark, sf_dir))
    return found.select(
        "site", "line", "time_start_dayshift", F.array_join("email_recipients", ",").alias("email_recipients"),
        "alert_lookback_timedelta", "heat_threshold", "bucket", "ordinal")


@query
def site_inherit_named(spark, sf_dir):
    """One site asked for: with lines of its own, with common ones, without lines, and an unknown name."""
    table, config = views.supplier_sites(spark, sf_dir), views.own_site_lines(spark, sf_dir)
    found = [controls.resolve_sites(table, config, name).select(
        F.lit(name).alias("asked"), "site", "line", "time_start_dayshift", "heat_threshold", "bucket", "ordinal")
        for name in ("s2", "s3", "s4", "nowhere")]
    return found[0].unionByName(found[1]).unionByName(found[2]).unionByName(found[3])


@query
def lookback_texts(spark, sf_dir):
    """Start of a look-back that orders spell in many ways."""
    lookback = views.spelled("o_orderkey", views.LOOKBACKS)
    run_at = F.timestamp_add("MINUTE", F.col("o_custkey") % 1440, F.col("o_orderdate"))
    return views.load(spark, sf_dir, "orders").select(
        "o_orderkey", lookback.alias("lookback"), alerts.cutoff(run_at, lookback).alias("cutoff"))


@query
def shift_letters(spark, sf_dir):
    """The shift that holds a time, and its letter, for day-shift starts that orders spell in many ways."""
    start = times.clock_seconds(views.spelled("o_orderkey", views.CLOCKS))
    at = F.timestamp_add("MINUTE", (F.col("o_custkey") * 7) % 1440, F.col("o_orderdate"))
    shift = times.from_seconds(times.shift_start_seconds(at, start))
    letter = F.when(shift.isNotNull(), times.shift_letter_of_start(shift, start))
    return views.load(spark, sf_dir, "orders").select(
        "o_orderkey", shift.alias("shift_start"), letter.alias("letter"))


@query
def select_lines(spark, sf_dir):
    """Points of the lines asked for, with or without their site in the name."""
    wanted = controls.select_lines(views.line_config(spark), "alpha", ["alpha-l1", "l2"])
    rows = scan(spark, sf_dir).join(sized(controls.line_dim(wanted).select("site", "line_id")), ["site", "line_id"])
    return rows.groupBy("site", "line_id").agg(F.count("*").alias("points"))


@query
def line_ids(spark, sf_dir):
    """Line id, table, number, measurement and label for a line per customer."""
    site = F.concat(F.lit("s"), F.col("c_nationkey").cast("string"))
    bare = F.concat(F.lit("l"), F.col("c_custkey").cast("string"))
    line = F.when(F.col("c_acctbal") > 3000, F.concat(site, F.lit("-"), bare)).otherwise(bare)
    bucket = F.concat(F.lit("v-"), bare, F.when(F.col("c_acctbal") > 0, F.lit("/ch_")).otherwise(F.lit("/")),
                      F.lower("c_mktsegment"))
    named = views.load(spark, sf_dir, "customer").select(
        "c_custkey", text.line_id(site, line).alias("line_id"), text.line_part(line).alias("line_part"),
        text.measurement_of(bucket).alias("measurement"))
    key = F.col("line_id")
    return named.select(
        "*", text.table_site(key).alias("table_site"), text.line_number(key).alias("line_no"),
        text.line_label(key).alias("line_label"))


@query
def failed_files(spark, sf_dir):
    """Folders of line configurations and alert histories in which some files are broken: what each gives, or why not."""
    folder = session.work_folder(spark, "inputs")
    lines_in = views.supplier_lines(spark, sf_dir).withColumn("part", F.substring("site", 2, 9).cast("int"))
    alerts_in = views.alerts(spark, sf_dir).drop("o_orderkey").withColumn("part", F.month("changed_at") + 12 * F.year("changed_at"))
    views.write_json_files(lines_in, f"{folder}/lines", cut=3, odd=4)
    views.write_json_files(alerts_in, f"{folder}/alerts", cut=3, odd=4)
    part = F.regexp_extract("file", r"part=(\d+)", 1).cast("int").alias("part")
    out = []
    for kind, rows in (("lines", tables.read_line_config(spark, f"{folder}/lines")), ("alerts", tables.read_alerts(spark, f"{folder}/alerts"))):
        good = rows.groupBy(tables.plain_path(F.col("_metadata.file_path")).alias("file")).agg(F.count("*").alias("n_rows"))
        out.append(good.select(F.lit(kind).alias("kind"), part, F.lit(None).cast("string").alias("error"), "n_rows"))
        out.append(tables.broken_files(spark, f"{folder}/{kind}", kind).select("kind", part, "error", F.lit(0).cast("long").alias("n_rows")))
    return out[0].unionByName(out[1]).unionByName(out[2]).unionByName(out[3])


# Quality

def measured(spark, sf_dir, site_tz="UTC"):
    return quality.measurements(views.quality(spark, sf_dir), lines(spark), site_tz)


def statistics(spark, sf_dir):
    return quality.test_statistics(quality.with_limits(measured(spark, sf_dir), views.specs(spark, sf_dir)))


def fraction_columns(df: DataFrame) -> DataFrame:
    return quality.worst_first(df).select(
        "site", "line_id", "shift_start", "part_item", "test_cleaned", "n", "lsl", "usl", r6("good_fraction"))


@query
def sanitize_tests(spark, sf_dir):
    tests = views.quality(spark, sf_dir).groupBy("test").agg(F.count("*").alias("n"))
    return tests.select("test", text.sanitize_test(F.col("test")).alias("test_cleaned"), "n")


@query
def sanitize_documents(spark, sf_dir):
    """The same rules over whole prose texts."""
    cleaned = text.sanitize_test(F.col("text"))
    return tables.spread(views.load(spark, sf_dir, "documents"), "doc_id").select(
        "doc_id", F.length(cleaned).alias("n_chars"), F.md5(cleaned).alias("digest"))


@query
def numeric_coerce(spark, sf_dir):
    """Prices in many spellings, numbers or not."""
    price = F.col("l_extendedprice").cast("string")
    spellings = [
        price, F.concat(F.lit(" "), price, F.lit(" ")), F.concat(price, F.lit("e1")), F.concat(F.lit("+"), price),
        F.concat(price, F.lit("d")), F.replace(price, F.lit("."), F.lit("_")), F.lit("n/a"), F.lit("Infinity"), F.lit("-inf"),
        F.concat(price, F.lit("e400")), F.concat(F.lit("-"), price, F.lit("E-2")), F.lit("0x1F")]
    place = (F.col("l_orderkey") + F.col("l_linenumber") * 5) % len(spellings) + 1
    rows = views.load(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", F.element_at(F.array(*spellings), place.cast("int")).alias("val"))
    return rows.withColumn("number", numeric.to_number(F.col("val")))


@query
def quality_scan_utc(spark, sf_dir):
    """Measurements of one shift given on the site's clock."""
    rows = tables.scan_quality(views.quality(spark, sf_dir), datetime(2024, 1, 9, 7), datetime(2024, 1, 9, 19))
    local = times.to_zone(F.col("datetime"), "UTC", "America/Chicago")
    return rows.withColumn("local_time", local).groupBy(
        "site", "line_no", "datetime", "local_time", "test", "val", "part_item").agg(F.count("*").alias("n"))


@query
def current_part(spark, sf_dir):
    return changes.with_timestamps(quality.current_part(measured(spark, sf_dir)))


@query
def distinct_tests(spark, sf_dir):
    return changes.with_timestamps(quality.distinct_tests(measured(spark, sf_dir)))


@query
def quality_latest_local(spark, sf_dir):
    stats = quality.test_statistics(quality.with_limits(measured(spark, sf_dir, "America/Chicago"), None))
    return quality.latest_measurement(stats)


@query
def good_fraction(spark, sf_dir):
    """All tests of the part being made, undefined ones dropped."""
    return fraction_columns(quality.good_fractions(statistics(spark, sf_dir)))


@query
def good_fraction_two_sided(spark, sf_dir):
    found = quality.good_fractions(statistics(spark, sf_dir), keep_undefined=True)
    return fraction_columns(found.where(F.col("lsl").isNotNull() & (F.col("usl") > 100)))


@query
def good_fraction_lower_only(spark, sf_dir):
    found = quality.good_fractions(statistics(spark, sf_dir), keep_undefined=True)
    return fraction_columns(found.where(F.col("usl").isNull()))


@query
def good_fraction_upper_only(spark, sf_dir):
    found = quality.good_fractions(statistics(spark, sf_dir), keep_undefined=True)
    return fraction_columns(found.where(F.col("lsl").isNull()))


@query
def good_fraction_default_spec(spark, sf_dir):
    found = quality.good_fractions(quality.test_statistics(quality.with_limits(measured(spark, sf_dir), None)))
    return fraction_columns(found)


@query
def good_fraction_clamped(spark, sf_dir):
    return fraction_columns(quality.good_fractions(statistics(spark, sf_dir), clamp=True))


# Alerts

@query
def alert_view(spark, sf_dir):
    run = runs.scheduled_run(lines(spark), AS_OF)
    return alerts.alert_view(views.alerts(spark, sf_dir), run, "UTC")


@query
def alert_local_times(spark, sf_dir):
    """Every change on the site's clock, whatever its age."""
    rows = alerts.alert_rows(views.alerts(spark, sf_dir), "America/Chicago", bucket="minute")
    return alerts.report_columns(rows)


@query
def alert_json(spark, sf_dir):
    """The nested alert settings, stored as JSON text."""
    stored = views.alerts(spark, sf_dir).withColumn("alert_config", F.to_json("alert_config"))
    parsed = alerts.parse_config(stored)
    return parsed.select(
        "o_orderkey",
        text.resource_label(F.col("alert_config.resource")).alias("line_label"),
        text.trigger_label(F.col("alert_config.trigger")).alias("trigger"),
        F.col("alert_config.part_number").alias("part"))


@query
def event_json(spark, sf_dir):
    """A nested field of the JSON the events carry."""
    parsed = views.load(spark, sf_dir, "events").select("event_id", F.from_json("props", "k int").alias("p"))
    return parsed.select("event_id", F.col("p.k").alias("k"))


# Reports

def backfill(spark, sf_dir, full=True, telemetry=None):
    dim = lines(spark)
    wanted = runs.backfill_runs(dim, FIRST_RUN, AS_OF)
    return reports.line_reports(
        wanted, dim, control_dim(spark), tables.scan_telemetry(telemetry or views.telemetry(spark, sf_dir)),
        views.quality(spark, sf_dir) if full else None, views.specs(spark, sf_dir) if full else None,
        views.alerts(spark, sf_dir) if full else None, site_tz="UTC", known_at_run=True,
        fail_on="shift")


def digest(df: DataFrame, column: str) -> list[Column]:
    return [F.md5(F.col(column)).alias("digest"), F.length(F.col(column)).alias("n_chars")]


@query
def line_report_html(spark, sf_dir):
    """All line reports of a month of runs, as digests of the documents."""
    found = backfill(spark, sf_dir)
    return found.select("site", "line_id", "run_at", "shift_label", "subject", "status", "error", "changed",
                        *digest(found, "html"))


@query
def machine_report_html(spark, sf_dir):
    """The older report: the machine part alone."""
    found = backfill(spark, sf_dir, full=False)
    return found.select("site", "line_id", "run_at", "shift_label", "subject", "status", "error", "changed",
                        *digest(found, "html"))


@query
def site_report(spark, sf_dir):
    found = reports.site_reports(backfill(spark, sf_dir))
    return found.select("site", "run_at", "shift_label", "shift_letter", "subject",
                        F.array_join("recipients", ",").alias("recipients"), "path", *digest(found, "full_html"))


@query
def blob_paths(spark, sf_dir):
    """Places of the documents, told without building them."""
    return reports.document_paths(backfill(spark, sf_dir), shift_of="last")


@query
def report_history(spark, sf_dir):
    return reports.report_history(backfill(spark, sf_dir), RUN_ID)


@query
def document_parts(spark, sf_dir):
    """Site documents as ordered pieces, from stored line reports as the job keeps them."""
    stored = sinks.write_line_reports(backfill(spark, sf_dir), session.work_folder(spark, "line-reports"), RUN_ID)
    found = reports.document_parts(stored, shift_of="last")
    return found.select("site", "run_at", "report_date", "shift_letter", "ordinal", "line_id", *digest(found, "html"))


@query
def outbox(spark, sf_dir):
    found = reports.outbox(reports.site_reports(backfill(spark, sf_dir)))
    return found.select("site", "run_at", F.array_join("recipients", ",").alias("recipients"), "subject",
                        *digest(found, "full_html"))


@query
def stored_documents(spark, sf_dir):
    """Every document as it is read back from the very path that history names."""
    out = session.work_folder(spark, "documents")
    stored = sinks.write_line_reports(backfill(spark, sf_dir), f"{out}/line_reports", RUN_ID)
    documents.write_at_paths(reports.site_reports(stored), f"{out}/documents", RUN_ID)
    files = spark.read.text(f"{out}/documents", wholetext=True, recursiveFileLookup=True)
    files = files.select(F.regexp_extract(F.col("_metadata.file_path"), "/documents/(.*)$", 1).alias("blob_path"),
                         *digest(files, "value"))
    named = reports.report_history(stored, RUN_ID).groupBy("site", "generated_at", "blob_path").agg(F.count("*").alias("n_lines"))
    return named.join(files, "blob_path", "left").select(
        "site", F.col("generated_at").alias("run_at"), "blob_path", "n_lines", "digest", "n_chars")


@query
def run_counts(spark, sf_dir):
    return reports.run_counts(backfill(spark, sf_dir))


def with_repeats(spark, sf_dir):
    """Telemetry in which high readings were stored twice with another value."""
    rows = views.telemetry(spark, sf_dir)
    return rows.unionByName(rows.where(F.col("_value") > 300).withColumn("_value", F.col("_value") + 1))


@query
def failed_lines(spark, sf_dir):
    """Reports that fail: no measurement, or a repeated reading in the shift."""
    return reports.failed_lines(backfill(spark, sf_dir, telemetry=with_repeats(spark, sf_dir)))


@query
def line_report_run(spark, sf_dir):
    """One scheduled run with all its sections, as the service makes it twice a day."""
    dim = lines(spark)
    rows = tables.scan_telemetry(views.telemetry(spark, sf_dir), as_of=RUN_AT)
    found = reports.line_reports(
        runs.scheduled_run(dim, RUN_AT), dim, control_dim(spark), rows, views.quality(spark, sf_dir),
        views.specs(spark, sf_dir), views.alerts(spark, sf_dir), site_tz="UTC")
    return found.select("site", "line_id", "run_at", "shift_label", "subject", "status", "error", "changed",
                        *digest(found, "html"))


@query
def failed_config(spark, sf_dir):
    """One run in which wrongly configured lines fail alone."""
    config = views.broken_config(spark)
    dim = controls.line_dim(config)
    rows = tables.scan_telemetry(views.telemetry(spark, sf_dir), as_of=RUN_AT)
    found = reports.line_reports(runs.scheduled_run(dim, RUN_AT), dim, controls.line_controls(config), rows)
    return found.select("site", "line_id", "run_at", "status", "error", "changed")


@query
def failed_run(spark, sf_dir):
    """One run in which a repeated reading anywhere in the fetch fails the line."""
    rows = tables.scan_telemetry(with_repeats(spark, sf_dir), as_of=RUN_AT)
    dim = lines(spark)
    found = reports.line_reports(runs.scheduled_run(dim, RUN_AT), dim, control_dim(spark), rows)
    return found.select("site", "line_id", "run_at", "shift_label", "status", "error", *digest(found, "html"))


# Partial states

@query
def merged_shift_changes(spark, sf_dir):
    """Changes from the states of batches as they arrived, late and repeated readings in later ones; equal to those from all points."""
    folder = session.work_folder(spark, "change-states")
    rows, batches = arriving(spark, sf_dir)
    for i in range(batches):
        batch = tables.scan_telemetry(views.events_as_telemetry(rows.where(F.col("batch") == i)), measurement="opcua")
        states = partials.change_states(batch, control_dim(spark), closed=False, tiebreak="event_id")
        partials.write_states(states, folder, f"batch-{i}")
    stored = partials.read_states(spark, folder, states.schema)
    return change_columns(partials.changes_of(stored, control_dim(spark)))


@query
def merged_good_fraction(spark, sf_dir):
    """Good fractions from the states of three batches of measurements that share all shifts."""
    folder = session.work_folder(spark, "test-states")
    for i in range(3):
        own = views.quality(spark, sf_dir).where(F.pmod(F.xxhash64("datetime", "val"), F.lit(3)) == i)
        rows = quality.with_limits(quality.measurements(own, lines(spark), "UTC"), views.specs(spark, sf_dir))
        states = partials.test_states(rows)
        partials.write_states(states, folder, f"batch-{i}")
    stored = partials.read_states(spark, folder, states.schema)
    return fraction_columns(quality.good_fractions(partials.statistics_of(stored)))


# Streaming

def event_stream(spark, sf_dir):
    schema = views.load(spark, sf_dir, "events").schema
    events = stream.read_stream(spark, sf_dir, schema, glob="events.parquet")
    return tables.scan_telemetry(views.events_as_telemetry(events))


def finished(spark, found):
    """Run a stream over the files there are; the shifts it has closed."""
    out = session.work_folder(spark, "stream-changes")
    stream.write_stream(found, f"{out}/rows", f"{out}/state").awaitTermination()
    return stream_columns(spark.read.schema(found.schema).parquet(f"{out}/rows"))


def stream_columns(done: DataFrame) -> DataFrame:
    return done.select("site", "line_id", "shift_start", "shift_end", "control",
                       r6("start_value"), r6("end_value"), r6("delta"), r6("spread"))


@query
def stream_shift_changes(spark, sf_dir):
    """Changes of closed shifts from a stream of the event files."""
    return finished(spark, stream.stream_shift_changes(event_stream(spark, sf_dir), tiebreak="event_id"))


@query
def stream_distinct(spark, sf_dir):
    """The same from a stream in which every reading comes twice."""
    twice = event_stream(spark, sf_dir).unionByName(event_stream(spark, sf_dir))
    return finished(spark, stream.stream_shift_changes(twice, distinct=True))


def arriving(spark, sf_dir, batches=4):
    """(events by batch of arrival, number of batches): in the order of time, some up to 25 minutes late and some a second time."""
    events = views.load(spark, sf_dir, "events")
    ends = events.agg(F.min("ts").alias("low"), F.max("ts").alias("high")).first()
    first = times.epoch_seconds(times.wall_clock(ends.low))
    span = int((ends.high - ends.low).total_seconds()) // batches + 1
    late = F.when(F.col("event_id") % 7 == 0, F.lit(1500)).otherwise(F.lit(0))
    again = events.where(F.col("event_id") % 10 == 0).withColumn("delay", F.lit(3000))
    rows = events.withColumn("delay", late).unionByName(again)
    batch = F.floor((times.epoch_seconds(F.col("ts")) - first + F.col("delay")) / span)
    return rows.withColumn("batch", batch).drop("delay"), batches + 1


def by_arrival(spark, sf_dir, changes_of):
    """What a stream has written after a run per batch of arrivals, over lines of several shift starts."""
    rows, batches = arriving(spark, sf_dir)
    folder, out = session.work_folder(spark, "arrivals"), session.work_folder(spark, "stream-changes")
    schema = rows.drop("batch").schema
    for i in range(batches):
        rows.where(F.col("batch") == i).drop("batch").write.mode("append").parquet(folder)
        points_in = tables.scan_telemetry(views.events_as_telemetry(stream.read_stream(spark, folder, schema)))
        found = changes_of(points_in, controls.line_controls(views.shifted_config(spark)))
        stream.write_stream(found, f"{out}/rows", f"{out}/state").awaitTermination()
    return spark.read.schema(found.schema).parquet(f"{out}/rows")


@query
def stream_line_shifts(spark, sf_dir):
    """Changes of closed shifts, each line from its own start, run by run as files bring late and repeated readings."""
    return stream_columns(by_arrival(spark, sf_dir, partial(stream.stream_line_shifts, tiebreak="event_id")))


@query
def stream_process_changes(spark, sf_dir):
    """The machine part of reports from the same arrivals: unique points, first instant per minute, closed shifts."""
    return stream_columns(by_arrival(spark, sf_dir, stream.stream_process_changes))
