"""Line and site reports.

A report is keyed by (site, line_id, run_at). Sections are rendered from grouped
rows, in parallel; only the last step puts the pieces of one document together.
"""

from __future__ import annotations

from datetime import timedelta

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftlab.functions import html, times
from shiftlab.operators import alerts as alert_ops
from shiftlab.operators import changes as change_ops
from shiftlab.operators import points as point_ops
from shiftlab.operators import quality as quality_ops
from shiftlab.operators.points import LINE
from shiftlab.sources import tables

REPORT = [*LINE, "run_at"]
SHIFT = [*LINE, "shift_start"]

# Texts of the documents.
TITLE = "<h1>{line}</h1>\n\n"
CHANGED_TITLE = '<h1 style="background-color:#80bfb7aa;">{line}</h1>\n\n'
SHIFT_TITLE = "<h2>Shift : {shift}</h2>\n\n"
NO_DATA = "No machine data available between {start} and {end} for {line}\n"
NO_FETCH = "<br>Error: No data found\n"
MACHINE = (
    "<b>Earliest timepoint</b>: {earliest}\n\n<b>Latest timepoint</b>: {latest}\n\n"
    "<h2>Non heats</h2> \n\n {nonheats} \n\n<h2>Heats</h2> \n\n {heats}\n"
)
CHANGE_HEADER = ["Control", "Shift start", "Shift end", "Shift end-start", "Shift max-min"]
NO_HEATS = "No heat exceeded {threshold} degrees."
QUALITY_TITLE = "<h2>Quality Report</h2>\n\n"
NO_QUALITY = "<h2>Quality Report</h2>\n<p>No quality data found between {start} and {end} for {line}.</p>\n"
NO_SPECS = "<p>No quality measurements found with specifications.</p>\n\n"
QUALITY = "<p>Latest data is until {latest}.</p>\n\n<b>Current part number</b>: {part}\n\n{table}\n\n"
FRACTION_HEADER = ["Measurement", "Good Fraction"]
ALERT_TITLE = "<h2>Alert Report</h2>\n\n"
NO_HISTORY = "<h2>Alert Report</h2>\n<p>No alert history available.</p>\n\n"
ALERTS = "<p>Disabled alerts in the last {lookback}.</p>\n\n{table}"
NO_ALERTS = "<p>No disabled alerts in the last {lookback}.</p>\n\n"
SEPARATOR = "\n\n----------------------------------------<br>\n\n"
SUBJECT = "{line} process report : {shift}"
SITE_SUBJECT = "{site} process report: {shift}"
PATH = "{site}/{date}/process_change_{letter}.html"

DUPLICATE_ERROR = "more than one reading for one time and control"
BUCKET_ERROR = "bucket names no measurement"


def two_decimals(value: Column) -> Column:
    return F.when(value.isNull(), F.lit("nan")).otherwise(F.format_string("%.2f", value))


def six_decimals(value: Column) -> Column:
    return F.format_string("%.6f", value)


def process_changes(points: DataFrame, controls: DataFrame, bucket: str | None = "minute",
                    telemetry_tz: str = "UTC", shift_tz: str = "UTC") -> DataFrame:
    """Changes as reports tell them: unique points, first per minute, closed shifts.

    Points are shuffled for three of these steps; they carry keys, not names,
    until they have become one row per control and shift.
    """
    keys = point_ops.name_keys(controls)
    unique = point_ops.unique_points(point_ops.keyed_points(points, keys))
    kept = point_ops.first_per_minute(unique, bucket, line=point_ops.KEYED_LINE)
    kept = kept.withColumn("minute_level", times.to_zone(F.col("minute_level"), telemetry_tz, shift_tz))
    observed = change_ops.observed_changes(
        kept, "minute_level", line=point_ops.KEYED_LINE, control="control_key")
    return change_ops.complete_changes(point_ops.named(observed, keys), controls)


def change_sections(changes: DataFrame) -> DataFrame:
    """Per line and shift: rendered rows of both tables, the change flag, the times seen.

    A group holds one short string per configured control of the line, and is
    already in one place, since the changes were completed by line and shift.
    """
    heat = F.col("kind") == "heat"

    def shown(name: str) -> Column:
        whole = F.coalesce(F.col(name).try_cast("bigint").cast("string"), F.lit("nan"))
        return F.when(heat, whole).otherwise(two_decimals(F.col(name)))

    sign = F.when(heat, F.signum(F.col("delta").try_cast("bigint"))).otherwise(F.signum("delta"))
    cells = [html.signed_cell(shown(n), sign) if n == "delta" else html.cell(shown(n))
             for n in ("start_value", "end_value", "delta", "spread")]
    rendered = html.row(html.cell(html.escape(F.col("control"))), *cells)
    order = [-F.col("spread"), F.col("control_ordinal")]
    return changes.groupBy(*SHIFT).agg(
        html.joined_rows(order, F.when(~heat, rendered)).alias("nonheat_rows"),
        html.joined_rows(order, F.when(change_ops.beyond_threshold(), rendered)).alias("heat_rows"),
        F.bool_or(change_ops.moved()).alias("changed"),
        F.min("earliest").alias("earliest"),
        F.max("latest").alias("latest"),
        *([F.max("copies").alias("copies")] if "copies" in changes.columns else []),
    )


def process_section(empty_fetch: Column) -> Column:
    """Machine part of a line report, from a run joined with its section; an empty fetch says so."""
    line, start, end = F.col("line_id"), *_bounds()
    title = F.when(F.col("changed"), html.fill(CHANGED_TITLE, line=line)).otherwise(html.fill(TITLE, line=line))
    heats = F.when(F.col("heat_rows") != "", html.table(CHANGE_HEADER, F.col("heat_rows"))).otherwise(
        html.fill(NO_HEATS, threshold=F.col("threshold").cast("string")))
    found = html.fill(
        MACHINE, earliest=times.timestamp_text(F.col("earliest")), latest=times.timestamp_text(F.col("latest")),
        nonheats=html.table(CHANGE_HEADER, F.col("nonheat_rows")), heats=heats)
    missing = html.text(html.fill(NO_DATA, start=start, end=end, line=line),
                        F.when(empty_fetch, F.lit(NO_FETCH)).otherwise(F.lit("")))
    return html.text(title, html.fill(SHIFT_TITLE, shift=F.col("shift_label")),
                     F.when(F.col("earliest").isNull(), missing).otherwise(found))


def _bounds() -> tuple[Column, Column]:
    return times.timestamp_text(F.col("shift_start")), times.timestamp_text(F.col("shift_end"))


def quality_sections(stats: DataFrame, site_tz: str = "America/Chicago") -> DataFrame:
    """Per line and shift with measurements: the part, the last time, the table rows."""
    rows = quality_ops.ranked_fractions(stats)
    shown = F.col("is_current") & F.col("good_fraction").isNotNull()
    cells = html.row(html.cell(html.escape(F.col("test_cleaned"))), html.cell(six_decimals(F.col("good_fraction"))))
    return rows.groupBy(*SHIFT).agg(
        html.joined_rows([F.round("good_fraction", 6), F.col("test_cleaned")], F.when(shown, cells)).alias("fraction_rows"),
        F.max(F.when(F.col("is_current"), F.col("part_item"))).alias("part_item"),
        times.to_zone(F.max("latest"), "UTC", site_tz).alias("latest_local"),
    )


def quality_section() -> Column:
    """Quality part of a line report."""
    start, end = _bounds()
    empty = html.fill(NO_QUALITY, start=start, end=end, line=F.col("line_id"))
    found = html.fill(
        QUALITY, latest=times.timestamp_text(F.col("latest_local")), part=html.escape(F.col("part_item")),
        table=html.table(FRACTION_HEADER, F.col("fraction_rows")))
    body = F.when(F.col("fraction_rows") == "", F.lit(NO_SPECS)).otherwise(found)
    return F.when(F.col("latest_local").isNull(), empty).otherwise(html.text(QUALITY_TITLE, body))


def alert_sections(alerts: DataFrame, runs: DataFrame, site_tz: str = "America/Chicago",
                   known_at_run: bool = False) -> DataFrame:
    """Per report: rendered rows of its alert table, oldest change first.

    An alert shows in every run of its look-back, so it is rendered before it
    meets them. In a backfill it is also put together with the others of its week
    first, and a run gathers weeks, not rows.
    """
    shown = [F.coalesce(html.escape(F.col(c).cast("string")), F.lit("None")) for c in alert_ops.COLUMNS]
    rendered = html.row(*[html.cell(s) for s in shown])
    rows = alert_ops.alert_rows(alerts, site_tz).select("site", "line_label", "changed_at", rendered.alias("row"))
    if known_at_run:
        found, order, piece = alert_ops.period_texts(alert_ops.by_period(rows), runs), "period", "text"
    else:
        found, order, piece = alert_ops.in_lookback(rows, runs), "changed_at", "row"
    whole = html.joined_rows([F.col(order)], F.col(piece))
    return found.groupBy(*REPORT).agg(F.nullif(whole, F.lit("")).alias("alert_rows"))


def alert_section() -> Column:
    """Alert part of a line report; a site without any history says so."""
    table = html.table(list(alert_ops.COLUMNS.values()), F.col("alert_rows"))
    rows = html.fill(ALERTS, lookback=F.col("lookback"), table=table)
    none = html.fill(NO_ALERTS, lookback=F.col("lookback"))
    body = F.when(F.col("alert_rows").isNull(), none).otherwise(rows)
    return F.when(F.col("has_history"), html.text(ALERT_TITLE, body)).otherwise(F.lit(NO_HISTORY))


#: Added to both ends of a bound on a scan: a minute's rounding, and an hour that a clock repeats.
MARGIN = timedelta(hours=3)


def bounded_reads(runs: DataFrame, points: DataFrame, quality: DataFrame | None, alerts: DataFrame | None,
                  site_tz: str, known_at_run: bool, whole_fetch: bool, telemetry_tz: str, shift_tz: str):
    """The three inputs, cut to what the runs can use by literal bounds that reach the files.

    One look at the runs, a table of lines and clock times, gives the first and
    last instant. ``whole_fetch`` leaves the points as they were fetched.
    """
    begin = alert_ops.cutoff(F.col("run_at"), F.col("lookback"))
    span = runs.agg(F.min("shift_start").alias("low"), F.max("shift_end").alias("high"), F.min(begin).alias("cutoff"),
                    F.max("run_at").alias("last")).first()
    if span.low is not None:
        low, high = span.low - MARGIN, span.high + MARGIN
        if not whole_fetch:
            ends = [times.to_zone(times.wall_clock(t), shift_tz, telemetry_tz) for t in (low, high)]
            points = points.where(F.col("_time").between(*ends))
        if quality is not None:
            quality = tables.scan_quality(quality, low, high, site_tz=site_tz)
    if alerts is not None and span.cutoff is not None:
        instant = dict(alerts.dtypes)["changed_at"] == "timestamp"

        def on_site(t):
            utc = times.to_zone(times.wall_clock(t), site_tz, "UTC")
            return times.utc_to_instant(utc) if instant else utc
        alerts = alerts.where(F.col("changed_at") >= on_site(span.cutoff - MARGIN))
        if known_at_run:
            alerts = alerts.where(F.col("changed_at") <= on_site(span.last + MARGIN))
    return points, quality, alerts


def _with_fetch(runs: DataFrame, sections: DataFrame) -> DataFrame:
    """Runs with the section of their shift, and the most copies of a reading in all shifts of their line's fetch.

    A fetch of a day touches four shifts at most, so a line's sections are one short list.
    """
    held = [c for c in sections.columns if c not in LINE]
    fetched = sections.groupBy(*LINE).agg(
        F.max("copies").alias("fetch_copies"), F.collect_list(F.struct(*held)).alias("fetched"))
    own = F.try_element_at(F.filter("fetched", lambda s: s["shift_start"] == F.col("shift_start")), F.lit(1))
    joined = runs.join(fetched, LINE, "left").withColumn("own", own)
    return joined.select("*", *[F.col("own")[c].alias(c) for c in held if c != "shift_start"]).drop("own", "fetched")


def line_reports(runs: DataFrame, lines: DataFrame, controls: DataFrame, points: DataFrame | list[DataFrame],
                 quality: DataFrame | None = None, specs: DataFrame | None = None,
                 alerts: DataFrame | None = None, bucket: str | None = "minute",
                 site_tz: str = "America/Chicago", known_at_run: bool = False,
                 fail_on: str = "fetch", telemetry_tz: str = "UTC", shift_tz: str = "UTC") -> DataFrame:
    """One report per line and run; the machine part alone without quality and alerts.

    A line that is configured wrongly (``config_error`` of :func:`controls.line_dim`),
    whose bucket names no measurement, or with more than one reading for
    a control and time, gets status ``failed`` and no document, and does not
    touch the other lines. ``fail_on="fetch"`` looks for such readings in all
    points of the line, the rule of a single run. ``"shift"`` looks in the shift
    reported, which suits a backfill: one bad minute does not fail a year. Either
    way the number of copies rides through the groupings that find the changes,
    so the points are read and shuffled once.

    ``points`` may be the several result sets of one fetch; readings that they repeat
    exactly are one then, and no failure.

    Telemetry clocks count as the clock shifts are told on, unless two different
    zones are named. Points are made unique and put in order before they move,
    so an hour that the local clock repeats is not taken for duplicates.
    Quality and alerts are stored in UTC and told on ``site_tz``.
    """
    if fail_on not in ("fetch", "shift"):
        raise ValueError(f"fail_on is 'fetch' or 'shift', not {fail_on!r}")
    if isinstance(points, list):
        points = point_ops.union_distinct(points)
    history = alerts
    points, quality, alerts = bounded_reads(
        runs, points, quality, alerts, site_tz, known_at_run, fail_on == "fetch", telemetry_tz, shift_tz)
    lines = lines.where("config_error is null")
    controls = controls.join(lines.select(*LINE), LINE, "left_semi")
    sections = change_sections(process_changes(points, controls, bucket, telemetry_tz, shift_tz))
    if fail_on == "fetch":
        reports = _with_fetch(runs, sections)
        duplicated, empty_fetch = F.col("fetch_copies") > 1, F.col("fetch_copies").isNull()
    else:
        reports = runs.join(sections, SHIFT, "left")
        duplicated, empty_fetch = F.col("copies") > 1, F.lit(False)
    document = process_section(empty_fetch)
    if quality is not None:
        rows = quality_ops.with_limits(quality_ops.measurements(quality, lines, site_tz), specs)
        reports = reports.join(quality_sections(quality_ops.test_statistics(rows), site_tz), SHIFT, "left")
        document = html.text(document, quality_section())
    if alerts is not None:
        history = history.select("site").distinct().withColumn("has_history", F.lit(True))
        reports = (
            reports.join(alert_sections(alerts, runs, site_tz, known_at_run), REPORT, "left")
            .join(history, "site", "left")
            .withColumn("has_history", F.coalesce("has_history", F.lit(False)))
        )
        document = html.text(document, alert_section())
    error = F.when(F.col("config_error").isNotNull(), F.col("config_error")).when(
        F.col("measurement").isNull(), F.lit(BUCKET_ERROR)).when(duplicated, F.lit(DUPLICATE_ERROR))
    ok = F.col("error").isNull()
    return reports.withColumn("error", error).select(
        *REPORT, "line", "ordinal", "recipients", "shift_start", "shift_label",
        F.when(ok, html.fill(SUBJECT, line=F.col("line_id"), shift=F.col("shift_label"))).alias("subject"),
        F.when(ok, html.text(document, SEPARATOR)).alias("html"),
        F.when(ok, F.coalesce("changed", F.lit(False))).alias("changed"),
        F.when(ok, F.lit("success")).otherwise(F.lit("failed")).alias("status"),
        "error",
    )


def _pick(shift_of: str):
    if shift_of not in ("first", "last"):
        raise ValueError(f"shift_of is 'first' or 'last', not {shift_of!r}")
    return F.min_by if shift_of == "first" else F.max_by


def _success_order() -> Column:
    return F.when(F.col("status") == "success", F.struct("ordinal", "line_id"))


def site_reports(reports: DataFrame, shift_of: str = "first") -> DataFrame:
    """One document per site and run, lines in configured order.

    Failed lines give no text but their recipients still get the document. A
    site with failed lines only gets none. The shift named is that of the first
    (or, with ``shift_of="last"``, the last) line that succeeded.
    """
    return (
        reports.groupBy("site", "run_at")
        .agg(
            _pick(shift_of)("shift_label", _success_order()).alias("shift_label"),
            html.joined_rows([F.col("ordinal"), F.col("line_id")], F.col("html")).alias("full_html"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("recipients")))).alias("recipients"),
            F.count_if(F.col("status") == "success").alias("succeeded"),
        )
        .where(F.col("succeeded") > 0)
        .select(
            "site", "run_at", "shift_label",
            times.shift_letter(F.col("shift_label")).alias("shift_letter"),
            html.fill(SITE_SUBJECT, site=F.upper("site"), shift=F.col("shift_label")).alias("subject"),
            "full_html", "recipients",
            blob_path(F.col("site"), F.col("run_at"), F.col("shift_label")).alias("path"),
        )
    )


def blob_path(site: Column, run_at: Column, label: Column) -> Column:
    """Place of a document; the date is that of the run, not of the shift."""
    return html.fill(PATH, site=site, date=run_at.cast("date").cast("string"), letter=times.shift_letter(label))


def run_counts(reports: DataFrame) -> DataFrame:
    ok = F.col("status") == "success"
    return reports.groupBy("site").agg(
        F.count("*").alias("reports"), F.count_if(ok).alias("succeeded"), F.count_if(~ok).alias("failed"))


def failed_lines(reports: DataFrame) -> DataFrame:
    return reports.where(F.col("status") == "failed").select(*REPORT, "error")


def site_labels(reports: DataFrame, shift_of: str = "first") -> DataFrame:
    """The shift that each site's document names, where it has one; a short row per document, without its text."""
    return reports.groupBy("site", "run_at").agg(
        _pick(shift_of)("shift_label", _success_order()).alias("site_label"),
        F.count_if(F.col("status") == "success").alias("succeeded")).where("succeeded > 0").drop("succeeded")


def document_paths(reports: DataFrame, shift_of: str = "first") -> DataFrame:
    """Place of every site's document, without building it."""
    label = F.col("site_label")
    return site_labels(reports, shift_of).select(
        "site", "run_at", label.alias("shift_label"), times.shift_letter(label).alias("shift_letter"),
        blob_path(F.col("site"), F.col("run_at"), label).alias("path"))


def with_site_label(reports: DataFrame, shift_of: str = "first") -> DataFrame:
    """Add the shift its site's document names to every report that succeeded.

    The labels are grouped by themselves and joined, so that no text of a report is
    held in a window. The reports are read twice, the first time without their
    texts: have them stored.
    """
    labels = site_labels(reports, shift_of).withColumnsRenamed({"site": "_site", "run_at": "_run_at"})
    joined = reports.where(F.col("status") == "success").join(
        labels, F.col("site").eqNullSafe(F.col("_site")) & F.col("run_at").eqNullSafe(F.col("_run_at")))
    return joined.drop("_site", "_run_at")


def report_history(reports: DataFrame, run_id: str, shift_of: str = "first") -> DataFrame:
    """One row per line that succeeded, with the place of its site's document."""
    document = Window.partitionBy("site", "run_at")
    rows = reports.select("site", "line", "line_id", "run_at", "ordinal", "shift_label", "status").withColumn(
        "site_label", _pick(shift_of)("shift_label", _success_order()).over(document))
    return rows.where(F.col("status") == "success").select(
        "site", "line", F.col("shift_label").alias("shift"),
        blob_path(F.col("site"), F.col("run_at"), F.col("site_label")).alias("blob_path"),
        "status", F.lit(run_id).alias("run_id"), F.col("run_at").alias("generated_at"))


def document_parts(reports: DataFrame, shift_of: str = "first") -> DataFrame:
    """Site documents as ordered pieces, one per line, never joined into one value.

    For sites with so many lines that a whole document is too large for a row.
    Give it stored reports, see :func:`with_site_label`.
    """
    return with_site_label(reports, shift_of).select(
        "site", "run_at", F.col("run_at").cast("date").alias("report_date"),
        times.shift_letter(F.col("site_label")).alias("shift_letter"), "ordinal", "line_id", "html")


def outbox(sites: DataFrame) -> DataFrame:
    """What to send to whom; sending is left to a mail service."""
    return sites.select("site", "run_at", "recipients", "subject", "full_html")
