import os
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from shiftlab import schemas
from shiftlab.operators import controls
from shiftlab.plans import jobs, reports, runs, sinks
from helpers import POINTS, at, config, rows_of

RUN = "2024-03-05 18:02"
DAY = "2024-03-05 "


def setup(spark, *entries):
    table = config(spark, *entries)
    lines, per_line = controls.line_dim(table), controls.line_controls(table)
    return lines, per_line, runs.scheduled_run(lines, at(RUN))


def frame(spark, rows):
    return spark.createDataFrame([("s", line, at(t), f, v) for line, t, f, v in rows], POINTS)


MOVED = [("s-l1", DAY + "08:00", "h_1", 100.25), ("s-l1", DAY + "09:00", "h_1", 120.75),
         ("s-l1", DAY + "08:00", "plug", 2.5), ("s-l1", DAY + "09:30:20", "plug", 1.25)]


def test_machine_report(spark):
    lines, per_line, run = setup(spark, dict(num_heats=2, nonheats=["plug", "idle"]))
    row = reports.line_reports(run, lines, per_line, frame(spark, MOVED)).first()
    assert (row.status, row.error, row.changed, row.shift_label) == ("success", None, True, "2024_03_05 D")
    assert row.subject == "s-l1 process report : 2024_03_05 D"
    style = ' style="background-color:#{}; border: 2px solid #000066;"'
    head = "<table><tr><th>Control</th><th>Shift start</th><th>Shift end</th><th>Shift end-start</th><th>Shift max-min</th></tr>"
    assert row.html == (
        '<h1 style="background-color:#80bfb7aa;">s-l1</h1>\n\n<h2>Shift : 2024_03_05 D</h2>\n\n'
        "<b>Earliest timepoint</b>: 2024-03-05 08:00:00\n\n<b>Latest timepoint</b>: 2024-03-05 09:30:00\n\n"
        f"<h2>Non heats</h2> \n\n {head}"
        f"<tr><td>plug</td><td>2.50</td><td>1.25</td><td{style.format('199bd6aa')}>-1.25</td><td>1.25</td></tr>"
        "<tr><td>idle</td><td>nan</td><td>nan</td><td>0.00</td><td>0.00</td></tr></table> \n\n"
        f"<h2>Heats</h2> \n\n {head}"
        f"<tr><td>h_1</td><td>100</td><td>120</td><td{style.format('e62525aa')}>20</td><td>20</td></tr></table>\n"
        "\n\n----------------------------------------<br>\n\n")


def test_report_without_moves(spark):
    lines, per_line, run = setup(spark, dict(num_heats=1, threshold=30.0))
    row = reports.line_reports(run, lines, per_line, frame(spark, MOVED[:2])).first()
    assert not row.changed and "<h1>s-l1</h1>" in row.html and "No heat exceeded 30.0 degrees." in row.html


def test_report_without_data_is_a_success(spark):
    lines, per_line, run = setup(spark, dict(num_heats=1))
    row = reports.line_reports(run, lines, per_line, frame(spark, [("s-l1", "2024-03-05 19:00:40", "h_1", 1.0)])).first()
    assert (row.status, row.changed) == ("success", False)
    assert row.html.startswith("<h1>s-l1</h1>\n\n<h2>Shift : 2024_03_05 D</h2>\n\nNo machine data available between "
                               "2024-03-05 07:00:00 and 2024-03-05 19:00:00 for s-l1\n")


def test_failures_stay_with_their_line(spark):
    lines, per_line, run = setup(spark, dict(num_heats=1), dict(line="l2", num_heats=1), dict(line="l3", num_heats=1, bucket="none"))
    rows = MOVED + [("s-l2", DAY + "08:00", "h_1", 1.0), ("s-l2", DAY + "08:00", "h_1", 2.0)]
    found = reports.line_reports(run, lines, per_line, frame(spark, rows))
    got = {r.line_id: (r.status, r.error, r.html is None) for r in found.collect()}
    assert got == {"s-l1": ("success", None, False), "s-l2": ("failed", reports.DUPLICATE_ERROR, True),
                   "s-l3": ("failed", reports.BUCKET_ERROR, True)}
    assert rows_of(reports.run_counts(found), "reports", "succeeded", "failed") == [(3, 1, 2)]
    assert rows_of(reports.failed_lines(found), "line_id") == [("s-l2",), ("s-l3",)]


def test_a_duplicate_of_another_shift(spark):
    lines, per_line, run = setup(spark, dict(num_heats=1))
    rows = MOVED + [("s-l1", DAY + "05:00", "h_1", 1.0), ("s-l1", DAY + "05:00", "h_1", 2.0)]
    by_fetch = reports.line_reports(run, lines, per_line, frame(spark, rows))
    by_shift = reports.line_reports(run, lines, per_line, frame(spark, rows), fail_on="shift")
    assert (by_fetch.first().status, by_shift.first().status) == ("failed", "success")
    with pytest.raises(ValueError):
        reports.line_reports(run, lines, per_line, frame(spark, rows), fail_on="never")


def test_result_sets_of_one_fetch(spark):
    """Readings that several result sets repeat are one; two values at one time still fail the line."""
    lines, per_line, run = setup(spark, dict(num_heats=1, nonheats=["plug"]))
    whole, part = frame(spark, MOVED), frame(spark, MOVED[1:])
    alone, both = (reports.line_reports(run, lines, per_line, p).first() for p in (whole, [whole, part, part]))
    assert (alone.status, alone.html) == ("success", both.html)
    assert reports.line_reports(run, lines, per_line, whole.unionByName(part)).first().status == "failed"
    other = frame(spark, [("s-l1", DAY + "08:00", "h_1", 7.0)])
    assert reports.line_reports(run, lines, per_line, [whole, other]).first().status == "failed"


def test_a_duplicate_fails_a_line_without_data_in_its_shift(spark):
    lines, per_line, run = setup(spark, dict(num_heats=1))
    rows = [("s-l1", DAY + "05:00", "h_1", 1.0), ("s-l1", DAY + "05:00", "h_1", 2.0)]
    assert reports.line_reports(run, lines, per_line, frame(spark, rows)).first().status == "failed"


def test_as_stored_buckets(spark):
    """Without minute rounding a reading just after the end of the shift stays out."""
    lines, per_line, run = setup(spark, dict(num_heats=1))
    rows = [("s-l1", DAY + "19:00:10", "h_1", 1.0)]
    rounded = reports.line_reports(run, lines, per_line, frame(spark, rows)).first()
    exact = reports.line_reports(run, lines, per_line, frame(spark, rows), bucket=None).first()
    assert "Earliest" in rounded.html and "No machine data" in exact.html


def test_local_clock_that_repeats_an_hour(spark):
    """06:30 and 07:30 UTC both read 01:30 in Chicago on 2024-11-03; neither is a duplicate."""
    table = config(spark, dict(num_heats=1))
    lines, per_line = controls.line_dim(table), controls.line_controls(table)
    run = runs.scheduled_run(lines, at("2024-11-03 06:02"))
    rows = [("s-l1", "2024-11-03 07:30", "h_1", 50.0), ("s-l1", "2024-11-03 06:30", "h_1", 10.0),
            ("s-l1", "2024-11-03 00:30", "h_1", 99.0), ("s-l1", "2024-11-02 23:30", "h_1", 99.0)]
    row = reports.line_reports(run, lines, per_line, frame(spark, rows), shift_tz="America/Chicago").first()
    assert row.status == "success"
    assert "<b>Earliest timepoint</b>: 2024-11-02 19:30:00" in row.html
    assert "<td>99</td><td>50</td>" in row.html and "<td>-49</td><td>89</td>" in row.html.replace(
        ' style="background-color:#199bd6aa; border: 2px solid #000066;"', "")


def sections(spark, quality_rows, alert_rows):
    lines, per_line, run = setup(spark, dict(num_heats=1, days=10))
    quality = spark.createDataFrame([("s", "1", at(t), test, v, p) for t, test, v, p in quality_rows], schemas.QUALITY)
    alerts = spark.createDataFrame(
        [("s", datetime.fromisoformat(t).replace(tzinfo=timezone.utc), None, "me", True, (r, "<x>_y", "7")) for t, r in alert_rows],
        schemas.ALERT_HISTORY)
    return reports.line_reports(run, lines, per_line, frame(spark, MOVED), quality, None, alerts, site_tz="UTC").first().html


def test_quality_section(spark):
    html = sections(spark, [(DAY + "08:00", "a b", v, "p&q") for v in ("40", "60")], [])
    assert "<p>Latest data is until 2024-03-05 08:00:00.</p>\n\n<b>Current part number</b>: p&amp;q\n\n" in html
    assert "<th>Measurement</th><th>Good Fraction</th></tr><tr><td>a_b</td><td>0.999593</td></tr></table>" in html
    assert "No alert history available." in html


def test_quality_fallbacks(spark):
    assert "No quality data found between 2024-03-05 07:00:00 and 2024-03-05 19:00:00 for s-l1." in sections(spark, [], [])
    assert "No quality measurements found with specifications." in sections(spark, [(DAY + "08:00", "t", "x", "p")], [])
    assert "No quality measurements found with specifications." in sections(
        spark, [(DAY + "08:00", "t", v, None) for v in ("1", "2")], [])


def test_alert_section(spark):
    html = sections(spark, [], [(DAY + "09:00", "line1"), (DAY + "08:00", "line1"), ("2024-02-20 00:00", "line1")])
    assert "<p>Disabled alerts in the last 10 days.</p>" in html
    rows = "<td>Line 1</td><td>7</td><td>&lt;x&gt; y</td><td>me</td><td>2024-03-05 0{}:00:00</td><td>true</td><td>None</td>"
    assert html.index(rows.format(8)) < html.index(rows.format(9)) and "2024-02-20" not in html
    assert "<p>No disabled alerts in the last 10 days.</p>" in sections(spark, [], [(DAY + "09:00", "line2")])


def stored(spark):
    """Line reports of lines 1 (ok), 2 (failed), 3 (ok) of site s, and of a site with one failed line."""
    def row(site, n, status, html, label, who):
        return (site, f"{site}-l{n}", at("2024-03-05 06:02"), f"l{n}", n, who, None, label, None, html, True, status, None)
    rows = [row("s", 3, "success", "<3>", "2024_03_04 D", ["y"]), row("s", 2, "failed", None, "2024_03_04 N", ["z"]),
            row("s", 1, "success", "<1>", "2024_03_04 N", ["x", "y"]), row("t", 1, "failed", None, "2024_03_04 N", ["q"])]
    return spark.createDataFrame(rows, """site string, line_id string, run_at timestamp_ntz, line string, ordinal int,
        recipients array<string>, shift_start timestamp_ntz, shift_label string, subject string, html string,
        changed boolean, status string, error string""")


def test_site_report(spark):
    (row,) = reports.site_reports(stored(spark)).collect()
    assert (row.full_html, row.shift_label, row.recipients) == ("<1><3>", "2024_03_04 N", ["x", "y", "z"])
    assert (row.subject, row.path) == ("S process report: 2024_03_04 N", "s/2024-03-05/process_change_N.html")
    last = reports.site_reports(stored(spark), "last").first()
    assert (last.shift_label, last.path) == ("2024_03_04 D", "s/2024-03-05/process_change_D.html")
    with pytest.raises(ValueError):
        reports.site_reports(stored(spark), "middle")


def test_history_and_outbox(spark):
    history = reports.report_history(stored(spark), "r1")
    assert rows_of(history, "line", "shift", "blob_path", "status", "run_id") == [
        ("l1", "2024_03_04 N", "s/2024-03-05/process_change_N.html", "success", "r1"),
        ("l3", "2024_03_04 D", "s/2024-03-05/process_change_N.html", "success", "r1")]
    assert reports.outbox(reports.site_reports(stored(spark))).columns == ["site", "run_at", "recipients", "subject", "full_html"]


def texts(folder):
    return "".join(open(os.path.join(folder, f), newline="").read() for f in sorted(os.listdir(folder)) if f.startswith("part-"))


def test_document_parts_read_in_order(spark, tmp_path):
    path = str(tmp_path / "parts")
    many = spark.range(500).select(
        F.lit("s").alias("site"), F.concat(F.lit("s-l"), F.col("id").cast("string")).alias("line_id"),
        F.expr("TIMESTAMP_NTZ'2024-03-05 06:02:00'").alias("run_at"), F.col("id").cast("int").alias("ordinal"),
        F.lit("2024_03_04 N").alias("shift_label"), F.concat(F.lit("<"), F.col("id").cast("string"), F.lit(">")).alias("html"),
        F.lit("success").alias("status"))
    many.repartition(7).write.parquet(str(tmp_path / "reports"))
    sinks.write_document_parts(reports.document_parts(spark.read.parquet(str(tmp_path / "reports"))), path)
    folder = f"{path}/site=s/report_date=2024-03-05/shift_letter=N"
    assert texts(folder) == "".join(f"<{i}>\n" for i in range(500))


def test_publish_is_repeatable(spark, tmp_path):
    out = str(tmp_path / "out")
    for run_id in ("r1", "r2", "r2"):
        counts = jobs.publish(stored(spark), out, run_id)
    assert rows_of(counts, "site", "reports", "succeeded", "failed") == [("s", 3, 2, 1), ("t", 1, 0, 1)]
    assert rows_of(spark.read.parquet(f"{out}/history").groupBy("run_id").count(), "run_id", "count") == [("r1", 2), ("r2", 2)]
    assert spark.read.parquet(f"{out}/outbox").count() == 2
    assert open(f"{out}/documents/s/2024-03-05/process_change_N.html").read() == "<1><3>"
    jobs.publish(stored(spark), str(tmp_path / "parts"), "r1", whole=False)
    assert texts(f"{tmp_path}/parts/documents/site=s/report_date=2024-03-05/shift_letter=N") == "<1>\n<3>\n"


def test_backfill_runs(spark):
    lines, _, _ = setup(spark, dict(start="06:30:00"))
    found = runs.backfill_runs(lines, at("2024-03-05 06:02"), at("2024-03-06 06:02"))
    assert rows_of(found, "run_at", "shift_start", "shift_label") == [
        (at("2024-03-05 06:02"), at("2024-03-04 18:30"), "2024_03_04 N"),
        (at("2024-03-05 18:02"), at("2024-03-05 06:30"), "2024_03_05 D"),
        (at("2024-03-06 06:02"), at("2024-03-05 18:30"), "2024_03_05 N")]
