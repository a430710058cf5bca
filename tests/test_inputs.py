"""Broken files stay out with a reason, telemetry keeps its declared types and is read by row group."""

import glob
import json
import os
from datetime import datetime

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from registry import views
from shiftlab import __main__ as main
from shiftlab.operators import controls
from shiftlab.plans import reports, runs, sinks
from shiftlab.sources import tables
from helpers import TELEMETRY, at, config, rows_of
from test_main import LINES, inputs  # noqa: F401

DATA = "/root/testdata/sf0.001"
GOOD = json.dumps([{"site": "a", "line": "l1", "ordinal": 1}, {"site": "a", "line": "l2", "ordinal": 2}])
FILES = {
    "good": GOOD, "cut": GOOD[:50], "empty": "", "blank": "  \n", "words": "hello", "numbers": "[1, 2]", "none": "[]",
    "kinds": '[{"site": "a", "line": "l3", "ordinal": "x"}]', "nameless": '[{"site": "q"}, {"site": "q", "line": "l4"}]', "one": '{"line": "l5"}'}


def short(file):
    return os.path.basename(file).removesuffix(".json")


def test_broken_line_files(spark, tmp_path):
    for name, body in FILES.items():
        (tmp_path / f"{name}.json").write_text(body)
    found = tables.broken_files(spark, str(tmp_path), "lines").collect()
    assert {(short(r.file), r.error) for r in found} == {
        ("cut", tables.NOT_READABLE), ("words", tables.NOT_READABLE), ("numbers", tables.NOT_READABLE), ("kinds", tables.NOT_READABLE),
        ("empty", tables.EMPTY), ("blank", tables.EMPTY), ("nameless", "names no line")}
    assert len(found) == 7 and {r.kind for r in found} == {"lines"}
    rows = tables.read_line_config(spark, str(tmp_path))
    assert rows_of(rows, "line") == [("l1",), ("l2",), ("l4",), ("l5",)]
    assert rows.count() == 4 and rows.select("line").distinct().count() == 4
    assert not controls.line_dim(rows).where("line is null").count()


def test_broken_alert_files(spark, tmp_path):
    row = {"site": "a", "changed_at": "2024-03-01T10:00:00Z", "disabled": True, "alert_config": {"resource": "line1"}}
    bodies = {"good": [row, row], "time": [{**row, "changed_at": "never"}], "flag": [{**row, "disabled": "perhaps"}],
              "nested": [{**row, "alert_config": 5}], "siteless": [{k: v for k, v in row.items() if k != "site"}]}
    for name, body in bodies.items():
        (tmp_path / f"{name}.json").write_text(json.dumps(body))
    (tmp_path / "cut.json").write_text(json.dumps([row, row])[:-30])
    found = tables.broken_files(spark, str(tmp_path), "alerts")
    assert {(short(r.file), r.error) for r in found.collect()} == {
        ("cut", tables.NOT_READABLE), ("time", tables.NOT_READABLE), ("flag", tables.NOT_READABLE), ("nested", tables.NOT_READABLE),
        ("siteless", "names no site")}
    alerts = tables.read_alerts(spark, str(tmp_path))
    assert alerts.count() == 2 and alerts.select("site").count() == 2 and alerts.select("alert_config.resource").count() == 2


def test_json_lines_fail_line_by_line(spark, tmp_path):
    good = '{"site": "a", "changed_at": "2024-03-01T10:00:00Z"}'
    (tmp_path / "a.json").write_text("\n".join([good, good[:20], good]))
    assert tables.read_alerts(spark, str(tmp_path), array_per_file=False).count() == 2
    found = tables.broken_files(spark, str(tmp_path), "alerts", array_per_file=False).collect()
    assert [(short(r.file), r.error) for r in found] == [("a", tables.NOT_READABLE)]


def test_no_broken_file(spark, tmp_path):
    (tmp_path / "a.json").write_text(GOOD)
    assert tables.broken_files(spark, str(tmp_path), "lines").collect() == []


def test_the_job_reports_the_rest(spark, inputs, tmp_path):  # noqa: F811
    folder = tmp_path / "config"
    folder.mkdir()
    (folder / "good.json").write_text(json.dumps(LINES))
    alerts = tmp_path / "alerts"
    alerts.mkdir()
    (alerts / "good.json").write_text(json.dumps([{"site": "a", "changed_at": "2024-03-05T10:00:00Z", "disabled": True,
                                                   "alert_config": {"resource": "line1", "trigger": "x_alert", "part_number": "7"}}]))
    args = [*inputs, "--lines", str(folder), "--alerts", str(alerts), "--as-of", "2024-03-05 18:02", "--site-tz", "UTC"]
    main.run(spark, main.arguments([*args, "--run-id", "before"]))
    (folder / "cut.json").write_text(json.dumps(LINES)[:70])
    (alerts / "words.json").write_text("gateway timeout")
    main.run(spark, main.arguments([*args, "--run-id", "after"]))
    failed = spark.read.json(f"{tmp_path}/out/broken_files").where("run_id = 'after'")
    assert [(r.kind, short(r.file), r.error) for r in failed.orderBy("kind").collect()] == [
        ("alerts", "words", tables.NOT_READABLE), ("lines", "cut", tables.NOT_READABLE)]
    stored = spark.read.parquet(f"{tmp_path}/out/line_reports")
    both = [rows_of(stored.where(F.col("run_id") == r), "site", "line_id", "status", "html") for r in ("before", "after")]
    assert both[0] == both[1] and len(both[0]) == 2 and all("Disabled alerts" in html or "No disabled" in html for *_, html in both[0])


def readings(spark, sites, lines, days, per_day=288):
    rows = spark.range(len(sites) * lines * days * per_day)
    i = F.col("id")
    site = F.element_at(F.array(*[F.lit(s) for s in sites]), (i % len(sites) + 1).cast("int"))
    line = F.concat(F.lit("l"), (F.floor(i / len(sites)) % lines + 1).cast("string"))
    step = F.floor(i / (len(sites) * lines))
    return rows.select(
        site.alias("site"), line.alias("line"), F.lit("opcua").alias("measurement"),
        F.timestamp_add("SECOND", step * (86400 // per_day), F.expr("TIMESTAMP_NTZ'2024-03-01 00:00:00'")).alias("_time"),
        F.concat(F.lit("h_"), (step % 4 + 1).cast("string")).alias("_field"), (i % 97).cast("double").alias("_value"))


def test_folders_of_digits_stay_texts(spark, tmp_path):
    path = str(tmp_path / "telemetry")
    sinks.write_telemetry(readings(spark, ["007", "12"], 2, 2, 24), path)
    found = tables.read_telemetry(spark, path)
    assert dict(found.dtypes) == {"site": "string", "line": "string", "measurement": "string", "_time": "timestamp_ntz",
                                  "_field": "string", "_value": "double", "date": "date"}
    table = config(spark, dict(site="007", line="l1", num_heats=4))
    dim = controls.line_dim(table)
    points = tables.scan_telemetry(found, lines=dim, as_of=at("2024-03-02 06:02"))
    row = reports.line_reports(runs.scheduled_run(dim, at("2024-03-02 06:02")), dim, controls.line_controls(table), points).first()
    assert (row.line_id, row.status) == ("007-l1", "success") and "Earliest" in row.html


def test_other_columns_and_layouts_are_read_as_found(spark, tmp_path):
    rows = readings(spark, ["a"], 1, 1, 10).withColumns({"line_id": F.lit("5"), "event_id": F.lit(3)})
    rows.write.partitionBy("line_id").parquet(str(tmp_path / "t"))
    found = dict(tables.read_telemetry(spark, str(tmp_path / "t")).dtypes)
    assert found["line_id"] == "string" and found["event_id"] == "int" and "date" not in found


def rows_scanned(df):
    """Rows that left the files, after row groups and pages were skipped."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return sum(leaves.apply(i).metrics().apply("numOutputRows").value() for i in range(leaves.size()))


def test_a_fetch_skips_row_groups(spark, tmp_path):
    rows = readings(spark, ["a", "b"], 40, 3)
    small = {"parquet.block.row.count.limit": 500}
    hadoop = spark.sparkContext._jsc.hadoopConfiguration()
    before = {k: hadoop.get(k) for k in small}
    for k, v in small.items():
        hadoop.set(k, str(v))
    try:
        sinks.write_telemetry(rows, str(tmp_path / "clustered"))
        rows.withColumn("date", F.to_date("_time")).repartition(8).write.partitionBy("site", "date").parquet(str(tmp_path / "loose"))
    finally:
        for k, v in before.items():
            hadoop.unset(k) if v is None else hadoop.set(k, v)
    files = glob.glob(f"{tmp_path}/clustered/site=a/date=2024-03-02/*.parquet")
    groups = [(g.column(0).statistics.min, g.column(0).statistics.max, g.num_rows)
              for f in files for g in (pq.ParquetFile(f).metadata.row_group(i) for i in range(pq.ParquetFile(f).metadata.num_row_groups))]
    assert len(groups) > 4 and sum(low <= "l7" <= high for low, high, _ in groups) <= len(groups) / 2
    scanned = {}
    for layout in ("clustered", "loose"):
        telemetry = tables.read_telemetry(spark, f"{tmp_path}/{layout}").where("site = 'a' and line = 'l7'")
        fetch = tables.scan_telemetry(telemetry, as_of=at("2024-03-03 00:00"))
        scanned[layout] = rows_scanned(fetch)
        assert fetch.count() == 288
    assert scanned["clustered"] * 3 < scanned["loose"], scanned


@pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables not present")
def test_clustered_telemetry_tells_the_same(spark, tmp_path):
    rows = views.telemetry(spark, DATA)
    sinks.write_telemetry(rows, str(tmp_path / "t"))
    found = tables.scan_telemetry(tables.read_telemetry(spark, str(tmp_path / "t")), as_of=datetime(2024, 1, 16, 6, 2))
    plain = tables.scan_telemetry(rows, as_of=datetime(2024, 1, 16, 6, 2))
    columns = ["event_id", "site", "line_id", "_time", "_field", "_value"]
    assert rows_of(found, *columns) == rows_of(plain, *columns) and found.count() > 0


def test_wrong_kinds_are_refused(spark):
    with pytest.raises(KeyError):
        tables.broken_files(spark, "x", "telemetry")
    assert TELEMETRY
