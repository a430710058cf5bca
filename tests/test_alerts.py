import json
from datetime import datetime, timezone

from pyspark.sql import functions as F

from shiftlab import schemas
from shiftlab.operators import alerts
from shiftlab.plans import reports, runs
from shiftlab.sources import tables
from helpers import at, dims, rows_of


def utc(text):
    return datetime.fromisoformat(text).replace(tzinfo=timezone.utc)


def history(spark, *rows):
    return spark.createDataFrame(
        [("s", utc(t), None, "me", disabled, (resource, "TOP_LOAD_alert_good_fraction", "7"))
         for t, resource, disabled in rows], schemas.ALERT_HISTORY)


def view(spark, table, as_of="2024-03-01 00:00", **options):
    lines, _ = dims(spark, dict(line="l8"))
    return alerts.alert_view(table, runs.scheduled_run(lines, at(as_of)), "UTC", **options)


def test_lookback_is_strict_and_keeps_enabled_rows(spark):
    table = history(spark, ("2024-01-01 00:00", "line8", True), ("2024-01-01 00:01", "line8", False),
                    ("2024-02-01 00:00", "line9", True))
    assert rows_of(view(spark, table), "changed_at", "disabled", "line_label", "trigger", "part") == [
        (at("2024-01-01 00:01"), False, "Line 8", "Top load", "7")]


def test_known_at_run(spark):
    table = history(spark, ("2024-03-01 00:00", "line8", True), ("2024-03-01 00:01", "line8", True))
    assert view(spark, table).count() == 2
    assert rows_of(view(spark, table, known_at_run=True), "changed_at") == [(at("2024-03-01 00:00"),)]


def test_periods_do_not_change_a_backfill(spark):
    lines, _ = dims(spark, dict(line="l8", timedelta="45 days"), dict(line="l9", days=100))
    backfill = runs.backfill_runs(lines, at("2023-11-01 06:02"), at("2024-04-01 06:02"))
    table = history(spark, *[(f"2023-{m:02d}-{d:02d} 06:0{d % 5}", f"line{8 + d % 2}", True)
                             for m in range(7, 13) for d in range(1, 28)])
    found = alerts.alert_view(table, backfill, "UTC", known_at_run=True)
    rows = alerts.alert_rows(table, "UTC")
    pairs = backfill.select("line_id", "run_at", "lookback").join(
        rows, (F.replace("line_id", F.lit("s-l"), F.lit("Line ")) == F.col("line_label"))
        & (F.col("changed_at") <= F.col("run_at")) & (F.col("changed_at") > F.expr("run_at - cast(lookback as interval)")))
    assert rows_of(found, "line_id", "run_at", "changed_at") == rows_of(pairs, "line_id", "run_at", "changed_at")
    assert found.count() > 1000


def test_times_are_rounded_and_local(spark):
    table = history(spark, ("2024-02-01 12:00:30", "line8", True), ("2024-02-01 12:01:30", "line8", True))
    local = alerts.alert_rows(table, "America/Chicago")
    assert rows_of(local, "changed_at") == [(at("2024-02-01 06:00"),), (at("2024-02-01 06:02"),)]
    exact = alerts.alert_rows(table, "UTC", bucket=None)
    assert rows_of(exact, "changed_at") == [(at("2024-02-01 12:00:30"),), (at("2024-02-01 12:01:30"),)]


def test_missing_times_pass_through(spark):
    row = alerts.alert_rows(history(spark, ("2024-02-01 12:00", "line8", True))).first()
    assert row.disable_until is None and row.changed_at is not None


def test_report_columns(spark):
    assert alerts.report_columns(view(spark, history(spark, ("2024-02-01 12:00", "line8", True)))).columns == [
        "Line", "Part", "Trigger", "Changed by", "Changed at", "Disabled", "Disable until"]


def test_read_json_array_and_lines(spark, tmp_path):
    entry = {"site": "s", "changed_at": "2024-02-01T12:00:00Z", "disable_until": None, "changed_by": "me", "disabled": True,
             "alert_config": {"resource": "line8", "trigger": "X_GEN_FLG_A_T", "part_number": "7"}}
    (tmp_path / "array.json").write_text(json.dumps([entry, entry]))
    (tmp_path / "lines.json").write_text(json.dumps(entry) + "\n" + json.dumps(entry) + "\n")
    array = tables.read_alerts(spark, str(tmp_path / "array.json"))
    lines = tables.read_alerts(spark, str(tmp_path / "lines.json"), array_per_file=False)
    assert rows_of(view(spark, array), "trigger") == rows_of(view(spark, lines), "trigger") == [("X",), ("X",)]


def test_settings_as_text(spark):
    table = history(spark, ("2024-02-01 12:00", "line8", True)).withColumn("alert_config", F.to_json("alert_config"))
    assert rows_of(view(spark, table), "trigger", "part") == [("Top load", "7")]


def test_weeks_put_together_tell_the_same(spark):
    """A backfill gathers weeks: the same texts as row by row, and no rendered row crosses more than two shuffles."""
    lines, _ = dims(spark, dict(line="l8", timedelta="45 days"), dict(line="l9", days=3), dict(line="l7", timedelta="10 hours"))
    backfill = runs.backfill_runs(lines, at("2023-11-20 06:02"), at("2024-01-20 06:02"))
    table = history(spark, *[(f"2023-{m:02d}-{d:02d} {h:02d}:02", f"line{7 + (d + h) % 3}", True)
                             for m in (10, 11, 12) for d in range(1, 31) for h in (6, 7, 18)])
    found = reports.alert_sections(table, backfill, "UTC", known_at_run=True)
    rows = alerts.in_lookback(alerts.alert_rows(table, "UTC"), backfill, known_at_run=True)
    shown = [F.coalesce(F.col(c).cast("string"), F.lit("None")) for c in alerts.COLUMNS]
    cells = F.concat(F.lit("<tr>"), *[F.concat(F.lit("<td>"), s, F.lit("</td>")) for s in shown], F.lit("</tr>"))
    plain = rows.groupBy("line_id", "run_at").agg(F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("changed_at", cells.alias("r")))), lambda x: x["r"]), "").alias("t"))
    shown = found.where("alert_rows is not null")
    assert rows_of(shown, "line_id", "run_at", "alert_rows") == rows_of(plain, "line_id", "run_at", "t")
    assert shown.count() > 100
    plan = found._jdf.queryExecution().executedPlan().toString()
    moved = [line for line in plan.splitlines() if "Exchange hashpartitioning" in line and "_w0" not in line]
    assert len(moved) == 2, plan


def test_cut_edges(spark):
    """The last row within and the first rows outside of a look-back, on the days where weeks begin."""
    lines, _ = dims(spark, dict(line="l8", timedelta="14 days"))
    for day in range(1, 9):
        run_at = at(f"2024-03-{day + 14:02d} 06:02")
        run = runs.scheduled_run(lines, run_at)
        table = history(spark, *[(f"2024-03-{day:02d} 06:0{m}", "line8", True) for m in (1, 2, 3)],
                        *[(f"2024-03-{day + 14:02d} 06:0{m}", "line8", True) for m in (1, 2, 3)])
        (row,) = reports.alert_sections(table, run, "UTC", known_at_run=True).collect()
        assert [row.alert_rows.count(f"2024-03-{d:02d} 06:0{m}") for d in (day, day + 14) for m in (1, 2, 3)] == [0, 0, 1, 1, 1, 0]
