"""Reports read only what their runs can use, and tell the same as without bounds."""

import os
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from registry import views
from shiftlab.operators import controls
from shiftlab.plans import reports, runs
from shiftlab.sources import tables

DATA = "/root/testdata/sf0.001"

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables not present")


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    """Telemetry and quality by site and day, alerts by site."""
    out = str(tmp_path_factory.mktemp("bounds"))
    telemetry = views.telemetry(spark, DATA).drop("event_id").dropDuplicates(["site", "line", "_time", "_field"])
    # A few readings on and beside the edges of shifts, and ones that round into them.
    edges = [datetime(2024, 1, 15, 19, 0), datetime(2024, 1, 16, 7, 0), datetime(2024, 1, 16, 7, 0, 20), datetime(2024, 1, 15, 18, 59, 40)]
    more = spark.createDataFrame([("alpha", "l1", "opcua", t, "heat_1", 500.0 + i) for i, t in enumerate(edges)], telemetry.schema)
    telemetry = telemetry.unionByName(more).withColumn("date", F.col("_time").cast("date"))
    telemetry.write.partitionBy("site", "date").parquet(f"{out}/telemetry")
    quality = views.quality(spark, DATA)
    quality.withColumn("date", F.col("datetime").cast("date")).write.partitionBy("site", "date").parquet(f"{out}/quality")
    views.alerts(spark, DATA).write.partitionBy("site").parquet(f"{out}/alerts")
    return out


def found(spark, folder, single):
    dim = controls.line_dim(views.line_config(spark))
    if single:
        run = datetime(2024, 1, 16, 6, 2)
        wanted, read = runs.scheduled_run(dim, run), dict(as_of=run)
    else:
        first, last = datetime(2024, 1, 16, 6, 2), datetime(2024, 1, 17, 6, 2)
        wanted, read = runs.backfill_runs(dim, first, last), dict(since=datetime(2024, 1, 15, 6, 2), until=datetime(2024, 1, 18, 6, 2))
    return reports.line_reports(
        wanted, dim, controls.line_controls(views.line_config(spark)),
        tables.scan_telemetry(spark.read.parquet(f"{folder}/telemetry"), **read), spark.read.parquet(f"{folder}/quality"),
        views.specs(spark, DATA), spark.read.parquet(f"{folder}/alerts"), site_tz="America/Chicago",
        known_at_run=not single, fail_on="fetch" if single else "shift")


@pytest.mark.parametrize("single", [True, False])
def test_bounds_reach_the_files_and_change_nothing(spark, folder, single, monkeypatch):
    bounded = found(spark, folder, single)
    plan = bounded._jdf.queryExecution().executedPlan().toString()
    scans = [line for line in plan.splitlines() if "FileScan" in line]
    for table, column, by_day in (("telemetry", "_time", True), ("quality", "datetime", True), ("alerts", "changed_at", False)):
        reads = [s for s in scans if f"{folder}/{table}" in s and column in s.split("PushedFilters")[1]]
        assert reads, (table, scans)
        for scan in reads:
            assert f"GreaterThanOrEqual({column}" in scan
            assert not by_day or "date" in scan.split("PartitionFilters: [")[1].split("]")[0]
    rows = sorted(map(repr, bounded.collect()))
    monkeypatch.setattr(reports, "bounded_reads", lambda runs, points, quality, alerts, *rest: (points, quality, alerts))
    assert rows == sorted(map(repr, found(spark, folder, single).collect()))
    assert any("success" in r for r in rows)
