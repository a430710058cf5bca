import random
from collections import defaultdict
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from shiftlab.operators import points as ops
from shiftlab.sources import tables
from helpers import TELEMETRY, at, dims, points, rows_of

DAY = "2024-01-01 "


def test_first_per_minute(spark):
    p = points(spark, [(DAY + "00:00:40", "f1", 1.0), (DAY + "00:01:10", "f2", 2.0),
                       (DAY + "00:01:20", "f1", 9.0), (DAY + "00:02:30", "f1", 5.0)])
    kept = ops.first_per_minute(p)
    assert rows_of(kept, "_time", "_field", "_value", "minute_level") == [
        (at(DAY + "00:00:40"), "f1", 1.0, at(DAY + "00:01")), (at(DAY + "00:02:30"), "f1", 5.0, at(DAY + "00:02"))]
    every = ops.first_per_minute(p, bucket=None)
    assert rows_of(every, "_time") == rows_of(every, "minute_level") and every.count() == 4
    with pytest.raises(ValueError):
        ops.first_per_minute(p, bucket="hour")


def test_first_per_minute_keeps_the_missing_reading(spark):
    p = points(spark, [(DAY + "00:01:00", "f1", None), (DAY + "00:01:10", "f1", 3.0), (DAY + "00:01:00", "f2", 4.0)])
    assert rows_of(ops.first_per_minute(p), "_field", "_value") == [("f1", None), ("f2", 4.0)]


def test_first_per_minute_against_whole_rows(spark):
    """Against the rule on wide rows: sort by time, keep the first row of each minute."""
    rng = random.Random(3)
    start = at(DAY + "00:00:00")
    rows = {(line, start + timedelta(seconds=rng.randrange(3000) / 2), f): rng.random()
            for line in ("s-l1", "s-l2") for f in ("a", "b", "c") for _ in range(400)}
    frame = spark.createDataFrame([("s", line, t, f, v) for (line, t, f), v in rows.items()],
                                  "site string, line_id string, _time timestamp_ntz, _field string, _value double")
    wide = defaultdict(dict)
    for (line, t, f), v in rows.items():
        wide[line, t][f] = v
    expected, seen = [], set()
    for line, t in sorted(wide):
        minute = round((t - start).total_seconds() / 60)
        if (line, minute) not in seen:
            seen.add((line, minute))
            expected += [(line, t, f, v) for f, v in wide[line, t].items()]
    assert rows_of(ops.first_per_minute(frame), "line_id", "_time", "_field", "_value") == sorted(expected)


def test_duplicates(spark):
    p = points(spark, [(DAY + "00:00", "f1", 1.0), (DAY + "00:00", "f1", 2.0), (DAY + "00:00", "f2", 1.0)])
    assert rows_of(ops.duplicate_keys(p), "_field", "copies") == [("f1", 2)]
    assert rows_of(ops.lines_with_duplicates(p), "line_id", "duplicate_keys") == [("s-l1", 1)]
    assert rows_of(ops.unique_points(p), "_field", "copies") == [("f1", 2), ("f2", 1)]


def test_exact_repeats_leave_with_the_union(spark):
    p = points(spark, [(DAY + "00:00", "f1", 1.0)])
    merged = ops.union_distinct([p, p])
    assert merged.count() == 1 and ops.duplicate_keys(merged).count() == 0
    wider = p.withColumn("extra", F.lit(1))
    assert ops.union_distinct([p, wider]).count() == 1


def test_a_duplicate_shows_after_its_point_is_gone(spark):
    p = points(spark, [(DAY + "00:00:50", "f2", 0.0), (DAY + "00:01:10", "f1", 1.0), (DAY + "00:01:10", "f1", 2.0)])
    kept = ops.first_per_minute(ops.unique_points(p))
    assert rows_of(kept, "_field", "copies") == [("f2", 2)]


def test_requested_is_literal_and_per_line(spark):
    _, per_line = dims(spark, dict(num_heats=1, name="h.{x}"), dict(line="l2", nonheats=["plug"]))
    p = points(spark, [(DAY + "00:00", "h.1", 1.0), (DAY + "00:00", "hx1", 1.0), (DAY + "00:00", "plug", 1.0)])
    assert rows_of(ops.requested(p, per_line), "_field") == [("h.1",)]


def test_widen(spark):
    p = points(spark, [(DAY + "00:00", "a", 1.0), (DAY + "00:00", "b", 2.0), (DAY + "00:01", "b", 3.0)])
    assert rows_of(ops.widen(p, ["a", "b", "c"]), "b", "c") == [(2.0, None), (3.0, None)]


def telemetry(spark, rows):
    return spark.createDataFrame([("s", l, m, at(t), f, v) for l, m, t, f, v in rows], TELEMETRY)


def test_scan(spark):
    t = telemetry(spark, [
        ("l1", "opcua", "2024-01-01 06:02", "f", 1.0), ("s-l1", "opcua", "2024-01-01 06:01:59", "f", 2.0),
        ("l1", "opcua", "2024-01-02 06:02", "f", 5.0), ("l1", "other", "2024-01-02 00:00", "f", 3.0), ("l1", "opcua", "2024-01-02 00:00", "f", float("nan"))])
    scanned = tables.scan_telemetry(t, as_of=at("2024-01-02 06:02"), measurement="opcua")
    assert rows_of(scanned, "line_id", "_time", "_value") == [
        ("s-l1", at("2024-01-01 06:02"), 1.0), ("s-l1", at("2024-01-02 00:00"), None)]
    assert tables.scan_telemetry(t).count() == 5
    assert tables.scan_telemetry(t, until=at("2024-01-01 06:02")).count() == 2
    lines, _ = dims(spark, dict(), dict(line="l9", bucket="v/ch_other"))
    assert tables.scan_telemetry(t, lines=lines).count() == 4


def test_scan_pushes_its_filters(spark, tmp_path):
    t = telemetry(spark, [("l1", "opcua", f"2024-01-0{d} 12:00", "f", 1.0) for d in range(1, 9)])
    path = str(tmp_path / "telemetry")
    t.withColumn("date", F.col("_time").cast("date")).write.partitionBy("site", "date").parquet(path)
    scanned = tables.scan_telemetry(tables.read_telemetry(spark, path), as_of=at("2024-01-06 12:00"),
                                    measurement="opcua")
    assert scanned.count() == 1
    plan = scanned._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(date" in plan
    assert "GreaterThanOrEqual(_time" in plan and "EqualTo(measurement,opcua)" in plan
