from functools import partial

import pytest
from pyspark.sql import functions as F

from shiftlab import session
from shiftlab.functions import times
from shiftlab.operators import changes
from shiftlab.operators.points import first_per_minute, requested, unique_points
from shiftlab.streaming import changes as stream
from helpers import at, dims, points, rows_of

DAY = "2024-03-05 "


def run_stream(spark, folder, out, max_files=None, **options):
    rows = stream.read_stream(spark, folder, spark.read.parquet(folder).schema, max_files=max_files)
    found = stream.stream_shift_changes(rows, **options)
    stream.write_stream(found, f"{out}/rows", f"{out}/state").awaitTermination()
    return spark.read.schema(found.schema).parquet(f"{out}/rows")


def write(spark, folder, rows):
    points(spark, rows).coalesce(1).write.mode("append").parquet(folder)


@pytest.mark.parametrize("distinct", [False, True])
def test_closed_shifts_come_out_once(spark, tmp_path, distinct):
    run = partial(run_stream, distinct=distinct)
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    write(spark, folder, [(DAY + "08:00", "a", 1.0), (DAY + "09:00", "a", 4.0), (DAY + "09:00", "a", 4.0), (DAY + "08:30", "a", None)])
    assert run(spark, folder, out).count() == 0
    write(spark, folder, [(DAY + "18:59", "a", 3.0), (DAY + "19:30", "a", 9.0)])
    assert run(spark, folder, out).count() == 0
    # A late reading still counts: the latest time seen is within an hour of the end of the shift.
    write(spark, folder, [(DAY + "18:59:30", "a", 2.0)])
    write(spark, folder, [(DAY + "20:01", "b", 1.0)])
    run(spark, folder, out)
    write(spark, folder, [("2024-03-06 00:00", "b", 1.0)])
    found = run(spark, folder, out)
    assert rows_of(found, "shift_start", "shift_end", "control", "start_value", "end_value", "delta", "spread") == [
        (at(DAY + "07:00"), at(DAY + "19:00"), "a", 1.0, 2.0, 1.0, 3.0)]


def test_a_backlog_in_batches(spark, tmp_path):
    folder = str(tmp_path / "in")
    for day in range(1, 5):
        write(spark, folder, [(f"2024-03-0{day} {h:02d}:00", "a", float(h)) for h in range(24)])
    once = run_stream(spark, folder, str(tmp_path / "once"))
    cut = run_stream(spark, folder, str(tmp_path / "cut"), max_files=1)
    assert rows_of(once, "shift_start", "delta") == rows_of(cut, "shift_start", "delta") and cut.count() == 8


def test_tiebreak(spark, tmp_path):
    folder = str(tmp_path / "in")
    rows = points(spark, [(DAY + "08:00", "a", 1.0), (DAY + "08:00", "a", 2.0), ("2024-03-06 00:00", "a", 0.0)])
    rows.withColumn("id", -F.col("_value").cast("bigint")).write.parquet(folder)
    found = run_stream(spark, folder, str(tmp_path / "out"), tiebreak="id")
    assert rows_of(found, "start_value", "end_value") == [(2.0, 1.0)]


def test_closed_shifts_equal_the_batch(spark, tmp_path):
    folder = str(tmp_path / "in")
    frame = spark.range(20000).select(
        F.lit("s").alias("site"), F.concat(F.lit("s-l"), (F.col("id") % 3).cast("string")).alias("line_id"),
        F.timestamp_add("SECOND", F.col("id") * 37, F.expr("TIMESTAMP_NTZ'2024-03-01 00:00:00'")).alias("_time"),
        F.concat(F.lit("c"), (F.col("id") % 4).cast("string")).alias("_field"),
        F.when(F.col("id") % 11 > 0, F.pmod(F.col("id") * 7919, F.lit(1009)).cast("double")).alias("_value"))
    frame.write.parquet(folder)
    found = run_stream(spark, folder, str(tmp_path / "out"))
    last = frame.agg(F.max("_time")).first()[0]
    batch = changes.observed_changes(frame, dayshift_start="07:00:00", closed=False)
    batch = batch.where(F.col("shift_start") + F.expr("INTERVAL 13 HOURS") <= times.wall_clock(last))
    columns = ["line_id", "shift_start", "control", "start_value", "end_value"]
    assert rows_of(found, *columns) == rows_of(batch, *columns) and found.count() > 150


def test_grids():
    hour = 3600
    assert stream.shift_grids([7 * hour]) == [(7 * hour, 12 * hour, [7 * hour])]
    assert stream.shift_grids([0, 7 * hour]) == [(0, hour, [0, 7 * hour])]
    assert stream.shift_grids([7 * hour, int(6.5 * hour)]) == [(0, 1800, [int(6.5 * hour), 7 * hour])]
    found = stream.shift_grids([0, 450, 7 * hour, 7 * hour + 450, 7])
    assert found == [(0, hour, [0, 7 * hour]), (7, 12 * hour, [7]), (450, hour, [450, 7 * hour + 450])]
    for first, step, own in found:
        assert 12 * hour % step == 0 and all((s - first) % step == 0 for s in own)


STARTS = {"l1": "00:00:00", "l2": "07:00:00", "l3": "19:00:00", "l4": "06:30:00", "l5": "06:37:30", "l6": "late"}


def line_readings(spark, days):
    """A reading every 20 minutes on every line, and the last of each shift beside its end."""
    hour = F.expr("INTERVAL 20 MINUTES")
    rows = spark.range(days[0] * 72, days[1] * 72).select(
        (F.expr("TIMESTAMP_NTZ'2024-03-01 00:00:00'") + F.col("id").cast("int") * hour).alias("_time"), F.col("id").cast("double").alias("_value"))
    names = F.explode(F.array(*[F.lit(f"s-{x}") for x in STARTS]))
    return rows.select(F.lit("s").alias("site"), names.alias("line_id"), "_time", F.lit("h_1").alias("_field"), "_value")


def test_lines_of_different_starts_equal_the_batch(spark, tmp_path):
    """Files in the order of time, none late, default lateness: no closed shift loses a reading."""
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    _, per_line = dims(spark, *[dict(line=x, num_heats=1, start=s) for x, s in STARTS.items()])
    for day in range(4):
        line_readings(spark, (day, day + 1)).write.mode("append").parquet(folder)
        found = stream.stream_line_shifts(stream.read_stream(spark, folder, spark.read.parquet(folder).schema), per_line)
        stream.write_stream(found, f"{out}/rows", f"{out}/state").awaitTermination()
    everything = line_readings(spark, (0, 4))
    last = everything.agg(F.max("_time")).first()[0]
    wanted = requested(everything, per_line).where("start_seconds is not null")
    batch = changes.observed_changes(wanted, closed=False)
    batch = batch.where(F.col("shift_start") + F.expr("INTERVAL 13 HOURS") <= times.wall_clock(last))
    columns = ["line_id", "shift_start", "control", "start_value", "end_value"]
    got = rows_of(spark.read.parquet(f"{out}/rows"), *columns)
    assert got == rows_of(batch, *columns)
    assert {line for line, *_ in got} == {f"s-l{i}" for i in range(1, 6)} and len(got) >= 35


def test_process_changes_equal_the_batch(spark, tmp_path):
    """Rounded minutes with halves, instants that several controls share, missing and repeated readings, boundaries of shifts."""
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    _, per_line = dims(spark, *[dict(line=x, num_heats=3, name="h_{x}", start=s) for x, s in STARTS.items()])
    steps = spark.range(0, 3 * 86400 // 15 + 1).where("id % 13 < 8 or id % 240 < 3")
    i = F.col("id")
    rows = steps.select(
        F.timestamp_add("SECOND", i * 15, F.expr("TIMESTAMP_NTZ'2024-03-01 00:00:00'")).alias("_time"), i,
        F.explode(F.array(*[F.lit(f"s-{x}") for x in STARTS])).alias("line_id"))
    rows = rows.select(F.lit("s").alias("site"), "line_id", "_time", "id", F.explode(F.array(*[F.lit(f"h_{n}") for n in (1, 2, 3)])).alias("_field"))
    mark = F.pmod(F.xxhash64("line_id", "id", "_field"), F.lit(100))
    rows = rows.where(mark < 60).withColumn("_value", F.when(mark % 11 > 0, (mark * 7 % 53).cast("double"))).drop("id")
    rows = rows.unionByName(rows.where(mark % 10 == 0))
    for day in range(1, 5):
        part = rows.where(F.to_date("_time") == F.lit(f"2024-03-0{day}").cast("date"))
        part.write.mode("append").parquet(folder)
        found = stream.stream_process_changes(stream.read_stream(spark, folder, rows.schema), per_line)
        stream.write_stream(found, f"{out}/rows", f"{out}/state").awaitTermination()
    last = rows.agg(F.max("_time")).first()[0]
    unique = unique_points(requested(rows, per_line).where("start_seconds is not null"))
    batch = changes.observed_changes(first_per_minute(unique), "minute_level")
    batch = batch.where(F.col("shift_start") + F.expr("INTERVAL 13 HOURS 90 SECONDS") <= times.wall_clock(last))
    columns = ["line_id", "shift_start", "control", "start_value", "end_value", "earliest", "latest"]
    got = rows_of(spark.read.parquet(f"{out}/rows"), *columns)
    assert got == rows_of(batch, *columns) and len(got) >= 60


def test_a_late_reading_counts_by_its_age(spark, tmp_path):
    """Half an hour late counts, two hours late does not, on every line alike."""
    folder, out = str(tmp_path / "in"), str(tmp_path / "out")
    _, per_line = dims(spark, dict(line="l1", num_heats=1, start="00:00:00"), dict(line="l2", num_heats=1, start="07:00:00"))
    batches = [[("01:00", 1.0), ("12:20", 2.0), ("19:20", 2.0)], [("11:50", 5.0), ("18:50", 7.0), ("19:55", 2.0)],
               [("18:55", 8.0), ("20:30", 2.0)], [("18:58", 9.0), ("23:59", 2.0)]]
    for batch in batches:
        both = points(spark, [(DAY + t, "h_1", v) for t, v in batch]).unionByName(
            points(spark, [(DAY + t, "h_1", v) for t, v in batch], line_id="s-l2"))
        both.write.mode("append").parquet(folder)
        found = stream.stream_line_shifts(stream.read_stream(spark, folder, both.schema), per_line)
        stream.write_stream(found, f"{out}/rows", f"{out}/state").awaitTermination()
    got = {(r.line_id, r.shift_start): (r.start_value, r.end_value) for r in spark.read.parquet(f"{out}/rows").collect()}
    # The first line's morning closed at 12:00 with 19:20 seen; the other line's day took 18:55 at 19:55, not 18:58 at 20:30.
    assert got == {("s-l1", at(DAY + "00:00")): (1.0, 1.0), ("s-l2", at("2024-03-04 19:00")): (1.0, 1.0),
                   ("s-l2", at(DAY + "07:00")): (5.0, 8.0)}


@pytest.mark.parametrize("zone", ["Asia/Kolkata", "America/Chicago"])
def test_session_zone_does_not_move_shifts(spark, tmp_path, zone):
    folder = str(tmp_path / "in")
    write(spark, folder, [(DAY + "08:00", "a", 1.0), ("2024-03-06 00:00", "a", 1.0)])
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        assert rows_of(run_stream(spark, folder, str(tmp_path / "out")), "shift_start") == [(at(DAY + "07:00"),)]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_work_folder_is_the_shared_one(spark):
    shared = spark.conf.get("spark.checkpoint.dir")
    one, two = session.work_folder(spark, "x"), session.work_folder(spark, "x")
    assert one.startswith(shared) and one != two
