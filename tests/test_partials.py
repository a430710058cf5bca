"""Merged states equal the direct results, whatever the batches and their order."""

import random

import pytest
from pyspark.sql import functions as F

from shiftlab import schemas
from shiftlab.operators import changes, partials, quality
from helpers import POINTS, at, dims, rows_of

CHANGED = ["line_id", "shift_start", "control", "start_value", "end_value", "delta", "spread", "earliest", "latest"]
TESTED = ["shift_start", "part_item", "test_cleaned", "n_rows", "latest", "n", "low", "high", "n_le", "below", "above"]


def made_points(spark, rng, n=400):
    rows = [("s", f"s-l{rng.randint(1, 2)}", at(f"2024-03-0{rng.randint(1, 4)} {rng.randint(0, 23):02d}:{rng.choice(['00', '30'])}"),
             f"h_{rng.randint(1, 3)}", rng.choice([None, 1.0, 2.5, -3.0, float(rng.randint(0, 99))])) for _ in range(n)]
    return spark.createDataFrame([(*r, i) for i, r in enumerate(rows)], POINTS + ", id long")


@pytest.mark.parametrize("closed", [True, False])
def test_changes(spark, tmp_path, closed):
    _, per_line = dims(spark, dict(line="l1", num_heats=3), dict(line="l2", num_heats=2, start="06:30:00"))
    points = made_points(spark, random.Random(2))
    direct = changes.shift_changes(points, per_line, closed=closed, tiebreak="id")
    path = str(tmp_path / "states")
    for i in (3, 0, 2, 1, 0, 4):
        batch = points.where(F.col("id") % 4 == i)
        states = partials.change_states(batch, per_line, closed=closed, tiebreak="id")
        partials.write_states(states, path, f"b{i}")
    stored = partials.read_states(spark, path, states.schema)
    assert rows_of(partials.changes_of(stored, per_line), *CHANGED) == rows_of(direct, *CHANGED) and direct.count() > 20
    merged = partials.merged_changes(stored)
    assert merged.count() == merged.select(*partials.CONTROL_SHIFT).distinct().count() < stored.count()
    assert rows_of(partials.changes_of(merged.unionByName(merged), per_line), *CHANGED) == rows_of(direct, *CHANGED)


def measured(spark, rng, n=600):
    lines, _ = dims(spark, dict(line="l1", num_heats=1))
    rows = [("s", "1", at(f"2024-03-0{rng.randint(1, 3)} {rng.randint(0, 23):02d}:00"), rng.choice(["a", "b", "c"]),
             rng.choice([None, "x", "5", "5", str(1e6 + rng.random()), str(rng.randint(0, 100))]), rng.choice(["p", "q", None]))
            for _ in range(n)]
    table = spark.createDataFrame(rows, schemas.QUALITY).withColumn("batch", F.lit(0))
    specs = spark.createDataFrame([("s", "s-l1", "p", "a", 10.0, 90.0), ("s", "s-l1", "q", "b", 10.0, None)], schemas.SPECS)
    numbered = table.withColumn("batch", F.pmod(F.xxhash64("datetime", "val", "test"), F.lit(5)))
    return numbered, lambda t: quality.with_limits(quality.measurements(t, lines, "UTC"), specs)


def close(a, b):
    return (a is None) == (b is None) and (a is None or abs(a - b) <= 1e-9 * max(1.0, abs(a)))


def test_statistics(spark, tmp_path):
    table, prepared = measured(spark, random.Random(3))
    direct = quality.test_statistics(prepared(table))
    path = str(tmp_path / "states")
    for i in (4, 1, 0, 3, 2, 2):
        states = partials.test_states(prepared(table.where(F.col("batch") == i)))
        partials.write_states(states, path, f"b{i}")
    stored = partials.read_states(spark, path, states.schema)
    found = partials.statistics_of(stored)
    key = ["shift_start", "part_item", "test_cleaned"]
    one, two = ({tuple(r[k] for k in key): r for r in df.collect()} for df in (direct, found))
    assert one.keys() == two.keys() and len(one) > 20
    for k, r in one.items():
        assert [r[c] for c in TESTED] == [two[k][c] for c in TESTED]
        assert close(r.mean, two[k].mean) and close(r.sd, two[k].sd)
    again = partials.statistics_of(partials.merged_tests(stored))
    assert all(close(r.sd, two[tuple(r[x] for x in key)].sd) for r in again.collect())
    good = {tuple(r[k] for k in key): r.good_fraction for r in quality.good_fractions(direct, keep_undefined=True).collect()}
    assert good == pytest.approx({tuple(r[k] for k in key): r.good_fraction
                                  for r in quality.good_fractions(found, keep_undefined=True).collect()}, nan_ok=True)


def test_no_states(spark):
    table, prepared = measured(spark, random.Random(3), 5)
    none = partials.test_states(prepared(table.where("false")))
    assert partials.statistics_of(none).collect() == []
