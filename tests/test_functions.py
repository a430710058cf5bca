import math
import random
import re

import pytest
from pyspark.sql import functions as F

from shiftlab.functions import html, numeric, text, times
from helpers import at


def column(spark, values, kind, fn):
    rows = spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {kind}")
    return [r[0] for r in rows.orderBy("i").select(fn(F.col("x"))).collect()]


SANITIZED = {
    "Top Load, lbs. (min)": "Top_Load_lbs",
    "Wall Thk. #1 - avg %": "Wall_Thk_No1_avg",
    ":Height  (in.)/max": "Height_max",
    "  Neck+OD?": "_NeckOD",
    "a (b) (c) d": "a_d",
    "%%%": "",
    "a b": "a_b",
    "a\x1cb c": "a_b_c",
    "open (never closed": "open_(never_closed",
    "two (lines\nof) text": "two_(lines_of)_text",
    "::x_": ":x",
}


def test_sanitize_cases(spark):
    assert column(spark, list(SANITIZED), "string", text.sanitize_test) == list(SANITIZED.values())


def stepwise(name: str) -> str:
    """The eight replacements one after another."""
    for pattern, new in [(r"[-,?+%]", ""), (r"[#]", "No"), (r"\(.*?\)", ""), (r"\s+", "_"),
                         (r"[./]", "_"), (r"_+", "_"), (r"_+$", ""), (r"^:", "")]:
        name = re.sub(pattern, new, name)
    return name


def test_sanitize_equals_the_stepwise_rules(spark):
    rng = random.Random(7)
    alphabet = "ab:_./-,?+%#() \t\n\r \x1f\x85  　é"
    names = ["".join(rng.choice(alphabet) for _ in range(rng.randint(0, 14))) for _ in range(4000)]
    assert column(spark, names, "string", text.sanitize_test) == [stepwise(n) for n in names]


def test_to_number(spark):
    values = ["1", " 2 ", "1e3", "inf", "-inf", "1.", ".5", "1d", "1_0", "0x10", "true", "", None, "nan", "1e", "--1"]
    expected = [1.0, 2.0, 1000.0, math.inf, -math.inf, 1.0, 0.5] + [None] * 9
    assert column(spark, values, "string", numeric.to_number) == expected


def test_erf(spark):
    values = [x / 16 for x in range(-160, 161)] + [1e17, -1e17, math.inf, -math.inf]
    for x, y in zip(values, column(spark, values, "double", numeric.erf)):
        assert y == pytest.approx(math.erf(x), abs=1e-14)


def test_missing_if_nan(spark):
    assert column(spark, [1.0, math.nan, None], "double", numeric.missing_if_nan) == [1.0, None, None]


def test_labels(spark):
    assert column(spark, ["line8", "line22"], "string", text.resource_label) == ["Line 8", "Line 22"]
    assert column(spark, ["abc-l8", "noline"], "string", text.line_label) == ["Line 8", None]
    assert column(spark, ["TOP_LOAD_alert_good_fraction", "OVEN_GEN_FLG_A_T"], "string", text.trigger_label) == [
        "Top load", "Oven"]
    assert column(spark, ["top LOAD now", "", None], "string", text.capitalise) == ["Top load now", "", None]


def test_line_ids(spark):
    ids = column(spark, ["l8", "abc-l8", "abcl8"], "string", lambda x: text.line_id(F.lit("abc"), x))
    assert ids == ["abc-l8", "abc-l8", "abc-abcl8"]
    assert column(spark, ["abc-l22", "alone"], "string", text.table_site) == ["abc", "alone"]
    assert column(spark, ["abc-l22", "alone"], "string", text.line_number) == ["22", None]
    assert column(spark, ["v-x-l8-1/ch_opcua", "none", None, "a_ch_b_ch_c"], "string", text.measurement_of) == [
        "opcua", None, None, "b_"]
    assert column(spark, ["a-l8", "l8", "a-b-c"], "string", text.line_part) == ["l8", "l8", "b-c"]


def test_round_minute_half_even(spark):
    cases = {
        "2024-01-01 00:00:30": "2024-01-01 00:00:00", "2024-01-01 00:01:30": "2024-01-01 00:02:00",
        "2024-01-01 00:02:30": "2024-01-01 00:02:00", "2024-01-01 00:00:30.000001": "2024-01-01 00:01:00",
        "2024-01-01 23:59:59": "2024-01-02 00:00:00", "1969-12-31 23:58:30": "1969-12-31 23:58:00",
        "1969-12-31 23:59:31": "1970-01-01 00:00:00",
    }
    assert column(spark, [at(t) for t in cases], "timestamp_ntz", times.round_minute) == [at(t) for t in cases.values()]


RUNS = {
    "2024-03-05 06:02": ("2024-03-04 19:00", "2024_03_04 N"),
    "2024-03-05 18:02": ("2024-03-05 07:00", "2024_03_05 D"),
    "2024-03-05 11:59": ("2024-03-04 19:00", "2024_03_04 N"),
    "2024-03-05 20:00": ("2024-03-05 07:00", "2024_03_05 D"),
    "2024-03-05 00:30": ("2024-03-04 19:00", "2024_03_04 N"),
}


def test_run_shift(spark):
    found = column(spark, [at(t) for t in RUNS], "timestamp_ntz", lambda x: times.run_shift(x, F.lit("07:00:00")))
    for shift, (left, label) in zip(found, RUNS.values()):
        assert shift["shift_start"] == at(left)
        assert (shift["shift_end"] - shift["shift_start"]).total_seconds() == 43200
        assert shift["shift_label"] == label


def test_shift_holding_a_time(spark):
    cases = {"2024-03-05 06:02": "2024-03-04 19:00", "2024-03-05 11:59": "2024-03-05 07:00",
             "2024-03-05 20:00": "2024-03-05 19:00", "2024-03-05 07:00": "2024-03-05 07:00",
             "2040-06-01 06:59:59.999999": "2040-05-31 19:00", "1960-06-01 07:30": "1960-06-01 07:00"}
    start = F.lit(7 * 3600)
    assert column(spark, [at(t) for t in cases], "timestamp_ntz",
                  lambda x: times.from_seconds(times.shift_start_seconds(x, start))) == [at(t) for t in cases.values()]


@pytest.mark.parametrize("start", ["07:00:00", "06:30:00", "00:00:00", "19:15:30"])
def test_both_shift_forms_agree(spark, start):
    rows = spark.range(5000).select(
        F.timestamp_add("SECOND", F.col("id") * 977, F.expr("TIMESTAMP_NTZ'2024-02-27 00:00:00'")).alias("t"))
    seconds = times.clock_seconds(F.lit(start))
    both = rows.withColumn("w", times.shift_window(F.col("t"), start)["start"]).select(
        "w", times.from_seconds(times.shift_start_seconds(F.col("t"), seconds)).alias("k"))
    assert both.where(F.col("w") != F.col("k")).count() == 0


@pytest.mark.parametrize("zone", ["UTC", "America/Chicago", "Asia/Kolkata"])
def test_wall_clocks_ignore_the_session_zone(spark, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        # 02:30 does not exist in Chicago that day; a wall clock does not care.
        t = at("2024-03-10 02:30:40")
        assert column(spark, [t], "timestamp_ntz", times.round_minute) == [at("2024-03-10 02:31:00")]
        shift = column(spark, [at("2024-03-10 18:00")], "timestamp_ntz", lambda x: times.run_shift(x, F.lit("02:30:00")))[0]
        assert (shift["shift_start"], shift["shift_label"]) == (at("2024-03-10 02:30"), "2024_03_10 D")
        assert column(spark, [t], "timestamp_ntz", times.timestamp_text) == ["2024-03-10 02:30:40"]
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)


def test_micros_round_trip(spark):
    t = at("2024-03-10 02:30:40.000123")
    assert column(spark, [t], "timestamp_ntz", times.epoch_micros) == [1710037840000123]
    assert column(spark, [t], "timestamp_ntz", lambda x: times.instant_to_utc(times.utc_to_instant(x))) == [t]


def test_zones(spark):
    move = lambda x: times.to_zone(x, "UTC", "America/Chicago")
    assert column(spark, [at("2024-01-01 12:00"), at("2024-07-01 12:00")], "timestamp_ntz", move) == [
        at("2024-01-01 06:00"), at("2024-07-01 07:00")]


def test_letters_and_text(spark):
    assert column(spark, ["2024_03_04 N", "2024_03_04 D"], "string", times.shift_letter) == ["N", "D"]
    assert column(spark, [at("2024-01-01 00:00:00.5")], "timestamp_ntz", times.timestamp_text) == [
        "2024-01-01 00:00:00.500000"]


def test_html(spark):
    assert column(spark, ["<a & b>"], "string", html.escape) == ["&lt;a &amp; b&gt;"]
    cells = column(spark, [1.0, -1.0, 0.0, None], "double", lambda x: html.signed_cell(F.lit("v"), x))
    assert ["e62525aa" in c for c in cells] == [True, False, False, False]
    assert ["199bd6aa" in c for c in cells] == [False, True, False, False]
    assert cells[2] == cells[3] == "<td>v</td>"


@pytest.mark.parametrize("text,seconds", [
    ("60 days", 60 * 86400), ("60d", 60 * 86400), ("1440h", 60 * 86400), ("8w", 56 * 86400), ("60 days 00:00:00", 60 * 86400),
    ("1 day 02:30:05", 95405), ("1 Day, 3 hours", 97200), ("90 min", 5400), ("1.5 hours", 5400), ("02:00:00", 7200), (" 7 days ", 604800),
    ("soon", None), ("", None), ("60", None), ("60 dayz", None), ("5 parsecs", None), (None, None)])
def test_periods(spark, text, seconds):
    found = spark.range(1).select(times.period_seconds(F.lit(text).cast("string")).alias("s")).first().s
    assert found == seconds


@pytest.mark.parametrize("text,seconds", [
    ("07:00:00", 25200), ("7:00:00", 25200), ("06:30", 23400), (" 19:00:01 ", 68401), ("late", None), ("24:00:00", None),
    ("07:61:00", None), ("7", None), ("", None), (None, None)])
def test_clocks(spark, text, seconds):
    assert spark.range(1).select(times.clock_seconds(F.lit(text).cast("string")).alias("s")).first().s == seconds
