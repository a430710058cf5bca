import json
import os

import pytest
from pyspark.sql import functions as F

from shiftlab import __main__ as main
from helpers import TELEMETRY, at, rows_of

LINES = [
    {"site": "a", "line": f"l{i}", "controls": {"heats": {"num_heats": 1, "threshold": 5.0, "name": "h_{x}"}},
     "recipients": [f"r{i}"], "bucket": "b/ch_opcua", "ordinal": i} for i in (1, 2)]


@pytest.fixture()
def inputs(spark, tmp_path):
    (tmp_path / "lines.json").write_text(json.dumps(LINES))
    rows = [("a", f"l{i}", "opcua", at(f"2024-03-0{d} {h:02d}:00"), "h_1", float(h * i))
            for i in (1, 2) for d in (4, 5, 6) for h in range(0, 24, 2)]
    spark.createDataFrame(rows, TELEMETRY).withColumn("date", F.col("_time").cast("date")).write.partitionBy(
        "site", "date").parquet(str(tmp_path / "telemetry"))
    return ["--lines", str(tmp_path / "lines.json"), "--telemetry", str(tmp_path / "telemetry"), "--out", str(tmp_path / "out")]


def test_one_run(spark, inputs, tmp_path):
    counts = main.run(spark, main.arguments([*inputs, "--as-of", "2024-03-05 18:02"]))
    assert rows_of(counts, "site", "reports", "failed") == [("a", 2, 0)]
    text = open(f"{tmp_path}/out/documents/a/2024-03-05/process_change_D.html").read()
    assert text.index("a-l1") < text.index("a-l2") and "<td>8</td><td>18</td>" in text
    assert rows_of(spark.read.parquet(f"{tmp_path}/out/history"), "line", "run_id") == [
        ("l1", "2024-03-05T18-02"), ("l2", "2024-03-05T18-02")]


def test_backfill_of_one_line(spark, inputs, tmp_path):
    counts = main.run(spark, main.arguments(
        [*inputs, "--first", "2024-03-05 06:02", "--last", "2024-03-06 06:02", "--line", "a-l2", "--parts"]))
    assert rows_of(counts, "reports", "failed") == [(3, 0)]
    assert sorted(os.listdir(f"{tmp_path}/out/documents/site=a"))[-2:] == ["report_date=2024-03-05", "report_date=2024-03-06"]


def test_lines_by_site(spark, inputs, tmp_path):
    (tmp_path / "sites.json").write_text('[{"site": "a", "lines": ["l2"], "email_recipients": ["boss"]}]')
    main.run(spark, main.arguments([*inputs, "--sites", str(tmp_path / "sites.json"), "--as-of", "2024-03-05 18:02"]))
    assert [r.recipients for r in spark.read.parquet(f"{tmp_path}/out/outbox").collect()] == [["boss"]]


def test_arguments_are_checked(spark, inputs):
    for bad in ([], ["--first", "2024-03-05"], ["--as-of", "2024-03-05", "--first", "2024-03-05", "--last", "2024-03-06"]):
        with pytest.raises(SystemExit):
            main.arguments([*inputs, *bad])
    with pytest.raises(ValueError):
        main.run(spark, main.arguments([*inputs, "--as-of", "2024-03-05", "--line", "nowhere"]))


def test_unknown_site_means_all(spark, inputs):
    counts = [sorted(map(tuple, main.run(spark, main.arguments([*inputs, "--as-of", "2024-03-05 06:02", *site])).collect()))
              for site in ([], ["--site", "nowhere"])]
    assert counts[0] == counts[1] and counts[0]
