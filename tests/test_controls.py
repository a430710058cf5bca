import pytest
from pyspark.sql import functions as F

from shiftlab import schemas
from shiftlab.operators import controls
from shiftlab.operators.sizes import sized
from shiftlab.sources import tables
from helpers import config, dims, rows_of


def expanded(spark, **entry):
    return rows_of(controls.expand_controls(controls.line_controls(config(spark, entry))), "kind", "control", "control_ordinal")


def test_expand(spark):
    assert expanded(spark, num_heats=3, nonheats=["plug"]) == [
        ("heat", "h_1", 1), ("heat", "h_2", 2), ("heat", "h_3", 3), ("nonheat", "plug", 1)]


@pytest.mark.parametrize("count", [0, -2, None])
def test_expand_without_heats(spark, count):
    assert expanded(spark, num_heats=count, nonheats=["plug"]) == [("nonheat", "plug", 1)]


def test_expand_every_placeholder(spark):
    assert expanded(spark, num_heats=1, name="{x}_of_{x}") == [("heat", "1_of_1", 1)]


def test_requested_names_once_per_line(spark):
    _, per_line = dims(spark, dict(num_heats=2, nonheats=["h_1", "plug"]))
    assert rows_of(controls.requested_names(per_line), "_field") == [("h_1",), ("h_2",), ("plug",)]


@pytest.mark.parametrize("own,line,enhanced,older", [(12.0, 10.0, 12.0, 10.0), (None, 8.0, 8.0, 8.0), (None, None, 10.0, 10.0)])
def test_threshold(spark, own, line, enhanced, older):
    table = config(spark, dict(threshold=own, heat_threshold=line))
    row = table.select(controls.heat_threshold().alias("e"), controls.heat_threshold(False).alias("o")).first()
    assert (row.e, row.o) == (enhanced, older)


def test_line_dim_defaults(spark):
    lines, _ = dims(spark, dict(), dict(line="s-l2", start="06:30:00", days=5, recipients=["a"]),
                    dict(line="l3", timedelta="2 days", days=5, recipients=["a"], email_recipients=["b"], bucket="x"))
    got = {r.line_id: r for r in lines.collect()}
    assert (got["s-l1"].dayshift_start, got["s-l1"].lookback, got["s-l1"].recipients) == ("07:00:00", "60 days", [])
    assert (got["s-l2"].start_seconds, got["s-l2"].lookback, got["s-l2"].recipients) == (23400, "5 days", ["a"])
    assert (got["s-l3"].lookback, got["s-l3"].recipients, got["s-l3"].measurement) == ("2 days", ["b"], None)


def test_select_lines(spark):
    table = config(spark, dict(line="l1"), dict(line="s-l2"), dict(site="t", line="l1"))
    assert rows_of(controls.select_lines(table, "s", ["s-l1", "l2"]), "line") == [("l1",), ("s-l2",)]
    assert controls.select_lines(table).count() == 3
    with pytest.raises(ValueError):
        controls.select_lines(table, site="s", require=True)


def sites(spark, *rows):
    return spark.createDataFrame([(*r, *[None] * (5 - len(r))) for r in rows], schemas.SITE_CONFIG)


def test_all_sites_inherit(spark):
    site_table = sites(spark, ("a", ["a-l1", "a-l2"], "06:00:00"), ("b", None), ("default", ["x"]))
    lines = config(spark, dict(site=None, line="a-l1", start="09:00:00", recipients=["r"], heat_threshold=3.0))
    found = controls.resolve_sites(site_table, lines).orderBy("ordinal").collect()
    assert [(r.site, r.line, r.time_start_dayshift, r.email_recipients, r.alert_lookback_timedelta) for r in found] == [
        ("a", "a-l1", "06:00:00", [], "60 days"), ("a", "a-l2", "06:00:00", [], "60 days")]
    assert [(r.heat_threshold, r.recipients, r.ordinal) for r in found] == [(3.0, ["r"], 0), (None, None, 1)]


def test_one_site_does_not_inherit(spark):
    site_table = sites(spark, ("a", ["a-l1"], "06:00:00"), ("b", None))
    lines = config(spark, dict(site=None, line="a-l1", start="09:00:00"), dict(site=None, line="b"))
    assert rows_of(controls.resolve_sites(site_table, lines, "a"), "site", "line", "time_start_dayshift") == [
        ("a", "a-l1", "09:00:00")]
    assert rows_of(controls.resolve_sites(site_table, lines, "b"), "site", "line") == [("b", "b")]
    assert rows_of(controls.resolve_sites(site_table, lines, "nowhere"), "site", "line") == [("a", "a-l1")]


def test_read_config_json(spark, tmp_path):
    (tmp_path / "lines.json").write_text("""[
      {"site": "a", "line": "l1", "controls": {"heats": {"num_heats": 2, "threshold": 5.0, "name": "h_{x}"},
       "nonheats": {"controls": ["plug"]}}, "recipients": ["r"], "enabled": true, "alert_lookback_days": 7},
      {"site": "a", "line": "l2"}]""")
    table = tables.read_line_config(spark, str(tmp_path / "lines.json"))
    assert table.schema == schemas.LINE_CONFIG
    per_line = controls.line_controls(table)
    assert {r.line_id: len(r.controls) for r in per_line.collect()} == {"a-l1": 3, "a-l2": 0}
    (tmp_path / "sites.json").write_text('[{"site": "a", "lines": ["l1"]}]')
    assert rows_of(controls.resolve_sites(tables.read_site_config(spark, str(tmp_path / "sites.json")), table), "line") == [("l1",)]


def test_broadcast_only_what_was_counted(spark):
    big, dim = spark.range(1000), spark.range(50)
    plan = lambda bound: big.join(sized(dim, bound), "id")._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan(50)
    assert "SortMergeJoin" in plan(49)
    wide = dim.withColumn("list", F.array(F.lit(1), F.lit(2)))
    heavy = big.join(sized(wide, 99, weight=F.size("list")), "id")
    assert "SortMergeJoin" in heavy._jdf.queryExecution().executedPlan().toString()
    assert big.join(sized(dim, 49), "id").count() == big.join(sized(dim, 50), "id").count() == 50


def test_each_site_keeps_its_own_line(spark):
    site_table = sites(spark, ("a", ["l1", "l2"]), ("b", ["l1"]))
    lines = config(spark, dict(site="a", line="l1", heat_threshold=1.0), dict(site="b", line="l1", heat_threshold=2.0),
                   dict(site=None, line="l1", heat_threshold=3.0), dict(site=None, line="l2", heat_threshold=4.0))
    found = controls.resolve_sites(site_table, lines)
    assert rows_of(found, "site", "line", "heat_threshold") == [("a", "l1", 1.0), ("a", "l2", 4.0), ("b", "l1", 2.0)]
    assert rows_of(controls.resolve_sites(site_table, lines, "b"), "line", "heat_threshold") == [("l1", 2.0)]
