"""Every registered query against its SQL, and the shape of the plans."""

import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from registry import queries
from registry.oracle import ORACLE
from registry.queries import REGISTERED

DATA = "/root/testdata/sf0.001"
TYPES = {"bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
         "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN", "date": "DATE"}

pytestmark = pytest.mark.skipif(not os.path.isdir(DATA), reason="test tables not present")


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{DATA}/*.parquet"):
        con.execute(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def comparable(rows):
    return sorted(tuple((x is not None, repr(x)) for x in row) for row in rows)


def compare(spark, duck, name):
    found = REGISTERED[name](spark, DATA)
    columns = sorted(found.columns)
    result = duck.execute(ORACLE[name])
    types = {d[0]: str(d[1]) for d in result.description}
    assert {c: TYPES[t] for c, t in found.dtypes} == types
    expected = result.fetchall()
    position = [list(types).index(c) for c in columns]
    got = [tuple(row) for row in found.select(*[f"`{c}`" for c in columns]).collect()]
    assert comparable(got) == comparable([tuple(row[i] for i in position) for row in expected])
    assert got


@pytest.mark.parametrize("name", sorted(REGISTERED))
def test_query_equals_its_sql(spark, duck, name):
    compare(spark, duck, name)


def test_every_query_has_sql():
    assert REGISTERED.keys() == ORACLE.keys()
    assert entry.queries().keys() >= REGISTERED.keys() and entry.oracle_sql().keys() >= ORACLE.keys()


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("name,table", [
    ("shift_changes_all", "value"), ("process_changes", "value"), ("machine_report_html", "value"),
    ("good_fraction", "l_extendedprice"), ("line_report_html", "value"), ("line_report_html", "l_extendedprice"),
    ("report_history", "event_type"), ("line_report_run", "event_type"), ("line_report_run", "l_extendedprice")])
def test_fact_tables_are_read_once(spark, name, table):
    plan = plan_of(REGISTERED[name](spark, DATA))
    scans = [line for line in plan.splitlines() if "FileScan" in line and table in line.split("Batched")[0]]
    assert len(scans) == 1, plan


@pytest.mark.parametrize("name", sorted(REGISTERED))
def test_no_pairing_without_a_key(spark, name):
    if name.startswith("stream"):
        pytest.skip("the plan of a stream is that of its output files")
    plan = plan_of(REGISTERED[name](spark, DATA))
    for slow in ("CartesianProduct", "BroadcastNestedLoopJoin", "PythonUDF", "ArrowEvalPython", "BatchEvalPython"):
        assert slow not in plan


def test_points_are_hash_aggregated(spark):
    for name in ("shift_changes_all", "shift_changes_tiebreak", "process_changes", "good_fraction", "dup_key_guard"):
        assert "SortAggregate" not in plan_of(REGISTERED[name](spark, DATA)), name


def test_only_needed_columns_are_read(spark):
    plan = plan_of(queries.shift_coverage(spark, DATA))
    (scan,) = [line for line in plan.splitlines() if "FileScan" in line]
    assert "value" not in scan.split("ReadSchema")[1] and "props" not in scan


@pytest.mark.parametrize("zone", ["America/Chicago", "Asia/Kolkata"])
@pytest.mark.parametrize("name", ["process_changes_run", "failed_run", "alert_view", "quality_scan_utc",
                                  "synthetic_telemetry", "report_history", "shift_changes_closed"])
def test_results_do_not_depend_on_the_session_zone(spark, duck, name, zone):
    before = spark.conf.get("spark.sql.session.timeZone")
    spark.conf.set("spark.sql.session.timeZone", zone)
    try:
        compare(spark, duck, name)
    finally:
        spark.conf.set("spark.sql.session.timeZone", before)
