"""The library's input tables as views of the supplied ones."""

from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shiftlab import schemas
from shiftlab.functions import text
from shiftlab.sources import tables

FIELDS = ["heat_1", "heat_2", "heat_3", "plug_pos", "belt_speed"]
EVENT_FIELD = dict(zip(["click", "view", "purchase", "error", "signup"], FIELDS))

# One entry per line. l3 names no measurement, so its reports fail.
LINES = [
    dict(site="alpha", line="l1", heat_threshold=10.0, threshold=12.0, num_heats=3,
         nonheats=["plug_pos", "belt_speed", "idle_valve"], recipients=["ann@x.example", "bob@x.example"],
         start="07:00:00", days=60, bucket="v-x-l1-1/ch_opcua"),
    dict(site="alpha", line="alpha-l2", heat_threshold=8.0, threshold=None, num_heats=3,
         nonheats=["plug_pos", "belt_speed", "idle_valve"], recipients=["bob@x.example"],
         email_recipients=["cy@x.example", "ann@x.example"],
         start=None, timedelta="45 days", bucket="v-x-l2-1/ch_opcua"),
    dict(site="alpha", line="l3", heat_threshold=None, threshold=None, num_heats=3,
         nonheats=["plug_pos", "belt_speed", "idle_valve"], recipients=["dee@x.example"],
         start="07:00:00", bucket="v-x-l3-1"),
    dict(site="beta", line="l4", heat_threshold=10.0, threshold=50.0, num_heats=2,
         nonheats=["plug_pos", "belt_speed", "idle_valve"], recipients=["eve@x.example"],
         start="06:30:00", timedelta="30 days", bucket="v-x-l4-1/ch_opcua"),
    dict(site="beta", line="l5", heat_threshold=10.0, threshold=25.5, num_heats=3,
         nonheats=["plug_pos", "idle_valve"], recipients=None,
         start="06:30:00", days=90, bucket="v-x-l5-1/ch_opcua"),
]


def load(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def line_config(spark: SparkSession) -> DataFrame:
    rows = [
        {
            "site": x["site"], "line": x["line"], "heat_threshold": x["heat_threshold"],
            "controls": {
                "heats": {"num_heats": x["num_heats"], "threshold": x["threshold"], "name": "heat_{x}"},
                "nonheats": {"controls": x["nonheats"]},
            },
            "recipients": x["recipients"], "email_recipients": x.get("email_recipients"), "enabled": True,
            "time_start_dayshift": x["start"], "alert_lookback_timedelta": x.get("timedelta"),
            "alert_lookback_days": x.get("days"), "bucket": x["bucket"], "ordinal": i,
        }
        for i, x in enumerate(LINES)
    ]
    stored = F.from_json(F.lit(json.dumps(rows)), T.ArrayType(schemas.LINE_CONFIG))
    return spark.range(1).select(F.inline(stored))


def number_of(key: str) -> Column:
    """Line number 1 to 5 from an id column."""
    return F.col(key) % 5 + 1


def site_of(number: Column) -> Column:
    return F.when(number <= 3, F.lit("alpha")).otherwise(F.lit("beta"))


def line_of(number: Column) -> Column:
    return F.when(number == 2, F.lit("alpha-l2")).otherwise(F.concat(F.lit("l"), number.cast("string")))


def events_as_telemetry(events: DataFrame) -> DataFrame:
    number = number_of("user_id")
    field = F.create_map(*[F.lit(x) for pair in EVENT_FIELD.items() for x in pair])
    return events.select(
        site_of(number).alias("site"),
        line_of(number).alias("line"),
        F.lit("opcua").alias("measurement"),
        F.col("ts").alias("_time"),
        field[F.col("event_type")].alias("_field"),
        F.col("value").alias("_value"),
        "event_id",
    )


def telemetry(spark: SparkSession, sf_dir: str) -> DataFrame:
    return events_as_telemetry(load(spark, sf_dir, "events"))


def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A measurement per order line; the part table gives part and test names."""
    number = number_of("l_suppkey")
    items = tables.spread(load(spark, sf_dir, "lineitem"), "l_orderkey", "l_linenumber", "l_suppkey")
    parts = load(spark, sf_dir, "part").select("p_partkey", "p_type", "p_brand")
    val = (
        F.when(F.col("l_linenumber") == 7, F.lit("n/a"))
        .when(F.col("l_quantity") == 13, F.lit("1d"))
        .when(F.col("l_quantity") == 50, F.lit(None).cast("string"))
        .otherwise(F.col("l_extendedprice").cast("string"))
    )
    minutes = (F.col("l_orderkey") % 60) * 720 + F.col("l_linenumber")
    return items.join(parts, items.l_partkey == parts.p_partkey).select(
        site_of(number).alias("site"),
        number.cast("string").alias("line_no"),
        F.timestamp_add("MINUTE", minutes, F.expr("TIMESTAMP_NTZ'2024-01-01 07:30:00'")).alias("datetime"),
        F.concat("l_returnflag", F.lit(" #"), "l_linestatus", F.lit(" ("), "p_brand", F.lit(")/x%")).alias("test"),
        val.alias("val"),
        F.col("p_type").alias("part_item"),
    )


def specs(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Limits per line and part: A tests two-sided, N lower only, R_NoF upper only, R_NoO none."""
    tests = F.array(*[
        F.struct(F.lit(t).alias("test_cleaned"), F.lit(lo).cast("double").alias("lsl"), F.lit(hi).cast("double").alias("usl"))
        for t, lo, hi in SPEC_ROWS
    ])
    number = F.explode(F.sequence(F.lit(1), F.lit(5)))
    parts = load(spark, sf_dir, "part").select("p_type").distinct()
    rows = parts.select(F.col("p_type").alias("part_item"), number.alias("number"), tests.alias("t"))
    site = site_of(F.col("number"))
    return rows.select(
        site.alias("site"),
        text.line_id(site, line_of(F.col("number"))).alias("line_id"),
        "part_item", F.explode("t").alias("t"),
    ).select("site", "line_id", "part_item", "t.*")


SPEC_ROWS = [
    ("A_NoF_x", 20000.0, 90000.0), ("A_NoO_x", 20000.0, 90000.0),
    ("N_NoF_x", 20000.0, None), ("N_NoO_x", 20000.0, None),
    ("R_NoF_x", None, 90000.0),
]


def alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An alert change per order, moved on to the weeks of the telemetry."""
    orders = tables.spread(load(spark, sf_dir, "orders"), "o_orderkey")
    customers = load(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_mktsegment")
    number = number_of("o_custkey")
    changed = F.timestamp_add(
        "SECOND", F.col("o_orderkey") % 86400, F.timestamp_add("DAY", F.lit(8217), F.col("o_orderdate")))
    return orders.join(customers, orders.o_custkey == customers.c_custkey).select(
        site_of(number).alias("site"),
        changed.alias("changed_at"),
        F.when(F.col("o_orderstatus") != "P", F.timestamp_add("DAY", F.lit(7), changed)).alias("disable_until"),
        F.col("c_name").alias("changed_by"),
        (F.col("o_orderstatus") != "F").alias("disabled"),
        F.struct(
            F.concat(F.lit("line"), number.cast("string")).alias("resource"),
            F.concat("c_mktsegment", F.lit("_alert_good_fraction")).alias("trigger"),
            (F.col("o_custkey") % 20).cast("string").alias("part_number"),
        ).alias("alert_config"),
        "o_orderkey",
    )


def supplier_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A line configuration per supplier."""
    key = F.col("s_suppkey")
    return load(spark, sf_dir, "supplier").select(
        F.concat(F.lit("s"), F.col("s_nationkey").cast("string")).alias("site"),
        F.concat(F.lit("l"), key.cast("string")).alias("line"),
        F.when(F.col("s_acctbal") > 0, F.lit(20.0)).alias("heat_threshold"),
        F.struct(
            F.struct(
                (key % 7).cast("int").alias("num_heats"),
                F.when(F.col("s_acctbal") > 5000, F.lit(15.0)).alias("threshold"),
                F.concat(F.lit("heat_"), key.cast("string"), F.lit("_{x}")).alias("name"),
            ).alias("heats"),
            F.struct(
                F.when(F.col("s_acctbal") > 1000, F.array(F.lit("plug"), F.col("s_name"))).alias("controls"),
            ).alias("nonheats"),
        ).alias("controls"),
        F.lit(None).cast("array<string>").alias("recipients"),
        F.lit(None).cast("array<string>").alias("email_recipients"),
        F.lit(None).cast("string").alias("time_start_dayshift"),
        F.lit(None).cast("string").alias("alert_lookback_timedelta"),
        F.lit(30).alias("alert_lookback_days"),
        F.concat(F.lit("v-x-"), key.cast("string"), F.when(F.col("s_acctbal") > 0, F.lit("/ch_opcua")).otherwise(F.lit("/raw"))).alias("bucket"),
        F.lit(0).alias("ordinal"),
    )


def supplier_sites(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A site per supplier with none to three lines; supplier 0 plays the default entry."""
    key = F.col("s_suppkey")
    count = (key % 4).cast("int")
    return load(spark, sf_dir, "supplier").select(
        F.when(key == 0, F.lit("default")).otherwise(F.concat(F.lit("s"), key.cast("string"))).alias("site"),
        F.when(count > 0, F.transform(
            F.sequence(F.lit(1), count),
            lambda i: F.concat(F.lit("l"), key.cast("string"), F.lit("_"), i.cast("string")),
        )).alias("lines"),
        F.when(F.col("s_acctbal") > 0, F.lit("06:00:00")).alias("time_start_dayshift"),
        F.when(F.col("s_acctbal") > 2000, F.array("s_name")).alias("email_recipients"),
        F.when(F.col("s_acctbal") > 4000, F.lit("30 days")).alias("alert_lookback_timedelta"),
    )


def site_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Configuration of the first two lines of each of those sites, which names no site."""
    one = supplier_lines(spark, sf_dir).withColumn("site", F.lit(None).cast("string"))
    return one.withColumn("n", F.explode(F.array(F.lit(1), F.lit(2)))).withColumn(
        "line", F.concat("line", F.lit("_"), F.col("n").cast("string"))
    ).drop("n")


def own_site_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, and for every second site a configuration of its own under the same line names."""
    common = site_lines(spark, sf_dir)
    key = F.regexp_extract("line", r"^l(\d+)_", 1).cast("bigint")
    own = common.where(key % 2 == 0).withColumns(
        {"site": F.concat(F.lit("s"), key.cast("string")), "heat_threshold": F.lit(99.0)})
    return common.unionByName(own)


def broken_config(spark: SparkSession) -> DataFrame:
    """Line configurations of which one has no clock, one no look-back, and one stands twice."""
    rows = line_config(spark)
    line = F.col("line")
    rows = rows.withColumns({
        "time_start_dayshift": F.when(line == "alpha-l2", F.lit("late")).otherwise(F.col("time_start_dayshift")),
        "alert_lookback_timedelta": F.when(line == "l4", F.lit("soon")).otherwise(F.col("alert_lookback_timedelta"))})
    return rows.unionByName(rows.where(line == "l5").withColumn("line", F.lit("beta-l5")))


#: Shift starts of the lines in streams: midnight, morning, evening, a half hour, and one on no quarter of an hour.
STREAM_STARTS = {"l1": "00:00:00", "alpha-l2": "07:00:00", "l3": "19:00:00", "l4": "06:30:00", "l5": "06:37:30"}


def shifted_config(spark: SparkSession) -> DataFrame:
    """The line configurations with those starts."""
    starts = F.create_map(*[F.lit(x) for pair in STREAM_STARTS.items() for x in pair])
    return line_config(spark).withColumn("time_start_dayshift", starts[F.col("line")])


def write_json_files(rows: DataFrame, folder: str, cut: int, odd: int) -> None:
    """One JSON array per ``part``; of every 7 parts one is cut short and one has values of other kinds."""
    kept = [c for c in rows.columns if c != "part"]
    files = rows.groupBy("part").agg(F.to_json(F.collect_list(F.struct(*kept))).alias("value"))
    kind = F.col("part") % 7
    files = files.withColumn("value", F.when(kind == cut, F.substring(F.col("value"), F.lit(1), F.length("value") - 2)).when(
        kind == odd, F.lit('[{"site": "x", "line": "y", "ordinal": "z", "changed_at": "never"}]')).otherwise(F.col("value")))
    files.write.partitionBy("part").text(folder)


LOOKBACKS = {"60 days": 5184000, "60d": 5184000, "1440h": 5184000, "8w": 4838400, "60 days 00:00:00": 5184000,
             "1 day 02:30:05": 95405, "90 min": 5400, "soon": None}
CLOCKS = {"07:00:00": 420, "7:00:00": 420, "06:30": 390, "19:00": 1140, "0:15": 15, "late": None}


def spelled(key: str, values: dict) -> Column:
    """One of the texts, by an id."""
    return F.element_at(F.array(*[F.lit(v) for v in values]), (F.col(key) % len(values) + 1).cast("int"))
