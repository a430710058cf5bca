"""Schemas of the input tables, declared so that no reader has to infer them."""

from pyspark.sql import types as T

HEATS = T.StructType([
    T.StructField("num_heats", T.IntegerType()),
    T.StructField("threshold", T.DoubleType()),
    T.StructField("name", T.StringType()),
])

CONTROLS = T.StructType([
    T.StructField("heats", HEATS),
    T.StructField("nonheats", T.StructType([
        T.StructField("controls", T.ArrayType(T.StringType())),
    ])),
])

LINE_CONFIG = T.StructType([
    T.StructField("site", T.StringType()),
    T.StructField("line", T.StringType()),
    T.StructField("heat_threshold", T.DoubleType()),
    T.StructField("controls", CONTROLS),
    T.StructField("recipients", T.ArrayType(T.StringType())),
    T.StructField("email_recipients", T.ArrayType(T.StringType())),
    T.StructField("schedule_cron", T.StringType()),
    T.StructField("enabled", T.BooleanType()),
    T.StructField("time_start_dayshift", T.StringType()),
    T.StructField("alert_lookback_timedelta", T.StringType()),
    T.StructField("alert_lookback_days", T.IntegerType()),
    T.StructField("org", T.StringType()),
    T.StructField("bucket", T.StringType()),
    T.StructField("ordinal", T.IntegerType()),
])

SITE_CONFIG = T.StructType([
    T.StructField("site", T.StringType()),
    T.StructField("lines", T.ArrayType(T.StringType())),
    T.StructField("time_start_dayshift", T.StringType()),
    T.StructField("email_recipients", T.ArrayType(T.StringType())),
    T.StructField("alert_lookback_timedelta", T.StringType()),
])

TELEMETRY = T.StructType([
    T.StructField("site", T.StringType()),
    T.StructField("line", T.StringType()),
    T.StructField("measurement", T.StringType()),
    T.StructField("_time", T.TimestampNTZType()),
    T.StructField("_field", T.StringType()),
    T.StructField("_value", T.DoubleType()),
])

QUALITY = T.StructType([
    T.StructField("site", T.StringType()),
    T.StructField("line_no", T.StringType()),
    T.StructField("datetime", T.TimestampNTZType()),
    T.StructField("test", T.StringType()),
    T.StructField("val", T.StringType()),
    T.StructField("part_item", T.StringType()),
])

SPECS = T.StructType([
    T.StructField("site", T.StringType()),
    T.StructField("line_id", T.StringType()),
    T.StructField("part_item", T.StringType()),
    T.StructField("test_cleaned", T.StringType()),
    T.StructField("lsl", T.DoubleType()),
    T.StructField("usl", T.DoubleType()),
])

ALERT_CONFIG = T.StructType([
    T.StructField("resource", T.StringType()),
    T.StructField("trigger", T.StringType()),
    T.StructField("part_number", T.StringType()),
])

ALERT_HISTORY = T.StructType([
    T.StructField("site", T.StringType()),
    T.StructField("changed_at", T.TimestampType()),
    T.StructField("disable_until", T.TimestampType()),
    T.StructField("changed_by", T.StringType()),
    T.StructField("disabled", T.BooleanType()),
    T.StructField("alert_config", ALERT_CONFIG),
])
