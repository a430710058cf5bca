"""Small frames for the tests."""

from datetime import datetime

from shiftlab import schemas
from shiftlab.operators import controls

POINTS = "site string, line_id string, _time timestamp_ntz, _field string, _value double"
TELEMETRY = "site string, line string, measurement string, _time timestamp_ntz, _field string, _value double"


def at(text: str) -> datetime:
    return datetime.fromisoformat(text)


def config(spark, *entries, **defaults):
    """Line configurations; a keyword not given is missing."""
    rows = []
    for i, entry in enumerate(entries):
        x = {"site": "s", "line": "l1", "num_heats": None, "threshold": None, "name": "h_{x}", "nonheats": None,
             "ordinal": i, "bucket": "v-x-l1-1/ch_opcua", **defaults, **entry}
        rows.append((
            x["site"], x["line"], x.get("heat_threshold"),
            ((x["num_heats"], x["threshold"], x["name"]), (x["nonheats"],)),
            x.get("recipients"), x.get("email_recipients"), None, True, x.get("start"),
            x.get("timedelta"), x.get("days"), None, x["bucket"], x["ordinal"]))
    return spark.createDataFrame(rows, schemas.LINE_CONFIG)


def dims(spark, *entries, **defaults):
    """(lines, controls) of those configurations."""
    table = config(spark, *entries, **defaults)
    return controls.line_dim(table), controls.line_controls(table)


def points(spark, rows, site="s", line_id="s-l1"):
    """Points from (time, field, value)."""
    return spark.createDataFrame([(site, line_id, at(t), f, v) for t, f, v in rows], POINTS)


def rows_of(df, *columns):
    return sorted(tuple(r) for r in df.select(*columns).collect())
