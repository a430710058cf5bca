"""Alert history of a line within a look-back period."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shiftlab.functions import text, times
from shiftlab.operators.points import LINE
from shiftlab.operators.sizes import sized

# The columns of the report, in order.
COLUMNS = {
    "line_label": "Line",
    "part": "Part",
    "trigger": "Trigger",
    "changed_by": "Changed by",
    "changed_at": "Changed at",
    "disabled": "Disabled",
    "disable_until": "Disable until",
}

PERIOD_DAYS = 7


def site_clock(ts: Column, dtype: str, site_tz: str, bucket: str | None = "minute") -> Column:
    """Alert time on the site's clock, rounded to the minute unless ``bucket`` is None."""
    utc = times.instant_to_utc(ts) if dtype == "timestamp" else ts
    if bucket == "minute":
        utc = times.round_minute(utc)
    return times.to_zone(utc, "UTC", site_tz)


def parse_config(alerts: DataFrame, schema: str = "resource string, trigger string, part_number string") -> DataFrame:
    """``alert_config`` as a struct when it is stored as JSON text."""
    if dict(alerts.dtypes)["alert_config"] == "string":
        alerts = alerts.withColumn("alert_config", F.from_json("alert_config", schema))
    return alerts


def alert_rows(alerts: DataFrame, site_tz: str = "America/Chicago", bucket: str | None = "minute") -> DataFrame:
    """Alert history with site-clock times and readable labels."""
    alerts = parse_config(alerts)
    types = dict(alerts.dtypes)
    return alerts.select(
        "site",
        text.resource_label(F.col("alert_config.resource")).alias("line_label"),
        F.col("alert_config.part_number").alias("part"),
        text.trigger_label(F.col("alert_config.trigger")).alias("trigger"),
        "changed_by",
        site_clock(F.col("changed_at"), types["changed_at"], site_tz, bucket).alias("changed_at"),
        "disabled",
        site_clock(F.col("disable_until"), types["disable_until"], site_tz, bucket).alias("disable_until"),
    )


def cutoff(run_at: Column, lookback: Column) -> Column:
    """Start of the look-back, from text such as ``60 days``; NULL if the text names no period."""
    return F.timestamp_add("SECOND", -times.period_seconds(lookback), run_at)


def period(ts: Column) -> Column:
    return F.floor(F.unix_date(ts.cast("date")) / PERIOD_DAYS)


def by_period(rows: DataFrame) -> DataFrame:
    """Rendered rows (site, line_label, changed_at, row) gathered per line and period, oldest first, and put together.

    A period is a week, so what is gathered does not grow with the history.
    """
    held = F.array_sort(F.collect_list(F.struct("changed_at", "row")))
    grouped = rows.groupBy("site", "line_label", period(F.col("changed_at")).alias("period")).agg(held.alias("held"))
    return grouped.withColumn("whole", F.array_join(F.col("held.row"), ""))


def period_texts(periods: DataFrame, runs: DataFrame) -> DataFrame:
    """(site, line_id, run_at, period, text): what each run shows of each period that its look-back touches.

    Runs are told apart only here, after the rows were put together: a period that lies
    within a look-back is taken whole, and only the two at its ends are cut.
    """
    begin = cutoff(F.col("run_at"), F.col("lookback"))
    dim = runs.select(*LINE, "run_at", begin.alias("cutoff"), text.line_label(F.col("line_id")).alias("line_label"))
    first, last = period(F.col("cutoff")), period(F.col("run_at"))
    dim = dim.withColumns({"first": first, "last": last, "period": F.explode(F.sequence(first, last))})
    found = periods.join(sized(dim), ["site", "line_label", "period"])
    inner = (F.col("period") > F.col("first")) & (F.col("period") < F.col("last"))
    cut = F.filter("held", lambda r: (r["changed_at"] > F.col("cutoff")) & (r["changed_at"] <= F.col("run_at")))
    shown = F.when(inner, F.col("whole")).otherwise(F.array_join(F.transform(cut, lambda r: r["row"]), ""))
    return found.select(*LINE, "run_at", "period", shown.alias("text"))


def in_lookback(rows: DataFrame, runs: DataFrame, known_at_run: bool = False) -> DataFrame:
    """Rows of :func:`alert_rows` in the look-back of each run of their line.

    ``runs`` has site, line_id, run_at and lookback. A row exactly at the cutoff
    is out. With ``known_at_run`` a run in the past does not see what was changed
    after it. One scan serves all lines and runs.
    """
    begin = cutoff(F.col("run_at"), F.col("lookback"))
    dim = runs.select(*LINE, "run_at", begin.alias("cutoff"), text.line_label(F.col("line_id")).alias("line_label"))
    keys = ["site", "line_label"]
    if known_at_run:
        # Each alert is in one period, each run in the few its look-back touches,
        # so a long backfill does not pair every run with every alert of its line.
        first, last = period(F.col("cutoff")), period(F.col("run_at"))
        dim = dim.withColumn("period", F.explode(F.sequence(first, last)))
        rows = rows.withColumn("period", period(F.col("changed_at")))
        keys.append("period")
    found = rows.join(sized(dim), keys).where(F.col("changed_at") > F.col("cutoff"))
    return found.where(F.col("changed_at") <= F.col("run_at")) if known_at_run else found


def alert_view(alerts: DataFrame, runs: DataFrame, site_tz: str = "America/Chicago",
               bucket: str | None = "minute", known_at_run: bool = False) -> DataFrame:
    """Alerts of each line in the look-back of each run; re-enabled ones (``disabled`` false) stay in."""
    found = in_lookback(alert_rows(alerts, site_tz, bucket), runs, known_at_run)
    return found.select(*LINE, "run_at", *COLUMNS)


def report_columns(view: DataFrame) -> DataFrame:
    """The view under the names shown in reports."""
    return view.select(*[F.col(c).alias(name) for c, name in COLUMNS.items()])
