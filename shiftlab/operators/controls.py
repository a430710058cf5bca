"""Line configuration: which lines, which controls, which thresholds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from shiftlab.functions import text, times

DEFAULT_THRESHOLD = 10.0
DEFAULT_LOOKBACK = "60 days"
START_ERROR = "day-shift start is no clock time"
LOOKBACK_ERROR = "alert look-back is no period"
TWICE_ERROR = "line configured more than once"


def heat_threshold(enhanced: bool = True) -> Column:
    """Threshold of a line: that of its heats first, then the line's, then 10.

    ``enhanced=False`` is the older rule, which knows only the line's.
    """
    line = F.coalesce(F.col("heat_threshold"), F.lit(DEFAULT_THRESHOLD))
    return F.coalesce(F.col("controls.heats.threshold"), line) if enhanced else line


def lookback_text() -> Column:
    """Alert look-back as configured: the interval text, else the days, else 60 days."""
    days = F.concat(F.col("alert_lookback_days").cast("string"), F.lit(" days"))
    return F.coalesce(F.col("alert_lookback_timedelta"), days, F.lit(DEFAULT_LOOKBACK))


def line_dim(line_config: DataFrame) -> DataFrame:
    """One row per line with every default filled in, and what is wrong with it in ``config_error``.

    Of a line configured more than once the first row stays, and fails.
    """
    start = F.coalesce(F.col("time_start_dayshift"), F.lit(times.DEFAULT_START))
    ordinal = F.coalesce(F.col("ordinal"), F.lit(0))
    same = Window.partitionBy("site", text.line_id(F.col("site"), F.col("line")))
    rows = line_config.withColumns({
        "_times": F.count("*").over(same), "_place": F.row_number().over(same.orderBy(ordinal, "line"))}).where("_place = 1")
    return rows.select(
        "site",
        "line",
        text.line_id(F.col("site"), F.col("line")).alias("line_id"),
        start.alias("dayshift_start"),
        times.clock_seconds(start).alias("start_seconds"),
        heat_threshold().alias("threshold"),
        lookback_text().alias("lookback"),
        text.measurement_of(F.col("bucket")).alias("measurement"),
        F.coalesce("email_recipients", "recipients", F.array().cast("array<string>")).alias("recipients"),
        ordinal.alias("ordinal"),
        F.when(F.col("_times") > 1, F.lit(TWICE_ERROR))
        .when(times.clock_seconds(start).isNull(), F.lit(START_ERROR))
        .when(times.period_seconds(lookback_text()).isNull(), F.lit(LOOKBACK_ERROR)).alias("config_error"),
    )


def line_controls(line_config: DataFrame, enhanced: bool = True) -> DataFrame:
    """One row per line with its threshold and all its controls: numbered heats, then listed others.

    ``enhanced`` is the threshold rule, see :func:`heat_threshold`. ``{x}`` in the heat name counts from 1. A count below one gives no heats;
    sequence(1, 0) would run backwards, hence the guard.
    """
    count = F.coalesce(F.col("controls.heats.num_heats"), F.lit(0))
    numbers = F.when(count >= 1, F.sequence(F.lit(1), count)).otherwise(F.array().cast("array<int>"))
    template = F.coalesce(F.col("controls.heats.name"), F.lit(""))
    heats = F.transform(numbers, lambda i: F.struct(
        F.lit("heat").alias("kind"),
        F.replace(template, F.lit("{x}"), i.cast("string")).alias("control"),
        i.alias("control_ordinal"),
    ))
    listed = F.coalesce(F.col("controls.nonheats.controls"), F.array().cast("array<string>"))
    nonheats = F.transform(listed, lambda name, i: F.struct(
        F.lit("nonheat").alias("kind"), name.alias("control"), (i + 1).alias("control_ordinal"),
    ))
    start = F.coalesce(F.col("time_start_dayshift"), F.lit(times.DEFAULT_START))
    return line_config.select(
        "site",
        text.line_id(F.col("site"), F.col("line")).alias("line_id"),
        start.alias("dayshift_start"),
        times.clock_seconds(start).alias("start_seconds"),
        heat_threshold(enhanced).alias("threshold"),
        F.concat(heats, nonheats).alias("controls"),
    )


def expand_controls(controls: DataFrame) -> DataFrame:
    """One row per control, from :func:`line_controls`."""
    rows = controls.select("site", "line_id", F.explode("controls").alias("c"))
    return rows.select("site", "line_id", "c.kind", "c.control", "c.control_ordinal")


def requested_names(controls: DataFrame) -> DataFrame:
    """Each control name once per line, with the line's shift start."""
    names = F.array_distinct(F.transform("controls", lambda c: c["control"]))
    return controls.select("site", "line_id", "start_seconds", F.explode(names).alias("_field"))


def select_lines(line_config: DataFrame, site: str | None = None,
                 lines: list[str] | None = None, require: bool = False) -> DataFrame:
    """Configured lines of a site and a list of lines.

    A requested line may carry its site (``alpha-l8``). ``require`` demands both
    arguments, as the older variant does.
    """
    if require and not (site and lines):
        raise ValueError("both site and lines are required")
    if site:
        line_config = line_config.where(F.col("site") == site)
    if lines:
        wanted = [line.split("-", 1)[-1] for line in lines]
        line_config = line_config.where(text.line_part(F.col("line")).isin(wanted))
    return line_config


def resolve_sites(site_config: DataFrame, line_config: DataFrame, site: str | None = None) -> DataFrame:
    """Line configurations reached through the site table.

    For all sites, each line inherits day-shift start, recipients and look-back
    from its site; sites without lines and the ``default`` entry are left out.
    For one named site nothing is inherited, and a site without lines is its own
    single line. An unknown name means all sites. A configuration that names a
    site is that site's line, one that names none serves every site without its own.
    """
    settings = [c for c in line_config.columns if c not in ("site", "line")]
    stated = F.struct(*settings)
    own = line_config.where(F.col("site").isNotNull()).select("site", "line", stated.alias("own"))
    common = line_config.where(F.col("site").isNull()).select("line", stated.alias("common"))

    def configured(wanted: DataFrame) -> DataFrame:
        found = wanted.join(own, ["site", "line"], "left").join(common, "line", "left")
        chosen = F.when(F.col("own").isNotNull(), F.col("own")).otherwise(F.col("common"))
        return found.select(*wanted.columns, *[chosen[c].alias(f"_{c}") for c in settings])

    if site is not None:
        # An empty answer means the name is unknown; only then are all sites read.
        named = site_config.where(F.col("site") == site)
        if not named.isEmpty():
            lines = F.coalesce("lines", F.array("site"))
            wanted = named.select("site", F.posexplode(lines).alias("position", "line"))
            return configured(wanted).select(
                "site", "line", *[F.col(f"_{c}").alias(c) for c in settings if c != "ordinal"],
                F.col("position").alias("ordinal"),
            )
    inherited = ("time_start_dayshift", "email_recipients", "alert_lookback_timedelta")
    wanted = site_config.where(
        (F.col("site") != "default") & F.col("lines").isNotNull()
    ).select(
        "site",
        F.coalesce("time_start_dayshift", F.lit(times.DEFAULT_START)).alias("time_start_dayshift"),
        F.coalesce("email_recipients", F.array().cast("array<string>")).alias("email_recipients"),
        F.coalesce("alert_lookback_timedelta", F.lit(DEFAULT_LOOKBACK)).alias("alert_lookback_timedelta"),
        F.posexplode("lines").alias("ordinal", "line"),
    )
    return configured(wanted).select(
        "site", "line", *inherited,
        *[F.col(f"_{c}").alias(c) for c in settings if c not in ("ordinal", *inherited)],
        "ordinal",
    )
