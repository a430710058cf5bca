"""Run the reports once, or over a past period: ``spark-submit -m shiftlab`` or ``python -m shiftlab``."""

from __future__ import annotations

import argparse
from datetime import datetime, timedelta

from pyspark.sql import DataFrame, SparkSession

from shiftlab.operators import controls
from shiftlab.plans import jobs, reports, runs, sinks
from shiftlab.session import build_session
from shiftlab.sources import tables


def arguments(argv: list[str] | None = None) -> argparse.Namespace:
    p = argparse.ArgumentParser(prog="shiftlab", description=__doc__)
    p.add_argument("--lines", required=True, help="line configurations, JSON")
    p.add_argument("--sites", help="site configurations, JSON; lines then inherit from their site")
    p.add_argument("--site", help="one site only")
    p.add_argument("--line", action="append", help="one line only; may be repeated")
    p.add_argument("--telemetry", required=True, help="parquet")
    p.add_argument("--quality", help="parquet")
    p.add_argument("--specs", help="parquet")
    p.add_argument("--alerts", help="JSON arrays; parquet if the name ends so")
    p.add_argument("--out", required=True)
    p.add_argument("--as-of", type=datetime.fromisoformat, help="clock time of one run")
    p.add_argument("--first", type=datetime.fromisoformat, help="first run of a backfill")
    p.add_argument("--last", type=datetime.fromisoformat, help="last run of a backfill")
    p.add_argument("--site-tz", default="America/Chicago", help="zone of quality and alerts")
    p.add_argument("--run-id", help="default: the clock time of the run")
    p.add_argument("--parts", action="store_true", help="write documents as ordered parts")
    args = p.parse_args(argv)
    if (args.as_of is None) == (args.first is None or args.last is None):
        p.error("give either --as-of, or --first and --last")
    return args


def broken_inputs(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """Configuration and alert files that the run leaves out, with the reason."""
    found = tables.broken_files(spark, args.lines, "lines")
    if args.sites:
        found = found.unionByName(tables.broken_files(spark, args.sites, "sites"))
    if args.alerts and not args.alerts.endswith("parquet"):
        found = found.unionByName(tables.broken_files(spark, args.alerts, "alerts"))
    return found


def run(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    """Publish the reports; files that are broken are listed below ``out/broken_files`` and hold up no other."""
    run_id = args.run_id or (args.as_of or args.last).strftime("%Y-%m-%dT%H-%M")
    sinks.write_broken_files(broken_inputs(spark, args), f"{args.out}/broken_files", run_id)
    config = tables.read_line_config(spark, args.lines)
    if args.sites:
        config = controls.resolve_sites(tables.read_site_config(spark, args.sites), config, args.site)
    known = args.site is None or not config.where(config.site == args.site).isEmpty()
    config = controls.select_lines(config, args.site if known else None, args.line)
    if config.isEmpty():
        raise ValueError("no line configurations to report on")
    lines, per_line = controls.line_dim(config), controls.line_controls(config)
    backfill = args.as_of is None
    wanted = runs.backfill_runs(lines, args.first, args.last) if backfill else runs.scheduled_run(lines, args.as_of)
    alerts = args.alerts and tables.read_alerts(
        spark, args.alerts, "parquet" if args.alerts.endswith("parquet") else "json")
    found = reports.line_reports(
        wanted, lines, per_line,
        tables.scan_telemetry(
            tables.read_telemetry(spark, args.telemetry), lines=lines, as_of=args.as_of,
            since=args.first - timedelta(hours=24) if backfill else None,
            until=args.last + timedelta(hours=24) if backfill else None),
        tables.read_quality(spark, args.quality) if args.quality else None,
        tables.read_specs(spark, args.specs) if args.specs else None,
        alerts or None, site_tz=args.site_tz, known_at_run=backfill, fail_on="shift" if backfill else "fetch")
    return jobs.publish(found, args.out, run_id, whole=not args.parts)


if __name__ == "__main__":
    run(build_session("shift reports"), arguments()).show(truncate=False)
