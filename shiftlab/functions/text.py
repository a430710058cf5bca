"""Names and labels."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Characters dropped from test names, and trigger suffixes dropped.
DROPPED = "[-,?+%]"
TRIGGER_SUFFIXES = ("_alert_good_fraction", "_GEN_FLG_A_T")

# Bracketed remarks, up to the first closing bracket on the same line. (?d)
# makes only \n end a line.
REMARK = r"(?d)\(.*?\)"
# Whitespace, dots, slashes and underscores all turn into one underscore per
# run. (?U) adds the Unicode spaces, \x1c-\x1f the four separators it leaves out.
SEPARATORS = r"(?U)[\s\x1c-\x1f./_]+"


def sanitize_test(name: Column) -> Column:
    """A test name as an identifier.

    Some characters are dropped, '#' is spelled out, remarks go, runs of
    separators become one underscore, and the ends are trimmed.
    """
    kept = F.regexp_replace(name, DROPPED, "")
    spelled = F.replace(kept, F.lit("#"), F.lit("No"))
    plain = F.regexp_replace(spelled, REMARK, "")
    joined = F.regexp_replace(plain, SEPARATORS, "_")
    return F.regexp_replace(F.rtrim(joined, F.lit("_")), "^:", "")


def capitalise(text: Column) -> Column:
    """First character upper, the rest lower (not every word)."""
    return F.concat(F.upper(F.left(text, F.lit(1))), F.lower(F.substr(text, F.lit(2))))


def _swap(text: Column, old: str, new: str) -> Column:
    return F.replace(text, F.lit(old), F.lit(new))


def resource_label(resource: Column) -> Column:
    """``line8`` -> ``Line 8``."""
    return capitalise(_swap(resource, "e", "e "))


def line_label(line_id: Column) -> Column:
    """``alpha-l8`` -> ``Line 8``; NULL when there is no second part."""
    return _swap(F.get(F.split(line_id, "-"), 1), "l", "Line ")


def trigger_label(trigger: Column) -> Column:
    """``TOP_LOAD_alert_good_fraction`` -> ``Top load``."""
    for suffix in TRIGGER_SUFFIXES:
        trigger = _swap(trigger, suffix, "")
    return capitalise(_swap(trigger, "_", " "))


def line_id(site: Column, line: Column) -> Column:
    """``site-line``, or the line itself when it already carries its site."""
    prefix = F.concat(site, F.lit("-"))
    return F.when(F.startswith(line, prefix), line).otherwise(F.concat(prefix, line))


def line_part(line: Column) -> Column:
    """A requested line without its site: the text after the first dash."""
    return F.regexp_replace(line, r"^[^-]*-", "")


def table_site(line_id: Column) -> Column:
    """Site under which the measurements of a line are kept."""
    return F.get(F.split(line_id, "-"), 0)


def line_number(line_id: Column) -> Column:
    """``alpha-l22`` -> ``22``."""
    return F.substr(F.get(F.split(line_id, "-"), 1), F.lit(2))


def measurement_of(bucket: Column) -> Column:
    """``v-x-l8-1/ch_opcua`` -> ``opcua``; NULL when there is no ``ch_``."""
    return F.get(F.split(bucket, "ch_"), 1)
