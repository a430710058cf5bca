"""Wall-clock time: minutes, zones, 12-hour shifts.

Times are TIMESTAMP_NTZ. Nothing here depends on the session time zone.
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column
from pyspark.sql import functions as F

MINUTE = 60
SHIFT = 12 * 60 * MINUTE
DEFAULT_START = "07:00:00"


def wall_clock(t: datetime) -> Column:
    """A TIMESTAMP_NTZ literal. By way of text, since a datetime literal is an
    instant, whose clock depends on the zones of Python and of the session."""
    return F.lit(t.isoformat(sep=" ")).cast("timestamp_ntz")


def epoch() -> Column:
    return F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'")


def epoch_seconds(ts: Column) -> Column:
    """TIMESTAMP_NTZ -> BIGINT whole seconds since 1970.

    unix_timestamp takes wall clocks as they are. timestampdiff and date_trunc
    would first read them in the session zone, and move times its clock skips.
    """
    return F.unix_timestamp(ts)


def epoch_micros(ts: Column) -> Column:
    """TIMESTAMP_NTZ -> BIGINT microseconds since 1970."""
    of_minute = (F.extract(F.lit("SECOND"), ts) * 1_000_000).cast("bigint")
    return epoch_seconds(ts) * 1_000_000 + of_minute % 1_000_000


def from_seconds(seconds: Column) -> Column:
    """BIGINT seconds since 1970 -> TIMESTAMP_NTZ."""
    return F.timestamp_add("SECOND", seconds, epoch())


def instant_to_utc(ts: Column) -> Column:
    """TIMESTAMP (an instant) -> TIMESTAMP_NTZ holding the UTC wall clock."""
    return F.timestamp_add("MICROSECOND", F.unix_micros(ts), epoch())


def utc_to_instant(ts: Column) -> Column:
    """TIMESTAMP_NTZ holding the UTC wall clock -> TIMESTAMP."""
    return F.timestamp_micros(epoch_micros(ts))


def to_zone(ts: Column, source: str, target: str) -> Column:
    """Move a wall clock between zones; the same zone twice costs nothing.

    An ambiguous local time takes the earlier offset and a skipped one moves
    forward, where a strict converter would raise.
    """
    if source == target:
        return ts
    return F.convert_timezone(F.lit(source), F.lit(target), ts)


def minute_seconds(ts: Column) -> Column:
    """Seconds since 1970 of the nearest minute; half minutes go to the even minute."""
    seconds = epoch_seconds(ts)
    rest = F.pmod(seconds, F.lit(MINUTE))
    floor = seconds - rest
    odd = F.pmod(floor, F.lit(2 * MINUTE)) != 0
    beyond_half = ts > from_seconds(seconds)
    up = F.when(rest == MINUTE // 2, beyond_half | odd).otherwise(rest > MINUTE // 2)
    return floor + F.when(up, F.lit(MINUTE)).otherwise(F.lit(0))


def round_minute(ts: Column) -> Column:
    return from_seconds(minute_seconds(ts))


def timestamp_text(ts: Column) -> Column:
    """``YYYY-MM-DD HH:MM:SS`` and six decimals only when there is a fraction."""
    text = ts.cast("string")
    return F.when(
        F.length(text) > 19, F.rpad(text, 26, "0")
    ).otherwise(text)


def clock_seconds(clock: Column) -> Column:
    """``H:MM``, ``HH:MM`` or either with ``:SS`` -> seconds after midnight, NULL for any other text."""
    part = F.split(F.trim(clock), ":")
    seconds = (
        F.get(part, 0).try_cast("bigint") * 3600
        + F.get(part, 1).try_cast("bigint") * 60
        + F.coalesce(F.get(part, 2).try_cast("bigint"), F.lit(0))
    )
    return F.when(F.trim(clock).rlike(r"^([01]?\d|2[0-3]):[0-5]\d(:[0-5]\d)?$"), seconds)


def period_seconds(text: Column) -> Column:
    """Length of a period such as ``60 days``, ``8w``, ``1440h`` or ``1 day 02:30:00`` in seconds.

    Numbers with units, and at most one clock at the end, in any case. NULL for
    any other text.
    """
    plain = F.lower(F.trim(text))
    units = {"weeks?|w": 604800, "days?|d": 86400, "hours?|hrs?|hr|h": 3600,
             "minutes?|mins?|min|m|t": 60, "seconds?|secs?|sec|s": 1}
    known = "|".join(units)
    clock = F.regexp_extract(plain, r"(\d+:\d\d:\d\d)$", 1)
    total = F.when(clock == "", F.lit(0.0)).otherwise(
        F.get(F.split(clock, ":"), 0).try_cast("double") * 3600 + F.get(F.split(clock, ":"), 1).try_cast("double") * 60
        + F.get(F.split(clock, ":"), 2).try_cast("double"))
    for unit, seconds in units.items():
        counts = F.regexp_extract_all(plain, F.lit(rf"(\d+(?:\.\d+)?)\s*(?:{unit})(?![a-z])"), F.lit(1))
        total = total + F.aggregate(counts, F.lit(0.0), lambda sum_, n: sum_ + n.try_cast("double")) * seconds
    shape = rf"^(\d+(\.\d+)?\s*({known})(?![a-z]),?\s*)*(\d+:\d\d:\d\d)?$"
    return F.when(plain.rlike(shape) & (plain != ""), total.cast("bigint"))


def shift_start_seconds(ts: Column, start_seconds: Column) -> Column:
    """Start of the half-open shift holding ``ts``, for a start that varies by row.

    Plain BIGINT arithmetic, so readings meet their shift without a range join.
    """
    seconds = epoch_seconds(ts)
    return seconds - F.pmod(seconds - start_seconds, F.lit(SHIFT))


def shift_window(ts: Column, start: str) -> Column:
    """The same shift as a tumbling window, for one start known up front.

    Works in batch and in streams, and needs no per-row clock conversion.
    """
    hours, minutes, seconds = (int(x) for x in start.split(":"))
    offset = (hours * 3600 + minutes * 60 + seconds) % SHIFT
    return F.window(ts, "12 hours", "12 hours", f"{offset} seconds")


def shift_letter_of_start(shift_start: Column, start_seconds: Column) -> Column:
    """D for the shift that begins at the day-shift start, in seconds after midnight, N for the other."""
    clock = F.pmod(epoch_seconds(shift_start), F.lit(86400))
    return F.when(clock == start_seconds, F.lit("D")).otherwise(F.lit("N"))


def shift_label(shift_start: Column, letter: Column) -> Column:
    """``YYYY_MM_DD D`` or ``YYYY_MM_DD N``; the date is that of the shift start."""
    day = F.replace(shift_start.cast("date").cast("string"), F.lit("-"), F.lit("_"))
    return F.concat(day, F.lit(" "), letter)


def shift_end(shift_start: Column) -> Column:
    return shift_start + F.expr("INTERVAL 12 HOURS")


def shift_letter(label: Column) -> Column:
    """Letter of a label."""
    return F.when(F.contains(label, F.lit("D")), F.lit("D")).otherwise(F.lit("N"))


def run_shift(run_at: Column, start: Column) -> Column:
    """The shift a run at clock time ``run_at`` reports on, as a struct.

    Before noon that is the night shift that began the evening before, from
    noon on today's day shift, whatever the day-shift start is. It is not
    always the shift that holds ``run_at``.
    """
    midnight = run_at.cast("date").cast("timestamp_ntz")
    day_start = F.timestamp_add("SECOND", clock_seconds(start), midnight)
    night = F.hour(run_at) < 12
    left = F.when(night, day_start - F.expr("INTERVAL 12 HOURS")).otherwise(day_start)
    letter = F.when(night, F.lit("N")).otherwise(F.lit("D"))
    return F.struct(
        left.alias("shift_start"),
        shift_end(left).alias("shift_end"),
        shift_label(left, letter).alias("shift_label"),
    )
