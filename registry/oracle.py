"""The registered queries as SQL, written apart from the library's own formulas."""

from __future__ import annotations

from registry.views import CLOCKS, EVENT_FIELD, FIELDS, LINES, LOOKBACKS, SPEC_ROWS, STREAM_STARTS


def text(value: str | None) -> str:
    return "NULL" if value is None else "'" + value.replace("'", "''") + "'"


def number(value: float | None) -> str:
    return "NULL::DOUBLE" if value is None else f"{value}::DOUBLE"


def _line_id(x: dict) -> str:
    return x["line"] if x["line"].startswith(x["site"] + "-") else f"{x['site']}-{x['line']}"


def _threshold(x: dict) -> float:
    return next(t for t in (x["threshold"], x["heat_threshold"], 10.0) if t is not None)


def _lookback(x: dict) -> str:
    return x.get("timedelta") or (f"{x['days']} days" if x.get("days") else "60 days")


def _recipients(x: dict) -> str:
    names = x.get("email_recipients") or x["recipients"] or []
    return "[" + ", ".join(text(n) for n in names) + "]::VARCHAR[]"


def _config_rows(starts: dict | None = None) -> str:
    rows = []
    for i, x in enumerate(LINES):
        start = (starts or {}).get(x["line"]) or x["start"] or "07:00:00"
        bucket = x["bucket"].split("ch_")
        rows.append("(" + ", ".join([
            text(x["site"]), text(x["line"]), text(_line_id(x)), f"INTERVAL '{start}'", f"TIME '{start}'",
            number(_threshold(x)), text(bucket[1] if len(bucket) > 1 else None),
            text(_lookback(x)), f"INTERVAL '{_lookback(x)}'", _recipients(x), str(i),
            text(_line_id(x).split("-")[1][1:]),
        ]) + ")")
    return ",\n".join(rows)


def _control_rows() -> str:
    rows = []
    for x in LINES:
        heats = [("heat", f"heat_{i}", i) for i in range(1, x["num_heats"] + 1)]
        others = [("nonheat", name, i) for i, name in enumerate(x["nonheats"], 1)]
        rows += [f"({text(x['site'])}, {text(_line_id(x))}, {text(k)}, {text(c)}, {o})" for k, c, o in heats + others]
    return ",\n".join(rows)


CONFIG = f"""
cfg AS (SELECT * FROM (VALUES
{_config_rows()}
) v(site, line, line_id, start_after, start_clock, threshold, measurement, lookback, lookback_span, recipients, ordinal, line_no)),
ctl AS (SELECT * FROM (VALUES
{_control_rows()}
) v(site, line_id, kind, control, control_ordinal))"""

_NUMBER = "(user_id % 5 + 1)"
TELEMETRY = f"""
tel AS (SELECT event_id,
  CASE WHEN {_NUMBER} <= 3 THEN 'alpha' ELSE 'beta' END AS site,
  CASE WHEN {_NUMBER} <= 3 THEN 'alpha-l' ELSE 'beta-l' END || {_NUMBER} AS line_id,
  ts AS _time,
  CASE event_type {' '.join(f"WHEN '{e}' THEN '{f}'" for e, f in EVENT_FIELD.items())} END AS _field,
  value AS _value FROM events),
req AS (SELECT t.*, g.start_after, g.start_clock FROM tel t JOIN cfg g USING (site, line_id)
  WHERE EXISTS (SELECT 1 FROM ctl c WHERE c.line_id = t.line_id AND c.control = t._field))"""


def minute(ts: str) -> str:
    """Nearest minute, half to even."""
    us = f"epoch_us({ts})"
    return (f"make_timestamp(({us} // 60000000 + CASE WHEN {us} % 60000000 > 30000000 "
            f"OR ({us} % 60000000 = 30000000 AND ({us} // 60000000) % 2 = 1) THEN 1 ELSE 0 END) * 60000000)")


def open_shift(ts: str) -> str:
    return f"time_bucket(INTERVAL 12 hours, {ts}, start_after)"


def label(shift_start: str, clock: str = "start_clock") -> str:
    return f"strftime({shift_start}, '%Y_%m_%d ') || CASE WHEN CAST({shift_start} AS TIME) = {clock} THEN 'D' ELSE 'N' END"


# Every shift of every line that the data can touch, for closed intervals.
CALENDAR = """
cal AS (SELECT site, line_id, start_clock, unnest(generate_series(
    TIMESTAMP '2023-12-30 00:00:00' + start_after, TIMESTAMP '2024-03-01 00:00:00', INTERVAL 12 hours)) AS shift_start
  FROM cfg)"""

DEDUP = f"""
firsts AS (SELECT *, {minute('_time')} AS minute_level FROM req),
kept AS (SELECT * FROM (SELECT *, min(_time) OVER (PARTITION BY site, line_id, minute_level) AS first_time FROM firsts)
  WHERE _time = first_time)"""


def closed_rows(source: str, ts: str) -> str:
    return f"""
rows_in AS (SELECT s.site, s.line_id, s.shift_start, r._field, r._value, r._time, r.event_id, r.{ts} AS seen
  FROM {source} r JOIN cal s ON r.site = s.site AND r.line_id = s.line_id
   AND r.{ts} BETWEEN s.shift_start AND s.shift_start + INTERVAL 12 hours)"""


def open_rows(source: str, ts: str = "_time") -> str:
    return f"""
rows_in AS (SELECT site, line_id, {open_shift(ts)} AS shift_start, _field, _value, _time, event_id, {ts} AS seen FROM {source})"""


OBSERVED = """
obs AS (SELECT site, line_id, shift_start, _field AS control,
  first(_value ORDER BY _time, event_id) FILTER (WHERE _value IS NOT NULL) AS start_value,
  last(_value ORDER BY _time, event_id) FILTER (WHERE _value IS NOT NULL) AS end_value,
  max(_value) AS high, min(_value) AS low, min(seen) AS earliest, max(seen) AS latest
  FROM rows_in GROUP BY ALL)"""

CHANGES = f"""
chg AS (SELECT c.site, c.line_id, s.shift_start, s.shift_start + INTERVAL 12 hours AS shift_end,
  {label('s.shift_start', 'g.start_clock')} AS shift_label, c.kind, c.control, c.control_ordinal, g.threshold,
  o.start_value, o.end_value,
  coalesce(o.end_value - o.start_value, 0) AS delta, coalesce(o.high - o.low, 0) AS spread
  FROM (SELECT DISTINCT site, line_id, shift_start FROM obs) s
  JOIN ctl c ON c.line_id = s.line_id JOIN cfg g ON g.line_id = s.line_id
  LEFT JOIN obs o ON o.line_id = s.line_id AND o.shift_start = s.shift_start AND o.control = c.control)"""


def r6(expression: str, name: str | None = None) -> str:
    return f"round({expression}, 6) + 0.0 AS {name or expression}"


CHANGE_COLUMNS = ("site, line_id, shift_start, shift_end, shift_label, kind, control, "
                  + ", ".join(r6(c) for c in ("start_value", "end_value", "delta", "spread")))


def with_(*parts: str) -> str:
    return "WITH " + ",".join(parts)


_OPEN = with_(CONFIG, TELEMETRY, open_rows("req"), OBSERVED, CHANGES)

ORACLE: dict[str, str] = {}

ORACLE["shift_changes_all"] = f"{_OPEN} SELECT {CHANGE_COLUMNS} FROM chg"

ORACLE["shift_changes_uniform_start"] = f"""
{with_(CONFIG, TELEMETRY, '''
rows_in AS (SELECT site, line_id, time_bucket(INTERVAL 12 hours, _time, INTERVAL 7 hours) AS shift_start,
  _field, _value, _time, event_id, _time AS seen FROM req)''', OBSERVED)}
SELECT site, line_id, shift_start, control, {r6('start_value')}, {r6('end_value')}, {r6('high')}, {r6('low')}, earliest, latest FROM obs"""

ORACLE["shift_changes_closed"] = f"""
{with_(CONFIG, TELEMETRY, CALENDAR, f"rounded AS (SELECT *, {minute('_time')} AS minute_level FROM req)",
       closed_rows('rounded', 'minute_level'), OBSERVED, CHANGES)} SELECT {CHANGE_COLUMNS} FROM chg"""

ORACLE["shift_changes_tiebreak"] = f"""
{with_(CONFIG, TELEMETRY, "coarse AS (SELECT * REPLACE (date_trunc('hour', _time)::TIMESTAMP AS _time) FROM req)",
       open_rows('coarse'), OBSERVED, CHANGES)} SELECT {CHANGE_COLUMNS} FROM chg"""

_OWN = "own AS (SELECT * FROM kept WHERE line_id IN (SELECT line_id FROM cfg WHERE measurement = 'opcua'))"
ORACLE["process_changes"] = f"""
{with_(CONFIG, TELEMETRY, DEDUP, _OWN, CALENDAR, closed_rows('own', 'minute_level'), OBSERVED, CHANGES)}
SELECT {CHANGE_COLUMNS} FROM chg"""

_FETCH = "ts >= TIMESTAMP '2024-01-15 06:02:00' AND ts < TIMESTAMP '2024-01-16 06:02:00'"
ORACLE["process_changes_run"] = f"""
{with_(CONFIG, TELEMETRY.replace('FROM events', f"FROM events WHERE {_FETCH}"), DEDUP, CALENDAR,
       closed_rows('kept', 'minute_level'), OBSERVED, CHANGES)}
SELECT {CHANGE_COLUMNS} FROM chg JOIN cfg USING (site, line_id)
WHERE shift_start = TIMESTAMP '2024-01-16 00:00:00' + start_after - INTERVAL 12 hours"""

ORACLE["assign_shifts"] = f"""
{with_(CONFIG, TELEMETRY, CALENDAR, f"rounded AS (SELECT *, {minute('_time')} AS minute_level FROM req)",
       closed_rows('rounded', 'minute_level'))}
SELECT event_id, line_id, seen AS minute_level, shift_start, shift_start + INTERVAL 12 hours AS shift_end FROM rows_in"""

ORACLE["shift_for_run"] = """
WITH r AS (SELECT o_orderkey, o_orderdate + to_minutes(((o_orderkey * 7) % 1440)::BIGINT) AS run_at,
  CASE o_custkey % 5 WHEN 0 THEN INTERVAL '07:00:00' WHEN 1 THEN INTERVAL '06:30:00' WHEN 2 THEN INTERVAL '00:00:00'
    WHEN 3 THEN INTERVAL '12:15:30' ELSE INTERVAL '19:00:00' END AS start_after FROM orders),
s AS (SELECT *, date_trunc('day', run_at)::TIMESTAMP + start_after
    - CASE WHEN hour(run_at) < 12 THEN INTERVAL 12 hours ELSE INTERVAL 0 hours END AS shift_start,
  CASE WHEN hour(run_at) < 12 THEN 'N' ELSE 'D' END AS shift_letter FROM r)
SELECT o_orderkey, run_at, shift_start, shift_start + INTERVAL 12 hours AS shift_end,
  strftime(shift_start, '%Y_%m_%d ') || shift_letter AS shift_label, shift_letter FROM s"""

ORACLE["heat_over_threshold"] = f"""{_OPEN}
SELECT site, line_id, shift_label, control, threshold, {r6('delta')},
  trunc(start_value)::BIGINT AS shown_start, trunc(end_value)::BIGINT AS shown_end,
  trunc(delta)::BIGINT AS shown_delta, trunc(spread)::BIGINT AS shown_spread
FROM chg WHERE kind = 'heat' AND (delta > threshold OR delta < -threshold)"""

ORACLE["change_ranking"] = f"""{_OPEN}
SELECT site, line_id, shift_label, kind, control,
  row_number() OVER (PARTITION BY site, line_id, shift_start, kind
    ORDER BY round(spread, 6) DESC NULLS LAST, control_ordinal)::INTEGER AS place FROM chg"""

ORACLE["shift_coverage"] = f"""{_OPEN}
SELECT site, line_id, shift_start, min(seen) AS earliest, max(seen) AS latest FROM rows_in GROUP BY ALL"""

_FLAG = """bool_or(CASE WHEN kind = 'heat' THEN delta > threshold OR delta < -threshold ELSE delta <> 0 END)"""
ORACLE["changed_flag"] = f"""{_OPEN}
SELECT site, line_id, shift_label, {_FLAG} AS changed FROM chg GROUP BY site, line_id, shift_label"""

_POINT = "event_id, site, line_id, _time, _field, _value"
ORACLE["telemetry_scan"] = f"""{with_(CONFIG, TELEMETRY)}
SELECT {_POINT} FROM tel WHERE _time >= TIMESTAMP '2024-01-15 06:02:00' AND _time < TIMESTAMP '2024-01-16 06:02:00'
  AND line_id IN (SELECT line_id FROM cfg WHERE measurement = 'opcua')"""
ORACLE["minute_rounding"] = f"SELECT event_id, {minute('ts')} AS minute_level FROM events"
ORACLE["shift_changes_local"] = f"""{with_(CONFIG, TELEMETRY, "there AS (SELECT *, (_time AT TIME ZONE 'UTC') AT TIME ZONE 'America/Chicago' AS local_time FROM req)",
       open_rows('there', 'local_time'), OBSERVED, CHANGES)} SELECT {CHANGE_COLUMNS} FROM chg"""
ORACLE["field_semijoin"] = f"{with_(CONFIG, TELEMETRY)} SELECT {_POINT} FROM req"
ORACLE["minute_dedup"] = f"{with_(CONFIG, TELEMETRY, DEDUP)} SELECT {_POINT.removeprefix('event_id, ')}, minute_level FROM kept"
ORACLE["minute_dedup_off"] = f"{with_(CONFIG, TELEMETRY)} SELECT {_POINT}, _time AS minute_level FROM req"
ORACLE["wide_minutes"] = f"""{with_(CONFIG, TELEMETRY, DEDUP)}
SELECT site, line_id, minute_level, {', '.join(f"max(CASE WHEN _field = '{f}' THEN _value END) AS {f}" for f in FIELDS)}
FROM kept GROUP BY site, line_id, minute_level"""

_TWICE = """
twice AS (SELECT site, line_id, _time, _field, _value FROM tel
  UNION ALL SELECT site, line_id, _time, _field, _value + 1 FROM tel WHERE _field = 'heat_3'),
dup AS (SELECT site, line_id, _time, _field, count(*) AS copies FROM twice GROUP BY ALL HAVING count(*) > 1)"""
ORACLE["dup_key_guard"] = f"{with_(CONFIG, TELEMETRY, _TWICE)} SELECT * FROM dup"
ORACLE["dup_key_lines"] = f"""{with_(CONFIG, TELEMETRY, _TWICE)}
SELECT site, line_id, count(*) AS duplicate_keys FROM dup GROUP BY ALL"""
ORACLE["union_dedup"] = f"""{with_(CONFIG, TELEMETRY)}
SELECT site, line_id, _time, _field, _value FROM tel UNION SELECT site, line_id, _time, _field, _value FROM tel"""

# Configuration

_SUPPLIER = """
sup AS (SELECT s_suppkey AS k, 's' || s_nationkey AS site, 's' || s_nationkey || '-l' || s_suppkey AS line_id, s_name, s_acctbal FROM supplier),
sctl AS (
  SELECT site, line_id, 'heat' AS kind, 'heat_' || k || '_' || i AS control, i::INTEGER AS control_ordinal
  FROM sup, LATERAL (SELECT unnest(generate_series(1, k % 7)) AS i)
  UNION ALL SELECT site, line_id, 'nonheat', 'plug', 1 FROM sup WHERE s_acctbal > 1000
  UNION ALL SELECT site, line_id, 'nonheat', s_name, 2 FROM sup WHERE s_acctbal > 1000)"""
ORACLE["expand_controls"] = f"{with_(_SUPPLIER)} SELECT * FROM sctl"
ORACLE["line_settings"] = """
SELECT 's' || s_nationkey AS site, 's' || s_nationkey || '-l' || s_suppkey AS line_id, '07:00:00' AS dayshift_start,
  CASE WHEN s_acctbal > 5000 THEN 15.0 WHEN s_acctbal > 0 THEN 20.0 ELSE 10.0 END::DOUBLE AS threshold,
  '30 days' AS lookback, CASE WHEN s_acctbal > 0 THEN 'opcua' END AS measurement FROM supplier"""
ORACLE["site_inherit"] = """
WITH s AS (SELECT *, unnest(generate_series(1, s_suppkey % 4)) AS i FROM supplier WHERE s_suppkey <> 0)
SELECT 's' || s_suppkey AS site, 'l' || s_suppkey || '_' || i AS line,
  CASE WHEN s_acctbal > 0 THEN '06:00:00' ELSE '07:00:00' END AS time_start_dayshift,
  CASE WHEN s_acctbal > 2000 THEN s_name ELSE '' END AS email_recipients,
  CASE WHEN s_acctbal > 4000 THEN '30 days' ELSE '60 days' END AS alert_lookback_timedelta,
  CASE WHEN i <= 2 AND s_acctbal > 0 THEN 20.0::DOUBLE END AS heat_threshold,
  CASE WHEN i <= 2 THEN 'v-x-' || s_suppkey || CASE WHEN s_acctbal > 0 THEN '/ch_opcua' ELSE '/raw' END END AS bucket,
  (i - 1)::INTEGER AS ordinal FROM s"""
_NAMED = """
SELECT '{asked}' AS asked, 's' || s_suppkey AS site, 'l' || s_suppkey || '_' || i AS line, {start} AS time_start_dayshift,
  CASE WHEN i > 2 THEN NULL WHEN s_suppkey % 2 = 0 THEN 99.0::DOUBLE WHEN s_acctbal > 0 THEN 20.0::DOUBLE END AS heat_threshold,
  CASE WHEN i <= 2 THEN 'v-x-' || s_suppkey || CASE WHEN s_acctbal > 0 THEN '/ch_opcua' ELSE '/raw' END END AS bucket,
  (i - 1)::INTEGER AS ordinal FROM s WHERE {which}"""
ORACLE["site_inherit_named"] = f"""
WITH s AS (SELECT *, unnest(generate_series(1, s_suppkey % 4)) AS i FROM supplier WHERE s_suppkey <> 0)
{" UNION ALL ".join(_NAMED.format(asked=f"s{n}", start="NULL::VARCHAR", which=f"s_suppkey = {n}") for n in (2, 3))}
UNION ALL SELECT 's4', 's4', 's4', NULL, NULL, NULL, 0 FROM supplier WHERE s_suppkey = 4
UNION ALL {_NAMED.format(asked="nowhere", start="CASE WHEN s_acctbal > 0 THEN '06:00:00' ELSE '07:00:00' END", which="true")}"""


def _by_place(key: str, values: list[str]) -> str:
    return f"CASE {key} % {len(values)} " + " ".join(f"WHEN {i} THEN {v}" for i, v in enumerate(values)) + " END"


ORACLE["lookback_texts"] = f"""
SELECT o_orderkey, {_by_place('o_orderkey', [text(t) for t in LOOKBACKS])} AS lookback,
  o_orderdate::TIMESTAMP + to_minutes(o_custkey % 1440)
    - to_seconds({_by_place('o_orderkey', ['NULL' if v is None else str(v) for v in LOOKBACKS.values()])}) AS cutoff FROM orders"""
ORACLE["shift_letters"] = f"""
WITH o AS (SELECT o_orderkey, o_orderdate::TIMESTAMP AS day, (o_custkey * 7) % 1440 AS minute,
  {_by_place('o_orderkey', ['NULL' if v is None else str(v) for v in CLOCKS.values()])} AS start FROM orders),
d AS (SELECT *, start % 720 AS half, CASE WHEN minute < start % 720 THEN start % 720 - 720
  WHEN minute < start % 720 + 720 THEN start % 720 ELSE start % 720 + 720 END AS begins FROM o)
SELECT o_orderkey, day + to_minutes(begins::BIGINT) AS shift_start,
  CASE WHEN start IS NULL THEN NULL WHEN (begins + 1440) % 1440 = start THEN 'D' ELSE 'N' END AS letter FROM d"""
ORACLE["select_lines"] = f"""{with_(CONFIG)}
SELECT g.site, g.line_id, count(*) AS points FROM cfg g JOIN (SELECT user_id % 5 + 1 AS n FROM events) e ON e.n::VARCHAR = g.line_no
WHERE g.site = 'alpha' AND g.line_no IN ('1', '2') GROUP BY ALL"""
ORACLE["line_ids"] = """
SELECT c_custkey, 's' || c_nationkey || '-l' || c_custkey AS line_id, 'l' || c_custkey AS line_part,
  CASE WHEN c_acctbal > 0 THEN lower(c_mktsegment) END AS measurement,
  's' || c_nationkey AS table_site, c_custkey::VARCHAR AS line_no, 'Line ' || c_custkey AS line_label FROM customer"""

_LEVEL = "(('0x' || substr(md5({key}), 1, 12))::BIGINT + 0.5::DOUBLE) / 281474976710656::DOUBLE"


def _uniform(*keys: str) -> str:
    return _LEVEL.format(key=" || '|' || ".join(keys))


def _base(name: str) -> str:
    return _uniform(f"'{name}'", "'0'", "line_id", "control")


ORACLE["synthetic_telemetry"] = f"""{with_(_SUPPLIER)},
d AS (SELECT site, line_id, control, contains(lower(control), 'heat') AS heat, {_base('level')} AS level,
  {_base('steps')} < 0.3 AS steps, floor(480 + {_base('step')} * 480) AS step_at FROM sctl),
p AS (SELECT *, unnest(generate_series(0, 1440)) AS i FROM d),
z AS (SELECT *, sqrt(-2 * ln({_uniform("'r'", "'noise'", "'0'", "line_id", "control", "i")}))
  * cos(2 * pi() * {_uniform("'a'", "'noise'", "'0'", "line_id", "control", "i")}) AS noise FROM p),
m AS (SELECT site, line_id, control AS _field, i, TIMESTAMP '2024-01-30 06:02:00' + to_minutes(i) AS _time,
  CASE WHEN heat THEN 330 + floor(level * 40) + 2 * noise + CASE WHEN i >= 720 THEN (i - 720) * 15.0::DOUBLE / 720 ELSE 0 END
    ELSE 90 + floor(level * 20) + 0.5 * noise + CASE WHEN steps AND i >= step_at THEN 5 ELSE 0 END END AS _value FROM z)
SELECT site, line_id, _field, count(*) AS n, min(_time) AS begins, max(_time) AS ends,
  {r6('min(_value)', 'low')}, {r6('max(_value)', 'high')},
  {r6('avg(_value) FILTER (WHERE i < 720)', 'first_half')}, {r6('avg(_value) FILTER (WHERE i >= 720)', 'second_half')}
FROM m GROUP BY site, line_id, _field"""

# Quality

# The replacement rules, in order
_SPACE = r"[\t-\r \x1c-\x1f\x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]+"
_RULES = [
    (r"[-,?+%]", ""), ("[#]", "No"), (r"\(.*?\)", ""), (_SPACE, "_"),
    (r"[./]", "_"), ("_+", "_"), ("_+$", ""), ("^:", ""),
]


def sanitize(expression: str) -> str:
    for pattern, new in _RULES:
        expression = f"regexp_replace({expression}, '{pattern}', '{new}', 'g')"
    return expression


_NUMERIC = r"^\s*[+-]?((\d+\.?\d*|\.\d+)([eE][+-]?\d+)?|(?i:inf))\s*$"


def coerce(expression: str) -> str:
    return f"CASE WHEN regexp_matches({expression}, '{_NUMERIC}') THEN TRY_CAST(trim({expression}) AS DOUBLE) END"


QUALITY = f"""
qual AS (SELECT CASE WHEN l_suppkey % 5 + 1 <= 3 THEN 'alpha' ELSE 'beta' END AS site, (l_suppkey % 5 + 1)::VARCHAR AS line_no,
  TIMESTAMP '2024-01-01 07:30:00' + to_minutes(((l_orderkey % 60) * 720 + l_linenumber)::BIGINT) AS datetime,
  l_returnflag || ' #' || l_linestatus || ' (' || p_brand || ')/x%' AS test,
  CASE WHEN l_linenumber = 7 THEN 'n/a' WHEN l_quantity = 13 THEN '1d' WHEN l_quantity = 50 THEN NULL
    ELSE l_extendedprice::VARCHAR END AS val, p_type AS part_item
  FROM lineitem JOIN part ON l_partkey = p_partkey),
names AS (SELECT test, {sanitize('test')} AS test_cleaned FROM (SELECT DISTINCT test FROM qual)),
spec AS (SELECT * FROM (VALUES {', '.join(f"({text(t)}, {number(lo)}, {number(hi)})" for t, lo, hi in SPEC_ROWS)}) v(test_cleaned, lsl, usl))"""


def measured(zone: str | None = None) -> str:
    local = "datetime" if zone is None else f"(datetime AT TIME ZONE 'UTC') AT TIME ZONE '{zone}'"
    return f"""
local AS (SELECT q.site, g.line_id, q.datetime, {local} AS local_time, q.part_item, n.test_cleaned, {coerce('q.val')} AS val
  FROM qual q JOIN cfg g ON q.site = g.site AND q.line_no = g.line_no JOIN names n USING (test)),
meas AS (SELECT l.*, s.shift_start FROM local l JOIN cal s ON l.line_id = s.line_id
  AND l.local_time BETWEEN s.shift_start AND s.shift_start + INTERVAL 12 hours)"""


PART = """
parts AS (SELECT site, line_id, shift_start, part_item FROM (
  SELECT *, row_number() OVER (PARTITION BY site, line_id, shift_start ORDER BY n DESC, part_item) AS place
  FROM (SELECT site, line_id, shift_start, part_item, count(*) AS n FROM meas WHERE part_item IS NOT NULL GROUP BY ALL))
  WHERE place = 1)"""

# The normal mass by Simpson's rule, as the two-sided fraction is defined.
_SIMPSON = """list_sum([
    (CASE WHEN i = 0 OR i = 400 THEN 1 WHEN i % 2 = 1 THEN 4 ELSE 2 END)
    * exp(-power(-cut + 2 * cut * i / 400, 2) / 2) for i in generate_series(0, 400)]) * (2 * cut / 400) / 3 / sqrt(2 * pi())"""


def fractions(default_only: bool = False) -> str:
    """Good fractions from the sorted values of each group."""
    limits = ("0.0::DOUBLE AS lsl, 100.0::DOUBLE AS usl" if default_only else
              "CASE WHEN s.test_cleaned IS NULL THEN 0.0 ELSE s.lsl END AS lsl, CASE WHEN s.test_cleaned IS NULL THEN 100.0 ELSE s.usl END AS usl")
    return f"""
grp AS (SELECT site, line_id, shift_start, part_item, test_cleaned, count(val) AS n, avg(val) AS mean, stddev_samp(val) AS sd,
  min(val) AS low, max(val) AS high, list_sort(coalesce(list(val) FILTER (WHERE val IS NOT NULL), [])) AS xs
  FROM meas JOIN parts USING (site, line_id, shift_start, part_item) GROUP BY ALL),
lim AS (SELECT g.*, {limits} FROM grp g LEFT JOIN spec s USING (test_cleaned)),
cuts AS (SELECT *, len([x for x in xs if x <= lsl]) AS n_le,
  CASE WHEN low = high OR n < 2 THEN NULL ELSE greatest(least(
    CASE WHEN lsl IS NULL THEN usl - mean ELSE least(usl - mean, mean - lsl) END / sd, 9), -9) END AS cut FROM lim),
frac AS (SELECT *, CASE
  WHEN n <= 1 THEN NULL
  WHEN usl IS NULL THEN CASE WHEN lsl IS NULL THEN NULL WHEN low > lsl THEN 1 WHEN high < lsl THEN 0
    ELSE 1 - (n_le - 1 + CASE WHEN n_le = n THEN 0 ELSE (lsl - xs[n_le]) / (xs[n_le + 1] - xs[n_le]) END) / (n - 1) END
  WHEN low = high THEN CASE WHEN mean BETWEEN lsl AND usl THEN 1 ELSE 0 END
  ELSE {_SIMPSON} END AS good_fraction FROM cuts)"""


_MEAS = (CONFIG, CALENDAR, QUALITY, measured())
_FRACTION = f"site, line_id, shift_start, part_item, test_cleaned, n, lsl, usl, {r6('good_fraction::DOUBLE', 'good_fraction')}"

ORACLE["sanitize_tests"] = f"""{with_(QUALITY)}
SELECT test, test_cleaned, count(*) AS n FROM qual JOIN names USING (test) GROUP BY ALL"""
ORACLE["sanitize_documents"] = f"""
WITH c AS (SELECT doc_id, {sanitize('text')} AS cleaned FROM documents)
SELECT doc_id, length(cleaned)::INTEGER AS n_chars, md5(cleaned) AS digest FROM c"""
_SPELLINGS = [  # text and what it means, each written out
    ("p", "price"), ("' ' || p || ' '", "price"), ("p || 'e1'", "price * 10"), ("'+' || p", "price"), ("p || 'd'", "NULL"),
    ("replace(p, '.', '_')", "NULL"), ("'n/a'", "NULL"), ("'Infinity'", "'Infinity'::DOUBLE"), ("'-inf'", "'-Infinity'::DOUBLE"),
    ("p || 'e400'", "NULL"), ("'-' || p || 'E-2'", "(('-' || p || 'E-2')::DOUBLE)"), ("'0x1F'", "NULL")]
_CASES = [" ".join(f"WHEN {i} THEN {pair[side]}" for i, pair in enumerate(_SPELLINGS)) for side in (0, 1)]
ORACLE["numeric_coerce"] = f"""
WITH v AS (SELECT l_orderkey, l_linenumber, l_partkey, l_extendedprice::VARCHAR AS p, l_extendedprice::DOUBLE AS price,
  (l_orderkey + l_linenumber * 5) % {len(_SPELLINGS)} AS place FROM lineitem)
SELECT l_orderkey, l_linenumber, l_partkey, CASE place {_CASES[0]} END AS val,
  (CASE place {_CASES[1].replace("price * 10", "((p || 'e1')::DOUBLE)")} END)::DOUBLE AS number FROM v"""
ORACLE["quality_scan_utc"] = f"""{with_(QUALITY)}
SELECT site, line_no, datetime, (datetime AT TIME ZONE 'UTC') AT TIME ZONE 'America/Chicago' AS local_time, test, val, part_item,
  count(*) AS n FROM qual
WHERE datetime BETWEEN (TIMESTAMP '2024-01-09 07:00:00' AT TIME ZONE 'America/Chicago') AT TIME ZONE 'UTC'
  AND (TIMESTAMP '2024-01-09 19:00:00' AT TIME ZONE 'America/Chicago') AT TIME ZONE 'UTC' GROUP BY ALL"""
ORACLE["current_part"] = f"{with_(*_MEAS, PART)} SELECT site, line_id, shift_start, part_item FROM parts"
ORACLE["distinct_tests"] = f"{with_(*_MEAS)} SELECT DISTINCT site, line_id, shift_start, test_cleaned FROM meas"
ORACLE["quality_latest_local"] = f"""{with_(CONFIG, CALENDAR, QUALITY, measured('America/Chicago'))}
SELECT site, line_id, shift_start, max(datetime) AS latest, max(local_time) AS latest_local FROM meas GROUP BY ALL"""


def _fraction_query(where: str, column: str = _FRACTION, default_only: bool = False) -> str:
    return f"{with_(*_MEAS, PART, fractions(default_only))} SELECT {column} FROM frac WHERE {where}"


ORACLE["good_fraction"] = _fraction_query("good_fraction IS NOT NULL")
ORACLE["good_fraction_two_sided"] = _fraction_query("lsl IS NOT NULL AND usl > 100")
ORACLE["good_fraction_lower_only"] = _fraction_query("usl IS NULL")
ORACLE["good_fraction_upper_only"] = _fraction_query("lsl IS NULL")
ORACLE["good_fraction_default_spec"] = _fraction_query("good_fraction IS NOT NULL", default_only=True)
ORACLE["good_fraction_clamped"] = _fraction_query(
    "good_fraction IS NOT NULL", _FRACTION.replace("good_fraction::DOUBLE", "greatest(good_fraction::DOUBLE, 0.0)"))

# Alerts

ALERTS = f"""
alr AS (SELECT o_orderkey, CASE WHEN o_custkey % 5 + 1 <= 3 THEN 'alpha' ELSE 'beta' END AS site,
  'Line ' || (o_custkey % 5 + 1) AS line_label, (o_custkey % 20)::VARCHAR AS part,
  upper(c_mktsegment[1]) || lower(c_mktsegment[2:]) AS trigger, c_name AS changed_by,
  o_orderdate + INTERVAL 8217 days + to_seconds((o_orderkey % 86400)::BIGINT) AS raw_at,
  o_orderstatus <> 'F' AS disabled, o_orderstatus <> 'P' AS ends FROM orders JOIN customer ON o_custkey = c_custkey),
ala AS (SELECT *, {minute('raw_at')} AS changed_at,
  CASE WHEN ends THEN {minute("(raw_at + INTERVAL 7 days)")} END AS disable_until FROM alr)"""
_ALERT_COLUMNS = "line_label, part, trigger, changed_by, changed_at, disabled, disable_until"

ORACLE["alert_view"] = f"""{with_(CONFIG, ALERTS)}
SELECT a.site, g.line_id, TIMESTAMP '2024-01-31 06:02:00' AS run_at, {_ALERT_COLUMNS}
FROM ala a JOIN cfg g ON a.site = g.site AND a.line_label = 'Line ' || g.line_no
WHERE a.changed_at > TIMESTAMP '2024-01-31 06:02:00' - g.lookback_span"""


def _chicago(column: str) -> str:
    return f"({column} AT TIME ZONE 'UTC') AT TIME ZONE 'America/Chicago'"


ORACLE["alert_local_times"] = f"""{with_(ALERTS)},
z AS (SELECT * REPLACE ({_chicago('changed_at')} AS changed_at, {_chicago('disable_until')} AS disable_until) FROM ala)
SELECT line_label AS "Line", part AS "Part", trigger AS "Trigger", changed_by AS "Changed by", changed_at AS "Changed at",
  disabled AS "Disabled", disable_until AS "Disable until" FROM z"""
ORACLE["alert_json"] = f"""{with_(ALERTS)},
j AS (SELECT o.o_orderkey, json_object('resource', 'line' || (o_custkey % 5 + 1), 'trigger', c_mktsegment || '_alert_good_fraction',
  'part_number', (o_custkey % 20)::VARCHAR) AS doc FROM orders o JOIN customer ON o_custkey = c_custkey)
SELECT o_orderkey, replace(json_extract_string(doc, '$.resource'), 'line', 'Line ') AS line_label,
  upper(json_extract_string(doc, '$.trigger')[1])
    || lower(replace(json_extract_string(doc, '$.trigger'), '_alert_good_fraction', '')[2:]) AS trigger,
  json_extract_string(doc, '$.part_number') AS part FROM j"""
ORACLE["event_json"] = "SELECT event_id, json_extract_string(props, '$.k')::INTEGER AS k FROM events"

# Reports

RUNS = """
runs AS (SELECT g.*, r.run_at, date_trunc('day', r.run_at)::TIMESTAMP + g.start_after
    - CASE WHEN hour(r.run_at) < 12 THEN INTERVAL 12 hours ELSE INTERVAL 0 hours END AS shift_start,
    CASE WHEN hour(r.run_at) < 12 THEN 'N' ELSE 'D' END AS letter
  FROM cfg g, (SELECT unnest(generate_series(TIMESTAMP '2024-01-01 06:02:00', TIMESTAMP '2024-01-31 06:02:00', INTERVAL 12 hours)) AS run_at) r),
rep AS (SELECT *, shift_start + INTERVAL 12 hours AS shift_end, strftime(shift_start, '%Y_%m_%d ') || letter AS shift_label FROM runs)"""


def _escape(expression: str) -> str:
    return f"replace(replace(replace({expression}, '&', '&amp;'), '<', '&lt;'), '>', '&gt;')"


def _cell(expression: str) -> str:
    return f"'<td>' || {expression} || '</td>'"


def _style(value: str) -> str:
    border = "border: 2px solid #000066;"
    return (f"CASE WHEN {value} > 0 THEN ' style=\"background-color:#e62525aa; {border}\"' "
            f"WHEN {value} < 0 THEN ' style=\"background-color:#199bd6aa; {border}\"' ELSE '' END")


def _head(names: list[str]) -> str:
    return "'<table><tr>" + "".join(f"<th>{n}</th>" for n in names) + "</tr>'"


def _two(column: str) -> str:
    return f"CASE WHEN {column} IS NULL THEN 'nan' ELSE printf('%.2f', {column}) END"


def _whole(column: str) -> str:
    return f"trunc({column})::BIGINT::VARCHAR"


_CHANGE_HEAD = _head(["Control", "Shift start", "Shift end", "Shift end-start", "Shift max-min"])
_ALERT_HEAD = _head(["Line", "Part", "Trigger", "Changed by", "Changed at", "Disabled", "Disable until"])
_NL2 = "chr(10) || chr(10)"

MACHINE = f"""
htm AS (SELECT *, kind = 'heat' AND (delta > threshold OR delta < -threshold) AS beyond,
  '<tr>' || {_cell(_escape('control'))} || CASE WHEN kind = 'heat' THEN {_cell(_whole('start_value'))} || {_cell(_whole('end_value'))}
      || '<td' || {_style('trunc(delta)')} || '>' || {_whole('delta')} || '</td>' || {_cell(_whole('spread'))}
    ELSE {_cell(_two('start_value'))} || {_cell(_two('end_value'))}
      || '<td' || {_style('delta')} || '>' || {_two('delta')} || '</td>' || {_cell(_two('spread'))} END || '</tr>' AS piece FROM chg),
sec AS (SELECT site, line_id, shift_start,
  coalesce(string_agg(piece, '' ORDER BY spread DESC, control_ordinal) FILTER (WHERE kind = 'nonheat'), '') AS nonheat_rows,
  coalesce(string_agg(piece, '' ORDER BY spread DESC, control_ordinal) FILTER (WHERE beyond), '') AS heat_rows,
  {_FLAG} AS changed FROM htm GROUP BY site, line_id, shift_start),
cov AS (SELECT site, line_id, shift_start, min(seen) AS earliest, max(seen) AS latest FROM rows_in GROUP BY ALL),
mac AS (SELECT r.*, s.changed,
  CASE WHEN coalesce(s.changed, false) THEN '<h1 style="background-color:#80bfb7aa;">' ELSE '<h1>' END || r.line_id || '</h1>' || {_NL2}
  || '<h2>Shift : ' || r.shift_label || '</h2>' || {_NL2}
  || CASE WHEN c.earliest IS NULL THEN 'No machine data available between ' || r.shift_start::VARCHAR || ' and '
      || r.shift_end::VARCHAR || ' for ' || r.line_id || chr(10)
    ELSE '<b>Earliest timepoint</b>: ' || c.earliest::VARCHAR || {_NL2} || '<b>Latest timepoint</b>: ' || c.latest::VARCHAR || {_NL2}
      || '<h2>Non heats</h2> ' || {_NL2} || ' ' || {_CHANGE_HEAD} || s.nonheat_rows || '</table> ' || {_NL2}
      || '<h2>Heats</h2> ' || {_NL2} || ' ' || CASE WHEN s.heat_rows <> '' THEN {_CHANGE_HEAD} || s.heat_rows || '</table>'
        ELSE 'No heat exceeded ' || r.threshold::VARCHAR || ' degrees.' END || chr(10) END AS machine
  FROM rep r LEFT JOIN sec s ON r.line_id = s.line_id AND r.shift_start = s.shift_start
  LEFT JOIN cov c ON r.line_id = c.line_id AND r.shift_start = c.shift_start)"""

QUALITY_HTML = f"""
qtab AS (SELECT site, line_id, shift_start, any_value(part_item) AS part_item,
  string_agg('<tr>' || {_cell(_escape('test_cleaned'))} || {_cell("printf('%.6f', good_fraction::DOUBLE)")} || '</tr>', ''
    ORDER BY round(good_fraction, 6), test_cleaned) AS fraction_rows FROM frac WHERE good_fraction IS NOT NULL GROUP BY ALL),
qlast AS (SELECT site, line_id, shift_start, max(local_time) AS latest_local FROM meas GROUP BY ALL),
qsec AS (SELECT m.line_id, m.run_at, CASE WHEN l.latest_local IS NULL THEN '<h2>Quality Report</h2>' || chr(10)
    || '<p>No quality data found between ' || m.shift_start::VARCHAR || ' and ' || m.shift_end::VARCHAR || ' for ' || m.line_id || '.</p>' || chr(10)
  ELSE '<h2>Quality Report</h2>' || {_NL2} || CASE WHEN t.fraction_rows IS NULL
    THEN '<p>No quality measurements found with specifications.</p>' || {_NL2}
    ELSE '<p>Latest data is until ' || l.latest_local::VARCHAR || '.</p>' || {_NL2} || '<b>Current part number</b>: '
      || {_escape('t.part_item')} || {_NL2} || {_head(['Measurement', 'Good Fraction'])} || t.fraction_rows || '</table>' || {_NL2} END END AS quality
  FROM rep m LEFT JOIN qlast l ON m.line_id = l.line_id AND m.shift_start = l.shift_start
  LEFT JOIN qtab t ON m.line_id = t.line_id AND m.shift_start = t.shift_start)"""

ALERT_HTML = f"""
acell AS (SELECT *, '<tr>' || {' || '.join(
    _cell(f"coalesce({_escape(f'{c}::VARCHAR')}, 'None')") for c in _ALERT_COLUMNS.split(', '))} || '</tr>' AS piece FROM ala),
arow AS (SELECT r.line_id, r.run_at, string_agg(a.piece, '' ORDER BY a.changed_at, a.piece) AS alert_rows
  FROM rep r JOIN acell a ON a.site = r.site AND a.line_label = 'Line ' || r.line_no
   AND a.changed_at > r.run_at - r.lookback_span AND a.changed_at <= r.run_at GROUP BY r.line_id, r.run_at),
asec AS (SELECT r.line_id, r.run_at, CASE WHEN r.site NOT IN (SELECT site FROM ala)
    THEN '<h2>Alert Report</h2>' || chr(10) || '<p>No alert history available.</p>' || {_NL2}
  ELSE '<h2>Alert Report</h2>' || {_NL2} || CASE WHEN a.alert_rows IS NULL
    THEN '<p>No disabled alerts in the last ' || r.lookback || '.</p>' || {_NL2}
    ELSE '<p>Disabled alerts in the last ' || r.lookback || '.</p>' || {_NL2} || {_ALERT_HEAD} || a.alert_rows || '</table>' END END AS alerts
  FROM rep r LEFT JOIN arow a ON a.line_id = r.line_id AND a.run_at = r.run_at)"""


def _reports(document: str, joins: str) -> str:
    return f"""
lrep AS (SELECT m.site, m.line, m.line_id, m.run_at, m.ordinal, m.recipients, m.shift_label, m.letter,
  CASE WHEN m.measurement IS NOT NULL THEN m.line_id || ' process report : ' || m.shift_label END AS subject,
  CASE WHEN m.measurement IS NOT NULL THEN 'success' ELSE 'failed' END AS status,
  CASE WHEN m.measurement IS NULL THEN 'bucket names no measurement' END AS error,
  CASE WHEN m.measurement IS NOT NULL THEN coalesce(m.changed, false) END AS changed,
  CASE WHEN m.measurement IS NOT NULL THEN {document} || {_NL2} || '{'-' * 40}<br>' || {_NL2} END AS html
  FROM mac m {joins}),
srep AS (SELECT site, run_at, arg_min(shift_label, ordinal) FILTER (WHERE status = 'success') AS first_label,
  arg_max(shift_label, ordinal) FILTER (WHERE status = 'success') AS last_label,
  string_agg(html, '' ORDER BY ordinal) AS full_html,
  array_to_string(list_sort(list_distinct(flatten(list(recipients)))), ',') AS recipients
  FROM lrep GROUP BY site, run_at HAVING string_agg(html, '') IS NOT NULL)"""


_MACHINE_PARTS = (CONFIG, TELEMETRY, DEDUP, CALENDAR, closed_rows("kept", "minute_level"), OBSERVED, CHANGES, RUNS, MACHINE)
_FULL = with_(*_MACHINE_PARTS, QUALITY, measured(), PART, fractions(), QUALITY_HTML, ALERTS, ALERT_HTML,
              _reports("machine || q.quality || a.alerts",
                       "JOIN qsec q ON q.line_id = m.line_id AND q.run_at = m.run_at JOIN asec a ON a.line_id = m.line_id AND a.run_at = m.run_at"))
_SHORT = with_(*_MACHINE_PARTS, _reports("machine", ""))
_LINE_COLUMNS = "site, line_id, run_at, shift_label, subject, status, error, changed, md5(html) AS digest, length(html)::INTEGER AS n_chars"
_PATH = "site || '/' || strftime(run_at, '%Y-%m-%d') || '/process_change_' || {label}[-1] || '.html'"

ORACLE["line_report_html"] = f"{_FULL} SELECT {_LINE_COLUMNS} FROM lrep"
ORACLE["machine_report_html"] = f"{_SHORT} SELECT {_LINE_COLUMNS} FROM lrep"
ORACLE["site_report"] = f"""{_FULL}
SELECT site, run_at, first_label AS shift_label, first_label[-1] AS shift_letter,
  upper(site) || ' process report: ' || first_label AS subject, recipients, {_PATH.format(label='first_label')} AS path,
  md5(full_html) AS digest, length(full_html)::INTEGER AS n_chars FROM srep"""
ORACLE["blob_paths"] = f"""{_FULL}
SELECT site, run_at, last_label AS shift_label, last_label[-1] AS shift_letter, {_PATH.format(label='last_label')} AS path FROM srep"""
ORACLE["report_history"] = f"""{_FULL}
SELECT l.site, l.line, l.shift_label AS shift, {_PATH.format(label='s.first_label').replace('site ||', 'l.site ||').replace('(run_at', '(l.run_at')} AS blob_path,
  l.status, 'backfill-1' AS run_id, l.run_at AS generated_at
FROM lrep l JOIN srep s ON l.site = s.site AND l.run_at = s.run_at WHERE l.status = 'success'"""
ORACLE["document_parts"] = f"""{_FULL}
SELECT l.site, l.run_at, l.run_at::DATE AS report_date, s.last_label[-1] AS shift_letter, l.ordinal::INTEGER AS ordinal, l.line_id,
  md5(l.html) AS digest, length(l.html)::INTEGER AS n_chars
FROM lrep l JOIN srep s ON l.site = s.site AND l.run_at = s.run_at WHERE l.status = 'success'"""
ORACLE["outbox"] = f"""{_FULL}
SELECT site, run_at, recipients, upper(site) || ' process report: ' || first_label AS subject,
  md5(full_html) AS digest, length(full_html)::INTEGER AS n_chars FROM srep"""
ORACLE["run_counts"] = f"""{_FULL}
SELECT site, count(*) AS reports, count(*) FILTER (WHERE status = 'success') AS succeeded,
  count(*) FILTER (WHERE status = 'failed') AS failed FROM lrep GROUP BY site"""

# Readings above 300 are stored a second time, one higher
_REPEATED = TELEMETRY.replace("FROM events)", "FROM (SELECT * FROM events {where} UNION ALL SELECT * REPLACE (value + 1 AS value) FROM events {both}))")
ORACLE["failed_lines"] = f"""{_FULL},
twice AS (SELECT DISTINCT line_id, {minute('_time')} AS minute_level FROM req WHERE _value > 300),
bad AS (SELECT DISTINCT t.line_id, s.shift_start FROM twice t JOIN cal s
  ON t.line_id = s.line_id AND t.minute_level BETWEEN s.shift_start AND s.shift_start + INTERVAL 12 hours)
SELECT m.site, m.line_id, m.run_at, CASE WHEN m.measurement IS NULL THEN 'bucket names no measurement'
  ELSE 'more than one reading for one time and control' END AS error
FROM mac m LEFT JOIN bad b ON m.line_id = b.line_id AND m.shift_start = b.shift_start
WHERE m.measurement IS NULL OR b.line_id IS NOT NULL"""
_ONE_RUN = (CONFIG, _REPEATED.format(where=f"WHERE {_FETCH}", both=f"WHERE value > 300 AND {_FETCH}"),
            DEDUP, CALENDAR, closed_rows("kept", "minute_level"), OBSERVED, CHANGES,
            RUNS.replace("TIMESTAMP '2024-01-01 06:02:00'", "TIMESTAMP '2024-01-16 06:02:00'").replace(
                "TIMESTAMP '2024-01-31 06:02:00'", "TIMESTAMP '2024-01-16 06:02:00'"), MACHINE)
# A line without any reading in the fetch says so
_NO_FETCH = " || chr(10)\n    ELSE '<b>Earliest"
assert MACHINE.count(_NO_FETCH) == 1
_FETCHED_MACHINE = MACHINE.replace(_NO_FETCH, " || chr(10) || CASE WHEN r.line_id NOT IN (SELECT line_id FROM req) "
                                   "THEN '<br>Error: No data found' || chr(10) ELSE '' END\n    ELSE '<b>Earliest")
_ONE_RUN = (*_ONE_RUN[:-1], _FETCHED_MACHINE)
ORACLE["failed_run"] = f"""{with_(*_ONE_RUN)},
bad AS (SELECT DISTINCT line_id FROM (SELECT line_id FROM req GROUP BY line_id, _time, _field HAVING count(*) > 1)),
o AS (SELECT m.*, CASE WHEN m.measurement IS NULL THEN 'bucket names no measurement'
  WHEN b.line_id IS NOT NULL THEN 'more than one reading for one time and control' END AS error,
  machine || {_NL2} || '{'-' * 40}<br>' || {_NL2} AS html FROM mac m LEFT JOIN bad b ON m.line_id = b.line_id)
SELECT site, line_id, run_at, shift_label, CASE WHEN error IS NULL THEN 'success' ELSE 'failed' END AS status, error,
  CASE WHEN error IS NULL THEN md5(html) END AS digest, CASE WHEN error IS NULL THEN length(html)::INTEGER END AS n_chars FROM o"""

_FETCHED = TELEMETRY.replace("FROM events)", f"FROM events WHERE {_FETCH})")
_RUN = with_(CONFIG, _FETCHED, *_ONE_RUN[2:], QUALITY, measured(), PART, fractions(), QUALITY_HTML, ALERTS,
             ALERT_HTML.replace(" AND a.changed_at <= r.run_at", ""),
             _reports("machine || q.quality || a.alerts",
                      "JOIN qsec q ON q.line_id = m.line_id AND q.run_at = m.run_at JOIN asec a ON a.line_id = m.line_id AND a.run_at = m.run_at"))
ORACLE["line_report_run"] = f"{_RUN} SELECT {_LINE_COLUMNS} FROM lrep"
ORACLE["failed_config"] = f"""{_RUN}
SELECT site, line_id, run_at, CASE WHEN line_id = 'alpha-l1' THEN 'success' ELSE 'failed' END AS status,
  CASE line_id WHEN 'alpha-l2' THEN 'day-shift start is no clock time' WHEN 'alpha-l3' THEN 'bucket names no measurement'
    WHEN 'beta-l4' THEN 'alert look-back is no period' WHEN 'beta-l5' THEN 'line configured more than once' END AS error,
  CASE WHEN line_id = 'alpha-l1' THEN changed END AS changed FROM lrep"""

ORACLE["stored_documents"] = f"""{_FULL}
SELECT s.site, s.run_at, {_PATH.format(label='s.first_label').replace('site ||', 's.site ||').replace('(run_at', '(s.run_at')} AS blob_path,
  count(*) AS n_lines, md5(s.full_html) AS digest, length(s.full_html)::INTEGER AS n_chars
FROM srep s JOIN lrep l ON l.site = s.site AND l.run_at = s.run_at WHERE l.status = 'success' GROUP BY ALL"""
ORACLE["telemetry_clustered"] = f"""{with_(CONFIG, TELEMETRY)}
SELECT event_id, '007' AS site, '007-l1' AS line_id, _time, _field, _value FROM tel
WHERE line_id = 'alpha-l1' AND _time >= TIMESTAMP '2024-01-15 06:02:00' AND _time < TIMESTAMP '2024-01-16 06:02:00'"""
_FILE_ERROR = "CASE WHEN part % 7 IN (3, 4) THEN 'not readable as declared' END"
ORACLE["failed_files"] = f"""{with_(ALERTS)},
files AS (SELECT 'lines' AS kind, s_nationkey::INTEGER AS part FROM supplier
  UNION ALL SELECT 'alerts', (month(raw_at) + 12 * year(raw_at))::INTEGER FROM alr)
SELECT kind, part, {_FILE_ERROR} AS error, CASE WHEN part % 7 IN (3, 4) THEN 0 ELSE count(*) END::BIGINT AS n_rows FROM files GROUP BY kind, part"""
ORACLE["merged_shift_changes"] = ORACLE["shift_changes_all"]
ORACLE["merged_good_fraction"] = ORACLE["good_fraction"]

# Streaming: the shifts that ended an hour before the latest reading

ORACLE["stream_shift_changes"] = f"""{with_(CONFIG, TELEMETRY)},
rows_in AS (SELECT site, line_id, time_bucket(INTERVAL 12 hours, _time, INTERVAL 7 hours) AS shift_start,
  _field, _value, _time, event_id, _time AS seen FROM tel),
{OBSERVED.strip()}
SELECT site, line_id, shift_start, shift_start + INTERVAL 12 hours AS shift_end, control, {r6('start_value')}, {r6('end_value')},
  {r6('end_value - start_value', 'delta')}, {r6('high - low', 'spread')}
FROM obs WHERE shift_start + INTERVAL 12 hours <= (SELECT max(_time) FROM tel) - INTERVAL 1 hour"""
ORACLE["stream_distinct"] = ORACLE["stream_shift_changes"]
ORACLE["stream_line_shifts"] = f"""{with_(CONFIG.replace(_config_rows(), _config_rows(STREAM_STARTS)), TELEMETRY, open_rows("req"), OBSERVED)}
SELECT site, line_id, shift_start, shift_start + INTERVAL 12 hours AS shift_end, control, {r6('start_value')}, {r6('end_value')},
  {r6('coalesce(end_value - start_value, 0)', 'delta')}, {r6('coalesce(high - low, 0)', 'spread')}
FROM obs WHERE shift_start + INTERVAL 12 hours <= (SELECT max(_time) FROM tel) - INTERVAL 1 hour"""
_STREAMED = CONFIG.replace(_config_rows(), _config_rows(STREAM_STARTS))
ORACLE["stream_process_changes"] = f"""
{with_(_STREAMED, TELEMETRY, DEDUP, CALENDAR, closed_rows("kept", "minute_level"), OBSERVED)}
SELECT site, line_id, shift_start, shift_start + INTERVAL 12 hours AS shift_end, control, {r6('start_value')}, {r6('end_value')},
  {r6('coalesce(end_value - start_value, 0)', 'delta')}, {r6('coalesce(high - low, 0)', 'spread')}
FROM obs WHERE shift_start + INTERVAL 12 hours + INTERVAL 90 seconds <= (SELECT max(_time) FROM tel) - INTERVAL 1 hour"""
