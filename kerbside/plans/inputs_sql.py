"""SQL of the inputs, as common table expressions over ``events``."""

from .inputs import (
    CALM_FROM, EARLY_TEXT, EMPTY, HALF, LARGE, LARGE_COUNT, LATE_TEXT, MORE_MEMBERS, MORE_TEXT, OTHER_DOCUMENT, OUTAGE_FROM, OUTAGE_TO,
    TOO_EARLY, TOO_LATE, TOO_LONG, TWO_VALUES,
)

_ID = "'dev-' || CASE WHEN length(CAST({n} AS VARCHAR)) > 5 THEN CAST({n} AS VARCHAR) ELSE lpad(CAST({n} AS VARCHAR), 5, '0') END"


def device_id(n: str) -> str:
    return f"({_ID.format(n=n)})"



def seconds(user: str = "user_id") -> str:
    return f"CASE WHEN {user} + 1 <= (SELECT max(user_id) + 1 FROM events) // 2 THEN 15 ELSE 60 END"


SECONDS = seconds()

DEVICES = f"""devices AS (
  SELECT DISTINCT {device_id("user_id + 1")} AS device_id, 'Sensor ' || CAST(user_id + 1 AS VARCHAR) AS name,
         CAST({SECONDS} AS INTEGER) AS interval_seconds
  FROM events)"""

READINGS = f"""readings AS (
  SELECT {device_id("user_id + 1")} AS device_id,
         CASE WHEN {SECONDS} = 15 THEN time_bucket(INTERVAL '15 seconds', ts) ELSE date_trunc('minute', ts) END AS interval_start,
         CAST(floor(value) AS INTEGER) AS vehicles, ts AS stored_at, ts AS accepted_at,
         event_id AS "offset", event_type, user_id
  FROM events)"""

STORED = f"""stored AS (
  SELECT device_id, interval_start, vehicles, stored_at FROM (
    SELECT *, row_number() OVER (PARTITION BY device_id, interval_start ORDER BY "offset") AS rn
    FROM readings WHERE stored_at < TIMESTAMP '{HALF}') WHERE rn = 1)"""

# Offset of the foreign message of an event.
FOREIGN_OFFSET = "event_id + 3 * (SELECT max(event_id) + 1 FROM events)"

K = "CAST(json_extract(props, '$.k') AS INTEGER)"


def message(vehicles: str = "vehicles", start: str = "strftime(interval_start, '%Y-%m-%dT%H:%M:%SZ')") -> str:
    """A reading as message text."""
    return f"""'{{"deviceId":"' || device_id || '","intervalStart":"' || {start} || '","vehicles":' || {vehicles}
       || ',"receivedAt":"' || strftime(accepted_at, '%Y-%m-%dT%H:%M:%S.%g') || 'Z"}}'"""


# The foreign message of each purchase, and whether it decodes.
FOREIGN = f"""foreign_messages AS (
  SELECT device_id, interval_start, vehicles, accepted_at, CAST((r.user_id + 1) % 6 AS INTEGER) AS partition, {FOREIGN_OFFSET} AS "offset",
         {K} = {LARGE_COUNT} AS is_large, {K} IN ({TOO_EARLY}, {TOO_LATE}) AS is_outside,
         CASE {K} WHEN {MORE_MEMBERS} THEN {message()} || ',"x":1' WHEN {OTHER_DOCUMENT} THEN '1,"doc":' || {message()}
                  WHEN {MORE_TEXT} THEN {message()} || ' x' WHEN {TWO_VALUES} THEN {message()} || ',' || {message()}
                  WHEN {LARGE_COUNT} THEN {message(f"'{LARGE}'")}
                  WHEN {TOO_EARLY} THEN {message(start=f"'{EARLY_TEXT}'")} WHEN {TOO_LATE} THEN {message(start=f"'{LATE_TEXT}'")} ELSE props END AS value
  FROM readings r JOIN events e ON e.event_id = r."offset" WHERE e.event_type = 'purchase')"""

BROKEN = f"""broken AS (
  SELECT device_id, CASE WHEN {K} IN (2, 3) THEN interval_start END AS interval_start,
         CASE {K} WHEN 2 THEN NULL WHEN 3 THEN CAST('{LARGE}' AS DOUBLE) ELSE vehicles END AS vehicles,
         "offset" + 4 * (SELECT max(event_id) + 1 FROM events) AS "offset",
         CASE WHEN {K} = 1 THEN 'no interval start' WHEN {K} > 3 THEN 'interval start out of range' ELSE 'vehicles out of range' END AS reason
  FROM readings r JOIN events e ON e.event_id = r."offset" WHERE e.event_type = 'view' AND {K} BETWEEN 1 AND 5)"""

# Reason of the second submission of an event.
BODY_REASON = f"""CASE {K} WHEN {EMPTY} THEN 'batch must contain 1-500 readings, got 0'
  WHEN {TOO_LONG} THEN 'batch must contain 1-500 readings, got 501' ELSE 'body must be a JSON array of readings' END"""

INCOMING = """incoming AS (
  SELECT device_id, interval_start, vehicles, accepted_at, "offset", CAST((user_id + 1) % 6 AS INTEGER) AS partition FROM readings
  UNION ALL
  SELECT device_id, interval_start, vehicles + 1, accepted_at, "offset" + (SELECT max(event_id) + 1 FROM events), CAST((user_id + 1) % 6 AS INTEGER)
  FROM readings WHERE event_type = 'signup'
  UNION ALL
  SELECT 'dev-unknown', interval_start, vehicles, accepted_at, "offset" + 2 * (SELECT max(event_id) + 1 FROM events), CAST((user_id + 1) % 6 AS INTEGER)
  FROM readings WHERE event_type = 'error')"""

KNOWN = """known AS (SELECT i.* FROM incoming i SEMI JOIN devices d USING (device_id))"""

# One row per incoming key: the winning copy, its copies, and what is stored.
PROBED = """probed AS (
  SELECT f.device_id, f.interval_start, f.vehicles, f.accepted_at, f."offset", f.copies, s.vehicles AS stored_vehicles
  FROM (SELECT *, row_number() OVER (PARTITION BY device_id, interval_start ORDER BY "offset") AS rn,
               count(*) OVER (PARTITION BY device_id, interval_start) AS copies
        FROM known) f
  LEFT JOIN stored s ON s.device_id = f.device_id AND s.interval_start = f.interval_start
  WHERE f.rn = 1)"""

DELAYED = """delayed AS (
  SELECT ts AS accepted_at, ts + to_milliseconds(CAST(floor(value * 1000) AS BIGINT)) AS stored_at FROM events)"""

REQUESTS = """requests AS (
  SELECT event_id, ts,
         CAST(CASE WHEN event_type IN ('click', 'view') THEN 200 WHEN event_type = 'purchase' THEN 400
                   WHEN event_type = 'signup' THEN 503 END AS INTEGER) AS status,
         CASE WHEN event_type = 'error' AND value >= 20 THEN 'timeout' WHEN event_type = 'error' THEN 'refused' END AS error,
         CAST(floor(value * 10) AS BIGINT) AS latency_ms,
         CAST(floor(value) + 1 AS BIGINT) AS n_readings, CAST(floor(value) + 1 AS BIGINT) AS queued
  FROM events)"""


def ranked(p: float) -> str:
    """Nearest-rank percentile over rows numbered ``rn`` of ``n``."""
    return f"rn = greatest(1, least(n, CAST(ceil(CAST({p / 100} AS DOUBLE) * n) AS BIGINT)))"


_DOWN = f"ts >= TIMESTAMP '{OUTAGE_FROM}' AND ts < TIMESTAMP '{OUTAGE_TO}'"
WINDOWS = f"""windows AS (
  SELECT run, start + INTERVAL 1 HOUR AS "end", reqs AS sent, reqs, s200, s400, s5xx, timeouts, CAST(0 AS BIGINT) AS neterr,
         slow + CASE WHEN start >= TIMESTAMP '{OUTAGE_FROM}' AND start < TIMESTAMP '{CALM_FROM}' THEN 100 ELSE 0 END AS buffered,
         p50, p95, p99, s5xx + timeouts AS errors
  FROM (
    SELECT run, start, count(*) AS reqs, count(*) FILTER (NOT down) AS s200,
           count(*) FILTER (NOT down AND value < 1) AS s400, count(*) FILTER (down AND value < 20) AS s5xx,
           count(*) FILTER (down AND value >= 20) AS timeouts, count(*) FILTER (value >= 20) AS slow,
           max(ms) FILTER ({ranked(50)}) AS p50, max(ms) FILTER ({ranked(95)}) AS p95, max(ms) FILTER ({ranked(99)}) AS p99
    FROM (
      SELECT *, row_number() OVER (PARTITION BY run, start ORDER BY ms) AS rn, count(*) OVER (PARTITION BY run, start) AS n
      FROM (SELECT event_type AS run, date_trunc('hour', ts) AS start, CAST(floor(value * 10) AS BIGINT) AS ms, value, {_DOWN} AS down
            FROM events))
    GROUP BY run, start))"""

LENGTHS = """lengths AS (
  SELECT run, greatest(1000, (gap * 2 + 1000) // 2000 * 1000) AS len_ms FROM (
    SELECT run, max(gap) FILTER (rn = n // 2 + 1) AS gap FROM (
      SELECT run, gap, row_number() OVER (PARTITION BY run ORDER BY gap) AS rn, count(*) OVER (PARTITION BY run) AS n
      FROM (SELECT run, epoch_ms("end") - epoch_ms(lag("end") OVER (PARTITION BY run ORDER BY "end")) AS gap FROM windows)
      WHERE gap IS NOT NULL) GROUP BY run))"""

# Windows snapped to the grid of their run.
PLACED = """placed AS (
  SELECT *, start_ms + len_ms AS until_ms, make_timestamp(start_ms * 1000) AS start, make_timestamp((start_ms + len_ms) * 1000) AS until
  FROM (SELECT w.*, len_ms, (epoch_ms("end") * 2 + len_ms) // (2 * len_ms) * len_ms - len_ms AS start_ms
        FROM windows w JOIN lengths l ON l.run = w.run))"""

# Windows next to the facts of their run.
NORMAL = """normal AS (
  SELECT run, CASE WHEN first_error IS NULL THEN med_buffered ELSE coalesce(early, 0) END AS normal, med_p99, last_error, first_error
  FROM (
    SELECT w.run, any_value(e.first_error) AS first_error, any_value(e.last_error) AS last_error,
           max(w.buffered) FILTER (w."end" < e.first_error) AS early,
           max(w.buffered) FILTER (w.rb = w.n // 2 + 1) AS med_buffered, max(w.p99) FILTER (w.rp = w.n // 2 + 1) AS med_p99
    FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY buffered) AS rb,
                 row_number() OVER (PARTITION BY run ORDER BY p99) AS rp, count(*) OVER (PARTITION BY run) AS n FROM windows) w
    JOIN (SELECT run, min("end") FILTER (errors > 0) AS first_error, max("end") FILTER (errors > 0) AS last_error
          FROM windows GROUP BY run) e ON e.run = w.run
    GROUP BY w.run))"""

SHOWN = """shown AS (
  SELECT *, interesting OR coalesce(lag(interesting) OVER o, false) OR coalesce(lead(interesting) OVER o, false) AS shown
  FROM (SELECT w.*, n.normal, w.errors > 0 OR w.buffered > n.normal OR w.p99 > 3 * n.med_p99 + 5 AS interesting
        FROM placed w JOIN normal n ON n.run = w.run)
  WINDOW o AS (PARTITION BY run ORDER BY "end"))"""


def with_(*ctes: str) -> str:
    return "WITH " + ",\n".join(ctes) + "\n"
