"""Registered queries over request windows and monitor samples, including the file formats."""

from functools import reduce

from pyspark.sql import functions as F

from ..functions.scalars import byte_size
from ..functions.times import iso_millis
from ..operators import incident as N
from ..operators import samples as S
from ..schema import SAMPLE_COLUMNS, WINDOW_COUNTERS
from ..session import work_path
from ..sources import host_stats as H
from ..sources import logs, sample_csv, snapshots
from . import inputs as X
from . import inputs_sql as Q
from .inputs import ntz
from .inputs_sql import with_

RUN = ["run"]
DAY = 86_400_000
RESTORED = "2024-01-10 09:00:00"
NOW = "2024-02-01 00:00:00"


def _at(spark, sf):
    return N.placed(X.windows(spark, sf), RUN)


def _as_time(df, *cols):
    """Epoch milliseconds as zone-free timestamps under the name without ``_ms``."""
    return reduce(lambda d, c: d.withColumn(c[:-3], ntz(F.timestamp_millis(F.col(c)))).drop(c), cols, df)


def request_windows(spark, sf):
    return X.windows(spark, sf)


def window_length(spark, sf):
    return N.window_length(X.windows(spark, sf), RUN)


def incident_totals(spark, sf):
    return N.totals(X.windows(spark, sf), RUN)


def error_span(spark, sf):
    return _as_time(N.error_span(_at(spark, sf), RUN), "first_ms", "last_ms", "first_end_ms", "last_end_ms")


def normal_backlog(spark, sf):
    return N.normal_backlog(_at(spark, sf), RUN)


def recovery(spark, sf):
    return _as_time(N.recovery(_at(spark, sf), RUN), "last_end_ms", "cleared_ms")


def post_restore(spark, sf):
    return _as_time(N.post_restore(_at(spark, sf), RUN, X.instant(RESTORED)), "cleared_ms")


def phase_profile(spark, sf):
    return N.phase_profile(_at(spark, sf), RUN, DAY, DAY)


def shown_windows(spark, sf):
    return N.shown_windows(_at(spark, sf), RUN).select("run", "end", "interesting", "shown")


def timeline_rows(spark, sf):
    rows = N.timeline(_at(spark, sf), RUN)
    return rows.withColumn("start", ntz("start")).withColumn("end", ntz("end"))


def zero_runs(spark, sf):
    rows = N.zero_runs(_at(spark, sf), RUN)
    return rows.withColumn("start", ntz("start")).withColumn("end", ntz("end"))


def longest_zero_run(spark, sf):
    return N.longest_zero_run(_at(spark, sf), RUN)


def _log_parse(spark, sf, encoding):
    """Windows and unrelated lines written as logs, one folder per run, then parsed back."""
    path = work_path(spark, "logs")
    lines = logs.format_windows(X.windows(spark, sf), 3600)
    noise = X.events(spark, sf).select(F.col("event_type").alias("run"), F.col("props").alias("value"))
    logs.write_log_lines(lines.unionByName(noise), path, encoding)
    parsed = logs.parse_windows(logs.read_log_lines(spark, path, encoding))
    return parsed.withColumn("end", ntz("end"))


def log_parse_detected(spark, sf):
    """Logs in two encodings, each told by its byte order mark, in one folder per run."""
    path = work_path(spark, "logs")
    lines = logs.format_windows(X.windows(spark, sf), 3600).withColumn("part", F.lit(1))
    noise = X.events(spark, sf).select(F.col("event_type").alias("run"), F.col("props").alias("value"), F.lit(2).alias("part"))
    marks = noise.select("run").distinct().select("run", F.lit("\ufeff").alias("value"), F.lit(0).alias("part"))
    every = marks.unionByName(lines).unionByName(noise)
    is_wide = F.length("run") % 2 == 0
    for encoding, of in (("UTF-16LE", is_wide), ("UTF-8", ~is_wide)):
        # One file per run, so that the mark is its start.
        one = every.filter(of).repartition("run").sortWithinPartitions("run", "part").select("run", "value")
        logs.write_log_lines(one, path, encoding)
    return logs.parse_windows(logs.detect_log_lines(spark, path)).withColumn("end", ntz("end"))


def latest_snapshot(spark, sf):
    """Every window written as a JSON snapshot of its source; the newest per source is reported."""
    path = work_path(spark, "snapshots")
    rows = X.windows(spark, sf).select(
        F.col("run").alias("source"),
        iso_millis("end").alias("writtenAt"),
        F.lit(10.0).alias("windowSeconds"),
        F.col("reqs").alias("deviceCount"),
        "buffered",
        F.col("reqs").alias("requests"),
        F.col("sent").alias("readingsSent"),
        F.col("s200").alias("queued"),
        F.col("s200").alias("status200"),
        F.col("s400").alias("status400"),
        F.col("s5xx").alias("status5xx"),
        "timeouts",
        F.col("neterr").alias("networkErrors"),
        "p50",
        "p95",
        "p99",
    )
    rows.write.json(path)
    return S.latest_snapshots(snapshots.read_snapshots(spark, path), NOW)


def _samples(spark, sf):
    """One sample per hour: its city-wide total, the request windows of all runs and the highest container load."""
    hour = F.window("ts", "1 hour").start
    base = X.events(spark, sf).withColumn("timestamp", hour + F.expr("INTERVAL '1' HOUR"))
    hourly = base.groupBy("timestamp").agg(F.count("*").alias("rows_approx"))
    every = X.windows(spark, sf).groupBy("end").agg(
        *[F.sum(c).alias(c) for c in ("reqs", "s400", "s5xx", "timeouts", "neterr", "buffered")],
        *[F.max(c).alias(c) for c in ("p50", "p95", "p99")],
    )
    window = every.select(
        F.col("end").alias("timestamp"),
        F.col("reqs").alias("sim_devices"),
        (F.col("reqs") * 15).alias("sim_age_s"),
        F.col("p50").alias("p50_ms"),
        F.col("p95").alias("p95_ms"),
        F.col("p99").alias("p99_ms"),
        F.col("s400").alias("status400"),
        F.col("s5xx").alias("status5xx"),
        "timeouts",
        "neterr",
        "buffered",
    )
    load = base.groupBy("timestamp").agg(F.max("value").alias("pg_cpu_pct"))
    return S.with_elapsed(S.assemble(hourly.select("timestamp"), [hourly, window, load]))


def sample_assembly(spark, sf):
    return _samples(spark, sf)


def sample_report(spark, sf):
    report = S.sample_report(_samples(spark, sf))
    return report.select("timestamp", "elapsed_whole_min", "sim_devices", "sim_age_s", "is_stale")


def csv_round_trip(spark, sf):
    """Samples appended to a CSV in two parts and read back as text cells."""
    path = work_path(spark, "samples")
    rows = _samples(spark, sf).withColumn("sim_devices", F.concat(F.lit('a,"'), F.col("sim_devices"), F.lit('"')))
    half = X.instant(X.HALF)
    for part in (rows.filter(F.col("timestamp") < half), rows.filter(F.col("timestamp") >= half)):
        sample_csv.append_samples(part.withColumn("timestamp", iso_millis("timestamp")), path)
    return sample_csv.read_samples(spark, path)


def _host_stats(spark, sf):
    path = work_path(spark, "stats")
    ms = F.floor(F.col("value") * 10).cast("string")
    X.events(spark, sf).select(
        iso_millis("ts").alias("time_utc"),
        F.floor("value").cast("int").alias("api_cpu_pct"),
        F.concat(ms, F.lit(".25%")).alias("pg_cpu"),
        F.concat(ms, F.when(F.col("event_type") == "view", "kB").otherwise("MiB"), F.lit(" / 1GiB")).alias("pg_mem"),
        F.concat(F.lit("ClientRead:"), ms, F.lit(" WALSync:2 ClientRead:1")).alias("pg_waits"),
    ).write.option("header", True).csv(path)
    return H.read_host_stats(spark, path)


def host_stats(spark, sf):
    return _host_stats(spark, sf).drop("pg_waits")


def host_waits(spark, sf):
    return H.wait_counts(_host_stats(spark, sf))


def byte_sizes(spark, sf):
    unit = F.when(F.col("event_type") == "view", "GiB").when(F.col("event_type") == "click", " kb").otherwise("?")
    return X.events(spark, sf).select(
        "event_id", byte_size(F.concat(F.floor("value").cast("string"), unit)).alias("bytes")
    )


def table_profile(spark, sf):
    """Sizes in bytes are not visible to SQL, so only whether there are any is kept."""
    profile = S.table_profile(spark, f"{sf}/events.parquet")
    return profile.select("rows_approx", (F.col("total_mib") >= 0).alias("has_size"), "index_mib")


QUERIES = {
    "request_windows": request_windows,
    "window_length": window_length,
    "incident_totals": incident_totals,
    "error_span": error_span,
    "normal_backlog": normal_backlog,
    "recovery": recovery,
    "post_restore": post_restore,
    "phase_profile": phase_profile,
    "shown_windows": shown_windows,
    "timeline_rows": timeline_rows,
    "zero_runs": zero_runs,
    "longest_zero_run": longest_zero_run,
    "log_parse": lambda spark, sf: _log_parse(spark, sf, "UTF-8"),
    "log_parse_utf16": lambda spark, sf: _log_parse(spark, sf, "UTF-16LE"),
    "log_parse_detected": log_parse_detected,
    "latest_snapshot": latest_snapshot,
    "sample_assembly": sample_assembly,
    "sample_report": sample_report,
    "csv_round_trip": csv_round_trip,
    "host_stats": host_stats,
    "host_waits": host_waits,
    "byte_sizes": byte_sizes,
    "table_profile": table_profile,
}

_COUNTERS = ", ".join(WINDOW_COUNTERS)
_CLEARED = """cleared AS (
  SELECT n.run, n.normal, n.last_error, min(w."end") FILTER (w."end" > n.last_error AND w.buffered <= n.normal) AS cleared
  FROM normal n JOIN windows w ON w.run = n.run GROUP BY 1, 2, 3)"""
_SAMPLES = """allruns AS (
  SELECT "end", sum(reqs)::BIGINT AS reqs, sum(s400)::BIGINT AS s400, sum(s5xx)::BIGINT AS s5xx, sum(timeouts)::BIGINT AS timeouts,
         sum(neterr)::BIGINT AS neterr, sum(buffered)::BIGINT AS buffered, max(p50) AS p50, max(p95) AS p95, max(p99) AS p99
  FROM windows GROUP BY 1),
samples AS (
  SELECT h."timestamp", rows_approx, sim_devices, sim_age_s, p50_ms, p95_ms, p99_ms, status400, status5xx, timeouts, neterr, buffered,
         pg_cpu_pct, CAST(epoch_ms(h."timestamp") - epoch_ms(min(h."timestamp") OVER ()) AS DOUBLE) / 60000 AS elapsed_min
  FROM (SELECT date_trunc('hour', ts) + INTERVAL 1 HOUR AS "timestamp", count(*) AS rows_approx FROM events GROUP BY 1) h
  LEFT JOIN (SELECT "end" AS "timestamp", reqs AS sim_devices, reqs * 15 AS sim_age_s, p50 AS p50_ms, p95 AS p95_ms, p99 AS p99_ms,
                    s400 AS status400, s5xx AS status5xx, timeouts, neterr, buffered FROM allruns) c
    ON c."timestamp" = h."timestamp"
  LEFT JOIN (SELECT date_trunc('hour', ts) + INTERVAL 1 HOUR AS "timestamp", max(value) AS pg_cpu_pct FROM events GROUP BY 1) l ON l."timestamp" = h."timestamp")"""
_CELLS = {
    "timestamp": """strftime("timestamp", '%Y-%m-%dT%H:%M:%S.%g') || 'Z'""",
    "sim_devices": """'a,"' || sim_devices || '"'""",
}
_FILLED = "rows_approx sim_age_s p50_ms p95_ms p99_ms status400 status5xx timeouts neterr buffered pg_cpu_pct elapsed_min".split()


def _cell(name: str) -> str:
    text = _CELLS.get(name) or (f"CAST({name} AS VARCHAR)" if name in _FILLED else "CAST(NULL AS VARCHAR)")
    return f'{text} AS "{name}"'


SQL = {
    "request_windows": with_(Q.WINDOWS) + f'SELECT run, "end", {_COUNTERS} FROM windows',
    "window_length": with_(Q.WINDOWS, Q.LENGTHS) + "SELECT run, len_ms FROM lengths",
    "incident_totals": with_(Q.WINDOWS)
    + """SELECT run, count(*) AS windows, CAST(sum(reqs) AS BIGINT) AS requests, CAST(sum(s5xx) AS BIGINT) AS s5xx,
       CAST(sum(timeouts) AS BIGINT) AS timeouts, CAST(sum(neterr) AS BIGINT) AS neterr, CAST(sum(s400) AS BIGINT) AS s400,
       max(buffered) AS max_buffered, max(p99) AS max_p99 FROM windows GROUP BY run""",
    "error_span": with_(Q.WINDOWS, Q.LENGTHS, Q.PLACED)
    + """SELECT run, min(start) FILTER (errors > 0) AS "first", max(until) FILTER (errors > 0) AS "last",
       min("end") FILTER (errors > 0) AS first_end, max("end") FILTER (errors > 0) AS last_end,
       count(*) FILTER (errors > 0) AS error_windows, count(*) AS windows,
       max(until_ms) FILTER (errors > 0) - min(start_ms) FILTER (errors > 0) AS duration_ms
FROM placed GROUP BY run""",
    "normal_backlog": with_(Q.WINDOWS, Q.NORMAL) + "SELECT run, normal FROM normal",
    "recovery": with_(Q.WINDOWS, Q.NORMAL, _CLEARED)
    + """SELECT run, normal, last_error AS last_end, cleared, epoch_ms(cleared) - epoch_ms(last_error) AS recovery_ms FROM cleared""",
    "post_restore": with_(Q.WINDOWS, Q.LENGTHS, Q.PLACED, Q.NORMAL, _CLEARED)
    + f"""SELECT c.run, CAST(coalesce(sum(w.errors) FILTER (w.until > TIMESTAMP '{RESTORED}'), 0) AS BIGINT) AS errors_after,
       any_value(c.cleared) AS cleared, any_value(epoch_ms(c.cleared) - epoch_ms(TIMESTAMP '{RESTORED}')) AS normal_after_ms
FROM cleared c JOIN placed w ON w.run = c.run GROUP BY c.run""",
    "phase_profile": with_(Q.WINDOWS, Q.LENGTHS, Q.PLACED)
    + """SELECT run, phase_ms, count(*) AS windows, max(p99) AS max_p99, CAST(sum(s5xx) AS BIGINT) AS s5xx,
       CAST(sum(timeouts) AS BIGINT) AS timeouts, CAST(sum(neterr) AS BIGINT) AS neterr, max(p99) FILTER (rn = n // 2 + 1) AS median_p99
FROM (SELECT *, row_number() OVER (PARTITION BY run, phase_ms ORDER BY p99) AS rn, count(*) OVER (PARTITION BY run, phase_ms) AS n
      FROM (SELECT *, start_ms % 86400000 AS phase_ms FROM placed WHERE len_ms < 86400000 AND 86400000 % len_ms = 0)) GROUP BY 1, 2""",
    "shown_windows": with_(Q.WINDOWS, Q.LENGTHS, Q.PLACED, Q.NORMAL, Q.SHOWN) + 'SELECT run, "end", interesting, shown FROM shown',
    "timeline_rows": with_(Q.WINDOWS, Q.LENGTHS, Q.PLACED, Q.NORMAL, Q.SHOWN)
    + """SELECT run, seq, NOT bool_or(shown) AS is_gap, count(*) AS windows, min(start) AS start, max(until) AS "end",
       max(sent) FILTER (shown) AS sent, max(s200) FILTER (shown) AS s200, max(s5xx) FILTER (shown) AS s5xx,
       max(timeouts) FILTER (shown) AS timeouts, max(neterr) FILTER (shown) AS neterr, max(buffered) FILTER (shown) AS buffered,
       max(p50) FILTER (shown) AS p50, max(p95) FILTER (shown) AS p95, max(p99) FILTER (shown) AS p99
FROM (SELECT *, CAST(sum(opens) OVER (PARTITION BY run ORDER BY "end") AS BIGINT) AS seq FROM (
        SELECT *, CASE WHEN shown OR coalesce(lag(shown) OVER (PARTITION BY run ORDER BY "end"), true) THEN 1 ELSE 0 END AS opens FROM shown))
GROUP BY run, seq""",
    "zero_runs": with_(Q.WINDOWS, Q.LENGTHS, Q.PLACED)
    + """SELECT run, count(*) AS windows, min(start) AS start, max(until) AS "end", max(until_ms) - min(start_ms) AS duration_ms
FROM (SELECT *, row_number() OVER (PARTITION BY run ORDER BY "end") - row_number() OVER (PARTITION BY run, s200 = 0 ORDER BY "end") AS island
      FROM placed) WHERE s200 = 0 GROUP BY run, island""",
    "log_parse": with_(Q.WINDOWS) + f'SELECT run, "end", {_COUNTERS} FROM windows',
    "latest_snapshot": with_(Q.WINDOWS)
    + f"""SELECT run AS source, reqs AS sim_devices, (epoch_ms(TIMESTAMP '{NOW}') - epoch_ms("end") + 500) // 1000 AS sim_age_s,
       CAST(sent AS DOUBLE) / 10 AS sent_per_s, p50 AS p50_ms, p95 AS p95_ms, p99 AS p99_ms, s400 AS status400, s5xx AS status5xx,
       timeouts, neterr, buffered
FROM windows QUALIFY row_number() OVER (PARTITION BY run ORDER BY "end" DESC) = 1""",
    "table_profile": "SELECT count(*) AS rows_approx, true AS has_size, CAST(NULL AS DOUBLE) AS index_mib FROM events",
    "sample_assembly": with_(Q.WINDOWS, _SAMPLES) + "SELECT * FROM samples",
    "sample_report": with_(Q.WINDOWS, _SAMPLES)
    + """SELECT "timestamp", CAST(floor(elapsed_min + 0.5) AS BIGINT) AS elapsed_whole_min, sim_devices, sim_age_s,
       coalesce(sim_age_s > 60, false) AS is_stale FROM samples""",
    "csv_round_trip": with_(Q.WINDOWS, _SAMPLES) + "SELECT " + ", ".join(map(_cell, SAMPLE_COLUMNS)) + " FROM samples",
    "host_stats": """SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS time_utc, CAST(floor(value) AS INTEGER) AS api_cpu_pct,
       floor(value * 10) + 0.25 AS pg_cpu_pct,
       CASE WHEN event_type = 'view' THEN floor(floor(value * 10) * 1000 / 1048576 * 10 + 0.5) / 10 ELSE floor(value * 10) END AS pg_mem_mib
FROM events""",
    "host_waits": """SELECT time_utc, wait, CAST(sum(n) AS BIGINT) AS sessions FROM (
  SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z' AS time_utc, 'ClientRead' AS wait, floor(value * 10) + 1 AS n FROM events
  UNION ALL SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S.%g') || 'Z', 'WALSync', 2 FROM events) GROUP BY 1, 2""",
    "byte_sizes": """SELECT event_id, CASE event_type WHEN 'view' THEN floor(value) * 1073741824 WHEN 'click' THEN floor(value) * 1000 END AS bytes
FROM events""",
}
SQL["log_parse_utf16"] = SQL["log_parse_detected"] = SQL["log_parse"]
SQL["longest_zero_run"] = (
    "SELECT run, max(duration_ms) AS longest_zero_ms, count(*) AS zero_runs FROM (" + SQL["zero_runs"] + ") GROUP BY run"
)
