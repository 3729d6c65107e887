"""Registered queries over devices and readings: dimension, panels, wire format, ingest, validation."""

from pyspark.sql import functions as F

from ..functions.scalars import device_id, key_partition, to_fixed
from ..functions.times import bin_start, epoch_ms, floor_to, from_ms, next_boundary_ms
from ..operators import devices as D
from ..operators import ingest as I
from ..operators import panels as P
from ..operators import telemetry as T
from ..operators import validation as V
from ..operators import wire
from ..operators.scale import lookup
from ..schema import MAX_BATCH
from . import inputs as X
from . import inputs_sql as Q
from .inputs import ntz
from .inputs_sql import with_

ONE_DEVICE = "dev-00001"
EARLY = "2024-01-02 00:00:00"
FROM, TO = "2024-01-01 00:00:00", "2024-01-20 12:00:00"


def seed_devices(spark, sf):
    count = X.n_devices(spark, sf).first().n
    rows = X.readings(spark, sf, ("event_type",))
    early = rows.filter((F.col("stored_at") < X.instant(EARLY)) & (F.col("event_type") == "purchase"))
    return D.missing_devices(D.seed_devices(spark, count), early.select("device_id"))


def load_devices(spark, sf):
    return D.load_devices(X.devices(spark, sf))


def expected_rate(spark, sf):
    return D.expected_rate(X.devices(spark, sf))


def device_ids(spark, sf):
    return X.events(spark, sf).select("event_id", device_id(F.col("user_id") + 99_950).alias("device_id"))


def dimension_lookup(spark, sf):
    rows = X.incoming(spark, sf).select("offset", "device_id")
    return lookup(rows, D.load_devices(X.devices(spark, sf)), "device_id", "left")


def _one_device(spark, sf, seconds):
    rows = P.device_range(X.readings(spark, sf), ONE_DEVICE, X.instant(FROM), X.instant(TO))
    return P.vehicles_per_bin(rows, seconds).orderBy("time")


def citywide_1m(spark, sf):
    return P.vehicles_per_bin(X.readings(spark, sf)).orderBy("time")


def citywide_range_6h(spark, sf):
    last = X.events(spark, sf).agg(F.max("ts")).scalar()
    rows = P.time_range(X.readings(spark, sf), last - F.expr("INTERVAL '6' HOUR"), last)
    return P.vehicles_per_bin(rows).orderBy("time")


def ingest_rate_1m(spark, sf):
    return P.ingest_rate(X.readings(spark, sf)).orderBy("time")


def completeness_1m(spark, sf):
    return P.completeness(X.readings(spark, sf), X.devices(spark, sf))


def missing_intervals(spark, sf):
    span = X.readings(spark, sf).agg(F.min("interval_start").alias("lo"), F.max("interval_start").alias("hi"))
    lo = span.select(F.date_trunc("day", "lo").alias("lo")).scalar()
    hi = span.select((F.date_trunc("day", "hi") + F.expr("INTERVAL '1' DAY")).alias("hi")).scalar()
    gaps = P.missing_ranges(X.readings(spark, sf), X.devices(spark, sf), lo, hi)
    return gaps.select("device_id", ntz("missing_from").alias("missing_from"), ntz("missing_to").alias("missing_to"), "n_missing")


def send_store_gap(spark, sf):
    return P.send_store_gap(X.readings(spark, sf), X.delayed(spark, sf))


def time_bins(spark, sf):
    return X.events(spark, sf).select(
        "event_id",
        bin_start("ts", 900).alias("quarter"),
        ntz(F.date_trunc("minute", "ts")).alias("minute"),
        ntz(floor_to("ts", 15)).alias("quarter_minute"),
    )


def next_boundary(spark, sf):
    joined = lookup(X.readings(spark, sf), D.load_devices(X.devices(spark, sf)), "device_id", "inner")
    ms = next_boundary_ms(epoch_ms("interval_start"), "interval_seconds")
    return joined.select("offset", ntz(from_ms(ms)).alias("boundary"))


def key_partitions(spark, sf):
    rows = X.incoming(spark, sf).select("device_id", key_partition("device_id", 6).alias("p"))
    spread = rows.groupBy("device_id").agg(F.min("p").alias("lo"), F.max("p").alias("hi"), F.count("*").alias("messages"))
    return spread.select("device_id", "messages", (F.col("lo") == F.col("hi")).alias("is_colocated"))


def rounding(spark, sf):
    return X.events(spark, sf).select("event_id", to_fixed("value", 1).alias("rounded"))


def wire_encode(spark, sf):
    return wire.encode(X.readings(spark, sf))


def wire_decode(spark, sf):
    rows = wire.decode(X.topic(spark, sf))
    return rows.select(
        "partition",
        "offset",
        "is_decoded",
        "device_id",
        ntz(X.shown("interval_start")).alias("interval_start"),
        "vehicles",
        ntz("accepted_at").alias("accepted_at"),
    )


def commit_offsets(spark, sf):
    return wire.commit_offsets(X.topic(spark, sf))


def _marks(spark, sf):
    sent = X.incoming(spark, sf)
    ends = sent.groupBy("partition").agg(F.min("offset").alias("low"), (F.max("offset") + 1).alias("high"))
    # Partition 0 has never been committed.
    done = sent.filter((F.col("accepted_at") < X.instant(X.HALF)) & (F.col("partition") != 0))
    return ends, wire.commit_offsets(done)


def lag_per_partition(spark, sf):
    return T.lag_per_partition(*_marks(spark, sf))


def consumer_lag(spark, sf):
    return T.consumer_lag(*_marks(spark, sf))


def _good(spark, sf):
    return I.split_by_constraints(X.incoming(spark, sf), X.devices(spark, sf))


def _probed(spark, sf):
    return I.probe(I.first_writes(_good(spark, sf)[0]), X.stored(spark, sf))


def ingest_new_rows(spark, sf):
    return I.new_rows(_probed(spark, sf))


def ingest_duplicates(spark, sf):
    return I.duplicate_keys(_probed(spark, sf))


def ingest_conflicts(spark, sf):
    return I.conflicts(_good(spark, sf)[0], _probed(spark, sf))


def ingest_conflicts_in_batch(spark, sf):
    return I.conflicts(_good(spark, sf)[0], _probed(spark, sf), include_in_batch=True)


def ingest_rejected(spark, sf):
    rows = X.incoming(spark, sf).withColumn("vehicles", F.col("vehicles").cast("double")).drop("partition")
    refused = I.split_by_constraints(rows.unionByName(X.broken(spark, sf)), X.devices(spark, sf))[1]
    return refused.select("device_id", X.shown("interval_start").alias("interval_start"), "vehicles", "offset", "reason")


def ingest_counters(spark, sf):
    return I.counters(_probed(spark, sf))


def _hourly_batches(spark, sf):
    rows = X.incoming(spark, sf)
    return I.batch_counters(rows, X.devices(spark, sf), _probed(spark, sf), bin_start("accepted_at", 3600))


def ingest_batches(spark, sf):
    return _hourly_batches(spark, sf)


def ingest_rollup(spark, sf):
    rows = _hourly_batches(spark, sf).withColumn("ts", F.col("batch_id")).withColumn("store_retries", F.lit(0).cast("long"))
    return T.ingest_rollup(rows, 86_400)


def flush_times(spark, sf):
    cost = F.col("inserted") * 2 + F.col("duplicates") + F.col("skipped")
    rows = _hourly_batches(spark, sf).withColumn("ts", F.col("batch_id")).withColumn("flush_ms", cost)
    return T.flush_times(rows, 86_400)


def e2e_delay(spark, sf):
    return T.end_to_end_delay(X.delayed(spark, sf), 3600)


def reconcile(spark, sf):
    stored = X.stored(spark, sf)
    table = stored.select("device_id", "interval_start", "vehicles").unionByName(
        I.new_rows(_probed(spark, sf)).select("device_id", "interval_start", "vehicles")
    )
    source = I.first_writes(X.readings(spark, sf))
    return I.reconcile(source, table)


def batch_packing(spark, sf):
    rows = I.first_writes(X.readings(spark, sf)).select("device_id", "interval_start", "vehicles")
    return T.pack_batches(rows, MAX_BATCH)


def oldest_batch(spark, sf):
    return batch_packing(spark, sf).filter(F.col("batch_no") == 0).select("device_id", "interval_start", "vehicles")


def _checked(spark, sf):
    return V.check_items(X.submissions(spark, sf), X.devices(spark, sf))


def validate_reasons(spark, sf):
    return _checked(spark, sf).select("batch_id", "pos", "reason")


def validate_batches(spark, sf):
    return V.rejected_batches(_checked(spark, sf))


def _accepted(spark, sf):
    return V.validate_submissions(X.submissions(spark, sf), X.devices(spark, sf))[0]


def validate_accepted(spark, sf):
    return _accepted(spark, sf).select("batch_id", "pos", "device_id", ntz("interval_start").alias("interval_start"), "vehicles")


def validate_summary(spark, sf):
    return V.accepted_summary(_accepted(spark, sf))


def classify_outcomes(spark, sf):
    return X.requests(spark, sf).select("event_id", V.outcome("status", "error").alias("outcome"))


def window_metrics(spark, sf):
    return T.with_rate(T.request_windows(X.requests(spark, sf), 3600), 3600)


def percentiles(spark, sf):
    rows = X.events(spark, sf).select("event_type", F.floor(F.col("value") * 1000).cast("long").alias("us"))
    return T.percentiles(rows, ["event_type"], "us", (50, 95, 99))


def upper_median(spark, sf):
    rows = X.events(spark, sf).select("event_type", F.floor(F.col("value") * 1000).cast("long").alias("us"))
    return T.median(rows, ["event_type"], "us")


QUERIES = {
    "seed_devices": seed_devices,
    "load_devices": load_devices,
    "expected_rate": expected_rate,
    "device_ids": device_ids,
    "dimension_lookup": dimension_lookup,
    "vehicles_1m_device": lambda spark, sf: _one_device(spark, sf, 60),
    "vehicles_15m_device": lambda spark, sf: _one_device(spark, sf, 900),
    "citywide_1m": citywide_1m,
    "citywide_range_6h": citywide_range_6h,
    "ingest_rate_1m": ingest_rate_1m,
    "completeness_1m": completeness_1m,
    "missing_intervals": missing_intervals,
    "send_store_gap": send_store_gap,
    "time_bins": time_bins,
    "next_boundary": next_boundary,
    "key_partition": key_partitions,
    "rounding": rounding,
    "wire_encode": wire_encode,
    "wire_decode": wire_decode,
    "commit_offsets": commit_offsets,
    "lag_per_partition": lag_per_partition,
    "consumer_lag": consumer_lag,
    "ingest_new_rows": ingest_new_rows,
    "ingest_duplicates": ingest_duplicates,
    "ingest_conflicts": ingest_conflicts,
    "ingest_conflicts_in_batch": ingest_conflicts_in_batch,
    "ingest_rejected": ingest_rejected,
    "ingest_counters": ingest_counters,
    "ingest_batches": ingest_batches,
    "ingest_rollup": ingest_rollup,
    "flush_times": flush_times,
    "e2e_delay": e2e_delay,
    "reconcile": reconcile,
    "batch_packing": batch_packing,
    "oldest_batch": oldest_batch,
    "validate_reasons": validate_reasons,
    "validate_batches": validate_batches,
    "validate_accepted": validate_accepted,
    "validate_summary": validate_summary,
    "classify_outcomes": classify_outcomes,
    "window_metrics": window_metrics,
    "percentiles": percentiles,
    "upper_median": upper_median,
}

_ONE = (
    with_(Q.READINGS)
    + """SELECT time_bucket(INTERVAL '{width}', interval_start) AS "time", CAST(sum(vehicles) AS BIGINT) AS vehicles
FROM readings WHERE device_id = '"""
    + ONE_DEVICE
    + f"""' AND interval_start BETWEEN TIMESTAMP '{FROM}' AND TIMESTAMP '{TO}' GROUP BY 1 ORDER BY 1"""
)

_INGEST = (Q.DEVICES, Q.READINGS, Q.STORED, Q.INCOMING, Q.KNOWN, Q.PROBED)

_HOURLY = """hourly AS (
  SELECT r.batch_id, coalesce(n.inserted, 0) AS inserted, r.good - coalesce(n.inserted, 0) AS duplicates, r.skipped
  FROM (SELECT date_trunc('hour', accepted_at) AS batch_id, count(*) FILTER (d.device_id IS NOT NULL) AS good,
               count(*) FILTER (d.device_id IS NULL) AS skipped
        FROM incoming i LEFT JOIN devices d USING (device_id) GROUP BY 1) r
  LEFT JOIN (SELECT date_trunc('hour', accepted_at) AS batch_id, count(*) AS inserted
             FROM probed WHERE stored_vehicles IS NULL GROUP BY 1) n ON n.batch_id = r.batch_id)"""

_CONFLICTS = """SELECT k.device_id, k.interval_start, k.vehicles AS incoming_vehicles, count(*) AS messages,
       min(k."offset") AS first_offset, any_value({kept}) AS stored_vehicles
FROM known k JOIN probed p ON p.device_id = k.device_id AND p.interval_start = k.interval_start
WHERE k.vehicles <> {kept} GROUP BY 1, 2, 3"""

_MARKS = f"""ends AS (SELECT partition, min("offset") AS low, max("offset") + 1 AS high FROM incoming GROUP BY 1),
done AS (SELECT partition, max("offset") + 1 AS committed FROM incoming
         WHERE accepted_at < TIMESTAMP '{X.HALF}' AND partition <> 0 GROUP BY 1)"""

_TEXT = "strftime(interval_start, '%Y-%m-%dT%H:%M:%SZ')"
_SHAPE = """intervalStart must be an ISO 8601 UTC timestamp like "2026-09-30T11:00:45Z\""""
ITEMS = f"""items AS (
  SELECT event_id // 20 * 2 AS batch_id, CAST(row_number() OVER (PARTITION BY event_id // 20 ORDER BY event_id) - 1 AS INTEGER) AS pos,
         device_id, interval_start, vehicles,
         CASE k WHEN 20 THEN 'reading must be an object'
                WHEN 21 THEN 'deviceId must be a string'
                WHEN 13 THEN 'unknown deviceId "dev-99999x"'
                WHEN 14 THEN 'intervalSeconds must be ' || seconds || ' for ' || device_id || ', got "15"'
                WHEN 12 THEN 'intervalSeconds must be ' || seconds || ' for ' || device_id || ', got 30'
                WHEN 15 THEN '{_SHAPE}'
                WHEN 22 THEN '{_SHAPE} (invalid date)'
                WHEN 16 THEN 'intervalStart ' || replace({_TEXT}, 'Z', '.500Z') || ' is not aligned to a ' || seconds || 's boundary'
                WHEN 17 THEN 'intervalStart 2025' || substr({_TEXT}, 5) || ' is in the future'
                WHEN 18 THEN 'vehicles must be a non-negative integer, got -1'
                WHEN 19 THEN 'vehicles must be a non-negative integer, got "7"'
                WHEN 11 THEN 'vehicles must be a non-negative integer, got 1.5'
                WHEN 10 THEN 'vehicles must be a non-negative integer, got 2147483648' END AS reason
  FROM (SELECT r.*, {Q.seconds('r.user_id')} AS seconds, e.event_id,
               CASE WHEN e.event_type = 'error' THEN CAST(json_extract(e.props, '$.k') AS INTEGER) END AS k
        FROM events e JOIN readings r ON r."offset" = e.event_id AND r.user_id = e.user_id)),
rejected AS (
  SELECT batch_id, min(pos) AS "index", arg_min(reason, pos) AS reason FROM items WHERE reason IS NOT NULL GROUP BY 1)"""

_ANSWERED = f"""answered AS (
  SELECT *, row_number() OVER (PARTITION BY h ORDER BY latency_ms) AS rn, count(*) OVER (PARTITION BY h) AS n
  FROM (SELECT *, date_trunc('hour', ts) AS h FROM requests WHERE status IS NOT NULL)),
ranks AS (SELECT h, max(latency_ms) FILTER ({Q.ranked(50)}) AS p50, max(latency_ms) FILTER ({Q.ranked(95)}) AS p95,
                 max(latency_ms) FILTER ({Q.ranked(99)}) AS p99 FROM answered GROUP BY h)"""

_FIRST = """firsts AS (
  SELECT * FROM readings QUALIFY row_number() OVER (PARTITION BY device_id, interval_start ORDER BY "offset") = 1)"""

_VALUES = """numbered AS (
  SELECT event_type, CAST(floor(value * 1000) AS BIGINT) AS us,
         row_number() OVER (PARTITION BY event_type ORDER BY floor(value * 1000)) AS rn, count(*) OVER (PARTITION BY event_type) AS n
  FROM events)"""

SQL = {
    "seed_devices": with_(Q.READINGS)
    + f"""SELECT device_id, name, interval_seconds FROM (
  SELECT {Q.device_id("n")} AS device_id, 'Sensor ' || n AS name,
         CAST(CASE WHEN n <= (SELECT max(user_id) + 1 FROM events) // 2 THEN 15 ELSE 60 END AS INTEGER) AS interval_seconds
  FROM (SELECT unnest(range(1, (SELECT max(user_id) + 2 FROM events))) AS n))
WHERE device_id NOT IN (SELECT device_id FROM readings WHERE stored_at < TIMESTAMP '{EARLY}' AND event_type = 'purchase')""",
    "load_devices": with_(Q.DEVICES) + "SELECT device_id, interval_seconds FROM devices",
    "expected_rate": with_(Q.DEVICES)
    + """SELECT count(*) AS devices, CAST(sum(60 // interval_seconds) AS BIGINT) AS readings_per_min,
       CAST(sum(60 // interval_seconds) AS DOUBLE) / 60 AS readings_per_s FROM devices""",
    "device_ids": f"SELECT event_id, {Q.device_id('(user_id + 99950)')} AS device_id FROM events",
    "dimension_lookup": with_(Q.DEVICES, Q.READINGS, Q.INCOMING)
    + 'SELECT "offset", device_id, interval_seconds FROM incoming LEFT JOIN devices USING (device_id)',
    "vehicles_1m_device": _ONE.format(width="1 minute"),
    "vehicles_15m_device": _ONE.format(width="15 minutes"),
    "citywide_1m": with_(Q.READINGS)
    + """SELECT time_bucket(INTERVAL '1 minute', interval_start) AS "time", CAST(sum(vehicles) AS BIGINT) AS vehicles
FROM readings GROUP BY 1 ORDER BY 1""",
    "citywide_range_6h": with_(Q.READINGS)
    + """SELECT time_bucket(INTERVAL '1 minute', interval_start) AS "time", CAST(sum(vehicles) AS BIGINT) AS vehicles
FROM readings WHERE interval_start BETWEEN (SELECT max(ts) FROM events) - INTERVAL 6 HOUR AND (SELECT max(ts) FROM events)
GROUP BY 1 ORDER BY 1""",
    "ingest_rate_1m": with_(Q.READINGS)
    + """SELECT time_bucket(INTERVAL '1 minute', stored_at) AS "time", count(*) AS "rows" FROM readings GROUP BY 1 ORDER BY 1""",
    "completeness_1m": with_(Q.DEVICES, Q.READINGS)
    + """SELECT date_trunc('minute', interval_start) AS "time", count(*) AS "rows",
       (SELECT CAST(sum(60 // interval_seconds) AS BIGINT) FROM devices) AS expected,
       count(*) = (SELECT sum(60 // interval_seconds) FROM devices) AS is_complete
FROM readings GROUP BY 1""",
    "missing_intervals": with_(Q.DEVICES, Q.READINGS)
    + """, span AS (SELECT date_trunc('day', min(interval_start)) AS lo, date_trunc('day', max(interval_start)) + INTERVAL 1 DAY AS hi FROM readings),
held AS (SELECT DISTINCT device_id, interval_start FROM readings),
gaps AS (
  SELECT device_id, interval_start + to_seconds(interval_seconds) AS a,
         coalesce(lead(interval_start) OVER (PARTITION BY device_id ORDER BY interval_start), (SELECT hi FROM span)) AS b, interval_seconds
  FROM held JOIN devices USING (device_id)
  UNION ALL
  SELECT device_id, (SELECT lo FROM span), coalesce(min(interval_start), (SELECT hi FROM span)), any_value(interval_seconds)
  FROM devices LEFT JOIN held USING (device_id) GROUP BY device_id)
SELECT device_id, a AS missing_from, b AS missing_to, CAST(epoch(b - a) AS BIGINT) // interval_seconds AS n_missing
FROM gaps WHERE b > a""".replace("\n, span", ",\nspan", 1),
    "send_store_gap": with_(Q.DELAYED)
    + """SELECT "time", sent, stored, sent - stored AS gap, CAST(sum(sent - stored) OVER (ORDER BY "time") AS BIGINT) AS backlog
FROM (SELECT coalesce(a.t, b.t) AS "time", coalesce(a.n, 0) AS sent, coalesce(b.n, 0) AS stored
      FROM (SELECT date_trunc('minute', accepted_at) AS t, count(*) AS n FROM delayed GROUP BY 1) a
      FULL JOIN (SELECT date_trunc('minute', stored_at) AS t, count(*) AS n FROM delayed GROUP BY 1) b ON a.t = b.t)""",
    "time_bins": """SELECT event_id, time_bucket(INTERVAL '15 minutes', ts) AS quarter, date_trunc('minute', ts) AS minute,
       time_bucket(INTERVAL '15 seconds', ts) AS quarter_minute FROM events""",
    "next_boundary": with_(Q.DEVICES, Q.READINGS)
    + 'SELECT "offset", interval_start + to_seconds(interval_seconds) AS boundary FROM readings JOIN devices USING (device_id)',
    "key_partition": with_(Q.READINGS, Q.INCOMING)
    + "SELECT device_id, count(*) AS messages, true AS is_colocated FROM incoming GROUP BY 1",
    "rounding": """SELECT event_id, CAST((CAST(value * 1152921504606846976 AS HUGEINT) * 20 + 1152921504606846976) // 2305843009213693952 AS DOUBLE) / 10 AS rounded
FROM events""",
    "wire_encode": with_(Q.READINGS)
    + f"""SELECT device_id AS key, '{{"deviceId":"' || device_id || '","intervalStart":"' || {_TEXT} || '","vehicles":' || vehicles
       || ',"receivedAt":"' || strftime(accepted_at, '%Y-%m-%dT%H:%M:%S.%g') || 'Z"}}' AS value FROM readings""",
    "wire_decode": with_(Q.READINGS, Q.INCOMING, Q.FOREIGN)
    + f"""SELECT partition, "offset", true AS is_decoded, device_id, interval_start, CAST(vehicles AS DOUBLE) AS vehicles,
       date_trunc('milliseconds', accepted_at) AS accepted_at FROM incoming
UNION ALL SELECT partition, "offset", is_large OR is_outside, CASE WHEN is_large OR is_outside THEN device_id END,
       CASE WHEN is_large THEN interval_start END, CASE WHEN is_large THEN CAST('{X.LARGE}' AS DOUBLE) WHEN is_outside THEN CAST(vehicles AS DOUBLE) END,
       CASE WHEN is_large OR is_outside THEN date_trunc('milliseconds', accepted_at) END
FROM foreign_messages""",
    "commit_offsets": with_(Q.READINGS, Q.INCOMING)
    + """SELECT partition, max("offset") + 1 AS "offset" FROM (
  SELECT partition, "offset" FROM incoming
  UNION ALL SELECT CAST((user_id + 1) % 6 AS INTEGER), {fo} FROM events WHERE event_type = 'purchase') GROUP BY 1""".format(fo=Q.FOREIGN_OFFSET),
    "lag_per_partition": with_(Q.READINGS, Q.INCOMING, _MARKS)
    + """SELECT partition, low, high, committed, high - coalesce(committed, low) AS lag FROM ends LEFT JOIN done USING (partition)""",
    "consumer_lag": with_(Q.READINGS, Q.INCOMING, _MARKS)
    + """SELECT CAST(sum(high - coalesce(committed, low)) AS BIGINT) AS lag FROM ends LEFT JOIN done USING (partition)""",
    "ingest_new_rows": with_(*_INGEST)
    + 'SELECT device_id, interval_start, vehicles, accepted_at, "offset" FROM probed WHERE stored_vehicles IS NULL',
    "ingest_duplicates": with_(*_INGEST)
    + """SELECT device_id, interval_start, copies - CASE WHEN stored_vehicles IS NULL THEN 1 ELSE 0 END AS duplicates
FROM probed WHERE copies > 1 OR stored_vehicles IS NOT NULL""",
    "ingest_conflicts": with_(*_INGEST) + _CONFLICTS.format(kept="p.stored_vehicles"),
    "ingest_conflicts_in_batch": with_(*_INGEST) + _CONFLICTS.format(kept="coalesce(p.stored_vehicles, p.vehicles)"),
    "ingest_rejected": with_(Q.DEVICES, Q.READINGS, Q.INCOMING, Q.BROKEN)
    + """SELECT device_id, interval_start, CAST(vehicles AS DOUBLE) AS vehicles, "offset", 'unknown device' AS reason
FROM incoming ANTI JOIN devices USING (device_id)
UNION ALL SELECT device_id, interval_start, vehicles, "offset", reason FROM broken""",
    "ingest_counters": with_(*_INGEST)
    + """SELECT count(*) FILTER (stored_vehicles IS NULL) AS accepted,
       CAST(sum(copies) - count(*) FILTER (stored_vehicles IS NULL) AS BIGINT) AS duplicates FROM probed""",
    "ingest_batches": with_(*_INGEST, _HOURLY) + "SELECT batch_id, inserted, duplicates, skipped FROM hourly",
    "ingest_rollup": with_(*_INGEST, _HOURLY)
    + """SELECT date_trunc('day', batch_id) AS "time", count(*) AS batches, CAST(sum(inserted) AS BIGINT) AS inserted,
       CAST(sum(duplicates) AS BIGINT) AS duplicates, CAST(sum(skipped) AS BIGINT) AS skipped, CAST(0 AS BIGINT) AS store_retries,
       CAST(floor(CAST(sum(inserted + duplicates) AS DOUBLE) / count(*) + 0.5) AS BIGINT) AS avg_batch FROM hourly GROUP BY 1""",
    "flush_times": with_(*_INGEST, _HOURLY)
    + f"""SELECT "time", max(ms) FILTER ({Q.ranked(50)}) AS flush_ms_p50, max(ms) AS flush_ms_max FROM (
  SELECT *, row_number() OVER (PARTITION BY "time" ORDER BY ms) AS rn, count(*) OVER (PARTITION BY "time") AS n
  FROM (SELECT date_trunc('day', batch_id) AS "time", inserted * 2 + duplicates + skipped AS ms FROM hourly)) GROUP BY 1""",
    "e2e_delay": with_(Q.DELAYED)
    + f"""SELECT "time", max(ms) FILTER ({Q.ranked(50)}) AS end_to_end_ms_p50, max(ms) AS end_to_end_ms_max FROM (
  SELECT *, row_number() OVER (PARTITION BY "time" ORDER BY ms) AS rn, count(*) OVER (PARTITION BY "time") AS n
  FROM (SELECT date_trunc('hour', stored_at) AS "time", epoch_ms(stored_at) - epoch_ms(accepted_at) AS ms FROM delayed)) GROUP BY 1""",
    "reconcile": with_(*_INGEST)
    + """, source AS (SELECT count(*) AS n, CAST(sum(vehicles) AS BIGINT) AS v FROM (
  SELECT vehicles, row_number() OVER (PARTITION BY device_id, interval_start ORDER BY "offset") AS rn FROM readings) WHERE rn = 1),
held AS (SELECT count(*) AS n, CAST(sum(vehicles) AS BIGINT) AS v FROM (
  SELECT vehicles FROM stored UNION ALL SELECT vehicles FROM probed WHERE stored_vehicles IS NULL))
SELECT s.n AS source_rows, s.v AS source_vehicles, h.n AS table_rows, h.v AS table_vehicles, s.n = h.n AND s.v = h.v AS is_equal
FROM source s, held h""".replace("\n, source", ",\nsource", 1),
    "batch_packing": with_(Q.READINGS, _FIRST)
    + f"""SELECT device_id, interval_start, vehicles,
       (row_number() OVER (PARTITION BY device_id ORDER BY interval_start) - 1) // {MAX_BATCH} AS batch_no FROM firsts""",
    "oldest_batch": with_(Q.READINGS, _FIRST)
    + f"""SELECT device_id, interval_start, vehicles FROM firsts
QUALIFY row_number() OVER (PARTITION BY device_id ORDER BY interval_start) <= {MAX_BATCH}""",
    "validate_reasons": with_(Q.READINGS, ITEMS) + """SELECT batch_id, pos, reason FROM items
UNION ALL SELECT event_id * 2 + 1, NULL, """ + Q.BODY_REASON + " FROM events",
    "validate_batches": with_(Q.READINGS, ITEMS)
    + """SELECT batch_id, "index", reason FROM rejected
UNION ALL SELECT event_id * 2 + 1, NULL, """ + Q.BODY_REASON + " FROM events",
    "validate_accepted": with_(Q.READINGS, ITEMS)
    + "SELECT batch_id, pos, device_id, interval_start, vehicles FROM items WHERE batch_id NOT IN (SELECT batch_id FROM rejected)",
    "validate_summary": with_(Q.READINGS, ITEMS)
    + "SELECT batch_id, count(*) AS queued FROM items WHERE batch_id NOT IN (SELECT batch_id FROM rejected) GROUP BY 1",
    "classify_outcomes": with_(Q.REQUESTS)
    + """SELECT event_id, CASE WHEN status = 200 THEN 'ok' WHEN status = 400 THEN 'rejected' WHEN status IS NOT NULL THEN '5xx'
       WHEN error = 'timeout' THEN 'timeout' ELSE 'network' END AS outcome FROM requests""",
    "window_metrics": with_(Q.REQUESTS, _ANSWERED)
    + """SELECT w.*, coalesce(p50, 0) AS p50, coalesce(p95, 0) AS p95, coalesce(p99, 0) AS p99, CAST(readings_sent AS DOUBLE) / 3600 AS sent_per_s
FROM (SELECT date_trunc('hour', ts) AS window_start, count(*) AS requests, CAST(sum(n_readings) AS BIGINT) AS readings_sent,
             CAST(coalesce(sum(queued) FILTER (status = 200), 0) AS BIGINT) AS queued, count(*) FILTER (status = 200) AS status200,
             count(*) FILTER (status = 400) AS status400, count(*) FILTER (status = 503) AS status5xx,
             count(*) FILTER (error = 'timeout') AS timeouts, count(*) FILTER (error = 'refused') AS network_errors,
             count(*) FILTER (status IS NOT NULL) AS answered
      FROM requests GROUP BY 1) w LEFT JOIN ranks r ON r.h = w.window_start""",
    "percentiles": with_(_VALUES)
    + f"""SELECT event_type, count(*) AS n, max(us) FILTER ({Q.ranked(50)}) AS p50, max(us) FILTER ({Q.ranked(95)}) AS p95,
       max(us) FILTER ({Q.ranked(99)}) AS p99 FROM numbered GROUP BY 1""",
    "upper_median": with_(_VALUES) + "SELECT event_type, max(us) FILTER (rn = n // 2 + 1) AS median FROM numbered GROUP BY 1",
}
