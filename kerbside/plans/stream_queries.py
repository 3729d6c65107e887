"""Registered streaming queries. The topic is written from the tables, drained, extended and drained again."""

import threading
from bisect import bisect_right
from collections import defaultdict

from pyspark.sql import functions as F

from ..functions.times import bin_start
from ..operators import telemetry as T
from ..session import discard, saved, work_path
from ..sources import table, topic
from ..streaming import ingest, live, publish
from ..streaming.progress import ProgressLog, lag_after_batches, read_progress
from . import inputs as X
from . import inputs_sql as Q
from . import reading_queries as R
from .inputs import ntz
from .inputs_sql import with_


def _drain(spark, sf, root, max_files=None, progress=None):
    query = ingest.start_ingest(
        topic.read_file_stream(spark, f"{root}/topic", max_files),
        f"{root}/table",
        f"{root}/checkpoint",
        lambda session: X.devices(session, sf),
        progress=progress,
    )
    query.awaitTermination()


def _in_parts(spark, sf, is_first):
    """Ingests the messages of a first part, stops, appends the others and resumes; returns the working folder."""
    root = work_path(spark, "ingest")
    messages = X.topic(spark, sf)
    for part in (messages.filter(is_first), messages.filter(~is_first)):
        topic.write_files(part, f"{root}/topic")
        log = ProgressLog(spark, f"{root}/progress")
        _drain(spark, sf, root, progress=log)
        log.wait()
    return root


def _ingested(spark, sf):
    """Every reading first, what was sent again and foreign messages later."""
    return _in_parts(spark, sf, F.col("offset") < X.n_events(spark, sf).scalar())


def _late(spark, sf):
    """The second half of the month first, so that the rest is weeks late: old intervals with new keys."""
    received = F.get_json_object("value", "$.receivedAt").try_cast("timestamp")
    return _in_parts(spark, sf, F.coalesce(received >= F.lit(X.HALF).cast("timestamp"), F.lit(False)))


CUTS = 10
#: Most messages of a file of the topic, and of a task that orders them.
FILE_MESSAGES = 1 << 18


def _limit(spark, sf):
    return -(-X.topic(spark, sf).count() // CUTS)


def _cut(spark, sf):
    """A topic of files with a limited number of messages, so many to a batch: batches cut by count."""
    root = work_path(spark, "cut")
    _drain(spark, sf, root, max_files=_write_cuts(X.topic(spark, sf), f"{root}/topic", _limit(spark, sf)))
    return root


def _write_cuts(messages, path, limit, file_messages=FILE_MESSAGES):
    """Appends the messages in the order of their offsets, ``limit`` at a time; returns the number of files of each cut.

    All cuts but the last have equally many files, and the files of a cut are older than those of the next. Messages are
    ordered in ranges of offsets, so no task holds more than some files' worth; one count per range numbers them all.
    """
    if not limit:
        return 1
    n_files = -(-limit // file_messages)
    per_file = -(-limit // n_files)
    n_files = -(-limit // per_file)
    n_ranges = -(-limit * CUTS // file_messages)
    # The number of the range above 33 bits of the place in it.
    ordered = messages.repartitionByRange(n_ranges, "offset", "partition").sortWithinPartitions("offset", "partition")
    ordered = saved(ordered.withColumn("at", F.monotonically_increasing_id()), "ordered")
    part = F.shiftright("at", 33)
    ranges = ordered.groupBy(part.alias("part")).agg(F.count("*").alias("n")).orderBy("part").collect()
    starts, total = [], 0
    for r in ranges:
        starts.append((r.part, total))
        total += r.n
    starts_of = F.broadcast(ordered.sparkSession.createDataFrame(starts, "part long, start long"))
    ends = [(part << 33) - start for part, start in starts]  # plus the number of a message: its place
    firsts = [start for _, start in starts]
    place = lambda number: number + ends[bisect_right(firsts, number) - 1]
    for low in range(0, total, limit):
        high = min(low + limit, total)
        one = ordered.filter(F.col("at").between(place(low), place(high - 1))).withColumn("part", part)
        number = F.col("at") - F.shiftleft("part", 33) + F.col("start") - low
        one = one.join(starts_of, "part").withColumn("file", F.floor(number / per_file).cast("int"))
        # By the number itself: with a hash the first partition could be empty, which Spark writes as a file more.
        topic.write_files(one.repartitionById(n_files, F.col("file")), path, per_file)
    discard(ordered)
    return n_files


_runs, _locks = {}, defaultdict(threading.Lock)


def _shared(spark, sf, run):
    """The folder of a run that several queries look at; it runs once in a session, also when they start together."""
    key = (spark.sparkContext.applicationId, sf, run.__name__)
    with _locks[key]:
        if key not in _runs:
            _runs[key] = run(spark, sf)
    return _runs[key]


def stream_ingest(spark, sf):
    rows = table.read_readings(spark, f"{_ingested(spark, sf)}/table")
    return rows.select("device_id", ntz("interval_start").alias("interval_start"), "vehicles")


def stream_resume(spark, sf):
    """Counters of both runs, one row per batch."""
    batches = table.read_side(spark, f"{_shared(spark, sf, _ingested)}/table", "batches")
    return batches.select("batch_id", "messages", "inserted", "duplicates", "skipped")


def stream_quarantine(spark, sf):
    rows = table.read_side(spark, f"{_shared(spark, sf, _ingested)}/table", "quarantine")
    return rows.select("partition", "offset", "key", "value", "reason")


def stream_replay(spark, sf):
    """A batch that ran with half of the devices and runs again with all: what is still quarantined."""
    root = work_path(spark, "replay")
    messages, devices = X.topic(spark, sf), X.devices(spark, sf)
    ingest.ingest_batch(messages, 0, f"{root}/table", devices.filter(F.col("interval_seconds") == 15))
    ingest.ingest_batch(messages, 0, f"{root}/table", devices)
    rows = table.read_side(spark, f"{root}/table", "quarantine")
    return rows.select("partition", "offset", "key", "value", "reason")


def stream_conflicts(spark, sf):
    rows = table.read_side(spark, f"{_shared(spark, sf, _ingested)}/table", "conflicts")
    return rows.withColumn("interval_start", ntz("interval_start"))


def stream_lag(spark, sf):
    """Nothing is left to read once both runs are drained."""
    offsets = table.read_side(spark, f"{_shared(spark, sf, _ingested)}/table", "offsets")
    return T.lag_per_partition(_ends(spark, sf), offsets.groupBy("partition").agg(F.max("offset").alias("offset")))


def _ends(spark, sf):
    return X.topic(spark, sf).groupBy("partition").agg(F.min("offset").alias("low"), (F.max("offset") + 1).alias("high"))


def stream_progress_lag(spark, sf):
    """What was left to read after each batch, from the recorded progress; a file source does not report its end."""
    return lag_after_batches(read_progress(spark, f"{_shared(spark, sf, _ingested)}/progress"), _ends(spark, sf))


def stream_panel_exact(spark, sf):
    """Minutes, quarter hours and days from what each batch has added, with intervals that were weeks late."""
    minutes = table.read_panel(spark, f"{_shared(spark, sf, _late)}/table")
    grains = [("minute", F.col("time")), ("quarter", bin_start("time", 900)), ("day", F.date_trunc("day", "time"))]
    grain = F.explode(F.array(*[F.struct(F.lit(name).alias("grain"), at.alias("time")) for name, at in grains])).alias("at")
    sums = minutes.select(grain, "vehicles", "readings").groupBy("at.grain", "at.time")
    return sums.agg(F.sum("vehicles").alias("vehicles"), F.sum("readings").alias("readings")).withColumn("time", ntz("time"))


def stream_cut(spark, sf):
    """Totals of a run whose batches are cut by count, and whether all stayed within the limit."""
    batches = table.read_side(spark, f"{_shared(spark, sf, _cut)}/table", "batches")
    return batches.agg(
        F.count("*").alias("batches"),
        (F.max("messages") <= _limit(spark, sf)).alias("is_within_limit"),
        *[F.sum(c).alias(c) for c in ("messages", "inserted", "duplicates", "skipped")],
    )


def stream_compacted(spark, sf):
    """The table after its batches were merged, with the number of the batch that stored each row."""
    rows = table.read_readings(spark, f"{_shared(spark, sf, _cut)}/table")
    return rows.select("device_id", ntz("interval_start").alias("interval_start"), "vehicles", "batch_id")


def stream_publish(spark, sf):
    """All submissions validated as a stream; returns the messages that reached the topic."""
    root = work_path(spark, "publish")
    submitted = X.submissions(spark, sf)
    submitted.write.parquet(f"{root}/submissions")

    def store(name):
        return lambda rows, batch_id: rows.write.mode("overwrite").parquet(f"{root}/{name}/batch_id={batch_id}")

    stream = spark.readStream.schema(submitted.schema).parquet(f"{root}/submissions")
    publish.start_publish(
        stream, store("messages"), store("rejected"), f"{root}/checkpoint", lambda session: X.devices(session, sf)
    ).awaitTermination()
    return spark.read.schema("key string, value string").parquet(f"{root}/messages").select("key", "value")


def stream_windows(spark, sf):
    root = work_path(spark, "panel")
    schema = X.events(spark, sf).schema
    # The pattern matches the table as one file and as a folder of parts; each file is a micro-batch.
    stream = spark.readStream.schema(schema).option("maxFilesPerTrigger", 1).parquet(f"{sf}/events.parque[t]")
    readings = stream.select(F.col("ts").alias("interval_start"), F.floor("value").cast("int").alias("vehicles"))
    live.start_live_panel(live.live_windows(readings), f"{root}/panel", f"{root}/checkpoint").awaitTermination()
    return live.read_live_panel(spark, f"{root}/panel").withColumn("time", ntz("time"))


QUERIES = {
    "stream_ingest": stream_ingest,
    "stream_resume": stream_resume,
    "stream_quarantine": stream_quarantine,
    "stream_replay": stream_replay,
    "stream_conflicts": stream_conflicts,
    "stream_lag": stream_lag,
    "stream_progress_lag": stream_progress_lag,
    "stream_panel_exact": stream_panel_exact,
    "stream_cut": stream_cut,
    "stream_compacted": stream_compacted,
    "stream_publish": stream_publish,
    "stream_windows": stream_windows,
}

_CUT = "cut AS (SELECT max(event_id) + 1 AS cut FROM events)"
_TOPIC = f"""topic AS (
  SELECT partition, "offset" FROM incoming
  UNION ALL SELECT CAST((user_id + 1) % 6 AS INTEGER), {Q.FOREIGN_OFFSET} FROM events WHERE event_type = 'purchase')"""
_FIRST = """firsts AS (
  SELECT * FROM known QUALIFY row_number() OVER (PARTITION BY device_id, interval_start ORDER BY "offset") = 1)"""
_BATCH = 'CASE WHEN "offset" < (SELECT cut FROM cut) THEN 0 ELSE 1 END'
_BASE = (Q.DEVICES, Q.READINGS, Q.INCOMING, Q.KNOWN, Q.FOREIGN, _CUT, _TOPIC, _FIRST)
_ENDS = 'ends AS (SELECT partition, min("offset") AS low, max("offset") + 1 AS high FROM topic GROUP BY 1)'
_CUTS = f"""cuts AS (
  SELECT partition, "offset", (row_number() OVER (ORDER BY "offset", partition) - 1) // ((count(*) OVER () + {CUTS - 1}) // {CUTS}) AS cut
  FROM topic)"""
_QUARANTINE = f"""SELECT partition, "offset", device_id AS key, {Q.message()} AS value, 'unknown device' AS reason
FROM incoming ANTI JOIN devices USING (device_id)
UNION ALL SELECT partition, "offset", device_id, value, CASE WHEN is_large THEN 'vehicles out of range' WHEN is_outside THEN 'interval start out of range' ELSE 'undecodable' END
FROM foreign_messages"""

SQL = {
    "stream_ingest": with_(*_BASE) + "SELECT device_id, interval_start, vehicles FROM firsts",
    "stream_resume": with_(*_BASE)
    + f"""SELECT CAST(b AS BIGINT) AS batch_id, sum(m)::BIGINT AS messages, sum(i)::BIGINT AS inserted, sum(k - i)::BIGINT AS duplicates,
       sum(m - k)::BIGINT AS skipped FROM (
  SELECT {_BATCH} AS b, 1 AS m, 0 AS k, 0 AS i FROM topic
  UNION ALL SELECT {_BATCH}, 0, 1, 0 FROM known
  UNION ALL SELECT {_BATCH}, 0, 0, 1 FROM firsts) GROUP BY b""",
    "stream_quarantine": with_(*_BASE)
    + _QUARANTINE,
    "stream_replay": with_(*_BASE) + _QUARANTINE,
    "stream_conflicts": with_(*_BASE)
    + f"""SELECT CAST(1 AS BIGINT) AS batch_id, k.device_id, k.interval_start, f.vehicles AS stored_vehicles, k.vehicles AS incoming_vehicles,
       count(*) AS messages, min(k."offset") AS first_offset
FROM (SELECT * FROM known WHERE {_BATCH} = 1) k JOIN (SELECT * FROM firsts WHERE {_BATCH} = 0) f
  ON f.device_id = k.device_id AND f.interval_start = k.interval_start
WHERE k.vehicles <> f.vehicles GROUP BY 2, 3, 4, 5""",
    "stream_lag": with_(*_BASE)
    + """SELECT partition, min("offset") AS low, max("offset") + 1 AS high, max("offset") + 1 AS committed, CAST(0 AS BIGINT) AS lag
FROM topic GROUP BY 1""",
    "stream_progress_lag": with_(*_BASE, _ENDS)
    + f"""SELECT b AS batch_id, (SELECT count(*) FROM topic WHERE {_BATCH} = b) AS messages, CAST(-1 AS BIGINT) AS reported,
       CAST(sum(high - coalesce(done, low)) AS BIGINT) AS lag FROM (
  SELECT CAST(b AS BIGINT) AS b, partition, low, high,
    (SELECT max("offset") + 1 FROM topic t WHERE t.partition = ends.partition AND {_BATCH} <= b) AS done
  FROM ends CROSS JOIN (VALUES (0), (1)) v(b)) GROUP BY b""",
    "stream_panel_exact": with_(*_BASE)
    + """SELECT grain, "time", CAST(sum(vehicles) AS BIGINT) AS vehicles, count(*) AS readings FROM (
  SELECT 'minute' AS grain, date_trunc('minute', interval_start) AS "time", vehicles FROM firsts
  UNION ALL SELECT 'quarter', time_bucket(INTERVAL '15 minutes', interval_start), vehicles FROM firsts
  UNION ALL SELECT 'day', date_trunc('day', interval_start), vehicles FROM firsts) GROUP BY 1, 2""",
    "stream_cut": with_(*_BASE, _CUTS)
    + """SELECT count(DISTINCT cut) AS batches, true AS is_within_limit, count(*) AS messages, (SELECT count(*) FROM firsts) AS inserted,
       (SELECT count(*) FROM known) - (SELECT count(*) FROM firsts) AS duplicates, count(*) - (SELECT count(*) FROM known) AS skipped
FROM cuts""",
    "stream_compacted": with_(*_BASE, _CUTS)
    + """SELECT device_id, interval_start, vehicles, cuts.cut AS batch_id FROM firsts JOIN cuts USING (partition, "offset")""",
    "stream_publish": with_(Q.READINGS, R.ITEMS)
    + """SELECT i.device_id AS key, '{"deviceId":"' || i.device_id || '","intervalStart":"' || strftime(interval_start, '%Y-%m-%dT%H:%M:%SZ')
       || '","vehicles":' || vehicles || ',"receivedAt":"' || strftime(b.received_at, '%Y-%m-%dT%H:%M:%S.%g') || 'Z"}' AS value
FROM items i JOIN (SELECT event_id // 20 * 2 AS batch_id, max(ts) AS received_at FROM events GROUP BY 1) b ON b.batch_id = i.batch_id
WHERE i.batch_id NOT IN (SELECT batch_id FROM rejected)""",
    "stream_windows": """SELECT date_trunc('minute', ts) AS "time", CAST(sum(floor(value)) AS BIGINT) AS vehicles FROM events GROUP BY 1""",
}
