import glob
import json

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from kerbside.operators import ingest as I
from kerbside.operators import panels as P
from kerbside.operators import telemetry as T
from kerbside.sources import table, topic
from kerbside.streaming import ingest, live
from kerbside.streaming.publish import start_publish

from .helpers import devices, later, naive, ts

T0 = ts("2026-09-30 23:59:00")
DIM = (("a", 15), ("b", 60))


def message(offset, device, step, vehicles, partition=0):
    value = {
        "deviceId": device,
        "intervalStart": later(T0, step * 15).strftime("%Y-%m-%dT%H:%M:%SZ"),
        "vehicles": vehicles,
        "receivedAt": "2026-10-01T00:00:00.000Z",
    }
    return (device, json.dumps(value), partition, offset)


def publish(spark, folder, items):
    topic.write_files(spark.createDataFrame(items, topic.TOPIC), f"{folder}/topic")


def drain(spark, folder, checkpoint="checkpoint"):
    stream = topic.read_file_stream(spark, f"{folder}/topic")
    query = ingest.start_ingest(stream, f"{folder}/table", f"{folder}/{checkpoint}", lambda s: devices(s, *DIM))
    query.awaitTermination()


def held(spark, folder):
    got = table.read_readings(spark, f"{folder}/table").collect()
    assert all(r.event_date == naive(r.interval_start).date() for r in got)
    return {(r.device_id, int((naive(r.interval_start) - naive(T0)).total_seconds()) // 15): r.vehicles for r in got}


def side(spark, folder, name):
    return table.read_side(spark, f"{folder}/table", name)


def test_stops_at_any_point_store_every_reading_once(spark, tmp_path):
    """Three runs over two partitions: each sends news, and what the runs before it have sent once more."""
    folder, sent, expected, offset = str(tmp_path), [], [], 0
    for n in (31, 7, 64):
        news = [("a" if i % 3 else "b", 4 * (1000 * n + i), i) for i in range(n)]
        batch = news + sent
        publish(spark, folder, [message(offset + i, d, s, v, partition=i % 2) for i, (d, s, v) in enumerate(batch)])
        drain(spark, folder)
        expected.append((len(batch), n, len(sent), 0))
        sent, offset = sent + news, offset + len(batch)
        assert held(spark, folder) == {(d, s): v for d, s, v in sent}
    counts = side(spark, folder, "batches").orderBy("batch_id").collect()
    assert [(r.messages, r.inserted, r.duplicates, r.skipped) for r in counts] == expected
    done = side(spark, folder, "offsets").groupBy("partition").agg(F.max("offset").alias("offset"))
    ends = done.select("partition", F.lit(0).cast("long").alias("low"), F.col("offset").alias("high"))
    assert ends.agg(F.max("high")).first()[0] == offset
    assert T.consumer_lag(ends, done).first().lag == 0


def test_a_replay_leaves_nothing_of_the_first_try(spark, tmp_path, rows):
    """The second try of a batch knows a device more, and so has no bad rows; the third one lost its readings of a day."""
    folder = str(tmp_path)
    batch = spark.createDataFrame([message(0, "a", 0, 5), message(1, "b", 40, 6)], topic.TOPIC)
    ingest.ingest_batch(batch, 0, f"{folder}/table", devices(spark, ("a", 15)))
    assert rows(side(spark, folder, "quarantine"), "offset") == [(1,)]
    ingest.ingest_batch(batch, 0, f"{folder}/table", devices(spark, *DIM))
    assert held(spark, folder) == {("a", 0): 5, ("b", 40): 6}
    assert side(spark, folder, "quarantine").count() == 0
    ingest.ingest_batch(batch.filter("offset = 0"), 0, f"{folder}/table", devices(spark, *DIM))
    assert held(spark, folder) == {("a", 0): 5}


def test_poison_unknown_and_late_messages(spark, tmp_path, rows):
    folder = str(tmp_path)
    publish(spark, folder, [message(0, "a", 0, 5), ("a", "not json", 0, 1), message(2, "ghost", 0, 1), message(3, "b", 4, 2**31)])
    drain(spark, folder)
    # Far older than anything stored, and a recount of a stored interval.
    publish(spark, folder, [message(4, "a", -400_000, 9), message(5, "a", 0, 6), message(6, "a", 0, 5)])
    drain(spark, folder)
    assert held(spark, folder) == {("a", 0): 5, ("a", -400_000): 9}
    assert rows(side(spark, folder, "quarantine"), "offset", "reason") == [
        (1, "undecodable"),
        (2, "unknown device"),
        (3, "vehicles out of range"),
    ]
    assert rows(side(spark, folder, "conflicts"), "device_id", "stored_vehicles", "incoming_vehicles", "messages") == [("a", 5, 6, 1)]
    assert rows(side(spark, folder, "offsets"), "batch_id", "offset") == [(0, 4), (1, 7)]
    counts = side(spark, folder, "batches").orderBy("batch_id").collect()
    assert [(r.inserted, r.duplicates, r.skipped) for r in counts] == [(1, 0, 3), (1, 2, 0)]


def test_a_crash_after_the_write_is_replayed_without_traces(spark, tmp_path, monkeypatch):
    folder = str(tmp_path)
    publish(spark, folder, [message(0, "a", 0, 5), message(1, "a", 1, 6)])
    drain(spark, folder)
    publish(spark, folder, [message(2, "a", 0, 99), message(3, "a", 2, 7), message(4, "a", 2, 8)])
    write_side = table.write_side

    def crash(rows, path, name, batch_id):
        if name == "batches":
            raise OSError("lost the connection")
        write_side(rows, path, name, batch_id)

    monkeypatch.setattr(table, "write_side", crash)
    with pytest.raises(Exception, match="lost the connection"):
        drain(spark, folder)
    # The unfinished batch is invisible to readers.
    assert held(spark, folder) == {("a", 0): 5, ("a", 1): 6}
    monkeypatch.setattr(table, "write_side", write_side)
    publish(spark, folder, [message(5, "a", 2, 9), message(6, "b", 4, 1)])
    drain(spark, folder)
    assert held(spark, folder) == {("a", 0): 5, ("a", 1): 6, ("a", 2): 7, ("b", 4): 1}
    counts = side(spark, folder, "batches").orderBy("batch_id").collect()
    assert [(r.inserted, r.duplicates) for r in counts] == [(2, 0), (1, 2), (1, 1)]


def test_a_lost_checkpoint_only_causes_duplicates(spark, tmp_path):
    folder = str(tmp_path)
    publish(spark, folder, [message(i, "a", i, i) for i in range(10)])
    drain(spark, folder)
    publish(spark, folder, [message(10, "a", 3, 77), message(11, "a", 10, 10)])
    drain(spark, folder, "another")
    drain(spark, folder, "another")
    assert held(spark, folder) == {("a", i): i for i in range(11)}
    counts = side(spark, folder, "batches").orderBy("batch_id").collect()
    assert [(r.batch_id, r.inserted, r.duplicates) for r in counts] == [(0, 10, 0), (1, 1, 11)]


def test_the_same_batch_twice_changes_nothing(spark, tmp_path):
    folder = str(tmp_path)
    dim = devices(spark, *DIM)
    batch = spark.createDataFrame([message(i, "a", i % 7, i) for i in range(30)], topic.TOPIC)
    for _ in range(2):
        ingest.ingest_batch(batch, 0, f"{folder}/table", dim)
    assert held(spark, folder) == {("a", i): i for i in range(7)}
    assert side(spark, folder, "batches").count() == 1


def test_sorted_rewrite_keeps_the_rows(spark, tmp_path):
    folder = str(tmp_path)
    dim = devices(spark, *DIM)
    for b in range(3):
        batch = spark.createDataFrame([message(i, "a", i + 5 * b, i) for i in range(10)], topic.TOPIC)
        ingest.ingest_batch(batch, b, f"{folder}/table", dim)
    rows = table.read_readings(spark, f"{folder}/table")
    table.rewrite_sorted(rows, f"{folder}/sorted")
    again = table.read_readings(spark, f"{folder}/sorted")
    cols = ["device_id", "interval_start", "vehicles", "stored_at"]
    assert again.select(cols).exceptAll(rows.select(cols)).count() == 0
    assert again.count() == rows.count() == 20
    # Time filters need statistics in the files.
    for path in glob.glob(f"{folder}/sorted/readings/*/*/*.parquet"):
        meta = pq.ParquetFile(path).metadata
        names = [meta.schema.column(i).name for i in range(meta.num_columns)]
        stats = meta.row_group(0).column(names.index("interval_start")).statistics
        assert stats is not None and stats.has_min_max


def test_submissions_reach_the_table(spark, tmp_path, rows):
    """Submitted bodies, validated and published by one stream, stored by another."""
    folder = str(tmp_path)
    item = '{"deviceId":"%s","intervalStart":"2026-09-30T23:59:%s","intervalSeconds":%s,"vehicles":%s}'
    bodies = [
        "[" + item % ("a", "00Z", 15, 1) + "," + item % ("b", "00Z", 60, 2) + "]",
        "[" + item % ("a", "15Z", 15, 3) + "," + item % ("a", "16Z", 15, 4) + "]",
        "[" + item % ("a", "00Z", 15, 9) + "]",
    ]
    data = [(i, later(T0, 60 + i), body) for i, body in enumerate(bodies)]
    schema = "batch_id long, received_at timestamp, body string"
    spark.createDataFrame(data, schema).coalesce(1).write.parquet(f"{folder}/in")

    def send(messages, batch_id):
        offset = F.unix_millis(F.get_json_object("value", "$.receivedAt").cast("timestamp"))
        topic.write_files(messages.withColumn("partition", F.lit(0)).withColumn("offset", offset), f"{folder}/topic")

    def reject(rejected, batch_id):
        rejected.write.mode("overwrite").parquet(f"{folder}/rejected/batch_id={batch_id}")

    stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
    start_publish(stream, send, reject, f"{folder}/sent", lambda s: devices(s, *DIM)).awaitTermination()
    drain(spark, folder)
    assert held(spark, folder) == {("a", 0): 1, ("b", 0): 2}
    refused = spark.read.parquet(f"{folder}/rejected")
    assert rows(refused, "index", "reason") == [(1, "intervalStart 2026-09-30T23:59:16Z is not aligned to a 15s boundary")]
    assert rows(side(spark, folder, "conflicts"), "messages") == []


def test_a_new_checkpoint_keeps_the_totals_of_the_panel(spark, tmp_path):
    folder, schema = str(tmp_path), "device_id string, interval_start timestamp, vehicles int"
    for part, counts in enumerate(([3, 4], [5], [1, 2, 6])):
        spark.createDataFrame([("a", later(T0, 15 * i), n) for i, n in enumerate(counts)], schema).write.parquet(f"{folder}/in{part}")
        stream = spark.readStream.schema(schema).parquet(f"{folder}/in{part}")
        start = [live.live_windows(stream), f"{folder}/panel", f"{folder}/checkpoint{part}"]
        if part:
            with pytest.raises(ValueError, match="another checkpoint"):
                live.start_live_panel(*start)
        live.start_live_panel(*start, continues=part > 0).awaitTermination()
    assert [r.vehicles for r in live.read_live_panel(spark, f"{folder}/panel").collect()] == [21]


def test_published_batches_leave_no_files_behind(spark, tmp_path):
    from kerbside.session import shared_dir

    folder, schema = str(tmp_path), "batch_id long, received_at timestamp, body string"
    spark.createDataFrame([(1, later(T0, 0), "[]")], schema).write.parquet(f"{folder}/in")
    before = set(glob.glob(f"{shared_dir(spark)}/kerbside/*"))
    stream = spark.readStream.schema(schema).parquet(f"{folder}/in")
    keep = lambda rows, batch_id: rows.collect()
    start_publish(stream, keep, keep, f"{folder}/sent", lambda s: devices(s, *DIM)).awaitTermination()
    assert set(glob.glob(f"{shared_dir(spark)}/kerbside/*")) == before


def test_live_panel_equals_the_batch_answer(spark, tmp_path):
    folder = str(tmp_path)
    for part in range(2):
        data = [("a", later(T0, 15 * i), i) for i in range(part * 10, part * 10 + 10)]
        rows = spark.createDataFrame(data, "device_id string, interval_start timestamp, vehicles int")
        rows.coalesce(1).write.mode("append").parquet(f"{folder}/in")
        stream = spark.readStream.schema(rows.schema).parquet(f"{folder}/in")
        live.start_live_panel(live.live_windows(stream), f"{folder}/panel", f"{folder}/checkpoint").awaitTermination()
    got = {r.time: r.vehicles for r in live.read_live_panel(spark, f"{folder}/panel").collect()}
    exact = P.vehicles_per_bin(spark.read.parquet(f"{folder}/in"))
    assert got == {r.time: r.vehicles for r in exact.collect()}
