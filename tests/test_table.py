"""The table of runs: merging, crashes between its steps, folders that are not opened, and recorded progress."""

import glob
import json

import pytest
from pyspark.sql import functions as F

from kerbside.operators import panels as P
from kerbside.sources import table, topic
from kerbside.streaming import ingest
from kerbside.streaming.progress import ProgressLog, lag_after_batches, read_progress

from .helpers import devices
from .test_streaming import DIM, held, message, side


def batch_of(spark, *items):
    return spark.createDataFrame([message(i, *item) for i, item in enumerate(items)], topic.TOPIC)


def store(spark, folder, batch_id, *items):
    ingest.ingest_batch(batch_of(spark, *items), batch_id, f"{folder}/table", devices(spark, *DIM))


def test_neighbours_of_one_size_are_due():
    due = table.due
    assert due([(i, i) for i in range(3)], 4) is None
    assert due([(i, i) for i in range(5)], 4) == [(0, 0), (1, 1), (2, 2), (3, 3)]
    assert due([(0, 3), (4, 4), (5, 5), (6, 6), (7, 7)], 4) == [(4, 4), (5, 5), (6, 6), (7, 7)]
    assert due([(0, 3), (4, 7), (8, 11), (12, 15), (16, 16)], 4) == [(0, 3), (4, 7), (8, 11), (12, 15)]
    assert due([(0, 15), (16, 19), (20, 20)], 4) is None
    runs, most = [], 0
    for i in range(500):
        runs.append((i, i))
        while part := due(runs, 4):
            runs = sorted([r for r in runs if r not in part] + [(part[0][0], part[-1][1])])
        most = max(most, len(runs))
    assert most <= 3 * 5 and runs[0][0] == 0 and runs[-1][1] == 499


def test_merging_keeps_rows_counters_and_minutes(spark, tmp_path, monkeypatch):
    folder, path = str(tmp_path), f"{tmp_path}/table"
    for b in range(5):
        # Every batch repeats the reading before it, sends it another count, and one message of an unknown device.
        store(spark, folder, b, ("a", b, b), ("a", b - 1, b - 1), ("b", 4 * (b - 1), 90 + b), ("b", 4 * b, 50 + b), ("ghost", b, 1))
        table.compact(spark, path, b, fan=2)
    assert table.live_runs(spark, path) == [(0, 3), (4, 4)]
    rows = held(spark, folder)
    assert {k: v for k, v in rows.items() if k[0] == "a"} == {("a", i): i for i in range(5)}
    assert {k: v for k, v in rows.items() if k[0] == "b"} == {("b", -4): 90} | {("b", 4 * i): 50 + i for i in range(5)}
    counts = side(spark, folder, "batches").orderBy("batch_id").collect()
    assert [(r.batch_id, r.messages, r.inserted, r.skipped) for r in counts] == [(0, 5, 3, 2)] + [(b, 5, 2, 1) for b in range(1, 5)]
    assert side(spark, folder, "quarantine").count() == 6
    assert side(spark, folder, "conflicts").count() == 4
    exact = {r.time: r.vehicles for r in P.vehicles_per_bin(table.read_readings(spark, path)).collect()}
    assert {r.time: r.vehicles for r in table.read_panel(spark, path).collect()} == exact
    # One generation that is out of use is left for readers that have just looked it up.
    assert len(glob.glob(f"{path}/readings/run=*")) <= 6

    # A crash before the marker of the merged run is written changes nothing, and the next merge goes through.
    store(spark, folder, 5, ("a", 7, 7))
    write = table._write

    def crash(rows, path, name, run):
        if name == "batches" and run[0] != run[1]:
            raise OSError("lost the connection")
        write(rows, path, name, run)

    monkeypatch.setattr(table, "_write", crash)
    before = held(spark, folder)
    with pytest.raises(OSError, match="lost the connection"):
        table.compact(spark, path, 6, fan=2)
    assert held(spark, folder) == before and table.live_runs(spark, path) == [(0, 3), (4, 4), (5, 5)]
    monkeypatch.setattr(table, "_write", write)
    table.compact(spark, path, 6, fan=2)
    assert held(spark, folder) == before and table.live_runs(spark, path) == [(0, 3), (4, 5)]
    store(spark, folder, 6, ("a", 0, 99), ("a", 7, 7), ("a", 8, 8))
    assert held(spark, folder) == before | {("a", 8): 8}


def test_a_folder_without_a_key_of_the_batch_is_not_opened(spark, tmp_path):
    folder, path = str(tmp_path), f"{tmp_path}/table"
    day = 24 * 60 * 4
    store(spark, folder, 0, *[("a", -3 * day + 2 * i, i) for i in range(50)])
    store(spark, folder, 1, ("a", 10, 1), ("a", 20, 2))
    files = glob.glob(f"{path}/readings/run=0-0/*/*.parquet")
    assert files
    for file in files:
        with open(file, "wb") as broken:
            broken.write(b"not a file of readings")
    for crc in glob.glob(f"{path}/readings/run=0-0/*/.*.crc"):
        with open(crc, "wb"):
            pass
    # In the time range of the old folder, with keys it does not have.
    store(spark, folder, 2, ("a", 15, 3), ("a", 20, 2), ("a", -3 * day + 5, 7), ("b", -3 * day + 40, 8))
    counts = side(spark, folder, "batches").filter("batch_id = 2").first()
    assert (counts.inserted, counts.duplicates) == (3, 1)
    with pytest.raises(Exception, match="(?i)parquet|not a file|checksum"):
        store(spark, folder, 3, ("a", -3 * day + 4, 2))
    keys = spark.createDataFrame([("a", None)], "device_id string, interval_start timestamp")
    keys = keys.withColumn("interval_start", F.lit("2026-09-30 23:59:00").cast("timestamp"))
    plan = table.read_candidates(spark, path, keys, 3)._jdf.queryExecution().toString()
    assert "dynamicpruning" in plan.lower()


def test_filters_find_every_key_and_few_others(spark, tmp_path):
    path = f"{tmp_path}/table"
    start = F.timestamp_seconds(F.lit(1_790_000_000) + F.col("id") * 15)
    rows = spark.range(20_000).select(F.concat(F.lit("d"), F.col("id") % 7).alias("device_id"), start.alias("interval_start"))
    rows = rows.withColumns({"vehicles": F.lit(1), "stored_at": F.current_timestamp()})
    table.write_batch(rows, path, 0)
    filters = table.read_runs(spark, path, "filters", [(0, 0)])
    sizes = table.read_runs(spark, path, "folders", [(0, 0)]).select("event_date", "words")
    other = rows.withColumn("device_id", F.lit("x"))
    for keys, least, most in ((rows, 20_000, 20_000), (other, 0, 60)):
        near = keys.withColumn("event_date", F.to_date("interval_start")).join(sizes, "event_date")
        near = near.select("event_date", table._word().alias("word"), table._bits().alias("wanted"))
        hits = near.join(filters, ["event_date", "word"]).filter(F.col("bits").bitwiseAND(F.col("wanted")) == F.col("wanted"))
        assert least <= hits.count() <= most


def test_recorded_progress_tells_the_lag(spark, tmp_path):
    folder = str(tmp_path)
    ends = spark.createDataFrame([(0, 0, 9), (1, 0, 8), (2, 3, 5)], "partition int, low long, high long")
    parts = [[message(0, "a", 0, 5), message(6, "a", 1, 5), message(4, "b", 0, 5, 1)], [message(7, "b", 4, 5, 1)]]
    for part in parts:
        topic.write_files(spark.createDataFrame(part, topic.TOPIC), f"{folder}/topic")
        log = ProgressLog(spark, f"{folder}/progress")
        stream = topic.read_file_stream(spark, f"{folder}/topic")
        query = ingest.start_ingest(stream, f"{folder}/table", f"{folder}/checkpoint", lambda s: devices(s, *DIM), progress=log)
        query.awaitTermination()
        log.wait()
    got = lag_after_batches(read_progress(spark, f"{folder}/progress"), ends).orderBy("batch_id").collect()
    assert [tuple(r) for r in got] == [(0, 3, 2 + 3 + 2, -1), (1, 1, 2 + 0 + 2, -1)]


def test_lag_as_a_broker_reports_it(spark, tmp_path):
    reports = [
        ({"counts": {"4": 712, "5": 31}}, {"counts": {"4": 750, "5": 31}}),
        ({"counts": {"4": 712}}, {"counts": {"4": 750, "6": 909}}),
        ({"counts": {"4": 750, "5": 40}}, None),
    ]
    for b, (end, latest) in enumerate(reports):
        source = {"description": "topic", "endOffset": end, "latestOffset": latest}
        (tmp_path / f"{b}.json").write_text(json.dumps({"batchId": b, "numInputRows": 5, "sources": [source], "observedMetrics": {}}))
    ends = spark.createDataFrame([], "partition int, low long, high long")
    progress = read_progress(spark, str(tmp_path))
    assert [r.messages for r in progress.collect()] == [5, 5, 5]
    ends = spark.createDataFrame([(0, 0, 0)], "partition int, low long, high long")
    got = lag_after_batches(progress, ends).orderBy("batch_id").collect()
    # Partition 6 has no progress, and the third source does not know its end.
    assert [r.reported for r in got] == [38, -1, -1]
