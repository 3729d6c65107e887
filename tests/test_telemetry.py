import math
import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from kerbside.operators import telemetry as T
from kerbside.operators.scale import fewer_digits, neighbours, numbered, running_sum, time_chunk, value_counts
from kerbside.streaming.progress import progress_lag

from .helpers import naive, ts

T0 = ts("2026-09-30 11:00:00")


def nearest(values, p):
    values = sorted(values)
    return values[min(len(values), max(1, math.ceil(p / 100 * len(values)))) - 1]


def test_percentiles_of_one_to_hundred(spark):
    row = T.percentiles(spark.range(1, 101), [], "id").first()
    assert (row.p50, row.p95, row.p99) == (50, 95, 99)
    assert T.percentiles(spark.range(7, 8), [], "id").first().p99 == 7
    assert T.percentiles(spark.range(0), [], "id").first().p50 is None


@pytest.mark.parametrize("seed", range(3))
def test_percentiles_and_median_match_sorting(spark, seed):
    rng = random.Random(seed)
    groups = {
        "narrow": [rng.randint(0, 5) for _ in range(rng.randint(1, 400))],
        "wide": [rng.randint(-(10**9), 10**9) for _ in range(rng.randint(1, 400))],
        "tail": [int(rng.paretovariate(0.3)) for _ in range(rng.randint(1, 400))],
        "single": [rng.randint(0, 10)],
    }
    df = spark.createDataFrame([(g, v) for g, vs in groups.items() for v in vs], "g string, v long")
    got = {r.g: r for r in T.percentiles(df, ["g"], "v", (1, 50, 95, 99, 100)).collect()}
    middle = {r.g: r.median for r in T.median(df, ["g"], "v").collect()}
    for g, vs in groups.items():
        assert [got[g][f"p{p}"] for p in (1, 50, 95, 99, 100)] == [nearest(vs, p) for p in (1, 50, 95, 99, 100)]
        assert middle[g] == sorted(vs)[len(vs) // 2]


def test_ranks_of_many_wide_values_and_null_keys(spark):
    """A million values a million apart in one key: no group that is ordered in one piece exceeds one digit."""
    n = 1_000_000
    df = spark.range(n).select(F.lit(1).alias("g"), (F.col("id") * 1_000_000 - 7 * 10**11).alias("v"))
    counts = value_counts(df, ["g"], "v")
    blocks = fewer_digits(counts)
    for level in (counts, blocks):
        pieces = level.groupBy("_k", F.shiftright("_p", 16)).count()
        assert pieces.agg(F.max("count")).first()[0] <= 65_536
    assert fewer_digits(blocks).count() < 300
    row = T.percentiles(df, ["g"], "v", (1, 50, 99)).first()
    assert [row.p1, row.p50, row.p99] == [(n * p // 100 - 1) * 1_000_000 - 7 * 10**11 for p in (1, 50, 99)]
    ends = spark.createDataFrame([(None, -(2**63)), (None, 2**63 - 1), (None, 0), (5, None)], "g int, v long")
    assert [tuple(r) for r in T.percentiles(ends, ["g"], "v", (1, 50, 100)).collect()] == [(None, 3, -(2**63), 0, 2**63 - 1)]


def test_ordered_helpers_across_chunks(spark):
    rng = random.Random(5)
    data = []
    for k in ("a", "b"):
        at = T0
        for _ in range(60):
            at += timedelta(minutes=rng.choice([1, 5, 2000]))
            data.append((k, at, rng.randint(0, 9)))
    df = spark.createDataFrame(data, "k string, at timestamp, v long").withColumn("chunk", time_chunk("at"))
    near = {(r.k, r.at): r for r in neighbours(df, ["k"], "at", ["v"]).collect()}
    sums = {(r.k, r.at): r.s for r in running_sum(df, ["k"], "at", "v", "s").collect()}
    ranks = {(r.k, r.at): r.n for r in numbered(df, ["k"], "at", "n").collect()}
    for k in ("a", "b"):
        seq = [(naive(at), v) for key, at, v in data if key == k]
        by_time = {naive(at): r for (key, at), r in near.items() if key == k}
        local = lambda d: {naive(at): x for (key, at), x in d.items() if key == k}  # noqa: E731, B023
        for i, (at, _) in enumerate(seq):
            assert by_time[at].prev_v == (seq[i - 1][1] if i else None)
            assert by_time[at].next_v == (seq[i + 1][1] if i + 1 < len(seq) else None)
            assert local(sums)[at] == sum(v for _, v in seq[: i + 1])
            assert local(ranks)[at] == i + 1


def test_lag(spark):
    ends = spark.createDataFrame([(0, 0, 100), (1, 0, 50)], "partition int, low long, high long")
    done = spark.createDataFrame([(0, 90), (1, 50)], "partition int, offset long")
    assert T.consumer_lag(ends, done).first().lag == 10
    retained = spark.createDataFrame([(0, 40, 100)], "partition int, low long, high long")
    assert T.consumer_lag(retained, done.limit(0)).first().lag == 60
    never = spark.createDataFrame([(0, -1)], "partition int, offset long")
    assert T.consumer_lag(retained, never).first().lag == 60


def test_progress_lag():
    source = {"endOffset": '{"counts":{"4":712,"5":31}}', "latestOffset": '{"counts":{"4":750,"5":31,"6":909}}'}
    # Partition 6 has no progress; the broker still holds it from 900 on.
    assert progress_lag({"sources": [source]}, {"counts": {"6": 900, "4": 0}}) == 38 + 9
    assert progress_lag({"sources": [source]}) == -1
    assert progress_lag({"sources": [{"endOffset": None, "latestOffset": None}]}) == -1


def test_packing_is_oldest_first(spark):
    rng = random.Random(2)
    data = [("a", T0 + timedelta(minutes=i * 97)) for i in range(1203)] + [("b", T0)]
    rng.shuffle(data)
    packed = T.pack_batches(spark.createDataFrame(data, "device_id string, interval_start timestamp"))
    sizes = packed.groupBy("device_id", "batch_no").count().orderBy("device_id", "batch_no").collect()
    assert [tuple(r) for r in sizes] == [("a", 0, 500), ("a", 1, 500), ("a", 2, 203), ("b", 0, 1)]
    first = packed.filter("device_id = 'a' and batch_no = 0").agg(F.max("interval_start").alias("m")).first().m
    assert naive(first) == naive(T0 + timedelta(minutes=499 * 97))


def test_ingest_rollup_and_delays(spark):
    schema = "ts timestamp, inserted long, duplicates long, skipped long, store_retries long, flush_ms long"
    data = [(T0, 10, 1, 0, 0, 5), (T0 + timedelta(seconds=9), 20, 0, 2, 1, 7), (T0 + timedelta(seconds=10), 0, 0, 0, 0, 1)]
    batches = spark.createDataFrame(data, schema)
    got = [tuple(r)[1:] for r in T.ingest_rollup(batches).orderBy("time").collect()]
    assert got == [(2, 30, 1, 2, 1, 16), (1, 0, 0, 0, 0, 0)]
    assert [tuple(r)[1:] for r in T.flush_times(batches).orderBy("time").collect()] == [(5, 7), (1, 1)]
    rows = spark.createDataFrame(
        [(T0 + timedelta(milliseconds=d), T0) for d in (770, 1021, 3)], "stored_at timestamp, accepted_at timestamp"
    )
    assert [tuple(r)[1:] for r in T.end_to_end_delay(rows).collect()] == [(770, 1021)]


def test_request_windows_count_latency_of_answers_only(spark):
    schema = "ts timestamp, status int, error string, latency_ms long, n_readings long, queued long"
    data = [
        (T0, 200, None, 5, 2, 2),
        (T0, 200, None, 6, 1, 1),
        (T0, 400, None, 7, 3, None),
        (T0, 503, None, 9, 1, None),
        (T0, None, "timeout", 5000, 4, None),
        (T0, None, "refused", 1, 4, None),
        (T0 + timedelta(seconds=10), None, "timeout", 5000, 1, None),
    ]
    windows = T.with_rate(T.request_windows(spark.createDataFrame(data, schema), 10), 10)
    first, second = [r.asDict() for r in windows.orderBy("window_start").collect()]
    first.pop("window_start")
    assert first == {
        "requests": 6, "readings_sent": 15, "queued": 3, "status200": 2, "status400": 1, "status5xx": 1,
        "timeouts": 1, "network_errors": 1, "answered": 4, "p50": 6, "p95": 9, "p99": 9, "sent_per_s": 1.5,
    }
    assert (second["p50"], second["answered"], second["timeouts"]) == (0, 0, 1)
