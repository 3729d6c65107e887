import random
from datetime import timedelta

import pytest
from pyspark.sql import functions as F

from kerbside.operators import devices as D
from kerbside.operators import panels as P

from .helpers import devices, later, naive, stored, ts

T0 = ts("2026-09-30 11:00:00")


def table(spark, items):
    data = [(d, at, v, later(at, 61)) for d, at, v in items]
    return spark.createDataFrame(data, "device_id string, interval_start timestamp, vehicles int, stored_at timestamp")


@pytest.fixture(scope="module")
def three_minutes(spark):
    items = [("a", later(T0, 15 * i), i) for i in range(12)] + [("b", later(T0, 60 * i), 100) for i in range(3)]
    return table(spark, items).cache()


def bins(df, column):
    return [(naive(r.time).strftime("%H:%M"), r[column]) for r in df.orderBy("time").collect()]


def test_vehicles_per_device_and_city_wide(three_minutes):
    one = P.device_range(three_minutes, "a", "2026-09-30 11:00:00", "2026-09-30 11:02:00")
    assert bins(P.vehicles_per_bin(one), "vehicles") == [("11:00", 6), ("11:01", 22), ("11:02", 8)]
    assert bins(P.vehicles_per_bin(one, 900), "vehicles") == [("11:00", 36)]
    assert bins(P.vehicles_per_bin(three_minutes), "vehicles") == [("11:00", 106), ("11:01", 122), ("11:02", 138)]


def test_ingest_rate_follows_storage_time(three_minutes):
    assert bins(P.ingest_rate(three_minutes), "rows") == [("11:01", 5), ("11:02", 5), ("11:03", 5)]


def test_completeness(spark, three_minutes):
    dim = devices(spark, ("a", 15), ("b", 60))
    lossy = three_minutes.filter(F.col("interval_start") != later(T0, 75))
    got = [(r.rows, r.expected, r.is_complete) for r in P.completeness(lossy, dim).orderBy("time").collect()]
    assert got == [(5, 5, True), (4, 5, False), (5, 5, True)]


def test_expected_rate(spark):
    dim = D.seed_devices(spark, 20_000)
    row = D.expected_rate(dim).first()
    assert (row.devices, row.readings_per_min) == (20_000, 50_000)
    assert round(row.readings_per_s, 1) == 833.3


def test_seed_devices(spark, rows):
    seeded = D.seed_devices(spark, 40)
    assert rows(seeded.filter("device_id in ('dev-00020', 'dev-00021')")) == [
        ("dev-00020", "Sensor 20", 15),
        ("dev-00021", "Sensor 21", 60),
    ]
    assert D.missing_devices(seeded, seeded.filter("interval_seconds = 15")).count() == 20
    assert D.missing_devices(seeded, seeded).count() == 0


def test_missing_intervals_against_the_full_grid(spark):
    rng = random.Random(7)
    start, hours = ts("2026-09-29 22:30:00"), 27
    end = start + timedelta(hours=hours)
    dim = {"a": 15, "b": 60, "never": 60, "full": 60}
    grid = {(d, start + timedelta(seconds=s * i)) for d, s in dim.items() for i in range(hours * 3600 // s)}
    held = [
        (d, at)
        for d, at in sorted(grid)
        if d == "full" or (d != "never" and rng.random() < 0.6 and not 30_000 < (at - start).total_seconds() < 60_000)
    ]
    df = table(spark, [(d, at, 1) for d, at in held])
    args = (df, devices(spark, *dim.items()), "2026-09-29 22:30:00", "2026-10-01 01:30:00")
    assert end == ts("2026-10-01 01:30:00")
    got = {(r.device_id, naive(r.interval_start)) for r in P.missing_intervals(*args).collect()}
    assert got == {(d, naive(at)) for d, at in grid - set(held)}
    ranges = P.missing_ranges(*args).collect()
    assert sum(r.n_missing for r in ranges) == len(got)
    never = [r for r in ranges if r.device_id == "never"]
    assert [(r.n_missing, naive(r.missing_to)) for r in never] == [(hours * 60, naive(end))]


def test_send_store_gap_runs_over_days(spark):
    rng = random.Random(1)
    sent = [ts("2026-09-29 23:50:00") + timedelta(seconds=rng.randint(0, 3000)) for _ in range(200)]
    put = [at + timedelta(seconds=rng.randint(0, 600)) for at in sent]
    out = spark.createDataFrame([(a,) for a in sent], "accepted_at timestamp")
    into = spark.createDataFrame([(a,) for a in put], "stored_at timestamp")
    got = P.send_store_gap(out, into).orderBy("time").collect()
    minute = lambda t: naive(t).replace(second=0)
    for r in got:
        at = naive(r.time)
        assert r.sent == sum(minute(a) == at for a in sent)
        assert r.backlog == sum(minute(a) <= at for a in sent) - sum(minute(a) <= at for a in put)
    assert got[-1].backlog == 0


def test_time_range_prunes_dates(spark, tmp_path):
    path = str(tmp_path / "t")
    df = stored(spark, *[("a", f"2026-09-{d} 11:00:00", 1) for d in range(10, 20)])
    df.withColumn("event_date", F.to_date("interval_start")).write.partitionBy("event_date").parquet(path)
    some = P.device_range(spark.read.parquet(path), "a", "2026-09-12 00:00:00", "2026-09-13 12:00:00")
    assert some.count() == 2
    plan = some._jdf.queryExecution().executedPlan().toString()
    partition_filters = plan.split("PartitionFilters: ")[1].split("PushedFilters")[0]
    assert ">= 2026-09-12" in partition_filters and "<= 2026-09-13" in partition_filters
    assert "EqualTo(device_id,a)" in plan and "GreaterThanOrEqual(interv" in plan


def test_time_range_finds_the_day_in_any_session_zone(spark, tmp_path):
    path = str(tmp_path / "t")
    df = stored(spark, ("a", "2031-03-03 23:40:00", 1), ("a", "2031-03-04 00:10:00", 2))
    df.withColumn("event_date", F.to_date("interval_start")).write.partitionBy("event_date").parquet(path)
    zone = spark.conf.get("spark.sql.session.timeZone")
    try:
        for other in ("Europe/Berlin", "America/Lima"):
            spark.conf.set("spark.sql.session.timeZone", other)
            low = F.timestamp_micros(F.unix_micros(F.lit(ts("2031-03-03 23:30:00"))))
            rows = P.time_range(spark.read.parquet(path), low, low + F.expr("INTERVAL '15' MINUTE"))
            assert [r.vehicles for r in rows.collect()] == [1]
    finally:
        spark.conf.set("spark.sql.session.timeZone", zone)
