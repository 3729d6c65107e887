import csv
import json
import random

import pytest
from pyspark.sql import functions as F

from kerbside.operators import samples as S
from kerbside.schema import SAMPLE_COLUMNS
from kerbside.sources import host_stats as H
from kerbside.sources import sample_csv, snapshots

from .helpers import ts


def sample(spark, **cells):
    return spark.createDataFrame([tuple(cells.values())], list(cells))


def test_csv_round_trip_quotes_and_keeps_empty_cells(spark, tmp_path):
    path = str(tmp_path / "samples")
    one = sample(spark, timestamp="2031-03-04T06:00:00.000Z", elapsed_min=7.5, buffered=1, sim_devices='"x", y\n\n,z"')
    for n in (1, 2, 3):
        sample_csv.append_samples(one.withColumn("buffered", F.lit(n)), path)
    got = sorted(sample_csv.read_samples(spark, path).collect(), key=lambda r: r.buffered)
    assert [r.buffered for r in got] == ["1", "2", "3"]
    assert {(r.timestamp, r.elapsed_min, r.sim_devices) for r in got} == {("2031-03-04T06:00:00.000Z", "7.5", '"x", y\n\n,z"')}
    assert (got[0].pg_cpu_pct, tuple(got[0].__fields__)) == (None, SAMPLE_COLUMNS)


def test_csv_written_by_others(spark, tmp_path):
    path = tmp_path / "metrics.csv"
    path.write_text(",".join(SAMPLE_COLUMNS) + '\r\nlate,8,\r\n\r\n"""q"" r",,44\r\n', newline="")
    got = sample_csv.read_samples(spark, str(path)).collect()
    assert [(r.timestamp, r.elapsed_min, r.rows_approx, r.total_mib) for r in got] == [
        ("late", "8", None, None),
        ('"q" r', None, "44", None),
    ]


def test_header_only_file_has_no_samples(spark, tmp_path):
    path = tmp_path / "metrics.csv"
    path.write_text(",".join(SAMPLE_COLUMNS) + "\n")
    assert sample_csv.read_samples(spark, str(path)).count() == 0


def test_append_refuses_other_columns(spark, tmp_path):
    path = tmp_path / "samples"
    path.mkdir()
    (path / "part.csv").write_text("timestamp,other\n1,2\n")
    with pytest.raises(sample_csv.SchemaMismatch):
        sample_csv.append_samples(sample(spark, timestamp="x"), str(path))


def test_host_stats_with_mark_and_repeated_waits(spark, tmp_path, rows):
    path = tmp_path / "stats.csv"
    text = (
        "time_utc,api_cpu_pct,pg_cpu,pg_mem,pg_waits\n06:00:01,7,0.4%,2.5GiB / 4GiB,Lock:3\n"
        "06:00:02,,n.a.,-,\n06:00:03,100,99%,512kB / 1MB,Lock:1 IO:2 Lock:4 IO:1\n"
    )
    path.write_bytes(text.encode("utf-8-sig"))
    stats = H.read_host_stats(spark, str(path))
    assert rows(stats.drop("pg_waits")) == [("06:00:01", 7, 0.4, 2560.0), ("06:00:02", None, None, None), ("06:00:03", 100, 99.0, 0.5)]
    assert rows(H.wait_counts(stats)) == [("06:00:01", "Lock", 3), ("06:00:03", "IO", 3), ("06:00:03", "Lock", 5)]


def snapshot(source, written, **members):
    return json.dumps({"source": source, "writtenAt": written, "windowSeconds": 4} | members)


def test_latest_snapshot(spark, tmp_path):
    counters = dict(zip(("p50", "p95", "p99", "status400", "status5xx", "timeouts", "networkErrors", "buffered"), range(11, 19), strict=True))
    lines = [
        snapshot("east", "2031-03-04T06:00:08.000Z", deviceCount=50, readingsSent=333, **counters),
        snapshot("east", "2031-03-04T06:00:04.000Z", deviceCount=49, readingsSent=1),
        snapshot("east", "oops", deviceCount=48, readingsSent=2),
        snapshot("north", "2031-03-04T06:00:00Z", deviceCount=1, readingsSent=5, windowSeconds=0),
        snapshot("west", "never", deviceCount=2),
    ]
    path = tmp_path / "s.json"
    path.write_text("\n".join(lines))
    got = S.latest_snapshots(snapshots.read_snapshots(spark, str(path)), ts("2031-03-04 06:00:20.6")).orderBy("source").collect()
    assert tuple(got[0]) == ("east", 50, 13, 83.3, *range(11, 19))
    assert [(r.source, r.sim_devices, r.sim_age_s, r.sent_per_s) for r in got[1:]] == [("north", 1, 21, None), ("west", 2, None, None)]


def test_samples_are_assembled_with_gaps(spark):
    at = ["2031-03-04 06:00:00", "2031-03-04 06:12:30", "2031-03-04 07:59:40"]
    times = spark.createDataFrame([(ts(t),) for t in at], "timestamp timestamp")
    ages = spark.createDataFrame([(ts(at[1]), 60), (ts(at[2]), 6000)], "timestamp timestamp, sim_age_s int")
    got = S.sample_report(S.with_elapsed(S.assemble(times, [ages]))).orderBy("timestamp").collect()
    assert [(r.elapsed_min, r.elapsed_whole_min, r.sim_age_s, r.is_stale) for r in got] == [
        (0.0, 0, None, False),
        (12.5, 13, 60, False),
        (119.7, 120, 6000, True),
    ]


def test_city_wide_query_is_timed(spark):
    rows = spark.createDataFrame([("lane", ts("2031-03-04 06:00:00"), 8)], "device_id string, interval_start timestamp, vehicles int")
    assert S.city_wide_ms(rows, ts("2031-03-04 06:59:00"), 1) > 0


def test_table_profile(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(1000).repartition(3).write.parquet(path)
    size = sum(f.stat().st_size for f in (tmp_path / "t").glob("*.parquet"))
    profile = S.table_profile(spark, path)
    row = profile.first()
    assert (row.rows_approx, row.index_mib) == (1000, None)
    assert row.total_mib == round(size / 2**20, 1)
    # The counts of the footers, and no column.
    plan = profile._jdf.queryExecution().executedPlan().toString()
    assert "PushedAggregation: [COUNT(*)]" in plan and "content" not in plan


@pytest.mark.parametrize("seed", range(2))
def test_quoted_csv_is_read_by_many_tasks(spark, tmp_path, seed):
    """One file in splits of a few kilobytes: cells with quotes, separators, line breaks and blank lines inside."""
    rng = random.Random(seed)
    cells = ["", "7", "a,b", 'say "x"', "two\nlines", "\r\n", '"', "é\n\n\nü", " "]
    table = [[rng.choice(cells) for _ in SAMPLE_COLUMNS] for _ in range(1500)]
    for row in table:
        row[0] = rng.choice(("t", "long " * 50 + "\n" + '"' * rng.randint(0, 5)))
    path = tmp_path / "large.csv"
    with path.open("w", newline="", encoding="utf-8") as out:
        writer = csv.writer(out, lineterminator=rng.choice(("\n", "\r\n")))
        writer.writerow(SAMPLE_COLUMNS)
        for i, row in enumerate(table):
            writer.writerow(row)
            if i % 100 == 0:
                out.write("\n")
    small, before = "spark.sql.files.maxPartitionBytes", spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set(small, "16k")
    try:
        read = sample_csv.read_samples(spark, str(path))
        got = [tuple(c or "" for c in r) for r in read.collect()]
        assert spark.read.text(str(path)).rdd.getNumPartitions() > 10
        numbers = sample_csv.records(spark, str(path)).select("record").collect()
    finally:
        spark.conf.set(small, before)
    assert sorted(got) == sorted(tuple(row) for row in table)
    assert sorted(r.record for r in numbers) == list(range(1, len(numbers) + 1))
