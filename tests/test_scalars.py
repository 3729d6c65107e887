import random
from decimal import ROUND_HALF_UP, Decimal

from pyspark.sql import functions as F

from kerbside.functions import scalars as S
from kerbside.functions import times as T
from kerbside.sources import host_stats as H


def test_device_ids_keep_long_numbers(spark):
    cases = {0: "dev-00000", 305: "dev-00305", 40_000: "dev-40000", 7_654_321: "dev-7654321"}
    df = spark.createDataFrame([(n,) for n in cases], "n long")
    assert {r.n: r.d for r in df.select("n", S.device_id("n").alias("d")).collect()} == cases


def test_byte_sizes(spark):
    units = {"b": 1, "kB": 10**3, "mb": 10**6, "GB": 10**9, "TB": 10**12, "KiB": 2**10, "mib": 2**20, "GIB": 2**30, "TiB": 2**40}
    cases = {f"{n}{gap}{unit}": n * size for n in (0.25, 12.0) for gap in ("", "  ") for unit, size in units.items()}
    cases |= {text: None for text in ("", "12", "kB", "1,5kB", "2..5GB", "3 PiB", "-1B", "none")}
    df = spark.createDataFrame([(c,) for c in cases], "s string")
    assert {r.s: r.b for r in df.select("s", S.byte_size("s").alias("b")).collect()} == cases


def test_container_stats(spark):
    lines = [
        '{"MemPerc":"81.5%","Name":"db","CPUPerc":"140.07%","MemUsage":"1.25GiB / 2GiB"}',
        '{"CPUPerc":"","MemUsage":"?"}',
        "[",
    ]
    df = H.container_stats(spark.createDataFrame([(line,) for line in lines], "value string"))
    got = {r.value: (r.pg_cpu_pct, r.pg_mem_mib, r.pg_mem_pct) for r in df.collect()}
    assert [got[line] for line in lines] == [(140.07, 1280.0, 81.5), (None, None, None), (None, None, None)]


def exact(x, digits):
    step = Decimal(1).scaleb(-digits)
    return float(Decimal(x).quantize(step, rounding=ROUND_HALF_UP))


def test_to_fixed_rounds_the_binary_value(spark):
    rng = random.Random(11)
    values = [1.005, 0.05, 0.15, 0.25, 0.35, 2.5, -0.25, -1.005, 0.0, 0.49999999999999994, 1e9 + 0.05, 8.345]
    values += [rng.randint(0, 10**6) / 10 ** rng.randint(1, 4) for _ in range(400)] + [rng.random() * 1000 for _ in range(200)]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    for digits in (0, 1, 2):
        got = {r.x: r.y for r in df.select("x", S.to_fixed("x", digits).alias("y")).collect()}
        assert {v: got[v] for v in values} == {v: exact(v, digits) for v in values}


def test_to_fixed_keeps_numbers_without_a_fraction(spark):
    values = [2.0**52, -(2.0**53) - 2, 1e19, -1e19, 1.5e300, 2.0**51 + 0.5]
    df = spark.createDataFrame([(v,) for v in values], "x double")
    assert [r.y for r in df.select(S.to_fixed("x", 1).alias("y")).collect()] == values


def test_next_boundary_is_strictly_later(spark):
    cases = {ms: (ms // 15_000 + 1) * 15_000 for ms in (0, 1, 29_999, 30_000, 1_930_371_555_000, 1_930_371_555_001)}
    df = spark.createDataFrame([(c,) for c in cases], "ms long")
    assert {r.ms: r.b for r in df.select("ms", T.next_boundary_ms("ms", 15).alias("b")).collect()} == cases


def test_window_start_snaps_to_the_grid(spark):
    cases = {40_000 + late: 30_000 for late in (-5_000, -1, 0, 17, 4_999)} | {45_000: 40_000, 1_930_371_560_123: 1_930_371_550_000}
    df = spark.createDataFrame([(c,) for c in cases], "e long")
    got = {r.e: r.s for r in df.select("e", T.window_start_ms("e", F.lit(10_000).cast("long")).alias("s")).collect()}
    assert got == cases


def test_bins_count_from_the_year_2000(spark):
    df = spark.sql("select timestamp'2026-09-30 11:07:31' as t, timestamp_ntz'2026-09-30 11:07:31' as n")
    row = df.select(T.bin_start("t", 60).alias("m"), T.floor_to("t", 15).alias("q")).first()
    assert (row.m.minute, row.m.second, row.q.second) == (7, 0, 30)
    assert df.select(T.bin_start("n", 900).alias("m")).first().m.minute == 0
    # Seven minutes do not divide a day, so the origin shows.
    seven = df.select(T.epoch_ms(T.bin_start("t", 420)).alias("ms")).first().ms
    assert (seven // 1000 - T.BIN_ORIGIN) % 420 == 0


def test_iso_text(spark):
    df = spark.sql("select timestamp'2026-09-30 11:00:45' as a, timestamp'2026-09-30 11:00:45.25' as b")
    row = df.select(T.iso_seconds("a"), T.iso_millis("a"), T.iso_seconds("b")).first()
    assert tuple(row) == ("2026-09-30T11:00:45Z", "2026-09-30T11:00:45.000Z", "2026-09-30T11:00:45.250Z")
    assert S.STALE_AFTER_SECONDS == 60


def test_key_partition_is_stable(spark):
    df = spark.range(1000).select(S.device_id("id").alias("d")).withColumn("p", S.key_partition("d", 6))
    assert df.union(df).groupBy("d").agg(F.countDistinct("p").alias("n")).filter("n > 1").count() == 0
    assert df.select("p").distinct().count() == 6
