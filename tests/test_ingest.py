import random

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from kerbside.operators import ingest as I
from kerbside.operators.scale import absent_keys, lookup
from kerbside.sources.bucketed import read_bucketed, write_bucketed

from .helpers import devices, messages, naive, stored, ts

T0, T1, T2 = "2031-03-04 06:19:45", "2031-03-04 06:20:00", "2031-03-04 06:20:15"


def run(batch, table):
    probed = I.probe(I.first_writes(batch), table)
    return probed, tuple(I.counters(probed).first())


def test_what_is_stored_decides_over_the_batch(spark, rows):
    table = stored(spark, ("east", T0, 3), ("east", T2, 8), ("west", T2, 8))
    # East: an equal copy and two other counts of a stored interval, a new interval; west: an equal copy; north: new.
    batch = messages(spark, ("east", T0, 4), ("east", T1, 1), ("east", T0, 3), ("west", T2, 8), ("north", T2, 0), ("east", T0, 4))
    probed, counts = run(batch, table)
    assert counts == (2, 4)
    assert rows(I.new_rows(probed), "device_id", "vehicles", "offset") == [("east", 1, 1), ("north", 0, 4)]
    assert rows(I.duplicate_keys(probed), "device_id", "duplicates") == [("east", 3), ("west", 1)]
    found = I.conflicts(batch, probed)
    assert rows(found, "device_id", "stored_vehicles", "incoming_vehicles", "messages", "first_offset") == [("east", 3, 4, 2, 0)]
    assert naive(found.first().interval_start) == ts(T0).replace(tzinfo=None)


def test_copies_within_a_batch(spark, rows):
    values = [6, 2, 6, 2, 5]
    batch = messages(spark, *[("east", T1, v) for v in values])
    probed, counts = run(batch, stored(spark).limit(0))
    assert counts == (1, len(values) - 1)
    assert rows(I.new_rows(probed), "vehicles", "offset") == [(6, 0)]
    assert I.conflicts(batch, probed).count() == 0
    inside = I.conflicts(batch, probed, include_in_batch=True)
    assert rows(inside, "stored_vehicles", "incoming_vehicles", "messages", "first_offset") == [(6, 2, 2, 1), (6, 5, 1, 4)]


def test_rows_that_break_a_rule_of_the_table(spark, rows):
    schema = "device_id string, interval_start timestamp, vehicles double, accepted_at timestamp, offset long"
    cases = [("east", T0, 0.0, None), ("ghost", T0, 1.0, "unknown device"), (None, T0, 1.0, "unknown device"),
             ("east", None, 1.0, "no interval start"), ("east", T0, None, "vehicles out of range"), ("east", T0, -1.0, "vehicles out of range"),
             ("east", T0, 2.0**31, "vehicles out of range"), ("east", T0, 1e300, "vehicles out of range"), ("east", T1, 2.0**31 - 1, None)]
    data = [(d, s and ts(s), v, ts(T2), i) for i, (d, s, v, _) in enumerate(cases)]
    batch, dim = spark.createDataFrame(data, schema), devices(spark, ("east", 15))
    good, bad = I.split_by_constraints(batch, dim)
    assert rows(good, "offset", "vehicles") == [(0, 0), (8, 2**31 - 1)]
    assert rows(bad, "offset", "reason") == [(i, r) for i, (*_, r) in enumerate(cases) if r]
    probed = I.probe(I.first_writes(good), stored(spark).limit(0))
    counters = I.batch_counters(batch, dim, probed, F.lit(1))
    assert rows(counters) == [(1, 2, 0, 7)]


def test_a_device_table_too_large_to_broadcast_gives_the_same_rows(spark, rows):
    fact = spark.range(2000).select(F.concat(F.lit("d"), F.when(F.col("id") < 900, 1).otherwise(F.col("id") % 50)).alias("device_id"), "id")
    dim = spark.range(30).select(F.concat(F.lit("d"), "id").alias("device_id"), F.lit(15).alias("interval_seconds"))
    for how in ("left", "inner", "left_anti", "left_semi"):
        salted = lookup(fact, dim, "device_id", how, max_bytes=0)
        assert "_salt" in salted._jdf.queryExecution().analyzed().toString()
        assert rows(salted) == rows(lookup(fact, dim, "device_id", how))


def test_bucketed_tables_are_joined_where_they_lie(spark, rows):
    fact = spark.range(3000).select(F.concat(F.lit("d"), F.col("id") % 50).alias("device_id"), "id")
    dim = spark.range(40).select(F.concat(F.lit("d"), "id").alias("device_id"), F.lit(15).alias("interval_seconds"))
    names = ("bucketed_readings", "bucketed_devices")
    try:
        for name, df in zip(names, (fact, dim), strict=True):
            write_bucketed(df, name, "device_id", 6)
        sides = [read_bucketed(spark, name) for name in names]
        for how in ("left", "inner", "left_anti"):
            joined = lookup(*sides, "device_id", how, max_bytes=0)
            assert rows(joined) == rows(lookup(fact, dim, "device_id", how))
            plan = joined._jdf.queryExecution().executedPlan().toString()
            assert "Exchange" not in plan and "_salt" not in plan
    finally:
        for name in names:
            spark.sql(f"DROP TABLE IF EXISTS {name}")


def test_reconcile(spark):
    a = stored(spark, ("d", T0, 1), ("d", T1, 2))
    assert tuple(I.reconcile(a, a).first()) == (2, 3, 2, 3, True)
    assert tuple(I.reconcile(a, a.limit(1)).first())[-1] is False


def fold(items, table):
    """First write wins, one by one."""
    held = dict(table)
    accepted = 0
    for device, start, vehicles in items:
        if (device, start) not in held:
            held[device, start] = vehicles
            accepted += 1
    return held, accepted


KEYS = st.tuples(st.sampled_from(["a", "b", "c"]), st.sampled_from([T0, T1, T2]), st.integers(0, 3))


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(KEYS, min_size=1, max_size=30), st.integers(0, 8))
def test_any_split_into_batches_and_any_replay_gives_the_same_table(spark, items, cut):
    before, _ = fold(items[:cut], {})
    table = stored(spark, *[(d, s, v) for (d, s), v in before.items()] or [("z", T0, 0)])
    expected, accepted = fold(items, before)
    # The batch replays the prefix that is already stored.
    probed, counts = run(messages(spark, *items), table)
    assert counts == (accepted, len(items) - accepted)
    new = {(r.device_id, naive(r.interval_start)): r.vehicles for r in I.new_rows(probed).collect()}
    assert new == {(d, ts(s).replace(tzinfo=None)): v for (d, s), v in expected.items() if (d, s) not in before}


def test_a_key_holding_most_messages_is_folded(spark):
    n = 20_000
    hot = spark.range(n).select(
        F.lit("hot").alias("device_id"),
        F.lit(ts(T0)).alias("interval_start"),
        F.col("id").cast("int").alias("vehicles"),
        F.lit(ts(T1)).alias("accepted_at"),
        (F.lit(n) - F.col("id")).alias("offset"),
    )
    probed, counts = run(hot, stored(spark).limit(0))
    assert counts == (1, n - 1)
    assert probed.first().vehicles == n - 1


def test_batch_counters_match_a_sequential_fold(spark, rows):
    rng = random.Random(3)
    items = [(rng.choice(["a", "b", "ghost"]), rng.choice([T0, T1, T2]), rng.randint(0, 2)) for _ in range(40)]
    batch = messages(spark, *items)
    dim = devices(spark, ("a", 15), ("b", 15))
    good, _ = I.split_by_constraints(batch, dim)
    probed = I.probe(I.first_writes(good), stored(spark, ("a", T0, 1)))
    got = I.batch_counters(
        batch.withColumn("accepted_at", F.timestamp_seconds(F.expr("offset div 10"))), dim,
        probed.withColumn("accepted_at", F.timestamp_seconds(F.expr("offset div 10"))), F.unix_seconds("accepted_at"),
    )
    expected, held = [], {("a", T0)}
    for b in range(4):
        inserted = duplicates = skipped = 0
        for device, start, _ in items[b * 10 : b * 10 + 10]:
            if device == "ghost":
                skipped += 1
            elif (device, start) in held:
                duplicates += 1
            else:
                held.add((device, start))
                inserted += 1
        expected.append((b, inserted, duplicates, skipped))
    assert rows(got) == expected


def test_a_dimension_beyond_the_limit_is_never_broadcast(spark):
    """Adaptive execution must not broadcast the salted copies either, however small they are when shuffled."""
    fact = spark.range(3000).select(F.concat(F.lit("d"), F.col("id") % 50).alias("device_id"), "id")
    dim = spark.range(40).select(F.concat(F.lit("d"), "id").alias("device_id"), F.lit(True).alias("is_known"))
    joined = lookup(fact, dim, "device_id", "left", max_bytes=0)
    assert sum(r.is_known is None for r in joined.collect()) == 600
    assert "Broadcast" not in joined._jdf.queryExecution().executedPlan().toString()


def test_messages_are_not_moved_to_find_the_unknown_devices(spark, rows, tmp_path):
    batch = messages(spark, ("a", T0, 1), ("ghost", T0, 2), ("b", T0, 3), ("ghost", T0, 4))
    batch = batch.unionByName(batch.limit(1).withColumn("device_id", F.lit(None).cast("string")))
    batch.write.parquet(f"{tmp_path}/batch")
    batch = spark.read.parquet(f"{tmp_path}/batch")
    dim = devices(spark, ("a", 15), ("b", 60), ("c", 15))
    absent_keys(batch, dim, "device_id").write.parquet(f"{tmp_path}/unknown")
    unknown = spark.read.parquet(f"{tmp_path}/unknown")
    assert rows(unknown) == [("ghost",), (None,)]
    for ids in (unknown, None):
        good, bad = I.split_by_constraints(batch, dim, ids)
        assert rows(good, "device_id", "vehicles") == [("a", 1), ("b", 3)]
        assert rows(bad, "device_id", "vehicles", "reason") == [
            ("ghost", 2, "unknown device"),
            ("ghost", 4, "unknown device"),
            (None, 1, "unknown device"),
        ]
    good, _ = I.split_by_constraints(batch, dim, unknown)
    assert "Exchange hash" not in good._jdf.queryExecution().executedPlan().toString()


def test_only_disputed_keys_are_looked_at_for_conflicts(spark, rows):
    batch = messages(spark, ("a", T0, 5), ("a", T0, 5), ("b", T0, 1), ("b", T0, 2), ("c", T0, 9))
    probed = I.probe(I.first_writes(batch), stored(spark, ("a", T0, 5), ("b", T0, 1)))
    assert rows(I.disputed(probed), "device_id", "stored_vehicles") == [("b", 1)]
    assert rows(I.conflicts(batch, probed), "device_id", "incoming_vehicles", "messages") == [("b", 2, 1)]
