import zlib
from collections import defaultdict

import numpy as np
import pandas as pd

from kerbside.llm import sharding

from .corpus import corpus, table


def test_rows_sizes_and_gapless_slots(spark):
    rows = corpus(4, 300)
    got = sharding.shard_table(table(spark, rows)).collect()
    assert sorted((str(g.doc_id), g.size, g.text_crc32) for g in got) == sorted(
        (str(r[0]), len((r[1] or "").encode()) + 8, zlib.crc32((r[1] or "").encode())) for r in rows
    )
    slots = defaultdict(list)
    for g in got:
        assert (g.law, g.grown_shard) == ("bytes", None)
        slots[g.shard].append(g.slot)
    assert all(0 <= s < 24 for s in slots)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values())
    again = sharding.shard_table(table(spark, rows[::-1]).repartition(5)).collect()
    key = lambda g: (str(g.doc_id), g.text_crc32, g.shard, g.slot)
    assert sorted(map(key, got)) == sorted(map(key, again))


def test_columns_stay_and_clashing_ones_are_replaced(spark):
    docs = table(spark, [(1, "x"), (2, None), (2, None)]).selectExpr("*", "'old' as shard", "9 as extra")
    got = sharding.assign(docs)
    assert got.columns == ["doc_id", "text", "lang", "source", "n_chars", "extra", "shard", "slot"]
    assert got.count() == 3
    assert sharding.assign(docs.limit(0)).collect() == []


def cells(seed, n, hot=0):
    rng = np.random.default_rng(seed)
    cell = rng.choice(24 * 20 * 512, n, replace=False)
    size = rng.integers(1, 500, n)
    if hot:  # a third of all bytes on one arc
        cell[:512] = np.arange(512) + 7 * 512
        size[:512] = hot
    return pd.DataFrame({"cell": cell, "bytes": size, "n": size}).drop_duplicates("cell")


def loads(table, shard, n):
    return np.bincount(shard[table["cell"]], table["bytes"], n)


def test_bounded_loads_hold_for_a_hot_arc():
    for hot in (0, 5_000):
        table = cells(1, 20_000, hot)
        shard, _ = sharding.place(table, 24, 20, 512)
        load = loads(table, shard, 24)
        assert load.max() <= sharding.BOUND * load.mean() + table["bytes"].max()
        assert load.min() >= 0.95 * load.mean()


def test_one_more_shard_moves_a_limited_part():
    table = cells(2, 30_000)
    a, _ = sharding.place(table, 24, 20, 512)
    grown = table.assign(cell=table["cell"])
    points, _ = sharding.ring(24, 20)
    wider, _ = sharding.ring(25, 20)
    # The same points of the ring on the wider one.
    middle = points[table["cell"] // 512] - 1
    grown["cell"] = np.searchsorted(wider, middle) % len(wider) * 512 + table["cell"] % 512
    b, _ = sharding.place(grown.groupby("cell", as_index=False).sum(), 25, 20, 512)
    moved = (a[table["cell"]] != b[grown["cell"]]) * table["bytes"]
    assert moved.sum() < 0.1 * table["bytes"].sum()


def test_a_few_more_rows_move_few_others():
    table = cells(5, 30_000)
    a, _ = sharding.place(table, 24, 20, 512)
    more = table.copy()
    every_100th = more.index % 100 == 0
    more.loc[every_100th, "bytes"] *= 2
    b, _ = sharding.place(more, 24, 20, 512)
    moved = (a[table["cell"]] != b[table["cell"]]) * table["bytes"]
    assert moved.sum() < 0.05 * table["bytes"].sum()


def test_keys_start_at_their_own_node_while_it_has_room():
    table = cells(3, 100)
    points, owner = sharding.ring(24, 20)
    shard, _ = sharding.place(table, 24, 20, 512, bound=1000.0)
    assert (shard[table["cell"]] == owner[table["cell"] // 512]).all()
