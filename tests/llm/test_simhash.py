import random

import numpy as np
import xxhash

from kerbside.llm import simhash

from .corpus import corpus, lower_az, spaced, table


def plain(text):
    w = spaced(lower_az(text))
    n = min(3, len(w))
    if not w:
        return 0
    hashes = [xxhash.xxh64(" ".join(w[i : i + n]).encode(), seed=42).intdigest() for i in range(len(w) - n + 1)]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(fps):
    """Smallest index that each fingerprint reaches."""
    label = list(range(len(fps)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(fps):
            low = min(label[j] for j, b in enumerate(fps) if (a ^ b).bit_count() <= 3)
            if low < label[i]:
                label[i], changed = low, True
    return label


def test_masks_cover_every_pair_within_the_radius():
    rng = random.Random(1)
    first = simhash.masks(list(range(64)))
    assert len(first) == 15
    for _ in range(300):
        bits = rng.sample(range(64), rng.randint(0, 3))
        covering = [m for m in first if all(m >> b & 1 for b in bits)]
        assert covering
        for m in covering[:2]:
            inner = simhash.masks([b for b in range(64) if m >> b & 1])
            assert any(all(x >> b & 1 for b in bits) for x in inner)
            assert all(x.bit_count() <= 16 for x in inner)


def test_fingerprints_and_components_equal_brute_force(spark):
    rows = [r for r in corpus(9, 90) if r[0] is not None]
    got = simhash.near_duplicates(table(spark, rows)).collect()
    fps = [plain(r[1]) for r in rows]
    label = groups(fps)
    low = {}
    for r, name in zip(rows, label, strict=True):
        low[name] = min(low.get(name, r[0]), r[0])
    want = sorted((r[0], f"{f:016x}", low[n]) for r, f, n in zip(rows, fps, label, strict=True))
    assert sorted((g.doc_id, g.fingerprint, g.component_id) for g in got) == want


def test_large_buckets_are_split_without_losing_links(spark):
    rng = random.Random(2)
    base = [rng.getrandbits(64) for _ in range(4)]
    fps = sorted({b ^ sum(1 << i for i in rng.sample(range(64), rng.randint(0, 4))) for b in base for _ in range(40)})
    signed = np.array(fps, np.uint64).view(np.int64).tolist()
    links = simhash.links(spark.createDataFrame([(f,) for f in signed], "fp long"), bucket=3).collect()
    parent = {f: f for f in signed}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for e in links:
        parent[find(e.u)] = find(e.v)
    label = groups(fps)
    for i in range(len(fps)):
        for j in range(i):
            assert (find(signed[i]) == find(signed[j])) == (label[i] == label[j])


def test_keep_one_of_each_component(spark):
    rows = corpus(9, 90)
    docs = table(spark, rows).selectExpr("*", "1 as root", "2 as key")
    got = simhash.keep_one(docs)
    assert got.columns == docs.columns
    kept = [(g.doc_id, g.text) for g in got.collect()]
    label = groups([plain(r[1]) for r in rows])
    assert len(kept) == len(set(label))
    best = {}
    for r, name in zip(rows, label, strict=True):
        best[name] = min(best.get(name, (True, 0)), (r[0] is None, r[0] or 0))
    assert sorted((k[0] is None, k[0] or 0) for k in kept) == sorted(best.values())


def test_shared_ids_and_empty_tables(spark):
    same = table(spark, [(1, "one two three four"), (1, "completely other words here now"), (2, None), (3, "")])
    assert sorted(str(g.text) for g in simhash.keep_one(same).collect()) == ["None", "completely other words here now", "one two three four"]
    assert simhash.near_duplicates(same.limit(0)).collect() == []
    assert simhash.keep_one(same.limit(0)).collect() == []
