import hashlib
import random
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from kerbside.llm import prefix_trie

from .corpus import sentence

TURNS = "conv_id long, turn long, role string, text string"


def conversations(seed, n, spread=1):
    """Conversations that share openings, are copied, lack turns, numbers, roles and texts."""
    rng = random.Random(seed)
    openings = [[(rng.choice(("user", "system")), sentence(rng, 3)) for _ in range(6)] for _ in range(3)]
    rows, kept = [], []
    for i in range(n):
        kind = rng.randrange(6)
        if kind == 0 and kept:
            turns = list(rng.choice(kept))
        elif kind < 4:
            turns = rng.choice(openings)[: rng.randint(0, 6)] + [("user", sentence(rng, 2)) for _ in range(rng.randint(0, 4))]
        else:
            turns = [(rng.choice(("user", "assistant", None)), rng.choice((None, "", "é", sentence(rng, 4)))) for _ in range(rng.randint(1, 12))]
        kept.append(turns)
        conv_id = (i - n // 4) * spread
        rows += [(conv_id, None if t == 0 and i % 7 == 0 else t * 2, role, text) for t, (role, text) in enumerate(turns)]
    rng.shuffle(rows)
    return rows


def brute(rows):
    convs = defaultdict(list)
    for conv_id, turn, role, text in rows:
        if conv_id is not None:
            convs[conv_id].append(((turn is not None, turn or 0), role or "", text or ""))
    turns = {c: [(role, text) for _, role, text in sorted(x)] for c, x in convs.items()}
    new = {}
    for c in turns:
        h = zlib.crc32(str(c).encode()) % 9
        rest = c % 5 if c >= 0 else -(-c % 5)
        new[c] = tuple(turns.get(c - rest, [])[:h] + turns[c][h:])
    members = defaultdict(list)
    for c, path in new.items():
        for d in range(len(path) + 1):
            members[path[:d]].append(c)
    children = defaultdict(list)
    for node in members:
        if node:
            children[node[:-1]].append(node)
    leaves, kept = {}, {}
    for node in sorted(members, key=len, reverse=True):
        own = (len(members[node]) - 1) * len(node[-1][1].encode()) if node else 0
        leaves[node] = sum(leaves[k] for k in children[node]) or 1
        kept[node] = own + sum(kept[k] for k in children[node])
    out = []
    for node, found in members.items():
        ends = ",".join(str(c) for c in sorted(found) if len(new[c]) == len(node))
        parent = min(members[node[:-1]]) if node else None
        digest = hashlib.sha256(ends.encode()).hexdigest()
        out.append((min(found), len(node), parent, len(found), len(children[node]), leaves[node], kept[node], digest))
    return sorted(out, key=repr)


def found(conversations):
    got = prefix_trie.trie(conversations.repartition(3))
    assert [t for c, t in got.dtypes if c != "ends_sha256"] == ["bigint"] * 7
    return sorted(map(tuple, got.collect()), key=repr)


def test_equals_brute_force(spark):
    """Nulls, ties, repeated rows, a long text, copies with ids far apart, and columns named like those inside."""
    rows = conversations(1, 90)
    rows += [(None, 1, "user", "nobody's"), (777, 5, "user", "again"), (777, 5, "user", "again"), (778, None, None, "x" * 2_000_000)]
    rows += [(10**6 + i * 10_000, turn, "user", f"hello {turn}") for i in range(40) for turn in range(2)]
    docs = spark.createDataFrame(rows, TURNS).selectExpr("*", "'x' as rep", "1 as d", "2 as n", "3 as depth", "4 as e")
    assert found(docs) == brute(rows)


def test_long_chains_by_look_ups(spark, monkeypatch):
    """As for strings that are too long to carry their prefix hashes."""
    monkeypatch.setattr(prefix_trie, "SHORT", 0)
    rng = random.Random(2)
    chain = [("user", sentence(rng, 2)) for _ in range(70)]
    rows = []
    for i in range(25):
        path = chain[: rng.randint(1, 70)] + [("assistant", sentence(rng, 1)) for _ in range(rng.randint(0, 3))]
        rows += [(i * 5 * 10**9, t, role, text) for t, (role, text) in enumerate(path)]
    assert found(spark.createDataFrame(rows, TURNS)) == brute(rows)


def test_an_empty_table_has_no_node(spark):
    assert found(spark.createDataFrame([], TURNS)) == []


def test_fattest_number(spark):
    cases = [(a, b) for a in range(0, 40) for b in range(a + 1, 40)]
    df = spark.createDataFrame(cases, "a long, b long").select("a", "b", prefix_trie.fattest(F.col("a"), F.col("b")).alias("f"))
    for a, b, f in df.collect():
        assert f == max(range(a + 1, b + 1), key=lambda x: (x & -x))
