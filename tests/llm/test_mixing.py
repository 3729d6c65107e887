from collections import Counter, defaultdict

import hashlib
from kerbside.llm import mixing

from .corpus import corpus, spaced, table


def expected(rows):
    """Targets by resharing until no source is above its cap; taken words by walking through the hash order."""
    sizes = defaultdict(int)
    for _, text, _, source in rows:
        sizes[source] += len(spaced(text))
    names = sorted(sizes, key=lambda s: (s is None, (s or "").encode("utf-32-be")))
    weight = {s: (3, 1, 2)[i % 3] for i, s in enumerate(names)}
    left, open_, target = 1.5 * sum(sizes.values()), set(names), {}
    while open_:
        share = {s: left * weight[s] / sum(weight[o] for o in open_) for s in open_}
        over = {s for s in open_ if share[s] > 2 * sizes[s]}
        if not over:
            target |= share
            break
        for s in over:
            target[s] = 2.0 * sizes[s]
            left -= target[s]
        open_ -= over
    times = {}
    for s in names:
        full = int(target[s] // sizes[s]) if sizes[s] else 0
        rest, total = target[s] - full * sizes[s], 0
        groups = defaultdict(int)
        for i, text, _, source in rows:
            if source == s:
                groups[hashlib.md5(f"{'' if i is None else i}:{text or ''}".encode()).hexdigest()[:15]] += len(spaced(text))
        for place in sorted(groups):
            more = total + groups[place]
            take = sizes[s] > 0 and (more <= rest or more - rest < rest - total)
            times[s, place] = full + take
            total = more if take else float("inf")
    return sizes, target, times


def place(row):
    return hashlib.md5(f"{'' if row[0] is None else row[0]}:{row[1] or ''}".encode()).hexdigest()[:15]


def test_targets_and_taken_words(spark):
    rows = corpus()
    sizes, target, times = expected(rows)
    got = mixing.mixture(table(spark, rows)).collect()
    assert len(got) == len(rows)
    want = Counter()
    for r in rows:
        n = len(spaced(r[1]))
        want[r[0], n, sizes[r[3]], round(target[r[3]], 6), n * times[r[3], place(r)]] += 1
    assert Counter((g.doc_id, g.size, g.source_size, round(g.target, 6), g.taken) for g in got) == want
    assert all(g.taken <= 2 * g.size for g in got)


def test_mixed_corpus_repeats_rows_and_keeps_columns(spark):
    rows = corpus(8)
    _, _, times = expected(rows)
    docs = table(spark, rows).selectExpr("*", "1 as copies", "2 as place", "3 as target")
    got = mixing.mix(docs)
    assert got.columns == docs.columns
    want = Counter()
    for r in rows:
        if times[r[3], place(r)]:
            want[r[0], r[1]] += times[r[3], place(r)]
    assert Counter((g.doc_id, g.text) for g in got.collect()) == want
    assert {g.copies for g in got.collect()} == {1}


def test_one_source_without_words_and_an_empty_table(spark):
    docs = table(spark, [(1, "", "en", "a"), (2, None, "en", "a")])
    assert [g.taken for g in mixing.mixture(docs).collect()] == [0, 0]
    assert mixing.mixture(docs.limit(0)).collect() == []
    assert mixing.mix(docs.limit(0)).collect() == []
