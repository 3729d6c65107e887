import random
import re
from collections import defaultdict

from kerbside.llm import line_dedup

from .corpus import corpus, sentence, spaced, table


def brute(rows):
    """Line numbers to remove for each (id, text): all earlier lines are compared."""
    order = sorted({(r[0] is None, r[0] or 0, r[1]) for r in rows if r[1] is not None}, key=lambda r: r[:2])
    before, gone = [], {}
    for _, i, text in order:
        out = []
        for j, line in enumerate(text.split("\n")):
            s = frozenset(spaced(line.lower()))
            if not s:
                continue
            if any(5 * len(s & t) >= 4 * len(s | t) for t in before):
                out.append(j)
            before.append(s)
        gone[i, text] = out
    return gone


def case():
    rng = random.Random(3)
    rows = corpus(13, 60)
    line = sentence(rng, 40).split()
    for i in range(30):  # a group of near-copies
        words = list(line)
        for _ in range(rng.randint(0, 6)):
            words[rng.randrange(40)] = f"w{rng.randrange(60)}"
        rows.append((2000 + i, " ".join(words) + "\n" + sentence(rng, 4).upper(), "en", "a"))
    return rows


def test_equals_brute_force(spark):
    rows = case()
    want = brute(rows)
    expected = []
    for r in rows:
        out = want.get((r[0] or 0, r[1]), [])
        n = len(r[1].split("\n")) if r[1] is not None else 0
        expected.append((str(r[0]), n, len(out), ",".join(map(str, out))))
    got = line_dedup.report(table(spark, rows)).collect()
    assert sorted((str(g.doc_id), g.n_lines, g.n_removed, g.removed) for g in got) == sorted(expected)


def test_clean_texts(spark):
    docs = table(spark, [(1, "one two three four five\n\nsix"), (2, "six\nFive four three two ONE\n\nnew"), (3, None)])
    docs = docs.selectExpr("*", "1 as line", "2 as lines", "3 as row")
    got = line_dedup.clean(docs)
    assert got.columns == docs.columns
    assert {g.doc_id: g.text for g in got.collect()} == {1: "one two three four five\n\nsix", 2: "\nnew", 3: None}


def test_empty_table(spark):
    docs = table(spark, [(1, "x")])
    assert line_dedup.report(docs.limit(0)).collect() == []
    assert [tuple(g) for g in line_dedup.report(table(spark, [(1, None), (None, "")])).collect()] in (
        [(1, 0, 0, ""), (None, 1, 0, "")],
        [(None, 1, 0, ""), (1, 0, 0, "")],
    )


def test_words_are_split_at_single_characters(spark):
    df = spark.createDataFrame([("\t Ab\x0bÄ  c\r",), ("x",)], "text string")
    got = df.select(line_dedup._words("text").alias("w"))
    assert [r.w for r in got.collect()] == [["ab", "ä", "c"], ["x"]]
    assert "x09" not in got._jdf.queryExecution().executedPlan().toString()


def test_long_lines_of_common_words_are_no_candidates(spark, monkeypatch):
    counts = {}

    def saved(df, name):
        out = real(df, name)
        counts[name] = out.count()
        return out

    real = line_dedup.saved
    monkeypatch.setattr(line_dedup, "saved", saved)
    rng = random.Random(5)
    shared = [f"s{i}" for i in range(400)]
    lines = [[f"w{i}x{j}" for j in range(15)] + rng.sample(shared, 185) for i in range(30)]
    lines.append(lines[0][5:] + [f"n{i}" for i in range(5)])
    got = line_dedup.report(table(spark, [(i, " ".join(words)) for i, words in enumerate(lines)])).collect()
    assert {g.doc_id: g.n_removed for g in got} == {i: int(i == 30) for i in range(31)}
    assert 2 <= counts["candidates"] < 12


def test_sketches_differ_by_no_more_bits_than_words(spark):
    rng = random.Random(6)
    base = [f"a{i}" for i in range(300)]
    texts = [" ".join(base), " ".join(base[:-7] + [f"b{i}" for i in range(4)]), " ".join(f"c{i}" for i in range(300))]
    lines = spark.createDataFrame([(i, i, t) for i, t in enumerate(texts)], "s1 long, s2 long, text string")
    words = line_dedup.hashed(lines).withColumnRenamed("h", "words")
    a, b, c = line_dedup.sketches(words).orderBy("s1").collect()
    differ = lambda x, y: sum(((p ^ q) & (1 << 64) - 1).bit_count() for p, q in zip(x[2:], y[2:], strict=True))
    assert differ(a, b) <= 11 and differ(a, b) % 2 == 1
    # A bitmap of 64 bits would pass these, of 300 words each: 66 may differ.
    assert differ(a, c) > 66


def test_lists_hold_sets_of_about_one_size_and_lose_no_pair(spark):
    most, need = 60, lambda both: -(-4 * both // 9)
    prefix = lambda n: n - -(-4 * n // 5) + 1
    sets = spark.createDataFrame([(n, n, list(range(1, prefix(n) + 1))) for n in range(4, most)], "s1 long, n int, prefix array<int>")
    entries = line_dedup._lists(sets, "s1").collect()
    # Word i is at place i of every set: two sets can share each place of theirs that leaves enough words behind it.
    places = defaultdict(set)
    for e in entries:
        places[e.n, e.at].add(e.t)
    for x in range(4, most):
        for y in range(x, min(most - 1, x * 5 // 4) + 1):
            for at in range(1, x + 1 - need(x + y) + 1):
                assert places[x, at] & places[y, at], (x, y, at)
    lists = defaultdict(list)
    for e in entries:
        lists[e.t].append(e.n)
    assert max(max(ns) / min(ns) for ns in lists.values()) < 2.5
    # Few sets are listed twice by a word.
    assert len(entries) < 1.2 * sum(prefix(n) for n in range(4, most))


def test_lines_do_not_carry_their_text(spark):
    docs = table(spark, [(1, "a\nb")])
    got = line_dedup.split_lines(docs)
    assert [(r.line, r.text) for r in got.collect()] == [(0, "a"), (1, "b")]
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert re.search(r"Generate posexplode\(lines#\d+\), \[doc_id#\w+, text_hash#\w+\]", plan), plan


def test_all_texts_are_split_into_words_once(spark, monkeypatch):
    names, real = [], line_dedup.saved
    monkeypatch.setattr(line_dedup, "saved", lambda df, name: names.append(name) or real(df, name))
    docs = table(spark, [(1, "one two two three"), (2, "\n \t\nTwo"), (3, None)])
    counted, counts = [], line_dedup.word_counts
    monkeypatch.setattr(line_dedup, "word_counts", lambda rows: counted.append(rows) or counts(rows))
    lines = line_dedup.prepared(docs)
    assert names == ["hashes", "lines"] and lines.count() == 2
    assert counted[0].columns == ["doc_id", "text_hash", "line", "h"]


def test_word_counts_by_bucket(spark):
    hashes = [[5, 7], [5, -1], [5 + line_dedup.BUCKETS, 70000]]
    rows = spark.createDataFrame([(h,) for h in hashes], "h array<long>")
    got = line_dedup.word_counts(rows)
    at = {i: b for i, b in enumerate(got) if b > 1}
    assert len(got) == line_dedup.BUCKETS
    assert at == {5: 7, 7: 4, 70000: 4, line_dedup.BUCKETS - 1: 4}
