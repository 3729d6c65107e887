import hashlib
import re

from kerbside.llm import decontaminate

from .corpus import corpus, lower_az, sentence, table

import random

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(rows, items):
    windows = {}
    for item, text in items:
        w = WORD.findall(lower_az(text)) if text is not None else []
        for i in range(max(len(w) - 9, 1) if w else 0):
            windows.setdefault(tuple(w[i : i + 10]), set()).add(item)
    out = []
    for doc, text, *_ in rows:
        w = WORD.findall(lower_az(text))
        hit, found = set(), set()
        for k in {len(g) for g in windows}:
            for i in range(len(w) - k + 1):
                if (g := tuple(w[i : i + k])) in windows:
                    hit |= set(range(i, i + k))
                    found |= windows[g]
        names = sorted(str(i) for i in found if i is not None)
        out.append((str(doc), len(w), len(hit), len(names), hashlib.sha256(",".join(names).encode()).hexdigest(), bool(hit)))
    return sorted(out)


def benchmark(spark, items):
    return spark.createDataFrame(items, "item_id long, text string")


def case():
    rng = random.Random(5)
    rows = corpus(6, 40)
    long = sentence(rng, 30)
    rows += [(900, f"{sentence(rng, 4)}! {long.upper()} {sentence(rng, 3)}", "en", "a"), (901, long.replace(" ", ", "), "en", "a")]
    rows += [(902, "Été 3 Äpfel", "fr", "a"), (902, "kein Treffer", "de", "a")]
    items = [(2, long), (10, " ".join(long.split()[5:25])), (7, "Été 3 Äpfel"), (8, "  ,"), (9, None), (7, "Été 3 Äpfel"), (None, "nur so")]
    return rows, items + [(11, rows[0][1])]


def test_report_equals_brute_force(spark):
    rows, items = case()
    got = decontaminate.report(table(spark, rows), benchmark(spark, items)).collect()
    key = lambda g: (str(g.doc_id), g.n_words, g.n_hit, g.n_items, g.items_sha256, g.contaminated)
    assert sorted(map(key, got)) == brute(rows, items)


def test_shuffled_join_gives_the_same(spark, monkeypatch):
    rows, items = case()
    monkeypatch.setattr(decontaminate, "BROADCAST_BYTES", -1)
    got = decontaminate.report(table(spark, rows), benchmark(spark, items)).collect()
    key = lambda g: (str(g.doc_id), g.n_words, g.n_hit, g.n_items, g.items_sha256, g.contaminated)
    assert sorted(map(key, got)) == brute(rows, items)


def test_clean_drops_documents_with_hits_only(spark):
    rows, items = case()
    docs = table(spark, rows).selectExpr("*", "1 as text_hash", "2 as row")
    got = decontaminate.clean(docs, benchmark(spark, items))
    bad = {(b[0], b[1]) for b in brute(rows, items) if b[-1]}
    want = sorted((str(r[0]), r[1] or "") for r in rows if (str(r[0]), len(WORD.findall(lower_az(r[1])))) not in bad)
    assert got.columns == docs.columns
    assert sorted((str(g.doc_id), g.text or "") for g in got.collect()) == want


def test_empty_tables(spark):
    rows, items = case()
    docs, tests = table(spark, rows), benchmark(spark, items)
    assert decontaminate.clean(docs, tests.limit(0)).count() == len(rows)
    assert decontaminate.report(docs.limit(0), tests).collect() == []
    assert not any(g.contaminated for g in decontaminate.report(docs, tests.limit(0)).collect())


def test_words_are_those_of_the_expression_without_running_it(spark):
    """All ASCII characters and many others next to letters of both cases; the words of a text are found character by character."""
    texts = ["".join(f"{chr(c)}aB" if c % 3 else chr(c) for c in range(0x2100)), "", " \n", "\x00", "A\x00b", "x" * 3 + "\U0001F600 Y"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None])], "id int, text string")
    got = df.select("id", decontaminate.words(df.text).alias("w"))
    assert {r.id: r.w for r in got.collect()} == {i: WORD.findall(lower_az(t)) for i, t in enumerate([*texts, ""])}
    assert "regexp" not in got._jdf.queryExecution().executedPlan().toString()
