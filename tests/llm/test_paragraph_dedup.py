import random

import numpy as np
import xxhash

from kerbside.llm import common, paragraph_dedup

from .corpus import corpus, lower_az, sentence, spaced, table


def shingles(words):
    n = min(5, len(words))
    return {tuple(words[i : i + n]) for i in range(len(words) - n + 1)}


def removed(rows):
    """Paragraphs removed per (id, text), by comparing all of them."""
    order = sorted({(r[0], r[1]) for r in rows if r[0] is not None and r[1] is not None}, key=lambda r: r[0])
    units, places = {}, []
    for i, text in order:
        for line in text.split("\n"):
            if key := tuple(spaced(lower_az(line))):
                units.setdefault(key, len(units))
                places.append(((i, text), units[key]))
    sets = [shingles(u) for u in units]
    root = list(range(len(sets)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    for a in range(len(sets)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if both >= 0.8 * len(sets[a] | sets[b]):
                x, y = find(a), find(b)
                root[max(x, y)] = min(x, y)
    first, out = {}, {}
    for place, unit in places:
        g = find(unit)
        out[place] = out.get(place, 0) + (g in first)
        first.setdefault(g, place)
    return out


def test_removed_paragraphs_equal_brute_force(spark):
    rng = random.Random(5)
    rows = corpus(15, 60)
    line = sentence(rng, 60).split()
    for i in range(25):
        words = list(line)
        words[rng.randrange(60)] = f"w{i}"
        rows.append((3000 + i, " ".join(words), "en", "a"))
    want = removed(rows)
    got = paragraph_dedup.report(table(spark, rows)).collect()
    expected = sorted(
        (str(r[0]), sum(bool(spaced(x)) for x in (r[1] or "").split("\n")), want.get((r[0], r[1]), 0), len(spaced(r[1]))) for r in rows
    )
    assert sorted((str(g.doc_id), g.n_paragraphs, g.n_removed, g.n_words) for g in got) == expected
    assert all(g.n_removed_words <= g.n_words for g in got)


def test_a_passage_inside_other_paragraphs_goes_from_later_documents(spark):
    rng = random.Random(6)
    passage = sentence(rng, 55)
    rows = [(i, f"{sentence(rng, 80)} {passage} {sentence(rng, 90)}") for i in range(4)] + [(9, sentence(rng, 200))]
    got = {g.doc_id: g for g in paragraph_dedup.report(table(spark, rows)).collect()}
    assert got[0].n_removed_words == got[9].n_removed_words == 0
    assert all(paragraph_dedup.PASSAGE <= got[i].n_removed_words <= 57 for i in (1, 2, 3))
    texts = {g.doc_id: g.text for g in paragraph_dedup.clean(table(spark, rows)).collect()}
    assert texts[0] == rows[0][1] and texts[9] == rows[4][1]
    assert len(texts[1].split()) == 225 - got[1].n_removed_words


def left(rows, length=26):
    """Texts without the words of all runs of ``length`` words that a document with a lower id has."""
    windows = {i: {} for i, _ in rows}
    for i, text in rows:
        words = text.split()
        for at in range(len(words) - length + 1):
            windows[i].setdefault(tuple(words[at : at + length]), []).append(at)
    out = {}
    for i, text in rows:
        gone = {at + k for w, places in windows[i].items() if any(w in windows[j] for j in windows if j < i) for at in places for k in range(length)}
        out[i] = " ".join(w for k, w in enumerate(text.split()) if k not in gone)
    return out


def test_whole_shared_passages_go_whatever_their_length(spark):
    rng = random.Random(8)
    rows = []
    for i, n in enumerate([*range(24, 50), 50, 60, 80, 300] * 2):
        passage = sentence(rng, n)
        rows += [(10 * i + 10 + j, f"{sentence(rng, 100 + n)} {passage} {sentence(rng, 110 + n)}") for j in range(3)]
    # A passage of one document, the middle of which an earlier one has, too.
    middle = sentence(rng, 30)
    passage = f"{sentence(rng, 15)} {middle} {sentence(rng, 15)}"
    rows += [(1, f"{sentence(rng, 90)} {middle} {sentence(rng, 90)}"), (2, f"{sentence(rng, 90)} {passage}")]
    rows += [(9000, f"{passage} {sentence(rng, 90)}"), (9001, middle), (9002, sentence(rng, 25)), (9003, passage)]
    want = left(rows)
    docs = table(spark, [*rows, rows[4], rows[-3]])
    lost = {i: len(text.split()) - len(want[i].split()) for i, text in rows}
    assert {g.doc_id: g.n_removed_words for g in paragraph_dedup.report(docs).collect()} == lost
    assert {g.doc_id: g.text for g in paragraph_dedup.clean(docs).collect()} == want


def test_bands_find_a_pair_at_the_threshold():
    assert 1 - (1 - 0.8**paragraph_dedup.ROWS) ** paragraph_dedup.BANDS >= paragraph_dedup.RECALL
    rng = np.random.default_rng(3)
    hit = 0
    for _ in range(200):
        words = [f"w{x}" for x in rng.integers(0, 10**6, 94)]
        a, b = words[:89], words[:88] + words[89:90]  # one word apart at the end
        h, counts = paragraph_dedup.word_hashes([" ".join(a).encode(), " ".join(b).encode()])
        keys = paragraph_dedup.bands(h, counts)
        hit += bool((keys[0] == keys[1]).any())
    assert hit == 200


def test_empty_table_and_null_texts(spark):
    docs = table(spark, [(1, None), (2, ""), (None, "same words here"), (3, "same words here")]).selectExpr("*", "1 as at", "2 as gone")
    got = {str(g.doc_id): g.n_removed for g in paragraph_dedup.report(docs).collect()}
    assert got == {"1": 0, "2": 0, "None": 0, "3": 0}
    assert paragraph_dedup.report(docs.limit(0)).collect() == []


def test_words_are_those_of_the_expression_without_running_it(spark):
    texts = ["".join(f"{chr(c)}aB" if c % 3 else chr(c) for c in range(0x2100)), "", " \n", "\x00", "A\x00b\x85 c", "\U0001F600\t\vY "]
    df = spark.createDataFrame([(i, t) for i, t in enumerate([*texts, None])], "id int, text string")
    got = df.select("id", common.spaced(df.text).alias("w"))
    assert {r.id: r.w for r in got.collect()} == {i: t if t is None else spaced(t) for i, t in enumerate([*texts, None])}
    assert "regexp" not in got._jdf.queryExecution().executedPlan().toString()


def test_word_hashes_come_from_the_buffer_without_an_object_for_each_word(monkeypatch):
    rng = random.Random(9)
    texts = [b" Ab\tcd\x0b\n", b"", b"ab CD ba", "Ä\x85 ä\u00a0b".encode(), b"\r\x0c", b"cd", b"\x00 \xff"]
    texts += [b" ".join(rng.randbytes(n).translate(None, b" \t\n\x0b\x0c\r") for n in range(i, 60, 3)) for i in (1, 2, 3)]
    words = [w for t in texts for w in t.lower().split()]
    want = [xxhash.xxh64_intdigest(w) for w in words]
    called = []
    monkeypatch.setattr(paragraph_dedup.xxhash, "xxh64_intdigest", lambda w: called.append(w) or xxhash.xxh64(w).intdigest())
    h, counts = paragraph_dedup.word_hashes(texts)
    assert h.tolist() == want and counts.tolist() == [len(t.split()) for t in texts]
    assert called and all(len(w) >= 32 for w in called)
    assert [x.tolist() for x in paragraph_dedup.word_hashes([])] == [[], []]


def test_only_texts_without_an_id_are_split_again_for_the_report(spark):
    docs = table(spark, [(1, "a b\n \nc"), (1, "a b\n \nc"), (None, "a b\n\n c\nd"), (2, " \t"), (None, None), (None, ""), (3, None)])
    got = paragraph_dedup.report(docs)
    assert sorted((str(g.doc_id), g.n_paragraphs, g.n_words) for g in got.collect()) == [
        ("1", 2, 3), ("1", 2, 3), ("2", 0, 0), ("3", 0, 0), ("None", 0, 0), ("None", 0, 0), ("None", 3, 4)
    ]
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    splits = [part for part in plan.split("split(")[:-1]]
    assert splits and all("isnull(doc_id" in part.lower() for part in splits)
