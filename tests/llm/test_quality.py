import random

import duckdb
import pandas as pd

from kerbside.llm import quality, sql
from kerbside.session import saved

from .corpus import corpus, sentence, table, word


def case():
    rng = random.Random(4)
    rows = corpus(11, 150)
    for i in range(300):
        rows.append((1000 + i, f"{sentence(rng, rng.randint(20, 60))}.\n{sentence(rng, 30)}", "en", "a"))
    rows += [(2000, "tu " * 50, "en", "a"), (2001, "\n".join(["a line that comes again"] * 30), "en", "a")]
    rows += [(2002, " ".join(w + "$$#" for w in sentence(rng, 60).split()), "en", "a"), (2003, "w" * 5000, None, None)]
    rows += [(2004, " ".join(w + "!!" for w in sentence(rng, 60).split()), "en", "a")]
    return rows


def test_equals_its_sql(spark):
    rows = case()
    documents = pd.DataFrame([r[:4] for r in rows], columns=["doc_id", "text", "lang", "source"])
    documents["doc_id"] = documents["doc_id"].astype("Int64")
    con = duckdb.connect()
    con.register("documents", documents)
    want = con.execute(sql.QUALITY).fetchall()
    got = quality.judge(table(spark, rows)).collect()
    assert sorted(map(str, want)) == sorted(str(tuple(g)) for g in got)


def test_junk_goes_and_clean_documents_stay(spark):
    got = {g.doc_id: g for g in quality.judge(table(spark, case())).collect()}
    assert all(got[1000 + i].kept for i in range(300))
    assert [got[i].kept for i in (2000, 2001, 2002, 2003, 2004)] == [False] * 5
    assert got[2000].base_failed and got[2001].base_failed and not got[2002].base_failed


def test_empty_table_and_extra_columns(spark):
    docs = table(spark, case()[:5]).selectExpr("*", "1 as n_words", "true as kept", "2 as w")
    assert quality.judge(docs).count() == 5
    assert quality.judge(docs.limit(0)).collect() == []


def test_buckets_keep_six_leading_bits(spark):
    got = spark.range(0, 5000).select("id", quality.bucket(quality.F.col("id")).alias("b")).collect()
    for g in got:
        shift = max(g.id.bit_length() - 6, 0)
        assert g.b == g.id >> shift << shift


def noisy(rng, level):
    """A text whose metrics all grow with the level."""
    words = [w + ("#" * rng.randint(0, 2) + "!" * rng.randint(0, 2)) * level for w in sentence(rng, 60).split()]
    lines = [" ".join(words[i : i + 6]) for i in range(0, 60, 6)]
    lines += [f"{word(rng)} {word(rng)}"] * rng.randint(0, 2 * level) + [" ".join(words[:10])] * rng.randint(0, level - 1)
    return "\n".join(lines)


def test_every_limit_follows_its_source(spark):
    rng = random.Random(12)
    rows = [(i, noisy(rng, 1 + i % 2), "en", "ab"[i % 2]) for i in range(600)]
    # The same texts under sources too small for limits of their own take those of the language.
    rows += [(1000 + i, text, "en", f"s{i}") for i, text, *_ in rows[:6]]
    features = saved(quality.features(table(spark, rows)), "features")
    limits = {t.source: t.asDict() for t in quality.thresholds(quality.sketches(features)).collect()}
    for metric in quality.metrics():
        assert limits["a"][f"high_{metric}"] < limits["b"][f"high_{metric}"], metric
        assert limits["a"][f"high_{metric}"] <= limits["s0"][f"high_{metric}"], metric
    assert all(limits["s0"][k] == limits["s5"][k] for k in limits["s0"] if k != "source")


def test_at_most_the_tail_goes_by_a_limit_and_ties_stay_together(spark):
    rng = random.Random(13)
    texts = [f"{sentence(rng, 40)}{' ?' * (i % 40 == 0)}{' !' * 30 * (i % 80 == 0)}" for i in range(800)]
    got = {g.doc_id: g.kept for g in quality.judge(table(spark, [(i, t, "en", "a") for i, t in enumerate(texts)])).collect()}
    gone = {i for i, kept in got.items() if not kept}
    assert gone >= {i for i in range(800) if i % 80 == 0} and len(gone) <= 800 // quality.TAIL
    assert quality.judge(table(spark, [(i, texts[1], "en", "a") for i in range(200)])).filter("kept").count() == 200


def test_texts_of_megabytes(spark):
    rng = random.Random(14)
    rows = [(i, sentence(rng, 40), "en", "a") for i in range(120)]
    rows += [(200, sentence(rng, 100_000), "en", "a"), (201, "tu " * 300_000, "en", "a"), (202, "x" * 2_000_000, "en", "a")]
    got = {g.doc_id: (g.n_words, g.n_repeat_words, g.base_failed) for g in quality.judge(table(spark, rows)).collect()}
    assert got[200][0] == 100_000 and got[201] == (300_000, 300_000, True) and got[202] == (1, 0, True)
