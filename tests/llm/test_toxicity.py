import random
import zlib

import numpy as np
import pytest

from kerbside.llm import toxicity

from .corpus import sentence, table


def case(n=260, seed=1):
    """Documents of which a third hold words with one of two bad stems; half of the endings occur once only."""
    rng = random.Random(seed)
    rows, labels = [], []
    for i in range(n):
        text = sentence(rng, rng.randint(10, 90)).split()
        bad = i % 3 == 0
        for _ in range(rng.randint(2, 4) if bad else 0):
            text.insert(rng.randrange(len(text)), rng.choice(("grozz", "vilka")) + rng.choice(("", "en", "ak", "ost", str(i % 7))))
        rows.append((i, " ".join(text)))
        labels.append((i, 1, int(bad)))
    return rows, labels


@pytest.fixture(scope="module")
def fitted():
    rows, labels = case()
    return toxicity.fit([r[1] for r in rows], [x[2] for x in labels])


def test_held_out_documents_are_told_apart(fitted):
    rows, labels = case(150, seed=77)
    found = toxicity.Scorer(fitted).scores([r[1] for r in rows])
    truth = np.array([x[2] for x in labels])
    assert ((found >= 0.5) == truth).mean() > 0.95


def test_unseen_endings_are_read_by_their_stem(fitted):
    plain = "ka lo mi tu ren sol " * 4
    bad, good = toxicity.Scorer(fitted).scores([f"{plain} grozzimil {plain} vilkatur", f"{plain} solimil {plain} rentur"])
    assert bad > 0.5 > good


def test_every_window_of_a_long_text_counts(fitted):
    plain = "ka lo mi tu ren sol " * 2000
    scorer = toxicity.Scorer(fitted)
    late, none = scorer.scores([f"{plain} grozzen vilka grozz", plain])
    assert late > 0.5 > none


def test_a_phrase_of_half_a_window_lies_whole_in_a_window():
    for n in range(200):
        first = toxicity.starts(n)
        assert first[-1] + toxicity.WINDOW >= n
        for at in range(n - 16):
            assert any(s <= at and at + 17 <= s + toxicity.WINDOW for s in first)


def test_a_planted_phrase_is_found_at_every_offset(fitted):
    plain = "ka lo mi tu ren sol".split() * 20
    for n in (10, 17, 25, 32):
        phrase = [("grozzen", "vilka", "ren", "tu")[i % 4] for i in range(n)]
        texts = [" ".join(plain[:at] + phrase + plain[at:]) for at in range(toxicity.WINDOW)]
        assert (toxicity.Scorer(fitted).scores(texts) >= 0.5).all()


def test_scores_do_not_depend_on_what_was_scored_before(fitted):
    rows, _ = case(40, seed=5)
    texts = [r[1] for r in rows] + [None, "", "x" * 1000, "ßÄ \U0001f600"]
    together = toxicity.Scorer(fitted).scores(texts)
    alone = [toxicity.Scorer(fitted).scores([t])[0] for t in texts]
    assert np.allclose(together, alone, atol=1e-4)
    assert ((together >= 0) & (together <= 1)).all()


def test_gradients_agree_with_differences():
    rng = np.random.default_rng(0)
    net = toxicity.Network.fresh(3)
    net.layers = {k: v.astype(np.float64) for k, v in net.layers.items()}
    x = rng.standard_normal((5, 4, 2 * toxicity.HC + toxicity.EW))
    mask = (np.arange(5)[:, None] < np.array([5, 3, 1, 4])).astype(np.float32)
    y = np.array([1.0, 0, 1, 0])

    def loss():
        xf, xb = net.project(x.reshape(-1, x.shape[2]))
        index = np.where(mask > 0, np.arange(mask.size).reshape(mask.shape), -1)
        p = toxicity.sigmoid(net.windows(xf, xb, index)[0])
        return -np.mean(y * np.log(p) + (1 - y) * np.log(1 - p))

    g, _ = net.window_step(x, mask, y, np.ones(4))
    for name in ("wfu", "wbw", "aw", "av", "ow", "wfb"):
        layer, at = net.layers[name], (0,) * net.layers[name].ndim
        kept, step = layer[at], 1e-2
        layer[at] = kept + step
        up = loss()
        layer[at] = kept - step
        down = loss()
        layer[at] = kept
        assert abs((up - down) / (2 * step) - g[name][at]) < 2e-3


def test_table_of_scores_and_pipeline_stage(spark):
    rows, labels = case(200)
    rows += [(1000, None), (1001, ""), (0, rows[0][1]), (None, rows[0][1])]
    docs = table(spark, rows).selectExpr("*", "'x' as score")
    marks = spark.createDataFrame([*labels, (4, 1, None), (0, 1, 1)], "doc_id long, quality int, toxic int")
    got = toxicity.scored(docs, marks).collect()
    assert len(got) == len(rows)
    for g in got:
        assert g.held_out == (g.doc_id is not None and zlib.crc32(str(g.doc_id).encode()) % 5 == 0)
        assert 0 <= g.score <= 1 and g.predicted == int(g.score >= 0.5)
    assert len({g.score for g in got if g.doc_id in (0, None)}) == 1
    clean = toxicity.keep_clean(table(spark, rows), marks)
    assert clean.columns == ["doc_id", "text", "lang", "source", "n_chars"]
    assert sorted(str(c.doc_id) for c in clean.collect()) == sorted(str(g.doc_id) for g in got if g.score < 0.5)


def test_nothing_to_learn_from(spark):
    docs = table(spark, [(1, "a b"), (2, None)])
    marks = spark.createDataFrame([(7, 1, 1)], "doc_id long, quality int, toxic int")
    assert [g.score for g in toxicity.scored(docs, marks).collect()] == [0.0, 0.0]
    assert toxicity.scored(docs.limit(0), marks.limit(0)).collect() == []
