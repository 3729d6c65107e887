import os
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as entry
import corpus_pipeline
from kerbside.llm import decontaminate, mixing, queries, toxicity
from kerbside.llm.common import table

from .test_decontaminate import brute as contaminated
from .test_simhash import groups, plain

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not os.path.isdir(SF_DIR), reason="no test tables")
DOCS = ["doc_id", "text", "lang", "source", "n_chars"]


def test_all_queries_are_registered():
    names = list(entry.queries())
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 11)] == [1] * 10
    assert "pipeline" in names
    assert set(queries.SQL) <= set(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.SQL))
def test_query_equals_its_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF_DIR}/{t}.parquet'")
    want = con.execute(queries.SQL[name])
    columns = sorted(d[0] for d in want.description)
    place = [[d[0] for d in want.description].index(c) for c in columns]
    got = queries.QUERIES[name](spark, SF_DIR)
    assert sorted(got.columns) == columns
    show = lambda r: tuple(f"{x:.9g}" if isinstance(x, float) else str(x) for x in r)
    assert sorted(show([r[i] for i in place]) for r in want.fetchall()) == sorted(show(r) for r in got.select(columns).collect())


def test_stages_work_on_what_their_predecessor_kept(spark):
    docs, kept = table(spark, SF_DIR, "documents"), {}
    net = toxicity.train(docs, table(spark, SF_DIR, "labels"))
    for name, stage in corpus_pipeline.STAGES:
        docs = corpus_pipeline.saved(stage(spark, docs, SF_DIR), name)
        kept[name] = docs.collect()
        if name != "sharding":
            assert docs.columns == DOCS
    rows = table(spark, SF_DIR, "documents").collect()
    score = toxicity.Scorer(net).scores([r.text for r in rows])
    rows = [r for r, s in zip(rows, score, strict=True) if s < 0.5]
    assert sorted(rows) == sorted(kept["toxicity"])
    label = groups([plain(r.text) for r in rows])
    rows = [min(r for r, x in zip(rows, label, strict=True) if x == name) for name in set(label)]
    assert sorted(rows) == sorted(kept["simhash"])
    items = [(r.item_id, r.text) for r in table(spark, SF_DIR, "benchmark").collect()]
    bad = {b[0] for b in contaminated([(r.doc_id, r.text) for r in rows], items) if b[-1]}
    rows = [r for r in rows if str(r.doc_id) not in bad]
    assert sorted(rows) == sorted(kept["decontamination"])
    taken = {r.doc_id: r.taken // max(r.size, 1) for r in mixing.mixture(spark.createDataFrame(rows, docs.schema[:5])).collect()}
    assert Counter(r.doc_id for r in kept["mixing"]) == Counter({i: n for i, n in taken.items() if n})
    assert Counter((r.doc_id, r.text) for r in kept["sharding"]) == Counter((r.doc_id, r.text) for r in kept["mixing"])
    assert len({(r.shard, r.slot) for r in kept["sharding"]}) == len(kept["sharding"])


def test_windows_of_a_benchmark_item_without_words(spark):
    tests = spark.createDataFrame([(1, "..."), (2, None)], "item_id long, text string")
    assert decontaminate.test_windows(tests).collect() == []
