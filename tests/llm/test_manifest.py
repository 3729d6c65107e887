import hashlib
import re
import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from kerbside.llm import manifest

from .corpus import corpus, table


def H(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def field(value):
    return "-" if value is None else f"{len(str(value).encode())}:{value}"


def leaf(row, text):
    doc_id, _, lang, source = row
    n_chars = len(row[1] or "")
    return H(*map(field, (doc_id, source, lang, n_chars, text)))


def tree(digests, fan):
    """Root and, per leaf, the siblings of every level."""
    proofs, at, level = [[] for _ in digests], list(range(len(digests))), list(digests)
    while len(level) > 1:
        for i in range(len(digests)):
            run = at[i] // fan * fan
            proofs[i].append((level[run : at[i]], level[at[i] + 1 : run + fan]))
            at[i] //= fan
        level = [H(*level[i : i + fan]) for i in range(0, len(level), fan)]
    return level[0], proofs


def brute(rows, fan=8):
    by_lang = defaultdict(list)
    for row in rows:
        by_lang[row[2]].append((row[0] is not None, row[0] or 0, leaf(row, row[1]), row))
    langs = sorted(by_lang, key=lambda x: (x is not None, (x or "").encode()))
    trees = {}
    for lang in langs:
        by_lang[lang].sort(key=lambda x: x[:3])
        trees[lang] = tree([x[2] for x in by_lang[lang]], fan)
    root, top = tree([trees[lang][0] for lang in langs], fan)
    out = []
    for k, lang in enumerate(langs):
        for (_, _, digest, row), path in zip(by_lang[lang], trees[lang][1], strict=True):
            path = path + top[k]
            text = row[1]
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 3 == 0 and text is not None:
                text = re.sub("[A-Z]", lambda m: m[0].lower(), text)
            fold = leaf(row, text)
            for before, after in path:
                fold = H(*before, fold, *after)
            siblings = H(*[s for before, after in path for s in before + after])
            out.append((row[0], digest, trees[lang][0], root, siblings, fold, fold == root))
    return out


def found(docs):
    return sorted(map(tuple, manifest.verify(docs).collect()), key=repr)


def test_equals_brute_force(spark):
    """Trees of several levels, many languages, nulls, a long text, repeated rows and columns named like the results."""
    rows = corpus(2, 700)
    rows += [(None, None, None, None), (None, None, None, None), (9**9, "É A" * 400_000, "zz", "long"), (3, "Only", "", "a")]
    rows += [(i, f"Text {i}", f"l{i % 70}", "a") for i in range(100)]
    docs = table(spark, rows).repartition(7)
    more = docs.selectExpr("*", "'x' as tree", "1 as n", "2 as lo", "'y' as digest", "'z' as root", "array(1) as path")
    got = found(more)
    assert got == sorted(brute(rows), key=repr)
    assert {g[-1] for g in got} == {True, False}


def test_one_row_and_none(spark):
    rows = [(4, "A", "en", "a")]
    assert found(table(spark, rows)) == brute(rows)
    assert found(table(spark, [])) == []


def test_a_single_changed_byte_is_noticed(spark):
    rows = corpus(6, 50)
    leaves = table(spark, rows).select("doc_id", "lang", manifest.document_leaf(F.col("text")).alias("digest"))
    out = manifest.manifest(leaves, "lang", ["doc_id"])
    other = F.concat(F.when(F.col("digest").startswith("0"), "1").otherwise("0"), F.substring("digest", 2, 63))
    flags = out.select(
        (manifest.folded(F.col("digest"), F.col("path")) == F.col("root")).alias("same"),
        (manifest.folded(other, F.col("path")) == F.col("root")).alias("changed"),
    ).collect()
    assert len(flags) == len(rows) and all(f.same and not f.changed for f in flags)
