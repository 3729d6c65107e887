"""Benchmark decontamination: a broadcast hash set of test n-grams against the token windows of all documents.

A window of 10 document words is hashed in the scan and probes the hash set of the benchmark's windows; a hit is
verified word by word. Only hits are shuffled. The hash set is broadcast if its measured size is below a limit, else the
same join shuffles both sides by the hash.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import saved
from .common import null_join

#: Words of a window. An item with fewer words, but not none, is one window.
LENGTH = 10
#: What separates words: all of ASCII but digits and letters. Replaced one by one, as a regular expression takes ten times
#: as long for the same words, ``[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`` of the lower-cased text.
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
OTHER = "".join(c for c in map(chr, range(128)) if not c.isalnum())
#: Most bytes of test windows that are broadcast.
BROADCAST_BYTES = 64 << 20


def words(text: Column) -> Column:
    spaced = F.translate(F.coalesce(text, F.lit("")), OTHER + UPPER, " " * len(OTHER) + LOWER)
    return F.array_remove(F.split(spaced, " "), "")


def test_windows(benchmark: DataFrame, length: int = LENGTH) -> DataFrame:
    """``(item_id, gram, k, h, g)``: the windows of every item, their length, hash and second hash."""
    items = benchmark.select("item_id", words(F.col("text")).alias("w")).filter(F.size("w") > 0)
    first = F.sequence(F.lit(1), F.greatest(F.size("w") - length + 1, F.lit(1)))
    grams = items.select("item_id", "w", F.explode(first).alias("at"))
    grams = grams.select("item_id", F.slice("w", F.col("at"), F.lit(length)).alias("gram")).distinct()
    return grams.select(
        "item_id", "gram", F.size("gram").alias("k"), F.xxhash64("gram").alias("h"), F.xxhash64("gram", F.lit(1)).alias("g")
    )


def find_hits(docs: DataFrame, grams: DataFrame) -> DataFrame:
    """``(doc_id, text_hash, at, k, h, g)`` for each place of a document where a test window occurs."""
    tests = saved(grams.select("gram", "k", "h", "g").distinct(), "grams")
    # One row: how much would be broadcast, and which lengths occur (at most the window length).
    bytes_, lengths = tests.agg(
        F.sum(F.octet_length(F.concat_ws(" ", "gram")) + 24 * F.col("k") + 96), F.sort_array(F.collect_set("k"))
    ).first()
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), words(F.col("text")).alias("w"))
    places = rows.select("doc_id", "text_hash", "w", F.posexplode("w").alias("at", "word"))
    if len(lengths) == 1:
        places = places.withColumn("n", F.lit(lengths[0]))
    else:
        places = places.withColumn("n", F.explode(F.array(*map(F.lit, lengths or [0]))))
    places = places.filter(F.col("at") + F.col("n") <= F.size("w"))
    places = places.withColumn("own", F.slice("w", F.col("at") + 1, F.col("n"))).withColumn("own_h", F.xxhash64("own"))
    if (bytes_ or 0) <= BROADCAST_BYTES:
        tests = F.broadcast(tests)
    hits = places.join(tests, (F.col("own_h") == F.col("h")) & (F.col("own") == F.col("gram")))
    return hits.select("doc_id", "text_hash", "at", "k", "h", "g")


def spans(hits: DataFrame) -> DataFrame:
    """``(doc_id, text_hash, first, last)``: the runs of hit words, adjoining ones as found."""
    order = Window.partitionBy("doc_id", "text_hash").orderBy("at")
    end = F.col("at") + F.col("k")
    before = F.coalesce(F.max(end).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    runs = hits.withColumn("first", F.greatest("at", before)).withColumn("last", end - 1)
    return runs.filter("last >= first").select("doc_id", "text_hash", "first", "last")


def report(docs: DataFrame, benchmark: DataFrame, length: int = LENGTH) -> DataFrame:
    """Per document: ``doc_id, n_words, n_hit, n_items, items_sha256, contaminated``.

    Null and empty texts have no words and no hits. Rows with the same id and text get the same answer each; rows that
    share an id but not the text are kept apart. Items without words have no windows; null item ids are not listed.
    """
    grams = saved(test_windows(benchmark, length), "windows")
    hits = saved(find_hits(docs, grams), "hits")
    n_hit = spans(hits).groupBy("doc_id", "text_hash").agg(F.sum(F.col("last") - F.col("first") + 1).alias("n_hit"))
    found = hits.select("doc_id", "text_hash", "h", "g").distinct().join(grams.select("item_id", "h", "g"), ["h", "g"])
    listed = found.groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set(F.col("item_id").cast("string"))).alias("items"))
    both = null_join(n_hit, listed, ["doc_id", "text_hash"], "left")
    count = F.size(words(F.col("text"))).cast("long")
    base = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), count.alias("n_words"))
    out = null_join(base, both, ["doc_id", "text_hash"], "left")
    n = F.coalesce("n_hit", F.lit(0)).cast("long")
    return out.select(
        "doc_id",
        "n_words",
        n.alias("n_hit"),
        F.coalesce(F.size("items"), F.lit(0)).cast("long").alias("n_items"),
        F.sha2(F.coalesce(F.concat_ws(",", "items"), F.lit("")), 256).alias("items_sha256"),
        (n > 0).alias("contaminated"),
    )


def clean(docs: DataFrame, benchmark: DataFrame, length: int = LENGTH) -> DataFrame:
    """Documents without any hit, in the columns they came in. An empty benchmark keeps every document."""
    hits = find_hits(docs, saved(test_windows(benchmark, length), "windows"))
    bad = saved(hits.select("doc_id", "text_hash").distinct(), "contaminated")
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", F.xxhash64("text").alias("text_hash"))
    return null_join(rows, bad, ["doc_id", "text_hash"], "left_anti").select("row.*")
