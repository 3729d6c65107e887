"""Mixing sources to target weights by hash-threshold histograms.

A source's target is its weighted share of the wanted words; a share above ``most`` times the source's own words stops
there and the excess is shared anew. A document is repeated ``floor(target / source words)`` times, and once more if its
hash is at or below the threshold of its source. The threshold comes from histograms: words are summed by source and
hash bucket, the bucket in which the remaining budget ends is found, and only that bucket is refined, twice. Nothing
sorts documents, and a rerun finds the same hashes and so the same rows.
"""

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import saved
from .common import SPACED, null_join

#: Weights of the sources in their order, repeating.
WEIGHTS = (3, 1, 2)
#: Wanted words as a multiple of all words, and the most that a source may be repeated.
TOTAL, MOST = 1.5, 2
#: Bits of the hash in each of the two histograms; 60 bits in all.
BITS, LEVEL = 60, 12


def size(text: Column) -> Column:
    """Number of words; null and empty texts have none."""
    return F.coalesce(F.regexp_count(text, F.lit(SPACED)), F.lit(0)).cast("long")


def place(doc_id: Column, text: Column) -> Column:
    """60 bits of a hash of id and text; equal rows get equal places."""
    key = F.concat(
        F.coalesce(doc_id.cast("string"), F.lit("")), F.lit(":"), F.coalesce(text, F.lit(""))
    )
    return F.conv(F.substring(F.md5(key), 1, 15), 16, 10).cast("long")


def targets(sources: DataFrame, weights=WEIGHTS, total: float = TOTAL, most: int = MOST) -> DataFrame:
    """Adds ``target`` to one row per source ``(source, source_size)``.

    With sources ordered by cap / weight, the capped ones come first. ``level`` is the words per unit of weight if all
    sources from this row on are uncapped; the first row whose own share fits below its cap has the right one.
    The windows hold one row per source, not per document.
    """
    everything = Window.partitionBy(F.lit(0))
    named = everything.orderBy(F.col("source").isNull(), F.col("source"))
    by_ratio = everything.orderBy(F.col("cap") * 1.0 / F.col("weight"), "rank")
    w = sources.withColumn("rank", F.row_number().over(named))
    w = w.withColumn("weight", F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.col("rank") - 1, F.lit(len(weights))) + 1))
    w = w.withColumn("cap", F.col("source_size") * most)
    w = w.withColumn("budget", F.sum("source_size").over(everything) * F.lit(float(total)))
    w = w.withColumn("k", F.row_number().over(by_ratio))
    w = w.withColumn("capped", F.coalesce(F.sum("cap").over(by_ratio.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    w = w.withColumn("weights", F.sum("weight").over(by_ratio.rowsBetween(0, Window.unboundedFollowing)))
    w = w.withColumn("level", (F.col("budget") - F.col("capped")) / F.col("weights"))
    fits = F.when(F.col("level") * F.col("weight") <= F.col("cap"), F.struct("k", "level"))
    w = w.withColumn("level", F.coalesce(F.min(fits).over(everything)["level"], F.col("cap") * 1.0))
    return w.select("source", "source_size", F.least(F.col("cap") * 1.0, F.col("level") * F.col("weight")).alias("target"))


def plan(rows: DataFrame, weights=WEIGHTS, total: float = TOTAL, most: int = MOST) -> DataFrame:
    """One row per source: ``(source, source_size, target, full, cut)`` for rows ``(source, size, place)``.

    A document is taken ``full`` times, and once more if ``place <= cut``.
    """
    words = F.sum("size").alias("words")
    sources = targets(rows.groupBy("source").agg(F.sum("size").alias("source_size")), weights, total, most)
    full = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    sources = sources.withColumn("full", full)
    sources = sources.withColumn("rest", F.col("target") - F.col("full") * F.col("source_size"))
    sources = saved(sources.withColumn("low", F.lit(0).cast("long")).withColumn("before", F.lit(0).cast("long")), "targets")
    edge = sources
    for shift in (BITS - LEVEL, BITS - 2 * LEVEL):
        # The bucket of width 2^shift in which the budget ends; `low` and `before` are its first place and the words before it.
        inside = _inside(rows, edge, shift + LEVEL)
        bins = inside.groupBy("source", F.shiftright("place", shift).alias("bin")).agg(words)
        upto = F.sum("words").over(Window.partitionBy("source").orderBy("bin"))
        narrow = edge.select("source", "rest", "before")
        bins = bins.withColumn("upto", upto)
        bins = null_join(bins, narrow, ["source"])
        bins = bins.filter(F.col("before") + F.col("upto") > F.col("rest"))
        first = bins.groupBy("source").agg(F.min(F.struct("bin", "words", "upto")).alias("b"), F.first("before").alias("before"))
        first = first.select(
            "source",
            F.shiftleft("b.bin", shift).alias("low"),
            (F.col("before") + F.col("b.upto") - F.col("b.words")).alias("before"),
        )
        keep = sources.drop("low", "before")
        edge = saved(null_join(keep, first, ["source"]), "edge")
    inside = _inside(rows, edge, BITS - 2 * LEVEL)
    last = inside.groupBy("source", "place").agg(words)
    last = last.withColumn("upto", F.sum("words").over(Window.partitionBy("source").orderBy("place")))
    last = null_join(last, edge, ["source"])
    over = F.col("before") + F.col("upto") - F.col("rest")
    nearer = (over <= 0) | (over < F.col("words") - over)
    last = last.filter(nearer).groupBy("source").agg(F.max("place").alias("last"))
    cuts = null_join(edge.select("source", "low"), last, ["source"], "left")
    cuts = cuts.select("source", F.coalesce("last", F.col("low") - 1).alias("cut"))
    result = sources.select("source", "source_size", "target", "full")
    result = null_join(result, cuts, ["source"], "left")
    return saved(result.withColumn("cut", F.coalesce("cut", F.lit(-1).cast("long"))), "plan")


def _inside(rows: DataFrame, edge: DataFrame, width: int) -> DataFrame:
    """Rows in the bucket of 2^width places that starts at their source's ``low``."""
    narrow = edge.select("source", "low")
    joined = null_join(rows, narrow, ["source"])
    return joined.filter(F.shiftright("place", width) == F.shiftright("low", width))


def copies(docs: DataFrame, decided: DataFrame) -> DataFrame:
    """Adds ``copies``, ``source_size`` and ``target`` to documents with ``source`` and ``place``."""
    joined = null_join(docs, decided, ["source"])
    return joined.withColumn("copies", F.col("full") + (F.col("place") <= F.col("cut")).cast("long")).drop("full", "cut")


def measured(docs: DataFrame) -> DataFrame:
    """The narrow rows ``(doc_id, source, size, place)`` that the mix is planned on; clashing columns are left behind."""
    return docs.select("doc_id", "source", size(F.col("text")).alias("size"), place(F.col("doc_id"), F.col("text")).alias("place"))


def mix(docs: DataFrame, **shares) -> DataFrame:
    """The mixed corpus: documents in the columns they came in, as often as the mix takes them.

    Null and empty texts have no words; they are kept or left by the same rule as others of their source. Sources may
    be null. Equal rows (same id and text) share a place and are taken alike. An empty table gives an empty table.
    """
    decided = plan(saved(measured(docs), "sizes"), **shares)
    key = docs.select(F.struct(*docs.columns).alias("row"), "source", place(F.col("doc_id"), F.col("text")).alias("place"))
    taken = copies(key, decided).filter("copies > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1).cast("long"), "copies"))).select("row.*")


def mixture(docs: DataFrame) -> DataFrame:
    """Per document: ``doc_id, size, source_size, target, taken``."""
    rows = saved(measured(docs), "sizes")
    out = copies(rows, plan(rows))
    return out.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))
