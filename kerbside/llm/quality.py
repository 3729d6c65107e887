"""Quality rules whose thresholds follow the corpus, by mergeable quantile sketches per language and source.

A sketch is a histogram over log-linear buckets: whole numbers below 64 have a bucket each, larger ones keep their six
leading bits, so a quantile is off by 1/32 of itself at most. Sketches merge by adding counts, give the same result in any
order, and hold a few hundred rows whatever they have seen. A group of fewer than ``LEAST`` documents takes the merged
sketch of its language, and below that, of all documents.

All limits are quantiles of the sketch, none is a number of its own. Word lengths may lie ``RANGES`` quartile ranges outside
the quartiles. Of the other metrics most documents have none, so both quartiles are 0; there a document goes if it is in the
highest 1 of ``TAIL`` documents of its group and in the highest quarter of those that have any. Ties stand or fall together: a
bucket that reaches below the limit stays.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import saved
from .common import SPACED, null_join

#: Base rules: fewest words, most words in repeated windows (per 100), words of a window.
LEAST_WORDS, MOST_REPEATED, WINDOW = 20, 30, 8
#: Documents a group needs for thresholds of its own, quartile ranges a document may lie outside, documents to one of the tail.
LEAST, RANGES, TAIL = 100, 3, 20
#: The metric that has limits on both sides.
CENTRED = "word_length"
LEADING_BITS = 6


def features(docs: DataFrame) -> DataFrame:
    """``doc_id, lang, source, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, n_lines, n_shouts``."""
    text = F.coalesce("text", F.lit(""))
    rows = docs.select("doc_id", "lang", "source", text.alias("text"), F.regexp_extract_all(text, F.lit(SPACED), F.lit(0)).alias("w"))
    lines = F.filter(F.split("text", "\n"), lambda l: l.rlike(SPACED))
    shingles = F.transform(
        F.sequence(F.lit(1), F.size("w") - (WINDOW - 1)), lambda i: F.xxhash64(F.slice("w", i, F.lit(WINDOW)))
    )
    rows = rows.select(
        "doc_id",
        "lang",
        "source",
        F.size("w").cast("long").alias("n_words"),
        (F.length("text") - F.regexp_count("text", F.lit(r"[\x20\x09-\x0D]"))).cast("long").alias("word_chars"),
        F.regexp_count("text", F.lit(r"[#*$%&|<>]")).cast("long").alias("n_symbols"),
        F.regexp_count("text", F.lit("[!?]")).cast("long").alias("n_shouts"),
        lines.alias("lines"),
        F.when(F.size("w") > WINDOW, shingles).alias("h"),
    )
    rows = rows.withColumn("n_lines", F.size("lines").cast("long"))
    rows = rows.withColumn("n_dup_lines", F.col("n_lines") - F.size(F.array_distinct("lines")))
    rows = rows.withColumn("repeats", F.size(F.array_distinct("h")) < F.size("h")).drop("lines")
    # Only texts with a repeated window sort theirs: equal neighbours in that order are the repeated ones.
    pairs = F.transform("h", lambda h, i: F.struct(h.alias("h"), i.alias("i")))
    rows = rows.withColumn("s", F.when(F.col("repeats"), F.sort_array(pairs))).drop("h")
    again = F.filter(
        "s", lambda x, i: (x["h"] == F.get("s", i - 1)["h"]).eqNullSafe(True) | (x["h"] == F.get("s", i + 1)["h"]).eqNullSafe(True)
    )
    rows = rows.withColumn("p", F.sort_array(F.transform(again, lambda x: x["i"]))).drop("s")
    steps = F.transform("p", lambda x, i: F.least(F.lit(WINDOW), F.coalesce(F.get("p", i + 1) - x, F.lit(WINDOW))))
    covered = F.aggregate(steps, F.lit(0).cast("long"), lambda a, x: a + x)
    return rows.select(
        "doc_id",
        "lang",
        "source",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        F.coalesce(covered, F.lit(0).cast("long")).alias("n_repeat_words"),
        "n_lines",
        "n_shouts",
    )


def base_failed() -> Column:
    return (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))


def metrics() -> dict[str, Column]:
    """Whole thousandths of a word or line; null where there is nothing to divide by."""
    def per(a: str, b: str) -> Column:
        return F.when(F.col(b) > 0, F.floor(F.try_divide(F.col(a) * 1000 - F.pmod(F.col(a) * 1000, F.col(b)), F.col(b)))).cast("long")

    return {
        "symbols": per("n_symbols", "n_words"),
        "word_length": per("word_chars", "n_words"),
        "dup_lines": per("n_dup_lines", "n_lines"),
        "repeated": per("n_repeat_words", "n_words"),
        "shouted": per("n_shouts", "n_words"),
    }


def _width(x: Column) -> Column:
    """Numbers in the bucket of x >= 0."""
    cut = F.length(F.bin(x)) - LEADING_BITS
    return F.when(cut <= 0, F.lit(1).cast("long")).otherwise(F.pow(F.lit(2), cut).cast("long"))


def bucket(x: Column) -> Column:
    """The lowest number of the bucket that holds x >= 0."""
    return x - F.pmod(x, _width(x))


def sketches(rows: DataFrame) -> DataFrame:
    """``(lang, source, metric, bucket, n)`` over the rows that pass the base rules."""
    each = F.array(*[F.struct(F.lit(m).alias("metric"), c.alias("x")) for m, c in metrics().items()])
    values = rows.filter(~base_failed()).select("lang", "source", F.explode(each).alias("m"))
    values = values.filter("m.x is not null").select("lang", "source", "m.metric", bucket(F.col("m.x")).alias("bucket"))
    return values.groupBy("lang", "source", "metric", "bucket").agg(F.count("*").alias("n"))


def quantiles(sketch: DataFrame, keys: list[str]) -> DataFrame:
    """``(keys, metric, n, q)`` of the sketches merged by the keys: the quartiles ``q.q1, q.q3``, ``q.tail``, the lowest bucket
    that leaves at most 1 of ``TAIL`` above, and ``q.top``, the upper quartile of the values above 0, null if there are none."""
    merged = sketch.groupBy(*keys, "metric", "bucket").agg(F.sum("n").alias("n"))
    group = Window.partitionBy(*keys, "metric")
    merged = merged.withColumn("upto", F.sum("n").over(group.orderBy("bucket"))).withColumn("all", F.sum("n").over(group))
    merged = merged.withColumn("some", F.sum(F.when(F.col("bucket") > 0, F.col("n")).otherwise(0)).over(group))
    none = F.col("all") - F.col("some")
    first = lambda condition: F.min(F.when(condition, F.col("bucket")))
    return merged.groupBy(*keys, "metric").agg(
        F.max("all").alias("n"),
        F.struct(
            first(F.col("upto") * 4 >= F.col("all")).alias("q1"),
            first(F.col("upto") * 4 >= F.col("all") * 3).alias("q3"),
            first(F.col("upto") * TAIL >= F.col("all") * (TAIL - 1)).alias("tail"),
            first((F.col("bucket") > 0) & ((F.col("upto") - none) * 4 >= F.col("some") * 3)).alias("top"),
        ).alias("q"),
    )


def thresholds(sketch: DataFrame) -> DataFrame:
    """One row per language and source with ``low_<metric>`` and ``high_<metric>``; what is below low, or high or more, goes."""
    own = quantiles(sketch, ["lang", "source"])
    lang = quantiles(sketch, ["lang"]).selectExpr("lang as l", "metric as lm", "n as ln", "q as lq")
    every = quantiles(sketch, []).selectExpr("metric as am", "q as aq")
    t = own.join(lang, own["lang"].eqNullSafe(lang["l"]) & (own["metric"] == lang["lm"]))
    t = t.join(every, t["metric"] == every["am"])
    q = F.when(F.col("n") >= LEAST, F.col("q")).when(F.col("ln") >= LEAST, F.col("lq")).otherwise(F.col("aq"))
    t = t.select("lang", "source", "metric", q.alias("q")).select("lang", "source", "metric", "q.*")
    upper = F.col("q3") + _width(F.col("q3"))
    reach = RANGES * (upper - F.col("q1"))
    above = F.col("tail") + _width(F.col("tail"))
    centred = F.col("metric") == CENTRED
    low = F.when(centred, F.col("q1") - reach)
    high = F.when(centred, upper + reach).otherwise(F.greatest(above, "top"))
    t = t.select("lang", "source", "metric", low.alias("low"), high.alias("high"))
    ends = [F.max(F.when(F.col("metric") == m, F.col(e))).alias(f"{e}_{m}") for m in metrics() for e in ("low", "high")]
    return t.groupBy("lang", "source").agg(*ends)


def judge(docs: DataFrame) -> DataFrame:
    """Per document: ``doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, kept``.

    Null and empty texts have no words and fail the base rules. Null languages and sources are groups of their own.
    Repeated rows and ties are judged alike. Texts are worked on whole, one row at a time, however long; extra columns are left
    out, whatever their names. Only narrow features are written, read twice and joined with a row per group.
    """
    rows = saved(features(docs), "features")
    limits = saved(thresholds(sketches(rows)), "thresholds")
    rows = rows.withColumn("base_failed", base_failed())
    out = null_join(rows, limits, ["lang", "source"], "left")
    inside = reduce(
        lambda a, b: a & b,
        [F.coalesce(x >= F.col(f"low_{m}"), F.lit(True)) & F.coalesce(x < F.col(f"high_{m}"), F.lit(True)) for m, x in metrics().items()],
    )
    return out.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        (~F.col("base_failed") & inside).alias("kept"),
    )
