"""Removal of near-duplicate lines by an exact set-similarity join on their words.

A line is the set of its lower-cased words. It goes if a line before it (by document id, then line number) has a Jaccard
similarity of 0.8 or more, equality included. Only DataFrame functions are used.

Words of a line are ordered from rare to frequent; rarity comes from word counts in 2^18 hash buckets, a table of fixed size.
Two similar sets share one of their first n - ceil(0.8 n) + 1 words, so a set is listed under these. A list holds one word
and one class of sizes, so that sets meet only those of about their size; a set that may be similar to one of the class above
is listed there, too. Lists are joined with themselves under the length filter, the positional filter, and a filter on 128-bit
parity bitmaps, whose differing bits are never more than the differing words. Equal sets count once.

Large groups of similar lines share all their lists. So that no group's pairs are ever written out, a semi-join first finds
the sets that have any candidate; those are verified against the first set of each of their lists, which settles nearly all
members of a group; only what is left meets all sets before it.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import discard, saved
from .common import null_join, release, sized

#: Similarity as a fraction.
TOP, BOTTOM = 4, 5
#: Hash buckets of the word counts.
BUCKETS = 1 << 18
#: Buckets that are counted in one row.
PARTS = 8
#: 64-bit words of the sketches that pairs are compared by before their words are.
WIDE = 8
#: Sets of fewer words are similar to equal sets only.
LEAST = TOP
#: Sets of fewer words are told apart by 64 bits as well as by 128.
LONG = 64
#: Parity bitmaps of a set: of all its words, and of those in one half of the hashes (of long sets only).
_BITS = ["bits", "more"]
_KEY = ["never", "doc_id", "text_hash", "line"]


def split_lines(docs: DataFrame) -> DataFrame:
    """``(doc_id, text_hash, line, text)`` of all lines, numbered from 0."""
    # The text ends here: else each of its lines would carry and hash the whole of it.
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.split("text", "\n").alias("lines"))
    return rows.select("doc_id", "text_hash", F.posexplode("lines").alias("line", "text"))


def _split(text: str) -> Column:
    """The lower-cased words of a line, in order, with empty ones where white space meets other white space or an end."""
    line, found = F.lower(text), F.lit(False)
    for space in "\t\x0b\x0c\r":  # found in few lines; the others are not copied
        line, found = F.replace(line, F.lit(space), F.lit(" ")), found | F.contains(text, F.lit(space))
    return F.split(F.when(found, line).otherwise(F.lower(text)), " ")


def _words(text: str) -> Column:
    """The lower-cased words of a line, in order."""
    return F.array_remove(_split(text), "")


def hashed(lines: DataFrame) -> DataFrame:
    """Lines with the hashes ``h`` of their words in place of ``text``, each once."""
    empty = F.xxhash64(F.lit(""))
    # In steps, as an array that is used twice is only kept between projections.
    rows = lines.withColumn("h", F.array_distinct(F.transform(_split("text"), lambda w: F.xxhash64(w)))).drop("text")
    return rows.withColumn("h", F.when(F.array_contains("h", empty), F.array_remove("h", empty)).otherwise(F.col("h")))


def word_counts(rows: DataFrame) -> bytes:
    """A byte for each hash bucket: the number of lines with its words, from their hashes ``h``, on a log scale below 128.

    ``PARTS`` buckets share a row, as fewer rows are found faster.
    """
    words = rows.select(F.explode("h").alias("h"))
    words = words.select(F.expr(f"h & {BUCKETS // PARTS - 1}").alias("id"), F.expr(f"h & {BUCKETS - 1} ^ (h & {BUCKETS // PARTS - 1})").alias("part"))
    parts = [F.lit(i * (BUCKETS // PARTS)) for i in range(PARTS)]
    seen = words.groupBy("id").agg(*[F.count(F.when(F.col("part") == at, 1)).alias(f"n{i}") for i, at in enumerate(parts)])
    each = F.inline(F.array(*[F.struct((F.col("id") + at).alias("id"), F.col(f"n{i}").alias("n")) for i, at in enumerate(parts)]))
    dense = rows.sparkSession.range(BUCKETS).join(seen.select(each), "id", "left")
    level = F.least(F.floor(F.log2(F.coalesce("n", F.lit(0)) + 1) * 3) + 1, F.lit(127))
    listed = dense.agg(F.sort_array(F.collect_list(F.struct("id", F.char(level).alias("n")))).alias("all"))
    return listed.select(F.array_join(F.transform("all", lambda x: x["n"]), "")).first()[0].encode()


def prepared(docs: DataFrame) -> DataFrame:
    """Every line with a word: its place, set identity ``s1, s2``, size, parity bitmap and prefix, rare words first."""
    words = saved(hashed(split_lines(docs)), "hashes")
    counts = F.lit(word_counts(words))
    # Rarity in the upper 8 bits, 55 bits of the hash below.
    rank = lambda h: F.ascii(F.substring(counts, h.bitwiseAND(F.lit(BUCKETS - 1)).cast("int") + 1, F.lit(1)).cast("string"))
    key = lambda h: F.shiftleft(rank(h).cast("long"), 55).bitwiseOR(h.bitwiseAND(F.lit((1 << 55) - 1)))
    bit = lambda h: F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(h, 58).cast("int"))
    half = lambda h: F.call_function("shiftleft", F.shiftrightunsigned(h, 57).bitwiseAND(F.lit(1)), F.shiftrightunsigned(h, 58).cast("int"))
    parity = lambda bit: F.aggregate("h", F.lit(0).cast("long"), lambda a, h: a.bitwiseXOR(bit(h)))
    rows = words.filter(F.size("h") > 0).select(
        F.col("doc_id").isNull().alias("never"),
        "doc_id",
        "text_hash",
        "line",
        F.size("h").alias("n"),
        parity(bit).alias("bits"),
        F.when(F.size("h") >= LONG, parity(half)).otherwise(F.lit(0).cast("long")).alias("more"),
        F.sort_array(F.transform("h", key)).alias("k"),
    )
    # Lists need no more than 32 bits of a word; equal bits of other words only make a candidate more.
    prefix = F.transform(F.slice("k", F.lit(1), _prefix(F.col("n"))), lambda k: k.bitwiseAND(F.lit(0x7FFFFFFF)).cast("int"))
    rows = rows.select(
        *_KEY,
        F.xxhash64("k").alias("s1"),
        F.xxhash64(F.lit(1), "k").alias("s2"),
        "n",
        *_BITS,
        F.when(F.col("n") >= LEAST, prefix).alias("prefix"),
    )
    lines = saved(rows, "lines")
    discard(words)
    return lines


def _prefix(n: Column) -> Column:
    return n - F.floor((n * TOP + (BOTTOM - 1)) / BOTTOM).cast("int") + 1


def _need(both: Column) -> Column:
    """The fewest words that two similar sets share, by the sum of their sizes."""
    return F.floor((both * TOP + (TOP + BOTTOM - 1)) / (TOP + BOTTOM))


def _lists(sets: DataFrame, *columns: str) -> DataFrame:
    """``(t, at, n, *columns)``: an entry for each of the first words of a set, at its place from 1, in its list ``t``.

    Classes of sizes begin at powers of two, so similar sets are in the same class or in two neighbouring ones. The smaller
    set of two classes is listed in the class above, too, by the words that are early enough for any set there.
    """
    digits = F.length(F.bin("n"))
    above = F.call_function("shiftleft", F.lit(1), digits)
    rows = sets.filter("prefix is not null").select(
        *columns,
        "n",
        F.size("prefix").alias("own"),
        digits.alias("class"),
        F.greatest(F.lit(0), F.col("n") + 1 - _need(F.col("n") + above)).cast("int").alias("also"),
        "prefix",
    )
    rows = rows.select(*columns, "n", "own", "class", F.posexplode(F.concat("prefix", F.slice("prefix", F.lit(1), F.col("also")))).alias("at", "t"))
    place = F.shiftleft(F.col("class") + (F.col("at") >= F.col("own")).cast("int"), 25)
    return rows.select(F.col("t").bitwiseXOR(place).alias("t"), (F.col("at") % F.col("own") + 1).alias("at"), "n", *columns)


def _differ(x: str, y: str, bitmaps: list[str]) -> Column:
    """Bits that differ, at most as many as words do; columns of the sets begin with ``x`` and ``y``."""
    return sum(F.bit_count(F.col(x + b).bitwiseXOR(F.col(y + b))) for b in bitmaps)


def _differ_narrow() -> Column:
    """The same for the bitmaps in the lists. What is not in one half of the hashes is in the other."""
    every, more = [F.col(f"x.{b}").bitwiseXOR(F.col(f"y.{b}")) for b in _BITS]
    halves = F.bit_count(every.bitwiseXOR(more)) + F.bit_count(more)
    return F.when(F.least("x.n", "y.n") >= LONG, halves).otherwise(F.bit_count(every))


def _candidates() -> Column:
    """Conditions on two different sets ``x`` and ``y`` that stand in one list."""
    both = F.col("x.n") + F.col("y.n")
    need = _need(both)
    reach = 1 + F.least(F.col("x.n") - F.col("x.at"), F.col("y.n") - F.col("y.at"))
    return (
        (F.col("x.t") == F.col("y.t"))
        & (F.col("x.s1") != F.col("y.s1"))
        & (F.col("x.n") * BOTTOM >= F.col("y.n") * TOP)
        & (F.col("y.n") * BOTTOM >= F.col("x.n") * TOP)
        & (reach >= need)
        & (_differ_narrow() <= both - 2 * need)
    )


def similar(docs: DataFrame, sets: DataFrame) -> DataFrame:
    """``(s1, s2)`` of the sets whose first line has a similar one before it that is not equal."""
    lists = _lists(sets, "s1", *_BITS)
    some = lists.alias("x").join(lists.alias("y"), _candidates(), "left_semi").select("s1").distinct()
    some = saved(some, "candidates")
    release(docs.sparkSession)

    # From here on, only sets that have a candidate.
    involved = saved(sets.join(sized(some), "s1", "left_semi").select("s1", "s2", "n", *_BITS, "prefix", "first"), "involved")
    lists = saved(_lists(involved, "s1", "s2", *_BITS, "first"), "lists")
    # Their words as 64-bit hashes, read from the texts at their first lines.
    places = saved(involved.select("s1", "s2", *[F.col(f"first.{k}").alias(k) for k in _KEY[1:]]), "places")
    texts = null_join(split_lines(docs), sized(places), ["doc_id", "text_hash", "line"])
    words = saved(hashed(texts).select("s1", "s2", F.col("h").alias("words")).dropDuplicates(["s1", "s2"]), "words")
    wide = saved(sketches(words), "sketches")
    release(docs.sparkSession)

    heads = lists.groupBy("t").agg(F.min(F.struct("first", "at", "n", "s1", "s2", *_BITS)).alias("head"), F.count("*").alias("size"))
    heads = heads.filter("size > 1").select("t", "head.*")
    settled = _verified(lists, heads, words, wide)
    left = saved(lists.join(settled, ["s1", "s2"], "left_anti"), "left")
    release(docs.sparkSession)
    settled = settled.unionByName(_verified(left, lists, words, wide))
    discard(some, involved, lists, places, words, wide, left)
    return settled


def sketches(words: DataFrame) -> DataFrame:
    """``(s1, s2, b0, b1, ...)``: parity bitmaps of ``64 * WIDE`` bits, which tell long sets apart, too."""
    each = words.select("s1", "s2", F.explode("words").alias("h"))
    part = F.shiftrightunsigned("h", 48).bitwiseAND(F.lit(WIDE - 1))
    bit = F.expr("shiftleft(1L, cast(shiftrightunsigned(h, 58) as int))")
    parts = [F.bit_xor(F.when(part == i, bit).otherwise(F.lit(0).cast("long"))).alias(f"b{i}") for i in range(WIDE)]
    return each.groupBy("s1", "s2").agg(*parts)


def _verified(later: DataFrame, earlier: DataFrame, words: DataFrame, wide: DataFrame) -> DataFrame:
    """``(s1, s2)`` of the sets in ``later`` with a similar one in ``earlier`` that comes before.

    Pairs meet the narrow sketches before the words, as most candidates end there.
    """
    pairs = later.alias("x").join(earlier.alias("y"), _candidates() & (F.col("y.first") < F.col("x.first")))
    pairs = pairs.select(*[F.col(f"{side}.{c}").alias(f"{side}{c}") for side in "xy" for c in ("s1", "s2", "n")]).distinct()
    for side in "xy":
        own = sized(wide).withColumnsRenamed({c: f"{side}{c}" for c in wide.columns})
        pairs = pairs.join(own, [f"{side}s1", f"{side}s2"])
    both = F.col("xn") + F.col("yn")
    pairs = pairs.filter(_differ("x", "y", [f"b{i}" for i in range(WIDE)]) <= both - 2 * _need(both)).select("xs1", "xs2", "xn", "ys1", "ys2", "yn")
    for side in "xy":
        own = words.select(F.col("s1").alias(f"{side}s1"), F.col("s2").alias(f"{side}s2"), F.col("words").alias(f"{side}w"))
        pairs = pairs.join(own, [f"{side}s1", f"{side}s2"])
    shared = F.size(F.array_intersect("xw", "yw"))
    pairs = pairs.filter(shared * BOTTOM >= (F.col("xn") + F.col("yn") - shared) * TOP)
    return saved(pairs.select(F.col("xs1").alias("s1"), F.col("xs2").alias("s2")).distinct(), "similar")


def removed_lines(docs: DataFrame) -> DataFrame:
    """``(doc_id, text_hash, line)`` of the lines to remove, numbered from 0.

    Lines without a word stay. Documents without an id come last. Rows with the same id and text count as one document, so
    they lose the same lines; rows that share an id only are ordered by a hash of the text.
    """
    lines = prepared(docs)
    sets = lines.groupBy("s1", "s2").agg(
        F.min(F.struct(*_KEY)).alias("first"), *[F.first(c).alias(c) for c in ("n", *_BITS, "prefix")]
    )
    sets = saved(sets, "sets")
    release(docs.sparkSession)
    gone = similar(docs, sets).withColumn("gone", F.lit(True))
    firsts = sets.select("s1", "s2", "first").join(gone, ["s1", "s2"], "left")
    every = lines.select("s1", "s2", *_KEY).join(firsts, ["s1", "s2"])
    every = every.filter(F.col("gone") | (F.struct(*_KEY) > F.col("first")))
    return saved(every.select("doc_id", "text_hash", "line"), "removed")


def report(docs: DataFrame) -> DataFrame:
    """Per document: ``doc_id, n_lines, n_removed, removed`` (line numbers, comma-joined). Null texts have no lines."""
    gone = removed_lines(docs).groupBy("doc_id", "text_hash").agg(F.sort_array(F.collect_set("line")).alias("lines"))
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.coalesce(F.size(F.split("text", "\n")), F.lit(0)).alias("n_lines"))
    out = null_join(rows, gone, ["doc_id", "text_hash"], "left")
    return out.select(
        "doc_id",
        F.col("n_lines").cast("long").alias("n_lines"),
        F.coalesce(F.size("lines"), F.lit(0)).cast("long").alias("n_removed"),
        F.coalesce(F.array_join(F.col("lines").cast("array<string>"), ","), F.lit("")).alias("removed"),
    )


def clean(docs: DataFrame) -> DataFrame:
    """The documents without the removed lines, in the columns they came in."""
    gone = removed_lines(docs).groupBy("doc_id", "text_hash").agg(F.collect_set("line").alias("lines"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", F.xxhash64("text").alias("text_hash"))
    rows = null_join(rows, gone, ["doc_id", "text_hash"], "left")
    kept = F.filter(F.split("row.text", "\n"), lambda line, i: ~F.array_contains("lines", i))
    text = F.when(F.col("lines").isNull(), F.col("row.text")).otherwise(F.array_join(kept, "\n"))
    return rows.select(*[text.alias(c) if c == "text" else F.col(f"row.`{c}`").alias(c) for c in docs.columns])
