"""Removal of repeated paragraphs by MinHash banding.

A paragraph is a line. Its five-word shingles give ``BANDS * ROWS`` MinHash values; paragraphs that agree in a band are
candidates, exact Jaccard similarity of 0.8 or more makes a link, and of each connected component only the first paragraph
(by document id, then line) stays. Equal paragraphs count once.

The numbers of bands and rows come from ``tune``: the fewest bands that find a pair at the threshold with the wanted
probability. Members of a band's bucket are verified against its first member; only those that are not similar to it meet
the other members, and only members that the stars do not connect with them already, and whose sketches allow the similarity.
So a group of near-copies is linked by a star, and no connection between other members is lost.

Passages that repeat inside longer paragraphs: every run of ``PASSAGE`` words that a document with a lower id has, too, goes,
so of a longer shared passage all words go. Sampled runs are the candidate search only: runs of ``SAMPLED`` words that start
at an anchor, the word with the lowest hash among its neighbours. Any ``PASSAGE`` words hold a whole one. Around the
sampled runs that several documents have, all runs of ``PASSAGE`` words are hashed and grouped; nothing is paired.
"""

from collections.abc import Iterator
from functools import reduce
from operator import add

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import discard, saved
from .common import SPACED, components, lower_az, null_join, release, sized, small_batches, spaced
from .line_dedup import split_lines

SHINGLE, THRESHOLD, RECALL, ROWS = 5, 0.8, 0.999, 3
PASSAGE = 26
#: Words of a sampled run. It follows the anchor of the first ``PASSAGE - SAMPLED + 1`` words of a passage.
SAMPLED = PASSAGE // 2
#: Words of 64 bits in the sketch of a paragraph.
SKETCH = 4
#: Bytes of text that are worked on at once; their arrays stay in the cache of a core.
PIECE = 1 << 18
#: Bytes of words that are hashed one by one.
LONG = 32


def tune(threshold: float, recall: float, rows: int) -> int:
    """Bands that a pair at the threshold needs to agree in one of them with the wanted probability."""
    return int(np.ceil(np.log(1 - recall) / np.log(1 - threshold**rows)))


BANDS = tune(THRESHOLD, RECALL, ROWS)
_RNG = np.random.default_rng(17)
_FACTORS = _RNG.integers(1, 1 << 63, BANDS * ROWS, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_SPACE = np.isin(np.arange(256), list(b" \t\n\x0b\x0c\r"))
_XXH = np.array([0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5], np.uint64)
_MIX = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F], np.uint64)


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * _MIX[0]
    return h ^ (h >> np.uint64(29))


def _rotated(h: np.ndarray, bits: int) -> np.ndarray:
    return h << np.uint64(bits) | h >> np.uint64(64 - bits)


def _xxh64(buffer: bytes, start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """XXH64 of the words at ``start``; words of one length at once, except for long ones. Eight more bytes end the buffer."""
    n = len(buffer) - 8
    at8, at4, at1 = (np.ndarray((n,), kind, buffer, 0, (1,)) for kind in ("<u8", "<u4", "u1"))
    p1, p2, p3, p4, p5 = _XXH
    out = np.empty(len(start), np.uint64)
    kind = np.minimum(size, LONG).astype(np.uint8)
    order = np.argsort(kind, kind="stable")
    edges = np.searchsorted(kind[order], np.arange(LONG + 1))
    for length in range(1, LONG):
        own = order[edges[length] : edges[length + 1]]
        if not len(own):
            continue
        s, done = start[own], 0
        h = np.full(len(own), p5 + np.uint64(length))
        while length - done >= 8:
            h = _rotated(h ^ _rotated(at8[s + done] * p2, 31) * p1, 27) * p1 + p4
            done += 8
        if length - done >= 4:
            h = _rotated(h ^ at4[s + done] * p1, 23) * p2 + p3
            done += 4
        for i in range(done, length):
            h = _rotated(h ^ at1[s + i] * p5, 11) * p1
        h = (h ^ h >> np.uint64(33)) * p2
        h = (h ^ h >> np.uint64(29)) * p3
        out[own] = h ^ h >> np.uint64(32)
    for i in order[edges[LONG] :]:
        out[i] = xxhash.xxh64_intdigest(buffer[start[i] : start[i] + size[i]])
    return out


def word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the words of all texts in a row, and the number of words of each text."""
    buffer = b"\n".join(texts).lower()
    edges = np.flatnonzero(np.diff(~_SPACE[np.frombuffer(buffer, np.uint8)], prepend=False, append=False))
    start, size = edges[::2], edges[1::2] - edges[::2]
    begin = np.cumsum([0, *(len(t) + 1 for t in texts)])
    return _xxh64(buffer + bytes(8), start, size), np.diff(np.searchsorted(start, begin))


def runs(h: np.ndarray, length: int, at: np.ndarray | None = None) -> np.ndarray:
    """Hash of the ``length`` words from every word on, or from the words ``at``; short at the end."""
    out = np.zeros(max(len(h) - length + 1, 0) if at is None else len(at), np.uint64)
    for i in range(length):
        out = _mixed(out + (h[i : i + len(out)] if at is None else h[at + i]) * _MIX[1])
    return out


def bands(h: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Band keys ``(texts, BANDS)`` of texts with a word. A text of fewer words than a shingle is one shingle."""
    if not len(counts):
        return np.zeros((0, BANDS), np.uint64)
    every, begin = runs(h, SHINGLE), np.cumsum(counts) - counts
    own = np.maximum(counts - SHINGLE + 1, 1)
    first = np.cumsum(own) - own
    at = np.repeat(begin - first, own) + np.arange(own.sum())
    shingles = every[np.minimum(at, len(every) - 1)] if len(every) else np.zeros(len(at), np.uint64)
    for i in np.flatnonzero(counts < SHINGLE):
        shingles[first[i]] = runs(h[begin[i] : begin[i] + counts[i]], int(counts[i]))[0]
    keys = np.zeros((len(counts), BANDS), np.uint64)
    for j, factor in enumerate(_FACTORS):
        low = np.minimum.reduceat(_mixed(shingles * factor), first)
        keys[:, j // ROWS] = _mixed(keys[:, j // ROWS] + low)
    return keys


def _pieces(batch: pa.RecordBatch) -> Iterator[tuple[list[int], list[int], list[bytes]]]:
    """Rows, line numbers and lines of a batch ``(doc_id, text_hash, text)``, whole texts of some megabytes at a time."""
    row, line, texts, size = [], [], [], 0
    for i, text in enumerate(batch.column(2).cast(pa.binary()).to_pylist()):
        parts = text.split(b"\n")
        row += [i] * len(parts)
        line += range(len(parts))
        texts += parts
        size += len(text)
        if size > PIECE:
            yield row, line, texts
            row, line, texts, size = [], [], [], 0
    if texts:
        yield row, line, texts


def parts(docs: DataFrame) -> DataFrame:
    """Two kinds of rows, from one pass over the texts.

    A row ``(doc_id, text_hash, line, at, n, uid, bands)`` for each line with a word: words before it, words, identity. A row
    ``(doc_id, text_hash, at, h)`` for each anchored run of ``SAMPLED`` words, which may go on in the next line: place, hash.
    """
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, text_hash long, line int, at long, n long, uid long, bands array<long>, h long"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, line, texts in _pieces(batch):
                h, counts = word_hashes(texts)
                row, end = np.array(rows), np.cumsum(counts)
                new = np.flatnonzero(np.concatenate([[True], row[1:] != row[:-1]]))
                begin = (end - counts)[new]
                at = end - counts - np.repeat(begin, np.diff(np.append(new, len(row))))
                own, full = row[new], counts > 0
                row, n, end = row[full], counts[full], end[full]
                uid = [xxhash.xxh64_intdigest(h[a:b].tobytes()) for a, b in zip((end - n).tolist(), end.tolist(), strict=True)]
                keys = pa.ListArray.from_arrays(
                    pa.array(np.arange(len(n) + 1, dtype=np.int32) * BANDS), pa.array(bands(h, n).view(np.int64).ravel())
                )
                place = anchored(h, np.add.reduceat(counts, new))
                text = np.searchsorted(begin, place, side="right") - 1
                many, few = len(n), len(place)
                both = pa.array(np.concatenate([row, own[text]]))
                columns = [
                    batch.column(0).take(both),
                    batch.column(1).take(both),
                    pa.concat_arrays([pa.array(np.array(line, np.int32)[full]), pa.nulls(few, pa.int32())]),
                    pa.array(np.concatenate([at[full], place - begin[text]])),
                    pa.concat_arrays([pa.array(n), pa.nulls(few, pa.int64())]),
                    pa.concat_arrays([pa.array(np.array(uid, np.uint64).view(np.int64)), pa.nulls(few, pa.int64())]),
                    pa.concat_arrays([keys, pa.nulls(few, keys.type)]),
                    pa.concat_arrays([pa.nulls(many, pa.int64()), pa.array(runs(h, SAMPLED, place).view(np.int64))]),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "line", "at", "n", "uid", "bands", "h"])

    small_batches(docs.sparkSession)
    return docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").mapInArrow(run, schema)


def anchored(h: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Positions of the anchors in texts in a row from which a whole sampled run follows in the same text."""
    width, done = PASSAGE - SAMPLED + 1, 1
    if len(h) < PASSAGE:
        return np.zeros(0, np.int64)
    low = (1 << 28) - 1
    order = (_mixed(h) & ~np.uint64(low)) | np.arange(len(h), dtype=np.uint64)
    while done < width:
        step = min(done, width - done)
        order = np.minimum(order[:-step], order[step:])
        done += step
    text = np.repeat(np.arange(len(counts)), counts)
    at = np.unique(order[text[: len(order)] == text[width - 1 :]] & np.uint64(low)).astype(np.int64)
    at = at[at <= len(h) - SAMPLED]
    return at[(text[at] == text[at + SAMPLED - 1]) & (counts[text[at]] >= PASSAGE)]


def around(counts: np.ndarray, text: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Positions, in texts in a row, of the runs of ``PASSAGE`` words that hold the sampled run at word ``at`` of a ``text``."""
    begin = (np.cumsum(counts) - counts)[text]
    first, last = np.maximum(at - (PASSAGE - SAMPLED), 0), np.minimum(at, counts[text] - PASSAGE)
    edges = np.zeros(int(counts.sum()) + 1, np.int64)
    np.add.at(edges, begin + first, 1)
    np.add.at(edges, begin + last + 1, -1)
    return np.flatnonzero(np.cumsum(edges[:-1]))


def passages(docs: DataFrame, hits: DataFrame) -> DataFrame:
    """``(doc_id, text_hash, at, h)``: places and hashes of all runs of ``PASSAGE`` words around ``hits (.., places)``."""
    kind = docs.schema["doc_id"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for rows, _, texts in _pieces(batch):
                h, counts = word_hashes(texts)
                rows, new = np.unique(rows, return_index=True)
                counts = np.add.reduceat(counts, new)
                places = batch.column(3).take(pa.array(rows))
                text = np.repeat(np.arange(len(rows)), places.value_lengths().to_numpy(zero_copy_only=False))
                at = around(counts, text, places.flatten().to_numpy(zero_copy_only=False))
                key = runs(h, PASSAGE)[at]
                text = np.searchsorted(np.cumsum(counts), at, side="right")
                row = pa.array(rows[text])
                before = (np.cumsum(counts) - counts)[text]
                columns = [batch.column(0).take(row), batch.column(1).take(row), pa.array(at - before), pa.array(key.view(np.int64))]
                yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "at", "h"])

    small_batches(docs.sparkSession)
    texts = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text").join(sized(hits), ["doc_id", "text_hash"])
    texts = texts.select("doc_id", "text_hash", "text", "places")
    return texts.mapInArrow(run, f"doc_id {kind}, text_hash long, at long, h long")


def covered(starts: DataFrame) -> DataFrame:
    """``(doc_id, text_hash, at, n)``: the word ranges that the passages at ``(doc_id, text_hash, at)`` cover."""
    order = Window.partitionBy("doc_id", "text_hash").orderBy("at")
    new = F.coalesce(F.col("at") > F.lag("at").over(order) + PASSAGE, F.lit(True)).cast("int")
    upto = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranges = starts.withColumn("new", new).withColumn("range", F.sum("new").over(upto))
    ranges = ranges.groupBy("doc_id", "text_hash", "range").agg(F.min("at").alias("at"), F.max("at").alias("last"))
    return ranges.select("doc_id", "text_hash", "at", (F.col("last") - F.col("at") + PASSAGE).alias("n"))


def shingles(words: Column) -> Column:
    """The distinct shingles of a paragraph as hashes; a short one is a shingle itself."""
    last = F.greatest(F.size(words) - SHINGLE + 1, F.lit(1))
    return F.array_distinct(F.transform(F.sequence(F.lit(1), last), lambda i: F.xxhash64(F.slice(words, i, F.lit(SHINGLE)))))


def sketched(sets: DataFrame) -> DataFrame:
    """``(uid, m, bits)``: shingles of a set, and the parity of each of ``SKETCH`` * 64 classes of its shingles."""
    one = lambda s: F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(s, F.lit(64)).cast("int"))
    of = lambda i: F.filter("s", lambda s: F.pmod(F.shiftright(s, 6), F.lit(SKETCH)) == i)
    bits = [F.aggregate(of(i), F.lit(0).cast("long"), lambda a, s: a.bitwiseXOR(one(s))) for i in range(SKETCH)]
    return sets.select("uid", F.size("s").alias("m"), F.array(*bits).alias("bits"))


def _alike() -> Column:
    """True for all similar sets ``x`` and ``y``, and for few others.

    At a similarity of 0.8, at most a ninth of the shingles of both are in one set only. Every bit that differs
    between the sketches stands for at least one of these.
    """
    both = F.col("x.m") + F.col("y.m")
    differ = reduce(add, [F.bit_count(F.col("x.bits")[i].bitwiseXOR(F.col("y.bits")[i])) for i in range(SKETCH)])
    return differ * (1 + THRESHOLD) <= both * (1 - THRESHOLD) + 1e-6


def links(docs: DataFrame, units: DataFrame) -> DataFrame:
    """``(u, v)`` that connect all distinct paragraphs ``(uid, first, bands)`` which verified candidate pairs connect."""
    spark = docs.sparkSession
    tables = units.filter(f"n >= {SHINGLE}").select("uid", F.posexplode("bands").alias("band", "key"))
    filled = tables.groupBy("band", "key").agg(F.min("uid").alias("head"), F.count("*").alias("members")).filter("members > 1")
    tables = saved(tables.join(filled, ["band", "key"]).select("band", "key", "uid", "head"), "buckets")
    release(spark)

    involved = tables.select("uid").distinct()
    places = units.join(involved, "uid").select("uid", "first.doc_id", "first.text_hash", "first.line")
    places = saved(places, "places")
    texts = null_join(split_lines(docs), sized(places), ["doc_id", "text_hash", "line"]).select("uid", "text")
    words = spaced(lower_az(F.col("text")))
    sets = texts.dropDuplicates(["uid"]).withColumn("w", words).select("uid", shingles(F.col("w")).alias("s"))
    sets = saved(sets, "shingles")
    sketches = saved(sketched(sets), "sketches")

    def verified(pairs: DataFrame) -> DataFrame:
        """Pairs ``(u, v)`` that are similar."""
        pairs = pairs.select(F.least("u", "v").alias("u"), F.greatest("u", "v").alias("v")).distinct()
        pairs = pairs.join(sets.select(F.col("uid").alias("u"), F.col("s").alias("a")), "u")
        pairs = pairs.join(sets.select(F.col("uid").alias("v"), F.col("s").alias("b")), "v")
        shared = F.size(F.array_intersect("a", "b"))
        return pairs.filter(shared >= THRESHOLD * (F.size("a") + F.size("b") - shared)).select("u", "v")

    heads = tables.filter("uid != head").select(F.col("uid").alias("u"), F.col("head").alias("v"))
    star = saved(verified(heads), "star")
    both = star.unionByName(star.select(F.col("v").alias("u"), F.col("u").alias("v")))
    root = sketches.join(components(both), F.col("uid") == F.col("node"), "left")
    known = saved(root.select("uid", "m", "bits", F.coalesce("root", "uid").alias("root")), "known")
    members = saved(tables.join(known, "uid"), "members")
    rest = members.filter("uid != head").join(both.select(F.col("u").alias("uid"), F.col("v").alias("head")), ["uid", "head"], "left_anti")
    rest = saved(rest.select("band", "key", "uid", "m", "bits", "root"), "rest")
    meet = (F.col("x.band") == F.col("y.band")) & (F.col("x.key") == F.col("y.key")) & (F.col("x.root") != F.col("y.root"))
    others = rest.alias("x").join(members.alias("y"), meet & _alike())
    others = saved(verified(others.select(F.col("x.uid").alias("u"), F.col("y.uid").alias("v"))), "others")
    discard(tables, places, sets, sketches, known, members, rest)
    return star.unionByName(others)


def removed_ranges(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """All paragraphs with a flag ``gone``, and word ranges ``(doc_id, text_hash, at, n)`` of repeated passages."""
    docs = docs.select("doc_id", "text").filter("doc_id is not null and text is not null")

    def lowest_of(found: DataFrame) -> DataFrame:
        """``(h, low)`` of the runs that several documents have."""
        low = found.groupBy("h").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high"))
        return low.filter("low < high").select("h", "low")

    every = saved(parts(docs), "parts")
    found = every.filter("h is not null").select("doc_id", "text_hash", "at", "h")
    hits = found.join(lowest_of(found), "h").groupBy("doc_id", "text_hash").agg(F.collect_set("at").alias("places"))
    hits = saved(hits, "hits")
    release(docs.sparkSession)
    paragraphs = lines = saved(every.filter("uid is not null").drop("h"), "paragraphs")
    discard(every)
    place = F.struct("doc_id", "text_hash", "line")
    units = lines.groupBy("uid").agg(F.min(place).alias("first"), F.first("n").alias("n"), F.first("bands").alias("bands"))
    units = saved(units, "units")
    release(docs.sparkSession)
    member = components(links(docs, units))
    named = units.select("uid", "first").join(member, F.col("uid") == F.col("node"), "left")
    named = saved(named.select("uid", "first", F.coalesce("root", "uid").alias("root")), "named")
    lowest = named.groupBy("root").agg(F.min("first").alias("first"))
    lowest = named.select("uid", "root").join(lowest, "root").select("uid", "first")
    lines = lines.join(lowest, "uid").withColumn("gone", place > F.col("first"))
    lines = saved(lines.select("doc_id", "text_hash", "line", "at", "n", "gone"), "judged")
    discard(paragraphs, units, named)
    release(docs.sparkSession)

    found = saved(passages(docs, hits), "passages")
    again = found.join(lowest_of(found), "h").filter("doc_id > low").select("doc_id", "text_hash", "at")
    repeated = saved(covered(again), "repeated")
    discard(found)
    release(docs.sparkSession)
    return lines, repeated


def report(docs: DataFrame) -> DataFrame:
    """Per document: ``doc_id, n_paragraphs, n_removed, n_words, n_removed_words``.

    Removed words are those of removed paragraphs and of repeated passages. Null texts have no paragraphs. Documents without
    an id keep all, and nothing goes for their sake. Rows with the same id and text get the same answer.
    """
    lines, repeated = removed_ranges(docs)
    lines = lines.distinct()
    gone = F.sum(F.col("gone").cast("long")).alias("n_removed")
    per_doc = lines.groupBy("doc_id", "text_hash").agg(gone, F.count("*").alias("paragraphs"), F.sum("n").alias("words"))
    ranges = lines.filter("gone").select("doc_id", "text_hash", "at", "n").unionByName(repeated)
    order = Window.partitionBy("doc_id", "text_hash").orderBy("at")
    before = F.coalesce(F.max(F.col("at") + F.col("n")).over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    fresh = F.greatest(F.lit(0), F.col("at") + F.col("n") - F.greatest("at", before))
    words = ranges.withColumn("fresh", fresh).groupBy("doc_id", "text_hash").agg(F.sum("fresh").alias("n_removed_words"))
    # Texts with an id have been counted; only the others are split once more.
    text, none = F.coalesce("text", F.lit("")), F.col("doc_id").isNull()
    rows = docs.select(
        "doc_id",
        F.xxhash64("text").alias("text_hash"),
        F.when(none, F.size(F.filter(F.split(text, "\n"), lambda line: line.rlike(SPACED)))).alias("own_paragraphs"),
        F.when(none, F.size(spaced(text))).alias("own_words"),
    )
    out = null_join(null_join(rows, per_doc, ["doc_id", "text_hash"], "left"), words, ["doc_id", "text_hash"], "left")
    zero = lambda c: F.coalesce(c, F.lit(0)).cast("long").alias(c)
    counted = lambda name: F.coalesce(f"own_{name}", name, F.lit(0)).cast("long").alias(f"n_{name}")
    return out.select("doc_id", counted("paragraphs"), zero("n_removed"), counted("words"), zero("n_removed_words"))


def clean(docs: DataFrame) -> DataFrame:
    """The documents without the removed words, in the columns they came in; lines that lose all words go."""
    lines, repeated = removed_ranges(docs)
    ranges = lines.filter("gone").select("doc_id", "text_hash", "at", "n").unionByName(repeated).distinct()
    ranges = ranges.groupBy("doc_id", "text_hash").agg(F.collect_list(F.struct("at", "n")).alias("ranges"))
    rows = docs.select(F.struct(*docs.columns).alias("row"), "doc_id", F.xxhash64("text").alias("text_hash"))
    rows = null_join(rows, ranges, ["doc_id", "text_hash"], "left").select("row.*", F.col("ranges").alias("_ranges"))
    at, names = docs.columns.index("text"), docs.columns

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            *columns, lists = batch.columns
            texts = [_cut(t, r) if r else t for t, r in zip(columns[at].to_pylist(), lists.to_pylist(), strict=True)]
            columns[at] = pa.array(texts, columns[at].type)
            yield pa.RecordBatch.from_arrays(columns, names)

    small_batches(docs.sparkSession)
    return rows.mapInArrow(run, docs.schema)


def _cut(text: str, ranges: list[dict]) -> str:
    gone = {i for r in ranges for i in range(r["at"], r["at"] + r["n"])}
    out, i = [], 0
    for line in text.encode().split(b"\n"):
        words = line.split()
        kept = [w for j, w in enumerate(words, i) if j not in gone]
        if len(kept) == len(words):
            out.append(line)
        elif kept:
            out.append(b" ".join(kept))
        i += len(words)
    return b"\n".join(out).decode()
