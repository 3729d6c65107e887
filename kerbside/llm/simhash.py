"""SimHash near-duplicates by covering locality-sensitive hashing.

A 64-bit fingerprint is the majority of the XXH64 hashes of a text's word shingles. To find pairs within ``RADIUS`` bits,
every bit position gets a nonzero vector of ``RADIUS + 1`` bits; the mask of a nonzero vector v clears the positions
whose vector is orthogonal to v. Any ``RADIUS`` vectors have a common orthogonal v, so two fingerprints that differ in at
most that many bits agree under the mask of v: they meet in one of the 15 tables for certain.

A mask clears about 30 bits, so a bucket could hold many fingerprints. A bucket above ``BUCKET`` is split by a second
family of masks over its cleared bits, which covers every pair again and leaves 14 bits: 16,384 fingerprints at most.
Only distinct fingerprints are compared; links within a bucket leave it as a star, never as all pairs.
"""

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import saved
from .common import components, groups, small_batches

WORDS, RADIUS, SEED = 3, 3, 42
BUCKET = 1024


def masks(bits: list[int], radius: int = RADIUS) -> list[int]:
    """Covering masks over the given bit positions: the positions that each one clears, as 64-bit numbers."""
    top = 2 ** (radius + 1)
    vector = {bit: i % (top - 1) + 1 for i, bit in enumerate(bits)}
    return [sum(1 << b for b in bits if (vector[b] & v).bit_count() % 2 == 0) for v in range(1, top)]


def fingerprint(text: bytes | None, n_words: int = WORDS) -> int:
    """Majority bits of the shingle hashes; ``bytes.lower`` and ``bytes.split`` know ASCII only, as is wanted."""
    words = (text or b"").lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate([[0], ends[:-1] + 1])
    k = min(n_words, len(words))
    starts, ends = starts[: len(words) - k + 1], ends[k - 1 :]
    digest, ones = xxhash.xxh64_intdigest, np.zeros(64, np.int64)
    for at in range(0, len(starts), 65536):
        pairs = zip(starts[at : at + 65536].tolist(), ends[at : at + 65536].tolist(), strict=True)
        hashes = np.array([digest(joined[a:b], SEED) for a, b in pairs], "<u8")
        ones += np.unpackbits(hashes.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    majority = np.packbits(ones * 2 > len(starts), bitorder="little")
    return int(majority.view("<u8")[0])


def fingerprints(docs: DataFrame, n_words: int = WORDS) -> DataFrame:
    """``(doc_id, text_hash, fp)`` per document; ``fp`` is a signed long. Null texts have no words: 0."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = batch.column(2).cast(pa.binary())
            fps = np.array([fingerprint(t.as_py(), n_words) for t in texts], np.uint64)
            columns = [batch.column(0), batch.column(1), pa.array(fps.view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["doc_id", "text_hash", "fp"])

    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), "text")
    return rows.mapInArrow(run, f"doc_id {kind}, text_hash long, fp long")


def stars(fps: np.ndarray, radius: int) -> list[tuple[int, int]]:
    """Links from the first fingerprint of each connected group to its other members, in one bounded bucket."""
    left, out = np.unique(fps), []
    values = left.view(np.uint64)
    left = np.arange(len(values))
    while len(left):
        root, left = left[0], left[1:]
        front = [root]
        while front and len(left):
            near = np.bitwise_count(values[left] ^ values[front.pop()]) <= radius
            front.extend(left[near])
            out.extend((int(values[i].view(np.int64)), int(values[root].view(np.int64))) for i in left[near])
            left = left[~near]
    return out


def links(distinct: DataFrame, radius: int = RADIUS, bucket: int = BUCKET) -> DataFrame:
    """``(u, v)`` that connect the distinct fingerprints ``(fp)`` which can reach each other by steps within the radius."""

    def linked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, _, fps in groups(batches, 2):
            if len(fps) > 1 and (found := stars(fps, radius)):
                u, v = zip(*found, strict=True)
                yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], ["u", "v"])

    def meet(tables: DataFrame) -> DataFrame:
        return tables.repartition("t", "key").sortWithinPartitions("t", "key").mapInArrow(linked, "u long, v long")

    first = masks(list(range(64)), radius)
    tables = distinct.select("fp", F.posexplode(F.array(*[F.lit(_signed(~m)) for m in first])).alias("t", "mask"))
    tables = tables.select("t", F.col("fp").bitwiseAND(F.col("mask")).alias("key"), "fp")
    filled = tables.groupBy("t", "key").count().filter("count > 1")
    tables = saved(tables.join(filled, ["t", "key"]), "buckets")
    small = tables.filter(F.col("count") <= bucket).select("t", "key", "fp")
    large = tables.filter(F.col("count") > bucket)
    second = [F.array(*[F.lit(_signed(~n)) for n in masks([b for b in range(64) if m >> b & 1], radius)]) for m in first]
    large = large.select("t", "fp", F.posexplode(F.element_at(F.array(*second), F.col("t") + 1)).alias("t2", "mask"))
    large = large.select(
        (F.lit(len(first)) + F.col("t") * len(first) + F.col("t2")).cast("int").alias("t"),
        F.col("fp").bitwiseAND(F.col("mask")).alias("key"),
        "fp",
    )
    return meet(small.unionByName(large)).distinct()


def _signed(mask: int) -> int:
    return int(np.uint64(mask & (2**64 - 1)).view(np.int64))


def grouped(docs: DataFrame, n_words: int = WORDS, radius: int = RADIUS) -> DataFrame:
    """``(doc_id, text_hash, fp, root, component_id)`` per document; the component is named by its smallest doc_id.

    Texts without words have fingerprint 0 and are linked like any other. A null doc_id takes part; it names a component
    only if the component has no other. Repeated rows stay repeated. An empty table gives an empty table.
    """
    rows = saved(fingerprints(docs, n_words), "fingerprints")
    distinct = saved(rows.groupBy("fp").agg(F.min("doc_id").alias("low")), "distinct")
    member = components(links(distinct.select("fp"), radius))
    roots = distinct.join(member, distinct["fp"] == member["node"], "left")
    roots = saved(roots.select("fp", F.coalesce("root", "fp").alias("root"), "low"), "roots")
    names = roots.groupBy("root").agg(F.min("low").alias("component_id"))
    named = saved(roots.join(names, "root").select("fp", "root", "component_id"), "names")
    return rows.join(named, "fp").select("doc_id", "text_hash", "fp", "root", "component_id")


def near_duplicates(docs: DataFrame) -> DataFrame:
    """Per document: ``doc_id, fingerprint, component_id``."""
    out = grouped(docs)
    return out.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def row_key(doc_id: Column, text_hash: Column) -> Column:
    return F.concat_ws(":", F.coalesce(doc_id.cast("string"), F.lit("null")), text_hash)


def keep_one(docs: DataFrame) -> DataFrame:
    """One document of each component, the one with the smallest doc_id, in the columns they came in.

    Of rows that share this id, the one with the smallest text hash stays; of equal rows one stays.
    """
    pick = F.min(F.struct(F.col("doc_id").isNull(), "doc_id", "text_hash")).alias("pick")
    first = grouped(docs).groupBy("root").agg(pick)
    first = saved(first.select(row_key(F.col("pick.doc_id"), F.col("pick.text_hash")).alias("key")), "kept")
    rows = docs.select(F.struct(*docs.columns).alias("row"), row_key(F.col("doc_id"), F.xxhash64("text")).alias("key"))
    order = Window.partitionBy("key").orderBy(F.lit(0))
    kept = rows.join(first, "key", "left_semi").withColumn("n", F.row_number().over(order))
    return kept.filter("n = 1").select("row.*")
