"""What several corpus operators share: tables, intermediate results, grouped batches, connected components."""

import gc
from collections.abc import Iterable, Iterator
from functools import reduce
from operator import and_

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.scale import plan_bytes
from ..session import saved

#: Words that are separated by ASCII white space.
SPACED = r"[^\x20\x09-\x0D]+"

#: Rows in a batch that Spark hands to Python. Texts may be long, so batches are short.
BATCH_ROWS = 256

#: Most bytes of files whose rows are broadcast to a join.
BROADCAST_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def small_batches(spark: SparkSession) -> None:
    """Bounds what one Python worker holds of the texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))


def lower_az(text: Column) -> Column:
    """Lower-cases A-Z and nothing else; pure ASCII texts take the fast built-in."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    return F.when(F.length(text) == F.octet_length(text), F.lower(text)).otherwise(F.translate(text, upper, lower))


def spaced(text: Column) -> Column:
    """What ``SPACED`` finds in a text, in order. Single characters are replaced and split at, a tenth of the work."""
    return F.array_remove(F.split(F.translate(text, "\t\n\x0b\x0c\r", " " * 5), " "), "")


def release(spark: SparkSession) -> None:
    """Lets Spark delete the shuffle files of results that are written by now; it does when their handles are collected."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()


def sized(stored: DataFrame, limit: int = BROADCAST_BYTES) -> DataFrame:
    """A stored table, to be broadcast if its files are below the limit; else Spark chooses the join."""
    return F.broadcast(stored) if plan_bytes(stored) <= limit else stored


def null_join(left: DataFrame, right: DataFrame, keys: list[str], how: str = "inner") -> DataFrame:
    """Equi-join in which null keys pair with each other; the keys of the left side stay."""
    right = right.withColumnsRenamed({k: f"_{k}_r" for k in keys})
    condition = reduce(and_, [F.col(k).eqNullSafe(F.col(f"_{k}_r")) for k in keys])
    return left.join(right, condition, how).drop(*[f"_{k}_r" for k in keys])


def groups(batches: Iterable[pa.RecordBatch], n_keys: int) -> Iterator[list[np.ndarray]]:
    """Arrays of the columns for each run of rows that agree in the first ``n_keys`` columns.

    The input is sorted by those columns, so only the run at the end of a batch waits for the next batch. The
    caller makes sure that a run is bounded.
    """
    rest: list[np.ndarray] | None = None
    for batch in batches:
        cols = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if rest is not None:
            cols = [np.concatenate([a, b]) for a, b in zip(rest, cols, strict=True)]
        n = len(cols[0])
        if n == 0:
            continue
        change = np.zeros(n - 1, bool)
        for c in cols[:n_keys]:
            change |= c[1:] != c[:-1]
        cuts = np.concatenate([[0], np.flatnonzero(change) + 1])
        for a, b in zip(cuts[:-1], cuts[1:], strict=True):
            yield [c[a:b] for c in cols]
        rest = [c[cuts[-1] :] for c in cols]
    if rest is not None and len(rest[0]):
        yield rest


def components(edges: DataFrame) -> DataFrame:
    """Connected components of ``edges (u, v)``: a row ``(node, root)`` for each node of an edge.

    Alternates the large-star and small-star steps. Each step is one aggregation with map-side combine and one join
    that adaptive execution can split, so neither a hub nor a large component meets in one task. Every step is
    written to the shared folder, which cuts the lineage. The root is the smallest node.
    """
    e = edges.filter("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e = saved(e, "edges")
    before = _fingerprint(e)
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        lowest = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.join(lowest, "u").filter("v > u and v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = saved(large.distinct(), "edges")
        lowest = e.groupBy("u").agg(F.min("v").alias("m"))
        small = e.join(lowest, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        e = saved(small.unionByName(lowest.withColumnRenamed("m", "v")).distinct(), "edges")
        after = _fingerprint(e)
        if after == before:
            break
        before = after
    roots = e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    return saved(e.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(roots), "components")


def _fingerprint(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first())
