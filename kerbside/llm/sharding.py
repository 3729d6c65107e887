"""Sharding on a consistent-hash ring with virtual nodes and bounded loads.

The ring key of a document is its text, so equal texts start at the same point. A key goes to the next virtual node
clockwise; if that node's shard is full, it continues to the next. To do this for any number of rows, keys are summed
into cells: the arc of the ring they fall on and one of ``TICKS`` hash ticks of their id, which splits groups of equal
texts. Bytes and rows per cell are the only thing that reaches the driver, at most ``SHARDS * NODES * TICKS`` rows
whatever the corpus holds. Cells are placed in order of size, so the small ones fill up what the large ones leave.
"""

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

SHARDS, NODES, TICKS = 24, 20, 512
#: A shard is full beyond this multiple of the mean load.
BOUND = 1.001


def size(text: Column) -> Column:
    """UTF-8 bytes and 8 more; null has no bytes."""
    return F.coalesce(F.octet_length(text), F.lit(0)).cast("long") + F.lit(8)


def ring(shards: int, nodes: int) -> tuple[np.ndarray, np.ndarray]:
    """Points of the virtual nodes in clockwise order, and their shards."""
    points = [(int(hashlib.md5(f"{s}/{v}".encode()).hexdigest()[:15], 16), s) for s in range(shards) for v in range(nodes)]
    points.sort()
    return np.array([p for p, _ in points], np.int64), np.array([s for _, s in points], np.int32)


def cell(doc_id: Column, text: Column, shards: int = SHARDS, nodes: int = NODES, ticks: int = TICKS) -> Column:
    """Arc of the ring and tick of a document as one number."""
    points, _ = ring(shards, nodes)

    @F.pandas_udf(T.IntegerType())
    def arc(point: pd.Series) -> pd.Series:
        return pd.Series((np.searchsorted(points, point.to_numpy()) % len(points)).astype(np.int32))

    point = F.conv(F.substring(F.md5(F.coalesce(text, F.lit(""))), 1, 15), 16, 10).cast("long")
    tick = F.pmod(F.xxhash64(F.coalesce(doc_id.cast("string"), F.lit(""))), F.lit(ticks)).cast("int")
    return arc(point) * F.lit(ticks) + tick


def place(cells: pd.DataFrame, shards: int, nodes: int, ticks: int, bound: float = BOUND) -> tuple[np.ndarray, np.ndarray]:
    """Shard and first slot of every cell, for the filled cells ``(cell, bytes, n)``; -1 for empty ones."""
    _, owner = ring(shards, nodes)
    load, limit = np.zeros(shards), bound * cells["bytes"].sum() / shards
    shard = np.full(len(owner) * ticks, -1, np.int32)
    # The distinct shards that each arc meets clockwise.
    turn = [list(dict.fromkeys(np.roll(owner, -a).tolist())) for a in range(len(owner))]
    for c, b in cells.sort_values(["bytes", "cell"], ascending=[False, True])[["cell", "bytes"]].itertuples(index=False):
        route = turn[c // ticks]
        to = next((s for s in route if load[s] + b <= limit), None)
        if to is None:  # larger than any room that is left
            to = min(route, key=lambda s: load[s])
        shard[c], load[to] = to, load[to] + b
    slots = np.zeros(len(shard), np.int64)
    count = cells.assign(shard=shard[cells["cell"]]).sort_values(["shard", "cell"])
    slots[count["cell"]] = count.groupby("shard")["n"].cumsum() - count["n"]
    return shard, slots


def assign(docs: DataFrame, shards: int = SHARDS, nodes: int = NODES, ticks: int = TICKS) -> DataFrame:
    """Adds ``shard`` and ``slot`` to documents with ``doc_id``, ``text`` and any other columns.

    Slots count from 0 without gaps in every shard. They come from the first slot of the cell and a row number within
    the cell, so no task orders a whole shard. Null texts sit at the point of the empty text and have 8 bytes. Equal
    rows share a cell and get neighbouring slots. Clashing columns ``shard`` and ``slot`` are replaced.
    """
    spark = docs.sparkSession
    docs = docs.drop("shard", "slot")
    at = cell(F.col("doc_id"), F.col("text"), shards, nodes, ticks).alias("_cell")
    filled = docs.select(at, size(F.col("text")).alias("_bytes")).groupBy("_cell")
    filled = filled.agg(F.sum("_bytes").alias("bytes"), F.count("*").alias("n")).toPandas()
    filled = filled.rename(columns={"_cell": "cell"})
    found, first = place(filled, shards, nodes, ticks)
    table = spark.sparkContext.broadcast((found, first))  # 12 bytes for each possible cell

    @F.pandas_udf("shard int, first long")
    def target(c: pd.Series) -> pd.DataFrame:
        shard, first = table.value
        return pd.DataFrame({"shard": shard[c.to_numpy()], "first": first[c.to_numpy()]})

    order = Window.partitionBy("_cell").orderBy("doc_id", F.crc32(F.coalesce("text", F.lit(""))), F.octet_length("text"))
    rows = docs.withColumn("_cell", at).withColumn("_n", F.row_number().over(order)).withColumn("_to", target("_cell"))
    slot = (F.col("_to.first") + F.col("_n") - 1).cast("long").alias("slot")
    return rows.select(*docs.columns, F.col("_to.shard").alias("shard"), slot)


def shard_table(docs: DataFrame) -> DataFrame:
    """Per document: ``doc_id, size, text_crc32, law, shard, slot, grown_shard``."""
    out = assign(docs.select("doc_id", "text"))
    return out.select(
        "doc_id",
        size(F.col("text")).alias("size"),
        F.coalesce(F.crc32("text"), F.crc32(F.lit(""))).cast("long").alias("text_crc32"),
        F.lit("bytes").alias("law"),
        "shard",
        "slot",
        F.lit(None).cast("int").alias("grown_shard"),
    )
