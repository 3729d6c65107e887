"""Replay-safe ingest of the topic into the readings table.

The engine replays the same messages for the same batch id after a failure. A replay reads only rows of earlier
batches and overwrites its own partitions, so the table ends up as if every batch had run once. One writer per
table. Lateness is not limited: a reading of any age is stored when its key is new.
"""

import time
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..functions.times import epoch_ms
from ..operators import ingest as I
from ..operators.scale import absent_keys, nearest_rank, value_at_rank
from ..operators.wire import commit_offsets, decode
from ..session import configure, saved, scratch, together
from ..sources import table
from .progress import ProgressLog

DeviceReader = Callable[[SparkSession], DataFrame]


def ingest_batch(messages: DataFrame, batch_id: int, path: str, devices: DataFrame) -> None:
    """Stores one batch of messages ``(key, value, partition, offset)`` and its side rows, all under ``batch_id``."""
    spark = configure(messages.sparkSession)
    started = time.time()
    stored_at = F.timestamp_millis(F.lit(int(started * 1000)))
    with scratch(spark):
        decoded = saved(decode(messages), "decoded")
        readings = decoded.filter("is_decoded")
        unknown = saved(absent_keys(readings, devices, "device_id"), "unknown")
        good, refused = I.split_by_constraints(readings, devices, unknown)
        firsts = saved(I.first_writes(good), "firsts")
        stored = table.read_candidates(spark, path, firsts, batch_id)
        probed = saved(I.probe(firsts, stored), "probed")
        disputed = saved(I.disputed(probed), "disputed")
        table.begin_batch(spark, path, batch_id)
        undecodable = decoded.filter(~F.col("is_decoded")).withColumn("reason", F.lit("undecodable"))
        columns = ["partition", "offset", "key", "value", "reason"]
        refused = undecodable.select(columns).unionByName(refused.select(columns))
        summary: list[DataFrame] = []
        together(
            spark,
            lambda: table.write_batch(I.new_rows(probed).withColumn("stored_at", stored_at), path, batch_id),
            lambda: table.write_side(I.conflicts_with(good, disputed), path, "conflicts", batch_id),
            lambda: table.write_side(refused, path, "quarantine", batch_id),
            lambda: table.write_side(commit_offsets(decoded), path, "offsets", batch_id),
            lambda: summary.append(saved(_summary(decoded, probed, stored_at), "summary")),
        )
        flush_ms = F.lit(int((time.time() - started) * 1000))
        table.write_side(summary[0].withColumn("flush_ms", flush_ms), path, "batches", batch_id)


def _summary(decoded: DataFrame, probed: DataFrame, stored_at) -> DataFrame:
    counts = I.counters(probed)
    seen = decoded.agg(F.count("*").alias("messages"))
    # From acceptance to storage, over the new rows: the nearest-rank median and the maximum.
    delay = I.new_rows(probed).select((epoch_ms(stored_at) - epoch_ms("accepted_at")).alias("ms"))
    delays = value_at_rank(delay, [], "ms", {"p50": nearest_rank(50), "max": F.col("n")})
    row = seen.select(
        "messages",
        counts.select("accepted").scalar().alias("inserted"),
        counts.select("duplicates").scalar().alias("duplicates"),
    )
    return row.select(
        stored_at.alias("ts"),
        "messages",
        "inserted",
        "duplicates",
        (F.col("messages") - F.col("inserted") - F.col("duplicates")).alias("skipped"),
        F.lit(0).alias("store_retries"),
        delays.select("p50").scalar().alias("delay_ms_p50"),
        delays.select("max").scalar().alias("delay_ms_max"),
    )


def start_ingest(
    messages: DataFrame,
    path: str,
    checkpoint: str,
    devices: DeviceReader,
    every: str | None = None,
    progress: ProgressLog | None = None,
    fan: int = table.FAN,
) -> StreamingQuery:
    """Runs the ingest. Without ``every`` it drains what is there and stops; a restart resumes at the checkpoint.

    ``devices`` is called per batch, so new devices are seen without a restart. A batch is cut by age (``every``) or by
    count (the limit of the source, see ``sources.topic``). Earlier batches are merged ``fan`` at a time. ``progress``
    keeps the reports of the query.
    """

    first = table.first_batch_id(messages.sparkSession, path, checkpoint)

    def flush(batch: DataFrame, batch_id: int) -> None:
        ingest_batch(batch, first + batch_id, path, devices(batch.sparkSession))
        # The batch itself may still be replayed; the ones before are committed.
        table.compact(batch.sparkSession, path, first + batch_id, fan)

    if progress is not None:
        messages = progress.observed(messages)
    writer = messages.writeStream.foreachBatch(flush).option("checkpointLocation", checkpoint)
    if progress is not None:
        writer = progress.attach(writer)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()
