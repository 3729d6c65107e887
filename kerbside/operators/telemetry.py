"""Numbers about the pipeline itself: request windows, micro-batches, delays, lag, request packing."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.scalars import round_half_up
from ..functions.times import bin_start, epoch_ms
from ..schema import MAX_BATCH
from .scale import nearest_rank, numbered, time_chunk, upper_median, value_at_rank
from .validation import outcome


def percentiles(df: DataFrame, keys: list[str], value: str, ps=(50, 95, 99)) -> DataFrame:
    """Exact nearest-rank percentiles of a whole-number column, one row per group."""
    return value_at_rank(df, keys, value, {f"p{p}": nearest_rank(p) for p in ps})


def median(df: DataFrame, keys: list[str], value: str, out: str = "median") -> DataFrame:
    """The middle value, the higher one of an even number, one row per group."""
    return value_at_rank(df, keys, value, {out: upper_median()}).drop("n")


def request_windows(requests: DataFrame, seconds: int, keys: list[str] = ()) -> DataFrame:
    """Counters per reporting window of requests ``(ts, status, error, latency_ms, n_readings, queued)``.

    Percentiles cover answered requests only and are exact for latencies of any size: no group is held as a whole.
    """
    kind = F.col("kind")
    answered = kind.isin("ok", "rejected", "5xx")
    marked = requests.withColumn("kind", outcome("status", "error")).withColumn("window_start", bin_start("ts", seconds))
    groups = [*keys, "window_start"]
    ranks = percentiles(marked.filter(answered), groups, "latency_ms").drop("n")
    counted = marked.groupBy(*keys, "window_start").agg(
        F.count("*").alias("requests"),
        F.sum("n_readings").alias("readings_sent"),
        F.coalesce(F.sum(F.when(kind == "ok", F.col("queued"))), F.lit(0)).alias("queued"),
        F.count_if(kind == "ok").alias("status200"),
        F.count_if(kind == "rejected").alias("status400"),
        F.count_if(kind == "5xx").alias("status5xx"),
        F.count_if(kind == "timeout").alias("timeouts"),
        F.count_if(kind == "network").alias("network_errors"),
        F.count_if(answered).alias("answered"),
    )
    return counted.join(ranks, groups, "left").fillna(0, ["p50", "p95", "p99"])


def with_rate(windows: DataFrame, seconds: int) -> DataFrame:
    return windows.withColumn("sent_per_s", F.col("readings_sent") / seconds)


def ingest_rollup(batches: DataFrame, seconds: int = 10) -> DataFrame:
    """Micro-batch counters ``(ts, inserted, duplicates, skipped, store_retries)`` per reporting window."""
    sums = batches.groupBy(bin_start("ts", seconds).alias("time")).agg(
        F.count("*").alias("batches"),
        F.sum("inserted").alias("inserted"),
        F.sum("duplicates").alias("duplicates"),
        F.sum("skipped").alias("skipped"),
        F.sum("store_retries").alias("store_retries"),
    )
    average = F.try_divide(F.col("inserted") + F.col("duplicates"), F.col("batches"))
    return sums.withColumn("avg_batch", F.coalesce(round_half_up(average), F.lit(0)).cast("long"))


def flush_times(batches: DataFrame, seconds: int = 10) -> DataFrame:
    return _middle_and_max(batches.withColumn("time", bin_start("ts", seconds)), "flush_ms", "flush_ms")


def end_to_end_delay(rows: DataFrame, seconds: int = 10) -> DataFrame:
    """Delay from acceptance to storage in ms, median (nearest rank) and maximum per window of storage time."""
    delay = rows.select(
        bin_start("stored_at", seconds).alias("time"),
        (epoch_ms("stored_at") - epoch_ms("accepted_at")).alias("delay_ms"),
    )
    return _middle_and_max(delay, "delay_ms", "end_to_end_ms")


def _middle_and_max(df: DataFrame, value: str, prefix: str) -> DataFrame:
    ranks = {f"{prefix}_p50": nearest_rank(50), f"{prefix}_max": F.col("n")}
    return value_at_rank(df, ["time"], value, ranks).drop("n")


def lag_per_partition(ends: DataFrame, committed: DataFrame) -> DataFrame:
    """Messages not yet committed per partition: log end minus committed offset.

    Without a commit (missing or negative) everything still retained counts.
    """
    marks = ends.join(committed.select("partition", F.col("offset").alias("committed")), "partition", "left")
    start = F.when(F.col("committed") >= 0, F.col("committed")).otherwise(F.col("low"))
    return marks.select("partition", "low", "high", "committed", (F.col("high") - start).alias("lag"))


def consumer_lag(ends: DataFrame, committed: DataFrame) -> DataFrame:
    return lag_per_partition(ends, committed).agg(F.coalesce(F.sum("lag"), F.lit(0)).alias("lag"))


def pack_batches(pending: DataFrame, size: int = MAX_BATCH) -> DataFrame:
    """Adds ``batch_no``: pending readings per device, oldest first, ``size`` per request. Batch 0 goes first."""
    rows = pending.withColumn("chunk", time_chunk("interval_start"))
    ranked = numbered(rows, ["device_id"], "interval_start", "_rank")
    return ranked.withColumn("batch_no", F.expr(f"(_rank - 1) div {size}")).drop("_rank", "chunk")
