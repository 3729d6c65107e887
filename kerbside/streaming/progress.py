"""Gauges of running queries: progress reports kept as a table, and the lag that follows from them.

A ``ProgressLog`` listens to one query. Every report is stored as it is, one file per batch, in any file system that Spark
reaches; what the stream observed of a batch (messages, committed offset per partition) is part of the report.
"""

import json
import threading
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQueryListener

from ..schema import TOPIC_PARTITIONS
from ..session import put_text

REPORT = (
    "batchId long, numInputRows long, sources array<struct<endOffset: string, latestOffset: string>>, "
    "observedMetrics map<string, map<string, long>>"
)
OFFSETS = "map<string, map<string, long>>"
OBSERVED = "topic"


class ProgressLog(StreamingQueryListener):
    """Keeps the progress reports of the query it is attached to below ``path``."""

    def __init__(self, spark: SparkSession, path: str, partitions: int = TOPIC_PARTITIONS):
        self.spark, self.path, self.partitions = spark, path, partitions
        self.name, self.run, self.ended = f"query-{uuid.uuid4().hex}", None, threading.Event()

    def observed(self, messages: DataFrame) -> DataFrame:
        """Messages ``(partition, offset)`` whose number and next offset per partition go into the reports."""
        ends = [F.max(F.when(F.col("partition") == p, F.col("offset") + 1)).alias(str(p)) for p in range(self.partitions)]
        return messages.observe(OBSERVED, F.count(F.lit(1)).alias("messages"), *ends)

    def attach(self, writer: DataStreamWriter) -> DataStreamWriter:
        self.spark.streams.addListener(self)
        return writer.queryName(self.name)

    def wait(self, seconds: float = 60) -> None:
        """Returns when all reports of the ended query are stored."""
        if not self.ended.wait(seconds):
            raise TimeoutError(f"no end of {self.name} was reported")
        self.spark.streams.removeListener(self)

    def onQueryStarted(self, event):
        if event.name == self.name:
            self.run = event.runId

    def onQueryProgress(self, event):
        if event.progress.runId == self.run:
            put_text(self.spark, f"{self.path}/{event.progress.batchId:012d}.json", event.progress.json)

    def onQueryIdle(self, event):
        pass

    def onQueryTerminated(self, event):
        if event.runId == self.run:
            self.ended.set()


def read_progress(spark: SparkSession, path: str) -> DataFrame:
    """``(batch_id, messages, ends, sources)`` per report; ``ends`` is the next offset per partition of the batch."""
    reports = spark.read.option("wholetext", True).text(path).select(F.from_json("value", REPORT).alias("r"))
    seen = F.col("r.observedMetrics")[OBSERVED]
    return reports.select(
        F.col("r.batchId").alias("batch_id"),
        F.coalesce(seen["messages"], F.col("r.numInputRows")).alias("messages"),
        F.map_filter(seen, lambda k, v: k.rlike("^[0-9]+$") & v.isNotNull()).alias("ends"),
        F.col("r.sources").alias("sources"),
    )


def reported_lag(source: Column, oldest: Column | None = None) -> Column:
    """Lag from one source of a report: latest minus processed offsets of all topic partitions.

    A partition without progress counts from its oldest retained offset, ``oldest[topic][partition]``. -1 when the source
    does not report its latest offset, or the oldest one is needed and not given.
    """
    latest, end = F.from_json(source["latestOffset"], OFFSETS), F.from_json(source["endOffset"], OFFSETS)
    oldest = F.lit(None).cast(OFFSETS) if oldest is None else oldest

    def of_topic(total, topic):
        def of_partition(sum_, part):
            done = F.coalesce(end[topic["key"]][part["key"]], oldest[topic["key"]][part["key"]])
            return sum_ + part["value"] - done

        return F.aggregate(F.map_entries(topic["value"]), total, of_partition)

    known = latest.isNotNull() & end.isNotNull()
    return F.coalesce(F.when(known, F.aggregate(F.map_entries(latest), F.lit(0).cast("long"), of_topic)), F.lit(-1).cast("long"))


def lag_after_batches(progress: DataFrame, ends: DataFrame) -> DataFrame:
    """``(batch_id, messages, lag, reported)`` after every recorded batch.

    ``lag`` counts from the log ends ``(partition, low, high)`` as the broker has them, so it grows while the query is
    stuck; a partition without progress counts from its oldest message. ``reported`` is what the sources themselves tell,
    -1 where they do not know their end.
    """
    known = progress.select("batch_id", "messages", F.explode_outer("sources").alias("source"), "ends")
    known = known.withColumn("reported", reported_lag(F.col("source")))
    batches = known.groupBy("batch_id").agg(
        F.max("messages").alias("messages"),
        F.when(F.min("reported") < 0, -1).otherwise(F.sum("reported")).alias("reported"),
    )
    done = progress.select("batch_id", F.explode("ends").alias("partition", "offset"))
    # One row per batch and partition: the offset that is committed by then.
    marks = batches.select("batch_id").crossJoin(F.broadcast(ends))  # as many rows as the topic has partitions
    marks = marks.join(done.withColumn("partition", F.col("partition").cast("int")), ["batch_id", "partition"], "left")
    upto = Window.partitionBy("partition").orderBy("batch_id").rowsBetween(Window.unboundedPreceding, 0)
    left = F.col("high") - F.coalesce(F.max("offset").over(upto), F.col("low"))
    lag = marks.select("batch_id", left.alias("lag")).groupBy("batch_id").agg(F.sum("lag").alias("lag"))
    return batches.join(lag, "batch_id").select("batch_id", "messages", "lag", "reported")


def progress_lag(progress: dict, oldest: dict | None = None) -> int:
    """``reported_lag`` over all sources of one report at hand, without a job."""
    total = 0
    for source in progress.get("sources", []):
        latest, end = _offsets(source.get("latestOffset")), _offsets(source.get("endOffset"))
        if latest is None or end is None:
            return -1
        for topic, parts in latest.items():
            for partition, high in parts.items():
                done = end.get(topic, {}).get(partition, (oldest or {}).get(topic, {}).get(partition))
                if done is None:
                    return -1
                total += high - done
    return total


def _offsets(value):
    if isinstance(value, str):
        value = json.loads(value)
    return value if isinstance(value, dict) else None
