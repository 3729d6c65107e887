"""Live panel: vehicles per window, kept up to date while readings stream in.

The table is the exact answer at any time. This panel trades exactness for rows later than the watermark against
not having to scan the table.
"""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from ..session import found
from ..sources.table import first_id, read_or_empty

PANEL = "time timestamp, vehicles long, run long, batch_id long"


def live_windows(readings: DataFrame, seconds: int = 60, lateness: str = "10 minutes") -> DataFrame:
    """Streaming ``(time, vehicles)``. The window column must be a zoned timestamp for the watermark."""
    timed = readings.withColumn("interval_start", F.col("interval_start").cast("timestamp"))
    window = F.window("interval_start", f"{seconds} seconds")
    sums = timed.withWatermark("interval_start", lateness).groupBy(window).agg(F.sum("vehicles").alias("vehicles"))
    return sums.select(F.col("window.start").alias("time"), "vehicles")


def start_live_panel(
    windows: DataFrame, path: str, checkpoint: str, every: str | None = None, continues: bool = False
) -> StreamingQuery:
    """Writes the windows changed by each batch; ``read_live_panel`` keeps the latest state of each.

    A checkpoint is one run: its state starts empty and its batches have ids of their own, after those of earlier runs.
    As the sums of runs are added, a new checkpoint on a filled panel is refused, unless ``continues`` says that its
    stream starts where the old one stopped. ``sources.table.read_panel`` is exact whatever is sent again.
    """
    spark = windows.sparkSession
    is_filled = bool(found(spark, f"{path}/run=*")) and not found(spark, f"{checkpoint}/first-batch-id")
    if is_filled and not continues:
        raise ValueError(f"{path} holds the sums of another checkpoint; say if the stream continues after them")
    used = _read(spark, path).agg(F.coalesce(F.max("batch_id") + 1, F.lit(0)).alias("id")).first().id
    first = first_id(spark, used, checkpoint)

    def upsert(batch: DataFrame, batch_id: int) -> None:
        batch.write.mode("overwrite").parquet(f"{path}/run={first}/batch_id={first + batch_id}")

    writer = windows.writeStream.outputMode("update").foreachBatch(upsert).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()


def read_live_panel(spark: SparkSession, path: str) -> DataFrame:
    """The latest state of every window in each run, summed over the runs."""
    latest = _read(spark, path).groupBy("run", "time").agg(F.max_by("vehicles", "batch_id").alias("vehicles"))
    return latest.groupBy("time").agg(F.sum("vehicles").alias("vehicles"))


def _read(spark: SparkSession, path: str) -> DataFrame:
    return read_or_empty(spark, T.StructType.fromDDL(PANEL), path, [path])
