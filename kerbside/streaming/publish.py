"""From submitted batches to the topic: validate each micro-batch and pass accepted readings on as messages."""

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from ..operators.validation import validate_submissions
from ..operators.wire import encode
from ..session import configure, scratch


def publish_batch(submissions: DataFrame, devices: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Messages of the accepted batches and the rejected batches of ``(batch_id, received_at, body)``."""
    accepted, rejected = validate_submissions(submissions, devices)
    return encode(accepted.withColumn("accepted_at", F.col("received_at").cast("timestamp"))), rejected


def start_publish(
    submissions: DataFrame,
    send: Callable[[DataFrame, int], None],
    reject: Callable[[DataFrame, int], None],
    checkpoint: str,
    devices: Callable[[SparkSession], DataFrame],
    every: str | None = None,
) -> StreamingQuery:
    """Runs the validation as a stream. ``send`` and ``reject`` store the rows of one micro-batch.

    A replay sends a micro-batch again; the ingest drops what is stored already. Without ``every`` it drains what is
    there and stops.
    """

    def flush(batch: DataFrame, batch_id: int) -> None:
        spark = configure(batch.sparkSession)
        with scratch(spark):
            messages, rejected = publish_batch(batch, devices(spark))
            send(messages, batch_id)
            reject(rejected, batch_id)

    writer = submissions.writeStream.foreachBatch(flush).option("checkpointLocation", checkpoint)
    writer = writer.trigger(processingTime=every) if every else writer.trigger(availableNow=True)
    return writer.start()
