"""The message topic: Kafka in production, files with the same columns elsewhere."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import TOPIC


def read_kafka_stream(
    spark: SparkSession, brokers: str, topic: str, max_offsets: int | None = None, max_wait: str | None = None
) -> DataFrame:
    """Needs the Kafka connector on the class path. A new query starts at the oldest retained message.

    With both limits a batch is cut at ``max_offsets`` messages, or when it has waited ``max_wait`` for them.
    """
    reader = (
        spark.readStream.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("subscribe", topic)
        .option("startingOffsets", "earliest")
    )
    if max_offsets is not None:
        reader = reader.option("maxOffsetsPerTrigger", max_offsets)
        if max_wait is not None:
            reader = reader.option("minOffsetsPerTrigger", max_offsets).option("maxTriggerDelay", max_wait)
    return reader.load().select(
        F.col("key").cast("string").alias("key"), F.col("value").cast("string").alias("value"), "partition", "offset"
    )


def write_kafka(messages: DataFrame, brokers: str, topic: str) -> None:
    (
        messages.select("key", "value")
        .write.format("kafka")
        .option("kafka.bootstrap.servers", brokers)
        .option("kafka.acks", "all")
        .option("kafka.enable.idempotence", "true")
        .option("kafka.compression.type", "lz4")
        .option("kafka.linger.ms", "5")
        .option("topic", topic)
        .save()
    )


def read_file_stream(spark: SparkSession, path: str, max_files: int | None = None) -> DataFrame:
    """With one file per batch, a batch is as large as ``write_files`` lets a file become."""
    reader = spark.readStream.schema(TOPIC)
    if max_files is not None:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.parquet(path)


def write_files(messages: DataFrame, path: str, max_messages: int | None = None) -> None:
    """Appends messages ``(key, value, partition, offset)``; order within a key is carried by the offset."""
    writer = messages.select(*TOPIC.names).write.mode("append")
    if max_messages is not None:
        writer = writer.option("maxRecordsPerFile", max_messages)
    writer.parquet(path)
