"""The device dimension: seeding, loading, expected rates."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import device_id
from .scale import lookup


def device_rows(numbers: DataFrame, count) -> DataFrame:
    """Device rows for a column ``n`` of numbers: the lower half of ``count`` reports every 15 s, the rest every 60 s."""
    n = F.col("n")
    return numbers.select(
        device_id(n).alias("device_id"),
        F.concat(F.lit("Sensor "), n.cast("string")).alias("name"),
        F.when(n <= F.floor(count / 2), 15).otherwise(60).cast("int").alias("interval_seconds"),
    )


def seed_devices(spark: SparkSession, count: int) -> DataFrame:
    return device_rows(spark.range(1, count + 1).withColumnRenamed("id", "n"), F.lit(count))


def missing_devices(wanted: DataFrame, existing: DataFrame) -> DataFrame:
    """The rows an insert-if-absent would add; its count is the number of rows added."""
    return lookup(wanted, existing.select("device_id").distinct(), "device_id", "left_anti")


def load_devices(devices: DataFrame) -> DataFrame:
    """The two columns every lookup needs."""
    return devices.select("device_id", "interval_seconds")


def expected_rate(devices: DataFrame) -> DataFrame:
    """Readings per second and per minute that the active devices produce, one row."""
    per_minute = F.coalesce(F.sum(F.expr("60 div interval_seconds")), F.lit(0))
    rate = devices.agg(F.count("*").alias("devices"), per_minute.alias("readings_per_min"))
    return rate.withColumn("readings_per_s", F.col("readings_per_min") / 60)
