"""Host statistics sampled next to a load test."""

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import json_guard as J
from ..functions.scalars import percent, used_memory_mib
from ..schema import HOST_STATS_TEXT


def read_host_stats(spark: SparkSession, path: str) -> DataFrame:
    rows = spark.read.schema(HOST_STATS_TEXT).options(header=True, mode="PERMISSIVE").csv(path)
    return rows.select(
        "time_utc",
        F.col("api_cpu_pct").try_cast("int").alias("api_cpu_pct"),
        percent("pg_cpu").alias("pg_cpu_pct"),
        used_memory_mib("pg_mem").alias("pg_mem_mib"),
        "pg_waits",
    )


def wait_counts(stats: DataFrame) -> DataFrame:
    """``(time_utc, wait, sessions)``; a name that occurs twice in one sample is added up."""
    pairs = stats.select("time_utc", F.explode(F.split("pg_waits", " ")).alias("pair"))
    named = pairs.select(
        "time_utc",
        F.split_part("pair", F.lit(":"), F.lit(1)).alias("wait"),
        F.split_part("pair", F.lit(":"), F.lit(2)).try_cast("int").alias("n"),
    )
    return named.filter(F.col("n").isNotNull()).groupBy("time_utc", "wait").agg(F.sum("n").alias("sessions"))


def container_stats(lines: DataFrame, value: str = "value") -> DataFrame:
    """CPU and memory from container statistics in JSON, one object per row; parts that do not parse are NULL."""
    doc = J.with_fields(J.with_document(lines, value, "_doc"), "_doc", ("CPUPerc", "MemUsage", "MemPerc"))
    return doc.select(
        *lines.columns,
        percent(J.string_field("CPUPerc")).alias("pg_cpu_pct"),
        used_memory_mib(J.string_field("MemUsage")).alias("pg_mem_mib"),
        percent(J.string_field("MemPerc")).alias("pg_mem_pct"),
    )
