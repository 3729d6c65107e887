"""Monitor samples: profiles of the stored table, latest window per source, assembled sample rows."""

import time
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import MIB, is_stale, round_half_up, to_fixed
from ..functions.times import col, epoch_ms
from .panels import time_range, vehicles_per_bin


def table_profile(spark: SparkSession, path: str) -> DataFrame:
    """Rows and size of a stored table, one row. Parquet keeps no separate indexes, so their size is unknown.

    No data is read: the count is pushed down into the footers of the files (which needs the second generation of the
    Parquet reader, switched on in a session of its own), and the sizes come with the listing.
    """
    apart = spark.newSession()
    apart.conf.set("spark.sql.sources.useV1SourceList", "")
    apart.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    rows = apart.read.parquet(path).agg(F.count("*").alias("rows_approx"))
    files = apart.read.format("binaryFile").option("pathGlobFilter", "*.parquet").option("recursiveFileLookup", True).load(path)
    mib = to_fixed(files.agg(F.sum("length")).scalar() / F.lit(float(MIB)), 1)
    return rows.select("rows_approx", mib.alias("total_mib"), mib.alias("table_mib"), F.lit(None).cast("double").alias("index_mib"))


def city_wide_ms(readings: DataFrame, now, hours: int) -> float:
    """Wall-clock milliseconds of the city-wide panel over the last hours, all result rows computed."""
    end = _instant(now)
    recent = time_range(readings, end - F.make_dt_interval(hours=F.lit(hours)), end)
    start = time.perf_counter()
    vehicles_per_bin(recent).orderBy("time").write.format("noop").mode("overwrite").save()
    return round((time.perf_counter() - start) * 1000, 1)


def latest_snapshots(snapshots: DataFrame, now, source: str = "source") -> DataFrame:
    """The newest window of every source, under the monitor's column names.

    A snapshot whose time cannot be read is never the newest one; a source with no other has NULL in its row.
    """
    written = col("writtenAt").try_cast("timestamp")
    newest = snapshots.groupBy(source).agg(F.max_by(F.struct("*"), F.struct(written, "writtenAt")).alias("s")).select("s.*")
    age = (epoch_ms(_instant(now)) - epoch_ms(written)) / 1000
    return newest.select(
        source,
        F.col("deviceCount").alias("sim_devices"),
        round_half_up(age).cast("long").alias("sim_age_s"),
        to_fixed(F.try_divide(F.col("readingsSent").cast("double"), F.col("windowSeconds")), 1).alias("sent_per_s"),
        F.col("p50").alias("p50_ms"),
        F.col("p95").alias("p95_ms"),
        F.col("p99").alias("p99_ms"),
        "status400",
        "status5xx",
        "timeouts",
        F.col("networkErrors").alias("neterr"),
        "buffered",
    )


def _instant(now):
    return F.lit(now).cast("timestamp") if isinstance(now, str) else F.lit(now)


def assemble(sample_times: DataFrame, collectors: list[DataFrame], on: str = "timestamp") -> DataFrame:
    """One row per sample time with the columns of all collectors; a missing part leaves its columns NULL."""
    return reduce(lambda rows, part: rows.join(part, on, "left"), collectors, sample_times)


def with_elapsed(samples: DataFrame, ts: str = "timestamp") -> DataFrame:
    """Minutes since the first sample, to one digit."""
    start = samples.agg(epoch_ms(F.min(col(ts))).alias("start")).scalar()
    return samples.withColumn("elapsed_min", to_fixed((epoch_ms(ts) - start) / 60000, 1))


def sample_report(samples: DataFrame) -> DataFrame:
    """Typed columns behind the sample table: whole minutes, stale flag, sizes in GiB."""
    return samples.withColumn("elapsed_whole_min", round_half_up("elapsed_min").cast("long")).withColumn(
        "is_stale", is_stale("sim_age_s")
    )
