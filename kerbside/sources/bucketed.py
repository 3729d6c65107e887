"""Tables that are bucketed by a key, so that joins on it move no rows."""

from pyspark.sql import DataFrame, SparkSession


def write_bucketed(rows: DataFrame, name: str, key: str, buckets: int) -> None:
    """Stores a table of the session's catalogue in files by the hash of ``key``, sorted by it, one file per bucket.

    Tables with equally many buckets are joined bucket by bucket. A key's rows are all in one bucket, which is read by one
    task: keep a table with a hot key unbucketed, ``scale.lookup`` salts it.
    """
    spread = rows.repartition(buckets, key)
    spread.write.mode("overwrite").format("parquet").bucketBy(buckets, key).sortBy(key).saveAsTable(name)


def read_bucketed(spark: SparkSession, name: str) -> DataFrame:
    return spark.table(name)
