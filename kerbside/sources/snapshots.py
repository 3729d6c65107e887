"""Window snapshots: one JSON object per finished window of a source."""

from pyspark.sql import DataFrame, SparkSession

from ..schema import SNAPSHOT


def read_snapshots(spark: SparkSession, path: str, multi_line: bool = False) -> DataFrame:
    return spark.read.schema(SNAPSHOT).option("multiLine", multi_line).json(path)
