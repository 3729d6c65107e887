"""The monitor-sample CSV: fixed columns, quoted where needed, empty cell for "not measured"."""

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..schema import SAMPLE_COLUMNS, SAMPLE_TEXT

_CSV = {"header": True, "quote": '"', "escape": '"', "lineSep": "\n"}


class SchemaMismatch(ValueError):
    """The existing file has other columns than the samples to append."""


def existing_columns(spark: SparkSession, path: str) -> list[str] | None:
    """Header of the samples already at ``path``, or None when there are none."""
    try:
        header = spark.read.option("header", True).csv(path).columns
    except AnalysisException:
        return None
    return header or None


def append_samples(samples: DataFrame, path: str) -> None:
    """Appends samples with all columns in file order; refuses when the existing header differs."""
    found = existing_columns(samples.sparkSession, path)
    if found is not None and found != list(SAMPLE_COLUMNS):
        raise SchemaMismatch(f"{path} has different columns: {', '.join(found)}")
    cells = samples.select(
        *[(F.col(c) if c in samples.columns else F.lit(None)).cast("string").alias(c) for c in SAMPLE_COLUMNS]
    )
    cells.write.mode("append").options(**_CSV, emptyValue="", nullValue="").csv(path)


def records(spark: SparkSession, path: str) -> DataFrame:
    """``(file, record, text)``: the records of quoted CSV files, numbered from 1 per file, read in splits.

    A line starts a record if the quotes before it in its file are even. Their number is a prefix sum on two levels: over the
    lines of a split, and over the splits of a file, of which one row each is ordered. Only lines of records with embedded
    line breaks are brought together, so a file of any size is read by many tasks.
    """
    lines = spark.read.option("lineSep", "\n").text(path).select(
        "value",
        F.col("_metadata.file_path").alias("file"),
        F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("at"),
    )
    odd = F.length(F.regexp_replace("value", '[^"]', "")) % 2
    before = Window.partitionBy("file", "split").orderBy("at").rowsBetween(Window.unboundedPreceding, -1)
    lines = lines.withColumn("odd", odd).withColumn("inside", F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2)
    splits = lines.groupBy("file", "split").agg(
        F.sum("odd").alias("odds"), F.count_if(F.col("inside") == 0).alias("even"), F.count_if(F.col("inside") == 1).alias("uneven")
    )
    earlier = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    splits = splits.withColumn("opened", F.coalesce(F.sum("odds").over(earlier), F.lit(0)) % 2)
    started = F.sum(F.when(F.col("opened") == 0, F.col("even")).otherwise(F.col("uneven"))).over(earlier)
    splits = splits.select("file", "split", "opened", F.coalesce(started, F.lit(0)).alias("records"))
    lines = lines.join(splits, ["file", "split"]).withColumn("starts", F.col("inside") == F.col("opened"))
    upto = Window.partitionBy("file", "split").orderBy("at").rowsBetween(Window.unboundedPreceding, 0)
    number = F.col("records") + F.sum(F.col("starts").cast("long")).over(upto)
    lines = lines.withColumn("record", number).withColumn("is_whole", F.col("starts") & (F.col("odd") == 0))
    whole = lines.filter("is_whole").select("file", "record", F.col("value").alias("text"))
    parts = lines.filter(~F.col("is_whole")).groupBy("file", "record")
    parts = parts.agg(F.sort_array(F.collect_list(F.struct("split", "at", "value"))).alias("lines"))
    joined = F.array_join(F.transform("lines", lambda line: line["value"]), "\n")
    return whole.unionByName(parts.select("file", "record", joined.alias("text")))


def read_samples(spark: SparkSession, path: str) -> DataFrame:
    """Samples as text columns. Short rows are padded with NULL, blank lines dropped, cells may hold line breaks."""
    rows = records(spark, path).filter("record > 1").withColumn("text", F.regexp_replace("text", "\r$", "")).filter("trim(text) <> ''")
    options = {"quote": '"', "escape": '"', "mode": "PERMISSIVE", "multiLine": "true", "lineSep": "\n"}
    return rows.select(F.from_csv("text", F.lit(SAMPLE_TEXT_DDL), options).alias("row")).select("row.*")


SAMPLE_TEXT_DDL = ", ".join(f"`{f.name}` string" for f in SAMPLE_TEXT)
