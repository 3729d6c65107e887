"""Request-window logs written by a load generator."""

import re
from functools import reduce
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.times import iso_millis
from ..schema import WINDOW_COUNTERS
from ..session import found, is_folder, qualified

# Key of each counter in a log line (fixed values).
LOG_KEYS = {
    "sent": "sent",
    "reqs": "reqs",
    "s200": "200",
    "s400": "400",
    "s5xx": "5xx",
    "timeouts": "timeouts",
    "neterr": "neterr",
    "buffered": "buffered",
    "p50": "p50",
    "p95": "p95",
    "p99": "p99",
}
METRICS_LINE = r"\A\[([^\]]+)\] sent="


# One text column per line: the delimited reader knows encodings that the text reader does not.
_PLAIN_LINES = {"sep": "\u0001", "quote": "", "escape": "", "lineSep": "\n", "header": False}


def read_log_lines(spark: SparkSession, path: str | list[str], encoding: str = "UTF-8", base: str | None = None) -> DataFrame:
    """``(run, line)`` of logs of one encoding, split by size, so one huge log is read by many tasks.

    The run is the ``run=`` folder of the file, or else the file's place below ``base``, by default ``path``. Use
    ``UTF-16LE`` for logs of a Windows shell.
    """
    base = base or (path if isinstance(path, str) else None)
    reader = spark.read.option("basePath", base) if base and not _is_file(spark, base) else spark.read
    if encoding.upper() == "UTF-8":
        lines = reader.option("lineSep", "\n").text(path)
    else:
        keep = {"ignoreLeadingWhiteSpace": False, "ignoreTrailingWhiteSpace": False, "maxCharsPerColumn": -1}
        lines = reader.options(**_PLAIN_LINES, **keep, encoding=encoding, inferSchema=False).csv(path)
        lines = lines.withColumnRenamed("_c0", "value")
    run = F.col("run").cast("string") if "run" in lines.columns else _place(spark, base)
    return lines.select(run.alias("run"), _clean(F.col("value")).alias("line"))


def _is_file(spark: SparkSession, path: str) -> bool:
    return bool(found(spark, path)) and not is_folder(spark, path)


def _place(spark: SparkSession, base: str | None) -> Column:
    """The file's path below a folder, or below the fixed part of a pattern, so that equal names in several folders stay
    apart; else its name."""
    if base is None:
        return F.col("_metadata.file_name")
    file = F.regexp_replace("_metadata.file_path", "^file:/+", "file:/")
    fixed = re.split(r"/[^/]*[*?{\[]", base, maxsplit=1)[0]
    start = f"{qualified(spark, fixed)}/"
    return F.when(file.startswith(start), F.substring(file, len(start) + 1, 1 << 20)).otherwise(F.col("_metadata.file_name"))


def write_log_lines(lines: DataFrame, path: str, encoding: str = "UTF-8") -> None:
    """Writes ``(run, value)`` as logs, one folder per run."""
    writer = lines.write.mode("append").partitionBy("run")
    if encoding.upper() == "UTF-8":
        writer.text(path)
    else:
        writer.options(**_PLAIN_LINES, encoding=encoding, emptyValue="").csv(path)


def file_encodings(spark: SparkSession, path: str) -> DataFrame:
    """``(file, encoding)``: UTF-16LE for files that start with its byte order mark, else UTF-8.

    Tasks find the mark: it starts the first line of the split at the start of a file. This is one pass over the files,
    which nothing is parsed in.
    """
    lines = spark.read.option("lineSep", "\n").text(path)
    mark = F.substring(F.col("value").cast("binary"), 1, 2) == F.unhex(F.lit("FFFE"))
    starts = lines.filter("_metadata.file_block_start = 0").select(
        F.col("_metadata.file_path").alias("file"), mark.alias("mark"), F.monotonically_increasing_id().alias("at")
    )
    first = starts.groupBy("file").agg(F.min_by("mark", "at").alias("mark"))
    return first.select("file", F.when(F.col("mark"), "UTF-16LE").otherwise("UTF-8").alias("encoding"))


def detect_log_lines(spark: SparkSession, path: str) -> DataFrame:
    """``(run, line)`` of logs whose encoding is told by a byte order mark: UTF-16LE if there is one, else UTF-8.

    The files of each encoding are then read in splits. Only their names come to the driver, which lists them anyway.
    """
    by_encoding: dict[str, list[str]] = {}
    for row in file_encodings(spark, path).toLocalIterator():
        by_encoding.setdefault(row.encoding, []).append(unquote(row.file))
    parts = [read_log_lines(spark, files, encoding, path) for encoding, files in sorted(by_encoding.items())]
    return reduce(DataFrame.unionByName, parts) if parts else spark.createDataFrame([], "run string, line string")


def _clean(line: Column) -> Column:
    return F.regexp_replace(line, "\\A\ufeff|\r\\z", "")


def parse_windows(lines: DataFrame) -> DataFrame:
    """Request windows ``(run, end, counters...)`` from metrics lines; other lines are ignored."""
    metrics = lines.filter(F.col("line").rlike(METRICS_LINE))
    stamp = F.regexp_extract("line", METRICS_LINE, 1)
    return metrics.select(
        *[c for c in lines.columns if c != "line"],
        stamp.try_cast("timestamp").alias("end"),
        *[_counter(LOG_KEYS[c]).alias(c) for c in WINDOW_COUNTERS],
    )


def _counter(key: str) -> Column:
    # The last mention of a key counts, as whole word.
    return F.regexp_extract("line", rf"\A.*(?<![A-Za-z0-9_]){key}=([0-9]+)", 1).try_cast("long")


def format_windows(windows: DataFrame, seconds: int) -> DataFrame:
    """The log line of each window, the inverse of ``parse_windows``."""
    rate = F.floor(F.col("sent") / seconds + 0.5).cast("string")
    line = F.concat(
        F.lit("["), iso_millis("end"), F.lit("] sent="), F.col("sent"), F.lit(" ("), rate, F.lit("/s) reqs="),
        F.col("reqs"), F.lit(" 200="), F.col("s200"), F.lit(" 400="), F.col("s400"), F.lit(" 5xx="), F.col("s5xx"),
        F.lit(" timeouts="), F.col("timeouts"), F.lit(" neterr="), F.col("neterr"), F.lit(" queued="),
        F.col("s200"), F.lit(" buffered="), F.col("buffered"), F.lit(" latency p50="), F.col("p50"),
        F.lit("ms p95="), F.col("p95"), F.lit("ms p99="), F.col("p99"), F.lit("ms"),
    )
    return windows.select(*[c for c in windows.columns if c == "run"], line.alias("value"))
