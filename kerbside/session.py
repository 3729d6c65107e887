"""Session settings and the shared working folder."""

import re
import tempfile
import uuid
from collections.abc import Callable, Iterator
from concurrent.futures import ThreadPoolExecutor
from contextlib import contextmanager
from contextvars import ContextVar, copy_context

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

SETTINGS = {
    # A repeated member of a JSON object counts with its last value.
    "spark.sql.variant.allowDuplicateKeys": "true",
    "spark.sql.session.timeZone": "UTC",
    # The default encoding of instants carries no statistics, so time filters could not skip row groups.
    "spark.sql.parquet.outputTimestampType": "TIMESTAMP_MICROS",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    "spark.sql.adaptive.optimizeSkewsInRebalancePartitions.enabled": "true",
}


def configure(spark: SparkSession) -> SparkSession:
    """Applies the runtime settings the operators rely on: UTC instants and adaptive execution."""
    for key, value in SETTINGS.items():
        spark.conf.set(key, value)
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder; on a cluster a missing setting is an error.
    """
    base = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if base:
        return base.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder shared by all executors")
    base = tempfile.mkdtemp(prefix="kerbside-")
    spark.conf.set("spark.checkpoint.dir", base)
    return base


def work_path(spark: SparkSession, name: str) -> str:
    """A fresh path below the shared folder."""
    return f"{shared_dir(spark)}/kerbside/{name}-{uuid.uuid4().hex}"


_owner: ContextVar[list[str] | None] = ContextVar("owner", default=None)


@contextmanager
def scratch(spark: SparkSession) -> Iterator[None]:
    """Owns what is saved inside and deletes it at the end: for work that repeats within one application."""
    paths: list[str] = []
    token = _owner.set(paths)
    try:
        yield
    finally:
        _owner.reset(token)
        for path in paths:
            files, at = _file_system(spark, path)
            files.delete(at, True)


def _file_system(spark: SparkSession, path: str):
    at = spark._jvm.org.apache.hadoop.fs.Path(path)
    return at.getFileSystem(spark._jsc.hadoopConfiguration()), at


def found(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a pattern, in any file system that Spark reaches."""
    files, at = _file_system(spark, pattern)
    return [str(status.getPath().toString()) for status in files.globStatus(at) or []]


def together(spark: SparkSession, *tasks: Callable[[], object]) -> None:
    """Runs independent jobs at the same time; small ones mostly wait for the planner. The first failure is raised."""
    with ThreadPoolExecutor(len(tasks)) as pool:
        started = [pool.submit(copy_context().run, inheritable_thread_target(spark)(task)) for task in tasks]
        for task in started:
            task.result()


def is_folder(spark: SparkSession, path: str) -> bool:
    files, at = _file_system(spark, path)
    return any(status.isDirectory() for status in files.globStatus(at) or [])


def qualified(spark: SparkSession, path: str) -> str:
    """The path with its file system, as Spark names the files below it."""
    files, at = _file_system(spark, path)
    return re.sub("^file:/+", "file:/", files.makeQualified(at).toUri().toString())


def put_text(spark: SparkSession, path: str, text: str) -> None:
    """Writes a small file, in place of an earlier one."""
    files, at = _file_system(spark, path)
    stream = files.create(at, True)
    try:
        stream.write(text.encode())
    finally:
        stream.close()


def delete(spark: SparkSession, path: str) -> None:
    """Deletes a folder, if it is there."""
    files, at = _file_system(spark, path)
    files.delete(at, True)


def saved(df: DataFrame, name: str) -> DataFrame:
    """Writes an intermediate result to the shared folder and reads it back.

    Cuts the lineage of results that are used several times. Unlike cached blocks the files survive the loss of
    executors, and their sizes are known to the planner. They are deleted when the surrounding ``scratch`` ends, or
    else with the application.
    """
    path = work_path(df.sparkSession, name)
    owner = _owner.get()
    if owner is not None:
        owner.append(path)
    else:
        files, at = _file_system(df.sparkSession, path)
        files.deleteOnExit(at)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out._saved_at = path
    return out


def discard(*results: DataFrame) -> None:
    """Deletes saved results that nothing reads any more."""
    for df in results:
        files, at = _file_system(df.sparkSession, df._saved_at)
        files.delete(at, True)
