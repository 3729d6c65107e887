"""The readings table and its side tables, as parquet below one folder.

Every table has a folder per run of batches, ``run=<first>-<last>``: at first one batch, later what several were merged
into. A run counts once its folder in ``batches``, which is written last, is complete; a run inside a longer one that
counts is out of use. The complete folders of ``batches`` are thus the manifest of all tables: it changes in one step, and
a crash before that step changes nothing. Writing a run replaces exactly its folders, also when it has fewer rows or dates
than before or none, so a replay leaves nothing of the first try.

``FAN`` neighbouring runs of one size are merged into the next size (``compact``), so the number of folders grows with the
logarithm of the batches. Per run, ``minutes`` holds what its rows add to each minute, ``folders`` the time range of every
date, and ``filters`` a Bloom filter of the keys of every date, sized from their number: a batch opens only the stored
folders that may hold one of its keys.
"""

from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.scale import plan_bytes
from ..schema import READINGS
from ..session import delete, found, saved, together

SIDE_SCHEMAS = {
    "batches": "batch_id long, ts timestamp, messages long, inserted long, duplicates long, skipped long, "
    "store_retries long, flush_ms long, delay_ms_p50 long, delay_ms_max long",
    "offsets": "batch_id long, partition int, offset long",
    "conflicts": "batch_id long, device_id string, interval_start timestamp, stored_vehicles int, "
    "incoming_vehicles int, messages long, first_offset long",
    "quarantine": "batch_id long, partition int, offset long, key string, value string, reason string",
    "minutes": "time timestamp, vehicles long, readings long",
    "folders": "event_date date, words long, low timestamp, high timestamp",
    "filters": "event_date date, word long, bits long",
}
#: Tables whose rows are carried over when runs are merged; the others follow from the readings. The marker comes last.
CARRIED = ("offsets", "conflicts", "quarantine", "batches")
FAN = 4
#: Bits of a filter per key, and bits set by a key within one word of 64.
KEY_BITS, PROBES = 24, 5
KEY = ["device_id", "interval_start"]
#: Most bytes of folder names that are broadcast to the scan.
BROADCAST_BYTES = 16 << 20
#: Most bytes of stored keys that are broadcast to the filters.
SMALL_BYTES = 1 << 20
Run = tuple[int, int]


def folder(path: str, name: str, run: Run) -> str:
    return f"{path}/{name}/run={run[0]}-{run[1]}"


def _runs(spark: SparkSession, pattern: str) -> list[Run]:
    names = [part for file in found(spark, pattern) for part in file.split("/") if part.startswith("run=")]
    return sorted(tuple(map(int, name[4:].split("-"))) for name in names)


def complete_runs(spark: SparkSession, path: str) -> list[Run]:
    return _runs(spark, f"{path}/batches/run=*/_SUCCESS")


def live_runs(spark: SparkSession, path: str, before: int | None = None) -> list[Run]:
    """The runs that make up the table, in order; with ``before`` only those of earlier batches."""
    runs = [r for r in complete_runs(spark, path) if before is None or r[1] < before]
    return [r for r in runs if not any(o != r and o[0] <= r[0] and r[1] <= o[1] for o in runs)]


def read_or_empty(spark: SparkSession, schema, root: str, paths: list[str]) -> DataFrame:
    if not paths:
        return spark.createDataFrame([], schema)
    try:
        return spark.read.schema(schema).option("basePath", root).parquet(*paths)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def read_runs(spark: SparkSession, path: str, name: str, runs: list[Run]) -> DataFrame:
    """Rows of a table in some runs, with ``run`` as the folder's name has it."""
    schema = READINGS if name == "readings" else T.StructType.fromDDL(SIDE_SCHEMAS[name])
    schema = T.StructType([*schema.fields, T.StructField("run", T.StringType())])
    return read_or_empty(spark, schema, f"{path}/{name}", [folder(path, name, r) for r in runs])


def read_readings(spark: SparkSession, path: str) -> DataFrame:
    """Rows of finished batches. ``event_date`` is a partition column."""
    return read_runs(spark, path, "readings", live_runs(spark, path)).drop("run")


def read_side(spark: SparkSession, path: str, name: str) -> DataFrame:
    return read_runs(spark, path, name, live_runs(spark, path)).drop("run")


def read_panel(spark: SparkSession, path: str) -> DataFrame:
    """Exact ``(time, vehicles, readings)`` per minute of everything stored, from the minutes each run has added."""
    minutes = read_side(spark, path, "minutes").groupBy("time")
    return minutes.agg(F.sum("vehicles").alias("vehicles"), F.sum("readings").alias("readings"))


def _micros(ts: Column) -> Column:
    return F.unix_micros(ts)


def _bits() -> Column:
    """The bits that a key sets in its word."""
    hashed = F.xxhash64(F.lit(1), *KEY)
    bits = [F.call_function("shiftleft", F.lit(1).cast("long"), F.shiftrightunsigned(hashed, 6 * i).bitwiseAND(63).cast("int")) for i in range(PROBES)]
    out = bits[0]
    for bit in bits[1:]:
        out = out.bitwiseOR(bit)
    return out


def _word() -> Column:
    return F.xxhash64(*KEY).bitwiseAND(F.col("words") - 1)


def probe_folders(spark: SparkSession, path: str, keys: DataFrame, runs: list[Run]) -> DataFrame:
    """``(run, event_date)`` of the stored folders that may hold one of ``keys (device_id, interval_start)``.

    First by date and time range, then by the Bloom filters of the folders that are left, of which only the words that
    the keys fall on are compared. A folder without any of the keys is listed with a probability of about one in a
    thousand per key in its time range.
    """
    is_small = plan_bytes(keys) <= SMALL_BYTES
    keys = keys.select(*KEY, F.unix_date(F.to_date("interval_start")).alias("day"))
    folders = read_runs(spark, path, "folders", runs).withColumn("day", F.unix_date("event_date"))
    near = keys.join(_small(folders), "day").filter(F.col("interval_start").between(F.col("low"), F.col("high")))
    near = near.select("run", "event_date", _word().alias("word"), _bits().alias("wanted"))
    filters = read_runs(spark, path, "filters", runs)
    if is_small:
        near = F.broadcast(near)
    else:
        filters = filters.hint("merge")  # else adaptive execution may broadcast them
    hits = near.join(filters, ["run", "event_date", "word"]).filter(F.col("bits").bitwiseAND(F.col("wanted")) == F.col("wanted"))
    return hits.select("run", "event_date").distinct()


def _small(rows: DataFrame) -> DataFrame:
    return F.broadcast(rows) if plan_bytes(rows) <= BROADCAST_BYTES else rows


def read_candidates(spark: SparkSession, path: str, keys: DataFrame, before: int) -> DataFrame:
    """Stored readings of earlier batches that may have one of ``keys``, from the folders that may hold them.

    The folders reach the scan as dynamic partition pruning, so others are not opened; the time range of all keys reaches
    it as a filter on the file statistics. No list of dates or keys passes through the driver.
    """
    runs = live_runs(spark, path, before)
    if not runs:
        return spark.createDataFrame([], READINGS)
    span = keys.agg(F.min(_micros(F.col("interval_start"))).alias("low"), F.max(_micros(F.col("interval_start"))).alias("high")).first()
    if span.low is None:
        return spark.createDataFrame([], READINGS)
    hits = saved(probe_folders(spark, path, keys, runs), "folders")
    inside = f"interval_start BETWEEN timestamp_micros({span.low}) AND timestamp_micros({span.high})"
    stored = read_runs(spark, path, "readings", runs).filter(inside)
    # The filter on the folders tells the planner that they are worth pruning by.
    some = hits.filter("event_date >= DATE'0001-01-01' AND run > ''")
    return stored.join(_small(some), ["run", "event_date"]).drop("run")


def first_batch_id(spark: SparkSession, path: str, checkpoint: str) -> int:
    """The table's batch id for batch 0 of a checkpoint: after everything that older checkpoints wrote.

    Chosen once per checkpoint and kept next to it, so a restart finds the same ids and a new checkpoint on a filled
    table never overwrites earlier batches.
    """
    used = _runs(spark, f"{path}/readings/run=*") + _runs(spark, f"{path}/batches/run=*")
    return first_id(spark, max((last for _, last in used), default=-1) + 1, checkpoint)


def first_id(spark: SparkSession, start: int, checkpoint: str) -> int:
    """The id kept with the checkpoint, or else ``start``, which is kept from now on."""
    kept = f"{checkpoint}/first-batch-id"
    row = read_or_empty(spark, T.StructType.fromDDL("id long"), kept, [kept]).first()
    if row is not None:
        return row.id
    spark.createDataFrame([(start,)], "id long").write.mode("overwrite").parquet(kept)
    return start


def begin_batch(spark: SparkSession, path: str, batch_id: int) -> None:
    """Takes an earlier try of the batch out of the table before it is written again."""
    delete(spark, folder(path, "batches", (batch_id, batch_id)))


def write_batch(rows: DataFrame, path: str, batch_id: int) -> None:
    """Writes the new rows of a batch and what follows from them."""
    _write_readings(rows.withColumn("batch_id", F.lit(batch_id).cast("long")), path, (batch_id, batch_id))


def _write_readings(rows: DataFrame, path: str, run: Run) -> None:
    """Writes stored rows and what follows from them. Rebalancing merges small and splits hot dates before files are cut."""
    rows = rows.withColumn("event_date", F.to_date("interval_start")).select(*READINGS.names)
    files = (
        rows.hint("rebalance", "event_date")
        .sortWithinPartitions("event_date", "device_id", "interval_start")
        .write.mode("overwrite")
        .option("partitionOverwriteMode", "static")
        .partitionBy("event_date")
    )
    together(
        rows.sparkSession,
        lambda: files.parquet(folder(path, "readings", run)),
        lambda: _write_minutes(rows, path, run),
        lambda: _write_filters(rows, path, run),
    )


def _write_minutes(stored: DataFrame, path: str, run: Run) -> None:
    minutes = stored.groupBy(F.date_trunc("minute", "interval_start").alias("time"))
    _write(minutes.agg(F.sum("vehicles").alias("vehicles"), F.count("*").alias("readings")), path, "minutes", run)


def _write_filters(stored: DataFrame, path: str, run: Run) -> None:
    n_words = F.greatest(F.lit(1), F.ceil(F.count("*") * KEY_BITS / 64))
    words = F.call_function("shiftleft", F.lit(1).cast("long"), F.length(F.bin(n_words - 1)) * (n_words > 1).cast("int"))
    ranges = stored.groupBy("event_date").agg(words.alias("words"), F.min("interval_start").alias("low"), F.max("interval_start").alias("high"))
    _write(ranges, path, "folders", run)
    sizes = read_runs(stored.sparkSession, path, "folders", [run]).select("event_date", "words")
    sizes = sizes.select(F.unix_date("event_date").alias("day"), "words")
    marks = stored.select(*KEY, "event_date", F.unix_date("event_date").alias("day")).join(_small(sizes), "day")
    marks = marks.groupBy("event_date", _word().alias("word"))
    _write(marks.agg(F.bit_or(_bits()).alias("bits")).sort("event_date", "word"), path, "filters", run)


def write_side(rows: DataFrame, path: str, name: str, batch_id: int) -> None:
    _write(rows.withColumn("batch_id", F.lit(batch_id)), path, name, (batch_id, batch_id))


def _write(rows: DataFrame, path: str, name: str, run: Run) -> None:
    schema = T.StructType.fromDDL(SIDE_SCHEMAS[name])
    cols = [F.col(f.name).cast(f.dataType).alias(f.name) for f in schema]
    rows.select(*cols).write.mode("overwrite").parquet(folder(path, name, run))


def due(runs: list[Run], fan: int = FAN) -> list[Run] | None:
    """The oldest ``fan`` neighbouring runs of one size, smallest sizes first."""

    def size(run: Run) -> int:
        """Number of the size: runs of up to ``fan ** size`` batches."""
        size = 0
        while fan**size < run[1] - run[0] + 1:
            size += 1
        return size

    for level in sorted({size(r) for r in runs}):
        for i in range(len(runs) - fan + 1):
            part = runs[i : i + fan]
            if all(size(r) == level for r in part):
                return part
    return None


def merge_runs(spark: SparkSession, path: str, parts: list[Run]) -> Run:
    """Writes neighbouring runs as one. Readers see it, instead of the parts, when its ``batches`` are complete."""
    run = (parts[0][0], parts[-1][1])
    delete(spark, folder(path, "batches", run))
    carry = [lambda name=name: _write(read_runs(spark, path, name, parts).coalesce(len(parts)), path, name, run) for name in CARRIED]
    together(spark, lambda: _write_readings(read_runs(spark, path, "readings", parts), path, run), *carry[:-1])
    carry[-1]()
    return run


def compact(spark: SparkSession, path: str, before: int, fan: int = FAN) -> None:
    """Merges runs of batches before ``before`` while ``fan`` neighbours have one size.

    Runs that an earlier call has put out of use are deleted first, so readers that have just looked up the runs still
    find them. The marker goes last, so that a crash leaves nothing that no later call would delete.
    """
    live = live_runs(spark, path)
    for run in complete_runs(spark, path):
        if run not in live:
            for name in ("readings", *SIDE_SCHEMAS):
                if name != "batches":
                    delete(spark, folder(path, name, run))
            delete(spark, folder(path, "batches", run))
    while parts := due([r for r in live if r[1] < before], fan):
        merge_runs(spark, path, parts)
        live = live_runs(spark, path)


def rewrite_sorted(readings: DataFrame, target: str) -> None:
    """Rewrites finished rows to a new table with few large files, sorted for per-device range scans."""
    spark = readings.sparkSession
    _write_readings(readings.withColumn("batch_id", F.lit(0).cast("long")), target, (0, 0))
    summary = read_runs(spark, target, "readings", [(0, 0)]).agg(F.count("*").alias("inserted"))
    write_side(
        summary.select(
            F.current_timestamp().alias("ts"),
            F.col("inserted").alias("messages"),
            "inserted",
            F.lit(0).alias("duplicates"),
            F.lit(0).alias("skipped"),
            F.lit(0).alias("store_retries"),
            F.lit(0).alias("flush_ms"),
            F.lit(None).alias("delay_ms_p50"),
            F.lit(None).alias("delay_ms_max"),
        ),
        target,
        "batches",
        0,
    )
