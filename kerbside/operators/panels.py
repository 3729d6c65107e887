"""Dashboard questions over the readings table."""

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.times import bin_start, epoch_ms, from_ms
from .devices import expected_rate
from .scale import lookup, neighbours, running_sum, time_chunk

MINUTE = 60


def time_range(readings: DataFrame, start, end, ts: str = "interval_start") -> DataFrame:
    """Rows with ``start <= ts <= end``. On the stored table the dates also prune partitions.

    Spark derives no partition filter from the timestamp, so one is added when ``event_date`` is there.
    """
    start, end = _instant(start), _instant(end)
    ranged = readings.filter(F.col(ts).between(start, end))
    if ts == "interval_start" and "event_date" in readings.columns:
        ranged = ranged.filter(F.col("event_date").between(utc_date(start), utc_date(end)))
    return ranged


def utc_date(ts):
    """The UTC day of an instant, whatever the zone of the session; the folders of the table are UTC days."""
    return F.date_from_unix_date(F.floor(F.unix_seconds(ts.cast("timestamp")) / 86_400).cast("int"))


def _instant(x):
    return F.lit(x).cast("timestamp") if isinstance(x, str) else F.lit(x)


def device_range(readings: DataFrame, device: str, start, end) -> DataFrame:
    return time_range(readings.filter(F.col("device_id") == device), start, end)


def vehicles_per_bin(readings: DataFrame, seconds: int = MINUTE) -> DataFrame:
    """Vehicles per tumbling bin, over whatever devices the input holds."""
    return readings.groupBy(bin_start("interval_start", seconds).alias("time")).agg(F.sum("vehicles").alias("vehicles"))


def ingest_rate(readings: DataFrame, seconds: int = MINUTE) -> DataFrame:
    """Stored rows per tumbling bin of storage time."""
    return readings.groupBy(bin_start("stored_at", seconds).alias("time")).agg(F.count("*").alias("rows"))


def completeness(readings: DataFrame, devices: DataFrame) -> DataFrame:
    """Rows per minute next to the number a complete minute holds."""
    expected = expected_rate(devices).select("readings_per_min").scalar()
    per_minute = readings.groupBy(bin_start("interval_start", MINUTE).alias("time")).agg(F.count("*").alias("rows"))
    return per_minute.withColumn("expected", expected).withColumn("is_complete", F.col("rows") == F.col("expected"))


def missing_ranges(readings: DataFrame, devices: DataFrame, start, end) -> DataFrame:
    """Expected but absent intervals in ``[start, end)``, as ranges ``(device_id, missing_from, missing_to, n_missing)``.

    ``missing_to`` is exclusive. Gaps are found between neighbouring stored intervals, so the grid of all
    expected intervals is never built and the work grows with the stored rows.
    """
    dim = devices.select("device_id", F.col("interval_seconds").cast("long").alias("step"))
    lo, hi = epoch_ms(_instant(start)), epoch_ms(_instant(end))
    rows = time_range(readings, start, end).filter(F.col("interval_start") < _instant(end))
    # Placed once by (device, day); the summary of the days and the rows themselves share this exchange.
    rows = rows.select(
        "device_id", epoch_ms("interval_start").alias("at"), time_chunk("interval_start").alias("chunk")
    ).repartition("device_id", "chunk")
    near = lookup(neighbours(rows, ["device_id"], "at", ["at"]), dim, "device_id", "inner")
    step = F.col("step") * 1000

    def gap(low, high):
        return F.struct(low.alias("gap_from"), high.alias("gap_to"))

    # Every row closes the gap up to the next one; a device's first row also closes the gap before it.
    after = gap(F.col("at") + step, F.coalesce("next_at", hi))
    before = F.when(F.col("prev_at").isNull(), gap(_ceil_to(lo, step), F.col("at")))
    held = near.select("device_id", "step", F.inline(F.array_compact(F.array(before, after))))
    silent = dim.join(rows.select("device_id").distinct(), "device_id", "left_anti")
    gaps = held.unionByName(silent.select("device_id", "step", _ceil_to(lo, step).alias("gap_from"), hi.alias("gap_to")))
    n = F.ceil((F.col("gap_to") - F.col("gap_from")) / step).cast("long")
    return gaps.filter(F.col("gap_to") > F.col("gap_from")).select(
        "device_id",
        from_ms("gap_from").alias("missing_from"),
        from_ms(F.col("gap_from") + n * step).alias("missing_to"),
        n.alias("n_missing"),
    )


def missing_intervals(readings: DataFrame, devices: DataFrame, start, end) -> DataFrame:
    """The same, one row per absent interval. Ranges are cut by day before they are listed, so arrays stay short."""
    dim = devices.select("device_id", F.col("interval_seconds").cast("long").alias("step"))
    day = F.make_dt_interval(days=F.lit(1))
    ranges = lookup(missing_ranges(readings, devices, start, end), dim, "device_id", "inner")
    last = F.col("missing_to") - F.make_dt_interval(secs=F.col("step"))
    days = ranges.withColumn("last", last).withColumn(
        "day", F.explode(F.sequence(F.date_trunc("day", "missing_from"), F.date_trunc("day", "last"), day))
    )
    step = F.make_dt_interval(secs=F.col("step"))
    low = F.greatest(F.col("missing_from"), F.col("day"))
    high = F.least(F.col("last"), F.col("day") + day - step)
    return days.select("device_id", F.explode(F.sequence(low, high, step)).alias("interval_start"))


def _ceil_to(ms, step):
    return ms + F.pmod(-ms, step)


def send_store_gap(sent: DataFrame, stored: DataFrame) -> DataFrame:
    """Per minute: readings accepted for sending, readings stored, and the backlog left by the end of the minute.

    ``sent`` needs ``accepted_at``, ``stored`` needs ``stored_at``.
    """
    out = sent.groupBy(bin_start("accepted_at", MINUTE).alias("time")).agg(F.count("*").alias("sent"))
    into = stored.groupBy(bin_start("stored_at", MINUTE).alias("time")).agg(F.count("*").alias("stored"))
    both = out.join(into, "time", "full").select(
        "time", F.coalesce("sent", F.lit(0)).alias("sent"), F.coalesce("stored", F.lit(0)).alias("stored")
    )
    both = both.withColumn("gap", F.col("sent") - F.col("stored")).withColumn("chunk", time_chunk("time"))
    return running_sum(both, [], "time", "gap", "backlog").select("time", "sent", "stored", "gap", "backlog")
