"""First-write-wins ingest of decoded messages against the stored table.

Copies of a key are folded by a map-side combined aggregate, never by sorting a key's copies in one task, so
a key that was sent a billion times costs one row per map task. The stored side is probed by the batch's
keys (and not the other way round): a small batch is broadcast and the stored files are only scanned.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..schema import MAX_INT
from .scale import lookup, plan_bytes

KEY = ["device_id", "interval_start"]
#: Most bytes of stored ids that are broadcast, and of stored rows; in memory they are several times that size.
MOST_UNKNOWN_BYTES = MOST_BROADCAST_BYTES = 1 << 20


def broken_rule() -> Column:
    """The first rule of the table that a message of a known device breaks, or NULL. Missing values break rules, too."""
    in_range = F.coalesce(F.col("vehicles").between(0, MAX_INT), F.lit(False))
    return (
        F.when(F.col("interval_start").isNull(), "no interval start")
        .when(~has_calendar_year(F.col("interval_start")), "interval start out of range")
        .when(~in_range, "vehicles out of range")
    )


def has_calendar_year(ts: Column) -> Column:
    """Whether an instant lies in the years 1 to 9999, the ones that dates in folders and in clients can have."""
    return F.year(ts).between(1, 9999)


def split_by_constraints(
    messages: DataFrame, devices: DataFrame, unknown: DataFrame | None = None
) -> tuple[DataFrame, DataFrame]:
    """Rows the table's constraints admit, and the rest with a ``reason``.

    ``unknown`` may hold the ids of the messages that are no devices, stored. They are mostly few however many devices there
    are, so they are broadcast and no message is moved; if they are many, the messages meet the devices.
    """
    if unknown is not None and plan_bytes(unknown) <= MOST_UNKNOWN_BYTES:
        dim = unknown.select("device_id", F.lit(True).alias("is_unknown"))
        marked = messages.join(F.broadcast(dim), "device_id", "left")
        is_unknown = F.col("device_id").isNull() | F.col("is_unknown").isNotNull()
    else:
        dim = devices.select("device_id", F.lit(False).alias("is_unknown"))
        marked = lookup(messages, dim, "device_id", "left")
        is_unknown = F.col("is_unknown").isNull()
    reason = F.when(is_unknown, "unknown device").otherwise(broken_rule())
    marked = marked.withColumn("reason", reason).drop("is_unknown")
    good = marked.filter(F.col("reason").isNull()).drop("reason")
    return good.withColumn("vehicles", F.col("vehicles").try_cast("int")), marked.filter(F.col("reason").isNotNull())


def first_writes(messages: DataFrame) -> DataFrame:
    """One row per key: the copy with the lowest offset, the number of copies, and their least and greatest count.

    Equal keys share a partition, so the offset is a total order within a key. Where they do not (a message under a foreign
    key), the lower partition decides, so that a replay keeps the same copy.
    """
    first = F.col("offset")
    if "partition" in messages.columns:  # one number, as a struct would be aggregated by sorting
        first = first.cast("decimal(20,0)") * F.lit(2**32) + F.col("partition")
    return messages.groupBy(*KEY).agg(
        F.min_by("vehicles", first).alias("vehicles"),
        F.min_by("accepted_at", first).alias("accepted_at"),
        F.min("offset").alias("offset"),
        F.count("*").alias("copies"),
        F.min("vehicles").alias("least"),
        F.max("vehicles").alias("most"),
    )


def probe(firsts: DataFrame, stored: DataFrame) -> DataFrame:
    """Adds ``stored_vehicles``: what the table already holds for the key, or NULL for a new key."""
    held = stored.select(*KEY, F.col("vehicles").alias("stored_vehicles"))
    if plan_bytes(firsts) > MOST_BROADCAST_BYTES:  # both sides move once
        return firsts.join(held.hint("merge"), KEY, "left")
    hits = held.join(F.broadcast(firsts.select(*KEY)), KEY, "inner")
    return firsts.join(hits, KEY, "left")


def new_rows(probed: DataFrame) -> DataFrame:
    """The rows an insert-if-absent adds."""
    return probed.filter(F.col("stored_vehicles").isNull()).select(*KEY, "vehicles", "accepted_at", "offset")


def duplicate_keys(probed: DataFrame) -> DataFrame:
    """Incoming minus inserted, per key: how many copies were dropped as duplicates."""
    dropped = F.when(F.col("stored_vehicles").isNull(), F.col("copies") - 1).otherwise(F.col("copies"))
    return probed.select(*KEY, dropped.alias("duplicates")).filter(F.col("duplicates") > 0)


def conflicts(messages: DataFrame, probed: DataFrame, include_in_batch: bool = False) -> DataFrame:
    """Duplicates whose count differs from the one that is kept.

    Equal copies are folded first: one row per key and differing count, with the number of messages. By default
    only keys that were stored before the batch are checked; ``include_in_batch`` also compares copies within
    the batch with the one that won.
    """
    return conflicts_with(messages, disputed(probed, include_in_batch))


def disputed(probed: DataFrame, include_in_batch: bool = False) -> DataFrame:
    """The kept count of the keys that the batch also sent with another one: the only ones whose messages matter."""
    kept, checked = F.col("stored_vehicles"), F.col("stored_vehicles").isNotNull()
    if include_in_batch:
        kept, checked = F.coalesce(kept, F.col("vehicles")), checked | (F.col("copies") > 1)
    differs = (F.col("least") != kept) | (F.col("most") != kept)
    return probed.filter(checked & differs).select(*KEY, kept.alias("stored_vehicles"))


def conflicts_with(messages: DataFrame, winners: DataFrame) -> DataFrame:
    """``conflicts`` with the disputed keys; if these are few, only their messages are shuffled."""
    folded = [F.count("*").alias("messages"), F.min("offset").alias("first_offset")]
    value = F.col("vehicles").alias("incoming_vehicles")
    if plan_bytes(winners) <= MOST_BROADCAST_BYTES:
        met = messages.join(F.broadcast(winners), KEY).filter(F.col("stored_vehicles") != F.col("vehicles"))
        found = met.groupBy(*KEY, "stored_vehicles", value).agg(*folded)
    else:
        values = messages.groupBy(*KEY, value).agg(*folded)
        found = values.join(winners.hint("merge"), KEY).filter(F.col("stored_vehicles") != F.col("incoming_vehicles"))
    return found.select(*KEY, "incoming_vehicles", "messages", "first_offset", "stored_vehicles")


def counters(probed: DataFrame) -> DataFrame:
    """One row: accepted and duplicate messages of a batch."""
    is_new = F.col("stored_vehicles").isNull()
    accepted = F.count_if(is_new)
    return probed.agg(
        accepted.alias("accepted"), (F.coalesce(F.sum("copies"), F.lit(0)) - accepted).alias("duplicates")
    )


def batch_counters(decoded: DataFrame, devices: DataFrame, probed: DataFrame, batch: Column) -> DataFrame:
    """Per ``batch_id`` (an expression over offset-ordered messages): inserted, duplicates, skipped.

    ``batch`` is evaluated over the columns ``accepted_at`` and ``offset``. Messages are reduced to
    (batch, device) counts before they meet the device table.
    """
    per_device = decoded.groupBy(
        batch.alias("batch_id"), "device_id", broken_rule().isNull().alias("in_range")
    ).agg(F.count("*").alias("n"))
    dim = devices.select("device_id", F.lit(True).alias("is_known"))
    good = F.col("is_known").isNotNull() & F.col("in_range")
    received = (
        lookup(per_device, dim, "device_id", "left")
        .groupBy("batch_id")
        .agg(
            F.coalesce(F.sum(F.when(good, F.col("n"))), F.lit(0)).alias("stored_or_duplicate"),
            F.coalesce(F.sum(F.when(~good, F.col("n"))), F.lit(0)).alias("skipped"),
        )
    )
    inserted = new_rows(probed).groupBy(batch.alias("batch_id")).agg(F.count("*").alias("inserted"))
    joined = received.join(inserted, "batch_id", "left").withColumn("inserted", F.coalesce("inserted", F.lit(0)))
    return joined.select(
        "batch_id", "inserted", (F.col("stored_or_duplicate") - F.col("inserted")).alias("duplicates"), "skipped"
    )


def reconcile(source: DataFrame, table: DataFrame) -> DataFrame:
    """Row counts and vehicle sums of the source and the table, one row; equal means nothing lost or doubled."""
    tagged = source.select("vehicles", F.lit("source").alias("side"))
    tagged = tagged.unionByName(table.select("vehicles", F.lit("table").alias("side")))

    def of(side: str) -> list[Column]:
        own = F.col("side") == side
        total = F.coalesce(F.sum(F.when(own, F.col("vehicles"))), F.lit(0).cast("long"))
        return [F.count_if(own).alias(f"{side}_rows"), total.alias(f"{side}_vehicles")]

    both = tagged.agg(*of("source"), *of("table"))
    equal = (F.col("source_rows") == F.col("table_rows")) & (F.col("source_vehicles") == F.col("table_vehicles"))
    return both.withColumn("is_equal", equal)
