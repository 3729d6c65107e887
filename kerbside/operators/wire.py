"""The message format: encoding, tolerant decoding, offsets to commit."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import json_guard as J
from ..functions.times import iso_millis, iso_seconds, lenient_iso

# From here on every double is a whole number, and its floor may not fit a long.
WHOLE_DOUBLES = 2.0**53


def message_value(device_id="device_id", interval_start="interval_start", vehicles="vehicles", accepted_at="accepted_at") -> Column:
    return F.to_json(
        F.struct(
            F.col(device_id).alias("deviceId"),
            iso_seconds(interval_start).alias("intervalStart"),
            F.col(vehicles).alias("vehicles"),
            iso_millis(accepted_at).alias("receivedAt"),
        )
    )


def encode(readings: DataFrame) -> DataFrame:
    """One keyed message per reading; the key keeps a device's readings in order on one partition."""
    return readings.select(F.col("device_id").alias("key"), message_value().alias("value"))


def decode(messages: DataFrame) -> DataFrame:
    """Adds the typed fields and ``is_decoded``. Undecodable values yield NULL fields, never an error.

    ``vehicles`` is the number of the message, a double of any size; the range rule of the ingest refuses large ones.
    All other columns (partition, offset, ...) pass through.
    """
    fields = ("deviceId", "intervalStart", "vehicles", "receivedAt")
    body = J.with_document(messages.withColumn("_text", F.col("value").cast("string")), "_text", "_doc")
    body = J.with_fields(body, "_doc", fields).select(
        *messages.columns,
        J.string_field("deviceId").alias("_device"),
        J.string_field("intervalStart").alias("_start_text"),
        J.number_field("vehicles").alias("_count"),
        J.string_field("receivedAt").alias("_accepted_text"),
    )
    body = body.withColumns({"_start": lenient_iso("_start_text"), "_accepted": lenient_iso("_accepted_text")})
    count = F.col("_count")
    whole = (count >= 0) & (count < float("inf")) & ((count >= WHOLE_DOUBLES) | (count == F.floor(count)))
    good = (
        F.col("_device").isNotNull()
        & F.col("_start").isNotNull()
        & F.col("_accepted").isNotNull()
        & F.coalesce(whole, F.lit(False))
    )
    body = body.withColumn("is_decoded", good)
    ok = F.col("is_decoded")
    return body.select(
        *messages.columns,
        "is_decoded",
        F.when(ok, F.col("_device")).alias("device_id"),
        F.when(ok, F.col("_start")).alias("interval_start"),
        F.when(ok, count).alias("vehicles"),
        F.when(ok, F.col("_accepted")).alias("accepted_at"),
    )


def commit_offsets(messages: DataFrame) -> DataFrame:
    """The next offset to read per partition; undecodable messages count like any other."""
    return messages.groupBy("partition").agg((F.max("offset") + 1).alias("offset"))
