"""Validation of submitted batches, all or nothing, with the first failing item and its reason."""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import json_guard as J
from ..functions.times import epoch_ms, is_strict_utc, strict_utc
from ..schema import CLOCK_SKEW_SECONDS, MAX_BATCH, MAX_INT
from ..session import saved
from .scale import lookup

# The texts below are fixed values: clients match on them.
NOT_AN_ARRAY = "body must be a JSON array of readings"


def parse_bodies(submissions: DataFrame) -> DataFrame:
    """Adds ``items`` (array of variants; NULL when the body is not a JSON array) and ``batch_reason``."""
    parsed = J.with_document(submissions, "body", "_doc")
    parsed = parsed.withColumn("items", F.try_variant_get("_doc", "$", "array<variant>")).drop("_doc")
    n = F.size("items")
    reason = F.when(F.col("items").isNull(), F.lit(NOT_AN_ARRAY)).when(
        ~n.between(1, MAX_BATCH), F.concat(F.lit(f"batch must contain 1-{MAX_BATCH} readings, got "), n.cast("string"))
    )
    return parsed.withColumn("batch_reason", reason)


FIELDS = ("deviceId", "intervalStart", "intervalSeconds", "vehicles")


def item_rows(parsed: DataFrame) -> DataFrame:
    """One row per item of the well-formed batches; ``pos`` is the item's index. Other bodies give one row without.

    Size is checked before the explode, so no batch yields more than 500 rows.
    """
    good = F.when(F.col("batch_reason").isNull(), F.col("items"))
    items = parsed.select("batch_id", "received_at", "batch_reason", F.posexplode_outer(good).alias("pos", "item"))
    return J.with_fields(items.withColumn("is_object", J.is_object("item")), "item", FIELDS).select(
        "batch_id",
        "received_at",
        "batch_reason",
        "pos",
        "is_object",
        J.string_field("deviceId").alias("device_id"),
        J.string_field("intervalStart").alias("interval_text"),
        J.number_field("intervalSeconds").alias("claimed_seconds"),
        J.number_field("vehicles").alias("vehicles_number"),
        *J.field_columns(("intervalSeconds", "vehicles")),
    )


def reading_reason() -> Column:
    """The body's error or the first broken rule of an item joined with its device, else NULL, in this order."""
    start = strict_utc("interval_text")
    shape = 'intervalStart must be an ISO 8601 UTC timestamp like "2026-09-30T11:00:45Z"'
    known = F.col("interval_seconds")
    vehicles = F.col("vehicles_number")
    latest = F.col("received_at").cast("timestamp") + F.make_dt_interval(secs=F.lit(CLOCK_SKEW_SECONDS))
    return (
        F.when(F.col("batch_reason").isNotNull(), F.col("batch_reason"))
        .when(~F.col("is_object"), "reading must be an object")
        .when(F.col("device_id").isNull(), "deviceId must be a string")
        .when(known.isNull(), F.concat(F.lit('unknown deviceId "'), "device_id", F.lit('"')))
        .when(
            ~F.coalesce(F.col("claimed_seconds") == known, F.lit(False)),
            F.concat(
                F.lit("intervalSeconds must be "),
                known.cast("string"),
                F.lit(" for "),
                "device_id",
                F.lit(", got "),
                J.field_text("intervalSeconds"),
            ),
        )
        .when(~F.coalesce(is_strict_utc("interval_text"), F.lit(False)), shape)
        .when(start.isNull(), shape + " (invalid date)")
        .when(
            F.pmod(epoch_ms(start), known.cast("long") * 1000) != 0,
            F.concat(
                F.lit("intervalStart "),
                "interval_text",
                F.lit(" is not aligned to a "),
                known.cast("string"),
                F.lit("s boundary"),
            ),
        )
        .when(
            epoch_ms(start) > epoch_ms(latest),
            F.concat(F.lit("intervalStart "), "interval_text", F.lit(" is in the future")),
        )
        .when(
            ~F.coalesce(vehicles.between(0, MAX_INT) & (vehicles == F.floor(vehicles)), F.lit(False)),
            F.concat(F.lit("vehicles must be a non-negative integer, got "), J.field_text("vehicles")),
        )
    )


def check_items(submissions: DataFrame, devices: DataFrame) -> DataFrame:
    """Item rows with ``reason`` and, where valid, the typed reading; a broken body is one row without ``pos``."""
    dim = devices.select("device_id", "interval_seconds")
    checked = lookup(item_rows(parse_bodies(submissions)), dim, "device_id", "left").withColumn(
        "reason", reading_reason()
    )
    return checked.select(
        "batch_id",
        "received_at",
        "pos",
        "reason",
        "device_id",
        F.when(F.col("reason").isNull(), strict_utc("interval_text")).alias("interval_start"),
        F.when(F.col("reason").isNull(), F.col("vehicles_number")).try_cast("int").alias("vehicles"),
    )


def rejected_batches(checked: DataFrame) -> DataFrame:
    """``(batch_id, index, reason)``: one row per rejected batch; index is NULL for errors of the whole body.

    Only failures reach the aggregate, so what is shuffled is the bad part of the input.
    """
    failed = checked.filter(F.col("reason").isNotNull()).groupBy("batch_id")
    whole = F.max(F.when(F.col("pos").isNull(), F.col("reason")))
    return failed.agg(
        F.min("pos").alias("index"), F.coalesce(F.min_by("reason", "pos"), whole).alias("reason")
    )


def accepted_readings(checked: DataFrame, rejected: DataFrame) -> DataFrame:
    """Readings of the batches without any failing item."""
    return checked.join(rejected.select("batch_id"), "batch_id", "left_anti").drop("reason")


def validate_submissions(submissions: DataFrame, devices: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Splits submissions ``(batch_id, received_at, body)`` into accepted readings and rejected batches.

    ``batch_id`` identifies one submission. Bodies are parsed once: the typed rows are saved, then the rejected
    ids. The size of the latter is known when the anti join is planned, so accepted rows are not shuffled as
    long as the rejections fit a broadcast.
    """
    checked = saved(check_items(submissions, devices), "checked-items")
    rejected = saved(rejected_batches(checked), "rejected-batches")
    return accepted_readings(checked, rejected), rejected


def accepted_summary(accepted: DataFrame) -> DataFrame:
    """Readings queued per accepted batch."""
    return accepted.groupBy("batch_id").agg(F.count("*").alias("queued"))


def outcome(status, error) -> Column:
    """What a sender does next: ``ok``, ``rejected`` (never resend), or a kind of retry."""
    status, error = F.col(status), F.col(error)
    return (
        F.when(status == 200, "ok")
        .when(status == 400, "rejected")
        .when(status.isNotNull(), "5xx")
        .when(error == "timeout", "timeout")
        .otherwise("network")
    )
