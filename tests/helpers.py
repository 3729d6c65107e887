from datetime import datetime, timedelta, timezone

UTC = timezone.utc


def ts(text: str) -> datetime:
    """A zoned instant from ``2026-09-30 11:00:45``."""
    return datetime.fromisoformat(text).replace(tzinfo=UTC)


def later(start: datetime, seconds: float) -> datetime:
    return start + timedelta(seconds=seconds)


def naive(value: datetime) -> datetime:
    """Collected instants come back in the local zone of the process."""
    return value.astimezone(UTC).replace(tzinfo=None)


DEVICES = "device_id string, name string, interval_seconds int"


def devices(spark, *pairs):
    return spark.createDataFrame([(d, None, s) for d, s in pairs], DEVICES)


READING = "device_id string, interval_start timestamp, vehicles int, accepted_at timestamp, offset long"


def messages(spark, *items):
    """Decoded messages ``(device, start, vehicles)`` in offset order."""
    data = [(d, ts(s), v, ts("2026-09-30 12:00:00"), i) for i, (d, s, v) in enumerate(items)]
    return spark.createDataFrame(data, READING)


STORED = "device_id string, interval_start timestamp, vehicles int"


def stored(spark, *items):
    return spark.createDataFrame([(d, ts(s), v) for d, s, v in items], STORED)
