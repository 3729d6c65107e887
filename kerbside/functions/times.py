"""Time bins, boundaries and ISO text. Instants are UTC (see ``session.configure``)."""

from pyspark.sql import Column
from pyspark.sql import functions as F

# Bins are counted from this instant, in epoch seconds: 2000-01-01T00:00:00Z.
BIN_ORIGIN = 946684800


def col(c):
    return F.col(c) if isinstance(c, str) else c


def epoch_ms(ts) -> Column:
    return F.unix_millis(col(ts).cast("timestamp"))


def from_ms(ms) -> Column:
    return F.timestamp_millis(col(ms))


def bin_start(ts, seconds: int) -> Column:
    """Start of the fixed-width bin holding ``ts``; keeps the input's timestamp type."""
    return F.window(col(ts), f"{seconds} seconds", startTime=f"{BIN_ORIGIN % seconds} seconds").start


def floor_to(ts, seconds) -> Column:
    """Floors an instant to a multiple of a per-row number of seconds."""
    step = F.lit(seconds) if isinstance(seconds, int) else col(seconds)
    ms = epoch_ms(ts)
    return from_ms(ms - F.pmod(ms, step.cast("long") * 1000))


def next_boundary_ms(now_ms, interval_seconds) -> Column:
    """The first multiple of the interval strictly after ``now_ms``."""
    step = (F.lit(interval_seconds) if isinstance(interval_seconds, int) else col(interval_seconds)).cast("long") * 1000
    now = col(now_ms)
    return now - F.pmod(now, step) + step


def window_start_ms(end_ms, length_ms) -> Column:
    """Start of the window whose (slightly late) end is snapped to the nearest multiple of its length.

    Halves go up. Whole-number arithmetic, so no rounding error at any magnitude.
    """
    end, length = col(end_ms), col(length_ms)
    doubled = end * 2 + length
    return F.shiftright(doubled - F.pmod(doubled, length * 2), 1) - length


def iso_millis(ts) -> Column:
    return F.date_format(col(ts), "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'")


def iso_seconds(ts) -> Column:
    """ISO text without the fraction when it is zero."""
    c = col(ts)
    whole = F.pmod(epoch_ms(c), F.lit(1000)) == 0
    return F.when(whole, F.date_format(c, "yyyy-MM-dd'T'HH:mm:ss'Z'")).otherwise(iso_millis(c))


# UTC instant as devices must send it.
STRICT_UTC = r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}T[0-9]{2}:[0-9]{2}:[0-9]{2}(\.[0-9]{1,3})?Z\z"
# Instant as the decoder accepts it: a date, or a date and time with a zone. Days past the end of a month run on into the
# next one, and 24:00 is the next midnight.
LENIENT_ISO = (
    r"\A[0-9]{4}-[0-9]{2}-[0-9]{2}(T[0-9]{2}:[0-9]{2}(:[0-9]{2}(\.[0-9]{1,9})?)?(Z|[+-][0-9]{2}:[0-9]{2}))?\z"
)


def is_strict_utc(text) -> Column:
    return col(text).rlike(STRICT_UTC)


def strict_utc(text) -> Column:
    """The instant, or NULL for text of the wrong shape and for impossible calendar dates."""
    c = col(text)
    return F.when(is_strict_utc(c), c.try_cast("timestamp"))


def lenient_iso(text) -> Column:
    """The instant cut to milliseconds, or NULL."""
    c = col(text)
    day, time = F.substring(c, 9, 2).try_cast("int"), F.substring(c, 11, 40)
    midnight = time.rlike(r"\AT24:00(:00(\.0+)?)?[Z+-]")
    time = F.when(midnight, F.concat(F.lit("T00"), F.substring(time, 4, 40))).otherwise(time)
    first = F.concat(F.substring(c, 1, 8), F.lit("01"), time).try_cast("timestamp")
    days = day - 1 + midnight.cast("int")
    instant = F.timestamp_micros(F.unix_micros(first) + days.cast("long") * 86_400_000_000)
    return F.when(c.rlike(LENIENT_ISO) & day.between(1, 31), F.date_trunc("millisecond", instant))
