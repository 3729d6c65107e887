"""Small scalar functions: ids, sizes, percentages, decimal rounding."""

from pyspark.sql import Column
from pyspark.sql import functions as F

from .times import col

# Bytes per unit (fixed values); names compare without case.
BYTE_UNITS = {
    "B": 1,
    "KB": 1000,
    "MB": 1000**2,
    "GB": 1000**3,
    "TB": 1000**4,
    "KIB": 1024,
    "MIB": 1024**2,
    "GIB": 1024**3,
    "TIB": 1024**4,
}
MIB = 1024**2
STALE_AFTER_SECONDS = 60


def device_id(n) -> Column:
    """``dev-`` and the number padded to five digits; longer numbers are kept whole."""
    text = col(n).cast("string")
    return F.concat(F.lit("dev-"), F.when(F.length(text) > 5, text).otherwise(F.lpad(text, 5, "0")))


def key_partition(key, partitions: int) -> Column:
    """A partition number that is the same for every message with the same key."""
    return F.pmod(F.xxhash64(col(key)), F.lit(partitions)).cast("int")


def byte_size(text) -> Column:
    """``1.5GiB`` as a number of bytes; NULL when the text is not a size."""
    c = col(text)
    pattern = r"\A\s*([0-9.]+)\s*([A-Za-z]+)\s*\z"
    unit = F.upper(F.regexp_extract(c, pattern, 2))
    factor = F.lit(None).cast("double")
    for name, size in BYTE_UNITS.items():
        factor = F.when(unit == name, F.lit(float(size))).otherwise(factor)
    return F.regexp_extract(c, pattern, 1).try_cast("double") * factor


def percent(text) -> Column:
    """The leading number of ``12.34%``, or NULL."""
    return F.regexp_extract(col(text), r"\A\s*([+-]?[0-9]+\.?[0-9]*|[+-]?\.[0-9]+)", 1).try_cast("double")


def used_memory_mib(text) -> Column:
    """The part before the slash of ``256MiB / 7.6GiB``, in MiB with one digit."""
    return to_fixed(byte_size(F.split_part(col(text), F.lit("/"), F.lit(1))) / F.lit(float(MIB)), 1)


def to_fixed(x, digits: int) -> Column:
    """Rounds the exact binary value of a double to ``digits`` decimals, halves away from zero.

    ``round`` works on the shortest decimal text, so it turns 1.005 into 1.01 although the stored number is
    below 1.005. Here the rounding error of ``|x| * 10^digits`` is recovered with an error-free product and
    decides the cases that look like a tie. From 2^52 on the scaled value has no fraction, so the number stays.
    """
    a = F.abs(col(x).cast("double"))
    scale = F.lit(float(10**digits))
    splitter = F.lit(134217729.0)  # 2^27 + 1 splits a double into two halves of 26 bits

    def halves(v):
        c = splitter * v
        high = c - (c - v)
        return high, v - high

    product = a * scale
    a_hi, a_lo = halves(a)
    s_hi, s_lo = halves(scale)
    error = ((a_hi * s_hi - product) + a_hi * s_lo + a_lo * s_hi) + a_lo * s_lo
    whole = F.floor(product).cast("double")
    fraction = product - whole
    up = (fraction > 0.5) | ((fraction == 0.5) & (error >= 0))
    rounded = (whole + F.when(up, 1.0).otherwise(0.0)) / scale
    rounded = F.when(product >= 2.0**52, a).otherwise(rounded)
    return F.when(col(x) < 0, -rounded).otherwise(rounded)


def round_half_up(x) -> Column:
    """Nearest whole number, halves towards plus infinity."""
    return F.floor(col(x) + 0.5)


def is_stale(age_seconds) -> Column:
    return F.coalesce(col(age_seconds) > STALE_AFTER_SECONDS, F.lit(False))
