"""Building blocks that keep joins, ordered logic and ranks spread over the cluster.

* ``lookup`` broadcasts a dimension only after checking its size, uses a common bucketing, or else salts the join key.
* ``neighbours``, ``running_sum`` and ``numbered`` give lag/lead, prefix sums and row numbers over long
  sequences without sorting a whole sequence in one task: rows are cut into bounded chunks, one summary row
  per chunk carries the state across chunk borders.
* ``value_at_rank`` picks exact order statistics by radix selection over value counts.
"""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import WindowSpec

from ..functions.times import epoch_ms

DAY_MS = 86_400_000
#: Bytes of a fact table that one key may bring into a task, if it has a third of all rows; and bounds of the salts.
HOT_BYTES, LEAST_SALTS, MOST_SALTS = 128 << 20, 8, 1024


def plan_bytes(df: DataFrame) -> int:
    """The optimizer's size estimate of a DataFrame."""
    return int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())


def broadcast_limit(df: DataFrame) -> int:
    """The session's size limit for broadcast joins; -1 when broadcasting is off."""
    return int(df.sparkSession._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold())


def lookup(fact: DataFrame, dim: DataFrame, key: str, how: str = "left", max_bytes: int | None = None) -> DataFrame:
    """Joins a large fact with a dimension that is unique on ``key``.

    A dimension below the limit is broadcast, so the fact is not shuffled. If both are bucketed by the key alike
    (``sources.bucketed``), neither is. Otherwise the dimension is repeated over some salts and joined on (key,
    salt): a key holding a third of the fact then spreads over as many tasks, their number follows from the
    fact's size, and adaptive execution splits what is still too big. The salt is a hash of the whole row, so a
    retried task sends every row where it went before.
    """
    limit = broadcast_limit(dim) if max_bytes is None else max_bytes
    if plan_bytes(dim) <= limit:
        return fact.join(F.broadcast(dim), key, how)
    plain = fact.join(dim.hint("merge"), key, how)
    if "Exchange" not in plain._jdf.queryExecution().executedPlan().toString():
        return plain
    n = salts(fact, dim)
    cols = [c for c in fact.columns if not isinstance(fact.schema[c].dataType, (T.MapType, T.VariantType))]
    salted = fact.withColumn("_salt", F.pmod(F.xxhash64(*cols), F.lit(n)))
    copies = dim.withColumn("_salt", F.explode(F.sequence(F.lit(0).cast("long"), F.lit(n - 1).cast("long"))))
    # The hint keeps adaptive execution from broadcasting the copies, which are more than the limit allows.
    return salted.join(copies.hint("merge"), [key, "_salt"], how).drop("_salt")


def absent_keys(fact: DataFrame, dim: DataFrame, key: str) -> DataFrame:
    """The distinct values of ``key`` in the fact that the dimension lacks. Only keys are shuffled, folded on the map side."""
    return fact.select(key).distinct().join(dim.select(key).hint("merge"), key, "left_anti")


def salts(fact: DataFrame, dim: DataFrame) -> int:
    """Parts to cut a key into that holds a third of the fact, as long as the copies of the dimension stay below the fact."""
    size = plan_bytes(fact)
    return max(LEAST_SALTS, min(MOST_SALTS, size // 3 // HOT_BYTES + 1, size // max(1, plan_bytes(dim))))


def time_chunk(ts, chunk_ms: int = DAY_MS) -> Column:
    """Number of the time slice holding an instant; the unit in which ordered logic is cut."""
    ms = epoch_ms(ts)
    return ((ms - F.pmod(ms, F.lit(chunk_ms))) / chunk_ms).cast("long")


def neighbours(
    df: DataFrame, keys: Sequence[str], order: str, cols: Sequence[str], chunk: str = "chunk"
) -> DataFrame:
    """Adds ``prev_<c>`` and ``next_<c>`` of the row before and after, per ``keys`` in ``order``.

    The window runs inside (keys, chunk). The first and last row of every chunk travel through a summary of one
    row per chunk, so no task ever sorts a whole sequence.
    """
    keys = list(keys)
    wanted = list(dict.fromkeys([order, *cols]))
    inside = Window.partitionBy(*keys, chunk).orderBy(*wanted)
    # One min_by/max_by per column keeps fixed-width buffers, hence hash aggregation with map-side combine. With further
    # columns, these decide between rows that are equal in the order, so that every run gives the same answer.
    place = F.col(order) if len(wanted) == 1 else F.struct(*wanted)
    edges = df.groupBy(*keys, chunk).agg(
        *[F.min_by(c, place).alias(f"_first_{c}") for c in wanted],
        *[F.max_by(c, place).alias(f"_last_{c}") for c in wanted],
    )
    across = _sequence(keys, chunk)
    edges = edges.select(
        *keys,
        chunk,
        *[F.lag(f"_last_{c}").over(across).alias(f"_before_{c}") for c in cols],
        *[F.lead(f"_first_{c}").over(across).alias(f"_after_{c}") for c in cols],
    )
    near = df.withColumns(
        {f"_prev_{c}": F.lag(c).over(inside) for c in wanted} | {f"_next_{c}": F.lead(c).over(inside) for c in wanted}
    ).join(edges, [*keys, chunk], "left")

    def across_border(side: str, border: str, c: str) -> Column:
        # The order column is never NULL, so a NULL neighbour means the chunk ends here.
        return F.when(F.col(f"_{side}_{order}").isNull(), F.col(f"_{border}_{c}")).otherwise(F.col(f"_{side}_{c}"))

    return near.select(
        *df.columns,
        *[across_border("prev", "before", c).alias(f"prev_{c}") for c in cols],
        *[across_border("next", "after", c).alias(f"next_{c}") for c in cols],
    )


def running_sum(
    df: DataFrame, keys: Sequence[str], order: str, value: str, out: str, chunk: str = "chunk"
) -> DataFrame:
    """Inclusive prefix sum of ``value`` per ``keys`` in ``order``, two-level like ``neighbours``."""
    keys = list(keys)
    inside = Window.partitionBy(*keys, chunk).orderBy(order, value).rowsBetween(Window.unboundedPreceding, 0)
    before = _sequence(keys, chunk).rowsBetween(Window.unboundedPreceding, -1)
    totals = df.groupBy(*keys, chunk).agg(F.sum(value).alias("_total"))
    totals = totals.select(*keys, chunk, F.coalesce(F.sum("_total").over(before), F.lit(0)).alias("_offset"))
    return (
        df.withColumn("_local", F.sum(value).over(inside))
        .join(totals, [*keys, chunk], "left")
        .withColumn(out, F.col("_local") + F.col("_offset"))
        .drop("_local", "_offset")
    )


def numbered(df: DataFrame, keys: Sequence[str], order: str, out: str, chunk: str = "chunk") -> DataFrame:
    """1-based row number per ``keys`` in ``order``."""
    return running_sum(df.withColumn("_one", F.lit(1).cast("long")), keys, order, "_one", out, chunk).drop("_one")


def _sequence(keys: Sequence[str], order: str):
    # Only chunk summaries pass here: one row per key and time slice.
    return (Window.partitionBy(*keys) if keys else Window.partitionBy(F.lit(0))).orderBy(order)


def spread(df: DataFrame, per_key: DataFrame, keys: Sequence[str], chunk: str = "chunk") -> DataFrame:
    """Attaches one row per key to every row of ``df`` by way of (key, chunk), which never is a hot group."""
    keys = list(keys)
    carrier = df.select(*keys, chunk).distinct().join(per_key, keys, "inner")
    return df.join(carrier, [*keys, chunk], "inner")


DIGIT_BITS = 16


def value_counts(df: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """``(_k, _p, _n)``: rows per value of a whole-number column. ``_k`` holds the keys; as a struct it is never NULL
    itself, so groups with NULL keys stay."""
    key = F.struct(*keys) if keys else F.struct(F.lit(0).alias("all"))
    rows = df.select(key.alias("_k"), F.col(value).cast("long").alias("_p"))
    # The check that the joins would infer is spelled out, so that all uses of the counts share one exchange.
    present = F.col("_p").isNotNull() & F.shiftright("_p", DIGIT_BITS).isNotNull()
    return rows.filter(present).groupBy("_k", "_p").agg(F.count("*").alias("_n"))


def fewer_digits(counts: DataFrame) -> DataFrame:
    """Counts of the leading bits, without the last 16-bit digit."""
    up = F.shiftright("_p", DIGIT_BITS)
    return counts.withColumn("_p", up).filter(up.isNotNull()).groupBy("_k", "_p").agg(F.sum("_n").alias("_n"))


def _holding(counts: DataFrame, group: WindowSpec) -> DataFrame:
    """The counts that hold a wanted rank, with the rank among the values they stand for."""
    found = F.filter("_wanted", lambda w: (w["rank"] > F.col("_before")) & (w["rank"] <= F.col("_before") + F.col("_n")))
    inside = F.transform(found, lambda w: F.struct(w["name"].alias("name"), (w["rank"] - F.col("_before")).alias("rank")))
    before = F.sum("_n").over(group.orderBy("_p").rowsBetween(Window.unboundedPreceding, 0)) - F.col("_n")
    level = counts.withColumn("_before", before).withColumn("_wanted", inside)
    return level.filter(F.size("_wanted") > 0).select("_k", F.col("_p").alias("_up"), "n", "_wanted")


def _with_rank(counts: DataFrame, hits: DataFrame) -> DataFrame:
    """``_holding`` of the counts below the leading bits that are chosen already."""
    level = counts.withColumn("_up", F.shiftright("_p", DIGIT_BITS)).join(hits, ["_k", "_up"])
    return _holding(level, Window.partitionBy("_k", "_up"))


def value_at_rank(df: DataFrame, keys: Sequence[str], value: str, ranks: dict[str, Column]) -> DataFrame:
    """Exact order statistics of a whole-number column, one row per key.

    ``ranks`` maps an output name to the 1-based rank as an expression over ``n`` (rows of the group). This is a radix
    selection: rows shrink to counts per value before any shuffle, counts of the leading 32 bits locate the rest of every
    rank, then only counts below the chosen bits are looked at, 16 bits at a time. So what is ordered in one piece is never
    more than 65,536 counts, or one for each 2^32 of the span of a key's values. The digits are few, as each is a round of
    small shuffles.
    """
    keys = list(keys)
    counts = value_counts(df, keys, value)
    blocks = fewer_digits(counts)
    wanted = F.array(
        *[
            F.struct(
                F.lit(name).alias("name"),
                F.greatest(F.lit(1), F.least(F.col("n"), rank)).cast("long").alias("rank"),
            )
            for name, rank in ranks.items()
        ]
    )
    top = fewer_digits(blocks).withColumn("n", F.sum("_n").over(Window.partitionBy("_k"))).withColumn("_wanted", wanted)
    hits = _with_rank(counts, _with_rank(blocks, _holding(top, Window.partitionBy("_k"))))

    def holds(name: str) -> Column:
        return F.exists("_wanted", lambda w: w["name"] == name)

    picks = [F.max(F.when(holds(name), F.col("_up"))).alias(name) for name in ranks]
    out = hits.groupBy(*(["_k"] if keys else [])).agg(F.max("n").alias("n"), *picks)
    return out.select(*[F.col("_k")[c].alias(c) for c in keys], "n", *ranks)


def nearest_rank(p: float) -> Column:
    """Rank of the p-th percentile, to be used with ``value_at_rank``."""
    return F.ceil(F.lit(p / 100) * F.col("n"))


def upper_median() -> Column:
    """Rank of the middle element, the higher one of an even number."""
    return F.floor(F.col("n") / 2) + 1
