"""Incident analysis over request windows, for one or many runs.

Input rows are ``(run..., end, sent, reqs, s200, s400, s5xx, timeouts, neterr, buffered, p50, p95, p99)``.
Every function takes the columns that identify a run. Order-dependent logic goes through the chunked helpers of
``scale``, so a single very long run is still spread over the cluster.
"""

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.times import epoch_ms, from_ms, window_start_ms
from ..session import saved
from .scale import broadcast_limit, neighbours, plan_bytes, running_sum, spread, time_chunk, upper_median, value_at_rank

CYCLE_MS = 15_000
MINUTE_MS = 60_000


def errors() -> Column:
    """Failed requests of a window. A 400 is a data bug of the sender, not an outage."""
    return F.col("s5xx") + F.col("timeouts") + F.col("neterr")


def window_length(windows: DataFrame, run: list[str]) -> DataFrame:
    """``len_ms`` per run: the upper median gap between consecutive windows, to the second, at least one second."""
    timed = windows.select(*run, epoch_ms("end").alias("end_ms"), time_chunk("end").alias("chunk"))
    gaps = neighbours(timed, run, "end_ms", ["end_ms"]).select(
        *run, (F.col("end_ms") - F.col("prev_end_ms")).alias("gap")
    )
    typical = value_at_rank(gaps, run, "gap", {"gap": upper_median()})
    rounded = F.shiftright(F.col("gap") * 2 + 1000, 1)
    rounded = rounded - F.pmod(rounded, F.lit(1000))
    known = windows.select(*run).distinct().join(typical, run, "left") if run else typical
    return known.select(*run, F.greatest(F.lit(1000), F.coalesce(rounded, F.lit(1000))).cast("long").alias("len_ms"))


def placed(windows: DataFrame, run: list[str]) -> DataFrame:
    """Windows with ``len_ms``, their snapped ``start_ms``, ``errors`` and the ``chunk`` they are ordered in.

    All further questions read the result several times, so it is saved once.
    """
    base = saved(windows.withColumn("chunk", time_chunk("end")).withColumn("end_ms", epoch_ms("end")), "windows")
    lengths = saved(window_length(base.select(*windows.columns), run), "lengths")
    at = attached(base, lengths, run).withColumn("start_ms", window_start_ms("end_ms", "len_ms")).withColumn("errors", errors())
    return saved(at, "placed-windows")


def attached(at: DataFrame, facts: DataFrame, run: list[str]) -> DataFrame:
    """Windows with the saved facts of their run: one row per run, broadcast if they are small."""
    if not run:
        return at.crossJoin(F.broadcast(facts))  # one row
    if plan_bytes(facts) <= broadcast_limit(facts):
        return at.join(F.broadcast(facts), run)
    return spread(at, facts, run)


def totals(windows: DataFrame, run: list[str]) -> DataFrame:
    return windows.groupBy(*run).agg(
        F.count("*").alias("windows"),
        F.sum("reqs").alias("requests"),
        F.sum("s5xx").alias("s5xx"),
        F.sum("timeouts").alias("timeouts"),
        F.sum("neterr").alias("neterr"),
        F.sum("s400").alias("s400"),
        F.max("buffered").alias("max_buffered"),
        F.max("p99").alias("max_p99"),
    )


def error_span(at: DataFrame, run: list[str]) -> DataFrame:
    """First and last window with errors, and how many there are. Takes ``placed`` windows."""
    failed = F.col("errors") > 0
    span = at.groupBy(*run).agg(
        F.min(F.when(failed, F.col("start_ms"))).alias("first_ms"),
        F.max(F.when(failed, F.col("start_ms") + F.col("len_ms"))).alias("last_ms"),
        F.min(F.when(failed, F.col("end_ms"))).alias("first_end_ms"),
        F.max(F.when(failed, F.col("end_ms"))).alias("last_end_ms"),
        F.count_if(failed).alias("error_windows"),
        F.count("*").alias("windows"),
    )
    return span.withColumn("duration_ms", F.col("last_ms") - F.col("first_ms"))


def run_facts(at: DataFrame, run: list[str]) -> DataFrame:
    """``first_end_ms, last_end_ms, normal, median_p99`` per run, saved; see ``normal_backlog``.

    Both medians come from one selection, over (run, column).
    """
    span = saved(error_span(at, run).select(*run, "first_end_ms", "last_end_ms"), "spans")
    early = F.col("end_ms") < F.col("first_end_ms")
    highest = attached(at, span, run).groupBy(*run).agg(
        F.max("first_end_ms").alias("first_end_ms"),
        F.max("last_end_ms").alias("last_end_ms"),
        F.max(F.when(early, F.col("buffered"))).alias("_highest"),
    )
    both = F.explode(F.create_map(F.lit("buffered"), "buffered", F.lit("p99"), "p99")).alias("_column", "_value")
    middle = value_at_rank(at.select(*run, both), [*run, "_column"], "_value", {"_middle": upper_median()})
    of = {c: F.max(F.when(F.col("_column") == c, F.col("_middle"))) for c in ("buffered", "p99")}
    middle = middle.groupBy(*run).agg(of["buffered"].alias("_calm"), of["p99"].alias("median_p99"))
    facts = highest.join(middle, run, "left") if run else highest.crossJoin(F.broadcast(middle))  # one row each
    normal = F.when(F.col("first_end_ms").isNull(), F.col("_calm")).otherwise(F.greatest(F.lit(0), "_highest"))
    normal = F.coalesce(normal, F.lit(0)).cast("long").alias("normal")
    return saved(facts.select(*run, "first_end_ms", "last_end_ms", normal, "median_p99"), "facts")


def normal_backlog(at: DataFrame, run: list[str]) -> DataFrame:
    """``normal`` per run: the highest backlog before the first error, or the upper median of a run without errors."""
    return run_facts(at, run).select(*run, "normal")


def recovery(at: DataFrame, run: list[str]) -> DataFrame:
    """When the backlog was back to normal after the last error; NULL when it never was or nothing failed."""
    back = (F.col("end_ms") > F.col("last_end_ms")) & (F.col("buffered") <= F.col("normal"))
    cleared = attached(at, run_facts(at, run), run).groupBy(*run).agg(
        F.max("normal").alias("normal"),
        F.max("last_end_ms").alias("last_end_ms"),
        F.min(F.when(back, F.col("end_ms"))).alias("cleared_ms"),
    )
    return cleared.withColumn("recovery_ms", F.col("cleared_ms") - F.col("last_end_ms"))


def post_restore(at: DataFrame, run: list[str], restored_at) -> DataFrame:
    """Errors in windows ending after ``restored_at``, and the time from there until the backlog was normal."""
    restored = epoch_ms(F.lit(restored_at))
    late = (F.col("start_ms") + F.col("len_ms")) > restored
    after = at.groupBy(*run).agg(F.coalesce(F.sum(F.when(late, F.col("errors"))), F.lit(0)).alias("errors_after"))
    cleared = recovery(at, run).select(*run, "cleared_ms")
    out = after.join(cleared, run, "left") if run else after.withColumn("cleared_ms", cleared.scalar())
    return out.select(*run, "errors_after", "cleared_ms", (F.col("cleared_ms") - restored).alias("normal_after_ms"))


def phase_profile(at: DataFrame, run: list[str], cycle_ms: int = CYCLE_MS, period_ms: int = MINUTE_MS) -> DataFrame:
    """Windows grouped by their position in the period; only for windows that divide the sending cycle."""
    fits = (F.col("len_ms") < cycle_ms) & (F.pmod(F.lit(cycle_ms), F.col("len_ms")) == 0)
    phased = at.filter(fits).withColumn("phase_ms", F.pmod(F.col("start_ms"), F.lit(period_ms)))
    keys = [*run, "phase_ms"]
    sums = phased.groupBy(*keys).agg(
        F.count("*").alias("windows"),
        F.max("p99").alias("max_p99"),
        F.sum("s5xx").alias("s5xx"),
        F.sum("timeouts").alias("timeouts"),
        F.sum("neterr").alias("neterr"),
    )
    middle = value_at_rank(phased, keys, "p99", {"median_p99": upper_median()}).drop("n")
    return sums.join(middle, keys, "inner")


def shown_windows(at: DataFrame, run: list[str]) -> DataFrame:
    """Adds ``shown``: the window or a direct neighbour has errors, a backlog or a p99 well above the median."""
    facts = run_facts(at, run).select(*run, "normal", "median_p99")
    marked = attached(at, facts, run)
    loud = (
        (F.col("errors") > 0)
        | (F.col("buffered") > F.col("normal"))
        | (F.col("p99") > F.col("median_p99") * 3 + 5)
    )
    near = neighbours(marked.withColumn("interesting", loud), run, "end_ms", ["interesting"])
    shown = (
        F.col("interesting")
        | F.coalesce("prev_interesting", F.lit(False))
        | F.coalesce("next_interesting", F.lit(False))
    )
    return near.withColumn("shown", shown).drop("prev_interesting", "next_interesting")


def timeline(at: DataFrame, run: list[str]) -> DataFrame:
    """Shown windows as they are; each stretch of hidden windows as one row with ``is_gap`` and its length."""
    flagged = saved(shown_windows(at, run), "shown-windows")
    # Every shown window opens a stretch of its own; a hidden one opens a stretch when it follows a shown one.
    chained = neighbours(flagged, run, "end_ms", ["shown"])
    opens = F.col("shown") | F.coalesce("prev_shown", F.lit(True))
    stretched = running_sum(chained.withColumn("_opens", opens.cast("int").cast("long")), run, "end_ms", "_opens", "seq")
    counts = ["sent", "s200", "s5xx", "timeouts", "neterr", "buffered", "p50", "p95", "p99"]
    rows = stretched.groupBy(*run, "seq").agg(
        (~F.bool_or("shown")).alias("is_gap"),
        F.count("*").alias("windows"),
        F.min("start_ms").alias("start_ms"),
        F.max(F.col("start_ms") + F.col("len_ms")).alias("end_ms"),
        *[F.max(F.when(F.col("shown"), F.col(c))).alias(c) for c in counts],
    )
    return rows.select(
        *run, "seq", "is_gap", "windows", from_ms("start_ms").alias("start"), from_ms("end_ms").alias("end"), *counts
    )


def zero_runs(at: DataFrame, run: list[str]) -> DataFrame:
    """Stretches of consecutive windows without one successful request, with their length."""
    marked = at.withColumn("_alive", F.when(F.col("s200") > 0, 1).otherwise(0).cast("long"))
    # All windows of a stretch share the number of live windows before them.
    islands = running_sum(marked, run, "end_ms", "_alive", "_island").filter(F.col("s200") == 0)
    stretches = islands.groupBy(*run, "_island").agg(
        F.count("*").alias("windows"),
        F.min("start_ms").alias("start_ms"),
        F.max(F.col("start_ms") + F.col("len_ms")).alias("end_ms"),
    )
    return stretches.select(
        *run,
        "windows",
        from_ms("start_ms").alias("start"),
        from_ms("end_ms").alias("end"),
        (F.col("end_ms") - F.col("start_ms")).alias("duration_ms"),
    )


def longest_zero_run(at: DataFrame, run: list[str]) -> DataFrame:
    return zero_runs(at, run).groupBy(*run).agg(
        F.max("duration_ms").alias("longest_zero_ms"), F.count("*").alias("zero_runs")
    )
