import random
from datetime import datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from kerbside.operators import incident as N
from kerbside.sources import logs

from .helpers import naive, ts

T0 = ts("2031-03-04 05:00:00")
COUNTERS = "sent long, reqs long, s200 long, s400 long, s5xx long, timeouts long, neterr long, buffered long, p50 long, p95 long, p99 long"
SCHEMA = f"run string, end timestamp, {COUNTERS}"


def window(run, i, seconds, ok=60, e5=0, to=0, net=0, buf=4, p99=30, late=0):
    end = T0 + timedelta(seconds=seconds * i, milliseconds=late)
    return (run, end, ok, ok + e5, ok, 0, e5, to, net, buf, 8, 14, p99)


# Phases of the runs: how many windows look alike. Their ends are 0 to 40 ms late, in turn.
PHASES = {
    # A dam breaks twice: first with server errors, then without any answer; the backlog drains in steps.
    ("dam", 20): [(9, {"buf": 6}), (4, {"ok": 0, "e5": 11, "buf": 90}), (2, {"ok": 5, "buf": 70}), (3, {"ok": 0, "net": 9, "buf": 120}),
                  (5, {"buf": 40, "p99": 300}), (8, {"buf": 6})],
    # A tide: every 30 s one window of 3 s is slow, every minute it also times out.
    ("tide", 3): [part for _ in range(4) for part in ((1, {"to": 7, "p99": 800}), (9, {}), (1, {"p99": 400}), (9, {}))],
    ("calm", 45): [(5, {})],
}


def rows_of(name):
    (seconds, phases), = [(key[1], p) for key, p in PHASES.items() if key[0] == name]
    looks = [look for n, look in phases for _ in range(n)]
    return [window(name, i + 1, seconds, late=i % 5 * 10, **look) for i, look in enumerate(looks)]


def clock(seconds):
    return int((T0 + timedelta(seconds=seconds)).timestamp() * 1000)


@pytest.fixture(scope="module")
def runs(spark):
    windows = spark.createDataFrame([w for name, _ in PHASES for w in rows_of(name)], SCHEMA)
    return windows, N.placed(windows, ["run"])


def by_run(df):
    return {r.run: r for r in df.collect()}


def test_window_length_per_run(runs):
    got = {r.run: r.len_ms for r in N.window_length(runs[0], ["run"]).collect()}
    assert got == {name: seconds * 1000 for name, seconds in PHASES}


def test_totals(runs):
    got = by_run(N.totals(runs[0], ["run"]))
    for name, _ in PHASES:
        rows = rows_of(name)
        total = got[name]
        assert (total.s5xx, total.timeouts, total.windows) == (sum(w[6] for w in rows), sum(w[7] for w in rows), len(rows))
        assert total.max_buffered == max(w[9] for w in rows)


def test_error_span_covers_both_breaks(runs):
    span = by_run(N.error_span(runs[1], ["run"]))
    dam = span["dam"]
    # The first window with errors is the tenth, the last one the eighteenth.
    assert (dam.first_ms, dam.last_ms, dam.duration_ms) == (clock(9 * 20), clock(18 * 20), 9 * 20_000)
    assert (dam.error_windows, dam.windows) == (7, 31)
    assert (span["calm"].first_ms, span["calm"].error_windows) == (None, 0)


def test_recovery_waits_for_the_backlog(runs):
    dam = by_run(N.recovery(runs[1], ["run"]))["dam"]
    cleared = 24 * 20  # the first window after the errors with no more than before them
    assert (dam.normal, dam.recovery_ms // 1000) == (6, cleared - 18 * 20)
    assert dam.cleared_ms // 1000 == clock(cleared) // 1000


@pytest.mark.parametrize(("restored", "errors"), [(9, 7 * 10 + 1), (13, 27), (18, 0)])
def test_errors_after_a_restore(runs, restored, errors):
    after = by_run(N.post_restore(runs[1], ["run"], F.lit(T0 + timedelta(seconds=20 * restored))))
    assert after["dam"].errors_after == errors
    assert after["calm"].cleared_ms is None


def test_one_run_without_a_run_column_gives_the_same_answers(spark, runs):
    alone = N.placed(spark.createDataFrame(rows_of("dam"), SCHEMA).drop("run"), [])
    assert N.recovery(alone, []).first().recovery_ms == by_run(N.recovery(runs[1], ["run"]))["dam"].recovery_ms
    assert N.longest_zero_run(alone, []).first().longest_zero_ms == brute_zero_runs(rows_of("dam")) * 20_000
    got = [(r.is_gap, r.windows) for r in N.timeline(alone, []).orderBy("seq").collect()]
    assert got == [(gap, n) for gap, n, _ in brute_timeline(rows_of("dam"))]


def test_phase_profile_only_for_windows_that_divide_the_cycle(runs):
    got = {(r.run, r.phase_ms): r for r in N.phase_profile(runs[1], ["run"]).collect()}
    assert {run for run, _ in got} >= {"tide"} and "calm" not in {run for run, _ in got}
    tide = {phase // 1000: (r.windows, r.median_p99, r.max_p99, r.timeouts) for (run, phase), r in got.items() if run == "tide"}
    assert set(tide) == set(range(0, 60, 3))
    assert [tide[s] for s in (0, 3, 30, 57)] == [(4, 800, 800, 28), (4, 30, 30, 0), (4, 400, 400, 0), (4, 30, 30, 0)]


def test_a_calm_run_shows_nothing(runs):
    assert N.shown_windows(runs[1], ["run"]).filter("run = 'calm' and shown").count() == 0


def brute_timeline(rows):
    """Rows of the timeline, computed on a list: (is_gap, windows, first end)."""
    mid = lambda xs: sorted(xs)[len(xs) // 2]
    err = lambda w: w[6] + w[7] + w[8]
    first = next((i for i, w in enumerate(rows) if err(w) > 0), None)
    normal = mid([w[9] for w in rows]) if first is None else max([0] + [w[9] for w in rows[:first]])
    loud = [err(w) > 0 or w[9] > normal or w[12] > 3 * mid([w[12] for w in rows]) + 5 for w in rows]
    shown = [any(loud[max(0, i - 1) : i + 2]) for i in range(len(rows))]
    out = []
    for w, s in zip(rows, shown, strict=True):
        if s:
            out.append([False, 1, w[1]])
        elif out and out[-1][0]:
            out[-1][1] += 1
        else:
            out.append([True, 1, w[1]])
    return out


def brute_zero_runs(rows):
    longest = run = 0
    for w in rows:
        run = run + 1 if w[4] == 0 else 0
        longest = max(longest, run)
    return longest


@pytest.mark.parametrize("seed", [1, 2])
def test_long_random_runs_match_a_sequential_pass(spark, seed):
    """Hour windows over weeks, so runs cross many chunks."""
    rng = random.Random(seed)
    data = []
    for run in ("a", "b"):
        for i in range(1, 500):
            failing = rng.random() < 0.02
            data.append(
                window(run, i, 3600, ok=0 if rng.random() < 0.5 else 10, e5=5 if failing else 0, buf=rng.choice([2, 2, 2, 2, 9]), late=3,
                       p99=rng.choice([20] * 40 + [500]))
            )
    at = N.placed(spark.createDataFrame(data, SCHEMA), ["run"])
    lines = N.timeline(at, ["run"]).orderBy("run", "seq").collect()
    longest = {r.run: r.longest_zero_ms for r in N.longest_zero_run(at, ["run"]).collect()}
    for run in ("a", "b"):
        rows = [w for w in data if w[0] == run]
        expected = brute_timeline(rows)
        got = [r for r in lines if r.run == run]
        assert [(r.is_gap, r.windows) for r in got] == [(g, n) for g, n, _ in expected]
        starts = [(end - timedelta(hours=1, milliseconds=3)).astimezone(timezone.utc).replace(tzinfo=None) for _, _, end in expected]
        assert [naive(r.start) for r in got] == starts
        assert longest[run] == brute_zero_runs(rows) * 3_600_000


LINE = (
    "[2031-03-04T05:00:20.017Z] sent=61 (3/s) reqs=72 200=58 400=2 5xx=11 timeouts=6 neterr=9 queued=58 dupes=1 "
    "buffered=90 latency p50=8ms p95=14ms p99=333ms"
)


def parsed(windows):
    return [(r.run, naive(r.end), r.sent, r.reqs, r.s200, r.s400, r.s5xx, r.timeouts, r.neterr, r.buffered, r.p50, r.p95, r.p99)
            for r in windows.collect()]


EXPECTED = (datetime(2031, 3, 4, 5, 0, 20, 17000), 61, 72, 58, 2, 11, 6, 9, 90, 8, 14, 333)


@pytest.mark.parametrize(("name", "encoding"), [("utf8", "utf-8"), ("bom", "utf-8-sig"), ("wide", "utf-16")])
def test_log_files_in_any_encoding(spark, tmp_path, name, encoding):
    text = "\r\n".join(["", "load generator 4", LINE, LINE[1:60], "x" + LINE, "end of run"])
    path = tmp_path / f"{name}.log"
    path.write_bytes(text.encode(encoding))
    assert parsed(logs.parse_windows(logs.detect_log_lines(spark, str(path)))) == [(f"{name}.log", *EXPECTED)]
    given = "UTF-16LE" if encoding == "utf-16" else "UTF-8"
    assert parsed(logs.parse_windows(logs.read_log_lines(spark, str(path), given))) == [(f"{name}.log", *EXPECTED)]


@pytest.mark.parametrize(("folder", "pattern"), [("run={}", ""), ("host {}", "/*/x.log")])
def test_mixed_encodings_in_several_folders(spark, tmp_path, folder, pattern):
    """Files of one name in several folders, large enough for several splits, and an empty one."""
    text = "\r\n".join([LINE, *["noise Ċ \u0a0a"] * 2000, LINE])
    for name, encoding in (("a", "utf-16"), ("b", "utf-8"), ("c", "utf-8-sig"), ("d", "utf-16")):
        (tmp_path / folder.format(name)).mkdir()
        (tmp_path / folder.format(name) / "x.log").write_bytes(text.encode(encoding))
    (tmp_path / folder.format("e")).mkdir()
    (tmp_path / folder.format("e") / "x.log").write_bytes(b"")
    small = "spark.sql.files.maxPartitionBytes"
    before = spark.conf.get(small)
    spark.conf.set(small, "8k")
    try:
        got = parsed(logs.parse_windows(logs.detect_log_lines(spark, f"{tmp_path}{pattern}")))
    finally:
        spark.conf.set(small, before)
    names = list("abcd") if "run" in folder else [f"host%20{n}/x.log" for n in "abcd"]
    assert sorted(got) == sorted((n, *EXPECTED) for n in names for _ in range(2))


@pytest.mark.parametrize(("encoding", "given"), [("utf-8-sig", "UTF-8"), ("utf-16", "UTF-16LE")])
def test_the_byte_order_mark_does_not_hide_the_first_line(spark, tmp_path, encoding, given):
    path = tmp_path / "first.log"
    path.write_bytes((LINE + "\n").encode(encoding))
    assert len(parsed(logs.parse_windows(logs.read_log_lines(spark, str(path), given)))) == 1


def test_format_is_the_inverse_of_parse(spark, runs, rows):
    lines = logs.format_windows(runs[0], 10).withColumnRenamed("value", "line")
    assert rows(logs.parse_windows(lines)) == rows(runs[0])
