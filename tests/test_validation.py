import json

import pytest
from pyspark.sql import functions as F

from kerbside.operators import validation as V

from .helpers import devices, naive, ts

QUICK, SLOW = "bridge-03", "tunnel-11"
AT = "2031-03-04T06:{}Z"
NOON = "2031-03-04 06:20:00"  # when the bodies arrive
ITEM = {"deviceId": QUICK, "intervalStart": AT.format("19:15"), "intervalSeconds": 15, "vehicles": 42}
MINUTE = ITEM | {"deviceId": SLOW, "intervalSeconds": 60, "intervalStart": AT.format("18:00")}
SHAPE = 'intervalStart must be an ISO 8601 UTC timestamp like "2026-09-30T11:00:45Z"'
COUNT = "vehicles must be a non-negative integer, got "
LIST = "body must be a JSON array of readings"
TEXT = json.dumps(ITEM)


def without(name):
    return {k: v for k, v in ITEM.items() if k != name}


def start(text, item=ITEM):
    return item | {"intervalStart": text}


def seconds(got):
    return f"intervalSeconds must be 15 for {QUICK}, got {got}"


# Bodies that are no list, among them texts that only become one when something is put around them.
NO_LIST = [TEXT, "", "true", '"[]"', "[", "[" + TEXT, f"[{TEXT}]]", f"[{TEXT}] [", f'[{TEXT}],"x":1', f'5,"doc":[{TEXT}]', f"[{TEXT}],[{TEXT}]",
           f'[{TEXT}],"', f"1],[{TEXT}"]
SIZES = [(0, "0"), (501, "501"), (733, "733")]
# (item, reason), in the order of the rules.
BROKEN = [
    (17, "reading must be an object"),
    ("text", "reading must be an object"),
    ([ITEM], "reading must be an object"),
    (without("deviceId"), "deviceId must be a string"),
    (ITEM | {"deviceId": ["x"]}, "deviceId must be a string"),
    (ITEM | {"deviceId": "bridge-3"}, 'unknown deviceId "bridge-3"'),
    (ITEM | {"deviceId": ""}, 'unknown deviceId ""'),
    (without("intervalSeconds"), seconds("undefined")),
    (ITEM | {"intervalSeconds": None}, seconds("null")),
    (ITEM | {"intervalSeconds": "fifteen"}, seconds('"fifteen"')),
    (ITEM | {"intervalSeconds": 14}, seconds("14")),
    (without("intervalStart"), SHAPE),
    (start(1930371555), SHAPE),
    (start("04.03.2031 06:19"), SHAPE),
    (start("2031-03-04T06:19:15"), SHAPE),
    (start("2031-03-04T01:19:15-05:00"), SHAPE),
    (start(AT.format("19:15") + " "), SHAPE),
    (start("2031-04-31T06:19:15Z"), SHAPE + " (invalid date)"),
    (start("2031-03-03T24:00:00Z"), SHAPE + " (invalid date)"),
    (start(AT.format("19:17")), f"intervalStart {AT.format('19:17')} is not aligned to a 15s boundary"),
    (start(AT.format("19:15.001")), f"intervalStart {AT.format('19:15.001')} is not aligned to a 15s boundary"),
    (start(AT.format("18:45"), MINUTE), f"intervalStart {AT.format('18:45')} is not aligned to a 60s boundary"),
    (start(AT.format("20:15")), f"intervalStart {AT.format('20:15')} is in the future"),
    (start("2131-03-04T06:19:15Z"), "intervalStart 2131-03-04T06:19:15Z is in the future"),
    (without("vehicles"), COUNT + "undefined"),
    (ITEM | {"vehicles": False}, COUNT + "false"),
    (ITEM | {"vehicles": "many"}, COUNT + '"many"'),
    (ITEM | {"vehicles": -3}, COUNT + "-3"),
    (ITEM | {"vehicles": 0.25}, COUNT + "0.25"),
    (ITEM | {"vehicles": 2**31 + 9}, COUNT + str(2**31 + 9)),
    (TEXT.replace("42}", "3e555}"), COUNT + "null"),
]


def listed(*items):
    return "[" + ",".join(i if isinstance(i, str) and i.startswith("{") else json.dumps(i) for i in items) + "]"


REJECTED = [(text, None, LIST) for text in NO_LIST]
REJECTED += [([ITEM] * n, None, f"batch must contain 1-500 readings, got {text}") for n, text in SIZES]
# Each broken item alone, and behind as many good ones as its number in the list.
REJECTED += [(listed(item), 0, reason) for item, reason in BROKEN]
REJECTED += [(listed(*[ITEM] * i, item, 17), i, reason) for i, (item, reason) in enumerate(BROKEN) if i % 4 == 1]
# An item that breaks several rules is named by the first one.
REJECTED += [([ITEM | {"vehicles": -1, "intervalStart": "soon"}], 0, SHAPE), ([{"vehicles": "x"}], 0, "deviceId must be a string")]

ACCEPTED = [
    ([ITEM, MINUTE, ITEM], 3),
    ([start("2031-03-04T06:20:00.0Z")], 1),
    ([MINUTE] * 500, 500),
    ([ITEM | {"vehicles": v} for v in (0, 1, 2**31 - 1)], 3),
    (listed(TEXT.replace("42}", "4.2e1}"), TEXT.replace(" 15,", " 1.5E1,")), 2),
    (f" \n[ {TEXT} ]\t", 1),
    (listed(TEXT.replace('"vehicles"', '"vehicles": null, "vehicles"')), 1),
    ([ITEM | {"note": {"any": [1, None]}}], 1),
]


def body(b):
    return b if isinstance(b, str) else json.dumps(b)


@pytest.fixture(scope="module")
def result(spark):
    cases = [c[0] for c in REJECTED] + [c[0] for c in ACCEPTED]
    data = [(i, ts(NOON), body(c)) for i, c in enumerate(cases)]
    subs = spark.createDataFrame(data, "batch_id long, received_at timestamp, body string")
    dim = devices(spark, (QUICK, 15), (SLOW, 60))
    accepted, rejected = V.validate_submissions(subs, dim)
    return (
        {r.batch_id: (r["index"], r.reason) for r in rejected.collect()},
        {r.batch_id: r.queued for r in V.accepted_summary(accepted).collect()},
        accepted,
    )


def test_rejections_name_the_first_failing_item_and_rule(result):
    rejected, _, _ = result
    assert rejected == {i: (index, reason) for i, (_, index, reason) in enumerate(REJECTED)}


def test_accepted_batches_are_complete(result):
    _, queued, _ = result
    assert queued == {len(REJECTED) + i: n for i, (_, n) in enumerate(ACCEPTED)}


def test_accepted_readings_are_typed(result):
    _, _, accepted = result
    got = accepted.filter(F.col("batch_id") == len(REJECTED)).orderBy("pos").collect()
    assert [(r.device_id, r.vehicles) for r in got] == [(QUICK, 42), (SLOW, 42), (QUICK, 42)]
    assert [naive(r.interval_start).strftime("%H:%M:%S") for r in got] == ["06:19:15", "06:18:00", "06:19:15"]
    numbers = accepted.filter(F.col("batch_id") == len(REJECTED) + 4)
    assert [r.vehicles for r in numbers.orderBy("pos").collect()] == [42, 42]


def test_a_clock_may_be_ahead_by_five_seconds(spark):
    """The same reading, arriving 0 to 9 seconds before its interval starts."""
    data = [(s, ts(f"2031-03-04 06:29:{60 - s}") if s else ts("2031-03-04 06:30:00"), listed(start(AT.format("30:00")))) for s in range(10)]
    subs = spark.createDataFrame(data, "batch_id long, received_at timestamp, body string")
    _, rejected = V.validate_submissions(subs, devices(spark, (QUICK, 15)))
    assert sorted(r.batch_id for r in rejected.collect()) == [6, 7, 8, 9]


def test_outcomes(spark, rows):
    data = [(1, 200, None), (2, 400, None), (3, 404, None), (4, 503, None), (5, None, "timeout"), (6, None, "refused")]
    df = spark.createDataFrame(data, "id int, status int, error string")
    assert rows(df.select("id", V.outcome("status", "error"))) == [
        (1, "ok"),
        (2, "rejected"),
        (3, "5xx"),
        (4, "5xx"),
        (5, "timeout"),
        (6, "network"),
    ]
