import pytest

from kerbside.operators import wire
from kerbside.sources import topic

from .helpers import messages, naive, ts


def test_encode_writes_the_exact_value(spark):
    df = messages(spark, ("ferry-12", "2031-03-04 06:19:15", 31), ("ferry-12", "2031-03-04 06:19:15.5", 0))
    assert [tuple(r) for r in wire.encode(df).collect()] == [
        ("ferry-12", '{"deviceId":"ferry-12","intervalStart":"2031-03-04T06:19:15Z","vehicles":31,"receivedAt":"2026-09-30T12:00:00.000Z"}'),
        ("ferry-12", '{"deviceId":"ferry-12","intervalStart":"2031-03-04T06:19:15.500Z","vehicles":0,"receivedAt":"2026-09-30T12:00:00.000Z"}'),
    ]


START, ACCEPTED = "2031-03-04T06:19:15Z", "2031-03-04T06:19:59.125Z"


def value(device='"ferry"', start=f'"{START}"', vehicles="31", accepted=f'"{ACCEPTED}"', more=""):
    return f'{{"receivedAt":{accepted},"vehicles":{vehicles},"deviceId":{device},"intervalStart":{start}{more}}}'


# Message and count.
GOOD = [(value(), 31), (value(vehicles="31.0"), 31), (value(vehicles="3.1e1"), 31), (f"\t{value()}\n", 31), (value(vehicles="0"), 0),
        (value(vehicles="99999999999"), 99999999999), (value(vehicles="1e16"), 1e16), (value(vehicles="1e300"), 1e300),
        (value(more=',"x":{"y":[]}'), 31)]
# Texts around a right message, and members of another kind.
AROUND = ['{},"x":1', '1,"doc":{}', "{} 0", "{},{}", "[{}]", '"{}', "{}]", '{},"', "{}]["]
BAD = [None, "", "{", "7", "[]", "nul", "null", "{}"] + [text.replace("{}", value()) for text in AROUND]
BAD += [value(device=x) for x in ("1", "null", "[]")] + [value(vehicles=x) for x in ("-2", "0.5", '"31"', "null", "false", "Infinity", "1e999")]
BAD += [value(start=x) for x in ('"soon"', "1930371555", '"2031-13-04T06:19:15Z"', '"2031-03-32T06:19:15Z"', '"2031-03-04T25:00:00Z"', '"2031-03-04T06:19:15"')]
BAD += [value(accepted="null"), value().replace("receivedAt", "at")]
# Instants with a zone, dates past the end of a month, and midnight at the end of a day.
SAME = {"2031-03-04T08:19:15+02:00": "2031-03-04 06:19:15", "2031-03-04": "2031-03-04 00:00:00", "2031-02-31T06:19:15Z": "2031-03-03 06:19:15",
        "2031-12-31T24:00:00Z": "2032-01-01 00:00:00", "2031-04-31": "2031-05-01 00:00:00"}


@pytest.fixture(scope="module")
def decoded(spark):
    data = [("k", v, 0, i) for i, v in enumerate([v for v, _ in GOOD] + BAD)]
    df = spark.createDataFrame(data, "key string, value string, partition int, offset long")
    return {r.offset: r for r in wire.decode(df).collect()}


def test_good_values_are_decoded(decoded):
    assert [(decoded[i].is_decoded, decoded[i].vehicles) for i in range(len(GOOD))] == [(True, n) for _, n in GOOD]
    assert naive(decoded[0].interval_start) == ts("2031-03-04 06:19:15").replace(tzinfo=None)
    assert decoded[0].accepted_at.microsecond == 125_000


def test_bad_values_are_marked_and_never_raise(decoded):
    for i in range(len(GOOD), len(GOOD) + len(BAD)):
        assert (decoded[i].is_decoded, decoded[i].device_id, decoded[i].vehicles) == (False, None, None), BAD[i - len(GOOD)]


def test_ways_to_write_an_instant(spark):
    df = spark.createDataFrame([(k, value(start=f'"{k}"')) for k in SAME], "key string, value string")
    got = {r.key: naive(r.interval_start) for r in wire.decode(df).collect()}
    assert got == {k: ts(v).replace(tzinfo=None) for k, v in SAME.items()}


def test_encode_then_decode(spark, rows):
    df = messages(spark, ("ferry-12", "2031-03-04 06:19:15", 31), ("f", "1999-12-31 23:59:45.001", 0))
    cols = ["device_id", "interval_start", "vehicles", "accepted_at"]
    assert rows(wire.decode(wire.encode(df)), *cols) == rows(df.withColumn("vehicles", df.vehicles.cast("double")), *cols)


def test_commit_offsets_pass_undecodable_messages(spark, rows):
    data = [("k", v, p, o) for p, o, v in ((3, 41, "?"), (3, 40, value()), (0, 0, None), (5, 2**40, "{"))]
    assert rows(wire.commit_offsets(spark.createDataFrame(data, topic.TOPIC))) == [(0, 1), (3, 42), (5, 2**40 + 1)]
