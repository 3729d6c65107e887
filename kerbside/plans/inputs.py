"""Inputs of the registered queries, derived from the whole ``events`` table.

Every event is one reading of device ``user_id + 1``. The same inputs exist as SQL in ``inputs_sql``.
"""

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.scalars import device_id
from ..functions.times import floor_to
from ..operators.devices import device_rows
from ..operators.ingest import has_calendar_year
from ..operators.wire import message_value
from ..schema import MAX_BATCH
from ..session import configure

# Given, so that opening the table starts no job.
EVENTS = "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string"
HALF = "2024-01-16 00:00:00"
OUTAGE_FROM = "2024-01-10 06:00:00"
OUTAGE_TO = "2024-01-10 12:00:00"
CALM_FROM = "2024-01-10 18:00:00"


def ntz(c):
    return F.col(c).cast("timestamp_ntz") if isinstance(c, str) else c.cast("timestamp_ntz")


def instant(text: str):
    return F.lit(text).cast("timestamp_ntz")


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return configure(spark).read.schema(EVENTS).parquet(f"{sf_dir}/events.parquet")


def n_devices(spark, sf_dir) -> DataFrame:
    return events(spark, sf_dir).agg((F.max("user_id") + 1).alias("n"))


def n_events(spark, sf_dir) -> DataFrame:
    return events(spark, sf_dir).agg((F.max("event_id") + 1).alias("n"))


def devices(spark, sf_dir) -> DataFrame:
    numbers = events(spark, sf_dir).select((F.col("user_id") + 1).alias("n")).distinct()
    return device_rows(numbers, n_devices(spark, sf_dir).scalar())


def readings(spark, sf_dir, extra: tuple[str, ...] = ()) -> DataFrame:
    """``(device_id, interval_start, vehicles, stored_at, accepted_at, offset)``, one row per event.

    The reporting interval follows from the device number, so no join with the device table is needed.
    """
    number = F.col("user_id") + 1
    seconds = F.when(number <= F.floor(n_devices(spark, sf_dir).scalar() / 2), 15).otherwise(60)
    return events(spark, sf_dir).select(
        device_id(number).alias("device_id"),
        ntz(floor_to("ts", seconds)).alias("interval_start"),
        F.floor("value").cast("int").alias("vehicles"),
        F.col("ts").alias("stored_at"),
        F.col("ts").alias("accepted_at"),
        F.col("event_id").alias("offset"),
        *extra,
    )


def stored(spark, sf_dir) -> DataFrame:
    """What the table holds before the batch: the first write per key of the first half of the month."""
    early = readings(spark, sf_dir).filter(F.col("stored_at") < instant(HALF))
    return early.groupBy("device_id", "interval_start").agg(
        F.min_by("vehicles", "offset").alias("vehicles"), F.min_by("stored_at", "offset").alias("stored_at")
    )


def incoming(spark, sf_dir) -> DataFrame:
    """Messages of one batch: every reading, then a second count of every signup and a foreign device per error."""
    n = n_events(spark, sf_dir).scalar()
    rows = readings(spark, sf_dir, ("event_type", "user_id"))
    partition = F.pmod(F.col("user_id") + 1, F.lit(6)).cast("int")
    kind = F.col("event_type")

    def message(device, vehicles, offset):
        return F.struct(
            device.alias("device_id"),
            F.col("interval_start"),
            vehicles.alias("vehicles"),
            F.col("accepted_at"),
            offset.alias("offset"),
            partition.alias("partition"),
        )

    device, vehicles, offset = F.col("device_id"), F.col("vehicles"), F.col("offset")
    sent = message(device, vehicles, offset)
    recount = F.when(kind == "signup", message(device, vehicles + 1, offset + n))
    foreign = F.when(kind == "error", message(F.lit("dev-unknown"), vehicles, offset + n * 2))
    # One scan: at most two messages leave per event.
    return rows.select(F.inline(F.array_compact(F.array(sent, recount, foreign))))


# Values of ``k`` in ``props`` that turn a purchase into a message which only looks right, or holds a large count.
MORE_MEMBERS, OTHER_DOCUMENT, MORE_TEXT, TWO_VALUES, LARGE_COUNT = 1, 2, 3, 4, 5
LARGE = "1e16"
EMPTY, TOO_LONG = 6, 7
TOO_EARLY, TOO_LATE = 8, 9
#: Instants outside the years 1 to 9999, as a decoder accepts them.
EARLY_TEXT, LATE_TEXT = "0000-01-01T00:00:00Z", "9999-12-31T24:00:00Z"


def topic(spark, sf_dir) -> DataFrame:
    """The incoming messages on the wire, plus a foreign one per purchase: its ``props``, or a message broken by ``k``."""
    rows = incoming(spark, sf_dir).select(
        F.col("device_id").alias("key"), message_value().alias("value"), "partition", "offset"
    )
    k = F.get_json_object("props", "$.k").cast("int")
    right = message_value()
    value = (
        F.when(k == MORE_MEMBERS, F.concat(right, F.lit(',"x":1')))
        .when(k == OTHER_DOCUMENT, F.concat(F.lit('1,"doc":'), right))
        .when(k == MORE_TEXT, F.concat(right, F.lit(" x")))
        .when(k == TWO_VALUES, F.concat(right, F.lit(","), right))
        .when(k == LARGE_COUNT, F.regexp_replace(right, '"vehicles":[0-9]+', f'"vehicles":{LARGE}'))
        .when(k == TOO_EARLY, F.regexp_replace(right, '"intervalStart":"[^"]+', f'"intervalStart":"{EARLY_TEXT}'))
        .when(k == TOO_LATE, F.regexp_replace(right, '"intervalStart":"[^"]+', f'"intervalStart":"{LATE_TEXT}'))
        .otherwise(F.col("props"))
    )
    foreign = readings(spark, sf_dir, ("event_type", "user_id", "props")).filter(F.col("event_type") == "purchase").select(
        F.col("device_id").alias("key"),
        value.alias("value"),
        F.pmod(F.col("user_id") + 1, F.lit(6)).cast("int").alias("partition"),
        (F.col("offset") + n_events(spark, sf_dir).scalar() * 3).alias("offset"),
    )
    return rows.unionAll(foreign)


def broken(spark, sf_dir) -> DataFrame:
    """Decoded messages that break a rule of the table: views without a count, without a start, with a large count, or
    with a start before the year 1 or after 9999."""
    k = F.get_json_object("props", "$.k").cast("int")
    rows = readings(spark, sf_dir, ("event_type", "props")).filter((F.col("event_type") == "view") & k.between(1, 5))
    years = F.when(k == 4, F.expr("INTERVAL '-3000' YEAR")).when(k == 5, F.expr("INTERVAL '9000' YEAR"))
    return rows.select(
        "device_id",
        F.when(k > 3, F.col("interval_start") + years).when(k != 1, F.col("interval_start")).alias("interval_start"),
        F.when(k == 2, None).when(k == 3, float(LARGE)).otherwise(F.col("vehicles").cast("double")).alias("vehicles"),
        "accepted_at",
        (F.col("offset") + n_events(spark, sf_dir).scalar() * 4).alias("offset"),
    )


def shown(ts) -> Column:
    """An instant as clients can show it: NULL outside the years 1 to 9999."""
    return F.when(has_calendar_year(F.col(ts)), F.col(ts))


def delayed(spark, sf_dir) -> DataFrame:
    """Readings stored ``value`` seconds after they were accepted."""
    late = F.unix_micros(F.col("accepted_at").cast("timestamp")) + F.floor(F.col("value") * 1000) * 1000
    rows = readings(spark, sf_dir, ("value",)).withColumn("stored_at", ntz(F.timestamp_micros(late)))
    return rows.drop("value")


def requests(spark, sf_dir) -> DataFrame:
    """Every event as one request: purchases refused, signups failed on the server, errors without an answer."""
    kind = F.col("event_type")
    return events(spark, sf_dir).select(
        "event_id",
        "ts",
        (F.when(kind.isin("click", "view"), 200).when(kind == "purchase", 400).when(kind == "signup", 503))
        .cast("int")
        .alias("status"),
        F.when((kind == "error") & (F.col("value") >= 20), "timeout").when(kind == "error", "refused").alias("error"),
        F.floor(F.col("value") * 10).cast("long").alias("latency_ms"),
        (F.floor("value") + 1).cast("long").alias("n_readings"),
        (F.floor("value") + 1).cast("long").alias("queued"),
    )


def windows(spark, sf_dir) -> DataFrame:
    """Hourly request windows, one run per event type; all requests fail 06:00-12:00 on the 10th."""
    ts = F.col("ts")
    down = (ts >= instant(OUTAGE_FROM)) & (ts < instant(OUTAGE_TO))
    ms = F.floor(F.col("value") * 10).cast("long")
    slow = F.col("value") >= 20
    hourly = (
        events(spark, sf_dir)
        .withColumn("start", F.window("ts", "1 hour").start)
        .withColumn("ms", ms)
        .groupBy(F.col("event_type").alias("run"), "start")
        .agg(
            F.count("*").alias("reqs"),
            F.count_if(~down).alias("s200"),
            F.count_if(~down & (F.col("value") < 1)).alias("s400"),
            F.count_if(down & ~slow).alias("s5xx"),
            F.count_if(down & slow).alias("timeouts"),
            F.lit(0).cast("long").alias("neterr"),
            F.count_if(slow).alias("_slow"),
            *[
                F.expr(f"percentile_disc({p / 100}) WITHIN GROUP (ORDER BY ms)").cast("long").alias(f"p{p}")
                for p in (50, 95, 99)
            ],
        )
    )
    backlog = F.when((F.col("start") >= instant(OUTAGE_FROM)) & (F.col("start") < instant(CALM_FROM)), 100).otherwise(0)
    return hourly.select(
        "run",
        (F.col("start") + F.expr("INTERVAL '1' HOUR")).alias("end"),
        F.col("reqs").alias("sent"),
        "reqs",
        "s200",
        "s400",
        "s5xx",
        "timeouts",
        "neterr",
        (F.col("_slow") + backlog).alias("buffered"),
        "p50",
        "p95",
        "p99",
    )


def submissions(spark, sf_dir) -> DataFrame:
    """Every reading inside a JSON body, twenty per body; some errors carry a broken item, chosen by ``props``.

    A second submission per event uses its raw ``props`` as the body, which is no array; some are broken otherwise,
    empty, or too long, chosen by ``props``.
    """
    base = events(spark, sf_dir)
    number = F.col("user_id") + 1
    seconds = F.when(number <= F.floor(n_devices(spark, sf_dir).scalar() / 2), 15).otherwise(60)
    k = F.when(F.col("event_type") == "error", F.get_json_object("props", "$.k").cast("int"))
    start = floor_to("ts", seconds)
    text = F.date_format(start, "yyyy-MM-dd'T'HH:mm:ss'Z'")
    quoted = lambda c: F.concat(F.lit('"'), c, F.lit('"'))
    item = F.concat(
        F.lit('{"deviceId":'),
        F.when(k == 21, F.lit("5")).when(k == 13, F.lit('"dev-99999x"')).otherwise(quoted(device_id(number))),
        F.lit(',"intervalStart":'),
        F.when(k == 15, quoted(F.concat(F.substring(text, 1, 19), F.lit("+02:00"))))
        .when(k == 16, quoted(F.concat(F.substring(text, 1, 19), F.lit(".500Z"))))
        .when(k == 17, quoted(F.concat(F.lit("2025"), F.substring(text, 5, 16))))
        .when(k == 22, F.lit('"2024-02-30T00:00:00Z"'))
        .otherwise(quoted(text)),
        F.lit(',"intervalSeconds":'),
        F.when(k == 14, F.lit('"15"')).when(k == 12, F.lit("30")).otherwise(F.concat(seconds.cast("string"), F.lit(".0"))),
        F.lit(',"vehicles":'),
        F.when(k == 18, F.lit("-1"))
        .when(k == 19, F.lit('"7"'))
        .when(k == 11, F.lit("1.5"))
        .when(k == 10, F.lit("2147483648"))
        .otherwise(F.floor("value").cast("string")),
        F.lit("}"),
    )
    item = F.when(k == 20, F.lit("42")).otherwise(item)
    # Twenty consecutive events per body: a group is never larger than that.
    bodies = (
        base.select(F.expr("event_id div 20").alias("batch"), "event_id", "ts", item.alias("item"))
        .groupBy("batch")
        .agg(F.sort_array(F.collect_list(F.struct("event_id", "item"))).alias("items"), F.max("ts").alias("received_at"))
        .select(
            (F.col("batch") * 2).alias("batch_id"),
            "received_at",
            F.concat(F.lit("["), F.array_join(F.transform("items", lambda i: i["item"]), ","), F.lit("]")).alias("body"),
        )
    )
    any_k = F.get_json_object("props", "$.k").cast("int")
    body = (
        F.when(any_k == MORE_MEMBERS, F.lit('[{}],"x":1'))
        .when(any_k == OTHER_DOCUMENT, F.lit('5,"doc":[{}]'))
        .when(any_k == MORE_TEXT, F.lit("[{}] x"))
        .when(any_k == TWO_VALUES, F.lit("[{}],[{}]"))
        .when(any_k == EMPTY, F.lit("[]"))
        .when(any_k == TOO_LONG, F.concat(F.lit("["), F.repeat(F.lit("{},"), MAX_BATCH), F.lit("{}]")))
        .otherwise(F.col("props"))
    )
    foreign = base.select((F.col("event_id") * 2 + 1).alias("batch_id"), F.col("ts").alias("received_at"), body.alias("body"))
    return bodies.unionByName(foreign)
