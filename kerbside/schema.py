"""Fixed schemas and limits of the sensor-readings data model."""

from pyspark.sql import types as T

# Fixed values of the data model.
MAX_BATCH = 500
CLOCK_SKEW_SECONDS = 5
MAX_INT = 2147483647
INTERVAL_SECONDS = (15, 60)
TOPIC_PARTITIONS = 6

DEVICES = T.StructType(
    [
        T.StructField("device_id", T.StringType(), False),
        T.StructField("name", T.StringType()),
        T.StructField("interval_seconds", T.IntegerType(), False),
    ]
)

# The key is (device_id, interval_start); event_date and batch_id are the partition columns.
READINGS = T.StructType(
    [
        T.StructField("device_id", T.StringType()),
        T.StructField("interval_start", T.TimestampType()),
        T.StructField("vehicles", T.IntegerType()),
        T.StructField("stored_at", T.TimestampType()),
        T.StructField("event_date", T.DateType()),
        T.StructField("batch_id", T.LongType()),
    ]
)

TOPIC = T.StructType(
    [
        T.StructField("key", T.StringType()),
        T.StructField("value", T.StringType()),
        T.StructField("partition", T.IntegerType()),
        T.StructField("offset", T.LongType()),
    ]
)

WINDOW_COUNTERS = ("sent", "reqs", "s200", "s400", "s5xx", "timeouts", "neterr", "buffered", "p50", "p95", "p99")

# One JSON object per finished reporting window of one source.
SNAPSHOT = T.StructType(
    [
        T.StructField("source", T.StringType()),
        T.StructField("writtenAt", T.StringType()),
        T.StructField("windowSeconds", T.DoubleType()),
        T.StructField("deviceCount", T.LongType()),
        T.StructField("buffered", T.LongType()),
        T.StructField("requests", T.LongType()),
        T.StructField("readingsSent", T.LongType()),
        T.StructField("queued", T.LongType()),
        T.StructField("status200", T.LongType()),
        T.StructField("status400", T.LongType()),
        T.StructField("status5xx", T.LongType()),
        T.StructField("timeouts", T.LongType()),
        T.StructField("networkErrors", T.LongType()),
        T.StructField("p50", T.LongType()),
        T.StructField("p95", T.LongType()),
        T.StructField("p99", T.LongType()),
    ]
)

# Columns of the monitor-sample CSV, in file order. An empty cell means "could not be measured".
SAMPLE_COLUMNS = (
    "timestamp",
    "elapsed_min",
    "rows_approx",
    "total_mib",
    "table_mib",
    "index_mib",
    "city_1h_ms",
    "city_6h_ms",
    "sim_devices",
    "sim_age_s",
    "sent_per_s",
    "p50_ms",
    "p95_ms",
    "p99_ms",
    "status400",
    "status5xx",
    "timeouts",
    "neterr",
    "buffered",
    "pg_cpu_pct",
    "pg_mem_mib",
    "pg_mem_pct",
)
SAMPLE_TEXT = T.StructType([T.StructField(name, T.StringType()) for name in SAMPLE_COLUMNS])

HOST_STATS_TEXT = T.StructType(
    [
        T.StructField("time_utc", T.StringType()),
        T.StructField("api_cpu_pct", T.StringType()),
        T.StructField("pg_cpu", T.StringType()),
        T.StructField("pg_mem", T.StringType()),
        T.StructField("pg_waits", T.StringType()),
    ]
)
