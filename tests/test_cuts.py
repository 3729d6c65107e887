"""The topic of the cut runs is written in parallel, yet read in batches of exactly so many messages."""

from pyspark.sql import functions as F

from kerbside.plans.stream_queries import _write_cuts
from kerbside.sources import topic


def cuts(spark, folder, n, limit, file_messages):
    # Offsets far apart, in no order, and equal ones in two partitions.
    number = F.pmod(F.col("id") * 7919, F.lit(n)).cast("long")
    offset = F.floor(number / 2) * 1_000_003
    rows = spark.range(0, n, 1, 5).select(
        F.lit("a").alias("key"), number.cast("string").alias("value"), (number % 2).cast("int").alias("partition"), offset.alias("offset")
    )
    n_files = _write_cuts(rows, f"{folder}/topic", limit, file_messages)
    got = {}
    stream = topic.read_file_stream(spark, f"{folder}/topic", n_files).select(F.col("value").cast("long").alias("v"), F.input_file_name().alias("f"))

    def keep(batch, batch_id):
        got[batch_id] = [tuple(r) for r in batch.collect()]

    query = stream.writeStream.foreachBatch(keep).option("checkpointLocation", f"{folder}/cp").trigger(availableNow=True).start()
    query.awaitTermination()
    return n_files, [got[b] for b in sorted(got)]


def test_batches_are_cuts_in_order_of_offsets(spark, tmp_path):
    """1003 messages, 101 a batch, in files of at most 20."""
    n_files, batches = cuts(spark, str(tmp_path), 1003, 101, 20)
    assert n_files == 6
    assert [sorted(v for v, _ in b) for b in batches] == [list(range(low, min(low + 101, 1003))) for low in range(0, 1003, 101)]
    for batch in batches:
        files = [f for _, f in batch]
        assert len(set(files)) > 1 and max(files.count(f) for f in files) <= 20


def test_every_file_of_a_cut_has_messages(spark, tmp_path):
    """Four files a cut, whose numbers a hash puts into two of four partitions, not the first."""
    n_files, batches = cuts(spark, str(tmp_path), 400, 40, 10)
    assert n_files == 4 and [len(b) for b in batches] == [40] * 10


def test_no_task_orders_the_whole_topic(spark, tmp_path):
    """Half of the cuts of one file each: no file and no batch is larger than the limit."""
    n_files, batches = cuts(spark, str(tmp_path), 40, 8, 1000)
    assert n_files == 1 and [len(b) for b in batches] == [8] * 5
