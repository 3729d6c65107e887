"""Mixture-controlled packing of tokenized documents into sequences of one length.

Every source is a queue of documents, cut into packets of at most ``PACKET`` tokens. Deficit round-robin serves the
queues: a round stands for one sequence and gives each queue its share of the sequence's tokens; a queue sends packets
while its credit lasts, and what is left over (the deficit) stays for later rounds. The stream of packets is cut into
sequences of exactly ``WINDOW`` tokens, so only the last one is padded, and each sequence holds the target shares up to
one packet a source.

A queue's credit after r rounds is r times its share, so the packet that ends at token e of its queue leaves in round
ceil(e / share): no task has to replay the rounds before its own, and deficits pass from sequence to sequence and from
partition to partition as prefix sums. Both sums (tokens before a document in its queue, tokens before a packet in the
stream) have two levels with about the square root of the rows in each, so neither a hot source nor the stream as a whole
is ordered in one task.
"""

import base64
import functools
import math
from collections.abc import Callable, Iterator, Mapping

import numpy as np
import public_tokenizers
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import saved
from .common import sized, small_batches

WINDOW, PACKET, END = 2048, 256, 1
#: Ids in a batch that a task sends on.
OUT_IDS = 1 << 24
#: The ranks of the vocabulary byte_bpe_50k.json; both libraries give the same ids for it, this one sooner.
VOCABULARY = "byte_bpe_50k.tiktoken"


@functools.lru_cache(maxsize=4)
def encoder(vocabulary: str) -> Callable[[str], np.ndarray]:
    """Ids of a text by a public vocabulary, named as a file of ``public_tokenizers`` or by a path.

    Names of special tokens within a text are ordinary text.
    """
    path = vocabulary if "/" in vocabulary else public_tokenizers.path(vocabulary)
    if path.endswith(".json"):
        from tokenizers import Tokenizer

        tokenizer = Tokenizer.from_file(path)
        tokenizer.encode_special_tokens = True
        return lambda text: np.array(tokenizer.encode(text, add_special_tokens=False).ids, np.uint32)
    import tiktoken

    with open(path, "rb") as lines:
        ranks = {base64.b64decode(word): int(rank) for word, rank in map(bytes.split, lines)}
    own = tiktoken.Encoding(vocabulary, pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    return lambda text: own.encode_to_numpy(text, disallowed_special=())


def tokenized(docs: DataFrame, vocabulary: str = VOCABULARY, end: int = END) -> DataFrame:
    """``(key, doc_id, queue, place, n, ids)`` per row, in the shared folder.

    ``key`` is unique, ``queue`` names the source, ``place`` is a hash of id and text that orders the queue, ``ids`` are
    little-endian numbers of two bytes each, or of four if one is above 65,535 (``n`` tells which).
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = encoder(vocabulary)
        for batch in batches:
            lengths, blobs = [], []
            for text in batch.column(4):
                ids = np.append(encode(text.as_py() or ""), np.uint32(end))
                lengths.append(len(ids))
                blobs.append(ids.astype("<u2" if ids.max() < 65536 else "<u4").tobytes())
            columns = [*batch.columns[:4], pa.array(lengths, pa.int64()), pa.array(blobs, pa.binary())]
            yield pa.RecordBatch.from_arrays(columns, ["key", "doc_id", "queue", "place", "n", "ids"])

    small_batches(docs.sparkSession)
    queue = F.coalesce(F.concat(F.lit("="), F.col("source").cast("string")), F.lit("-")).alias("queue")
    place = F.xxhash64("doc_id", "text").alias("place")
    rows = docs.select(F.monotonically_increasing_id().alias("key"), "doc_id", queue, place, "text")
    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"key long, doc_id {kind}, queue string, place long, n long, ids binary"
    return saved(rows.mapInArrow(run, schema), "tokens")


def _weight(targets: Mapping[str | None, float] | None) -> Column:
    if targets is None:
        return F.col("total").cast("double")
    named = {"-" if source is None else f"={source}": float(w) for source, w in targets.items()}
    pairs = [F.lit(x) for item in named.items() for x in item]
    weights = F.create_map(*pairs) if pairs else F.lit(None).cast("map<string,double>")
    return F.coalesce(weights[F.col("queue")], F.lit(1.0))


def queued(tokens: DataFrame, targets: Mapping[str | None, float] | None) -> DataFrame:
    """``(key, queue, n, before, share)``: tokens before the document in its queue, and the queue's part of all credit."""
    rows = tokens.select("key", "queue", "place", "n")
    bits = max(1, math.isqrt(max(1, rows.count()))).bit_length()
    rows = rows.withColumn("block", F.shiftrightunsigned("place", 64 - bits))
    sums = rows.groupBy("queue", "block").agg(F.sum("n").alias("held"))
    earlier = Window.partitionBy("queue").orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = sums.select(
        "queue",
        "block",
        F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("base"),
        F.sum("held").over(Window.partitionBy("queue")).alias("total"),
    )
    sums = saved(sums, "queues")
    weights = sums.groupBy("queue").agg(F.first("total").alias("total")).withColumn("weight", _weight(targets))
    shares = weights.crossJoin(F.broadcast(weights.agg(F.sum("weight").alias("all"))))  # one row
    shares = saved(shares.select("queue", (F.col("weight") / F.col("all")).alias("share")), "shares")
    sums = sums.join(sized(shares), "queue")
    inside = Window.partitionBy("queue", "block").orderBy("place", "key").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("within", F.coalesce(F.sum("n").over(inside), F.lit(0)))
    rows = rows.join(sized(saved(sums, "blocks")), ["queue", "block"])
    return rows.select("key", "queue", "n", (F.col("base") + F.col("within")).alias("before"), "share")


def streamed(queues: DataFrame, window: int, packet: int) -> DataFrame:
    """``(key, start, pos)`` of every packet: its first token in the document, and in the stream."""
    starts = F.explode(F.sequence(F.lit(0).cast("long"), F.col("n") - 1, F.lit(packet).cast("long")))
    packets = queues.select("key", "queue", "n", "before", "share", starts.alias("start"))
    size = F.least(F.lit(packet), F.col("n") - F.col("start"))
    last = (F.col("before") + F.col("start") + size).alias("last")
    packets = packets.select("key", "queue", "start", size.cast("long").alias("size"), last, "share")
    turn = F.ceil(F.col("last") / (F.col("share") * window)).alias("turn")
    packets = saved(packets.select("key", "queue", "start", "size", "last", turn), "packets")
    rounds = packets.agg(F.max("turn")).first()[0] or 1
    packets = packets.withColumn("block", F.floor(F.col("turn") / (math.isqrt(rounds) + 1)))
    # One row for each of about the square root of all rounds.
    sums = packets.groupBy("block").agg(F.sum("size").alias("held"))
    earlier = Window.orderBy("block").rowsBetween(Window.unboundedPreceding, -1)
    sums = saved(sums.select("block", F.coalesce(F.sum("held").over(earlier), F.lit(0)).alias("base")), "rounds")
    inside = Window.partitionBy("block").orderBy("turn", "queue", "last").rowsBetween(Window.unboundedPreceding, -1)
    packets = packets.withColumn("within", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    placed = packets.join(sized(sums), "block")
    return placed.select("key", "start", (F.col("base") + F.col("within")).alias("pos"))


def pieces(doc: np.ndarray, starts: np.ndarray, pos: np.ndarray, n: np.ndarray, window: int) -> tuple[np.ndarray, ...]:
    """Document, first token, length and stream position of the pieces of some documents, in the order of their tokens.

    ``doc`` numbers the documents of ``n`` tokens each, ``starts`` and ``pos`` are their packets. Packets that follow each
    other in the stream become one piece; a piece ends where its sequence does.
    """

    def sizes() -> np.ndarray:
        last = np.append(doc[1:] != doc[:-1], True)
        return np.where(last, n[doc], np.append(starts[1:], 0)) - starts

    order = np.lexsort((starts, doc))
    doc, starts, pos = doc[order], starts[order], pos[order]
    size = sizes()
    begins = np.append(True, (doc[1:] != doc[:-1]) | (pos[1:] != pos[:-1] + size[:-1]))
    doc, starts, pos = doc[begins], starts[begins], pos[begins]
    size = sizes()
    first, parts = pos // window, (pos + size - 1) // window - pos // window + 1
    of = np.repeat(np.arange(len(starts)), parts)
    nth = np.arange(len(of)) - np.repeat(np.cumsum(parts) - parts, parts)
    at = np.maximum(pos[of], (first[of] + nth) * window)
    stop = np.minimum(pos[of] + size[of], (first[of] + nth + 1) * window)
    return doc[of], starts[of] + at - pos[of], stop - at, at


def wide_ids(blobs: pa.BinaryArray, n: np.ndarray) -> np.ndarray:
    """The ids of all documents of a batch, one after the other, as numbers of four bytes."""
    bounds = np.frombuffer(blobs.buffers()[1], "<i4")[blobs.offset : blobs.offset + len(blobs) + 1]
    data = memoryview(blobs.buffers()[2])
    if bounds[-1] - bounds[0] == 2 * n.sum():
        return np.frombuffer(data[bounds[0] : bounds[-1]], "<u2").astype("<u4")
    parts = zip(bounds[:-1].tolist(), bounds[1:].tolist(), n.tolist(), strict=True)
    return np.concatenate([np.frombuffer(data[a:b], "<u2" if b - a == 2 * k else "<u4").astype("<u4") for a, b, k in parts])


def pack(
    docs: DataFrame,
    targets: Mapping[str | None, float] | None = None,
    vocabulary: str = VOCABULARY,
    window: int = WINDOW,
    packet: int = PACKET,
    end: int = END,
) -> DataFrame:
    """Pieces ``doc_id, start, length, doc_tokens, sequence_id, offset, ids`` of packed documents.

    ``ids`` are little-endian numbers of four bytes. ``targets`` are weights of the sources (1 for those not named); a
    queue that ends early leaves its part to the others. Without them every source has the share of its own tokens, so
    that the mix is the same from the first sequence to the last. Null and empty texts have the end token only; null
    sources are a queue of their own. Repeated rows are packed each; the order of a queue follows a hash of id and text,
    so reruns agree. A text of any length is one row and goes over as many sequences as it takes. Further columns are
    not looked at. An empty table gives no piece.
    """
    tokens = tokenized(docs, vocabulary, end)
    packets = streamed(queued(tokens, targets), window, packet)
    # A list as long as its document has packets.
    places = packets.groupBy("key").agg(F.collect_list("start").alias("starts"), F.collect_list("pos").alias("pos"))

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, lists = batch.column(1).to_numpy(), batch.column(3)
            doc = np.repeat(np.arange(len(n)), np.diff(lists.offsets.to_numpy()))
            doc, starts, length, pos = pieces(doc, lists.flatten().to_numpy(), batch.column(4).flatten().to_numpy(), n, window)
            ids = wide_ids(batch.column(2), n)
            # In this order the pieces' ids are the documents' ids; a batch sent on has a bounded number of them.
            ends = np.cumsum(length)
            for part in np.split(np.arange(len(doc)), np.flatnonzero(np.diff(ends // OUT_IDS)) + 1):
                if not len(part):
                    continue
                base = ends[part[0]] - length[part[0]]
                bounds = np.append(0, ends[part] - base).astype("<i4") * 4
                data = pa.py_buffer(ids[base : ends[part[-1]]])
                of = pa.array(doc[part])
                columns = [
                    batch.column(0).take(of),
                    pa.array(starts[part]),
                    pa.array(length[part]),
                    batch.column(1).take(of),
                    pa.array(pos[part] // window),
                    pa.array(pos[part] % window),
                    pa.BinaryArray.from_buffers(pa.binary(), len(part), [None, pa.py_buffer(bounds), data]),
                ]
                yield pa.RecordBatch.from_arrays(columns, PIECE)

    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = tokens.select("key", "doc_id", "n", "ids").join(places, "key").select("doc_id", "n", "ids", "starts", "pos")
    return rows.mapInArrow(cut, f"doc_id {kind}, " + ", ".join(f"{c} long" for c in PIECE[1:-1]) + ", ids binary")


PIECE = ["doc_id", "start", "length", "doc_tokens", "sequence_id", "offset", "ids"]


def piece_table(docs: DataFrame) -> DataFrame:
    """Per piece: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``."""
    out = pack(docs)
    return out.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")
