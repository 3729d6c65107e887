import zlib
from collections import Counter, defaultdict
from fractions import Fraction

import numpy as np
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from kerbside.llm import packing

from .corpus import corpus, table

TOKENIZER = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
TOKENIZER.encode_special_tokens = True


def ids(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 1]


def served(rows, shares, window, packet):
    """Deficit round-robin, one queue and one packet after the other: ``(row, start, size)`` in the order of the stream."""
    queues = defaultdict(list)
    for row, queue, place, n in sorted(rows, key=lambda r: (r[2] % 2**64, r[0])):
        queues[queue] += [(row, a, min(packet, n - a)) for a in range(0, n, packet)]
    deficit, out = Counter(), []
    while any(queues.values()):
        for queue in sorted(queues):
            deficit[queue] += shares[queue] * window
            while queues[queue] and queues[queue][0][2] <= deficit[queue]:
                deficit[queue] -= queues[queue][0][2]
                out.append(queues[queue].pop(0))
    return out


@pytest.mark.parametrize("targets", [None, {"a": 3, "b": 1, None: 2}])
def test_stream_is_deficit_round_robin(spark, targets):
    docs = table(spark, corpus(8, 150)).repartition(3)
    tokens = packing.tokenized(docs)
    rows = [tuple(r) for r in tokens.select("key", "queue", "place", "n").collect()]
    weight = Counter()
    for _, queue, _, n in rows:
        if targets is None:
            weight[queue] += n
        else:
            weight[queue] = targets.get(None if queue == "-" else queue[1:], 1)
    shares = {q: Fraction(w, sum(weight.values())) for q, w in weight.items()}
    order = served(rows, shares, 128, 16)
    want, pos = {}, 0
    for row, start, size in order:
        want[row, start] = pos
        pos += size
    got = packing.streamed(packing.queued(tokens, targets), 128, 16).collect()
    assert {(g.key, g.start): g.pos for g in got} == want


def test_pieces_are_the_tokens_in_full_sequences(spark):
    rows = corpus(9, 200) + [(5000, "Lang é " * 60_000, "en", "a"), (5001, None, "en", "z"), (5002, "", None, None)]
    rows += [(6000, "same text here", "en", "b")] * 40
    got = packing.piece_table(table(spark, rows).repartition(4)).collect()
    want = Counter()
    for doc_id, text, *_ in rows:
        want[doc_id, len(ids(text)), zlib.crc32(np.array(ids(text), "<u4").tobytes())] += 1
    docs = table(spark, rows).repartition(5)
    more = docs.selectExpr("*", "'x' as key", "1 as n", "2 as start", "'q' as queue", "3 as place")
    out = packing.pack(more).collect()
    assert Counter((g.doc_id, g.start, g.length, g.sequence_id, g.offset) for g in got) == Counter(
        (o.doc_id, o.start, o.length, o.sequence_id, o.offset) for o in out
    )  # reruns agree, whatever other columns there are
    assert Counter(g.ids_crc32 for g in got) == Counter(zlib.crc32(o.ids) for o in out)
    # Sequences have no gaps and only the last one is short.
    filled = defaultdict(list)
    for o in out:
        assert len(o.ids) == 4 * o.length > 0
        filled[o.sequence_id].append((o.offset, o.length))
    total = sum(n * k for (_, n, _), k in want.items())
    assert sorted(filled) == list(range(-(-total // 2048)))
    for sequence, parts in filled.items():
        parts.sort()
        ends = np.cumsum([n for _, n in parts])
        assert [a for a, _ in parts] == [0, *ends[:-1].tolist()]
        assert ends[-1] == min(2048, total - sequence * 2048)
    # Every document comes back whole, as often as it is there.
    parts, back = defaultdict(list), Counter()
    for o in out:
        parts[o.doc_id, o.doc_tokens].append((o.start, o.sequence_id, o.offset, bytes(o.ids)))
    for (doc_id, n), found in parts.items():
        copies = defaultdict(list)
        for start, _, _, blob in sorted(found):
            copies[start].append(blob)
        again = len(copies[0])
        if again == 1:
            whole = b"".join(blob for start in sorted(copies) for blob in copies[start])
            assert len(whole) == 4 * n
            back[doc_id, n, zlib.crc32(whole)] += 1
        else:  # repeated rows: all their pieces together are that many times the text
            assert sum(len(b) for blobs in copies.values() for b in blobs) == 4 * n * again
            back[doc_id, n, next(c for d, m, c in want if (d, m) == (doc_id, n))] += again
    assert back == want


def test_sequences_hold_the_shares_of_the_sources(spark):
    rows = [(i, "some words to pack " * (20 + i % 50), "en", "a" if i % 4 else "b") for i in range(400)]
    rows += [(1000 + i, "hot " * 100, "en", "hot") for i in range(600)]
    out = packing.pack(table(spark, rows))
    per = out.join(table(spark, rows).select("doc_id", "source"), "doc_id").groupBy("sequence_id", "source").agg(F.sum("length").alias("n"))
    total, seen = Counter(), defaultdict(Counter)
    for r in per.collect():
        total[r.source] += r.n
        seen[r.sequence_id][r.source] += r.n
    everything = sum(total.values())
    for sequence in sorted(seen)[:-1]:
        for source, n in total.items():
            assert abs(seen[sequence][source] - 2048 * n / everything) <= 2 * len(total) * packing.PACKET


def test_encoders_agree_on_every_kind_of_character():
    fast, slow = packing.encoder(packing.VOCABULARY), packing.encoder("byte_bpe_50k.json")
    texts = [f"a{c}a 1{c}1 !{c}! {c}  {c}{c}a" for c in map(chr, [*range(0x3000), 0xFFFD, 0x1F600, 0x1D7D8, 0x20000, 0x10FFFF])]
    texts += ["<|endoftext|> x", "", " \n\t ", "x" * 5000]
    for text in texts:
        assert fast(text).tolist() == slow(text).tolist() == ids(text)[:-1]


def test_an_empty_table_gives_no_piece(spark):
    assert packing.piece_table(table(spark, [])).collect() == []
