"""Z-fast trie over conversations: which turns conversations start with in common.

A conversation is a string whose symbols are its turns (role, text). The trie is compacted: a node stands for the
prefixes from below its parent's extent down to its own extent, where conversations end or part. Each node is hashed
under its handle, the prefix whose length is the 2-fattest number in that range (the one with the most factors of two).
Fat binary search finds the exit node of a string of n turns by at most log2(n) + 1 probes of that hash table; one more
comparison along a single edge gives the place at which the string leaves the trie.

Strings are inserted in batches, of which the first is small: what later batches share with the trie is found by the
search and never grouped again. Only prefixes beyond the exits are grouped into new nodes; exits inside an edge split it.
Sums over subtrees are made by pointer doubling, in log2(height) joins. Edges are expanded into one row per prefix at
the end.

Prefixes are compared by 128 bits: the xor of a hash for each (depth, role, text). The rows that move are as narrow as
that; copies of a conversation are folded before anything is searched, and no task holds a long conversation, an edge
or the members of a node as a whole.
"""

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import saved
from .common import groups

#: Turns of one conversation that are ordered or summed in one piece, and ids that are joined into one text.
CHUNK_BITS = 12
#: Conversations that lend their first turns: every fifth; and the most turns that can be lent.
LENDER, MOST = 5, 8
#: Shares of the strings in the batches.
BATCHES = (1, 7)
#: Most turns with which all prefix hashes of a string travel in its row; longer ones are looked up by depth.
SHORT = 4096
NODE = ["e", "x1", "x2", "rep", "top", "t1", "t2"]
NOWHERE = -(2**62)


def _chunk(value: Column) -> Column:
    return F.coalesce(F.shiftright(value, CHUNK_BITS), F.lit(NOWHERE)).alias("chunk")


def ordered(conversations: DataFrame) -> DataFrame:
    """``(conv_id, rank, h1, h2, bytes)`` per turn; ranks count from 1 in the order of ``turn``, null first.

    Turns of the same number are ordered by role, then by the first characters and a hash of the text, so that reruns
    agree. Null roles and texts are empty. Rows without a conv_id belong to no conversation.
    """
    role, text = F.coalesce("role", F.lit("")), F.coalesce("text", F.lit(""))
    rows = conversations.filter("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        _chunk(F.col("turn").cast("long")),
        role.alias("role"),
        F.substring(text, 1, 64).alias("head"),
        F.xxhash64(role, text).alias("h1"),
        F.xxhash64(F.lit(1), text, role).alias("h2"),
        F.octet_length(text).cast("long").alias("bytes"),
    )
    held = rows.groupBy("conv_id", "chunk").agg(F.count("*").alias("held"))
    before = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    held = held.select("conv_id", "chunk", F.coalesce(F.sum("held").over(before), F.lit(0)).alias("base"))
    inside = Window.partitionBy("conv_id", "chunk").orderBy(F.asc_nulls_first("turn"), "role", "head", "h1", "h2")
    rows = rows.withColumn("nth", F.row_number().over(inside)).join(held, ["conv_id", "chunk"])
    return rows.select("conv_id", (F.col("base") + F.col("nth")).alias("rank"), "h1", "h2", "bytes")


def rebuilt(turns: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Conversations that start with turns of another one: ``(conv_id, n)``, and ``(conv_id, d, h1, h2, bytes)`` per turn.

    Conversation c takes the first h turns of conversation c - c % 5, then its own after its first h; h is the crc32 of
    its number modulo 9. A missing lender lends nothing.
    """
    own = turns.groupBy("conv_id").agg(F.max("rank").alias("own"))
    h = F.crc32(F.col("conv_id").cast("string")) % (MOST + 1)
    convs = own.select("conv_id", "own", h.alias("h"), (F.col("conv_id") - F.col("conv_id") % LENDER).alias("lender"))
    lent = own.select(F.col("conv_id").alias("lender"), F.col("own").alias("has"))
    convs = convs.join(lent, "lender", "left").withColumn("taken", F.least("h", F.coalesce("has", F.lit(0))))
    length = F.col("taken") + F.greatest(F.col("own") - F.col("h"), F.lit(0))
    convs = saved(convs.select("conv_id", "lender", "h", "taken", length.alias("n")), "conversations")
    first = turns.filter(F.col("rank") <= MOST).withColumnRenamed("conv_id", "lender")
    first = convs.filter("taken > 0").join(first, "lender").filter("rank <= taken")
    rest = turns.join(convs, "conv_id").filter("rank > h").withColumn("rank", F.col("rank") - F.col("h") + F.col("taken"))
    cols = ["conv_id", F.col("rank").alias("d"), "h1", "h2", "bytes"]
    return convs.select("conv_id", "n"), first.select(cols).unionByName(rest.select(cols))


def prefixes(turns: DataFrame) -> DataFrame:
    """``(conv_id, d, p1, p2, q1, q2, bytes, upto)``: hash of the first d turns and of one turn less; bytes of turn d and up to it."""
    rows = turns.select(
        "conv_id",
        "d",
        _chunk(F.col("d")),
        F.xxhash64("h1", "h2", "d").alias("s1"),
        F.xxhash64("d", "h2", "h1").alias("s2"),
        "bytes",
    )
    held = rows.groupBy("conv_id", "chunk").agg(F.bit_xor("s1").alias("c1"), F.bit_xor("s2").alias("c2"), F.sum("bytes").alias("c3"))
    before = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    held = held.select(
        "conv_id",
        "chunk",
        F.coalesce(F.bit_xor("c1").over(before), F.lit(0)).alias("c1"),
        F.coalesce(F.bit_xor("c2").over(before), F.lit(0)).alias("c2"),
        F.coalesce(F.sum("c3").over(before), F.lit(0)).alias("c3"),
    )
    upto = Window.partitionBy("conv_id", "chunk").orderBy("d").rowsBetween(Window.unboundedPreceding, 0)
    rows = rows.withColumns({"l1": F.bit_xor("s1").over(upto), "l2": F.bit_xor("s2").over(upto), "l3": F.sum("bytes").over(upto)})
    rows = rows.join(held, ["conv_id", "chunk"])
    p1, p2 = F.col("l1").bitwiseXOR(F.col("c1")), F.col("l2").bitwiseXOR(F.col("c2"))
    return rows.select(
        "conv_id",
        "d",
        p1.alias("p1"),
        p2.alias("p2"),
        p1.bitwiseXOR(F.col("s1")).alias("q1"),
        p2.bitwiseXOR(F.col("s2")).alias("q2"),
        "bytes",
        (F.col("l3") + F.col("c3")).alias("upto"),
    )


def fattest(low: Column, high: Column) -> Column:
    """The number in (low, high] with the most factors of two."""
    k = F.length(F.bin(low.bitwiseXOR(high))) - 1
    return F.call_function("shiftleft", F.call_function("shiftright", high, k), k)


def _at(rows: DataFrame, paths: DataFrame, rep: str, depth: str, **wanted: str) -> DataFrame:
    """Adds columns of ``paths`` for conversation ``rep`` at ``depth``; null where it is not that long, or depth is 0."""
    found = paths.select(F.col("rep").alias("_rep"), F.col("d").alias("_d"), *[F.col(c).alias(as_) for as_, c in wanted.items()])
    return rows.join(found, (F.col(rep) == F.col("_rep")) & (F.col(depth) == F.col("_d")), "left").drop("_rep", "_d")


def _in(way: str, depth: Column, name: str) -> Column:
    """A field of a way at a depth; null at 0 and beyond its end."""
    return F.when(depth > 0, F.try_element_at(F.col(way), depth.cast("int"))[name])


def _own(rows: DataFrame, paths: DataFrame, depth: str, **wanted: str) -> DataFrame:
    """As ``_at`` for the string of the row itself, which may have its way with it."""
    if "way" in rows.columns:
        return rows.withColumns({as_: _in("way", F.col(depth), c) for as_, c in wanted.items()})
    return _at(rows, paths, "rep", depth, **wanted)


def ways(paths: DataFrame) -> DataFrame:
    """``(rep, way)``: hashes and bytes of all prefixes of a string, shortest first."""
    steps = paths.groupBy("rep").agg(F.sort_array(F.collect_list(F.struct("d", "p1", "p2", "bytes", "upto"))).alias("way"))
    return steps.select("rep", "way")


def _of_rep(nodes: DataFrame, paths: DataFrame, lookups: list[tuple[str, dict[str, str]]], short: bool) -> DataFrame:
    """Adds columns of a node's conversation at several depths ``(depth, {name: column})``."""
    if short:
        nodes = nodes.join(paths, "rep", "left")
        return nodes.withColumns({a: _in("way", F.col(depth), c) for depth, wanted in lookups for a, c in wanted.items()}).drop("way")
    for depth, wanted in lookups:
        nodes = _at(nodes, paths, "rep", depth, **wanted)
    return nodes


def locate(strings: DataFrame, handles: DataFrame, paths: DataFrame) -> DataFrame:
    """Fat binary search: adds the last node on each string's way whose handle the string has, as ``g_*``.

    ``strings`` has ``rep`` (a conversation in ``paths``) and ``n`` (its length), ``handles`` are ``(f, k1, k2, y_*)``.
    """
    root = {"g_e": 0, "g_x1": 0, "g_x2": 0, "g_rep": None, "g_top": -1, "g_t1": 0, "g_t2": 0}
    now = strings.withColumns({c: F.lit(v).cast("long") for c, v in root.items()})
    now = now.withColumns({"low": F.lit(0).cast("long"), "high": F.col("n")})
    for _ in range(int(strings.agg(F.max("n")).first()[0] or 0).bit_length()):
        probe = now.withColumn("f", F.when(F.col("low") < F.col("high"), fattest(F.col("low"), F.col("high"))))
        probe = _own(probe, paths, "f", k1="p1", k2="p2").join(handles, ["f", "k1", "k2"], "left")
        hit, tried = F.col("y_e").isNotNull(), F.col("f").isNotNull()
        step = {f"g_{c}": F.when(hit, F.col(f"y_{c}")).otherwise(F.col(f"g_{c}")) for c in NODE}
        step["low"] = F.when(hit, F.col("y_e")).otherwise(F.col("low"))
        step["high"] = F.when(tried & ~hit, F.col("f") - 1).otherwise(F.col("high"))
        now = saved(probe.select(*strings.columns, *[v.alias(c) for c, v in step.items()]), "search")
    return now.drop("low", "high")


def exits(strings: DataFrame, nodes: DataFrame, paths: DataFrame) -> DataFrame:
    """``(*strings, m, m1, m2, g_*)``: how many turns of each string the trie has, and the node whose edge it leaves there.

    ``g_e`` is null where the string leaves at the extent of a node.
    """
    short = "way" in strings.columns
    inner = nodes.filter("e > 0").withColumns({"f": fattest(F.col("top"), F.col("e")), "below": F.col("top") + 1})
    inner = _of_rep(inner, paths, [("f", {"k1": "p1", "k2": "p2"}), ("below", {"b1": "p1", "b2": "p2"})], short)
    inner = saved(inner, "handles")
    handles = inner.select("f", "k1", "k2", *[F.col(c).alias(f"y_{c}") for c in NODE])
    found = _own(locate(strings, handles, paths), paths, "g_e", a1="p1", a2="p2")
    passed = (F.col("g_e") == 0) | (F.col("a1").eqNullSafe(F.col("g_x1")) & F.col("a2").eqNullSafe(F.col("g_x2")))
    found = found.withColumns({"passed": passed, "below": F.col("g_e") + 1}).drop("a1", "a2")
    # Behind an extent that the string has, the edge of the child with the string's next turn.
    named = inner.select("below", "b1", "b2", *[F.col(c).alias(f"z_{c}") for c in NODE])
    found = _own(found, paths, "below", b1="p1", b2="p2").join(named, ["below", "b1", "b2"], "left")
    edge = {f"g_{c}": F.when(F.col("passed"), F.col(f"z_{c}")).otherwise(F.col(f"g_{c}")) for c in NODE}
    m = F.when(F.col("passed"), F.col("g_e")).otherwise(F.col("g_top"))
    found = saved(found.select(*strings.columns, m.alias("m"), *[v.alias(c) for c, v in edge.items()]), "edges")
    # Turns along that one edge, compared with a conversation that has it.
    if short:
        other = paths.withColumnsRenamed({"rep": "g_rep", "way": "other"})
        depths = F.when(F.col("g_top") < F.least("n", "g_e"), F.sequence(F.col("g_top") + 1, F.least("n", "g_e")))
        same = F.filter(depths, lambda d: (_in("way", d, "p1") == _in("other", d, "p1")) & (_in("way", d, "p2") == _in("other", d, "p2")))
        out = found.join(other, "g_rep", "left").withColumn("m", F.greatest("m", F.array_max(same))).drop("other")
    else:
        inside = (F.col("d") > F.col("g_top")) & (F.col("d") <= F.least("n", "g_e"))
        along = found.filter("g_e is not null").join(paths.select("rep", "d", "p1", "p2"), "rep").filter(inside)
        along = _at(along.select("rep", "d", "p1", "p2", "g_rep"), paths, "g_rep", "d", o1="p1", o2="p2")
        far = along.filter("p1 = o1 and p2 = o2").groupBy("rep").agg(F.max("d").alias("far"))
        out = found.join(far, "rep", "left").withColumn("m", F.greatest("m", "far")).drop("far")
    out = _own(out, paths, "m", m1="p1", m2="p2")
    return out.withColumns({"m1": F.coalesce("m1", F.lit(0)), "m2": F.coalesce("m2", F.lit(0))})


def insert(strings: DataFrame, nodes: DataFrame, paths: DataFrame, empty: bool = False) -> DataFrame:
    """The nodes of the trie after a batch of distinct strings; ``empty`` if there was only the root.

    Strings are ``(n, e1, e2, rep)`` with ``paths (rep, d, p1, p2, q1, q2)``, or have their ``way`` as well with ``paths
    (rep, way)``.
    """
    if empty:
        none = {f"g_{c}": F.lit(None).cast("long") for c in NODE}
        out = strings.withColumns({c: F.lit(0).cast("long") for c in ("m", "m1", "m2")} | none)
    else:
        out = saved(exits(strings, nodes, paths), "exits")
    # Edges that strings leave in between are split there.
    cuts = out.filter("m < g_e").groupBy("m", "m1", "m2").agg(*[F.min(f"g_{c}").alias(c) for c in NODE])
    cuts = cuts.select(*NODE, F.col("m").alias("at"), F.col("m1").alias("a1"), F.col("m2").alias("a2"))
    old = nodes.select(*NODE, F.col("e").alias("at"), F.col("x1").alias("a1"), F.col("x2").alias("a2"))
    order = Window.partitionBy("e", "x1", "x2").orderBy("at")
    old = old.unionByName(cuts).select(
        F.col("at").alias("e"),
        F.col("a1").alias("x1"),
        F.col("a2").alias("x2"),
        "rep",
        F.coalesce(F.lag("at").over(order), "top").alias("top"),
        F.coalesce(F.lag("a1").over(order), "t1").alias("t1"),
        F.coalesce(F.lag("a2").over(order), "t2").alias("t2"),
    )
    # Prefixes beyond the exits are new; those that end a string or continue in two ways are new nodes.
    if "way" in out.columns:
        step = F.explode(F.filter("way", lambda w: w["d"] > F.col("m"))).alias("step")
        new = out.select("rep", "n", "m", "m1", "m2", "way", step).select("*", "step.d", "step.p1", "step.p2")
        upper = F.col("d") - 1
        new = new.withColumns({q: F.coalesce(_in("way", upper, p), F.lit(0)) for q, p in (("q1", "p1"), ("q2", "p2"))})
    else:
        new = paths.join(out.select("rep", "n", "m", "m1", "m2"), "rep").filter("d > m")
    new = saved(new.select("rep", "d", "p1", "p2", "q1", "q2", "n", "m", "m1", "m2"), "new")
    kids = new.filter("d > m + 1").select((F.col("d") - 1).alias("d"), F.col("q1").alias("p1"), F.col("q2").alias("p2"), F.col("p1").alias("c1"), F.col("p2").alias("c2"))
    forks = kids.distinct().groupBy("d", "p1", "p2").count().filter("count > 1").drop("count")
    ends = new.filter("d = n").select("d", "p1", "p2")
    stops = forks.unionByName(ends).distinct()
    way = Window.partitionBy("rep").orderBy("d")
    rows = new.join(stops, ["d", "p1", "p2"]).select(
        F.col("d").alias("e"),
        F.col("p1").alias("x1"),
        F.col("p2").alias("x2"),
        "rep",
        F.coalesce(F.lag("d").over(way), "m").alias("top"),
        F.coalesce(F.lag("p1").over(way), "m1").alias("t1"),
        F.coalesce(F.lag("p2").over(way), "m2").alias("t2"),
    )
    # All strings through a new node have the same way above it.
    rows = rows.groupBy("e", "x1", "x2").agg(*[F.min(c).alias(c) for c in ("rep", "top", "t1", "t2")])
    return saved(old.unionByName(rows), "nodes")


def build(strings: DataFrame, paths: DataFrame, shares: tuple[int, ...] = BATCHES) -> DataFrame:
    """The compacted trie of distinct strings, inserted batch by batch (see ``insert``).

    Nodes are ``(e, x1, x2)`` (depth and hash of the extent), ``rep`` (a conversation through the node) and ``(top, t1,
    t2)``, the extent of the parent; -1 above the root.
    """
    root = dict.fromkeys(NODE, 0) | {"rep": None, "top": -1}
    nodes = strings.sparkSession.range(1).select(*[F.lit(root[c]).cast("long").alias(c) for c in NODE])
    part, start = F.pmod(F.xxhash64("e1", "e2"), F.lit(sum(shares))), 0
    for share in shares:
        batch = strings.filter((part >= start) & (part < start + share))
        nodes = insert(batch, nodes, paths, empty=start == 0)
        start += share
    return nodes


def subtree_sums(nodes: DataFrame, sums: list[str], lows: list[str]) -> DataFrame:
    """Sums and minima over all nodes below and including each node, by pointer doubling.

    After k rounds a row holds its descendants at less than 2^k steps, and points to its ancestor at 2^k steps.
    """
    key, up = ["e", "x1", "x2"], ["top", "t1", "t2"]
    rest = [c for c in nodes.columns if c not in (*up, *sums, *lows)]
    links = nodes.select(*key, *[F.col(c).alias(f"u_{c}") for c in up], *sums, *lows)
    while True:
        to = [f"u_{c}" for c in up]
        given = links.filter("u_top >= 0").groupBy(*to).agg(*[F.sum(c).alias(f"g_{c}") for c in sums], *[F.min(c).alias(f"g_{c}") for c in lows])
        given = given.withColumnsRenamed(dict(zip(to, key, strict=True)))
        ahead = links.select(*[F.col(a).alias(b) for a, b in zip(key, to, strict=True)], *[F.col(a).alias(f"n_{a}") for a in to])
        links = links.join(given, key, "left").join(ahead, to, "left").select(
            *key,
            F.coalesce("n_u_top", F.lit(-1)).alias("u_top"),
            *[F.col(f"n_{c}").alias(c) for c in to[1:]],
            *[(F.col(c) + F.coalesce(f"g_{c}", F.lit(0))).alias(c) for c in sums],
            *[F.least(c, f"g_{c}").alias(c) for c in lows],
        )
        links = saved(links, "links")
        if links.filter("u_top >= 0").isEmpty():
            break
    return nodes.select(*rest, *up).join(links.select(*key, *sums, *lows), key)


def joined_ids(ends: DataFrame) -> DataFrame:
    """``(n, e1, e2, ends_sha256)``: digest of the ascending, comma-joined conv_ids that end at a prefix.

    Ids are joined in pieces of 2^12 neighbouring numbers; a prefix with several pieces is hashed piece by piece.
    """
    key = ["n", "e1", "e2"]
    parts = ends.groupBy(*key, F.shiftright("conv_id", CHUNK_BITS).alias("chunk")).agg(F.sort_array(F.collect_list("conv_id")).alias("ids"))
    parts = parts.select(*key, "chunk", F.concat_ws(",", F.transform("ids", lambda c: c.cast("string"))).alias("ids"))
    parts = saved(parts, "ids")
    several = saved(parts.groupBy(*key).count().filter("count > 1").drop("count"), "several")
    single = parts.join(several, key, "left_anti").select(*key, F.sha2("ids", 256).alias("ends_sha256"))

    def hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, digest = None, None

        def row() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([dict(zip([*key, "ends_sha256"], [*at, digest.hexdigest()], strict=True))])

        for batch in batches:
            for *now, ids in zip(*[batch.column(c).to_pylist() for c in (*key, "ids")], strict=True):
                if now == at:
                    digest.update(b"," + ids.encode())
                    continue
                if at is not None:
                    yield row()
                at, digest = now, hashlib.sha256(ids.encode())
        if at is not None:
            yield row()

    many = parts.join(several, key).repartition(*key).sortWithinPartitions(*key, "chunk").select(*key, "ids")
    return single.unionByName(many.mapInArrow(hashed, "n long, e1 long, e2 long, ends_sha256 string"))


def expanded(nodes: DataFrame) -> DataFrame:
    """One row per depth of each edge, ``d``; long edges are cut so that no row holds one."""
    first = F.col("top") + 1
    pieces = F.explode(F.sequence(F.lit(0).cast("long"), F.shiftright(F.col("e") - first, CHUNK_BITS))).alias("piece")
    start = first + F.call_function("shiftleft", F.col("piece"), F.lit(CHUNK_BITS))
    depths = F.explode(F.sequence(start, F.least(F.col("e"), start + 2**CHUNK_BITS - 1)))
    return nodes.select("*", pieces).withColumn("d", depths).drop("piece")


def trie(conversations: DataFrame) -> DataFrame:
    """Every prefix of the rebuilt conversations: ``conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256``.

    Null turns come first, null roles and texts are empty, rows without a conv_id are in no conversation. Repeated rows
    are turns of their own. Texts of any length are hashed whole and do not move; conversations may have any number of
    turns. Further columns do not matter. An empty table has no node, not even the root.
    """
    turns = saved(ordered(conversations.select("conv_id", "turn", "role", "text")), "turns")
    convs, rows = rebuilt(turns)
    every = saved(prefixes(rows), "prefixes")
    zero = F.lit(0).cast("long")
    ends = _at(convs, every.withColumnRenamed("conv_id", "rep"), "conv_id", "n", e1="p1", e2="p2", size="upto")
    ends = saved(ends.select("conv_id", "n", *[F.coalesce(c, zero).alias(c) for c in ("e1", "e2", "size")]), "ends")
    # Copies are one string, which has their number.
    strings = ends.groupBy("n", "e1", "e2").agg(F.min("conv_id").alias("rep"), F.count("*").alias("n_ends"), F.max("size").alias("size"))
    strings = saved(strings, "strings")
    if strings.isEmpty():
        return strings.select(*[zero.alias(c) for c in RESULT], F.lit("").alias("ends_sha256"))
    paths = strings.select("rep").join(every.withColumnRenamed("conv_id", "rep"), "rep")
    short = strings.agg(F.max("n")).first()[0] <= SHORT
    paths = saved(ways(paths) if short else paths, "paths")
    inserted = strings.select("n", "e1", "e2", "rep")
    nodes = build(saved(inserted.join(paths, "rep", "left"), "strings") if short else inserted, paths)

    kids = nodes.filter("e > 0").groupBy(F.col("top").alias("e"), F.col("t1").alias("x1"), F.col("t2").alias("x2"))
    kids = kids.agg(F.count("*").alias("n_children"))
    here = strings.select(F.col("n").alias("e"), F.col("e1").alias("x1"), F.col("e2").alias("x2"), F.col("rep").alias("low"), "n_ends", "size")
    full = nodes.join(kids, ["e", "x1", "x2"], "left").join(here, ["e", "x1", "x2"], "left")
    full = _of_rep(full, paths, [("e", {"at_e": "upto"}), ("top", {"at_top": "upto"})], short)
    n_children, n_convs = F.coalesce("n_children", zero), F.coalesce("n_ends", zero)
    edge = F.coalesce("at_e", zero) - F.coalesce("at_top", zero)
    full = saved(
        full.select(
            *[c for c in NODE if c != "rep"],
            n_children.alias("n_children"),
            F.coalesce("at_e", zero).alias("at_e"),
            edge.alias("edge"),
            n_convs.alias("n_convs"),
            (n_children == 0).cast("long").alias("n_leaves"),
            # Bytes of all conversations that end here, and of the edge, once.
            (n_convs * F.coalesce("size", zero)).alias("sizes"),
            edge.alias("edges"),
            F.col("low").alias("conv_id"),
        ),
        "full",
    )
    full = saved(subtree_sums(full, ["n_convs", "n_leaves", "sizes", "edges"], ["conv_id"]), "sums")
    above = full.select(F.col("e").alias("top"), F.col("x1").alias("t1"), F.col("x2").alias("t2"), F.col("conv_id").alias("above"))
    digests = joined_ids(ends.select("conv_id", "n", "e1", "e2")).withColumnsRenamed({"n": "e", "e1": "x1", "e2": "x2"})
    full = full.join(above, ["top", "t1", "t2"], "left").join(digests, ["e", "x1", "x2"], "left")

    out = _of_rep(expanded(full.withColumn("rep", F.col("conv_id"))), paths, [("d", {"size": "bytes", "upto": "upto"})], short)
    last, before = F.col("d") == F.col("e"), F.coalesce("upto", zero) - F.coalesce("size", zero)
    # A member has its bytes beyond this depth once; the distinct turns below are paid for once.
    kept = F.col("sizes") - F.col("n_convs") * before - (F.col("edges") - F.col("edge") + F.col("at_e") - before)
    return out.select(
        "conv_id",
        F.col("d").alias("depth"),
        F.when(F.col("d") == F.col("top") + 1, F.col("above")).otherwise(F.col("conv_id")).alias("parent_conv_id"),
        "n_convs",
        F.when(last, F.col("n_children")).otherwise(1).cast("long").alias("n_children"),
        "n_leaves",
        kept.alias("saved_tokens"),
        F.when(last, F.col("ends_sha256")).otherwise(None).alias("ends_sha256"),
    ).fillna({"ends_sha256": hashlib.sha256(b"").hexdigest()})


RESULT = ["conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens"]
