"""Merkle manifest of a dataset over nested-interval labels.

Every row is a leaf; the leaves of a language stand in the order of their ids, and every ``FAN`` consecutive nodes are
hashed into the node above. The subroots of the languages are the leaves of one more tree. A node is labelled with its
tree, its level and the interval ``[lo, hi)`` of the leaf ranks it covers. Labels alone carry the tree: the node above
is the one whose interval contains it, found in the bucket ``lo`` div ``FAN ** level`` of the next level; the siblings
are what is left of the parent's interval without the node's own.

Ranks come from a range partitioning by (tree, id, digest): each task numbers what it holds, and one row per task and
tree carries the counts across. A tree, also one with most of the rows, is thus never sorted or held in one task. A node
holds at most ``FAN`` digests. Paths go down the levels, so a path is joined once for ``FAN`` nodes, not once a leaf.
"""

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import saved
from .common import lower_az, sized

FAN = 8
#: Rows that tell which documents are altered to see whether the manifest notices.
TAMPERED = 3
CHILD = "struct<lo: bigint, hi: bigint, digest: string>"
STEP = "struct<before: string, after: string>"


def field(value: Column) -> Column:
    """``-`` for null, else the number of UTF-8 bytes, a colon and the value."""
    text = value.cast("string")
    return F.coalesce(F.concat(F.octet_length(text), F.lit(":"), text), F.lit("-"))


def leaf(*values: Column) -> Column:
    return F.sha2(F.concat(*[field(v) for v in values]), 256)


def document_leaf(text: Column) -> Column:
    return leaf(F.col("doc_id"), F.col("source"), F.col("lang"), F.col("n_chars"), text)


def ranked(rows: DataFrame, tree: str, order: list[str], name: str) -> DataFrame:
    """Adds ``rank`` (from 0, in the given order) and ``n`` (leaves of the tree), per value of ``tree``.

    The numbers within a task are fixed as the result is written, so a lost executor cannot change them later.
    """
    at = F.monotonically_increasing_id()
    placed = rows.repartitionByRange(tree, *order).sortWithinPartitions(tree, *order)
    placed = saved(placed.withColumn("_at", at).withColumn("_part", F.shiftright("_at", 33)), name)
    held = placed.groupBy(tree, "_part").agg(F.count("*").alias("_held"), F.min("_at").alias("_first"))
    before = Window.partitionBy(tree).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    held = held.withColumns(
        {
            "_base": F.coalesce(F.sum("_held").over(before), F.lit(0)) - F.col("_first"),
            "n": F.sum("_held").over(Window.partitionBy(tree)),
        }
    )
    held = saved(held.drop("_held", "_first"), f"{name}-counts")
    out = placed.join(sized(held), [tree, "_part"])
    return out.withColumn("rank", F.col("_at") + F.col("_base")).drop("_at", "_part", "_base")


def levels(leaves: DataFrame, fan: int = FAN) -> list[DataFrame]:
    """The nodes above the leaves ``(tree, n, lo, hi, digest)``, level by level, with their children as labelled digests.

    A tree ends with the level at which a single node remains.
    """
    out, width = [], 1
    most = leaves.agg(F.max("n")).first()[0] or 0
    nodes = leaves
    while width < most:
        width *= fan
        child = F.struct("lo", "hi", "digest")
        grown = (
            nodes.filter(F.col("n") > width // fan)
            .groupBy("tree", "n", F.floor(F.col("lo") / width).alias("bucket"))
            .agg(F.min("lo").alias("lo"), F.max("hi").alias("hi"), F.sort_array(F.collect_list(child)).alias("kids"))
        )
        digest = F.sha2(F.concat_ws("", F.transform("kids", lambda k: k["digest"])), 256)
        nodes = saved(grown.select("tree", "n", "lo", "hi", digest.alias("digest"), "kids"), "nodes")
        out.append(nodes)
    return out


def _step(kids: Column, lo: Column, hi: Column) -> Column:
    """Digests of the parent's children before and after an interval."""
    before = F.filter(kids, lambda k: k["hi"] <= lo)
    after = F.filter(kids, lambda k: k["lo"] >= hi)
    return F.struct(*[F.concat_ws("", F.transform(part, lambda k: k["digest"])).alias(name) for part, name in ((before, "before"), (after, "after"))])


def with_paths(leaves: DataFrame, above: list[DataFrame], roots: DataFrame, fan: int = FAN) -> DataFrame:
    """Adds ``path``: for each step from the leaf to the top, the siblings' digests before and after the node.

    ``roots`` is ``(tree, top)``, where ``top`` is the path from the tree's own root upwards.
    """
    parents = None
    for level in range(len(above), -1, -1):
        nodes, width = (above[level - 1] if level else leaves), fan**level
        alone = nodes.filter(F.col("n") <= width).join(sized(roots), "tree").withColumnRenamed("top", "path")
        if parents is not None:
            label = F.floor(F.col("lo") / (width * fan)).alias("bucket")
            up = parents.select(
                "tree", label, F.col("lo").alias("p_lo"), F.col("hi").alias("p_hi"), F.col("kids").alias("p_kids"), F.col("path").alias("p_path")
            )
            inside = (F.col("p_lo") <= F.col("lo")) & (F.col("hi") <= F.col("p_hi"))
            joined = nodes.filter(F.col("n") > width).withColumn("bucket", label).join(up, ["tree", "bucket"]).filter(inside)
            step = _step(F.col("p_kids"), F.col("lo"), F.col("hi"))
            path = F.concat(F.array(step), "p_path").alias("path")
            alone = alone.unionByName(joined.select(*nodes.columns, path))
        parents = alone if level == 0 else saved(alone, "paths")
    return parents


def folded(digest: Column, path: Column) -> Column:
    """The top that follows from a leaf's digest and its path."""
    return F.aggregate(path, digest, lambda acc, s: F.sha2(F.concat(s["before"], acc, s["after"]), 256))


def proof(path: Column) -> Column:
    """One digest of all siblings on a path."""
    return F.sha2(F.concat_ws("", F.transform(path, lambda s: F.concat(s["before"], s["after"]))), 256)


def manifest(leaves: DataFrame, key: str, order: list[str], fan: int = FAN) -> DataFrame:
    """Adds ``subroot, root, path`` to leaves with a ``digest``, in one tree per value of ``key`` ordered by ``order``.

    Null keys have a tree of their own, the first one. Rows that are equal in the order come in any order only if they
    have the same digest, which then ends it. An empty table gives an empty manifest.
    """
    named = leaves.withColumn("tree", F.coalesce(F.concat(F.lit("="), F.col(key).cast("string")), F.lit("-")))
    ranks = ranked(named, "tree", [*order, "digest"], "leaves")
    low = saved(ranks.withColumn("lo", F.col("rank")).withColumn("hi", F.col("rank") + 1).drop("rank"), "ranked")
    above = levels(low.select("tree", "n", "lo", "hi", "digest"), fan)
    single = low.filter("n = 1").select("tree", "digest")
    tops = [single] + [nodes.filter(F.col("n") <= fan ** (i + 1)).select("tree", "digest") for i, nodes in enumerate(above)]
    subroots = saved(reduce(DataFrame.unionByName, tops).withColumnsRenamed({"tree": "member", "digest": "subroot"}), "subroots")

    # The subroots are the leaves of the last tree; "-" sorts before "=", so that null comes first.
    last = subroots.select(F.lit("all").alias("tree"), "member", F.col("subroot").alias("digest"))
    last = ranked(last, "tree", ["member"], "languages")
    last = saved(last.withColumn("lo", F.col("rank")).withColumn("hi", F.col("rank") + 1).drop("rank"), "languages")
    over = levels(last.select("tree", "n", "lo", "hi", "digest"), fan)
    empty = F.array().cast(f"array<{STEP}>")
    top = with_paths(last, over, last.select("tree").distinct().withColumn("top", empty), fan)
    top = saved(top.select(F.col("member").alias("tree"), F.col("path").alias("top"), F.col("digest").alias("subroot")), "tops")

    out = with_paths(low, above, top.select("tree", "top"), fan)
    roots = top.select("tree", "subroot", folded(F.col("subroot"), F.col("top")).alias("root"))
    return out.join(sized(saved(roots, "roots")), "tree").drop("tree", "n", "lo", "hi")


def verify(docs: DataFrame, tampered: int = TAMPERED) -> DataFrame:
    """The manifest of ``documents`` and whether each row still leads to the root after some were altered.

    Altered are rows whose crc32 of the id is divisible by ``tampered``: A-Z in their text become lower case, so rows
    without such letters still verify. A null id is never altered, and comes first in its language. Nulls in other
    columns are told from empty values. Repeated rows are leaves of their own, with equal digests and different
    siblings. Texts of any length are hashed whole. Other columns, also named like the results, do not matter.
    """
    text = F.col("text")
    changed = F.crc32(F.col("doc_id").cast("string")) % tampered == 0
    seen = F.when(changed & text.rlike("[A-Z]"), document_leaf(lower_az(text)))
    leaves = docs.select("doc_id", "lang", document_leaf(text).alias("digest"), seen.alias("seen"))
    out = manifest(saved(leaves, "digests"), "lang", ["doc_id"])
    root = folded(F.coalesce("seen", "digest"), F.col("path"))
    out = out.select(
        "doc_id", F.col("digest").alias("leaf"), "subroot", "root", proof(F.col("path")).alias("proof_sha256"), root.alias("folded_root")
    )
    return out.withColumn("verified", F.col("folded_root") == F.col("root"))
