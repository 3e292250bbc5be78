"""Merkle manifest of a dataset, its leaves placed by rank queries on bitmaps.

Each group of documents has a compressed bitmap of its ids: only the 64-bit words that hold an id are
stored, each with the number of leaves before it.  Those numbers come from a popcount directory of several
levels, each entry summing 1,024 of the level below, so no sort and no window ever sees a whole
group.  The rank of an id, and with it the coordinate of its leaf, is the number of its word plus the
popcount of the word's lower bits.  Nodes then go, by coordinate, to the slots of an array of
:data:`BLOCK` leaves, which one call reduces by several levels of the tree.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parcelweave.llm.common import LOWER, UPPER, cut_lineage, prepare
from parcelweave.sources.ids import dense_ids

#: Children of a node.
ARITY = 8
#: Levels that one call reduces, and the leaves it takes.
LEVELS = 4
BLOCK = ARITY**LEVELS
#: Bits of the number of directory entries that one entry above sums up.
FAN_BITS = 10
#: Word of null ids: below that of any id, as nulls come first.
_NULL_WORD = -(1 << 60)
FIELDS = ("doc_id", "source", "lang", "n_chars", "text")
PATH = "array<struct<left:string,right:string>>"


def leaf_digest(values: dict[str, Column]) -> Column:
    """Digest of the named values in the order of :data:`FIELDS`: each its UTF-8 length, ``:`` and itself,
    or ``-`` if null."""

    def told(value: Column) -> Column:
        value = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(value).cast("string"), F.lit(":"), value), F.lit("-"))

    return F.sha2(F.concat(*[told(values[f]) for f in FIELDS]), 256)


def leaves(docs: DataFrame) -> DataFrame:
    """``id, tree, leaf, changed`` per document: ``changed`` is the leaf after tampering, which lower-cases
    the A-Z of texts whose id's CRC-32 is divisible by 3 (a null id is never tampered with).

    ``tree`` names the group, nulls first in byte order.
    """
    values = {f: F.col(f"`{f}`") for f in FIELDS}
    hit = F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 0, F.lit(False))
    lowered = values | {"text": F.translate("text", UPPER, LOWER)}
    leaf = leaf_digest(values)
    changed = F.when(hit, leaf_digest(lowered))
    tree = F.coalesce(F.concat(F.lit("="), F.col("lang").cast("string")), F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("id"), tree.alias("tree"), leaf.alias("leaf"), changed.alias("changed"))
    return rows.withColumn("changed", F.coalesce("changed", "leaf"))


def _word(value: Column) -> Column:
    return F.coalesce(F.shiftright(value, 6), F.lit(_NULL_WORD))


def _bit(value: Column) -> Column:
    return value.bitwiseAND(F.lit(63)).cast("int")


def _shifted(value: int, by: Column) -> Column:
    return F.call_function("shiftleft", F.lit(value).cast("long"), by)


def bitmaps(rows: DataFrame) -> DataFrame:
    """``tree, word, bits, crowd, n, before``: the compressed bitmaps with their popcount directory.

    ``n`` counts the leaves of a word, ``before`` those of the tree's earlier words; ``crowd`` lists the
    bits (64 at most) whose id has several rows, with the number of rows beyond the first.
    """
    ids = rows.groupBy("tree", "id").agg(F.count("*").alias("n"))
    several = F.when(F.col("n") > 1, F.struct(_bit(F.coalesce("id", F.lit(0))).alias("bit"), (F.col("n") - 1).alias("more")))
    words = ids.groupBy("tree", _word(F.col("id")).alias("word")).agg(
        F.bit_or(F.when(F.col("id").isNotNull(), _shifted(1, _bit(F.col("id")))).otherwise(F.lit(0).cast("long"))).alias("bits"),
        F.collect_list(several).alias("crowd"),
        F.sum("n").alias("n"),
    )
    words = cut_lineage(words)
    return _with_rank(words)


def _with_rank(words: DataFrame) -> DataFrame:
    """``before``: the sum of ``n`` over the tree's lower words, through levels of 2^FAN_BITS entries each."""
    levels = [words.select("tree", F.col("word").alias("at0"), "n")]
    while True:
        k = len(levels) - 1
        most = levels[k].groupBy("tree").count().agg(F.max("count")).first()[0] or 0
        if most <= 1 << FAN_BITS:
            break
        up = levels[k].groupBy("tree", F.shiftright(f"at{k}", FAN_BITS).alias(f"at{k + 1}")).agg(F.sum("n").alias("n"))
        levels.append(cut_lineage(up))
    out = words
    for k, level in enumerate(levels):
        mates = ["tree"] if k == len(levels) - 1 else ["tree", F.shiftright(f"at{k}", FAN_BITS)]
        earlier = W.partitionBy(*mates).orderBy(f"at{k}").rowsBetween(W.unboundedPreceding, -1)
        told = level.select("tree", f"at{k}", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias(f"before{k}"))
        at = F.col("word") if k == 0 else F.shiftright("word", FAN_BITS * k)
        out = out.withColumn(f"at{k}", at).join(told, ["tree", f"at{k}"])
    total = sum((F.col(f"before{k}") for k in range(len(levels))), F.lit(0).cast("long"))
    return cut_lineage(out.select("tree", "word", "bits", "crowd", "n", total.alias("before")))


def placed(rows: DataFrame) -> DataFrame:
    """``tree, total, idx, id, leaf, changed``: every leaf with its coordinate and the size of its tree.

    Leaves ascend by id, nulls first; rows that share an id ascend by leaf, and equal leaves are alike.
    """
    rows = cut_lineage(rows)
    words = bitmaps(rows)
    totals = words.groupBy("tree").agg(F.sum("n").alias("total"))
    bit = _bit(F.coalesce("id", F.lit(0)))
    lower = F.bit_count(F.col("bits").bitwiseAND(F.bitwise_not(_shifted(-1, bit)))).cast("long")
    more = F.aggregate(F.filter("crowd", lambda c: c["bit"] < bit), F.lit(0).cast("long"), lambda a, c: a + c["more"])
    shared = F.exists("crowd", lambda c: c["bit"] == bit)
    found = rows.withColumn("word", _word(F.col("id"))).join(words, ["tree", "word"])
    found = found.select("tree", "id", "leaf", "changed", (F.col("before") + lower + more).alias("first"), shared.alias("shared"))
    found = cut_lineage(found.join(totals, "tree"))
    alone = found.filter(~F.col("shared")).select("tree", "total", F.col("first").alias("idx"), "id", "leaf", "changed")

    # Rows that share an id: equal leaves are counted first, then ranks go by ranges of leaves.
    same = found.filter("shared").groupBy("tree", "total", "id", "first", "leaf", "changed").agg(F.count("*").alias("n"))
    same = cut_lineage(same.withColumn("part", F.substring("leaf", 1, 4)))
    parts = same.groupBy("tree", "first", "part").agg(F.sum("n").alias("m"))
    earlier = W.partitionBy("tree", "first").orderBy("part").rowsBetween(W.unboundedPreceding, -1)
    parts = parts.select("tree", "first", "part", F.coalesce(F.sum("m").over(earlier), F.lit(0)).alias("below"))
    inner = W.partitionBy("tree", "first", "part").orderBy("leaf").rowsBetween(W.unboundedPreceding, -1)
    start = F.col("first") + F.col("below") + F.coalesce(F.sum("n").over(inner), F.lit(0))
    ranked = same.join(parts, ["tree", "first", "part"]).withColumn("start", start)
    crowded = ranked.select("tree", "total", F.explode(F.sequence("start", F.col("start") + F.col("n") - 1)).alias("idx"), "id", "leaf", "changed")
    return alone.unionByName(crowded)


def _node(run: list[str]) -> str:
    return hashlib.sha256("".join(run).encode()).hexdigest()


def reduced(slots: list[str], levels: int | None) -> list[list[str]]:
    """The slot arrays of all levels: ``levels`` steps up, or up to a single node where None."""
    out = [slots]
    while len(out) - 1 < levels if levels is not None else len(out[-1]) > 1:
        below = out[-1]
        out.append([_node(below[i : i + ARITY]) for i in range(0, len(below), ARITY)])
    return out


def _slots(idx: list[int], digests: list[str]) -> list[str]:
    low = min(idx)
    slots = [""] * len(idx)
    for i, digest in zip(idx, digests, strict=True):
        slots[i - low] = digest
    return slots


def _steps(total: int) -> int | None:
    return LEVELS if total > BLOCK else None


def _up(table):
    import pyarrow as pa

    tree, total, block = (table.column(c)[0].as_py() for c in ("tree", "total", "block"))
    top = reduced(_slots(table.column("idx").to_pylist(), table.column("digest").to_pylist()), _steps(total))[-1]
    assert len(top) == 1
    return pa.table({"tree": pa.array([tree]), "total": pa.array([-(-total // BLOCK)], pa.int64()), "idx": pa.array([block], pa.int64()), "digest": pa.array(top)})


def _paths(levels: list[list[str]], above: list[dict]) -> Iterator[list[tuple[str, str]]]:
    """For every slot of the lowest level, what stands left and right of its node in the runs on the way
    to the root."""
    upper = [[(a["left"], a["right"]) for a in above]]
    for nodes in reversed(levels[:-1]):
        lower = []
        for i in range(len(nodes)):
            start = i - i % ARITY
            pair = ("".join(nodes[start:i]), "".join(nodes[i + 1 : start + ARITY]))
            lower.append([pair, *upper[i // ARITY]])
        upper = lower
    return upper


def _down(left, right):
    """Paths of the nodes of one block."""
    import pyarrow as pa

    idx = left.column("idx").to_pylist()
    total = left.column("total")[0].as_py()
    levels = reduced(_slots(idx, left.column("digest").to_pylist()), _steps(total))
    paths = _paths(levels, right.column("above")[0].as_py())
    low = min(idx)
    n = len(idx)
    kind = pa.list_(pa.struct([("left", pa.string()), ("right", pa.string())]))
    told = [[{"left": a, "right": b} for a, b in paths[i - low]] for i in idx]
    same = {c: pa.array([right.column(c)[0].as_py()] * n, pa.string()) for c in ("subroot", "root")}
    return pa.table({"tree": left.column("tree"), "idx": left.column("idx"), "above": pa.array(told, kind), **same})


def _prove(left, right):
    """Proof and folded root of every leaf of one block."""
    import pyarrow as pa

    idx, changed = left.column("idx").to_pylist(), left.column("changed").to_pylist()
    total = left.column("total")[0].as_py()
    levels = reduced(_slots(idx, left.column("digest").to_pylist()), _steps(total))
    paths = _paths(levels, right.column("above")[0].as_py())
    low = min(idx)
    proofs, folded = [], []
    for i, node in zip(idx, changed, strict=True):
        path = paths[i - low]
        proofs.append(_node([x for pair in path for x in pair]))
        for a, b in path:
            node = hashlib.sha256((a + node + b).encode()).hexdigest()
        folded.append(node)
    n = len(idx)
    same = {c: pa.array([right.column(c)[0].as_py()] * n, pa.string()) for c in ("subroot", "root")}
    return pa.table({"doc_id": left.column("id"), "leaf": left.column("digest"), **same, "proof_sha256": pa.array(proofs, pa.string()), "folded_root": pa.array(folded, pa.string())})


def _blocked(nodes: DataFrame) -> DataFrame:
    return nodes.withColumn("block", F.floor(F.col("idx") / BLOCK).cast("long"))


def climb(leaf_nodes: DataFrame) -> list[DataFrame]:
    """Tables of nodes ``tree, total, idx, digest``, the last of them with roots only; a tree of one node
    leaves the climb with ``total`` 1."""
    most = leaf_nodes.agg(F.max("total")).first()[0] or 0
    rounds = [leaf_nodes]
    while most > 0 and (most > 1 or len(rounds) == 1):
        rest = rounds[-1] if len(rounds) == 1 else rounds[-1].filter("total > 1")
        up = _blocked(rest.select("tree", "total", "idx", "digest")).groupBy("tree", "block").applyInArrow(_up, "tree string, total long, idx long, digest string")
        rounds.append(cut_lineage(up))
        most = -(-most // BLOCK)
    return rounds


def descend(rounds: list[DataFrame], tops: DataFrame) -> DataFrame:
    """``tree, idx, above, subroot, root`` of the nodes that are the blocks of the lowest table; ``tops``
    has ``tree, above, subroot, root`` of every tree."""
    known = None
    for r in range(len(rounds) - 1, 0, -1):
        nodes = rounds[r]
        done = nodes.filter("total = 1").select("tree", "idx").join(tops, "tree").select("tree", "idx", "above", "subroot", "root")
        if known is not None:
            more = _blocked(nodes.filter("total > 1")).groupBy("tree", "block").cogroup(known.groupBy("tree", "idx"))
            done = done.unionByName(more.applyInArrow(_down, f"tree string, idx long, above {PATH}, subroot string, root string"))
        known = cut_lineage(done)
    return known


def manifest(docs: DataFrame) -> DataFrame:
    """One row per document: doc_id, leaf, subroot, root, proof_sha256, folded_root, verified.

    Documents are the leaves of one tree per ``lang`` (null is a group of its own, first in order), in
    ascending order of ``doc_id``; the groups' subroots are the leaves of the tree of ``root``.
    ``proof_sha256`` hashes the siblings on the way from the leaf to ``root``, ``folded_root`` is computed
    from the tampered leaf and those siblings, and ``verified`` tells whether it is ``root``.

    Null values count as ``-``; null ids come first in their group and, like ids that several rows share,
    ascend by leaf; equal rows have equal leaves and one proof per place.  Long texts are hashed whole; an
    empty table gives no rows; further columns are left out.
    """
    spark = docs.sparkSession
    prepare(spark)
    nodes = cut_lineage(placed(leaves(docs)).withColumnRenamed("leaf", "digest"))
    rounds = climb(nodes)
    if len(rounds) == 1:
        return spark.createDataFrame([], "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string, verified boolean")
    ends = [r.filter("total = 1").select("tree", "digest") for r in rounds[1:]]
    subroots = ends[0]
    for more in ends[1:]:
        subroots = subroots.unionByName(more)
    groups = cut_lineage(dense_ids(subroots.orderBy("tree"), "idx").select(F.col("tree").alias("name"), F.col("idx").cast("long").alias("idx"), "digest"))
    upper = climb(groups.select(F.lit("").alias("tree"), F.lit(groups.count()).cast("long").alias("total"), "idx", "digest"))
    root = upper[-1].select("tree", F.from_json(F.lit("[]"), PATH).alias("above"), F.lit(None).cast("string").alias("subroot"), F.col("digest").alias("root"))
    blocks = descend(upper, root)
    below = _blocked(upper[0]).groupBy("tree", "block").cogroup(blocks.groupBy("tree", "idx"))
    found = below.applyInArrow(_down, f"tree string, idx long, above {PATH}, subroot string, root string")
    tops = cut_lineage(groups.join(found.select("idx", "above", "root"), "idx").select(F.col("name").alias("tree"), "above", F.col("digest").alias("subroot"), "root"))
    blocks = descend(rounds, tops)
    out = _blocked(nodes).groupBy("tree", "block").cogroup(blocks.groupBy("tree", "idx"))
    proved = out.applyInArrow(_prove, "doc_id long, leaf string, subroot string, root string, proof_sha256 string, folded_root string")
    return proved.withColumn("verified", F.col("folded_root") == F.col("root"))
