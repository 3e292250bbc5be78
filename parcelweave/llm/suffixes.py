"""Repeated passages found with sparse suffix arrays.

Of every text only the suffixes at minimiser positions are kept: a position is kept if the hash of its
next ``SEED`` words is the smallest among ``MIN_WORDS - SEED + 1`` neighbouring ones.  Any passage of
``MIN_WORDS`` words therefore holds a kept position, and equal passages hold it at the same place.
Suffixes whose seed words occur once drop out; the others are sorted, neighbours are compared to the
right and to the left of the seed, and a common stretch of ``MIN_WORDS`` words or more is a repeat.

A suffix carries ``MIN_WORDS`` words to either side.  That bounds no match: kept positions are closer
than that, so a longer passage is the union of what its kept positions find.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from parcelweave.llm.common import cut_lineage, n_words, prepare, stable_key

#: Words that a repeated passage has at least.
MIN_WORDS = 50
#: Words of a seed.
SEED = 10
_BASE = np.uint64(0x9E3779B97F4A7C15)


def words_in(text: bytes | None) -> list[bytes]:
    import re

    return re.findall(rb"[^\x20\x09-\x0D]+", text or b"")


def minimisers(words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Kept positions and the hashes of their seeds; none for texts below ``MIN_WORDS`` words."""
    import xxhash

    if len(words) < MIN_WORDS:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.uint64)
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(w) for w in words], dtype=np.uint64)
    n = len(hashes) - SEED + 1
    rolled = np.zeros(n, dtype=np.uint64)
    with np.errstate(over="ignore"):
        for i in range(SEED):
            rolled = rolled * _BASE + hashes[i : i + n]
        rolled ^= rolled >> np.uint64(29)
        rolled *= np.uint64(0xBF58476D1CE4E5B9)
    span = MIN_WORDS - SEED + 1
    kept = []
    for start in range(0, n - span + 1, 1 << 16):
        view = np.lib.stride_tricks.sliding_window_view(rolled[start : start + (1 << 16) + span - 1], span)
        kept.append(np.unique(view.argmin(axis=1) + np.arange(len(view))) + start)
    places = np.unique(np.concatenate(kept))
    return places, rolled[places]


def _seeds(batches: Iterator) -> Iterator:
    import pyarrow as pa

    for batch in batches:
        keys, places, hashes = [], [np.zeros(0, dtype=np.int64)], [np.zeros(0, dtype=np.uint64)]
        for key, text in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), strict=True):
            at, h = minimisers(words_in(text.as_py()))
            keys += [key] * len(at)
            places.append(at)
            hashes.append(h)
        yield pa.RecordBatch.from_arrays(
            [pa.array(keys, pa.binary()), pa.array(np.concatenate(places).astype(np.int32)), pa.array(np.concatenate(hashes).view(np.int64))],
            ["key", "place", "seed"],
        )


def _contexts(batches: Iterator) -> Iterator:
    """The words to either side of each wanted position, the left ones in reverse."""
    import hashlib

    import pyarrow as pa

    for batch in batches:
        rows: list[tuple] = []
        for key, text, wanted in zip(batch.column(0).to_pylist(), batch.column(1).cast(pa.binary()), batch.column(2).to_pylist(), strict=True):
            words = words_in(text.as_py())
            for w in wanted:
                at = w["place"]
                right = b"".join(x + b" " for x in words[at : at + MIN_WORDS])
                left = b"".join(x + b" " for x in reversed(words[max(0, at - MIN_WORDS) : at]))
                both = hashlib.blake2b(left + b"\n" + right, digest_size=16).digest()
                rows.append((key, at, w["seed"], both, left, right))
        columns = list(zip(*rows, strict=True)) or [()] * 6
        kinds = (pa.binary(), pa.int32(), pa.int64(), pa.binary(), pa.binary(), pa.binary())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["key", "place", "seed", "both", "left", "right"])


def common_words(a: bytes, b: bytes) -> int:
    """Number of leading words that two contexts share."""
    n = 0
    for x, y in zip(a.split(b" ")[:-1], b.split(b" ")[:-1], strict=False):
        if x != y:
            break
        n += 1
    return n


_PAIR = "both binary, l int, r int, seed long, left binary, right binary"


def _neighbours(batches: Iterator) -> Iterator:
    """Common words of each row with the one before it in the partition's order.

    The first and last row of the partition come out once more with their contexts, so that partitions
    can be compared at their edges.
    """
    import pyarrow as pa

    kinds = (pa.binary(), pa.int32(), pa.int32(), pa.int64(), pa.binary(), pa.binary())
    names = ["both", "l", "r", "seed", "left", "right"]

    def packed(rows: list[tuple]):
        columns = list(zip(*rows, strict=True)) or [()] * 6
        return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names)

    before = None
    for batch in batches:
        out: list[tuple] = []
        for row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
            both, seed, left, right = row
            if before is None:
                out.append((both, None, None, seed, left, right))
            elif before[1] == seed:
                l, r = common_words(before[2], left), common_words(before[3], right)  # noqa: E741
                if l + r >= MIN_WORDS:
                    out += [(before[0], l, r, None, None, None), (both, l, r, None, None, None)]
            before = row
        yield packed(out)
    if before is not None:
        yield packed([(before[0], None, None, *before[1:])])


def _compared(contexts: DataFrame, *order: str) -> DataFrame:
    """``both, l, r`` of neighbours in the given order of distinct contexts."""
    columns = ["both", "seed", "left", "right"]
    ranged = contexts.select(columns).repartitionByRange(*order).sortWithinPartitions(*order)
    found = cut_lineage(ranged.mapInArrow(_neighbours, _PAIR))
    # Two rows from each partition.
    edges = found.filter(F.col("seed").isNotNull()).select(columns).repartition(1).sortWithinPartitions(*order)
    across = edges.mapInArrow(_neighbours, _PAIR)
    return found.unionByName(across).filter(F.col("l").isNotNull()).select("both", "l", "r")


def repeated_passages(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_words, n_repeat_words, and ``spans``: the merged passages (from
    word 0, end exclusive) of at least 50 words that occur elsewhere in the corpus or again in the text.

    Words are runs of anything but ASCII white space, compared exactly.  Texts that occur in several
    rows with 50 words or more are repeats as a whole and searched once; null and empty texts have no words; texts of
    any length are searched whole; null ids are kept; an empty table gives no rows; further columns are
    left out.

    Suffixes are dealt by range of their words, so that a seed shared by a third of all texts spreads
    over tasks; equal contexts are one row before that, however many texts hold them.
    """
    prepare(docs.sparkSession)
    rows = docs.select(stable_key(F.col(text)).alias("key"), F.col(id_column).cast("long").alias("id"), F.col(text).alias("text"))
    facts = cut_lineage(rows.select("key", "id", n_words(F.col("text")).alias("n_words")))
    seeds = cut_lineage(rows.filter(F.octet_length("text") >= 2 * MIN_WORDS - 1).select("key", "text").mapInArrow(_seeds, "key binary, place int, seed long"))
    spot = F.struct("key", "place")
    often = seeds.groupBy("seed").agg(F.min(spot).alias("low"), F.max(spot).alias("high")).filter("low != high")
    often = cut_lineage(often.select("seed"))
    wanted = seeds.join(often, "seed").groupBy("key").agg(F.collect_set(F.struct("place", "seed")).alias("wanted"))
    # Of equal texts one row is read: that of the smallest id.
    chosen = facts.groupBy("key").agg(F.min("id").alias("id"), F.count("*").alias("copies"), F.first("n_words").alias("n_words"))
    chosen = cut_lineage(chosen.join(wanted, "key", "left"))
    reads = chosen.filter(F.col("wanted").isNotNull()).select("key", "id", "wanted")
    same = (rows["key"] == reads["key"]) & rows["id"].eqNullSafe(reads["id"])
    texts = rows.join(reads, same).select(rows["key"], "text", "wanted")
    occurrences = cut_lineage(texts.mapInArrow(_contexts, "key binary, place int, seed long, both binary, left binary, right binary"))
    contexts = occurrences.groupBy("both").agg(
        F.first("seed").alias("seed"), F.first("left").alias("left"), F.first("right").alias("right"), F.min(spot).alias("low"), F.max(spot).alias("high")
    )
    contexts = cut_lineage(contexts)

    def count(side: str):
        return F.octet_length(side) - F.octet_length(F.replace(F.col(side).cast("string"), F.lit(" "), F.lit("")))

    alike = contexts.filter("low != high").select("both", count("left").alias("l"), count("right").alias("r")).filter(F.col("l") + F.col("r") >= MIN_WORDS)
    found = alike.unionByName(_compared(contexts, "right", "left")).unionByName(_compared(contexts, "seed", "left", "right"))
    found = cut_lineage(found.distinct())
    spans = found.join(occurrences.select("both", "key", "place"), "both").select("key", (F.col("place") - F.col("l")).alias("start"), (F.col("place") + F.col("r")).alias("end"))
    whole = chosen.filter((F.col("copies") > 1) & (F.col("n_words") >= MIN_WORDS))
    spans = spans.unionByName(whole.select("key", F.lit(0).alias("start"), F.col("n_words").cast("int").alias("end")))
    merged = cut_lineage(_merged(spans))
    out = facts.join(merged, "key", "left")
    none = F.array().cast("array<struct<start:int,end:int>>")
    total = F.aggregate(F.coalesce("spans", none), F.lit(0).cast("long"), lambda n, s: n + s["end"] - s["start"])
    return out.select(F.col("id").alias("doc_id"), "n_words", total.alias("n_repeat_words"), F.coalesce("spans", none).alias("spans"))


def _merged(spans: DataFrame) -> DataFrame:
    """``key, spans`` with overlapping and touching spans of a key made one."""
    by_key = Window.partitionBy("key").orderBy("start", "end")
    reached = F.max("end").over(by_key.rowsBetween(Window.unboundedPreceding, -1))
    opened = spans.distinct().withColumn("opens", F.coalesce(F.col("start") > reached, F.lit(True)).cast("int"))
    islands = opened.withColumn("island", F.sum("opens").over(by_key)).groupBy("key", "island").agg(F.min("start").alias("start"), F.max("end").alias("end"))
    return islands.groupBy("key").agg(F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
