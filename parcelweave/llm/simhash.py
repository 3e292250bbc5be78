"""SimHash near-duplicates found by anchor points of a covering code.

The 64 bits of a fingerprint are cut into blocks of 23, 23 and 18 (padded to 23), and the anchors are
all triples of words of the binary Golay code, whose covering radius is 3: every block lies within 3
bits of exactly one code word.  If two fingerprints differ in at most 3 bits, some point between them
is at most 1 bit from the one and 2 bits from the other, and the anchor of that point is within radius
plus 1 of the one and radius plus 2 of the other (bits beyond the radius being added up over blocks).
So each fingerprint goes to the few anchors of the first kind and the more of the second, and only
fingerprints that meet at an anchor are compared.
"""

from __future__ import annotations

import functools
import itertools
from collections.abc import Iterator

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelweave.llm.common import OWN, cut_lineage, prepare, stable_key
from parcelweave.llm.components import components

#: Differing bits up to which fingerprints link; anchors are made for this number.
DISTANCE = 3
SEED = 42
SHINGLE = 3
#: Generator polynomial of the binary Golay code of length 23, a fixed value.
GOLAY = 0b110001110101
BLOCKS = ((0, 23), (23, 23), (46, 18))


def fingerprint(words: list[bytes]) -> int:
    """Unsigned 64-bit fingerprint of a word sequence: a bit is set where over half the hashes set it."""
    import xxhash

    if not words:
        return 0
    if len(words) < SHINGLE:
        shingles = [b" ".join(words)]
    else:
        shingles = map(b" ".join, zip(*(words[i:] for i in range(SHINGLE)), strict=False))
    digest = xxhash.xxh64_intdigest
    hashes = np.array([digest(s, SEED) for s in shingles], dtype="<u8")
    ones = np.zeros(64, dtype=np.int64)
    for part in np.array_split(hashes, max(1, len(hashes) // 65536)):
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    return int(np.packbits(2 * ones > len(hashes), bitorder="little").view("<u8")[0])


def _fingerprints(batches: Iterator) -> Iterator:
    import re

    import pyarrow as pa

    find = re.compile(rb"[^\x20\x09-\x0D]+").findall
    for batch in batches:
        *others, text = batch.columns
        texts = text.cast(pa.binary()).to_pylist()
        # bytes.lower() changes A-Z only, which is what is wanted.
        out = np.array([fingerprint(find((t or b"").lower())) for t in texts], dtype=np.uint64)
        yield pa.RecordBatch.from_arrays([*others, pa.array(out.view(np.int64))], [*batch.schema.names[:-1], "fp"])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, fp`` (signed long) of each row; null and empty texts have fingerprint zero."""
    prepare(docs.sparkSession)
    rows = docs.select(F.col(key).cast("long").alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(_fingerprints, "key long, fp long")


def hex_digits(fp: Column) -> Column:
    """16 lowercase hexadecimal digits."""
    return F.lower(F.lpad(F.hex(fp), 16, "0"))


@functools.cache
def _tables() -> tuple[np.ndarray, np.ndarray, tuple[np.ndarray, ...]]:
    """Syndromes of the low 12 and high 11 bits of a block, and for each syndrome the error patterns
    that lead to a code word at 0, 1 and 2 bits beyond the covering radius; -1 fills up."""
    unit = []
    for i in range(23):
        x = 1 << i
        for bit in range(22, 10, -1):
            if x >> bit & 1:
                x ^= GOLAY << (bit - 11)
        unit.append(x)

    def syndromes(first: int, count: int) -> np.ndarray:
        out = np.zeros(1 << count, dtype=np.int64)
        for i in range(count):
            out ^= np.where(np.arange(1 << count) >> i & 1, unit[first + i], 0)
        return out

    found: list[list[list[int]]] = [[[] for _ in range(2048)] for _ in range(3)]
    for weight in range(6):
        for places in itertools.combinations(range(23), weight):
            syndrome = functools.reduce(lambda a, i: a ^ unit[i], places, 0)
            found[max(0, weight - 3)][syndrome].append(sum(1 << i for i in places))
    padded = []
    for lists in found:
        width = max(map(len, lists))
        padded.append(np.array([x + [-1] * (width - len(x)) for x in lists], dtype=np.int64))
    return syndromes(0, 12), syndromes(12, 11), tuple(padded)


def anchors(fps: np.ndarray, beyond: int) -> tuple[np.ndarray, np.ndarray]:
    """Indexes into ``fps`` and anchors within ``beyond`` (0 to 2) bits of the covering radius."""
    low, high, patterns = _tables()
    n = len(fps)
    options = []
    for block, (shift, width) in enumerate(BLOCKS):
        y = (fps >> np.uint64(shift) & np.uint64((1 << width) - 1)).astype(np.int64)
        errors = [p[low[y & 4095] ^ high[y >> 12]] for p in patterns[: beyond + 1]]
        # A code word is known by its upper 12 bits.
        options.append([np.where(e < 0, -1, ((y[:, None] ^ e) >> 11) << (24 - 12 * block)) for e in errors])

    home = [o[0][:, 0] for o in options]
    base = home[0] | home[1] | home[2]
    rows = np.arange(n)
    ids, out = [rows], [base]

    def add(values: np.ndarray, valid: np.ndarray) -> None:
        at = np.nonzero(valid)
        ids.append(at[0])
        out.append(values[at])

    for b in range(3):
        others = base ^ home[b]
        for cost in range(1, beyond + 1):
            moved = options[b][cost]
            add(others[:, None] | moved, moved >= 0)
    if beyond >= 2:
        for b, c in ((0, 1), (0, 2), (1, 2)):
            left, right = options[b][1][:, :, None], options[c][1][:, None, :]
            add((base ^ home[b] ^ home[c])[:, None, None] | left | right, (left >= 0) & (right >= 0))
    return np.concatenate(ids), np.concatenate(out)


def _spread(beyond: int):
    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        for batch in batches:
            fps = batch.column(0).to_numpy(zero_copy_only=False).astype(np.int64).view(np.uint64)
            for start in range(0, len(fps), 4096):
                part = fps[start : start + 4096]
                ids, places = anchors(part, beyond)
                yield pa.RecordBatch.from_arrays([pa.array(places), pa.array(part[ids].view(np.int64))], ["anchor", f"fp{beyond}"])

    return run


def links(distinct: DataFrame) -> DataFrame:
    """Pairs ``a, b`` of the given distinct ``fp`` values that differ in at most 3 bits, each once."""
    fps = distinct.select("fp")
    near = fps.mapInArrow(_spread(1), "anchor long, fp1 long")
    far = fps.mapInArrow(_spread(2), "anchor long, fp2 long")
    # Many rows a fingerprint, which no estimate foresees: never a broadcast.
    met = near.join(far.hint("merge"), "anchor").filter((F.col("fp1") < F.col("fp2")) & (F.bit_count(F.col("fp1").bitwiseXOR(F.col("fp2"))) <= DISTANCE))
    return met.select(F.col("fp1").alias("a"), F.col("fp2").alias("b")).distinct()


def _rooted(distinct: DataFrame) -> DataFrame:
    """``fp, first, root`` of a table of distinct ``fp`` with ``first``: the root is the same all over a component."""
    roots = components(links(distinct))
    return distinct.join(roots.withColumnRenamed("node", "fp"), "fp", "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: ``doc_id``, ``fp`` (signed long), ``component_id``.

    Documents link if their fingerprints differ in at most 3 bits; ``component_id`` is the smallest id
    reachable over links.  Equal fingerprints meet as one, so a group of copies counts once in the
    search, whatever its size.  Null and empty texts have fingerprint zero and link like any other;
    long texts are read whole; repeated rows stay, in one component; null ids stay, but never name a
    component unless it has no other.  An empty table gives no rows; further columns are left out.
    """
    marked = cut_lineage(fingerprints(docs, key, text))
    distinct = cut_lineage(marked.groupBy("fp").agg(F.min("key").alias("first")))
    known = _rooted(distinct)
    tops = known.groupBy("root").agg(F.min("first").alias("component_id"))
    named = cut_lineage(known.join(tops, "root").select("fp", "component_id"))
    return marked.join(named, "fp").select(F.col("key").alias("doc_id"), "fp", "component_id")


def keep_first(docs: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """One document of each component, with the input's columns: that with the smallest id, nulls last,
    and of those the smallest :func:`stable_key`.

    Documents are told apart by id and content, so null ids and ids that several texts share stand for as
    many documents as there are texts.  Of rows alike in both, the one whose columns come first as JSON text stays.
    """
    prepare(docs.sparkSession)
    rows = docs.select(stable_key(F.col(key), F.col(text)).alias("key"), F.col(key).alias("id"), F.col(text).alias("text"))
    marked = cut_lineage(rows.mapInArrow(_fingerprints, f"key binary, id {docs.schema[key].dataType.simpleString()}, fp long"))
    each = marked.groupBy("fp", "key").agg(F.first("id").alias("id"), F.count("*").alias("n"))
    spot = F.struct(F.col("id").isNull().alias("last"), "id", "key", "n")
    distinct = cut_lineage(each.groupBy("fp").agg(F.min(spot).alias("first")))
    best = _rooted(distinct).groupBy("root").agg(F.min("first").alias("first"))
    kept = cut_lineage(best.select(F.col("first.key").alias(f"{OWN}key"), F.col("first.n").alias(f"{OWN}n")))
    found = docs.withColumn(f"{OWN}key", stable_key(F.col(key), F.col(text))).join(kept.hint("merge"), f"{OWN}key")
    one = found.filter(F.col(f"{OWN}n") == 1).select(*[F.col(f"`{c}`") for c in docs.columns])
    return one.unionByName(_one_each(found.filter(F.col(f"{OWN}n") > 1).drop(f"{OWN}n")))


def _one_each(rows: DataFrame) -> DataFrame:
    """One row per key, the same in every run, without the key: the first as JSON text, as columns may be of
    kinds that have no order."""
    whole = F.struct(*[F.col(f"`{c}`") for c in rows.columns if c != f"{OWN}key"])
    return rows.groupBy(f"{OWN}key").agg(F.min_by(whole, F.to_json(whole)).alias(f"{OWN}row")).select(f"{OWN}row.*")
