"""Line deduplication by content-defined chunks of lines.

A text is a sequence of lines.  A rolling hash over the hashes of its lines has its boundaries where it is
lowest among its neighbours, so that the same run of lines is cut alike wherever it stands.  Chunks that
occur more than once in the corpus are removed but for their first occurrence, after comparing their bytes.

A run's first and last chunk reach beyond it, and a short run lies inside one.  So each match is extended
to the run's ends: each line with words opens the shortest window that is long enough to be removed, and
closes another one, and windows that repeat are removed as chunks are.  Those inside a removed chunk need no
look, as the chunk's first occurrence holds the same ones.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelweave.llm.common import OWN, cut_lineage, once, prepare, stable_key

#: Lines that the rolling hash of :func:`chunk_ends` sees.
ROLL = 2
#: A run has at least so many lines with words, and so many words, to be removed.
MIN_LINES, MIN_WORDS = 2, 8
_BASE = np.uint64(0x9E3779B97F4A7C15)


def chunk_ends(lines: list[bytes]) -> list[int]:
    """Ends (exclusive) of the chunks of a line sequence; the last is the number of lines."""
    import xxhash

    if not lines:
        return []
    hashes = np.array([xxhash.xxh64_intdigest(x, 1) for x in lines], dtype=np.uint64)
    rolled = hashes.copy()
    power = np.uint64(1)
    with np.errstate(over="ignore"):
        for back in range(1, ROLL):
            power = power * _BASE
            rolled[back:] += power * hashes[:-back]
    low = np.nonzero((rolled[1:-1] < rolled[:-2]) & (rolled[1:-1] < rolled[2:]))[0] + 2
    return [*low.tolist(), len(lines)]


def windows(lines: list[bytes]) -> list[tuple[int, int]]:
    """First line and end (exclusive) of the shortest runs that are long enough, from each line with
    words on and up to each line with words."""
    counts = [len(x.split()) for x in lines]
    at = [i for i, c in enumerate(counts) if c]
    total = np.concatenate([[0], np.cumsum([counts[i] for i in at])]).astype(np.int64)
    n = np.arange(len(at))
    last = np.maximum(np.searchsorted(total, total[:-1] + MIN_WORDS) - 1, n + MIN_LINES - 1)
    first = np.minimum(np.searchsorted(total, total[1:] - MIN_WORDS, side="right") - 1, n - MIN_LINES + 1)
    found = {(i, j) for i, j in enumerate(last.tolist()) if j < len(at)} | {(i, j) for j, i in enumerate(first.tolist()) if i >= 0}
    return sorted((at[i], at[j] + 1) for i, j in found)


def chunks(lines: list[bytes]) -> list[tuple[int, int, int]]:
    """First line, end (exclusive) and number of words of each chunk, without the lines at its ends that
    have no words; chunks without words are left out."""
    out, start = [], 0
    counts = [len(x.split()) for x in lines]
    for end in chunk_ends(lines):
        at = [i for i in range(start, end) if counts[i]]
        if at:
            out.append((at[0], at[-1] + 1, sum(counts[start:end]), len(at)))
        start = end
    return [(first, end, words) for first, end, words, worded in out if worded >= MIN_LINES and words >= MIN_WORDS]


def _runs(batches: Iterator) -> Iterator:
    """One row per chunk and per window: key and id of the text, first line, number of lines, digest, and
    for a window the first line of the chunk around it, -1 if there is none; null for a chunk."""
    import bisect
    import hashlib

    import pyarrow as pa

    for batch in batches:
        rows: list[tuple] = []
        for key, number, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).cast(pa.binary()), strict=True):
            lines = (text.as_py() or b"").split(b"\n")
            whole = chunks(lines)
            starts = [first for first, _, _ in whole]
            spans = [(first, end, None) for first, end, _ in whole]
            for first, end in windows(lines):
                at = bisect.bisect_right(starts, first) - 1
                spans.append((first, end, starts[at] if at >= 0 and end <= whole[at][1] else -1))
            for first, end, around in spans:
                rows.append((key, number, first, end - first, hashlib.blake2b(b"\n".join(lines[first:end]), digest_size=16).digest(), around))
        columns = list(zip(*rows, strict=True)) or [()] * 6
        kinds = (pa.binary(), pa.int64(), pa.int32(), pa.int32(), pa.binary(), pa.int32())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], ["key", "id", "first", "lines", "digest", "around"])


def repeated_runs(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """``key, removed``: per document (see :func:`stable_key`) its chunks and windows that repeat an earlier
    one of the corpus, as an array of (first line, number of lines).

    Digests find candidates; their bytes are then read again and grouped whole, so only equal bytes
    count as a repeat.  The first occurrence is that of the smallest id (nulls last), then key, then
    place; what overlaps it in its own text is no repeat.  Groups are reduced to a count and a first
    occurrence on the map side, so a run shared by a third of all documents is no hot spot, and the
    joins that tell occurrences of their group are of two plain tables, whose skewed keys adaptive
    execution splits.  Joins with the texts are merge joins at every size, as the other side grows with
    the corpus.
    """
    prepare(docs.sparkSession)
    rows = docs.select(
        stable_key(F.col(id_column), F.col(text)).alias("key"), F.col(id_column).cast("long").alias("id"), F.col(text).alias("text")
    )
    found = cut_lineage(rows.mapInArrow(_runs, "key binary, id long, first int, lines int, digest binary, around int"))
    # Rows alike in id and text give the same runs again: they count once.
    spot = F.struct(F.col("id").isNull().alias("n"), "id", "key", "first")
    often = found.groupBy("digest").agg(F.min(spot).alias("low"), F.max(spot).alias("high")).filter("low != high")
    often = cut_lineage(often.select("digest", "low"))
    repeated = found.join(often, "digest")
    # Windows inside a later occurrence of a chunk have their first occurrence elsewhere, and go with the chunk.
    apart = (F.col("key") != F.col("low.key")) | (F.col("first") - F.col("low.first") >= F.col("lines"))
    gone = repeated.filter(F.col("around").isNull() & apart)
    gone = gone.select("key", F.col("first").alias("around")).distinct()
    inside = cut_lineage(repeated.filter("around >= 0").select("key", "id", "first", "lines", "around")).join(gone, ["key", "around"], "left_anti")
    others = repeated.filter("around is null or around < 0").select("key", "id", "first", "lines")
    candidates = others.unionByName(inside.drop("around")).groupBy("key", "id").agg(F.collect_set(F.struct("first", "lines")).alias("parts"))
    candidates = cut_lineage(candidates)
    split = rows.select("key", "text").join(candidates.hint("merge"), "key").select("key", "id", F.split("text", "\n").alias("all"), F.explode("parts").alias("part"))
    body = F.array_join(F.slice("all", F.col("part.first") + 1, F.col("part.lines")), "\n")
    placed = cut_lineage(split.select("key", "id", "part.*", body.alias("body")))
    groups = cut_lineage(placed.groupBy("body").agg(F.min(spot).alias("low"), F.max(spot).alias("high")).filter("low != high").select("body", "low"))
    later = placed.join(groups, "body").filter((F.col("key") != F.col("low.key")) | (F.col("first") - F.col("low.first") >= F.col("lines")))
    return cut_lineage(later.groupBy("key").agg(F.collect_set(F.struct("first", "lines")).alias("removed")))


def dedup_lines(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """All input rows and columns, repeated runs of lines cut out of ``text``.

    A line goes if it lies in a run of at least two lines with words and eight words that an earlier
    place of the corpus holds; lines without words at a run's ends stay.  Null texts stay null and empty
    ones empty; a text cut whole becomes empty; long texts are read whole; rows alike in id and text stand for one document and are cut alike; documents with a null id
    come last in order; an empty table stays empty.  Further columns of any name are kept.
    """
    removed = repeated_runs(docs, id_column, text).select(F.col("key").alias(f"{OWN}key"), F.col("removed").alias(f"{OWN}removed"))
    marked = docs.withColumn(f"{OWN}key", stable_key(F.col(id_column), F.col(text))).join(removed.hint("merge"), f"{OWN}key", "left")

    gone = F.flatten(F.transform(f"{OWN}removed", lambda r: F.sequence(r["first"], r["first"] + r["lines"] - 1)))

    def left(lines):
        return F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), gone), lambda i: F.get(lines, i))

    cut = F.array_join(once(F.split(F.col(text), "\n"), left), "\n")
    whole = marked.withColumn(text, F.when(F.col(f"{OWN}removed").isNull(), F.col(text)).otherwise(cut))
    return whole.select(*[F.col(f"`{c}`") for c in docs.columns])


def line_report(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per input row: doc_id, n_chars before, n_chars_left, and text_sha256 of the text left
    (null for a null text)."""
    rows = docs.select(F.col(id_column).alias("doc_id"), F.col(text).alias("text"), F.length(text).cast("long").alias("n_chars"))
    left = dedup_lines(rows)
    return left.select("doc_id", "n_chars", F.length("text").cast("long").alias("n_chars_left"), F.sha2("text", 256).alias("text_sha256"))
