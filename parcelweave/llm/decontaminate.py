"""Benchmark decontamination over a distributed positional inverted index.

The training documents are indexed in segments, each the documents of one Arrow batch: a row per
(segment, word) holds the word's positions, counted through the segment, and one row with an empty
word holds the segment's document ids and where each begins.  Positions of words that no test item
holds cannot take part in a match and are not stored.

A phrase of the test set is looked up from its rarest word: that word's positions, moved by its
offset, are the candidate starts, and the other words, rarest first, leave fewer and fewer of them.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelweave.llm.common import OWN, cut_lineage, prepare, stable_key

WINDOW = 13
#: Words of test items handled in one round, whose phrases each task holds in memory.
BLOCK_WORDS = 500_000
#: Words of text in a segment at most, but for a single longer document.
SEGMENT_WORDS = 1_000_000
INDEX = "segment long, term binary, positions array<int>, keys array<{kind}>"


def tokens(text: bytes | None) -> list[bytes]:
    """Words of ``[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+`` after lower-casing A-Z, as UTF-8."""
    import re

    return re.findall(rb"[0-9a-z\x80-\xff]+", (text or b"").lower())


def build_index(docs: DataFrame, vocabulary: Sequence[bytes] | None, key: str = "doc_id", text: str = "text", kind: str = "long") -> DataFrame:
    """Index rows of all documents; with ``vocabulary`` only its words get positions.  Keys are of type
    ``kind``, long or binary."""
    prepare(docs.sparkSession)
    shared = docs.sparkSession.sparkContext.broadcast(None if vocabulary is None else sorted(vocabulary))

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        number = TaskContext.get().partitionId() << 32
        known = None if shared.value is None else pa.array(shared.value, pa.binary())
        for batch in batches:
            keys = batch.column(0).to_pylist()
            texts = batch.column(1).cast(pa.binary())
            first = 0
            while first < len(keys):
                words, starts, at = [], [0], first
                while at < len(keys) and (at == first or len(words) < SEGMENT_WORDS):
                    words += tokens(texts[at].as_py())
                    starts.append(len(words))
                    at += 1
                yield _segment(number, words, starts, keys[first:at], known, batch.column(0).type)
                number += 1
                first = at

    rows = docs.select(F.col(key).cast(kind).alias("key"), F.col(text).alias("text"))
    return rows.mapInArrow(run, INDEX.format(kind=kind))


def _segment(number: int, words: list[bytes], starts: list[int], keys: list, known, kind):
    import pyarrow as pa
    import pyarrow.compute as pc

    flat = pa.array(words, pa.binary())
    if known is None:
        coded = flat.dictionary_encode()
        names, codes = coded.dictionary, coded.indices.to_numpy(zero_copy_only=False)
        places = np.arange(len(words), dtype=np.int32)
    else:
        found = pc.index_in(flat, value_set=known)
        names, places = known, np.nonzero(np.asarray(found.is_valid()))[0].astype(np.int32)
        codes = found.drop_null().to_numpy()
    order = np.argsort(codes, kind="stable")
    used, begin = np.unique(codes[order], return_index=True)
    offsets = np.append(begin, len(codes)).astype(np.int32)
    # The segment's own row stands first: where documents begin, and at last where the text ends.
    positions = np.concatenate([np.array(starts, dtype=np.int32), places[order]])
    offsets = np.concatenate([[0], offsets + len(starts)]).astype(np.int32)
    lists = pa.ListArray.from_arrays(pa.array(offsets), pa.array(positions))
    terms = pa.concat_arrays([pa.array([b""], pa.binary()), names.take(pa.array(used))])
    ids = pa.array([keys] + [None] * len(used), pa.list_(kind))
    return pa.RecordBatch.from_arrays(
        [pa.array(np.full(len(terms), number, dtype=np.int64)), terms, lists, ids], ["segment", "term", "positions", "keys"]
    )


@dataclass
class Phrases:
    """Distinct phrases of one length: word codes, offsets from rarest to commonest, and the items of each."""

    codes: np.ndarray
    order: np.ndarray
    items: list[list[str]]


def phrases(items: dict[str, list[bytes]], counts: dict[bytes, int]) -> tuple[dict[bytes, int], list[Phrases]]:
    """Codes of the words, and the phrases (all windows of the items) that the corpus may hold."""
    codes = {w: i for i, w in enumerate(sorted({w for words in items.values() for w in words}))}
    often = np.array([counts.get(w, 0) for w in codes], dtype=np.int64)
    owners: dict[tuple[int, ...], set[str]] = {}
    for item, words in items.items():
        ids = [codes[w] for w in words]
        for i in range(max(1, len(ids) - WINDOW + 1)) if ids else ():
            owners.setdefault(tuple(ids[i : i + WINDOW]), set()).add(item)
    out = []
    for length in sorted({len(p) for p in owners}):
        chosen = [p for p in owners if len(p) == length]
        table = np.array(chosen, dtype=np.int32).reshape(len(chosen), length)
        held = np.nonzero(often[table].min(axis=1) > 0)[0]
        table = table[held]
        out.append(Phrases(table, np.argsort(often[table], axis=1, kind="stable"), [sorted(owners[chosen[i]]) for i in held]))
    return codes, [p for p in out if len(p.codes)]


def find(text: np.ndarray, places: dict[int, np.ndarray], known: Phrases) -> tuple[np.ndarray, np.ndarray]:
    """Starts in ``text`` (word codes, -1 for others) and numbers of the phrases found there.

    Candidates are taken phrase group by phrase group; a group has the same rarest word, whose
    positions in bounded runs are tried against all its phrases.
    """
    anchor = known.codes[np.arange(len(known.codes)), known.order[:, 0]]
    sort = np.argsort(anchor, kind="stable")
    bounds = np.append(np.unique(anchor[sort], return_index=True)[1], len(sort))
    starts, numbers = [], []
    for low, high in zip(bounds[:-1], bounds[1:], strict=True):
        group = sort[low:high]
        at = places.get(int(anchor[group[0]]))
        if at is None:
            continue
        run = max(1, 1_000_000 // len(group))
        for i in range(0, len(at), run):
            s = (at[i : i + run, None].astype(np.int64) - known.order[group, 0][None, :]).ravel()
            p = np.broadcast_to(group, (len(at[i : i + run]), len(group))).ravel()
            inside = (s >= 0) & (s + known.codes.shape[1] <= len(text))
            s, p = s[inside], p[inside]
            for step in range(1, known.codes.shape[1]):
                offset = known.order[p, step]
                same = text[s + offset] == known.codes[p, offset]
                s, p = s[same], p[same]
                if not len(s):
                    break
            starts.append(s)
            numbers.append(p)
    if not starts:
        return np.zeros(0, dtype=np.int64), np.zeros(0, dtype=np.int64)
    return np.concatenate(starts), np.concatenate(numbers)


def _read_segment(rows, codes: dict[bytes, int]):
    """Ids, document starts, dense codes and positions by code of one segment's index rows."""
    import pyarrow as pa

    terms = rows.column("term").to_pylist()
    lists = rows.column("positions").combine_chunks()
    values, offsets = lists.values.to_numpy(), lists.offsets.to_numpy()
    own = terms.index(b"")
    keys = rows.column("keys").slice(own, 1).to_pylist()[0]
    starts = values[offsets[own] : offsets[own + 1]].astype(np.int64)
    # One separator between documents keeps phrases from running over their ends.
    text = np.full(int(starts[-1]) + len(keys), -1, dtype=np.int32)
    places: dict[int, np.ndarray] = {}
    for i, term in enumerate(terms):
        code = codes.get(term)
        if code is not None:
            p = values[offsets[i] : offsets[i + 1]].astype(np.int64)
            p = p + np.searchsorted(starts[1:], p, side="right")
            text[p] = code
            places[code] = p
    return keys, starts, text, places, pa


def _matcher(shared):
    def run(rows):
        codes, known = shared.value
        keys, starts, text, places, pa = _read_segment(rows, codes)
        begins = starts[:-1] + np.arange(len(keys))
        edges = np.zeros(len(text) + 1, dtype=np.int32)
        items: list[set[str]] = [set() for _ in keys]
        for group in known:
            s, p = find(text, places, group)
            np.add.at(edges, s, 1)
            np.add.at(edges, s + group.codes.shape[1], -1)
            pairs = np.unique(np.stack([np.searchsorted(begins, s, side="right") - 1, p]), axis=1)
            for doc, number in pairs.T.tolist():
                items[doc].update(group.items[number])
        hit = np.flatnonzero(np.diff(np.concatenate([[0], (np.cumsum(edges) > 0).astype(np.int8), [0]])))
        doc_of = np.searchsorted(begins, hit[::2], side="right") - 1
        spans: list[list[dict]] = [[] for _ in keys]
        for doc, start, end in zip(doc_of.tolist(), hit[::2].tolist(), hit[1::2].tolist(), strict=True):
            spans[doc].append({"start": start - int(begins[doc]), "end": end - int(begins[doc])})
        return pa.table(
            {
                "segment": pa.array([rows.column("segment")[0].as_py()] * len(keys), pa.int64()),
                "place": pa.array(range(len(keys)), pa.int32()),
                "doc_id": pa.array(keys, rows.column("keys").type.value_type),
                "n_words": pa.array(np.diff(starts), pa.int64()),
                "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32())]))),
                "items": pa.array([sorted(x) for x in items], pa.list_(pa.string())),
            }
        )

    return run


MATCHES = "segment long, place int, doc_id {kind}, n_words long, spans array<struct<start:int,end:int>>, items array<string>"


def _blocks(items: DataFrame, item: str, text: str) -> Iterator[dict[str, list[bytes]]]:
    """The test items by blocks of about ``BLOCK_WORDS`` words; null texts have none.  Items of one id
    stay apart under the hood of that id: each row's windows are its own."""
    rows = items.select(F.coalesce(F.col(item).cast("string"), F.lit("null")).alias("item"), F.encode(F.col(text), "UTF-8").alias("text"))
    total = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    count = 1 + total // (BLOCK_WORDS * 6)
    part = F.pmod(F.xxhash64("item", "text"), F.lit(count))
    for number in range(count):
        block: dict[str, list[bytes]] = {}
        for i, row in enumerate(rows.filter(part == number).collect()):
            block[f"{row.item}\x00{i}"] = tokens(row.text)
        yield block


def contamination(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text", item: str = "item_id", item_text: str = "text", kind: str = "long") -> DataFrame:
    """One row per document: doc_id, n_words, ``spans`` of words inside any occurrence of a window of a
    test item (merged, from 0, end exclusive), and ``items``, the sorted ids of the items found.

    A window is 13 consecutive words of an item, or all of a shorter one.  Null and empty texts have no
    words and no match; null ids stay, and repeated rows each give a row; items without words match
    nothing; an item with a null id goes by ``null``.  Very long documents are one segment.  Either
    table may be empty; further columns are left out.  Ids are of type ``kind``, long or binary.

    The test set is taken in blocks of bounded size, each against the whole index.
    """
    blocks = list(_blocks(items, item, item_text))
    vocabulary = {w for block in blocks for words in block.values() for w in words} if len(blocks) == 1 else None
    index = cut_lineage(build_index(docs, vocabulary, key, text, kind))
    found = None
    for block in blocks:
        part = _match_block(index, block, len(blocks) > 1, kind)
        found = part if found is None else found.unionByName(part)
    if len(blocks) > 1:
        found = found.groupBy("segment", "place").agg(
            F.first("doc_id").alias("doc_id"),
            F.first("n_words").alias("n_words"),
            F.flatten(F.collect_list("spans")).alias("spans"),
            F.array_sort(F.array_distinct(F.flatten(F.collect_list("items")))).alias("items"),
        )
        found = found.withColumn("spans", merged(F.col("spans")))
    return found.select("doc_id", "n_words", "spans", "items")


def merged(spans: Column) -> Column:
    """Overlapping and touching spans made one."""
    empty = F.slice(spans, 1, 0)

    def step(done: Column, x: Column) -> Column:
        last = F.get(done, F.size(done) - 1)
        joined = F.struct(last["start"].alias("start"), F.greatest(last["end"], x["end"]).alias("end"))
        return F.when(
            (F.size(done) > 0) & (x["start"] <= last["end"]), F.concat(F.slice(done, 1, F.greatest(F.size(done) - 1, F.lit(0))), F.array(joined))
        ).otherwise(F.concat(done, F.array(x)))

    return F.aggregate(F.array_sort(spans), empty, step)


def _match_block(index: DataFrame, block: dict[str, list[bytes]], narrow: bool, kind: str) -> DataFrame:
    spark = index.sparkSession
    words = {w for item in block.values() for w in item}
    if narrow:  # an index of all words: read only this block's, and the segments' own rows
        wanted = spark.createDataFrame([(bytearray(w),) for w in sorted(words | {b""})], "term binary")
        index = index.join(wanted, "term", "left_semi")
        counted = index
    else:
        counted = index
    counts = counted.filter(F.octet_length("term") > 0).groupBy("term").agg(F.sum(F.size("positions").cast("long")).alias("n"))
    codes, known = phrases(block, {bytes(r.term): r.n for r in counts.collect()})
    for group in known:
        group.items = [sorted({x.partition("\x00")[0] for x in owners}) for owners in group.items]
    shared = spark.sparkContext.broadcast((codes, known))
    return index.groupBy("segment").applyInArrow(_matcher(shared), MATCHES.format(kind=kind))


def proximity_matches(docs: DataFrame, queries: dict[str, Sequence[str]], within: int, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Occurrences of a query's rarest word that have each of its other words at most ``within`` words
    away in the same document: doc_id, query, position (from 0).  Queries without words match nothing."""
    asked = {q: [w for term in terms for w in tokens(term.encode())] for q, terms in queries.items()}
    vocabulary = {w for words in asked.values() for w in words}
    index = cut_lineage(build_index(docs, vocabulary, key, text))
    counts = {
        bytes(r.term): r.n
        for r in index.filter(F.octet_length("term") > 0).groupBy("term").agg(F.sum(F.size("positions").cast("long")).alias("n")).collect()
    }
    codes = {w: i for i, w in enumerate(sorted(vocabulary))}
    ranked = {q: [codes[w] for w in sorted(set(words), key=lambda w: (counts.get(w, 0), w))] for q, words in asked.items() if words}

    def run(rows):
        keys, starts, _, places, pa = _read_segment(rows, codes)
        begins = starts[:-1] + np.arange(len(keys))
        ids, names, at = [], [], []
        for query, (rarest, *others) in ranked.items():
            p = places.get(rarest, np.zeros(0, dtype=np.int64))
            doc = np.searchsorted(begins, p, side="right") - 1
            for other in others:
                q = places.get(other, np.zeros(0, dtype=np.int64))
                near = np.zeros(len(p), dtype=bool)
                for side in (0, -1):
                    i = np.searchsorted(q, p) + side
                    ok = (i >= 0) & (i < len(q))
                    to = q[np.clip(i, 0, max(len(q) - 1, 0))] if len(q) else p
                    near |= ok & (np.abs(to - p) <= within) & (np.searchsorted(begins, to, side="right") - 1 == doc)
                p, doc = p[near], doc[near]
            ids += [keys[d] for d in doc]
            names += [query] * len(p)
            at += (p - begins[doc]).tolist()
        return pa.table({"doc_id": pa.array(ids, pa.int64()), "query": pa.array(names, pa.string()), "position": pa.array(at, pa.int64())})

    return index.groupBy("segment").applyInArrow(run, "doc_id long, query string, position long")


def judged(matches: DataFrame) -> DataFrame:
    """Adds n_hit, n_items and ``contaminated``: some word is hit, and at least one in twenty."""
    n_hit = F.aggregate("spans", F.lit(0).cast("long"), lambda total, x: total + x["end"] - x["start"])
    rows = matches.withColumn("n_hit", n_hit).withColumn("n_items", F.size("items").cast("long"))
    return rows.withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def keep_clean(docs: DataFrame, items: DataFrame, key: str = "doc_id", text: str = "text") -> DataFrame:
    """The documents that are not contaminated, with the input's columns.  Each is judged by its own
    text, whatever other rows have its id or have none."""
    own = stable_key(F.col(key), F.col(text))
    rows = docs.select(own.alias("key"), F.col(text).alias("text"))
    bad = judged(contamination(rows, items, "key", "text", kind="binary")).filter("contaminated").select(F.col("doc_id").alias(f"{OWN}key")).distinct()
    return docs.withColumn(f"{OWN}key", own).join(bad, f"{OWN}key", "left_anti").drop(f"{OWN}key")
