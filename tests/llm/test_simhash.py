"""SimHash near-duplicates against brute force."""

import re

import duckdb
import numpy as np
import pytest
import xxhash

from parcelweave.llm import q_simhash
from parcelweave.llm.simhash import anchors, keep_first, near_duplicates

SF = "/root/testdata/sf0.01"


def plain_fingerprint(text):
    words = re.findall(rb"[^\x20\x09-\x0D]+", (text or "").encode().lower())
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(rows):
    fps = np.array([f for _, f in rows], dtype=np.uint64)
    parent = list(range(len(rows)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in np.nonzero(np.bitwise_count(fps[i] ^ fps) <= 3)[0]:
            a, b = top(i), top(int(j))
            parent[max(a, b)] = min(a, b)
    ids = {}
    for i, (doc, _) in enumerate(rows):
        ids[top(i)] = min(ids.get(top(i), doc), doc)
    return [ids[top(i)] for i in range(len(rows))]


def test_query_equals_brute_force(spark):
    rows = duckdb.connect().execute(f"select doc_id, text from '{SF}/documents.parquet' order by 1").fetchall()
    marked = [(d, plain_fingerprint(t)) for d, t in rows]
    want = {(d, f"{f:016x}", c) for (d, f), c in zip(marked, brute_components(marked), strict=True)}
    assert {tuple(r) for r in q_simhash.query(spark, SF).collect()} == want


@pytest.mark.parametrize("flips", [1, 2, 3])
def test_anchors_meet(flips):
    rng = np.random.default_rng(flips)
    x = rng.integers(0, 2**64, 400, dtype=np.uint64)
    y = x.copy()
    for i in range(len(x)):
        for bit in rng.choice(64, flips, replace=False):
            y[i] ^= np.uint64(1) << np.uint64(bit)
    near, far = [set() for _ in x], [set() for _ in x]
    for sets, (ids, places) in ((near, anchors(x, 1)), (far, anchors(y, 2))):
        for i, a in zip(ids, places, strict=True):
            sets[i].add(a)
    assert all(a & b for a, b in zip(near, far, strict=True))


def test_odd_rows(spark):
    long = " ".join(f"w{i}" for i in range(30_000))
    data = [(1, None, "x", 9), (2, "", "x", 9), (3, " \n", None, 9), (5, "same words here now", "x", 9), (5, "same words here now", "x", 9), (None, "same words here now", "x", 9), (7, long, "x", 9), (8, long + " end", "x", 9), (9, "other", "x", 9)]
    docs = spark.createDataFrame(data, "doc_id long, text string, source string, fp int")
    got = sorted((r.doc_id or 0, r.component_id) for r in near_duplicates(docs).collect())
    assert got == [(0, 5), (1, 1), (2, 1), (3, 1), (5, 5), (5, 5), (7, 7), (8, 7), (9, 9)]
    kept = keep_first(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect()) == [1, 5, 7, 9]


def test_empty(spark):
    docs = spark.createDataFrame([], "doc_id long, text string")
    assert near_duplicates(docs).count() == 0
    assert keep_first(docs).count() == 0


def test_keep_first_with_columns_that_have_no_order(spark):
    prose = " ".join(f"word{i} of{i}" for i in range(50))
    docs = spark.createDataFrame([(1, prose, {"a": 2}), (1, prose, {"a": 1}), (2, prose, {"b": 1}), (3, "other words altogether", None)], "doc_id long, text string, more map<string,int>")
    got = sorted((r.doc_id, str(r.more)) for r in keep_first(docs).collect())
    assert got == [(1, "{'a': 1}"), (3, "None")]
