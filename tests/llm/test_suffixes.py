"""Repeated passages against brute force."""

import random
import re
from collections import defaultdict

import duckdb

from parcelweave.llm import q_suffixes
from parcelweave.llm.suffixes import MIN_WORDS, repeated_passages

SF = "/root/testdata/sf0.01"


def brute(texts):
    """Merged spans per text: words inside a window of 50 words that occurs at another place."""
    words = [re.findall(r"[^\x20\x09-\x0D]+", t or "") for t in texts]
    places = defaultdict(list)
    for d, w in enumerate(words):
        for i in range(len(w) - MIN_WORDS + 1):
            places[hash(tuple(w[i : i + MIN_WORDS]))].append((d, i))
    hit = [set() for _ in texts]
    for at in places.values():
        if len(at) > 1:
            for d, i in at:
                hit[d].update(range(i, i + MIN_WORDS))
    out = []
    for h in hit:
        spans = []
        for i in sorted(h):
            if spans and spans[-1][1] == i:
                spans[-1][1] = i + 1
            else:
                spans.append([i, i + 1])
        out.append([tuple(s) for s in spans])
    return [len(w) for w in words], out


def got(df):
    return sorted((r.doc_id if r.doc_id is not None else -1, r.n_words, r.n_repeat_words, [tuple(s) for s in r.spans]) for r in df.collect())


def test_query_equals_brute_force(spark):
    rows = duckdb.connect().execute(f"select doc_id, text from '{SF}/documents.parquet'").fetchall()
    counts, spans = brute([t for _, t in rows])
    want = sorted((d, n, sum(e - s for s, e in x), x) for (d, _), n, x in zip(rows, counts, spans, strict=True))
    assert got(q_suffixes.query(spark, SF)) == want


def test_passages_at_all_lengths(spark):
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdefghij") for _ in range(6))
    fill = lambda n: [word() for _ in range(n)]
    texts = []
    for length in (30, 49, 50, 51, 60, 90, 200):
        shared = fill(length)
        for _ in range(3):
            texts.append(" ".join(fill(rng.randrange(40)) + shared + fill(rng.randrange(40))))
    counts, spans = brute(texts)
    want = [(i, n, sum(e - s for s, e in x), x) for i, (n, x) in enumerate(zip(counts, spans, strict=True))]
    assert got(repeated_passages(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"))) == want
    assert sum(bool(x) for x in spans) == 15


def test_odd_rows(spark):
    a = " ".join(f"a{i}" for i in range(60))
    long = " ".join(f"u{i}" for i in range(100_000))
    data = [(1, None, 0, "k"), (2, "", 0, "k"), (3, a, None, "k"), (3, a, None, "k"), (None, a, 0, None), (4, long, 0, "k"), (5, "x " * 120, 0, "k")]
    rows = got(repeated_passages(spark.createDataFrame(data, "doc_id long, text string, place int, seed string")))
    assert rows == [(-1, 60, 60, [(0, 60)]), (1, 0, 0, []), (2, 0, 0, []), (3, 60, 60, [(0, 60)]), (3, 60, 60, [(0, 60)]), (4, 100_000, 0, []), (5, 120, 120, [(0, 120)])]


def test_empty(spark):
    assert repeated_passages(spark.createDataFrame([], "doc_id long, text string")).count() == 0
