"""Perplexity classifier against a plain Kneser-Ney model, and on held-out labels."""

import math
from collections import Counter, defaultdict

import duckdb

from parcelweave.llm import q_perplexity
from parcelweave.llm.perplexity import ORDER, PEAK, classes, classify, perplexities, train

SF = "/root/testdata/sf0.01"


def symbols(text):
    fold = classes()
    return [0] * (ORDER - 1) + [int(fold[b]) for b in text.encode()]


def plain_model(texts):
    """Probability function of interpolated modified Kneser-Ney, by dictionaries."""
    counts = {ORDER: Counter()}
    for t in texts:
        s = symbols(t)
        counts[ORDER].update(tuple(s[i : i + ORDER]) for i in range(len(s) - ORDER + 1))
    for k in range(ORDER - 1, 0, -1):
        counts[k] = Counter(g[1:] for g in counts[k + 1])
    off, total = {}, defaultdict(int)
    for k, table in counts.items():
        n = Counter(table.values())
        y = n[1] / (n[1] + 2 * n[2]) if n[1] + 2 * n[2] else 0.5
        for c in (1, 2, 3):
            raw = c - (c + 1) * y * n[c + 1] / n[c] if n[c] else None
            off[k, c] = raw if raw is not None and 0.05 * c <= raw <= 0.95 * c else 0.5 * c
    held = defaultdict(float)
    for k, table in counts.items():
        for g, c in table.items():
            total[k, g[:-1]] += c
            held[k, g[:-1]] += off[k, min(c, 3)]

    def p(gram):
        k = len(gram)
        lower = p(gram[1:]) if k > 1 else 1 / 32
        if (k, gram[:-1]) not in total:
            return lower
        c = counts[k].get(gram, 0)
        top = c - off[k, min(c, 3)] if c else 0
        return (top + held[k, gram[:-1]] * lower) / total[k, gram[:-1]]

    return p


def test_equals_plain_model(spark):
    rows = duckdb.connect().execute(f"select doc_id, lang, text from '{SF}/documents.parquet' where lang = 'de' order by doc_id limit 60").fetchall()
    data = spark.createDataFrame(rows, "doc_id long, lang string, text string")
    p = plain_model([t for _, _, t in rows[:30]])
    assert abs(sum(p((5, 14, 4, 0, x)) for x in range(32)) - 1) < 1e-9
    trusted = data.filter(data.doc_id <= rows[29][0])
    for r in perplexities(data, train(trusted)).collect():
        s = symbols(next(t for d, _, t in rows if d == r.doc_id))
        costs = [-math.log(p(tuple(s[i : i + ORDER]))) for i in range(len(s) - ORDER + 1)]
        assert r.n_bytes == len(costs)
        assert math.isclose(r.perplexity, math.exp(sum(costs) / len(costs)), rel_tol=1e-4)
        peak = max((sum(costs[i : i + PEAK]) / PEAK for i in range(len(costs) - PEAK + 1)), default=0)
        assert math.isclose(r.peak, peak, rel_tol=1e-4, abs_tol=1e-6)


def test_labels_are_told_apart(spark):
    labels = dict((d, (q, t)) for d, q, t in duckdb.connect().execute(f"select doc_id, quality, toxic from '{SF}/labels.parquet'").fetchall())
    rows = q_perplexity.query(spark, SF).collect()
    assert len(rows) == 1000
    clean = [r.kept for r in rows if labels.get(r.doc_id) == (1, 0)]
    low = [r.kept for r in rows if labels.get(r.doc_id, (1, 0))[0] == 0]
    assert sum(clean) > 0.98 * len(clean)
    assert sum(low) < 0.6 * len(low)


def test_odd_rows(spark):
    text = "the same words of plain prose again and again. " * 30
    data = [(1, text, "en", 1), (1, text, "en", 1), (2, None, "en", 1), (3, "", "en", 1), (4, text * 400, "en", None), (5, "####%%%%@@@@" * 20, "en", 1), (6, text, None, 1), (None, text, "en", 1), (7, "a", "xx", 1)]
    docs = spark.createDataFrame(data, "doc_id long, text string, lang string, cost int")
    labels = spark.createDataFrame([(1, 1, 0), (2, 1, 0), (5, 0, 0), (6, None, 0), (7, 0, None), (None, 1, 0)], "doc_id long, quality int, toxic int")
    got = sorted((r.doc_id or 0, r.lang, r.kept, r.perplexity is None) for r in classify(docs, labels).collect())
    assert got == [(0, "en", True, False), (1, "en", True, False), (1, "en", True, False), (2, "en", False, True), (3, "en", False, True), (4, "en", True, False), (5, "en", False, False), (6, "", True, False), (7, "xx", True, False)]
    assert classify(docs.limit(0), labels).count() == 0
    assert sum(r.kept for r in classify(docs, labels.limit(0)).collect()) == 7
