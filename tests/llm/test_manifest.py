"""Merkle manifest against a plain version: odd rows, shared ids, trees of more than one block."""

import hashlib
import zlib

from pyspark.sql import functions as F

from parcelweave.llm import manifest

KIND = "doc_id long, text string, lang string, source string, n_chars long, word int, idx string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def told(v):
    return "-" if v is None else f"{len(str(v).encode())}:{v}"


def climb(nodes):
    levels = [nodes]
    while len(levels[-1]) > 1:
        levels.append([h(*levels[-1][i : i + 8]) for i in range(0, len(levels[-1]), 8)])
    return levels


def path(levels, i):
    out = []
    for level in levels[:-1]:
        start = i - i % 8
        out.append(("".join(level[start:i]), "".join(level[i + 1 : start + 8])))
        i //= 8
    return out


def plain(rows):
    """Sorted output rows of (doc_id, text, lang, source, n_chars)."""
    def leaf(r, text):
        return h(told(r[0]), told(r[3]), told(r[2]), told(r[4]), told(text))

    groups = {}
    for r in rows:
        low = r[1] if r[1] is None else "".join(c.lower() if "A" <= c <= "Z" else c for c in r[1])
        hit = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0
        first = leaf(r, r[1])
        groups.setdefault(r[2], []).append((r[0] is not None, r[0] or 0, first, leaf(r, low) if hit else first))
    names = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: climb([x[2] for x in sorted(groups[g])]) for g in names}
    top = climb([trees[g][-1][0] for g in names])
    out = []
    for k, g in enumerate(names):
        for i, (known, doc, first, changed) in enumerate(sorted(groups[g])):
            steps, node = path(trees[g], i) + path(top, k), changed
            for a, b in steps:
                node = h(a, node, b)
            out.append((doc if known else None, first, trees[g][-1][0], top[-1][0], h(*[x for s in steps for x in s]), node, node == top[-1][0]))
    return sorted(out, key=str)


def test_odd_rows(spark):
    rows = [(i, f"Text {i}", "en", "s", i, 1, "k") for i in (5, -9, 2**40, -(2**45), 64, 63, 0, 127, 128, 7)]
    rows += [(5, "Text 5", "en", "s", 5, 2, "k")] * 11 + [(5, f"Other {i}", "en", None, None, 1, None) for i in range(9)]
    rows += [(None, "A", "en", "s", 1, 1, "k")] * 10 + [(None, f"B{i}", "en", "s", 1, 1, "k") for i in range(20)]
    rows += [(1, None, None, None, None, None, None), (2, "", None, "", 0, 1, "k"), (None, "Ünï " * 100_000, "", "s", 3, 1, "k"), (4, "LONE", "zz", "s", 4, 1, "k")]
    out = manifest.manifest(spark.createDataFrame(rows, KIND))
    assert out.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    got = sorted((tuple(r) for r in out.collect()), key=str)
    assert got == plain([r[:5] for r in rows])
    assert {r[-1] for r in got} == {True, False}


def test_empty_and_single(spark):
    none = spark.createDataFrame([], KIND)
    assert manifest.manifest(none).count() == 0
    one = spark.createDataFrame([(6, "x", "en", "s", 1, 1, "k")], KIND)
    assert [tuple(r) for r in manifest.manifest(one).collect()] == plain([(6, "x", "en", "s", 1)])


def test_trees_of_several_blocks_and_directory_levels(spark, monkeypatch):
    monkeypatch.setattr(manifest, "FAN_BITS", 5)
    df = spark.range(9000).select((F.col("id") * 977 - 10**6).alias("doc_id"), F.concat(F.lit("Doc "), "id").alias("text"), F.when(F.col("id") % 2 == 0, "en").otherwise(F.concat(F.lit("l"), F.col("id") % 20)).alias("lang"), F.lit("s").alias("source"), F.col("id").alias("n_chars"))
    rows = [tuple(r) for r in df.collect()]
    got = sorted((tuple(r) for r in manifest.manifest(df).collect()), key=str)
    assert got == plain(rows)
