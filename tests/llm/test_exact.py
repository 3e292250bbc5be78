"""Exact deduplication: odd rows, splitting, chains of colliding hashes, the index on files."""

import uuid

import pytest
from pyspark.sql import functions as F

from parcelweave.llm import exact
from parcelweave.session import scratch_path


def docs(spark):
    long = "very long text " * 200_000
    rows = [(1, "a", 1, "x"), (2, "a", 2, "y"), (2, "a", 1, "y"), (3, None, 1, "x"), (4, "", 1, None), (None, "n", 1, "x"), (None, "n", 1, "x"), (5, "n", 1, "x"), (None, "only", 1, "x"), (6, long, 1, "x"), (7, long, 1, "x"), (8, "A", 1, "x")]
    return spark.createDataFrame(rows, "doc_id long, text string, bucket int, hash string")


def test_odd_rows(spark):
    got = [(r.doc_id or 0, r.keep_id or 0, r.group_size, r.kept) for r in exact.classes(docs(spark)).collect()]
    want = [(1, 2, 3, False), (2, 2, 3, True), (2, 2, 3, True), (3, 4, 2, False), (4, 4, 2, True), (0, 5, 3, False), (0, 5, 3, False), (5, 5, 3, True), (0, 0, 1, True), (6, 7, 2, False), (7, 7, 2, True), (8, 8, 1, True)]
    assert sorted(got) == sorted(want)
    assert exact.classes(docs(spark).limit(0)).count() == 0


def test_dedup_keeps_columns_of_any_kind(spark):
    df = docs(spark).withColumn("more", F.create_map(F.lit("k"), F.col("bucket")))
    out = exact.dedup(df)
    assert out.columns == df.columns
    rows = out.collect()
    assert sorted((r.doc_id or 0) for r in rows) == [0, 2, 4, 5, 7, 8]
    assert {r.bucket for r in rows if r.doc_id == 2} == {1}
    assert exact.dedup(df.limit(0)).count() == 0


@pytest.mark.parametrize("capacity", [1, 7, 10_000])
def test_buckets_split_and_hot_texts_get_pages(spark, capacity):
    df = spark.range(3000).select(F.col("id").alias("doc_id"), F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("t"), F.col("id") % 500)).alias("text"))
    want = {}
    for r in df.collect():
        want.setdefault(r.text, []).append(r.doc_id)
    got = {(r.doc_id, r.keep_id, r.group_size) for r in exact.classes(df, capacity=capacity).collect()}
    assert got == {(d, max(ids), len(ids)) for ids in want.values() for d in ids}
    keys = df.groupBy(F.xxhash64("text").alias("hash")).agg(F.count("*").alias("rows"))
    slots, depth = exact.directory(keys, capacity)
    rows = slots.collect()
    assert len({r.slot for r in rows}) == len(rows) and all(0 <= r.slot < 2**depth for r in rows)
    assert {r.bucket for r in rows} == {r.slot >> (depth - r.bits) for r in rows}
    assert max(r.pages for r in rows) == {1: 1000, 10_000: 1}.get(capacity, max(r.pages for r in rows))
    assert (depth == 0) == (capacity == 10_000)


def test_texts_of_one_hash_are_told_apart_by_bytes(spark, monkeypatch):
    monkeypatch.setattr(exact, "_hash", lambda text: F.length(text).cast("long"))
    df = spark.createDataFrame([(1, "aa"), (2, "bb"), (3, "aa"), (4, "c")], "doc_id long, text string")
    got = {(r.doc_id, r.keep_id, r.group_size) for r in exact.classes(df, capacity=1).collect()}
    assert got == {(1, 3, 2), (3, 3, 2), (2, 2, 1), (4, 4, 1)}


def test_index_on_files_answers_lookups(spark):
    df = docs(spark).select(F.col("doc_id").alias("id"), F.coalesce("text", F.lit("")).alias("text"))
    path = scratch_path(spark, f"t-index-{uuid.uuid4().hex}")
    exact.write_index(exact.build(df.withColumn("hash", F.xxhash64("text")), capacity=1), path)
    asked = spark.createDataFrame([("a", 1), ("b", 2), (None, 3), ("only", 4)], "text string, bits int")
    got = {(r.text, r.bits, r.keep_id, r.group_size) for r in exact.lookup(exact.read_index(spark, path), asked).collect()}
    assert got == {("a", 1, 2, 3), ("b", 2, None, None), (None, 3, 4, 2), ("only", 4, None, 1)}
