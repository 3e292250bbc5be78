"""The log-structured stores behind incremental ingest."""

import glob
import os

from pyspark.sql import functions as F

from parcelweave.streaming import ingest
from tests.test_disk import left_behind, shuffle_files


def _batch(spark, areas, text):
    return spark.createDataFrame([(a, 0, f"{text}-{a}" * 20) for a in areas], ingest.PAYLOADS)


def _bytes_read(rows):
    files = [r["f"] for r in rows.select(F.input_file_name().alias("f")).distinct().collect()]
    return sum(os.path.getsize(f.removeprefix("file://")) for f in files)


def test_a_batch_reads_only_the_buckets_of_its_areas(spark, tmp_path):
    store = str(tmp_path / "store")
    mine = _batch(spark, ["a1"], "x").select("aoi_id")
    number = spark.range(1).select(ingest.bucket(F.lit("a1"), 16)).first()[0]
    numbers = spark.range(400).select(F.concat(F.lit("h"), "id").alias("a")).select("a", ingest.bucket(F.col("a"), 16).alias("b"))
    others = [r["a"] for r in numbers.where(F.col("b") != number).collect()]
    ingest.store_payloads(_batch(spark, ["a1"], "x"), store, 0, 16)
    alone = _bytes_read(ingest.bucket_rows(spark, store, mine, buckets=16))
    for i in (1, 2, 3):
        ingest.store_payloads(_batch(spark, others, f"y{i}"), store, i, 16)
    assert alone and _bytes_read(ingest.bucket_rows(spark, store, mine, buckets=16)) == alone
    assert ingest.stored_payloads(spark, store, mine, buckets=16).count() == 1


def test_runs_fold_into_levels_and_the_newest_row_stays(spark, tmp_path):
    store = str(tmp_path / "store")
    keys = ["aoi_id", "page"]
    for i in range(ingest.FAN + 2):
        ingest.store_payloads(_batch(spark, ["same", f"own{i}"], f"v{i}"), store, i, 2)
        ingest.compact(spark, store, keys, schema=ingest.PAYLOADS, buckets=2)
    assert ingest.complete_runs(spark, store) == {0: [ingest.FAN, ingest.FAN + 1], 1: [ingest.FAN - 1]}
    areas = spark.createDataFrame([("same",), ("own0",), ("own9",), ("none",)], "aoi_id string")
    rows = {r.aoi_id: r.payload for r in ingest.stored_payloads(spark, store, areas, buckets=2).collect()}
    assert rows == {"same": "v9-same" * 20, "own0": "v0-own0" * 20, "own9": "v9-own9" * 20}
    # A batch replayed after it was folded, and a run that was never finished, change nothing.
    ingest.store_payloads(_batch(spark, ["same", "own3"], "v3"), store, 3, 2)
    broken = tmp_path / "store" / "level=0" / "run=99"
    os.makedirs(broken)
    again = {r.aoi_id: r.payload for r in ingest.stored_payloads(spark, store, areas, buckets=2).collect()}
    assert again == rows


def test_levels_nest():
    sizes = [ingest.level_buckets(i) for i in range(8)]
    assert sizes[:3] == [16, 128, 1024] and max(sizes) <= ingest.MAX_BUCKETS
    assert all(b % a == 0 for a, b in zip(sizes, sizes[1:]))


def test_rows_without_an_area_and_empty_stores(spark, tmp_path):
    store = str(tmp_path / "store")
    areas = spark.createDataFrame([("a",), (None,)], "aoi_id string")
    assert ingest.stored_payloads(spark, store, areas).count() == 0
    ingest.store_payloads(spark.createDataFrame([(None, 0, "x")], ingest.PAYLOADS), store, 0)
    assert ingest.stored_payloads(spark, store, areas).count() == 0


def test_runs_are_stored_with_zstd_and_leave_no_shuffle_files(spark, tmp_path):
    before = shuffle_files(spark)
    rows = _batch(spark, ["a1", "a2", "b1"], "x").withColumn("batch_id", F.lit(0).cast("bigint"))
    ingest.write_run(rows, str(tmp_path), 0, 0, 2)
    files = glob.glob(f"{tmp_path}/**/*.parquet", recursive=True)
    assert files and all(f.endswith(".zstd.parquet") for f in files)
    assert not left_behind(spark, before)
