"""Incremental ingest: landed payload files -> up-to-date rollups.

A file stream with ``availableNow`` picks up what is new.  Each micro-batch first joins the payload
store; the rollups of the areas it touches are then recomputed from all their stored payloads and
join the rollup store.

Both stores are logs of runs in levels.  A batch is a run of level 0; when a level has ``FAN`` runs they
are folded into one run of the next level, newest rows winning, so a row is rewritten once a level and a
reader meets less than ``FAN`` runs in each.  Inside a run rows lie in hash buckets of their area, ``FAN``
times as many on each level, so that a bucket stays about as large as history grows, and a batch
reads only the buckets its own areas fall into.

A run counts once its success marker is written, and every row carries its batch.  A replayed batch
replaces its own run, and a run that was folded but not yet deleted is outvoted, so losing the
driver at any point changes no result.
"""

from __future__ import annotations

from collections import defaultdict
from collections.abc import Callable, Iterable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelweave.session import shuffles_dropped

PAYLOADS = "aoi_id string, page int, payload string"
BUCKETS = 16
MAX_BUCKETS = 4096
FAN = 8


def payload_stream(spark: SparkSession, folder: str, *, schema: str = PAYLOADS, max_files: int = 1000) -> DataFrame:
    """Stream of landed JSON-lines payload files."""
    return spark.readStream.schema(schema).option("maxFilesPerTrigger", max_files).json(folder)


def bucket(aoi_id: Column, buckets: int) -> Column:
    return F.pmod(F.xxhash64(aoi_id), F.lit(buckets)).cast("int")


def level_buckets(level: int, buckets: int = BUCKETS) -> int:
    """Number of buckets of a level; each number divides the next, so a bucket lies inside one of the level below."""
    n = buckets
    for _ in range(level):
        n = n * FAN if n * FAN <= max(buckets, MAX_BUCKETS) else n
    return n


# ------------------------------------------------------------------ runs
def _files(spark: SparkSession, path: str):
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark._jsc.hadoopConfiguration()), target


def _children(spark: SparkSession, path: str, key: str) -> list[int]:
    fs, target = _files(spark, path)
    if not fs.exists(target):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(target)]
    return sorted(int(n[len(key) + 1:]) for n in names if n.startswith(f"{key}="))


def complete_runs(spark: SparkSession, store: str) -> dict[int, list[int]]:
    """Runs by level, those without a success marker left out; the log of runs is short by construction."""
    found = defaultdict(list)
    for level in _children(spark, store, "level"):
        for run in _children(spark, f"{store}/level={level}", "run"):
            fs, marker = _files(spark, f"{store}/level={level}/run={run}/_SUCCESS")
            if fs.exists(marker):
                found[level].append(run)
    return dict(found)


def write_run(rows: DataFrame, store: str, level: int, run: int, buckets: int = BUCKETS) -> None:
    """Replace one run; rows need ``aoi_id`` and ``batch_id``.  Hot buckets are written by several tasks."""
    placed = rows.withColumn("bucket", bucket(F.col("aoi_id"), level_buckets(level, buckets)))
    placed = placed.hint("rebalance", "bucket").sortWithinPartitions("bucket", "aoi_id")
    with shuffles_dropped(rows.sparkSession):
        writer = placed.write.mode("overwrite").partitionBy("bucket").option("compression", "zstd")
        writer.parquet(f"{store}/level={level}/run={run}")


def read_runs(
    spark: SparkSession, store: str, runs: dict[int, list[int]], *, schema: str | None = None,
    fine: Iterable[int] | None = None, buckets: int = BUCKETS,
) -> DataFrame | None:
    """Rows of the given runs, of the wanted buckets only (``fine`` counts as on the highest level)."""
    wanted = None if fine is None else set(fine)
    out = None
    for level, ids in sorted(runs.items()):
        reader = spark.read.option("basePath", f"{store}/level={level}")
        reader = reader.option("mergeSchema", True) if schema is None else reader.schema(f"{schema}, batch_id bigint, bucket int")
        rows = reader.parquet(*[f"{store}/level={level}/run={r}" for r in ids])
        if wanted is not None:
            rows = rows.where(F.col("bucket").isin(sorted({b % level_buckets(level, buckets) for b in wanted})))
        rows = rows.drop("bucket", "run")
        out = rows if out is None else out.unionByName(rows, allowMissingColumns=True)
    return out


def newest(rows: DataFrame, keys: Sequence[str]) -> DataFrame:
    """One row per key: that of the latest batch."""
    others = [c for c in rows.columns if c not in keys]
    latest = rows.groupBy(*keys).agg(F.max_by(F.struct(*[f"`{c}`" for c in others]), F.col("batch_id")).alias("_r"))
    return latest.select(*keys, "_r.*")


def compact(
    spark: SparkSession, store: str, keys: Sequence[str], *, schema: str | None = None, buckets: int = BUCKETS
) -> None:
    """Fold every full level into a run of the next one, lowest first."""
    store, level = store.rstrip("/"), 0
    while True:
        runs = complete_runs(spark, store)
        if level > max(runs, default=-1):
            return
        ids = runs.get(level, [])
        if len(ids) >= FAN:
            rows = read_runs(spark, store, {level: ids}, schema=schema, buckets=buckets)
            write_run(newest(rows, keys), store, level + 1, max(ids), buckets)
            for run in ids:
                fs, old = _files(spark, f"{store}/level={level}/run={run}")
                fs.delete(old, True)
        level += 1


# ------------------------------------------------------------------ payloads and rollups
def store_payloads(batch: DataFrame, store: str, batch_id: int, buckets: int = BUCKETS) -> None:
    """Add one batch to the payload store.  Rows without an area id belong to no rollup and are left out."""
    rows = batch.where(F.col("aoi_id").isNotNull()).withColumn("batch_id", F.lit(batch_id).cast("bigint"))
    write_run(rows, store, 0, batch_id, buckets)


def bucket_rows(
    spark: SparkSession, store: str, areas: DataFrame, schema: str = PAYLOADS, buckets: int = BUCKETS
) -> DataFrame:
    """Stored payloads of the buckets that some areas fall into, all batches.

    What reaches the driver is a set of bucket numbers, at most ``MAX_BUCKETS``.
    """
    runs = complete_runs(spark, store)
    finest = level_buckets(max(runs, default=0), buckets)
    hit = [r["b"] for r in areas.select(bucket(F.col("aoi_id"), finest).alias("b")).distinct().collect()]
    rows = read_runs(spark, store, runs, schema=schema, fine=hit, buckets=buckets)
    return spark.createDataFrame([], f"{schema}, batch_id bigint") if rows is None else rows


def stored_payloads(
    spark: SparkSession, store: str, areas: DataFrame, schema: str = PAYLOADS, buckets: int = BUCKETS
) -> DataFrame:
    """All payloads of some areas, the newest batch winning per (area, page)."""
    rows = bucket_rows(spark, store.rstrip("/"), areas, schema, buckets)
    # By hash of the areas, which are short, so that payloads are sorted once, to find the newest.
    rows = rows.join(areas.select("aoi_id").distinct().hint("shuffle_hash"), "aoi_id", "left_semi")
    return newest(rows, ["aoi_id", "page"]).drop("batch_id")


def current_rollup(spark: SparkSession, target: str, columns: Sequence[str] | None = None) -> DataFrame:
    """Newest row per area over all runs, of the named columns alone where they are given."""
    target = target.rstrip("/")
    rows = read_runs(spark, target, complete_runs(spark, target))
    if rows is None:
        raise ValueError(f"no rollup was written to {target}")
    if columns is not None:
        # Before the newest are found: rows travel as structs, which the optimizer does not narrow.
        rows = rows.select("aoi_id", "batch_id", *[c for c in columns if c != "aoi_id"])
    return newest(rows, ["aoi_id"]).drop("batch_id")


def run_incremental(
    spark: SparkSession,
    landing: str,
    store: str,
    target: str,
    checkpoint: str,
    rollup_of: Callable[[DataFrame], DataFrame],
    *,
    max_files: int = 1000,
    buckets: int = BUCKETS,
):
    """Process everything that landed since the last run and return when it is done.

    ``rollup_of`` maps payload rows (aoi_id, page, payload) of whole areas to their rollup rows.
    """
    store, target = store.rstrip("/"), target.rstrip("/")

    def upsert(batch: DataFrame, batch_id: int) -> None:
        store_payloads(batch, store, batch_id, buckets)
        areas = read_runs(spark, store, {0: [batch_id]}, schema=PAYLOADS).select("aoi_id").distinct()
        rollups = rollup_of(stored_payloads(spark, store, areas, buckets=buckets))
        write_run(rollups.withColumn("batch_id", F.lit(batch_id).cast("bigint")), target, 0, batch_id, buckets)
        compact(spark, store, ["aoi_id", "page"], schema=PAYLOADS, buckets=buckets)
        compact(spark, target, ["aoi_id"], buckets=buckets)

    query = (
        payload_stream(spark, landing, max_files=max_files)
        .writeStream.foreachBatch(upsert)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return query
