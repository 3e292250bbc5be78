"""What steps leave on, and send over, the executors' disks."""

import time

from pyspark.sql import functions as F

from parcelweave.config import BUILDING, POOL, ROOF
from parcelweave.operators import rollup
from parcelweave.plans import export
from parcelweave.plans.samples import CATALOGUE, Tables
from parcelweave.plans.workloads import exports
from parcelweave.session import cut_lineage

SF = "/root/testdata/sf0.001"


def shuffle_files(spark):
    found = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager().getAllFiles()
    return {found.apply(i).getName() for i in range(found.size()) if found.apply(i).getName().startswith("shuffle_")}


def left_behind(spark, before):
    for _ in range(50):
        left = shuffle_files(spark) - before
        if not left:
            return left
        time.sleep(0.1)
    return left


def _rows(spark):
    return spark.range(1000).groupBy((F.col("id") % 7).alias("k")).agg(F.sum("id").alias("n"))


def test_written_tables_leave_noshuffle_files(spark):
    setting = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    own, before = spark.conf.get(setting), shuffle_files(spark)
    written = cut_lineage(_rows(spark))
    assert not left_behind(spark, before)
    assert len(written.collect()) == 7 and spark.conf.get(setting) == own


def test_classes_without_links_are_not_shuffled(spark):
    i = exports.inputs(Tables(spark, SF))
    i.features = i.features.drop("parent_id").withColumn("parent_id", F.lit(None).cast("string"))
    linked = export.linked_features(i, "au", cell_size=4.0, materialize=False)
    pools = linked.where(F.col("class_id") == POOL)
    assert "Join" not in pools._jdf.queryExecution().optimizedPlan().toString()
    assert pools.count() == i.features.where(F.col("class_id") == POOL).count() > 0
    got = linked.groupBy("class_id").count().collect()
    want = i.features.groupBy("class_id").count().unionByName(i.roof_instances.groupBy("class_id").count()).collect()
    assert sorted(map(tuple, got)) == sorted(map(tuple, want))


def test_outlines_come_back_from_the_links(spark):
    f = exports.inputs(Tables(spark, SF)).features.where(F.col("class_id").isin(ROOF, BUILDING)).select("aoi_id", "feature_id", "geometry", "bbox")
    odd = F.when(F.length("feature_id") % 3 == 0, F.transform("geometry", lambda p: F.transform(p, lambda r: F.slice(r, 1, 4)))).when(F.length("feature_id") % 3 == 1, F.col("geometry"))
    f = cut_lineage(f.withColumn("geometry", odd))
    none = spark.createDataFrame([], "aoi_id string, feature_id string, role string, parent_id string")
    back = export._attach(f, none, "child", {"parent_id": "parent_id"}).drop("parent_id")
    assert back.exceptAll(f).isEmpty() and f.exceptAll(back).isEmpty()


def test_crowded_areas_are_folded_apart(spark):
    f = Tables(spark, SF).features()
    f = cut_lineage(f.withColumn("aoi_id", F.when(F.col("l_orderkey") % 3 == 0, "1").when(F.col("l_orderkey") % 7 > 0, F.col("aoi_id"))))
    areas = f.select("aoi_id").distinct().where(F.col("aoi_id").isNotNull())
    fold = lambda df: rollup.fold_classes(rollup.class_metrics(df, "au"))
    flat = lambda df: {r.aoi_id: {k: (v["count"], v["primary"]["feature_id"]) for k, v in r.classes.items()} for r in df.collect()}
    want = flat(fold(f.where(F.col("aoi_id").isNotNull())))
    assert flat(rollup.fold_by_area(f, fold)) == flat(rollup.fold_by_area(f, fold, crowded=50)) == want
    counts = [f"{c.name}_count" for c in CATALOGUE]
    once = rollup.parcel_rollup(areas, f, CATALOGUE, "au", stored=True).select("aoi_id", *counts)
    plain = rollup.parcel_rollup(areas, f, CATALOGUE, "au").select("aoi_id", *counts)
    steps = [df._jdf.queryExecution().executedPlan().toString().count("Exchange hashpartitioning") for df in (once, plain)]
    assert once.exceptAll(plain).isEmpty() and steps[0] < steps[1]
