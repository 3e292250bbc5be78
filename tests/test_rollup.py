"""Rollups in one pass over the features."""

from pyspark.sql import functions as F

from parcelweave.config import BUILDING, BUILDING_LIFECYCLE, ROOF
from parcelweave.operators import rollup
from parcelweave.plans.samples import Tables
from parcelweave.plans.workloads.rollups import _scored
from parcelweave.sources import payloads
from parcelweave.streaming import ingest


def test_mesh_date_is_found_in_the_pass_over_the_features(spark):
    rows = [("a", "f3", ROOF, "2024-03-03"), ("a", "f2", None, "2024-02-02"), ("a", "f1", BUILDING, None), ("b", "f1", None, "2024-01-01"), ("c", "f1", ROOF, None)]
    f = spark.createDataFrame(rows, "aoi_id string, feature_id string, class_id string, mesh_date string")
    f = f.withColumns({c: F.lit(1.0) for c in ("confidence", "fidelity", "area_sqm", "clipped_area_sqm", "unclipped_area_sqm")})
    areas = spark.createDataFrame([("a",), ("b",), ("c",), ("d",)], "aoi_id string")
    out = rollup.parcel_rollup(areas, f.withColumn("multiparcel_feature", F.lit(True)), [rollup.FeatureClass(ROOF, "Roof")], "au")
    got = {r.aoi_id: (r.mesh_date, r.roof_count, r.roof_multiparcel_feature_count) for r in out.collect()}
    # Features without a class give the date of an area that has others, but are no features by themselves.
    assert got == {"a": ("2024-02-02", 1, 1), "b": (None, 0, None), "c": (None, 1, 1), "d": (None, 0, None)}


def test_a_rollup_parses_payloads_once(spark, tmp_path):
    spark.createDataFrame([("a", "{}")], "aoi_id string, payload string").write.parquet(str(tmp_path / "p"))
    rows = spark.read.parquet(str(tmp_path / "p"))
    f = payloads.feature_rows(rows, other=False)
    assert "other" not in f.columns
    out = rollup.parcel_rollup(rows.select("aoi_id").distinct(), f, [rollup.FeatureClass(ROOF, "Roof")], "au")
    assert out._jdf.queryExecution().optimizedPlan().toString().count("from_json(") == 1


def test_current_rollup_of_some_columns_carries_no_others(spark, tmp_path):
    target = str(tmp_path / "rollups")
    for batch in (0, 1):
        rows = spark.createDataFrame([("a", batch, "x", batch), ("b", 5, "y", batch)][: 2 - batch], "aoi_id string, n int, remark string, batch_id bigint")
        ingest.write_run(rows, target, 0, batch, 2)
    now = ingest.current_rollup(spark, target, ["n"])
    assert sorted(map(tuple, now.collect())) == [("a", 1), ("b", 5)]
    assert "remark" not in now._jdf.queryExecution().executedPlan().toString()


def test_rows_with_a_parent_join_buildings_alone(spark):
    t = Tables(spark, "/root/testdata/sf0.001")
    linked = _scored(t).where(F.col("parent_id").isNotNull()).select("aoi_id", "feature_id", "parent_id")
    rows = [(r.aoi_id, r.feature_id, r.class_id) for r in t.features().select("aoi_id", "feature_id", "class_id").collect()]
    first = {}
    for area, feature, kind in rows:
        if kind == BUILDING_LIFECYCLE:
            first[area] = min(feature, first.get(area, feature))
    want = sorted((a, f, first[a]) for a, f, kind in rows if kind == BUILDING and a in first)
    assert want and sorted(map(tuple, linked.collect())) == want
    assert "LeftOuter" not in linked._jdf.queryExecution().optimizedPlan().toString()
