"""AOI input, parsing and file sinks."""

import json
import math
import sqlite3

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from parcelweave.functions import geometry as G
from parcelweave.functions import columns, kernel as K
from parcelweave.functions.columns import age_years, half_even, snake_name
from parcelweave.operators import rollup
from parcelweave.sources import aoi, geoparquet, payloads, sinks


def one(spark, column):
    return spark.range(1).select(column.alias("v")).first()["v"]


@pytest.mark.parametrize("text, parts", [
    ("POLYGON((0 0,1 0,1 1,0 0))", 1), ("polygon z ((0 0 5, 1 0 5, 1 1 5, 0 0 5))", 1), ("MultiPolygon (((0 0,1 0,1 1,0 0)),((5 5,6 5,6 6,5 5)))", 2),
    ("POLYGON(EMPTY)", None), ("POINT (1 2)", None), ("", None)])
def test_wkt(spark, text, parts):
    g = one(spark, G.from_wkt(F.lit(text)))
    assert (len(g) if g else None) == parts


def test_csv_reading_drops_unusable_rows(spark, tmp_path):
    p = tmp_path / "a.csv"
    p.write_text('aoi_id,geometry,since\n1,"POLYGON((0 0,1 0,1 1,0 0))",2020-01-01\n2,,\n3,POINT (1 2),\n4,"POLYGON((0 0,1 1,2 2,0 0))",\n')
    df = aoi.read_aois(spark, str(p))
    assert [r["aoi_id"] for r in df.collect()] == ["1"]
    assert set(aoi.header_columns(spark, str(p))) == {"aoi_id", "geometry", "since"}


def test_ids_and_errors(spark, tmp_path):
    p = tmp_path / "b.psv"
    p.write_text('name|geometry\nx|POLYGON((0 0,1 0,1 1,0 0))\ny|POLYGON((0 0,2 0,2 2,0 0))\n')
    assert sorted(r["aoi_id"] for r in aoi.read_aois(spark, str(p)).collect()) == ["0", "1"]
    d = tmp_path / "c.csv"
    d.write_text('aoi_id,geometry\n1,"POLYGON((0 0,1 0,1 1,0 0))"\n1,"POLYGON((0 0,1 0,1 1,0 0))"\n')
    with pytest.raises(ValueError, match="duplicate"):
        aoi.read_aois(spark, str(d))
    e = tmp_path / "d.csv"
    e.write_text("aoi_id,geometry\n1,POINT (1 2)\n")
    with pytest.raises(ValueError, match="no valid"):
        aoi.read_aois(spark, str(e))
    with pytest.raises(NotImplementedError):
        aoi.read_aois(spark, str(tmp_path / "x.shp"))
    with pytest.raises(TypeError):
        aoi.check_windows(spark.range(1).select(F.current_timestamp().alias("since")))


def test_geojson_without_ids(spark, tmp_path):
    shape = {"type": "Polygon", "coordinates": [[[151.0, -33.9], [151.1, -33.9], [151.1, -33.8], [151.0, -33.9]]]}
    doc = {"type": "FeatureCollection", "features": [{"type": "Feature", "properties": {"id": i, "address": "x"}, "geometry": shape} for i in range(3)]}
    p = tmp_path / "f.geojson"
    p.write_text(json.dumps(doc, indent=1))
    rows = aoi.read_aois(spark, str(p)).collect()
    assert sorted(r["aoi_id"] for r in rows) == ["0", "1", "2"] and rows[0]["address"] == "x"


def test_geopackage(spark, tmp_path):
    for k in range(2):
        db = sqlite3.connect(tmp_path / f"g{k}.gpkg")
        db.execute("create table gpkg_geometry_columns (table_name text, column_name text)")
        db.execute("insert into gpkg_geometry_columns values ('areas', 'geom')")
        db.execute("create table areas (aoi_id text, geom blob)")
        blob = b"GP\x00\x01" + (4326).to_bytes(4, "little") + K.format_wkb([[K.box_ring(0, 0, 2, 1 + k)]])
        db.execute("insert into areas values (?, ?)", (f"a{k}", blob))
        db.commit()
        db.close()
    df = aoi.read_table(spark, f"{tmp_path}/*.gpkg")
    assert sorted((r["aoi_id"], r["area"]) for r in df.select("aoi_id", G.area(F.col("geometry")).alias("area")).collect()) == [("a0", 2.0), ("a1", 4.0)]


def test_geoparquet_footer_and_overwrite(spark, tmp_path):
    path = str(tmp_path / "geo")
    for n in (5, 3):
        df = spark.range(n).select(F.col("id").cast("string").alias("feature_id"), F.lit("c").alias("class_id"), G.box(F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(1.0)).alias("geometry"))
        geoparquet.write_geoparquet(df, path, partitions=2)
    files = list((tmp_path / "geo").glob("part-*.parquet"))
    assert sum(pq.read_metadata(f).num_rows for f in files) == 3 and (tmp_path / "geo" / "_SUCCESS").exists()
    geo = json.loads(pq.read_schema(files[0]).metadata[b"geo"])
    assert geo["version"] == "1.0.0" and geo["primary_column"] == "geometry"


@pytest.mark.parametrize("country, lon, lat", [("us", -96.2, 39.0), ("ca", -79.4, 43.7), ("au", 151.2, -33.9), ("nz", 174.8, -41.3)])
def test_projected_area_is_ground_area(spark, country, lon, lat):
    """Against the closed-form area of a cell on the ellipsoid (the national grid of nz is not equal-area)."""
    f = 1 / 298.257222101
    e2 = 2 * f - f * f
    e, b = math.sqrt(e2), 6378137.0 * (1 - f)

    def q(p):
        s = math.sin(math.radians(p))
        return s / (2 * (1 - e2 * s * s)) + math.log((1 + e * s) / (1 - e * s)) / (4 * e)

    d = 0.002
    want = b * b * math.radians(d) * (q(lat + d) - q(lat))
    box = G.box(F.lit(lon), F.lit(lat), F.lit(lon + d), F.lit(lat + d))
    assert one(spark, G.area_sqm(box, country)) == pytest.approx(want, rel=1e-6 if country != "nz" else 1e-3)


def test_inside_point_of_concave_shape(spark):
    u = G.from_wkt(F.lit("POLYGON ((0 0, 4 0, 4 4, 3 4, 3 1, 1 1, 1 4, 0 4, 0 0))"))
    p = one(spark, G.inside_point(u))
    assert one(spark, G.contains_point(u, F.lit(p["x"]), F.lit(p["y"])))


def test_parcel_mode_needs_the_flag_on_the_first_feature(spark):
    f = [{"id": "1", "geometry": None}, {"id": "2", "belongsToParcel": False}]
    df = spark.createDataFrame([("a", json.dumps({"features": f})), ("b", json.dumps({"features": f[::-1]}))], "aoi_id string, payload string")
    rows = payloads.feature_rows(df, parcel_mode=True).collect()
    assert sorted((r["aoi_id"], r["feature_id"]) for r in rows) == [("a", "1"), ("a", "2"), ("b", "1")]
    assert all(r["belongs_to_parcel"] for r in rows if r["feature_id"] == "1")


def test_scalars(spark):
    assert [one(spark, half_even(F.lit(v), d)) for v, d in ((0.125, 2), (2.5, 0), (1.15, 1))] == [0.12, 2.0, 1.2]
    assert snake_name("afterInstallationCaptureDate") == "after_installation_capture_date"
    assert one(spark, age_years(F.lit("2019-06"), F.lit("2024-06-01"))) == 5.0
    assert one(spark, age_years(F.lit("soon"), F.lit("2024-06-01"))) is None


def test_permissive_union(spark):
    a = spark.sql("select 1 as k, cast(2 as tinyint) as n, null as x")
    b = spark.sql("select 5000000000 as k, 2.5e0 as n, 'y' as x")
    out = sinks.union_parts([a, b])
    assert dict(out.dtypes) == {"k": "bigint", "n": "double", "x": "string"} and out.count() == 2


def test_mixed_geojson_keeps_all_shapes(spark, tmp_path):
    square = [[[0, 0], [1, 0], [1, 1], [0, 1], [0, 0]]]
    features = [
        {"type": "Feature", "properties": {"name": "a"}, "geometry": {"type": "Polygon", "coordinates": square}},
        {"type": "Feature", "properties": {"name": "b"}, "geometry": {"type": "MultiPolygon", "coordinates": [square]}},
    ]
    path = tmp_path / "mixed.geojson"
    path.write_text(json.dumps({"type": "FeatureCollection", "features": features}))
    rows = aoi.read_aois(spark, str(path)).select("name", G.area(F.col("geometry")).alias("a")).collect()
    assert sorted((r.name, r.a) for r in rows) == [("a", 1.0), ("b", 1.0)]


def test_unreadable_payloads_are_errors(spark):
    good = '{"systemVersion": "s", "features": []}'
    rows = [("1", good), ("2", good[:20]), ("3", '{"systemVersion": "s"}'), ("4", None)]
    df = spark.createDataFrame(rows, "aoi_id string, payload string")
    assert [r.aoi_id for r in payloads.feature_metadata(df).collect()] == ["1"]
    errors = {r.aoi_id: r.message for r in payloads.unreadable_payloads(df).collect()}
    assert sorted(errors) == ["2", "3", "4"] and "JSON" in errors["2"] and "features" in errors["3"]


def test_bad_survey_date_is_null(spark):
    text = '{"surveys": [{"id": "a", "captureDate": "no date"}, {"id": "b", "captureDate": "2024-05-01"}]}'
    rows = payloads.survey_rows(spark.createDataFrame([("1", text)], "aoi_id string, payload string")).collect()
    assert [(r.survey_id, r.captureDate is None) for r in rows] == [("a", True), ("b", False)]


def test_nested_model_version_stays(spark):
    feature = {"id": "f", "roofSpotlightIndex": {"riskScore": 1, "modelVersion": "old", "detail": {"modelVersion": "keep"}}}
    text = json.dumps({"versions": {"roofSpotlightIndex": {"modelVersion": "new"}}, "features": [feature]})
    row = payloads.feature_rows(spark.createDataFrame([("1", text)], "aoi_id string, payload string")).first()
    assert json.loads(row.roof_spotlight_index) == {"riskScore": 1, "modelVersion": "new", "detail": {"modelVersion": "keep"}}


def test_unnamed_feature_keys_stay(spark):
    features = [
        {"id": "a", "confidence": 0.5, "review": {"grade": 3, "by": ["x", None]}, "rank": 7, "note": "5"},
        {"id": "b", "confidence": "much", "roofSpotlightIndex": {}},
        {"id": "c", "rank": None},
    ]
    text = json.dumps({"versions": {"roofSpotlightIndex": {"modelVersion": 'q"1'}}, "features": features})
    plain = json.dumps({"features": [{"id": "d"}]})
    df = spark.createDataFrame([("1", text), ("2", plain), ("3", None), ("4", "{}")], "aoi_id string, payload string")
    rows = {r.feature_id: r for r in payloads.feature_rows(df).withColumn("other", F.to_json("other")).collect()}
    assert json.loads(rows["a"].other) == {"review": {"grade": 3, "by": ["x", None]}, "rank": 7, "note": "5"}
    assert (rows["b"].other, rows["b"].confidence, rows["d"].other) == (None, None, None)
    assert json.loads(rows["c"].other) == {"rank": None}
    assert json.loads(rows["b"].roof_spotlight_index) == {"modelVersion": 'q"1'} and set(rows) == set("abcd")


def test_url_queries_are_cut(spark):
    text = "GET https://a.b/c?key=1&x=http://z?y failed:\thttp://d?e  twice? yes http://f"
    assert one(spark, columns.strip_url_query(F.lit(text))) == "GET https://a.b/c?... failed:\thttp://d?...  twice? yes http://f"


def test_unknown_packs_raise(spark):
    classes = spark.createDataFrame([("c1", "Roof", "Feature"), ("c2", "Zone", "Region")], "class_id string, description string, type string")
    packs = spark.createDataFrame([("building", "c1"), ("building", "c2"), ("solar", "gone")], "pack string, class_id string")
    assert [r.class_id for r in rollup.select_classes(classes, packs, ["building", "solar"]).collect()] == ["c1"]
    assert rollup.select_classes(classes, packs).count() == 2
    with pytest.raises(ValueError, match="foobar"):
        rollup.select_classes(classes, packs, ["building", "foobar"])


def test_date_limits_of_a_dataset_without_them(spark):
    df = spark.createDataFrame([("a", "2024-01-01", None), ("b", None, None)], "aoi_id string, since string, until string")
    with pytest.raises(ValueError, match="since"):
        aoi.check_cutoffs(df, "A.0")
    aoi.check_cutoffs(df, "A.1")
    aoi.check_cutoffs(df.drop("since", "until"), "A.0")
    aoi.check_cutoffs(df.where("aoi_id = 'b'"), "A.0")
