"""Operators on small hand-made tables, and against brute force."""

import json
import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from parcelweave.config import BUILDING, BUILDING_DEPRECATED, BUILDING_LIFECYCLE, LATENCY_EDGES, ROOF, ROOF_INSTANCE
from parcelweave.functions import geometry as G
from parcelweave.functions import kernel as K
from parcelweave.operators import attributes, chains, changes, coverage, damage, grid, includes, linking, primary, rollup, spatial, stats
from parcelweave.plans import export
from parcelweave.plans.samples import with_boxes

HERE = os.path.dirname(__file__)
F_SCHEMA = "aoi_id string, feature_id string, class_id string, kind string, x1 double, y1 double, x2 double, y2 double"


def boxes(spark, rows, schema=F_SCHEMA):
    names = [c.strip().split()[1] for c in schema.split(",")]
    rows = [tuple(float(v) if t == "double" and v is not None else v for v, t in zip(r, names)) for r in rows]
    df = spark.createDataFrame(rows, schema)
    return df.withColumn("geometry", G.box(*[F.col(c) for c in ("x1", "y1", "x2", "y2")]))


def by(df, *keys):
    return {tuple(r[k] for k in keys) if len(keys) > 1 else r[keys[0]]: r for r in df.collect()}


# ------------------------------------------------------------------ golden rollup
@pytest.fixture(scope="module")
def golden(spark):
    raw = spark.read.json(os.path.join(HERE, "resources", "sample_area_features.json"))
    f = raw.withColumns({
        "geometry": G.from_wkt(F.col("geometry")), "attributes": F.lit("[]"), "damage": F.lit(None).cast("string"),
        "mesh_date": F.lit(None).cast("string"),
    })
    aois = spark.createDataFrame([("area",), ("empty",), ("failed",)], "aoi_id string").withColumn(
        "geometry", G.box(F.lit(-112.0), F.lit(33.4), F.lit(-111.9), F.lit(33.5)))
    meta = spark.createDataFrame([("area", "gen6", "2025-10-24"), ("empty", "gen6", "2025-10-24")], "aoi_id string, system_version string, survey_date string")
    cat = [rollup.FeatureClass(ROOF, "Roof"), rollup.FeatureClass(BUILDING, "Building"), rollup.FeatureClass(BUILDING_DEPRECATED, "Building (Deprecated)")]
    inputs = export.ExportInputs(aois, f, meta, cat)
    names = ["hurricane_vulnerability_model_input_flat_present", "hurricane_vulnerability_model_input_roof_staining_ratio"]
    out = export.parcel_tables(inputs, "us", model_input_names=names)
    return by(out, "aoi_id")


def test_golden_counts_and_areas(golden):
    r = golden["area"]
    assert (r["roof_present"], r["roof_count"]) == ("Y", 4)
    assert (r["roof_total_area_sqft"], r["roof_total_clipped_area_sqft"], r["roof_total_unclipped_area_sqft"]) == (47567, 25419, 47567)
    assert (r["building_total_area_sqft"], r["building_total_clipped_area_sqft"]) == (65516, 29985)
    assert r["roof_confidence"] == 1.0 and r["building_confidence"] == 1.0
    assert (r["building_(deprecated)_present"], r["building_(deprecated)_count"], r["building_(deprecated)_confidence"]) == ("N", 0, None)


def test_golden_primary(golden):
    r = golden["area"]
    assert r["primary_roof_feature_id"].startswith("92e94e2c-") and r["primary_building_feature_id"].startswith("059b58b8-")
    assert (r["primary_roof_area_sqft"], r["primary_roof_clipped_area_sqft"]) == (15027, 11943)
    assert (r["primary_building_area_sqft"], r["primary_building_clipped_area_sqft"]) == (45277, 12931)
    assert r["primary_roof_fidelity"] == pytest.approx(0.8979974) and r["primary_roof_confidence"] == 0.99


def test_golden_scores(golden):
    r = golden["area"]
    assert (r["primary_roof_spotlight_index"], r["primary_roof_spotlight_index_confidence"]) == (87, 0.58)
    assert (r["roof_spotlight_index_min"], r["roof_spotlight_index_max"], r["roof_spotlight_index_area_weighted_mean"]) == (87, 93, 88.6)
    assert r["primary_roof_spotlight_index_skipped"] is False and r["primary_hurricane_score_skipped"] is False
    assert (r["primary_hurricane_vulnerability_score"], r["primary_hurricane_vulnerability_probability"]) == (5, 0.798)
    assert r["primary_hurricane_vulnerability_model_input_roof_staining_ratio"] == pytest.approx(0.13417763555499593)
    assert r["hurricane_vulnerability_score_area_weighted_mean"] == pytest.approx(5.0)


def test_three_valued_nulls(golden):
    assert (golden["empty"]["roof_present"], golden["empty"]["roof_count"]) == ("N", 0)
    assert golden["empty"]["roof_confidence"] is None and golden["empty"]["primary_roof_area_sqft"] == 0.0
    assert golden["failed"]["roof_present"] is None and golden["failed"]["roof_count"] is None


# ------------------------------------------------------------------ linking
def test_link_thresholds_and_kind_priority(spark):
    roofs = boxes(spark, [("a", "r1", ROOF, None, 0, 0, 10, 10), ("a", "r2", ROOF, None, 10, 0, 20, 10), ("b", "r1", ROOF, None, 0, 0, 1, 1)])
    ri = boxes(spark, [
        ("a", "parcel", ROOF_INSTANCE, "parcel", 0, 0, 10, 10), ("a", "small", ROOF_INSTANCE, "roof", 0, 0, 5, 4),
        ("a", "tiny", ROOF_INSTANCE, "roof", 19.8, 0, 20, 1), ("a", "far", ROOF_INSTANCE, "roof", 50, 50, 51, 51)])
    child, parent = linking.link_roof_instances_to_roofs(ri, roofs, cell_size=4.0)
    c, p = by(child, "feature_id"), by(parent, "aoi_id", "feature_id")
    assert (c["parcel"]["parent_id"], c["parcel"]["parent_iou"]) == ("r1", 1.0)
    assert (c["tiny"]["parent_id"], c["tiny"]["parent_iou"]) == (None, 0.0)  # 0.2 / 100 < 0.005
    assert c["far"]["parent_id"] is None
    assert p["a", "r1"]["primary_child_roof_age_feature_id"] == "small"  # kind before IoU
    assert [x["feature_id"] for x in json.loads(p["a", "r1"]["child_roof_instances"])] == ["small", "parcel"]
    assert (p["a", "r2"]["child_roof_instance_count"], p["a", "r2"]["primary_child_roof_age_feature_id"]) == (1, None)
    assert (p["b", "r1"]["child_roof_instances"], p["b", "r1"]["primary_child_roof_age_iou"]) == ("[]", 0.0)


def test_link_empty_side(spark):
    none = boxes(spark, [])
    roofs = boxes(spark, [("a", "r1", ROOF, None, 0, 0, 1, 1)])
    child, parent = linking.link_roofs_to_buildings(roofs, none)
    assert child.first()["parent_building_id"] is None and child.first()["parent_building_iou"] == 0.0
    assert parent.count() == 0


@pytest.mark.parametrize("cell", [0.5, 3.0, 1000.0])
def test_candidates_of_one_hot_area_match_brute_force(spark, cell):
    """All features in one area; sizes from far below to far above a cell; nothing lost or doubled."""
    rng = np.random.default_rng(5)

    def make(n, tag):
        xy = rng.uniform(0, 60, (n, 2))
        wh = rng.choice([0.05, 0.4, 3.0, 40.0], (n, 2), p=[0.4, 0.3, 0.25, 0.05])
        return [("hot", f"{tag}{i}", ROOF, None, *map(float, (x, y, x + w, y + h))) for i, ((x, y), (w, h)) in enumerate(zip(xy, wh))]

    a, b = make(300, "a"), make(300, "b")
    got = linking.candidate_pairs(boxes(spark, a), boxes(spark, b), cell_size=cell).select("l.feature_id", F.col("r.feature_id").alias("r")).collect()
    want = {(p[1], q[1]) for p in a for q in b if p[4] <= q[6] and q[4] <= p[6] and p[5] <= q[7] and q[5] <= p[7]}
    assert len(got) == len(want) and {tuple(r) for r in got} == want
    got = linking.candidate_pairs(boxes(spark, a), boxes(spark, b), cell_size=cell, touching=False).select("l.feature_id", F.col("r.feature_id").alias("r")).collect()
    want = {(p[1], q[1]) for p in a for q in b if p[4] < q[6] and q[4] < p[6] and p[5] < q[7] and q[5] < p[7]}
    assert len(got) == len(want) and {tuple(r) for r in got} == want


def test_boxes_that_end_on_a_cell_border_are_filed_once(spark):
    rows = [("a", str(i), ROOF, None, 4.0 * i, 0.0, 4.0 * i + 4, 4.0) for i in range(5)]
    filed = linking._filed(boxes(spark, rows), 4.0, "left", touching=False)
    assert filed.where("_level = 0").count() == 5
    assert linking.iou_pairs(boxes(spark, rows), boxes(spark, rows), cell_size=4.0).where("iou = 1").count() == 5


# ------------------------------------------------------------------ primary
def test_primary_tiers(spark):
    rows = [
        ("in", "big", 0, 0, 10, 10, 100.0, 0.5), ("in", "sure", 0, 0, 10, 10, 90.0, 0.95), ("in", "huge", 50, 50, 90, 90, 1600.0, 0.99),
        ("near", "close", 6, 0, 12, 10, 60.0, 0.5), ("near", "huge", 50, 50, 90, 90, 1600.0, 0.99),
        ("small", "shed", 0, 0, 6, 5, 30.0, 0.99), ("small", "huge", 50, 50, 90, 90, 1600.0, 0.5),
    ]
    f = boxes(spark, rows, "aoi_id string, feature_id string, x1 double, y1 double, x2 double, y2 double, area double, confidence double")
    f = f.withColumns({"lon": F.lit(5.5), "lat": F.lit(2.0)})
    pick = lambda m, df=f: {r["aoi_id"]: r["feature_id"] for r in primary.select_primary(
        df, ["aoi_id"], m, area_col="area", secondary_col=None, planar=True).collect()}
    assert pick("optimal") == {"in": "sure", "near": "close", "small": "huge"}
    assert pick("nearest") == {"in": "sure", "near": "close"}
    assert pick("largest") == {"in": "huge", "near": "huge", "small": "huge"}
    assert pick("nearest", f.withColumn("lat", F.lit(None).cast("double")))["small"] == "huge"
    with pytest.raises(ValueError):
        primary.select_primary(f, ["aoi_id"], "best")


# ------------------------------------------------------------------ multi-parcel identity and scores
def test_same_feature_in_two_areas_keeps_its_own_scores(spark):
    rows = [("p1", "r", ROOF, '{"value": 10}', None), ("p2", "r", ROOF, None, None), ("p2", "bn", BUILDING, None, "bl"),
            ("p2", "bl", BUILDING_LIFECYCLE, '{"value": 70}', None), ("p1", "bl", BUILDING_LIFECYCLE, '{"value": 99}', None)]
    f = spark.createDataFrame(rows, "aoi_id string, feature_id string, class_id string, roof_spotlight_index string, parent_id string")
    links = spark.createDataFrame([("p1", "r", None), ("p2", "r", "bn")], "aoi_id string, feature_id string, parent_building_id string")
    got = by(chains.resolve_scores(f, links), "aoi_id")
    assert got["p1"]["rsi"]["value"] == 10 and got["p2"]["rsi"]["value"] == 70
    assert got["p2"]["lifecycle_id"] == "bl"


def test_parent_cycles_end(spark):
    rows = [("a", "x", "c", "y"), ("a", "y", "c", "z"), ("a", "z", "c", "x"), ("a", "k", "c", "bl"), ("a", "bl", "B", None), ("b", "k", "c", "bl")]
    f = spark.createDataFrame(rows, "aoi_id string, feature_id string, class_id string, parent_id string")
    got = {(r["aoi_id"], r["feature_id"]): r["ancestor_id"] for r in chains.ancestors_of_class(f, "B").collect()}
    assert got["a", "k"] == "bl" and got["b", "k"] is None
    assert got["a", "x"] is None and got["a", "bl"] is None


# ------------------------------------------------------------------ grid
def test_combine_grid_sums_and_winner(spark):
    rows = [("a", "1", 10.0, "x", 0.0), ("a", "1", 15.0, "y", 1.0), ("a", "1", 12.0, "z", 2.0), ("a", "2", 20.0, "w", 5.0)]
    f = spark.createDataFrame(rows, "aoi_id string, feature_id string, clipped_area_sqm double, note string, x double")
    f = f.withColumn("geometry", G.box(F.col("x"), F.lit(0.0), F.col("x") + 1, F.lit(1.0))).drop("x")
    got = by(grid.combine_grid_features(f).withColumn("g", G.area(F.col("geometry"))), "feature_id")
    assert (got["1"]["clipped_area_sqm"], got["1"]["note"], got["1"]["g"]) == (37, "y", 3.0)
    assert (got["2"]["clipped_area_sqm"], got["2"]["note"]) == (20, "w")
    twice = f.unionByName(f.where("feature_id = '2'"))
    assert by(grid.combine_grid_features(twice), "feature_id")["2"]["clipped_area_sqm"] == 40
    once = grid.combine_grid_features(twice, dedupe_before_sum=True)
    assert by(once, "feature_id")["2"]["clipped_area_sqm"] == 20
    assert [r["feature_id"] for r in grid.conflicting_features(f).collect()] == ["1"]


def test_split_concave_area(spark):
    wkt = "POLYGON ((0 0, 4 0, 4 4, 3 4, 3 1, 1 1, 1 4, 0 4, 0 0))"
    a = spark.createDataFrame([("u", wkt)], "aoi_id string, w string").select("aoi_id", G.from_wkt(F.col("w")).alias("geometry"))
    pieces = grid.split_into_grid(a, 2.0).withColumn("area", G.area(F.col("geometry"))).collect()
    assert sum(p["area"] for p in pieces) == pytest.approx(10.0)
    assert len(pieces) == 4 and {(p["cell_col"], p["cell_row"]) for p in pieces} == {(0, 0), (0, 1), (1, 0), (1, 1)}


def test_clipped_roof_components(spark):
    """Half of the roof inside the area: components shrink to half when gridded, else stay whole."""
    attrs = json.dumps([{"description": "Roof material", "components": [
        {"description": "Tile", "classId": "tile", "areaSqm": 9, "areaSqft": 9, "confidence": 0.5, "ratio": 1.0}]}])
    roof = [("a", "r", -74.282, 40.63, -74.280, 40.632, 10.0, 20.0, attrs)]
    r = boxes(spark, roof, "aoi_id string, feature_id string, x1 double, y1 double, x2 double, y2 double, clipped_area_sqm double, unclipped_area_sqm double, attributes string")
    r = r.withColumns({"clipped_area_sqft": F.col("clipped_area_sqm"), "unclipped_area_sqft": F.col("unclipped_area_sqm")})
    kids = boxes(spark, [("a", "t", "tile", None, -74.282, 40.63, -74.280, 40.632)]).withColumn("confidence", F.lit(0.75))
    aoi = boxes(spark, [("a", "x", "x", None, -74.282, 40.63, -74.281, 40.632)])
    whole = spatial.component_overlaps(r, kids, "us").first()["recalc"]["tile"]
    half = spatial.component_overlaps(spatial.clip_gridded_roofs(r, aoi), kids, "us").first()["recalc"]["tile"]
    assert half["area"] == pytest.approx(whole["area"] / 2, rel=1e-4)
    assert whole["ratio"] == pytest.approx(1.0) and half["ratio"] == pytest.approx(1.0) and half["confidence"] == 0.75
    flat = attributes.flatten_roofs(r.withColumn("recalc", F.lit(None).cast(attributes.RECALC)), "us", recalc_col="recalc").first()
    assert flat["roof_numbers"]["tile_area_sqft"] == 9.0


# ------------------------------------------------------------------ damage, statistics
def test_damage_rollup_null_versus_zero(spark):
    aois = spark.createDataFrame([("p1",), ("empty",), ("error",)], "aoi_id string")
    b = spark.createDataFrame([("p1", f"b{i}", float(i), "Major" if i < 2 else "NoDamage", "E") for i in range(5)],
                              "aoi_id string, feature_id string, area_sqm double, damage_event_rating string, event_name string")
    ok = spark.createDataFrame([("p1",), ("empty",)], "aoi_id string")
    got = by(damage.conflation_rollup(aois, b, "au", successful=ok), "aoi_id")
    assert (got["p1"]["n_buildings"], got["p1"]["n_major"], got["p1"]["n_no_damage"], got["p1"]["primary_feature_id"]) == (5, 2, 3, "b4")
    assert (got["empty"]["n_buildings"], got["empty"]["n_minor"]) == (0, 0)
    assert (got["error"]["n_buildings"], got["error"]["query_succeeded"], got["error"]["event_name"]) == (None, False, "E")


def test_histogram_percentiles(spark):
    def p(hist, q):
        arr = F.array(*[F.lit(int(x)).cast("bigint") for x in hist])
        return spark.range(1).select(stats.histogram_percentile(arr, q)).first()[0]

    n = len(LATENCY_EDGES)
    only = [0] * n
    only[2] = 100
    assert 100 <= p(only, 50) <= 150
    last = [0] * n
    last[-1] = 10
    assert p(last, 99) == 60000.0 and p([0] * n, 50) == 0.0


def test_exact_percentiles_of_a_hot_group(spark):
    rng = np.random.default_rng(1)
    hot = np.exp(rng.normal(3, 2, 40000))
    rows = spark.createDataFrame([("hot", float(v)) for v in hot] + [("one", 5.0)] + [("few", float(i)) for i in range(10)], "g string, v double")
    got = by(stats.exact_percentiles(rows, ["g"], "v", (50, 90, 99)), "g")
    for q in (50, 90, 99):
        assert got["hot"][f"p{q}"] == pytest.approx(np.percentile(hot, q), rel=1e-12)
        assert got["few"][f"p{q}"] == pytest.approx(np.percentile(range(10), q))
        assert got["one"][f"p{q}"] == 5.0


def test_exact_percentiles_of_heaped_and_extreme_values(spark):
    rng = np.random.default_rng(5)
    groups = {
        "heaped": np.concatenate([np.full(20_000, 3.0), rng.random(500), [1e300, -1e300]]),
        "close": 1 + rng.random(20_000) * 1e-12,
        "tails": np.exp(rng.normal(0, 4, 20_000)),
        "wide": np.array([-1.7e308, 0.0, 1.7e308]),
        "endless": np.array([1.0, 2.0, 3.0, np.inf]),
        "one": np.array([7.0]),
    }
    rows = [(g, float(v)) for g, vs in groups.items() for v in vs]
    df = spark.createDataFrame([*rows, ("none", None)], "g string, v double")
    got = by(stats.exact_percentiles(df, ["g"], "v", (1, 50, 60, 99.9)), "g")
    assert set(got) == set(groups)
    for g, vs in groups.items():
        for q, name in ((1, "p1"), (50, "p50"), (60, "p60"), (99.9, "p99_9")):
            if g != "endless" or q <= 60:
                assert got[g][name] == pytest.approx(np.percentile(vs, q), rel=1e-12), (g, q)


def test_bootstrap_ignores_empty_groups(spark):
    hist = [0] * len(LATENCY_EDGES)
    hist[2] = 10
    rows = [(str(i), 10, 120.0, hist) for i in range(5)] + [("z", 0, 0.0, [0] * len(LATENCY_EDGES))]
    g = spark.createDataFrame(rows, "chunk string, count bigint, mean double, histogram array<bigint>")
    r = stats.global_stats(g, "chunk", n_bootstrap=50).first()
    assert r["count"] == 50 and r["mean"] == pytest.approx(120.0)
    assert r["p50_ci"][0] >= 100.0


def test_bootstrap_intervals_are_those_of_resampling(spark):
    """Against NumPy draws of groups with replacement: the same width, around the overall percentile."""
    rng = np.random.default_rng(3)
    edges = np.array([*LATENCY_EDGES, np.inf])
    chunks = [np.histogram(rng.gamma(2, 40 + 300 * (i % 3), 30), edges)[0] for i in range(80)]
    df = spark.createDataFrame([(str(i), 30, 1.0, [int(x) for x in h]) for i, h in enumerate(chunks)], "chunk string, count bigint, mean double, histogram array<bigint>")
    r = stats.global_stats(df, "chunk", n_bootstrap=1000).first()
    table = np.array(chunks)
    sums = rng.multinomial(len(chunks), np.full(len(chunks), 1 / len(chunks)), 1000) @ table
    at = spark.createDataFrame([([int(x) for x in h],) for h in sums], "h array<bigint>").select(stats.histogram_percentile(F.col("h"), 50).alias("p")).toPandas().p
    low, high = np.percentile(at, [2.5, 97.5])
    assert low < r["p50"] < high
    assert abs(r["p50_ci"][0] - low) < 0.25 * (high - low) and abs(r["p50_ci"][1] - high) < 0.25 * (high - low)
    assert r["p50_ci"] == stats.global_stats(df.repartition(7), "chunk", n_bootstrap=1000).first()["p50_ci"]


def test_greedy_cover_matches_brute_force(spark):
    rng = np.random.default_rng(2)
    pairs = {(int(p), f"s{int(s)}") for p, s in zip(rng.integers(0, 40, 150), rng.integers(0, 9, 150))}
    df = spark.createDataFrame([(p, s, "2024-01-01") for p, s in pairs], "pt int, survey_id string, captureDate string")
    got = [(r["survey_id"], r["points"]) for r in coverage.greedy_cover(df, "pt").collect()]
    left, want = set(pairs), []
    while left:
        count = {}
        for p, s in left:
            count[s] = count.get(s, 0) + 1
        best = min(count, key=lambda s: (-count[s], s))
        want.append((best, count[best]))
        gone = {p for p, s in left if s == best}
        left = {(p, s) for p, s in left if p not in gone}
    assert got == want


def test_union_of_crowded_cells(spark):
    rng = np.random.default_rng(4)
    shapes = [[[np.round(K.orient([np.column_stack([x + np.array([0, 2, 1.0]), y + np.array([0, 0, 1.5])])])[0], 6)]] for x, y in rng.uniform(0, 6, (60, 2))]
    rows = [("e", " ,".join(f"{a} {b}" for a, b in np.vstack([s[0][0], s[0][0][:1]]))) for s in shapes]
    df = spark.createDataFrame(rows, "event_id string, pts string").select("event_id", G.from_wkt(F.concat(F.lit("POLYGON (("), "pts", F.lit("))"))).alias("geometry"))
    got = spatial.union_area(spatial.union_cells(df, ["event_id"], cell_size=1.7, run=4), ["event_id"]).first()["area"]
    assert got == pytest.approx(K.union_area([s[0] for s in shapes]), rel=1e-6)


def test_defensible_space_defaults(spark):
    text = '{"zones": [{"zoneId": 1, "zoneAreaSqft": 7.5, "riskObjects": []}, {"zoneAreaSqft": 3}]}'
    m = spark.range(1).select(includes.defensible_space_metrics(includes.parse_include("defensible_space", F.lit(text)), "us").alias("m")).first()["m"]
    assert m["defensible_space_zone_1_zone_area_sqft"] == 7.5 and m["defensible_space_zone_1_roof_area_sqft"] == 0.0
    assert len(m) == 7


@pytest.mark.parametrize("gridded", [False, True])
def test_rollup_of_clipped_roofs_equals_roof_table(spark, gridded):
    """The primary roof's recalculated components are the same in both outputs, named by the data alone."""
    raw = spark.read.json(os.path.join(HERE, "resources", "sample_area_features.json"))
    tile = '[{"description":"Roof material","components":[{"description":"Tile","classId":"tile","areaSqm":9,"areaSqft":97,"ratio":0.4,"confidence":0.5}]}]'
    f = raw.where(F.col("class_id").isin(ROOF, BUILDING)).withColumns({
        "geometry": G.from_wkt(F.col("geometry")), "damage": F.lit(None).cast("string"), "mesh_date": F.lit(None).cast("string"),
        "attributes": F.when(F.col("class_id") == ROOF, tile).otherwise("[]"),
    })
    kids = f.where(F.col("class_id") == ROOF).withColumns({
        "class_id": F.lit("tile"), "feature_id": F.concat(F.lit("k"), "feature_id"), "confidence": F.lit(0.75), "attributes": F.lit("[]"),
    })
    f = f.unionByName(kids)
    aois = spark.createDataFrame([("area",)], "aoi_id string").withColumn("geometry", G.box(F.lit(-112.0), F.lit(33.4), F.lit(-111.9), F.lit(33.5)))
    meta = spark.createDataFrame([("area", "gen6", "2025-10-24")], "aoi_id string, system_version string, survey_date string")
    inputs = export.ExportInputs(aois, f, meta, [rollup.FeatureClass(ROOF, "Roof"), rollup.FeatureClass(BUILDING, "Building")])
    linked = export.linked_features(inputs, "us")
    cells = aois.select("aoi_id", "geometry") if gridded else None
    row = export.parcel_tables(inputs, "us", linked=linked, gridded_aois=cells).first()
    roofs = {r["feature_id"]: r for r in export.roof_table(linked, "us", cells).collect()}
    want = roofs[row["primary_roof_feature_id"]]["roof_numbers"]
    assert row["primary_roof_tile_area_sqft"] == pytest.approx(want["tile_area_sqft"]) and want["tile_area_sqft"] > 97
    assert row["primary_roof_tile_ratio"] == pytest.approx(want["tile_ratio"]) == pytest.approx(1.0, abs=1e-6)


def test_primary_ids_equal_the_rollup_and_need_no_record(spark):
    rows = [("a", "f1", 5.0, 1.0), ("a", "f2", 5.0, 2.0), ("a", "f3", None, 9.0), ("b", "f4", None, None)]
    f = spark.createDataFrame(rows, "aoi_id string, feature_id string, clipped_area_sqm double, unclipped_area_sqm double")
    f = f.withColumns({"class_id": F.lit(ROOF), "area_sqm": F.lit(1.0), "confidence": F.lit(0.5), "fidelity": F.lit(0.5), "multiparcel_feature": F.lit(False)})
    ids = rollup.primary_ids(f, [ROOF], "au")
    assert sorted(map(tuple, ids.collect())) == [("a", ROOF, "f2"), ("b", ROOF, "f4")]
    assert "fidelity" not in ids._jdf.queryExecution().optimizedPlan().toString()


def test_boxes_meet_without_carrying_their_outline(spark):
    rows = [("a", 0.0, 0.0, 2.0, 2.0), ("b", 1.0, 1.0, 3.0, 3.0)]
    df = with_boxes(spark.createDataFrame(rows, "feature_id string, x1 double, y1 double, x2 double, y2 double")).withColumn("aoi_id", F.lit("1"))
    tilted = df.limit(1).select("aoi_id", F.lit("t").alias("feature_id"), G.from_wkt(F.lit("POLYGON((1 0,2 1,1 2,0 1,1 0))")).alias("geometry"))
    boxes = df.select("aoi_id", "feature_id", "geometry", "bbox")
    assert {(r.child_id, r.parent_id): round(r.iou, 6) for r in linking.iou_pairs(boxes, tilted, cell_size=0.5).collect()} == {("a", "t"): 0.5, ("b", "t"): round(0.5 / 5.5, 6)}
    packed = boxes.withColumn("_box", F.col("bbox")).select(linking._packed(boxes).alias("l")).select("l.geometry")
    assert packed.where(F.col("geometry").isNotNull()).isEmpty()


def test_copies_of_points_and_footprints_meet_once(spark):
    feet = boxes(spark, [("e1", 0, 0, 4, 4), ("e2", 0, 0, 2, 2)], "event_id string, x1 double, y1 double, x2 double, y2 double").crossJoin(spark.range(40)).drop("id")
    pts = spark.range(300).select("id", F.lit(1.0).alias("lon"), F.when(F.col("id") < 200, 1.0).when(F.col("id") < 299, 3.0).alias("lat"))
    got = coverage.count_footprints_at_points(pts, feet, "id", ["event_id"], cell_size=3.0)
    assert by(got.groupBy("event_id", "n").count(), "event_id", "n").keys() == {("e1", 40), ("e2", 40)}
    assert got.count() == 299 + 200
    tagged = feet.withColumns({"event_name": F.lit("n"), "event_type": F.lit("fire"), "event_date": F.when(F.col("event_id") == "e2", "2024-02-01").otherwise("2024-01-01")})
    latest = coverage.discover_events(pts, tagged, "id", cell_size=3.0).groupBy("event_id", "n_events").count()
    assert {tuple(r) for r in latest.collect()} == {("e2", 2, 200), ("e1", 1, 99)}
    # What meets is places x outlines, not points x footprints.
    shapes = tagged.groupBy("event_id", "geometry").count()
    assert coverage.footprints_at_points(coverage._places(pts, "lon", "lat"), shapes, "_place", cell_size=3.0).count() == 3


def test_merged_passes_do_not_sort_the_rows(spark):
    first = spark.createDataFrame([("a", 1), ("a", 2), ("b", 3), (None, 4)], "aoi_id string, x int")
    errors = spark.createDataFrame([("a", 404), ("a", 404), ("b", 404), ("c", 500)], "aoi_id string, status_code int")
    aois = spark.createDataFrame([("a", None), ("b", "pin"), ("c", None)], "aoi_id string, survey_resource_id string")
    retry = changes.retry_areas(errors, aois)
    out = changes.merge_passes(first, spark.createDataFrame([("a", 9)], "aoi_id string, x int"), retry)
    assert sorted(r.x for r in out.collect()) == [3, 4, 9]
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "ShuffledHashJoin" in plan and "SortMergeJoin" not in plan


def test_primary_carries_wanted_columns_only(spark):
    rows = [("a", "r", "f1", 2.0, 5.0, "x" * 50), ("a", "r", "f2", 3.0, 4.0, "y" * 50), ("a", "b", "f3", None, None, "z")]
    f = spark.createDataFrame(rows, "aoi_id string, class_id string, feature_id string, clipped_area_sqm double, unclipped_area_sqm double, note string")
    p = primary.select_primary(f, ["aoi_id", "class_id"], columns=["feature_id"])
    assert p.columns == ["aoi_id", "class_id", "feature_id"]
    assert sorted(tuple(r) for r in p.collect()) == [("a", "b", "f3"), ("a", "r", "f2")]
    assert primary.select_primary(f, ["aoi_id", "class_id"]).columns == f.columns
    plan = p._jdf.queryExecution().optimizedPlan().toString()
    assert "Aggregate" in plan and "note" not in plan.split("LogicalRDD")[0]


def test_long_form_computes_the_map_once(spark):
    from parcelweave.functions.maps import long_form

    made = F.map_from_arrays(F.array(F.col("k")), F.array(F.col("v") * 2))
    df = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "k string, v double").withColumn("m", F.when(F.col("k") != "b", made))
    out = long_form(df, ["k"], "m")
    assert [tuple(r) for r in out.collect()] == [("a", "a", 2.0)]
    assert out._jdf.queryExecution().optimizedPlan().toString().count("map_from_arrays") == 1


def test_grid_errors_take_boxes(spark):
    errors = spark.createDataFrame([("a", 1), ("a", 2)], "aoi_id string, cell_id int")
    box = F.struct(F.lit(0.0).alias("minx"), F.lit(0.0).alias("miny"), F.lit(2.0).alias("maxx"), F.lit(3.0).alias("maxy"))
    cells = spark.createDataFrame([("a", 1)], "aoi_id string, cell_id int").withColumn("cell_box", box)
    out = grid.grid_cell_errors(errors, cells).withColumn("area", G.area(F.col("geometry"))).collect()
    assert sorted((r.cell_id, r.area, r.failure_type) for r in out if r.geometry) == [(1, 6.0, "grid")] and len(out) == 2
