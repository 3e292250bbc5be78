"""Flattening nested payloads to columns."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelweave.config import FLAT_ROOF_DEPRECATED, METERS_TO_FEET, SQM_TO_SQFT
from parcelweave.functions.columns import age_years, dataset_id, effective_window, half_even, slug, snake, with_location_marker
from parcelweave.functions.maps import long_form
from parcelweave.operators import attributes as A
from parcelweave.operators import includes as I
from parcelweave.plans import export
from parcelweave.plans.registry import query
from parcelweave.plans.samples import ctes, half_even_sql as he
from parcelweave.session import spread
from parcelweave.sources import sinks

_KEY = "cast(p_partkey as string) as feature_id"


def _key():
    return F.col("p_partkey").cast("string").alias("feature_id")


def _json(t, text_by_case):
    """part rows with a payload text chosen by the key."""
    # Spread before the texts are made: the rows are few bytes each, so one task would read many of them.
    part = spread(t.part.select("p_partkey", "p_size", "p_retailprice", "p_name", "p_type"), "p_partkey")
    return part.select(_key(), "p_partkey", "p_size", "p_retailprice", "p_name", "p_type", text_by_case.alias("payload"))


# ------------------------------------------------------------------ include payloads
def _wind_payload():
    k = F.col("p_partkey")
    full = F.concat(
        F.lit('{"vulnerabilityScore": '), (k % 6).cast("string"), F.lit(', "riskScore": '), (k % 9).cast("string"),
        F.lit(', "femaVersion": "v'), (k % 3).cast("string"), F.lit('", "modelVersion": "m1", "modelInputFeatures": {"roofAge": '),
        F.col("p_size").cast("string"), F.lit(', "hipPresent": '), (k % 2).cast("string"), F.lit("}}"),
    )
    return (
        F.when(k % 7 == 0, F.lit(None)).when(k % 7 == 1, F.lit('{"skipped": true, "modelVersion": "m1"}'))
        .when(k % 7 == 2, F.lit("not json")).when(k % 7 == 3, F.lit("{}")).otherwise(full)
    )


@query("include_columns", f"""
select {_KEY}, case when r = 1 then true when r > 3 then false end as wind_score_skipped,
  cast(case when r > 3 then p_partkey % 6 end as double) as wind_vulnerability_score,
  cast(case when r > 3 then p_partkey % 9 end as double) as wind_risk_score,
  case when r > 3 then 'v' || cast(p_partkey % 3 as string) end as wind_fema_version,
  case when r = 1 or r > 3 then 'm1' end as wind_score_model_version
from (select *, p_partkey % 7 as r from part)""")
def include_columns(t):
    """Score payload → columns with a three-valued skip flag; malformed and empty count as absent."""
    df = _json(t, _wind_payload()).withColumn("wind_score", I.parse_include("wind_score", F.col("payload")))
    flat = I.flatten_includes(df, ("wind_score",))
    return flat.select("feature_id", "wind_score_skipped", "wind_vulnerability_score", "wind_risk_score", "wind_fema_version", "wind_score_model_version")


@query("include_model_inputs", f"""
select {_KEY}, metric, cast(value as double) as value from (select p_partkey, 'wind_vulnerability_model_input_roof_age' as metric, p_size as value from part
union all select p_partkey, 'wind_vulnerability_model_input_hip_present', p_partkey % 2 from part) where p_partkey % 7 > 3""")
def include_model_inputs(t):
    """Open model-input maps in long form."""
    df = _json(t, _wind_payload()).withColumn("wind_score", I.parse_include("wind_score", F.col("payload")))
    return long_form(df.withColumn("m", I.model_inputs("wind_score", F.col("wind_score"))), ["feature_id"], "m")


@query("include_skips", """
select cast(user_id as string) as aoi_id, count(*) filter (event_type = 'error') > 0 as wind_score_skipped,
  count(*) filter (event_type = 'click' and value > 2e2) > 0 as hail_score_skipped from events group by user_id
having count(*) filter (event_type = 'error') > 0 or count(*) filter (event_type = 'click' and value > 2e2) > 0""")
def include_skips(t):
    """Areas where any include was skipped."""
    df = t.events.select(
        F.col("user_id").cast("string").alias("aoi_id"), F.when(F.col("event_type") != "view", F.col("event_type") == "error").alias("wind_score_skipped"),
        ((F.col("event_type") == "click") & (F.col("value") > 200.0)).alias("hail_score_skipped"),
    )
    return I.skip_flags(df, ["aoi_id"]).drop("skipped_includes")


@query("include_skip_counts", """
select count(*) filter (event_type = 'error') as wind_score_skipped_count, count(*) filter (value > 2e2) as hail_score_skipped_count from events""")
def include_skip_counts(t):
    """Number of skipped features per include."""
    return I.skip_counts(t.events.select((F.col("event_type") == "error").alias("wind_score_skipped"), (F.col("value") > 200.0).alias("hail_score_skipped")))


def _zones_payload():
    k = F.col("p_partkey")
    zone = lambda z, risk: F.concat(
        F.lit(f'{{"zoneId": {z}, "zoneAreaSqm": '), F.col("p_size").cast("string"), F.lit(', "defensibleSpaceCoverageRatio": 0.25, "riskObjects": ['),
        risk, F.lit("]}"),
    )
    roof = F.concat(F.lit('{"description": "Roof", "areaSqm": '), (k % 11).cast("string"), F.lit(', "ratio": 0.5}'))
    shed = F.lit('{"description": "Wood Pile", "areaSqm": 3}')
    full = F.concat(F.lit('{"zones": ['), zone(1, roof), F.lit(", "), zone(0, F.lit("")), F.lit(", "), zone(2, shed), F.lit('], "modelVersion": "d2"}'))
    return F.when(k % 5 == 0, F.lit('{"skipped": true}')).when(k % 5 == 1, F.lit(None)).otherwise(full)


def _zones_sql(prefix: str) -> str:
    rows = []
    for z in (0, 1, 2):
        rows += [(z, "zone_area_sqm", "p_size"), (z, "coverage_ratio", "25e-2")]
        for c in ("medium_and_high_vegetation_with_woody_vegetation", "roof", "yard_debris"):
            hit = z == 1 and c == "roof"
            rows += [(z, f"{c}_area_sqm", "p_partkey % 11" if hit else "0"), (z, f"{c}_ratio", "5e-1" if hit else "0")]
    rows += [(2, "wood_pile_area_sqm", "3"), (2, "wood_pile_ratio", "0")]
    parts = [f"select p_partkey, '{prefix}_{z}_{m}' as metric, cast({v} as double) as value from part" for z, m, v in rows]
    return f"select {_KEY}, metric, value from ({' union all '.join(parts)}) where p_partkey % 5 > 1"


@query("defensible_space_zones", _zones_sql("defensible_space_zone"))
def defensible_space_zones(t):
    """Zone metrics in long form; known risk classes default to 0.0."""
    df = _json(t, _zones_payload())
    # A column of its own, so that it is parsed once and not wherever the metrics name it.
    parsed = df.withColumn("zones", I.parse_include("defensible_space", F.col("payload")))
    return long_form(parsed.withColumn("m", I.defensible_space_metrics(F.col("zones"), "au")), ["feature_id"], "m")


@query("aggregate_zones", f"""
select cast(p_partkey as string) as aoi_id, case when r > 0 then r = 1 end as aggregate_defensible_space_skipped,
  cast(case when r = 2 then p_size end as double) as zone_1_area, cast(case when r = 2 then p_partkey % 11 end as double) as zone_1_roof
from (select *, case when p_partkey % 5 = 0 then 1 when p_partkey % 5 = 1 then 0 else 2 end as r from part)""")
def aggregate_zones(t):
    """Area-level defensible space from metadata."""
    m = t.part.select(
        F.col("p_partkey").cast("string").alias("aoi_id"), F.concat(F.lit('{"defensibleSpace": '), F.coalesce(_zones_payload(), F.lit("null")), F.lit("}")).alias("aggregate")
    )
    z = export.aggregate_zones(m, "au")
    return z.select(
        "aoi_id", "aggregate_defensible_space_skipped", F.col("aggregate_defensible_space_zone_1_zone_area_sqm").alias("zone_1_area"),
        F.col("aggregate_defensible_space_zone_1_roof_area_sqm").alias("zone_1_roof"),
    )


# ------------------------------------------------------------------ roofs
def _roof_attributes():
    k = F.col("p_partkey")
    comp = lambda d, cid, area, ratio, extra="": F.concat(
        F.lit(f'{{"description": "{d}", "classId": "{cid}", "areaSqm": '), area.cast("string"), F.lit(', "confidence": 0.75, "ratio": '),
        ratio.cast("string"), F.lit(extra + "}"),
    )
    stats = ', "dominant": true, "confidenceStats": {"histograms": [{"binType": "default", "ratios": [0.25, 0.5]}, {"binType": "fine", "ratios": null}]}'
    r = k % 5
    return F.concat(
        F.lit('[{"description": "Roof material", "components": ['), comp("Metal", "m1", F.col("p_size"), r / 10.0, stats), F.lit(", "),
        comp("Clay Tile", "m2", k % 3, (4 - r) / 10.0 + 0.2), F.lit(']}, {"description": "Roof types", "components": ['),
        comp("Shed", "s1", F.lit(9), F.lit(0.9)), F.lit(", "), comp("Old Flat", FLAT_ROOF_DEPRECATED, F.lit(9), F.lit(0.8)), F.lit(", "),
        comp("Hip", "s2", k % 2, F.lit(0.1)), F.lit(']}, {"description": "Low confidence parts", "components": ['),
        comp("Rust", "x", k % 4, F.lit(0.3)), F.lit(']}, {"description": "3d", "has3dAttributes": '),
        F.when(k % 2 == 0, F.lit('true, "pitch": 12.5')).otherwise(F.lit("false")), F.lit("}]"),
    )


@query("roof_dominant", f"""
select {_KEY}, case when m >= 5e-1 or c >= 5e-1 then case when m >= c then 'metal' else 'clay_tile' end else 'unknown' end as material,
  case when m >= 5e-1 or c >= 5e-1 then case when m >= c then 'm1' else 'm2' end end as material_class,
  case when m >= 5e-1 or c >= 5e-1 then greatest(m, c) end as material_ratio,
  case when p_partkey % 2 > 0 then 'hip' else 'unknown' end as shape, cast(case when p_partkey % 2 > 0 then 1 end as double) as shape_area,
  case when p_partkey % 2 = 0 then 'Y' else 'N' end as has_3d, case when p_partkey % 2 = 0 then 125e-1 end as pitch
from (select *, (p_partkey % 5) / 1e1 as m, (4 - p_partkey % 5) / 1e1 + 2e-1 as c from part)""")
def roof_dominant(t):
    """Dominant material and shape with their unknown rules; retired shapes never win."""
    f = A.flatten_roofs(_json(t, F.lit(None)).withColumn("attributes", _roof_attributes()), "au")
    return f.select(
        "feature_id", F.col("dominant_roof_material_description").alias("material"), F.col("dominant_roof_material_feature_class").alias("material_class"),
        F.col("dominant_roof_material_ratio").alias("material_ratio"), F.col("dominant_roof_types_description").alias("shape"),
        F.col("dominant_roof_types_area_sqm").alias("shape_area"), F.col("has_3d_attributes").alias("has_3d"), F.col("pitch_degrees").alias("pitch"),
    )


_COMPONENTS = [
    ("metal", "p_size", "(p_partkey % 5) / 1e1"), ("clay_tile", "p_partkey % 3", "(4 - p_partkey % 5) / 1e1 + 2e-1"), ("shed", "9", "9e-1"),
    ("old_flat", "9", "8e-1"), ("hip", "p_partkey % 2", "1e-1"), ("low_conf_rust", "p_partkey % 4", "3e-1"),
]


@query("roof_component_numbers", "select cast(p_partkey as string) as feature_id, metric, cast(value as double) as value from (" + " union all ".join(
    [f"select p_partkey, '{n}_{m}' as metric, {v} as value from part" for n, a, r in _COMPONENTS for m, v in (("area_sqm", a), ("ratio", r), ("confidence", "75e-2"))]
    + [f"select p_partkey, 'metal_confidence_stats_default_bin_{i}', {v} from part" for i, v in enumerate(("25e-2", "5e-1"))]) + ")")
def roof_component_numbers(t):
    """Areas, ratios, confidences and histogram bins of all components, long form."""
    f = A.flatten_roofs(_json(t, F.lit(None)).withColumn("attributes", _roof_attributes()), "au")
    return long_form(f, ["feature_id"], "roof_numbers")


@query("roof_component_texts", "select cast(p_partkey as string) as feature_id, metric, value from (" + " union all ".join(
    [f"select p_partkey, '{n}_present' as metric, case when {a} > 0 then 'Y' else 'N' end as value from part" for n, a, r in _COMPONENTS]
    + ["select p_partkey, 'metal_dominant', 'Y' from part"]) + ")")
def roof_component_texts(t):
    """Presence and dominance flags of all components, long form."""
    f = A.flatten_roofs(_json(t, F.lit(None)).withColumn("attributes", _roof_attributes()), "au")
    return long_form(f, ["feature_id"], "roof_texts")


@query("pool_components", """
select cast(p_partkey as string) as feature_id, cast(p_size as double) as algae_area_sqm, case when p_size > 20 then 'Y' else 'N' end as empty_present,
  6e-1 as algae_confidence from part""")
def pool_components(t):
    """Pool condition components as declared columns."""
    attrs = F.concat(
        F.lit('[{"description": "Pool condition", "components": [{"description": "Algae", "areaSqm": '), F.col("p_size").cast("string"),
        F.lit(', "confidence": 0.6}, {"description": "Empty", "areaSqm": '), F.greatest(F.col("p_size") - 20, F.lit(0)).cast("string"), F.lit(', "confidence": 0.5}]}]'),
    )
    f = A.flatten_pools(_json(t, F.lit(None)).withColumn("attributes", attrs), "au")
    return f.select(
        "feature_id", F.col("pool_numbers")["algae_area_sqm"].alias("algae_area_sqm"), F.col("pool_texts")["empty_present"].alias("empty_present"),
        F.col("pool_numbers")["algae_confidence"].alias("algae_confidence"),
    )


# ------------------------------------------------------------------ buildings
@query("building_3d", f"""
select {_KEY}, case when r = 0 then null when r = 1 then 'N' else 'Y' end as has_3d_attributes,
  case when r > 1 then {he(f'p_size * cast({METERS_TO_FEET!r} as double)', 1)} end as height_ft,
  case when r > 1 then 5e-1 end as storey_2, case when r > 2 then {he('p_retailprice / 1e2', 2)} end as pitch_degrees,
  case when r > 2 then {he(f'p_partkey * cast({METERS_TO_FEET!r} as double)', 1)} end as ground_height_ft
from (select *, p_partkey % 4 as r from part)""")
def building_3d(t):
    """Height, storeys, pitch and ground height in the country's unit."""
    k, r = F.col("p_partkey"), F.col("p_partkey") % 4
    main = F.when(r == 1, F.lit('{"description": "Building 3d attributes", "has3dAttributes": false}')).otherwise(F.concat(
        F.lit('{"description": "Building 3d attributes", "has3dAttributes": true, "numStories": {"1": 0.25, "2": 0.5}, "height": '), F.col("p_size").cast("string"), F.lit("}")))
    more = F.concat(
        F.lit(', {"description": "Building pitch", "available": true, "value": '), (F.col("p_retailprice") / 100.0).cast("string"),
        F.lit('}, {"description": "Ground height", "available": true, "value": '), k.cast("string"), F.lit("}"),
    )
    none = F.lit(', {"description": "Building pitch", "available": false}')
    attrs = F.when(r == 0, F.lit("[]")).otherwise(F.concat(F.lit("["), main, F.when(r > 2, more).otherwise(none), F.lit("]")))
    f = A.flatten_buildings(_json(t, F.lit(None)).withColumn("attributes", attrs), "us")
    return f.select("feature_id", "has_3d_attributes", "height_ft", F.col("storeys")["num_storeys_2_confidence"].alias("storey_2"), "pitch_degrees", "ground_height_ft")


def _damage_payload():
    k = F.col("p_partkey")
    return F.when(k % 4 == 0, F.lit(None)).when(k % 4 == 1, F.lit('{"ratios": []}')).otherwise(F.concat(
        F.lit('{"confidences": {"raw": {"Undamaged": '), (k % 10 / 10.0).cast("string"), F.lit(', "Minor": '), (F.col("p_size") % 10 / 10.0).cast("string"),
        F.lit('}, "2tier": {"MajorOrDestroyed": 0.125}, "3tier": {"Low": 0.375}}, "ratios": [{"description": "Missing Tile", "ratioAbove50PctConf": 0.5}, {"description": "None"}]}'),
    ))


@query("lifecycle_damage", f"""
select {_KEY}, case when u >= m then 'Undamaged' else 'Minor' end as damage_class, greatest(u, m) as damage_class_confidence,
  125e-3 as two_tier, 5e-1 as missing_tile from (select *, p_partkey % 10 / 1e1 as u, p_size % 10 / 1e1 as m from part where p_partkey % 4 > 1)
union all select {_KEY}, null, null, null, null from part where p_partkey % 4 < 2""")
def lifecycle_damage(t):
    """Most likely damage class (first wins ties) and per-class values."""
    f = A.flatten_lifecycle_damage(_json(t, F.lit(None)).withColumn("damage", _damage_payload()))
    return f.select(
        "feature_id", "damage_class", "damage_class_confidence", F.col("damage_numbers")["damage_2tier_MajorOrDestroyed_confidence"].alias("two_tier"),
        F.col("damage_numbers")["damage_ratio_missing_tile"].alias("missing_tile"),
    )


@query("damage_dotted", " union all ".join(
    f"select cast(p_partkey as string) as feature_id, '{m}' as metric, {v} as value from part where p_partkey % 4 > 1" for m, v in (
        ("damage.confidences.raw.Undamaged", "p_partkey % 10 / 1e1"), ("damage.confidences.raw.Minor", "p_size % 10 / 1e1"),
        ("damage.confidences.2tier.MajorOrDestroyed", "125e-3"), ("damage.confidences.3tier.Low", "375e-3"), ("damage.ratios.Missing Tile", "5e-1"))))
def damage_dotted(t):
    """The same payload with dotted names over three tiers."""
    return long_form(_json(t, _damage_payload()).withColumn("m", A.damage_dotted(F.col("payload"))), ["feature_id"], "m")


@query("conflated_damage", f"""
select {_KEY}, case p_partkey % 3 when 0 then 'Major' else 'NoDamage' end as damage_event_rating, p_size / 1e2 as damage_event_raw_major,
  '[{{"a":1}}]' as damage_event_class_ratios, case when p_partkey % 2 = 0 then 'Minor' end as damage_pre_event_rating,
  case when p_partkey % 2 = 0 then '2024-01-02' end as damage_pre_event_latest_capture_date, cast(null as double) as damage_pre_event_raw_no_damage from part""")
def conflated_damage(t):
    """Fixed columns of post-event and pre-event blocks; an absent block is all NULL."""
    rating = F.when(F.col("p_partkey") % 3 == 0, "Major").otherwise("NoDamage")
    pre = F.when(F.col("p_partkey") % 2 == 0, F.lit('{"rating": "Minor", "latestCaptureDate": "2024-01-02"}')).otherwise(F.lit("null"))
    text = F.concat(
        F.lit('{"event": {"rating": "'), rating, F.lit('", "rawRatings": {"Major": '), (F.col("p_size") / 100.0).cast("string"),
        F.lit('}, "classRatios": [{"a":1}]}, "preEvent": '), pre, F.lit("}"),
    )
    d = F.from_json(text, f"struct<event:{A.DAMAGE_BLOCK},preEvent:{A.DAMAGE_BLOCK}>")
    staged = t.part.select(_key(), d.alias("d"))
    c = A.conflated_damage_columns(F.col("d"))
    names = ("damage_event_rating", "damage_event_raw_major", "damage_event_class_ratios", "damage_pre_event_rating",
             "damage_pre_event_latest_capture_date", "damage_pre_event_raw_no_damage")
    return staged.select("feature_id", *[c[n].alias(n) for n in names])


@query("attributes_dotted", " union all ".join(
    f"select cast(p_partkey as string) as feature_id, '{m}' as metric, {v} as value from part" for m, v in (
        ("Size.value", "cast(p_size as string)"), ("Size.numStories.1", "'0.5'"), ("attr_1.flag", "'true'"),
        ("Roof.components", """'[{"description":"Metal","areaSqm":' || cast(p_size as string) || '}]'"""))))
def attributes_dotted(t):
    """Generic attribute list with dotted names; internal ids left out."""
    text = F.concat(
        F.lit('[{"description":"Size","internalClassId":7,"value":'), F.col("p_size").cast("string"), F.lit(',"numStories":{"1":0.5,"2":null}},{"flag":true},'),
        F.lit('{"description":"Roof","components":[{"internalClassId":5,"description":"Metal","areaSqm":'), F.col("p_size").cast("string"), F.lit("}]}]"),
    )
    return long_form(_json(t, text).withColumn("m", A.attribute_list_dotted(F.col("payload"))), ["feature_id"], "m")


# ------------------------------------------------------------------ roof instances and dates
@query("roof_instance_columns", f"""
select cast(l_orderkey as string) as aoi_id, l_linenumber, l_partkey, l_suppkey,
  case when l_partkey % 6 = 0 then null else o end as roof_age_installation_date, s as roof_age_as_of_date,
  case when l_partkey % 6 <> 0 and l_partkey % 5 <> 0 then {he("date_diff('day', cast(o_orderdate as date), cast(l_shipdate as date)) / cast(365.25 as double)", 1)} end as roof_age_years_as_of_date,
  case when l_suppkey % 3 = 0 then null when l_suppkey % 3 = 1 then 'Y' else 'N' end as roof_age_relevant_permits
from (select *, case when l_partkey % 5 = 0 then 'unknown' else cast(cast(o_orderdate as date) as string) end as o,
  cast(cast(l_shipdate as date) as string) as s from lineitem join orders on l_orderkey = o_orderkey)""")
def roof_instance_columns(t):
    """Canonical record columns; as-of date falls back to the until date; bad dates give no age."""
    j = t.lineitem.join(t.orders.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    ship = F.col("l_shipdate").cast("date").cast("string")
    installed = F.when(F.col("l_partkey") % 5 == 0, "unknown").otherwise(F.col("o_orderdate").cast("date").cast("string"))
    rows = j.select(
        F.col("l_orderkey").cast("string").alias("aoi_id"), "l_linenumber", "l_partkey", "l_suppkey",
        F.when(F.col("l_partkey") % 6 != 0, installed).alias("installation_date"),
        F.when(F.col("l_linenumber") % 2 == 0, ship).alias("as_of_date"), ship.alias("until_date"),
        F.when(F.col("l_suppkey") % 3 != 0, F.col("l_suppkey") % 3 == 1).alias("relevant_permits"),
    )
    c = A.roof_instance_columns(rows.columns)
    names = ("roof_age_installation_date", "roof_age_as_of_date", "roof_age_years_as_of_date", "roof_age_relevant_permits")
    return rows.select("aoi_id", "l_linenumber", "l_partkey", "l_suppkey", *[c[n].alias(n) for n in names])


@query("roof_age_years", f"""
select l_orderkey, l_linenumber, l_partkey, l_suppkey, {he("date_diff('day', cast(o_orderdate as date), cast(l_shipdate as date)) / cast(365.25 as double)", 1)} as years
from lineitem join orders on l_orderkey = o_orderkey""")
def roof_age_years(t):
    """Age in Julian years, one decimal, half to even."""
    j = t.lineitem.join(t.orders.select("o_orderkey", "o_orderdate"), F.col("l_orderkey") == F.col("o_orderkey"))
    y = age_years(F.col("o_orderdate").cast("date").cast("string"), F.col("l_shipdate").cast("date").cast("string"))
    return j.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", y.alias("years"))


@query("effective_windows", """
select cast(o_orderkey as string) as aoi_id, case r when 0 then '2020-01-01' when 1 then null else d end as since_features,
  case when r < 2 then '2020-01-01' else d end as since_roof_age
from (select *, o_orderkey % 3 as r, cast(cast(o_orderdate as date) as string) as d from orders)""")
def effective_windows(t):
    """Per-area date overrides; an empty text lifts the limit for features only."""
    r = F.col("o_orderkey") % 3
    own = F.when(r == 1, F.lit("")).when(r == 2, F.col("o_orderdate").cast("date").cast("string"))
    return t.orders.select(
        F.col("o_orderkey").cast("string").alias("aoi_id"), effective_window(own, "2020-01-01").alias("since_features"),
        effective_window(own, "2020-01-01", empty_is_unset=True).alias("since_roof_age"),
    )


@query("scalar_texts", """
select p_partkey, regexp_replace(lower(p_name || '--' || p_type), '[^a-z0-9]+', '_', 'g') as slug, 'cap_ture_date' as snake,
  case when p_partkey % 2 = 0 then 'u?locationMarker' else '' end as link, case when p_partkey % 2 = 0 then 'cf6bf06a-c8f7-58bd-9b1e-bce8e089a9bc' else p_type end as dataset from part""")
def scalar_texts(t):
    """Slugs, snake case, link markers and dataset aliases."""
    even = F.col("p_partkey") % 2 == 0
    return t.part.select(
        "p_partkey", slug(F.concat(F.col("p_name"), F.lit("--"), F.col("p_type"))).alias("slug"), snake(F.lit("capTureDate")).alias("snake"),
        with_location_marker(F.when(even, F.when(F.col("p_partkey") % 4 == 0, "u").otherwise("u?locationMarker")).otherwise("")).alias("link"),
        dataset_id(F.when(even, "A.1").otherwise(F.col("p_type"))).alias("dataset"),
    )


@query("rounded_confidence", ctes("features") + f"select aoi_id, feature_id, {he('confidence / 3e0', 2)} as confidence, {he(f'area_sqm * cast({SQM_TO_SQFT!r} as double)', 1)} as area_sqft from features")
def rounded_confidence(t):
    """Confidence to two decimals, and square feet for imperial countries."""
    f = sinks.with_instance_sqft(t.features(), "us")
    return f.select("aoi_id", "feature_id", half_even(F.col("confidence") / 3.0, 2).alias("confidence"), half_even(F.col("area_sqft"), 1).alias("area_sqft"))
