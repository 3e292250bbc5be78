"""Rollups, primary features and score statistics."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelweave.config import (
    BUILDING,
    BUILDING_LIFECYCLE,
    BUILDING_STYLE_CLASSES,
    POOL,
    PRIMARY_CLASSES,
    PRIMARY_ID_COLUMNS,
    ROOF,
    ROOF_INSTANCE,
)
from parcelweave.functions.columns import half_even
from parcelweave.operators import chains, damage, primary, rollup
from parcelweave.plans.registry import query
from parcelweave.plans.samples import CATALOGUE, CLASS_CODES, ctes, half_even_sql as he, with_boxes

FEATURE_CLASS_IDS = [c.class_id for c in CATALOGUE if c.class_id != ROOF_INSTANCE]


@query("select_classes", """
select p_partkey as class_id, p_name as description from part
where p_size % 4 <> 0 and (p_type in ('PROMO', 'ECONOMY') or p_brand = 'Brand#13')""")
def select_classes(t):
    """Classes of three packs; a class may be in several, and one of another type is left out."""
    ids = F.col("p_partkey").alias("class_id")
    kind = F.when(F.col("p_size") % 4 == 0, "Region").otherwise("Feature").alias("type")
    classes = t.part.select(ids, F.col("p_name").alias("description"), kind)
    packs = t.part.select(F.col("p_type").alias("pack"), ids).unionByName(t.part.select(F.col("p_brand").alias("pack"), ids))
    return rollup.select_classes(classes, packs, ["PROMO", "ECONOMY", "Brand#13"]).drop("type")


def _observed_sql(c) -> str:
    if c.class_id == ROOF_INSTANCE:
        return "r_ok"
    if c.availability is None:
        return "f_ok"
    versions = [v for v, s in c.availability if s == "prod"]
    known = f"version in ({', '.join(repr(v) for v in versions)})" if versions else "false"
    return f"(f_ok and (version is null or {known}))"


def _rollup_sql() -> str:
    cols, out = [], []
    for i, c in enumerate(CATALOGUE):
        n, seen = c.name, _observed_sql(c)
        here = f"class_id = '{c.class_id}'"
        ri = c.class_id == ROOF_INSTANCE
        countable = f"{here} and kind = 'roof'" if ri else here
        area = "area_sqm" if ri else "clipped_area_sqm"
        cols += [
            f"count(*) filter ({countable}) as n{i}",
            f"coalesce(sum(area_sqm) filter ({countable}), 0e0) as a{i}",
            f"coalesce(sum(clipped_area_sqm) filter ({here}), 0e0) as c{i}",
            f"coalesce(sum(unclipped_area_sqm) filter ({here}), 0e0) as u{i}",
            f"1e0 - product(1e0 - confidence) filter ({here}) as p{i}",
            f"count(*) filter ({here} and multiparcel_feature) as m{i}",
            f"count(*) filter ({here}) as k{i}",
            "first(struct_pack(f := feature_id, area := area_sqm, clipped := clipped_area_sqm, unclipped := unclipped_area_sqm, "
            f"conf := confidence, fid := fidelity, multi := multiparcel_feature) order by "
            + ("(kind <> 'roof'), " if ri else "")
            + f"{area} desc nulls last, " + ("" if ri else "unclipped_area_sqm desc nulls last, ")
            + f"feature_id) filter ({here}) as t{i}",
        ]

        def put(name, expr, gated=True):
            out.append(f"""{f'case when {seen} then {expr} end' if gated else expr} as "{name}" """)

        put(f"{n}_present", f"case when coalesce(n{i}, 0) > 0 then 'Y' else 'N' end")
        put(f"{n}_count", f"coalesce(n{i}, 0)")
        put(f"{n}_total_area_sqm", he(f"coalesce(a{i}, 0e0)", 2))
        if not ri:
            put(f"{n}_total_clipped_area_sqm", he(f"coalesce(c{i}, 0e0)", 1))
            put(f"{n}_total_unclipped_area_sqm", he(f"coalesce(u{i}, 0e0)", 1))
            put(f"{n}_confidence", he(f"case when k{i} > 0 then p{i} end", 2))
        if c.class_id in BUILDING_STYLE_CLASSES:
            put(f"{n}_multiparcel_feature_count", f"m{i}")
        if c.class_id in PRIMARY_CLASSES:
            put(f"primary_{n}_area_sqm", f"coalesce({he(f't{i}.area', 1)}, 0e0)")
            if not ri:
                put(f"primary_{n}_clipped_area_sqm", f"coalesce({he(f't{i}.clipped', 1)}, 0e0)")
                put(f"primary_{n}_unclipped_area_sqm", f"coalesce({he(f't{i}.unclipped', 1)}, 0e0)")
                put(f"primary_{n}_confidence", he(f"t{i}.conf", 2))
            if c.class_id in BUILDING_STYLE_CLASSES:
                if not ri:
                    put(f"primary_{n}_fidelity", f"t{i}.fid", gated=False)
                put(f"primary_{n}_multiparcel_feature", f"case when t{i}.multi then 'Y' when not t{i}.multi then 'N' end", gated=False)
            put(f"primary_{n}_feature_id", f"t{i}.f", gated=False)
    return (
        ctes("features", "aois", "metadata")
        + f", g as (select aoi_id, {', '.join(cols)} from features group by aoi_id), "
        + "b as (select a.aoi_id, m.aoi_id is not null as f_ok, m.system_version as version, o_orderkey % 13 <> 0 as r_ok, g.* exclude (aoi_id) "
        + "from aois a left join g using (aoi_id) left join metadata m using (aoi_id)) "
        + f"select aoi_id, {', '.join(out)} from b"
    )


@query("parcel_rollup", _rollup_sql())
def parcel_rollup(t):
    """One row per order with all class metrics; failed and unreturnable classes are NULL."""
    ages = t.aois().where(F.col("o_orderkey") % 13 != 0).select("aoi_id")
    apis = [rollup.ApiResult(t.metadata(), FEATURE_CLASS_IDS), rollup.ApiResult(ages, [ROOF_INSTANCE])]
    out = rollup.parcel_rollup(t.aois(), t.features(), CATALOGUE, "au", api_results=apis)
    # Area totals are plain sums; two decimals make them comparable between engines.
    return out.withColumns({c: half_even(F.col(c), 2) for c in out.columns if c.endswith("_total_area_sqm")})


@query("class_metrics", ctes("features") + f"""
select aoi_id, class_id, count(*) as n, {he('sum(area_sqm)', 2)} as area, {he('sum(clipped_area_sqm)', 1)} as clipped,
       {he('1e0 - product(1e0 - confidence)', 2)} as confidence, count(*) filter (multiparcel_feature) as multiparcel
from features where class_id <> '{ROOF_INSTANCE}' group by all""")
def class_metrics(t):
    """Count, areas and noisy-or confidence per (area, class)."""
    m = rollup.class_metrics(t.features().where(F.col("class_id") != ROOF_INSTANCE), "au")
    return m.select(
        "aoi_id", "class_id", F.col("count").cast("bigint").alias("n"), half_even(F.col("area"), 2).alias("area"), "clipped",
        half_even(F.col("confidence"), 2).alias("confidence"), "multiparcel",
    )


@query("roof_instance_metrics", ctes("features") + f"""
select aoi_id, count(*) filter (kind = 'roof') as n, {he("coalesce(sum(area_sqm) filter (kind = 'roof'), 0e0)", 2)} as area
from features where class_id = '{ROOF_INSTANCE}' group by aoi_id""")
def roof_instance_metrics(t):
    """Only records of kind 'roof' count."""
    m = rollup.class_metrics(t.features().where(F.col("class_id") == ROOF_INSTANCE), "au")
    return m.select("aoi_id", F.col("count").cast("bigint").alias("n"), half_even(F.col("area"), 2).alias("area"))


_DIST = """
, d as (select f.*, a.lon, a.lat,
  case when a.lon is not null and a.lat is not null and clipped_area_sqm > 30e0 then
    sqrt(power(greatest(f.x1 - a.lon, 0e0, a.lon - f.x2), 2) + power(greatest(f.y1 - a.lat, 0e0, a.lat - f.y2), 2)) end as dist
  from features f join aois a using (aoi_id)),
k as (select *, case when dist = 0 then 0 when dist <= 1e0 then 1 else 2 end as tier,
  case when confidence >= 9e-1 then 0 else 1 end as unsure from d)
"""
_RANK = """row_number() over (partition by aoi_id, class_id order by tier, case when tier < 2 then unsure else 0 end,
  case when tier = 1 then dist else 0 end, case when tier = 2 then clipped_area_sqm end desc nulls last,
  case when tier = 2 then unclipped_area_sqm end desc nulls last, feature_id)"""


@query("primary_largest", ctes("features") + """
select aoi_id, class_id, feature_id, clipped_area_sqm from (select *, row_number() over (partition by aoi_id, class_id
order by clipped_area_sqm desc nulls last, unclipped_area_sqm desc nulls last, feature_id) as rn from features) where rn = 1""")
def primary_largest(t):
    """Largest feature per (area, class)."""
    return primary.select_primary(t.features(), ["aoi_id", "class_id"], columns=["feature_id", "clipped_area_sqm"])


def _by_point(t, method):
    f = t.features().select("aoi_id", "class_id", "feature_id", "clipped_area_sqm", "unclipped_area_sqm", "confidence", "x1", "y1", "x2", "y2")
    # Outlines are made where the areas have met, and do not travel.
    f = with_boxes(f.join(t.aois().select("aoi_id", "lat", "lon"), "aoi_id"))
    return primary.select_primary(f, ["aoi_id", "class_id"], method, planar=True, columns=["feature_id"])


@query("primary_optimal", ctes("features", "aois") + _DIST + f"select aoi_id, class_id, feature_id from (select *, {_RANK} as rn from k) where rn = 1")
def primary_optimal(t):
    """Containing the target, else within tolerance, else largest."""
    return _by_point(t, "optimal")


@query("primary_nearest", ctes("features", "aois") + _DIST + f"""
select aoi_id, class_id, feature_id from (select *, {_RANK} as rn from k where tier < 2 or lon is null or lat is null) where rn = 1""")
def primary_nearest(t):
    """Containing or near the target only; largest where there is no target."""
    return _by_point(t, "nearest")


@query("primary_roof_instance", ctes("features") + f"""
, roofs as (select aoi_id, min(feature_id) as linked from features where class_id = '{ROOF_INSTANCE}' and l_partkey % 2 = 0 group by aoi_id)
select aoi_id, feature_id from (select f.aoi_id, f.feature_id, row_number() over (partition by f.aoi_id order by
  case when f.feature_id = linked then 0 when kind = 'roof' then 1 else 2 end, area_sqm desc nulls last, feature_id) as rn
  from features f left join roofs using (aoi_id) where class_id = '{ROOF_INSTANCE}') where rn = 1""")
def primary_roof_instance(t):
    """The primary roof's linked record first, then roof records, then any."""
    ri = t.features().where(F.col("class_id") == ROOF_INSTANCE)
    linked = ri.where(F.col("l_partkey") % 2 == 0).groupBy("aoi_id").agg(F.min("feature_id").alias("linked"))
    rows = ri.join(linked, "aoi_id", "left")
    p = primary.select_primary(
        rows, ["aoi_id"], area_col="area_sqm", secondary_col=None, rank_first=primary.linked_instance_rank(F.col("linked"))
    )
    return p.select("aoi_id", "feature_id")


@query("mark_primary", ctes("features") + """
select aoi_id, feature_id, class_id, row_number() over (partition by aoi_id, class_id order by clipped_area_sqm desc nulls last,
unclipped_area_sqm desc nulls last, feature_id) = 1 and class_id in ({}) as is_primary from features""".format(
    ", ".join(f"'{c}'" for c in (ROOF, BUILDING, BUILDING_LIFECYCLE, POOL))))
def mark_primary(t):
    """``is_primary`` from the rollup's primary ids."""
    cat = [c for c in CATALOGUE if c.class_id in (ROOF, BUILDING, BUILDING_LIFECYCLE, POOL)]
    r = rollup.parcel_rollup(t.aois(), t.features(), cat, "au")
    marked = primary.mark_primary(t.features(), primary.stack_primary_ids(r, PRIMARY_ID_COLUMNS))
    return marked.select("aoi_id", "feature_id", "class_id", "is_primary")


@query("weighted_range", ctes("features") + f"""
select aoi_id, min(v) as v_min, max(v) as v_max, {he('sum(v * w) / nullif(sum(case when v is not null then w end), 0e0)', 1)} as v_area_weighted_mean
from (select aoi_id, case when l_partkey % 4 <> 0 then cast(l_partkey % 100 as double) end as v,
      coalesce(case when l_suppkey % 5 <> 0 then l_quantity end, 0e0) as w from features) group by aoi_id""")
def weighted_range(t):
    """Min, max and area-weighted mean; NULL values and NULL weights."""
    v = t.features().select(
        "aoi_id", F.when(F.col("l_partkey") % 4 != 0, (F.col("l_partkey") % 100).cast("double")).alias("v"),
        F.when(F.col("l_suppkey") % 5 != 0, F.col("l_quantity")).alias("w"),
    )
    return rollup.weighted_range(v, ["aoi_id"], ["v"], "w", {"v": 1})


@query("class_returnable", """
select cast(l_orderkey as string) as aoi_id, l_linenumber,
  (v is null or v = '' or l_linenumber % 4 = 0 or (v = 'gen5' and l_linenumber % 2 = 1) or (v = 'gen6' and l_partkey % 2 = 0)) as ok, l_partkey
from (select *, case l_suppkey % 4 when 0 then null when 1 then '' when 2 then 'gen5' else 'gen6' end as v from lineitem)""")
def class_returnable(t):
    """Version check per row, with alpha classes allowed; unknowns fail open."""
    item = "struct<systemVersion:string,status:string>"
    v = F.when(F.col("l_suppkey") % 4 == 1, "").when(F.col("l_suppkey") % 4 == 2, "gen5").when(F.col("l_suppkey") % 4 == 3, "gen6")
    avail = F.when(
        F.col("l_linenumber") % 4 != 0,
        F.array(
            F.struct(F.lit("gen5").alias("systemVersion"), F.when(F.col("l_linenumber") % 2 == 1, "prod").otherwise("beta").alias("status")),
            F.struct(F.lit("gen6").alias("systemVersion"), F.when(F.col("l_partkey") % 2 == 0, "alpha").otherwise("retired").alias("status")),
        ).cast(f"array<{item}>"),
    )
    return t.lineitem.select(
        F.col("l_orderkey").cast("string").alias("aoi_id"), "l_linenumber", "l_partkey", rollup.returnable(v, avail, alpha=True).alias("ok")
    )


@query("score_resolution", ctes("features") + f"""
, s as (select *, case when l_partkey % 3 = 1 then l_partkey % 100 end as rsi,
        case when l_suppkey % 4 <> 0 then l_suppkey % 6 end as wind from features),
roofs as (select * from s where class_id = '{ROOF}'),
bn as (select * from s where class_id = '{BUILDING}'),
bl as (select * from s where class_id = '{BUILDING_LIFECYCLE}'),
bl_of as (select aoi_id, min(feature_id) as bl_id from bl group by aoi_id),
bn_of as (select aoi_id, min(feature_id) as bn_id from bn group by aoi_id)
select r.aoi_id, r.feature_id, cast(coalesce(r.rsi, b.rsi, l.rsi) as double) as rsi,
  cast(case when r.rsi is not null or r.wind is not null or r.l_partkey % 3 = 2 then r.wind else l.wind end as double) as wind
from roofs r left join bn_of using (aoi_id) left join bn b on b.aoi_id = r.aoi_id and b.feature_id = bn_id
left join bl_of on bl_of.aoi_id = r.aoi_id and bn_id is not null left join bl l on l.aoi_id = r.aoi_id and l.feature_id = bl_id""")
def score_resolution(t):
    """Roof, else linked building, else lifecycle ancestor; scores as whole payloads."""
    f = _scored(t)
    bn = f.where(F.col("class_id") == BUILDING).groupBy("aoi_id").agg(F.min("feature_id").alias("parent_building_id"))
    links = f.where(F.col("class_id") == ROOF).select("aoi_id", "feature_id").join(bn, "aoi_id", "left")
    r = chains.resolve_scores(f, links)
    return r.select("aoi_id", "feature_id", F.col("rsi.value").alias("rsi"), F.col("scores.wind_score.vulnerabilityScore").alias("wind"))


def _scored(t, *, geometry: bool = False):
    """Features with score payloads; buildings point to the area's first lifecycle."""
    bl = t.features().where(F.col("class_id") == BUILDING_LIFECYCLE).groupBy("l_orderkey").agg(F.min("feature_id").alias("parent_id"))
    # Buildings alone are joined, as line items, which are shorter than what is made of them.
    code = next(k for k, v in CLASS_CODES.items() if v == BUILDING)
    named = F.coalesce(F.concat("l_returnflag", "l_linestatus") == code, F.lit(False))
    owned = t.features(geometry=geometry, rows=t.lineitem.where(named).join(bl, "l_orderkey", "left"), carry=("parent_id",))
    others = t.features(geometry=geometry, rows=t.lineitem.where(~named))
    linked = owned.withColumn("class_id", F.lit(BUILDING)).unionByName(others.withColumn("parent_id", F.lit(None).cast("string")))
    rsi = F.when(F.col("l_partkey") % 3 == 1, F.to_json(F.struct((F.col("l_partkey") % 100).alias("value"), F.lit(0.5).alias("confidence"))))
    rsi = rsi.when(F.col("l_partkey") % 3 == 2, F.lit('{"skipped": true}'))
    wind = F.when(
        F.col("l_suppkey") % 4 != 0,
        F.to_json(F.struct((F.col("l_suppkey") % 6).alias("vulnerabilityScore"), F.struct(F.col("l_tax").alias("roofAge")).alias("modelInputFeatures"))),
    )
    return linked.withColumns({"roof_spotlight_index": rsi, "wind_score": wind})


@query("score_statistics", ctes("features") + f"""
, s as (select aoi_id, clipped_area_sqm as w, case when l_partkey % 3 = 1 then cast(l_partkey % 100 as double) end as rsi,
        case when l_suppkey % 4 <> 0 then cast(l_suppkey % 6 as double) end as wind from features where class_id = '{ROOF}')
select aoi_id, min(rsi) as rsi_min, max(rsi) as rsi_max, {he('sum(rsi * w) / nullif(sum(case when rsi is not null then w end), 0e0)', 1)} as rsi_mean,
  min(wind) as wind_min, max(wind) as wind_max, {he('sum(wind * w) / nullif(sum(case when wind is not null then w end), 0e0)', 6)} as wind_mean
from s group by aoi_id""")
def score_statistics(t):
    """Index and peril statistics over the roofs of an area (own payloads only)."""
    f = _scored(t).where(F.col("class_id") == ROOF)
    links = f.select("aoi_id", "feature_id", F.lit(None).cast("string").alias("parent_building_id"))
    s = rollup.score_statistics(chains.resolve_scores(f, links), f, "clipped_area_sqm")
    return s.select(
        "aoi_id", F.col("roof_spotlight_index_min").alias("rsi_min"), F.col("roof_spotlight_index_max").alias("rsi_max"),
        F.col("roof_spotlight_index_area_weighted_mean").alias("rsi_mean"),
        F.col("wind_vulnerability_score_min").alias("wind_min"), F.col("wind_vulnerability_score_max").alias("wind_max"),
        half_even(F.col("wind_vulnerability_score_area_weighted_mean"), 6).alias("wind_mean"),
    )


_RATINGS = {"view": "NoDamage", "signup": "Affected", "click": "Minor", "purchase": "Major", "error": "Destroyed"}


@query("damage_rollup", f"""
with a as (select cast(c_custkey as string) as aoi_id, c_custkey % 10 <> 3 as ok from customer),
e as (select cast(user_id as string) as aoi_id, 'e' || cast(event_id as string) as feature_id, value as area_sqm,
  case event_type {' '.join(f"when '{k}' then '{v}'" for k, v in _RATINGS.items())} end as rating from events),
g as (select aoi_id, count(*) as n, {', '.join(f"count(*) filter (rating = '{v}') as {k}" for k, v in _RATINGS.items())},
  first(struct_pack(f := feature_id, r := rating, a := area_sqm) order by area_sqm desc nulls last, feature_id) as p from e group by aoi_id)
select aoi_id, ok as query_succeeded, 'storm' as event_name,
  case when ok then coalesce(n, 0) end as n_buildings, case when ok then coalesce("view", 0) end as n_no_damage,
  case when ok then coalesce(signup, 0) end as n_affected, case when ok then coalesce(click, 0) end as n_minor,
  case when ok then coalesce(purchase, 0) end as n_major, case when ok then coalesce(error, 0) end as n_destroyed,
  case when ok then p.f end as primary_feature_id, case when ok then p.r end as primary_damage_event_rating,
  case when ok then p.a end as primary_area_sqm
from a left join g using (aoi_id)""")
def damage_rollup(t):
    """Rating counts per customer from the user's events; errored areas NULL, empty areas 0."""
    names = F.create_map(*[F.lit(x) for kv in _RATINGS.items() for x in kv])
    b = t.events.select(
        F.col("user_id").cast("string").alias("aoi_id"), F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("feature_id"),
        F.col("value").alias("area_sqm"), names[F.col("event_type")].alias("damage_event_rating"), F.lit("storm").alias("event_name"),
    )
    aois = t.customer.select(F.col("c_custkey").cast("string").alias("aoi_id"))
    ok = t.customer.where(F.col("c_custkey") % 10 != 3).select(F.col("c_custkey").cast("string").alias("aoi_id"))
    return damage.conflation_rollup(aois, b, "au", successful=ok)
