"""Linking, parent chains and child attributes."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelweave.config import BUILDING, BUILDING_LIFECYCLE, ROOF, ROOF_INSTANCE
from parcelweave.functions import geometry as G
from parcelweave.functions.columns import half_even
from parcelweave.operators import chains, linking, spatial
from parcelweave.plans.registry import query
from parcelweave.plans.samples import ctes, half_even_sql as he

CELL = 4.0

_INTER = "greatest(least(a.x2, b.x2) - greatest(a.x1, b.x1), 0e0) * greatest(least(a.y2, b.y2) - greatest(a.y1, b.y1), 0e0)"


def _pairs_sql(child: str, parent: str) -> str:
    return (
        ctes("features")
        + f""", p as (select a.aoi_id, a.feature_id as child_id, b.feature_id as parent_id, a.kind, {_INTER} as inter,
        (a.x2 - a.x1) * (a.y2 - a.y1) + (b.x2 - b.x1) * (b.y2 - b.y1) as both_areas
        from features a join features b using (aoi_id) where a.class_id = '{child}' and b.class_id = '{parent}'),
        pairs as (select aoi_id, child_id, parent_id, kind, inter / (both_areas - inter) as iou from p where inter > 0)
        """
    )


def _class(t, class_id):
    return t.features(geometry=True).where(F.col("class_id") == class_id)


@query("iou_pairs", _pairs_sql(ROOF_INSTANCE, ROOF) + f"select aoi_id, child_id, parent_id, {he('iou', 9)} as iou from pairs")
def iou_pairs(t):
    """Every overlapping (instance, roof) pair with its IoU."""
    p = linking.iou_pairs(_class(t, ROOF_INSTANCE), _class(t, ROOF), cell_size=CELL)
    return p.select("aoi_id", "child_id", "parent_id", half_even(F.col("iou"), 9).alias("iou"))


def _child_sql(child, parent, id_name, iou_name):
    return _pairs_sql(child, parent) + f"""
    , best as (select *, row_number() over (partition by aoi_id, child_id order by iou desc, parent_id) as rn from pairs)
    select f.aoi_id, f.feature_id, case when iou >= 5e-3 then parent_id end as {id_name},
      coalesce(case when iou >= 5e-3 then {he('iou', 4)} end, 0e0) as {iou_name}
    from features f left join best b on b.aoi_id = f.aoi_id and b.child_id = f.feature_id and rn = 1 where f.class_id = '{child}'"""


def _parent_sql(child, parent, primary, iou_name, count_name, with_kind):
    rank = "case kind when 'roof' then 0 when 'parcel' then 1 else 2 end" if with_kind else "0"
    return _pairs_sql(child, parent) + f"""
    , r as (select *, {he('iou', 4)} as r_iou, row_number() over (partition by aoi_id, parent_id
              order by {rank}, {he('iou', 4)} desc, child_id) as rn, count(*) over (partition by aoi_id, parent_id) as n from pairs)
    select f.aoi_id, f.feature_id, case when r_iou >= 5e-3 then child_id end as {primary},
      coalesce(case when r_iou >= 5e-3 then r_iou end, 0e0) as {iou_name}, coalesce(n, 0) as {count_name}
    from features f left join r on r.aoi_id = f.aoi_id and r.parent_id = f.feature_id and rn = 1 where f.class_id = '{parent}'"""


@query("link_instances_to_roofs", _child_sql(ROOF_INSTANCE, ROOF, "parent_id", "parent_iou"))
def link_instances_to_roofs(t):
    """Each instance's best roof."""
    c, _ = linking.link_roof_instances_to_roofs(_class(t, ROOF_INSTANCE), _class(t, ROOF), cell_size=CELL)
    return c.select("aoi_id", "feature_id", "parent_id", "parent_iou")


@query("link_roofs_of_instances", _parent_sql(
    ROOF_INSTANCE, ROOF, "primary_child_roof_age_feature_id", "primary_child_roof_age_iou", "child_roof_instance_count", True))
def link_roofs_of_instances(t):
    """Each roof's primary instance and number of instances."""
    _, p = linking.link_roof_instances_to_roofs(_class(t, ROOF_INSTANCE), _class(t, ROOF), cell_size=CELL)
    return p.select("aoi_id", "feature_id", "primary_child_roof_age_feature_id", "primary_child_roof_age_iou", "child_roof_instance_count")


@query("link_roofs_to_buildings", _child_sql(ROOF, BUILDING, "parent_building_id", "parent_building_iou"))
def link_roofs_to_buildings(t):
    """Each roof's best building."""
    c, _ = linking.link_roofs_to_buildings(_class(t, ROOF), _class(t, BUILDING), cell_size=CELL)
    return c.select("aoi_id", "feature_id", "parent_building_id", "parent_building_iou")


@query("link_buildings_of_roofs", _parent_sql(ROOF, BUILDING, "primary_child_roof_id", "primary_child_roof_iou", "child_roof_count", False))
def link_buildings_of_roofs(t):
    """Each building's primary roof and number of roofs."""
    _, p = linking.link_roofs_to_buildings(_class(t, ROOF), _class(t, BUILDING), cell_size=CELL)
    return p.select("aoi_id", "feature_id", "primary_child_roof_id", "primary_child_roof_iou", "child_roof_count")


@query("child_lists", _pairs_sql(ROOF, BUILDING) + f"""
select aoi_id, parent_id as feature_id, string_agg(child_id, ',' order by {he('iou', 4)} desc, child_id) as children
from pairs group by aoi_id, parent_id""")
def child_lists(t):
    """Ordered child ids of every building that has any."""
    s = linking.link_summary(linking.iou_pairs(_class(t, ROOF), _class(t, BUILDING), cell_size=CELL))
    ids = F.array_join(F.transform("children", lambda c: c["feature_id"]), ",")
    return s.where(F.col("role") == "parent").select("aoi_id", "feature_id", ids.alias("children"))


_CHAIN = """
with recursive nodes as (select p_partkey as id, p_partkey // 3 as parent, p_partkey % 7 = 3 as hit from part),
walk(id, pos, depth) as (
  select id, parent, 1 from nodes
  union all
  select w.id, n.parent, depth + 1 from walk w join nodes n on n.id = w.pos where not n.hit and n.parent <> w.pos and depth < 64)
select cast(w.id as string) as feature_id, cast(max(n.id) as string) as ancestor_id
from walk w left join nodes n on n.id = w.pos and n.hit group by w.id"""


@query("ancestor_walk", _CHAIN)
def ancestor_walk(t):
    """Nearest ancestor of a class along parent ids; the root points to itself (a cycle)."""
    f = t.part.select(
        F.lit("all").alias("aoi_id"), F.col("p_partkey").cast("string").alias("feature_id"),
        F.when(F.col("p_partkey") % 7 == 3, BUILDING_LIFECYCLE).otherwise(BUILDING).alias("class_id"),
        F.floor(F.col("p_partkey") / 3).cast("string").alias("parent_id"),
    )
    return chains.ancestors_of_class(f, BUILDING_LIFECYCLE).select("feature_id", "ancestor_id")


@query("ancestor_walk_short", """
select cast(c_custkey + 100 as string) as feature_id, cast(c_nationkey as string) as ancestor_id from customer
union all select cast(n_nationkey as string), null from nation""")
def ancestor_walk_short(t):
    """One-hop chains: customers below nations."""
    c = t.customer.select(
        (F.col("c_custkey") + 100).cast("string").alias("feature_id"), F.lit(BUILDING).alias("class_id"), F.col("c_nationkey").cast("string").alias("parent_id")
    )
    n = t.nation.select(
        F.col("n_nationkey").cast("string").alias("feature_id"), F.lit(BUILDING_LIFECYCLE).alias("class_id"), F.lit(None).cast("string").alias("parent_id")
    )
    f = c.unionByName(n).withColumn("aoi_id", F.lit("a"))
    return chains.ancestors_of_class(f, BUILDING_LIFECYCLE).select("feature_id", "ancestor_id")


def _linked_roofs_sql() -> str:
    return _pairs_sql(ROOF, BUILDING) + """
    , best as (select *, row_number() over (partition by aoi_id, child_id order by iou desc, parent_id) as rn from pairs)
    , linked as (select aoi_id, child_id, parent_id as building from best where rn = 1 and iou >= 5e-3)"""


@query("lifecycle_child_roofs", _linked_roofs_sql() + f"""
, bl as (select aoi_id, min(feature_id) as lifecycle_id from features where class_id = '{BUILDING_LIFECYCLE}' group by aoi_id)
select l.aoi_id, lifecycle_id, first(child_id order by f.clipped_area_sqm desc, child_id) as primary_child_roof_id, count(*) as child_roof_count
from linked l join bl using (aoi_id) join features f on f.aoi_id = l.aoi_id and f.feature_id = l.child_id group by all""")
def lifecycle_child_roofs(t):
    """Roof → building → lifecycle: largest roof and number of roofs per lifecycle."""
    f = t.features(geometry=True)
    bl = f.where(F.col("class_id") == BUILDING_LIFECYCLE).groupBy("aoi_id").agg(F.min("feature_id").alias("parent_id"))
    buildings = f.where(F.col("class_id") == BUILDING).join(bl, "aoi_id", "left")
    roofs, _ = linking.link_roofs_to_buildings(f.where(F.col("class_id") == ROOF), buildings, cell_size=CELL)
    return chains.lifecycle_child_roofs(buildings, roofs, "clipped_area_sqm")


@query("building_child_attributes", _pairs_sql(ROOF, BUILDING) + f"""
, r as (select *, {he('iou', 4)} as r_iou, row_number() over (partition by aoi_id, parent_id order by {he('iou', 4)} desc, child_id) as rn from pairs)
select f.aoi_id, f.feature_id, c.survey_date as primary_child_roof_survey_date, c.clipped_area_sqm as primary_child_roof_clipped_area_sqm
from features f left join r on r.aoi_id = f.aoi_id and r.parent_id = f.feature_id and rn = 1 and r_iou >= 5e-3
left join features c on c.aoi_id = f.aoi_id and c.feature_id = r.child_id where f.class_id = '{BUILDING}'""")
def building_child_attributes(t):
    """Buildings ⟕ attributes of their primary child roof."""
    roofs = _class(t, ROOF)
    _, b = linking.link_roofs_to_buildings(roofs, _class(t, BUILDING), cell_size=CELL)
    out = chains.attach_by_id(b, roofs, "primary_child_roof_id", ["survey_date", "clipped_area_sqm"], "primary_child_roof_")
    return out.select("aoi_id", "feature_id", "primary_child_roof_survey_date", "primary_child_roof_clipped_area_sqm")


@query("child_score_range", _pairs_sql(ROOF, BUILDING) + """
select p.aoi_id, parent_id, min(c.l_partkey % 100) as v_min, max(c.l_partkey % 100) as v_max
from pairs p join features c on c.aoi_id = p.aoi_id and c.feature_id = p.child_id where c.l_partkey % 3 = 1 group by all""")
def child_score_range(t):
    """Min and max of a score over all child roofs of a building."""
    roofs = _class(t, ROOF)
    pairs = linking.iou_pairs(roofs, _class(t, BUILDING), cell_size=CELL)
    v = roofs.select("aoi_id", "feature_id", F.when(F.col("l_partkey") % 3 == 1, F.col("l_partkey") % 100).alias("v"))
    return chains.child_score_range(pairs.select("aoi_id", "parent_id", "child_id"), v, "v")


@query("component_overlaps", ctes("features") + f"""
, roofs as (select * from features where class_id = '{ROOF}' and clipped_area_sqm < unclipped_area_sqm * 99e-2),
p as (select a.aoi_id, a.feature_id, {_INTER} as part, b.confidence, (a.x2 - a.x1) * (a.y2 - a.y1) as area
  from roofs a join features b on a.aoi_id = b.aoi_id and b.class_id = '{BUILDING}'),
s as (select aoi_id, feature_id, sum(part) as total, max(confidence) filter (part > 0) as best from p group by all)
select r.aoi_id, r.feature_id, {he('coalesce(total, 0e0)', 6)} as area, {he('coalesce(total, 0e0) / ((x2 - x1) * (y2 - y1))', 6)} as ratio,
  case when total > 0 then best end as confidence from roofs r left join s using (aoi_id, feature_id)""")
def component_overlaps(t):
    """Recalculated component of clipped roofs: overlap with all features of the component's class."""
    roofs = _class(t, ROOF).withColumn(
        "attributes", F.lit(f'[{{"description":"Parts","components":[{{"description":"Tile Part","classId":"{BUILDING}"}}]}}]')
    )
    r = spatial.component_overlaps(roofs, _class(t, BUILDING), "au", cell_size=CELL, planar=True)
    m = F.col("recalc")["tile_part"]
    return r.select(
        "aoi_id", "feature_id", half_even(m["area"], 6).alias("area"), half_even(m["ratio"], 6).alias("ratio"), m["confidence"].alias("confidence")
    )


@query("clip_gridded_roofs", ctes("features", "aois") + f"""
select f.aoi_id, f.feature_id, {he("case when a.aoi_id is null or w <= 0 or h <= 0 then (f.x2 - f.x1) * (f.y2 - f.y1) else w * h end", 6)} as area
from (select f.*, least(f.x2, a.x2) - greatest(f.x1, a.x1) as w, least(f.y2, a.y2) - greatest(f.y1, a.y1) as h
  from features f left join aois a on a.aoi_id = f.aoi_id and o_orderkey % 2 = 0 where class_id = '{ROOF}') f
left join aois a on a.aoi_id = f.aoi_id and o_orderkey % 2 = 0""")
def clip_gridded_roofs(t):
    """Roofs of gridded areas are clipped to the area; an empty result keeps the outline."""
    gridded = t.aois(geometry=True).where(F.col("o_orderkey") % 2 == 0)
    out = spatial.clip_gridded_roofs(_class(t, ROOF), gridded)
    return out.select("aoi_id", "feature_id", half_even(G.area(F.col("geometry")), 6).alias("area"))
