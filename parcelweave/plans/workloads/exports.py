"""The unified export end to end."""

from __future__ import annotations

import dataclasses

from pyspark.sql import functions as F

from parcelweave.config import BUILDING, BUILDING_LIFECYCLE, POOL, ROOF, ROOF_INSTANCE
from parcelweave.operators import chains
from parcelweave.plans import export
from parcelweave.plans.registry import query
from parcelweave.plans.samples import CATALOGUE, ctes
from parcelweave.plans.workloads.links import CELL, _pairs_sql, _parent_sql
from parcelweave.plans.workloads.rollups import _scored


def inputs(t) -> export.ExportInputs:
    """Orders and line items as the tables of one run."""
    f = _scored(t, geometry=True).drop("x1", "y1", "x2", "y2", "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax")
    roof = F.when(
        F.col("class_id") == ROOF,
        F.lit(f'[{{"description":"Roof material","components":[{{"description":"Metal","classId":"{BUILDING}","areaSqm":4,"ratio":0.75,"confidence":0.5}}]}}]'),
    )
    f = f.withColumns({"attributes": roof, "damage": F.lit(None).cast("string"), "mesh_date": F.lit(None).cast("string")})
    ri = f.where(F.col("class_id") == ROOF_INSTANCE).withColumns({"installation_date": F.col("survey_date"), "as_of_date": F.lit("2024-01-01")})
    return export.ExportInputs(
        aois=t.aois(geometry=True).select("aoi_id", "geometry", "lat", "lon", "status"),
        features=f.where(F.col("class_id") != ROOF_INSTANCE).drop("kind", "trust_score"),
        metadata=t.metadata().withColumn("mesh_date", F.lit("")),
        catalogue=CATALOGUE,
        roof_instances=ri.select("aoi_id", "feature_id", "class_id", "kind", "area_sqm", "trust_score", "geometry", "bbox", "installation_date", "as_of_date"),
        roof_age_metadata=t.aois().select("aoi_id"),
        feature_errors=t.aois().where(F.col("o_orderkey") % 17 == 0).select("aoi_id"),
    )


@query("export_features", ctes("features", "metadata") + f"""
, p as (select aoi_id, feature_id, class_id, row_number() over (partition by aoi_id, class_id order by clipped_area_sqm desc nulls last, unclipped_area_sqm desc nulls last, feature_id) as rn
  from features where class_id in ('{ROOF}', '{BUILDING}', '{BUILDING_LIFECYCLE}', '{POOL}'))
select f.aoi_id, f.feature_id, f.class_id, coalesce(rn = 1, false) as is_primary, m.system_version from features f join metadata m using (aoi_id)
left join p on p.aoi_id = f.aoi_id and p.feature_id = f.feature_id and p.class_id = f.class_id""")
def export_features(t):
    """Feature output: metadata ⋈ features ⋈ areas with the primary flag."""
    i = inputs(t)
    linked = export.linked_features(i, "au", cell_size=CELL)
    plain = dataclasses.replace(i, catalogue=[c for c in CATALOGUE if c.class_id != ROOF_INSTANCE])
    out = export.feature_output(linked, plain, None, "au")
    return out.select("aoi_id", "feature_id", "class_id", "is_primary", "system_version")


@query("export_rollup", ctes("features", "aois", "metadata") + f"""
select a.aoi_id, status, m.system_version, case when m.aoi_id is null then 'N' else 'Y' end as feature_api_success,
  case when m.aoi_id is not null then (select count(*) from features f where f.aoi_id = a.aoi_id and class_id = '{ROOF}') end as roof_count
from aois a left join metadata m using (aoi_id)""")
def export_rollup(t):
    """The finished rollup of the whole run: links, primaries, scores, statistics, metadata."""
    i = inputs(t)
    linked = export.linked_features(i, "au", cell_size=CELL)
    r = export.parcel_tables(i, "au", linked=linked, cell_size=CELL)
    out = export.finished_rollup(r, i, "au")
    return out.select("aoi_id", "status", "system_version", "feature_api_success", "roof_count")


@query("export_buildings", _parent_sql(ROOF, BUILDING, "primary_child_roof_id", "primary_child_roof_iou", "child_roof_count", False)
       .replace("coalesce(n, 0) as child_roof_count", "coalesce(n, 0) as child_roof_count, case when r_iou >= 5e-3 then 'metal' end as primary_child_roof_material"))
def export_buildings(t):
    """Building table with its primary roof's attributes and index range."""
    i = inputs(t)
    linked = export.linked_features(i, "au", cell_size=CELL)
    roofs = export.roof_table(linked, "au", recalculate=False)
    resolved = chains.resolve_scores(linked, linked.where(F.col("class_id") == ROOF).select("aoi_id", "feature_id", "parent_building_id"))
    b = export.building_table(linked, roofs, resolved, "au")
    return b.select(
        "aoi_id", "feature_id", "primary_child_roof_id", F.coalesce("primary_child_roof_iou", F.lit(0.0)).alias("primary_child_roof_iou"),
        F.coalesce("child_roof_count", F.lit(0)).cast("bigint").alias("child_roof_count"),
        F.col("primary_child_roof_dominant_roof_material_description").alias("primary_child_roof_material"),
    )


@query("export_roofs", _pairs_sql(ROOF_INSTANCE, ROOF) + f"""
, r as (select *, row_number() over (partition by aoi_id, parent_id order by case kind when 'roof' then 0 when 'parcel' then 1 else 2 end,
        (round_even(iou * 1e4, 0) / 1e4) desc, child_id) as rn, round_even(iou * 1e4, 0) / 1e4 as r_iou from pairs)
select f.aoi_id, f.feature_id, case when r_iou >= 5e-3 then c.survey_date end as primary_child_roof_age_installation_date
from features f left join r on r.aoi_id = f.aoi_id and r.parent_id = f.feature_id and rn = 1
left join features c on c.aoi_id = f.aoi_id and c.feature_id = r.child_id where f.class_id = '{ROOF}'""")
def export_roofs(t):
    """Roof table with recalculated components and its instance's record."""
    i = inputs(t)
    linked = export.linked_features(i, "au", cell_size=CELL)
    return export.roof_table(linked, "au", cell_size=CELL).select("aoi_id", "feature_id", "primary_child_roof_age_installation_date")


@query("export_lifecycles")
def export_lifecycles(t):
    """Lifecycle table with its largest child roof."""
    i = inputs(t)
    out = export.lifecycle_table(export.linked_features(i, "au", cell_size=CELL), "au")
    return out.select("aoi_id", "feature_id", "primary_child_roof_id", "child_roof_count", "damage_class")
