"""Clipping, component overlays and footprint unions."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelweave.config import SQM_TO_SQFT, area_unit
from parcelweave.functions import geometry as G
from parcelweave.functions import kernel
from parcelweave.functions.columns import half_even, label
from parcelweave.functions.maps import to_map
from parcelweave.operators.attributes import is_clipped, parse_attributes
from parcelweave.operators.linking import candidate_pairs
from parcelweave.session import spread


def clip_to_aoi(features: DataFrame, aois: DataFrame, country: str) -> DataFrame:
    """Clip features to their area and recompute the clipped areas (sqm 1 decimal, sqft whole)."""
    masks = aois.select("aoi_id", F.col("geometry").alias("_mask"))
    joined = features.drop("clipped_area_sqm", "clipped_area_sqft").join(masks, "aoi_id")
    clipped = joined.withColumn("geometry", G.clip_to_geometry(F.col("geometry"), F.col("_mask"))).drop("_mask")
    sqm = F.coalesce(G.areas(G.project(F.col("geometry"), country)), F.lit(0.0))
    return clipped.withColumn("_sqm", sqm).withColumns(
        {
            "clipped_area_sqft": half_even(F.col("_sqm") * F.lit(SQM_TO_SQFT), 0),
            "clipped_area_sqm": half_even(F.col("_sqm"), 1),
        }
    ).drop("_sqm")


def clip_gridded_roofs(roofs: DataFrame, gridded_aois: DataFrame) -> DataFrame:
    """Clip roofs to their area where it was gridded; an empty result keeps the outline."""
    masks = gridded_aois.select("aoi_id", F.col("geometry").alias("_mask"))
    joined = roofs.join(masks, "aoi_id", "left")
    cut = G.clip_to_geometry(F.col("geometry"), F.col("_mask"))
    return joined.withColumn("_cut", cut).withColumn(
        "geometry", F.when(F.col("_mask").isNull(), F.col("geometry")).otherwise(F.coalesce("_cut", "geometry"))
    ).drop("_mask", "_cut")


def component_overlaps(
    parents: DataFrame, children: DataFrame, country: str, *, cell_size: float = 0.002, planar: bool = False
) -> DataFrame:
    """Recalculated components of clipped parents: (aoi_id, feature_id, recalc map).

    Per component class, the areas of child ∩ parent are summed in square metres, the ratio is to
    the parent's area, and the confidence is the best among overlapping children.  Without any
    overlap area and ratio are 0 and there is no confidence.  A pair whose overlap cannot be
    computed adds nothing and is counted in ``skipped_pairs``.
    """
    shape = F.col("geometry") if planar else G.project(F.col("geometry"), country)
    staged = parents.where(is_clipped(country) & F.col("geometry").isNotNull()).select(
        "aoi_id", "feature_id", F.col("geometry").alias("geometry"), shape.alias("_shape"),
        parse_attributes(F.col("attributes")).alias("_attrs"),
    ).withColumn("_area", G.area(F.col("_shape"))).where(F.col("_area") > 0)
    low = F.coalesce(F.contains(F.col("_a.description"), F.lit("Low confidence")), F.lit(False))
    components = (
        staged.select("aoi_id", "feature_id", "geometry", "_shape", "_area", F.explode("_attrs").alias("_a"))
        .select(
            "aoi_id", "feature_id", "geometry", "_shape", "_area",
            F.when(low, F.lit("low_conf_")).otherwise(F.lit("")).alias("_head"), F.explode("_a.components").alias("_c"),
        )
        .where(F.col("_c.classId").isNotNull())
        .select(
            "aoi_id", "feature_id", "geometry", "_shape", "_area",
            F.col("_c.classId").alias("class_id"),
            F.concat(F.col("_head"), label(F.coalesce(F.col("_c.description"), F.lit("unknown")))).alias("name"),
        )
    )
    # Outlines travel as they are and are projected where they meet.
    placed = lambda df: df.withColumn("_b", F.col("bbox") if "bbox" in df.columns else G.bbox(F.col("geometry")))
    kids = placed(children).select("aoi_id", "class_id", "confidence", "geometry", F.col("_b").alias("bbox"))
    asked = components.select("aoi_id", "class_id", "feature_id", "name", "geometry", G.bbox(F.col("geometry")).alias("bbox"))
    pairs = candidate_pairs(asked, kids, keys=("aoi_id", "class_id"), cell_size=cell_size)
    here = lambda side: F.col(f"{side}.geometry") if planar else G.project(F.col(f"{side}.geometry"), country)
    overlap = pairs.select(
        "aoi_id", F.col("l.feature_id").alias("feature_id"), F.col("l.name").alias("name"),
        F.col("r.confidence").alias("confidence"), G.intersection_area(here("l"), here("r")).alias("part"),
    )
    hits = overlap.groupBy("aoi_id", "feature_id", "name").agg(
        F.sum("part").alias("total"),
        F.max(F.when(F.col("part") > 0, F.col("confidence"))).alias("best"),
        F.count_if(F.col("part").isNull()).alias("skipped"),
    )
    scale = F.lit(SQM_TO_SQFT if area_unit(country) == "sqft" else 1.0)
    total = F.coalesce("total", F.lit(0.0))
    rows = components.drop("geometry", "_shape").join(hits, ["aoi_id", "feature_id", "name"], "left")
    per_name = F.struct(
        F.col("name").alias("key"),
        F.struct(
            F.col("class_id"),
            (total * scale).alias("area"),
            (total / F.col("_area")).alias("ratio"),
            F.when(total > 0, F.col("best")).alias("confidence"),
        ).alias("value"),
    )
    return rows.groupBy("aoi_id", "feature_id").agg(
        to_map(F.array_sort(F.collect_set(per_name))).alias("recalc"),
        F.sum(F.coalesce("skipped", F.lit(0))).alias("skipped_pairs"),
    )


# ------------------------------------------------------------------ unions of footprints
def _union_group(table: pa.Table) -> pa.Table:
    """Union of the shapes of one small group as disjoint trapezoids, in one row."""
    shapes = table.column("geometry").combine_chunks()
    oriented = [kernel.orient(rings) for row in kernel.rows_to_parts(shapes) for rings in row or []]
    pieces = [[t] for t in kernel.trapezoids([p for p in oriented if p])]
    columns = [
        kernel.parts_to_rows([pieces]) if name == "geometry" else table.column(name).slice(0, 1).combine_chunks()
        for name in table.column_names
    ]
    return pa.Table.from_arrays(columns, names=table.column_names)


def union_cells(
    footprints: DataFrame, keys: list[str], *, cell_size: float, run: int = 256
) -> DataFrame:
    """(keys, cell, geometry): overlap-free union of all footprints of a group, cell by cell.

    Footprints are cut to cells first.  A footprint that covers its cell makes all others of the
    cell redundant, so of those one is kept; the rest are united as a tree of bounded runs.
    """
    box = F.col("_b")
    span = lambda lo, hi: F.sequence(F.floor(lo / cell_size), F.floor(hi / cell_size))
    cells = (
        footprints.select(*keys, "geometry", G.bbox(F.col("geometry")).alias("_b"))
        .where(box.isNotNull())
        .withColumn("cx", F.explode(span(box["minx"], box["maxx"])))
        .withColumn("cy", F.explode(span(box["miny"], box["maxy"])))
    )
    s = F.lit(cell_size)
    cut = spread(cells, *keys, "cx", "cy", "_b").select(
        *keys, "cx", "cy",
        G.clip_to_box(
            F.col("geometry"), F.col("cx") * s, F.col("cy") * s, (F.col("cx") + 1) * s, (F.col("cy") + 1) * s
        ).alias("geometry"),
    ).where(F.col("geometry").isNotNull())
    where = [*keys, "cx", "cy"]
    distinct = cut.distinct()
    full = G.area(F.col("geometry")) >= s * s * F.lit(1 - 1e-12)
    covered = distinct.where(full).groupBy(*where).agg(F.first("geometry").alias("geometry"))
    partial = distinct.where(~full).join(covered.select(*where), where, "left_anti")
    # A crowded cell is united as a tree: runs of about `run` shapes, then runs of those.
    sizes = partial.groupBy(*where).agg(F.ceil(F.count(F.lit(1)) / run).alias("_runs"))
    salted = partial.join(sizes, where).withColumn(
        "_salt", F.pmod(F.xxhash64("geometry"), F.col("_runs")).cast("bigint")
    ).drop("_runs")
    level = salted.groupBy(*where, "_salt").applyInArrow(_union_group, salted.schema)
    level = level.withColumn("_salt", F.floor(F.col("_salt") / run))
    level = level.groupBy(*where, "_salt").applyInArrow(_union_group, salted.schema)
    second = level.drop("_salt").groupBy(*where).applyInArrow(_union_group, partial.schema)
    return covered.unionByName(second)


def union_area(cells: DataFrame, keys: list[str]) -> DataFrame:
    """Covered area per group from overlap-free cells."""
    return cells.groupBy(*keys).agg(F.sum(G.area(F.col("geometry"))).alias("area"))
