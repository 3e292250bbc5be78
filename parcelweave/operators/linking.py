"""Linking two feature classes by intersection over union.

Candidate pairs come from an equi-join on (aoi_id, grid cell), never from "all pairs of an AOI":
a feature is filed under the cells its box touches, small ones in a fine grid and large ones in a
coarse grid that the small ones probe, so even one huge AOI spreads over many cells while a large
outline is not repeated over thousands of fine ones.  A pair is kept only in the cell that
holds the lower-left corner of the two boxes' common part, which makes pairs unique without a
distinct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelweave.config import MIN_LINK_IOU
from parcelweave.functions import geometry as G
from parcelweave.functions.columns import half_even

LEVEL_FACTOR = 64.0


def _filed(df: DataFrame, base: float, side: str, touching: bool = True) -> DataFrame:
    """One row per cell key (role, level, cx, cy).

    Level 0 holds features up to one cell in extent, level 1 the larger ones.  Role 0 pairs the
    left's own cells with the right's own and probe cells; role 1 pairs the left's probe cells
    with the right's own cells.  Only level-0 features probe (level 1).  Unless ``touching``, a box that ends on
    a cell's border is not in the next cell.
    """
    box = F.col("_box")
    extent = F.greatest(box["maxx"] - box["minx"], box["maxy"] - box["miny"])

    def keys(*pairs):
        return F.array(*[F.struct(F.lit(role).alias("role"), F.lit(level).alias("level")) for role, level in pairs])

    if side == "left":
        small, large = keys((0, 0), (1, 1)), keys((0, 1))
    else:
        small, large = keys((0, 0), (0, 1)), keys((0, 1), (1, 1))
    size = F.when(F.col("_level") == 0, F.lit(base)).otherwise(F.lit(base * LEVEL_FACTOR))

    def span(lo, hi):
        first = F.floor(lo / size)
        last = F.floor(hi / size) if touching else F.greatest(first, F.ceil(hi / size) - 1)
        return F.explode(F.sequence(first, last))

    return (
        df.withColumn("_box", F.col("bbox") if "bbox" in df.columns else G.bbox(F.col("geometry")))
        .where(box.isNotNull())
        .withColumn("_k", F.explode(F.when(extent <= base, small).otherwise(large)))
        .withColumns({"_role": F.col("_k.role"), "_level": F.col("_k.level")})
        .withColumn("_cx", span(box["minx"], box["maxx"]))
        .withColumn("_cy", span(box["miny"], box["maxy"]))
    )


def candidate_pairs(
    left: DataFrame, right: DataFrame, *, keys: tuple[str, ...] = ("aoi_id",), cell_size: float = 0.002, touching: bool = True
) -> DataFrame:
    """All (left, right) rows of equal ``keys`` whose bounding boxes overlap or, with ``touching``, meet.

    Both sides need ``geometry`` or a stored ``bbox``, which is used if there is one.  Their columns
    come back as structs ``l`` and ``r``.  An outline that is just its upright box travels as that box.
    """
    lf, rf = _filed(left, cell_size, "left", touching), _filed(right, cell_size, "right", touching)
    cell = ("role", "level", "cx", "cy")
    a = lf.select(
        *[F.col(k).alias(f"_a_{k}") for k in keys], *[F.col(f"_{k}").alias(f"_a_{k}") for k in cell],
        F.col("_box").alias("_a_box"), _packed(left).alias("l"),
    )
    b = rf.select(
        *[F.col(k).alias(f"_b_{k}") for k in keys], *[F.col(f"_{k}").alias(f"_b_{k}") for k in cell],
        F.col("_box").alias("_b_box"), _packed(right).alias("r"),
    )
    pa, pb = F.col("_a_box"), F.col("_b_box")
    before = (lambda a, b: a <= b) if touching else (lambda a, b: a < b)
    overlap = (
        before(pa["minx"], pb["maxx"]) & before(pb["minx"], pa["maxx"])
        & before(pa["miny"], pb["maxy"]) & before(pb["miny"], pa["maxy"])
    )
    size = F.when(F.col("_a_level") == 0, F.lit(cell_size)).otherwise(F.lit(cell_size * LEVEL_FACTOR))
    home = (F.floor(F.greatest(pa["minx"], pb["minx"]) / size) == F.col("_a_cx")) & (
        F.floor(F.greatest(pa["miny"], pb["miny"]) / size) == F.col("_a_cy")
    )
    on = overlap & home
    for k in (*cell, *keys):
        on = (F.col(f"_a_{k}") == F.col(f"_b_{k}")) & on
    # Both sides grow with the data, so neither is offered for broadcasting.
    joined = a.join(b.hint("merge"), on, "inner")
    return joined.select(
        *[F.col(f"_a_{k}").alias(k) for k in keys],
        _unpacked(left, "l", pa).alias("l"), _unpacked(right, "r", pb).alias("r"),
    )


def as_outline(box: Column) -> Column:
    return G.box(box["minx"], box["miny"], box["maxx"], box["maxy"])


def _packed(df: DataFrame) -> Column:
    """The columns of a filed row as a struct, without what its ``_box`` tells already: copies in several
    cells then do not repeat it."""
    outline = F.when(F.col("geometry") != as_outline(F.col("_box")), F.col("geometry")).alias("geometry")
    kept = [outline if c == "geometry" else F.col(c) for c in df.columns if c != "bbox"]
    return F.struct(*kept)


def _unpacked(df: DataFrame, name: str, box: Column) -> Column:
    """Inverse of :func:`_packed` after the join."""
    own = {"geometry": lambda: F.coalesce(F.col(f"{name}.geometry"), as_outline(box)), "bbox": lambda: box}
    return F.struct(*[own[c]().alias(c) if c in own else F.col(f"{name}.{c}").alias(c) for c in df.columns])


def iou_pairs(children: DataFrame, parents: DataFrame, *, cell_size: float = 0.002) -> DataFrame:
    """(aoi_id, child_id, parent_id, kind, iou) of every overlapping pair, iou > 0.

    Only ids and outlines travel to the kernel; other columns are joined back by id.
    """
    kind = F.col("kind") if "kind" in children.columns else F.lit(None).cast("string")
    box = [["bbox"] if "bbox" in df.columns else [] for df in (children, parents)]
    c = children.where(F.col("feature_id").isNotNull()).select("aoi_id", "feature_id", kind.alias("kind"), "geometry", *box[0])
    p = parents.where(F.col("feature_id").isNotNull()).select("aoi_id", "feature_id", "geometry", *box[1])
    # Boxes that only touch have no area in common.
    pairs = candidate_pairs(c, p, cell_size=cell_size, touching=False)
    return pairs.select(
        "aoi_id",
        F.col("l.feature_id").alias("child_id"),
        F.col("r.feature_id").alias("parent_id"),
        F.col("l.kind").alias("kind"),
        G.iou(F.col("l.geometry"), F.col("r.geometry")).alias("iou"),
    ).where(F.col("iou") > 0)


def _child_entry(with_kind: bool) -> Column:
    """Sort-ready list entry: kind first (roof, parcel, other), then larger rounded IoU."""
    rank = F.when(F.col("kind") == "roof", 0).when(F.col("kind") == "parcel", 1).otherwise(2)
    fields = [
        (rank if with_kind else F.lit(0)).alias("rank"),
        (-half_even(F.col("iou"), 4)).alias("minus_iou"),
        F.col("child_id").alias("feature_id"),
        F.col("kind").alias("kind"),
    ]
    return F.struct(*fields)


def link_summary(pairs: DataFrame, *, with_kind: bool = False, min_iou: float = MIN_LINK_IOU) -> DataFrame:
    """Both directions in one pass: one row per (aoi_id, role, feature_id).

    Each pair is emitted once for its child and once for its parent, so the pair kernel runs
    once and a single shuffle serves both sides.

    Child rows: ``parent_id`` of strictly greatest unrounded IoU (NULL below ``min_iou``) and
    ``parent_iou``.  Parent rows: the ordered child list and its first entry, which is primary
    only if its rounded IoU reaches ``min_iou``.
    """
    roles = F.explode(
        F.array(
            F.struct(F.lit("child").alias("role"), F.col("child_id").alias("feature_id")),
            F.struct(F.lit("parent").alias("role"), F.col("parent_id").alias("feature_id")),
        )
    )
    rows = pairs.select("aoi_id", "child_id", "parent_id", "kind", "iou", roles.alias("r")).select(
        "aoi_id", "r.role", "r.feature_id", "child_id", "parent_id", "kind", "iou"
    )
    is_child, is_parent = F.col("role") == "child", F.col("role") == "parent"
    best = F.when(is_child, F.struct((-F.col("iou")).alias("k"), F.col("parent_id").alias("id")))
    grouped = rows.groupBy("aoi_id", "role", "feature_id").agg(
        F.min(best).alias("best"),
        F.array_sort(F.collect_list(F.when(is_parent, _child_entry(with_kind)))).alias("entries"),
    )
    top = F.get(F.col("entries"), F.lit(0))
    strong = -F.col("best.k") >= min_iou
    first_ok = -top["minus_iou"] >= min_iou
    listed = F.transform(
        F.col("entries"),
        lambda e: F.struct(
            e["feature_id"].alias("feature_id"),
            (-e["minus_iou"]).alias("iou"),
            *([e["kind"].alias("kind")] if with_kind else []),
        ),
    )
    return grouped.select(
        "aoi_id", "role", "feature_id",
        F.when(strong, F.col("best.id")).alias("parent_id"),
        F.when(strong, half_even(-F.col("best.k"), 4)).otherwise(0.0).alias("parent_iou"),
        F.when(first_ok, top["feature_id"]).alias("primary_child_id"),
        F.when(first_ok, -top["minus_iou"]).otherwise(0.0).alias("primary_child_iou"),
        listed.alias("children"),
        F.size("entries").alias("child_count"),
    )


def attach_child_links(children: DataFrame, summary: DataFrame, id_name: str, iou_name: str) -> DataFrame:
    """Children ⟕ their best parent; unlinked children get NULL and 0.0."""
    s = summary.where(F.col("role") == "child").select(
        "aoi_id", "feature_id", F.col("parent_id").alias(id_name), F.col("parent_iou").alias(iou_name)
    )
    out = children.drop(id_name, iou_name).join(s, ["aoi_id", "feature_id"], "left")
    return out.withColumn(iou_name, F.coalesce(F.col(iou_name), F.lit(0.0)))


def attach_parent_links(
    parents: DataFrame, summary: DataFrame, primary_name: str, iou_name: str, list_name: str, count_name: str
) -> DataFrame:
    """Parents ⟕ their child list; parents without children get NULL, 0.0, ``[]`` and 0."""
    s = summary.where(F.col("role") == "parent").select(
        "aoi_id", "feature_id",
        F.col("primary_child_id").alias(primary_name),
        F.col("primary_child_iou").alias(iou_name),
        F.to_json("children", {"ignoreNullFields": "false"}).alias(list_name),
        F.col("child_count").alias(count_name),
    )
    out = parents.join(s, ["aoi_id", "feature_id"], "left")
    return out.withColumns(
        {
            iou_name: F.coalesce(F.col(iou_name), F.lit(0.0)),
            list_name: F.coalesce(F.col(list_name), F.lit("[]")),
            count_name: F.coalesce(F.col(count_name), F.lit(0)).cast("bigint"),
        }
    )


def link_roof_instances_to_roofs(instances: DataFrame, roofs: DataFrame, *, cell_size: float = 0.002):
    """Roof instances get ``parent_id``/``parent_iou``; roofs get their instance list."""
    summary = link_summary(iou_pairs(instances, roofs, cell_size=cell_size), with_kind=True)
    return (
        attach_child_links(instances, summary, "parent_id", "parent_iou"),
        attach_parent_links(
            roofs, summary, "primary_child_roof_age_feature_id", "primary_child_roof_age_iou",
            "child_roof_instances", "child_roof_instance_count",
        ),
    )


def link_roofs_to_buildings(
    roofs: DataFrame, buildings: DataFrame, min_iou: float = MIN_LINK_IOU, *, cell_size: float = 0.002
):
    """Roofs get ``parent_building_id``/``parent_building_iou``; buildings get their roof list."""
    summary = link_summary(iou_pairs(roofs, buildings, cell_size=cell_size), min_iou=min_iou)
    return (
        attach_child_links(roofs, summary, "parent_building_id", "parent_building_iou"),
        attach_parent_links(
            buildings, summary, "primary_child_roof_id", "primary_child_roof_iou", "child_roofs", "child_roof_count"
        ),
    )
