"""Choosing one primary feature per group.

The choice is a ``min_by`` over a composite ordering, not a ranking window: partial aggregation
keeps one candidate per group and task, so a group holding a third of all rows shuffles only a
few rows and never has to be sorted as a whole.  Ties break on ``feature_id``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelweave.config import HIGH_CONFIDENCE, NEAREST_TOLERANCE_M, SMALL_BUILDING_SQM
from parcelweave.functions import geometry as G

METHODS = ("largest", "largest_intersection", "nearest", "optimal")


def _descending(value: Column | None) -> list[Column]:
    """Sort keys for 'largest first, NULL last' under an ascending minimum."""
    if value is None:
        return []
    return [value.isNull(), -value]


def largest_order(area: Column, secondary: Column | None = None, tie: Column | None = None) -> Column:
    """Ordering whose minimum is the largest feature."""
    keys = _descending(area) + _descending(secondary) + [F.col("feature_id") if tie is None else tie]
    return F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)])


def point_distance(geom: Column, lat: Column, lon: Column, area: Column, country: str) -> Column:
    """Metres from the target point to the shape; NULL for small shapes or a missing target.

    Strictly larger than the small-building area counts as non-small.
    """
    px, py = G.project_xy(lon, lat, country)
    usable = lat.isNotNull() & lon.isNotNull() & (area > F.lit(SMALL_BUILDING_SQM))
    return F.when(usable, G.distance_to_point(G.project(geom, country), px, py))


def planar_point_distance(geom: Column, x: Column, y: Column, area: Column) -> Column:
    """Same rule for geometry that is planar already."""
    usable = x.isNotNull() & y.isNotNull() & (area > F.lit(SMALL_BUILDING_SQM))
    return F.when(usable, G.distance_to_point(geom, x, y))


def primary_order(
    method: str,
    area: Column,
    secondary: Column | None = None,
    *,
    distance: Column | None = None,
    has_target: Column | None = None,
    confidence: Column | None = None,
    tie: Column | None = None,
    tolerance: float = NEAREST_TOLERANCE_M,
    high_confidence: float = HIGH_CONFIDENCE,
) -> Column:
    """Composite ordering of the chosen method; NULL marks a feature that must not win.

    Tier 0 contains the target, tier 1 lies within tolerance, tier 2 competes by size.  Within
    tier 0 and 1 high confidence goes first, then (tier 1 only) the smaller distance.  Without a
    target every method falls back to size.
    """
    if method not in METHODS:
        raise ValueError(f"method must be one of {METHODS}, not {method!r}")
    tie = F.col("feature_id") if tie is None else tie
    if method in ("largest", "largest_intersection"):
        return largest_order(area, secondary, tie)
    tier = F.when(distance == 0, 0).when(distance <= tolerance, 1).otherwise(2)
    sure = F.lit(0) if confidence is None else F.when(confidence >= high_confidence, 0).otherwise(1)
    by_point = tier < 2
    size = [F.when(by_point, F.lit(None)).otherwise(k) for k in _descending(area) + _descending(secondary)]
    keys = [tier, F.when(by_point, sure).otherwise(0), F.when(tier == 1, distance).otherwise(0.0), *size, tie]
    order = F.struct(*[k.alias(f"k{i}") for i, k in enumerate(keys)])
    if method == "nearest":
        target = F.lit(True) if has_target is None else has_target
        return F.when(~target | by_point, order)
    return order


def select_primary(
    features: DataFrame,
    keys: list[str],
    method: str = "largest",
    *,
    area_col: str = "clipped_area_sqm",
    secondary_col: str | None = "unclipped_area_sqm",
    confidence_col: str | None = "confidence",
    country: str | None = None,
    lat_col: str = "lat",
    lon_col: str = "lon",
    geometry_col: str = "geometry",
    planar: bool = False,
    rank_first: Column | None = None,
    columns: list[str] | None = None,
) -> DataFrame:
    """One winning row per ``keys`` group, with all its columns, or the keys and ``columns`` only: the rest then
    neither travels nor is sorted.

    ``rank_first`` is an optional leading sort key (smaller wins), e.g. "linked to the primary
    roof" before "is a roof record" before the rest.
    """
    secondary = F.col(secondary_col) if secondary_col and secondary_col in features.columns else None
    confidence = F.col(confidence_col) if confidence_col and confidence_col in features.columns else None
    rows, distance, has_target = features, None, None
    if method in ("nearest", "optimal"):
        lat, lon, geom, area = (F.col(c) for c in (lat_col, lon_col, geometry_col, area_col))
        has_target = lat.isNotNull() & lon.isNotNull()
        metres = (
            planar_point_distance(geom, lon, lat, area)
            if planar
            else point_distance(geom, lat, lon, area, country or "us")
        )
        rows = rows.withColumn("_distance", metres)
        distance = F.col("_distance")
    order = primary_order(
        method, F.col(area_col), secondary, distance=distance, has_target=has_target, confidence=confidence
    )
    if rank_first is not None:
        order = F.when(order.isNotNull(), F.struct(rank_first.alias("first"), order.alias("then")))
    wanted = list(features.columns) if columns is None else [*keys, *[c for c in columns if c not in keys]]
    others = [c for c in wanted if c not in keys]
    # Only the order and the wanted columns reach the aggregation, each once.
    ranked = rows.select(*keys, order.alias("_order"), F.struct(F.lit(True).alias("_any"), *others).alias("_row"))
    best = ranked.groupBy(*keys).agg(F.min_by("_row", "_order").alias("_winner")).where(F.col("_winner").isNotNull())
    return best.select(*[F.col(c) if c in keys else F.col(f"_winner.{c}").alias(c) for c in wanted])


def linked_instance_rank(linked_id: Column) -> Column:
    """Leading key for roof instances: the primary roof's linked child, then roofs, then all."""
    return F.when(F.col("feature_id") == linked_id, 0).when(F.col("kind") == "roof", 1).otherwise(2)


def mark_primary(features: DataFrame, primary_ids: DataFrame) -> DataFrame:
    """Add ``is_primary`` from (aoi_id, class_id, feature_id) rows; ids compare as text.

    The feature side keeps its columns and row count: ids are made distinct before the join.
    """
    ids = primary_ids.select(
        F.col("aoi_id").cast("string").alias("_aoi"),
        F.col("class_id").alias("_class"),
        F.col("feature_id").cast("string").alias("_feature"),
    ).where(F.col("_feature").isNotNull()).distinct().withColumn("_hit", F.lit(True))
    on = (
        (F.col("aoi_id").cast("string") == F.col("_aoi"))
        & (F.col("class_id") == F.col("_class"))
        & (F.col("feature_id").cast("string") == F.col("_feature"))
    )
    joined = features.join(ids, on, "left")
    return joined.withColumn("is_primary", F.col("_hit").isNotNull()).drop("_aoi", "_class", "_feature", "_hit")


def stack_primary_ids(rollup: DataFrame, id_columns: dict[str, str]) -> DataFrame:
    """Rollup's ``primary_*_feature_id`` columns -> (aoi_id, class_id, feature_id) rows."""
    present = [(c, k) for c, k in id_columns.items() if c in rollup.columns]
    pairs = F.array(
        *[F.struct(F.lit(k).alias("class_id"), F.col(f"`{c}`").cast("string").alias("feature_id")) for c, k in present]
    )
    return (
        rollup.select("aoi_id", F.explode(pairs).alias("p"))
        .select("aoi_id", "p.class_id", "p.feature_id")
        .where(F.col("feature_id").isNotNull())
    )
