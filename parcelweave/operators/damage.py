"""Event-damage rollup: one row per area with rating counts and the primary building."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelweave.config import DAMAGE_EVENT_COLUMNS, DAMAGE_RATINGS, area_unit
from parcelweave.operators.primary import planar_point_distance, point_distance, primary_order

PRIMARY_BASE = ("feature_id", "area_sqm", "area_sqft", "confidence", "hilbert_id")


def conflation_rollup(
    aois: DataFrame,
    buildings: DataFrame,
    country: str,
    *,
    successful: DataFrame | None = None,
    method: str = "largest",
    planar: bool = False,
) -> DataFrame:
    """Counts per rating, event metadata and primary building.

    An area without a successful answer has NULL counts and no primary; an empty one has zeros.
    ``nearest`` counts as ``optimal``; both need lat/lon on the areas, else the largest wins.
    """
    ratings = {k: f"n_{v}" for k, v in DAMAGE_RATINGS.items()}
    wrong = "area_sqm" if area_unit(country) == "sqft" else "area_sqft"
    attrs = [c for c in buildings.columns if (c.startswith("damage_") or c in PRIMARY_BASE) and c != wrong]
    by_point = method in ("optimal", "nearest") and {"lat", "lon"} <= set(aois.columns)

    rows, distance, has_target = buildings, None, None
    if by_point:
        rows = rows.drop("lat", "lon").join(aois.select("aoi_id", "lat", "lon"), "aoi_id")
        lat, lon = F.col("lat"), F.col("lon")
        has_target = lat.isNotNull() & lon.isNotNull()
        metres = (
            planar_point_distance(F.col("geometry"), lon, lat, F.col("area_sqm"))
            if planar
            else point_distance(F.col("geometry"), lat, lon, F.col("area_sqm"), country)
        )
        rows = rows.withColumn("_distance", metres)
        distance = F.col("_distance")
    order = primary_order(
        "optimal" if by_point else "largest", F.col("area_sqm"),
        distance=distance, has_target=has_target, confidence=F.col("confidence") if by_point else None,
    )
    grouped = rows.groupBy("aoi_id").agg(
        F.count(F.lit(1)).alias("n_buildings"),
        *[F.count_if(F.col("damage_event_rating") == k).alias(n) for k, n in ratings.items()],
        F.min_by(F.struct(*attrs), order).alias("_primary"),
    )
    if successful is None:
        status = aois.select("aoi_id", F.lit(True).alias("query_succeeded"))
    else:
        ok = successful.select("aoi_id").distinct().withColumn("query_succeeded", F.lit(True))
        status = aois.select("aoi_id").join(ok, "aoi_id", "left").withColumn(
            "query_succeeded", F.coalesce("query_succeeded", F.lit(False))
        )
    # Event metadata is constant over an export: one non-null value per column, as a scalar.
    meta_cols = [c for c in DAMAGE_EVENT_COLUMNS if c in buildings.columns]
    out = status.join(grouped, "aoi_id", "left")
    if meta_cols:
        meta = buildings.agg(*[F.min(c).alias(c) for c in meta_cols]).select(F.struct(*meta_cols)).scalar()
        out = out.withColumn("_meta", meta)
    ok = F.col("query_succeeded")
    return out.select(
        "aoi_id",
        "query_succeeded",
        *[F.col(f"_meta.{c}").alias(c) for c in meta_cols],
        F.when(ok, F.coalesce("n_buildings", F.lit(0))).cast("bigint").alias("n_buildings"),
        *[F.when(ok, F.coalesce(n, F.lit(0))).cast("bigint").alias(n) for n in ratings.values()],
        *[F.when(ok, F.col(f"_primary.{c}")).alias(f"primary_{c}") for c in attrs],
    )
