"""Walking parent links and joining related features, always inside one area."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelweave.config import BUILDING, BUILDING_LIFECYCLE, DEPRECATED_CLASSES, INCLUDE_COLUMNS, ROOF
from parcelweave.operators.includes import parse_includes

KEY = ["aoi_id", "feature_id"]


def drop_deprecated(features: DataFrame) -> DataFrame:
    """Leave out the two retired classes."""
    return features.where(F.col("class_id").isNull() | ~F.col("class_id").isin(*DEPRECATED_CLASSES))


def forget_roof_parents(features: DataFrame) -> DataFrame:
    """A roof's own ``parent_id`` names a retired class, so it is cleared."""
    return features.withColumn("parent_id", F.when(F.col("class_id") == ROOF, None).otherwise(F.col("parent_id")))


#: Each round follows the pointers that are still open by one parent; ``seen`` ends walks in a circle.
_WALK = """
with recursive walk(aoi_id, start, ptr, seen) max recursion level 1000000 as (
  select s.aoi_id, s.start, n.parent_id, array(s.start)
  from {starts} s join {links} n on n.aoi_id = s.aoi_id and n.feature_id = s.start
  union all
  select w.aoi_id, w.start, n.parent_id, array_append(w.seen, w.ptr)
  from walk w join {links} n on n.aoi_id = w.aoi_id and n.feature_id = w.ptr
  where n.class_id <> :target and not array_contains(w.seen, w.ptr))
select w.aoi_id, w.start, w.ptr as ancestor_id, size(w.seen) as hops
from walk w join {tops} t on t.aoi_id = w.aoi_id and t.feature_id = w.ptr
"""


def walk_up(features: DataFrame, starts: DataFrame, target_class: str) -> DataFrame:
    """(aoi_id, start, ancestor_id): the nearest ancestor of a class for each ``starts`` (aoi_id, start).

    A recursive query, so nothing runs before the caller's action, and its work is that of the starts that
    are still on their way: one hop, as is usual, is one join.  Starts without such an ancestor have no row.
    """
    links = features.where(F.col("feature_id").isNotNull() & F.col("parent_id").isNotNull()).select("aoi_id", "feature_id", "class_id", "parent_id")
    tops = features.where(F.col("class_id") == target_class).select("aoi_id", "feature_id").distinct()
    found = starts.sparkSession.sql(_WALK, args={"target": target_class}, links=links, tops=tops, starts=starts.select("aoi_id", "start").distinct())
    return found.groupBy("aoi_id", "start").agg(F.min_by("ancestor_id", F.struct("hops", "ancestor_id")).alias("ancestor_id"))


def ancestors_of_class(features: DataFrame, target_class: str) -> DataFrame:
    """(aoi_id, feature_id, ancestor_id): nearest ancestor of a class for every feature, NULL if there is none
    or its parents run in a circle."""
    keys = features.where(F.col("feature_id").isNotNull()).select("aoi_id", "feature_id").distinct()
    starts = features.where(F.col("parent_id").isNotNull() & F.col("feature_id").isNotNull()).select("aoi_id", F.col("feature_id").alias("start"))
    return keys.join(walk_up(features, starts, target_class).withColumnRenamed("start", "feature_id"), KEY, "left")


def any_include(columns=INCLUDE_COLUMNS) -> Column:
    """True when at least one include payload is there (skipped ones count)."""
    cond = F.lit(False)
    for c in columns:
        cond = cond | F.col(c).isNotNull()
    return cond


def resolve_scores(features: DataFrame, roof_links: DataFrame) -> DataFrame:
    """Best scores per roof, resolved as whole payloads, never field by field.

    ``roof_links`` holds (aoi_id, feature_id, parent_building_id).  The headline index comes from
    the roof, else its linked building, else that building's lifecycle ancestor.  All other scores
    come from the roof if it has any payload at all, else from the lifecycle ancestor.

    Returns (aoi_id, feature_id, parent_building_id, lifecycle_id, rsi, scores).
    """
    kept = drop_deprecated(features)
    parsed = parse_includes(kept.where(F.col("class_id").isin(ROOF, BUILDING, BUILDING_LIFECYCLE)))
    payload = F.struct(*INCLUDE_COLUMNS).alias("includes")
    base = parsed.select("aoi_id", "feature_id", "class_id", any_include().alias("any"), payload)
    roofs = base.where(F.col("class_id") == ROOF).select("aoi_id", "feature_id", "any", "includes")
    # Both lookups: buildings for the index, lifecycles for everything.
    carriers = base.where(F.col("class_id") != ROOF)
    buildings = carriers.where(F.col("class_id") == BUILDING).select(
        "aoi_id", F.col("feature_id").alias("parent_building_id"),
        F.col("includes.roof_spotlight_index").alias("building_rsi"),
    )
    lifecycles = carriers.where(F.col("class_id") == BUILDING_LIFECYCLE).select(
        "aoi_id", F.col("feature_id").alias("lifecycle_id"), F.col("includes").alias("lifecycle_includes"),
        F.col("any").alias("lifecycle_any"),
    )
    links = roof_links.select("aoi_id", "feature_id", "parent_building_id")
    # Only buildings that a roof names are asked about.
    named = links.where(F.col("parent_building_id").isNotNull()).select("aoi_id", F.col("parent_building_id").alias("start"))
    chain = walk_up(kept, named, BUILDING_LIFECYCLE).select(
        "aoi_id", F.col("start").alias("parent_building_id"), F.col("ancestor_id").alias("lifecycle_id")
    )
    joined = (
        roofs.join(links, KEY, "left")
        .join(buildings, ["aoi_id", "parent_building_id"], "left")
        .join(chain, ["aoi_id", "parent_building_id"], "left")
        .join(lifecycles, ["aoi_id", "lifecycle_id"], "left")
    )
    own = F.col("includes.roof_spotlight_index")
    rsi = F.coalesce(
        F.when(_has_index(own), own),
        F.when(_has_index(F.col("building_rsi")), F.col("building_rsi")),
        F.col("lifecycle_includes.roof_spotlight_index"),
    )
    scores = F.when(F.col("any"), F.col("includes")).when(F.col("lifecycle_any"), F.col("lifecycle_includes"))
    return joined.select(*KEY, "parent_building_id", "lifecycle_id", rsi.alias("rsi"), scores.alias("scores"))


def _has_index(payload: Column) -> Column:
    """An index payload counts if it has a value, a confidence or a model version."""
    return payload["value"].isNotNull() | payload["confidence"].isNotNull() | payload["modelVersion"].isNotNull()


def lifecycle_child_roofs(buildings: DataFrame, roofs: DataFrame, area_col: str) -> DataFrame:
    """(aoi_id, lifecycle id) -> largest child roof and number of child roofs.

    ``roofs`` carry ``parent_building_id``; a building's ``parent_id`` is its lifecycle.
    """
    b = buildings.select("aoi_id", F.col("feature_id").alias("parent_building_id"), F.col("parent_id").alias("lifecycle_id"))
    area = F.coalesce(F.col(area_col), F.lit(0.0))
    return (
        roofs.where(F.col("parent_building_id").isNotNull())
        .select("aoi_id", "parent_building_id", F.col("feature_id").alias("roof_id"), area.alias("_area"))
        .join(b.where(F.col("lifecycle_id").isNotNull()), ["aoi_id", "parent_building_id"])
        .groupBy("aoi_id", "lifecycle_id")
        .agg(
            F.min(F.struct((-F.col("_area")).alias("k"), F.col("roof_id").alias("id")))["id"].alias("primary_child_roof_id"),
            F.count(F.lit(1)).alias("child_roof_count"),
        )
    )


def attach_by_id(
    left: DataFrame, right: DataFrame, id_col: str, columns: list[str], prefix: str
) -> DataFrame:
    """left ⟕ right on (aoi_id, id), right columns prefixed; right ids are made unique first."""
    one = right.groupBy("aoi_id", F.col("feature_id").alias(id_col)).agg(
        F.first(F.struct(*columns)).alias("_r")
    )
    joined = left.join(one, ["aoi_id", id_col], "left")
    return joined.withColumns({f"{prefix}{c}": F.col(f"_r.{c}") for c in columns}).drop("_r")


def child_score_range(links: DataFrame, roof_values: DataFrame, value_col: str) -> DataFrame:
    """Per parent: min and max of a resolved value over all its linked children.

    ``links`` are (aoi_id, parent_id, child_id) pairs, ``roof_values`` (aoi_id, feature_id, value).
    """
    v = roof_values.select("aoi_id", F.col("feature_id").alias("child_id"), F.col(value_col).alias("_v"))
    return (
        links.join(v.where(F.col("_v").isNotNull()), ["aoi_id", "child_id"])
        .groupBy("aoi_id", "parent_id")
        .agg(F.min("_v").alias(f"{value_col}_min"), F.max("_v").alias(f"{value_col}_max"))
    )
