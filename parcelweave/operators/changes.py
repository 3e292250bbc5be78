"""Merging, replacing and comparing result sets."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_sources(*frames: DataFrame) -> DataFrame:
    """Union of feature tables with different columns; missing ones are NULL."""
    out = frames[0]
    for f in frames[1:]:
        out = out.unionByName(f, allowMissingColumns=True)
    return out


def failed_areas(aois: DataFrame, succeeded: DataFrame) -> DataFrame:
    """Areas without an answer."""
    return aois.select("aoi_id").join(succeeded.select("aoi_id"), "aoi_id", "left_anti")


def areas_on_both_sides(left: DataFrame, right: DataFrame) -> DataFrame:
    """Areas present in both feature sets."""
    return left.select("aoi_id").distinct().join(right.select("aoi_id"), "aoi_id", "left_semi")


def retry_areas(errors: DataFrame, aois: DataFrame | None = None) -> DataFrame:
    """Areas to ask again: answered 404 and not pinned to one survey."""
    ids = errors.where(F.col("status_code") == 404).select("aoi_id").distinct()
    if aois is not None and "survey_resource_id" in aois.columns:
        free = aois.where(F.col("survey_resource_id").isNull()).select("aoi_id")
        ids = ids.join(hashed(free), "aoi_id", "left_semi")
    return ids


def hashed(ids: DataFrame) -> DataFrame:
    """Ids as the side of a join that tasks hold: each holds its share of them, and the rows that
    are asked for are not sorted."""
    return ids.hint("shuffle_hash")


def merge_passes(first: DataFrame, second: DataFrame, retried: DataFrame) -> DataFrame:
    """First-pass rows survive unless their area was retried; then all of them give way.

    Works the same for features, metadata and errors.
    """
    return first.join(hashed(retried.select("aoi_id")), "aoi_id", "left_anti").unionByName(second, allowMissingColumns=True)


def distinct_requests(requests: DataFrame, parameters: Sequence[str]) -> DataFrame:
    """(request_key, parameters, n_areas): each distinct request once, to be fetched once."""
    return (
        requests.groupBy(*parameters).agg(F.count(F.lit(1)).alias("n_areas"))
        .withColumn("request_key", F.sha2(F.to_json(F.struct(*parameters)), 256))
    )


def fan_out_responses(requests: DataFrame, responses: DataFrame, parameters: Sequence[str]) -> DataFrame:
    """Hand each distinct response back to every area that asked for it."""
    keyed = requests.withColumn("request_key", F.sha2(F.to_json(F.struct(*parameters)), 256))
    return keyed.join(responses.drop(*parameters), "request_key", "left")


def pending_areas(aois: DataFrame, completed: DataFrame) -> DataFrame:
    """Areas not yet in the completed rollup."""
    return aois.join(completed.select("aoi_id"), "aoi_id", "left_anti")


def rollup_diff(before: DataFrame, after: DataFrame, metrics: Sequence[str], *, key: str = "aoi_id") -> DataFrame:
    """Full outer comparison of two vintages: status per area and delta per metric."""
    b = before.select(F.col(key).alias("_b"), *[F.col(m).alias(f"{m}_before") for m in metrics])
    a = after.select(F.col(key).alias("_a"), *[F.col(m).alias(f"{m}_after") for m in metrics])
    joined = b.join(a, F.col("_b") == F.col("_a"), "full_outer")
    same = F.lit(True)
    for m in metrics:
        same = same & F.col(f"{m}_before").eqNullSafe(F.col(f"{m}_after"))
    status = (
        F.when(F.col("_b").isNull(), "added").when(F.col("_a").isNull(), "removed").when(same, "unchanged").otherwise("changed")
    )
    deltas = [(F.col(f"{m}_after") - F.col(f"{m}_before")).alias(f"{m}_delta") for m in metrics]
    return joined.select(
        F.coalesce("_b", "_a").alias(key), status.alias("status"),
        *[c for m in metrics for c in (f"{m}_before", f"{m}_after")], *deltas,
    )
