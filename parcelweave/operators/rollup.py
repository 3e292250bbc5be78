"""One row per area: class metrics, primary features, score statistics, three-valued nulls.

Features shrink to (area, class) rows by partial aggregation first; the second step folds the few
class rows of an area into a map, and every output column is a lookup in that map.  The number of
shuffles does not depend on the number of classes, and a hot area arrives pre-aggregated.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelweave.config import (
    BUILDING_STYLE_CLASSES,
    INCLUDES,
    PRIMARY_CLASSES,
    ROOF_INSTANCE,
    SCORE_FIELDS,
    area_unit,
)
from parcelweave.functions.columns import half_even, label_name, zero_if_null
from parcelweave.operators.chains import drop_deprecated
from parcelweave.operators.primary import point_distance, planar_point_distance, primary_order
from parcelweave.session import cut_lineage

#: Areas of more features than this are always aggregated before they are shuffled.
CROWDED = 100_000


@dataclass(frozen=True)
class FeatureClass:
    """Catalogue entry; ``availability`` is a list of (system_version, status) or None."""

    class_id: str
    description: str
    availability: tuple[tuple[str, str], ...] | None = None

    @property
    def name(self) -> str:
        return label_name(self.description)


@dataclass(frozen=True)
class ApiResult:
    """Which areas a source answered: one row per successful area, and the classes it covers."""

    metadata: DataFrame
    class_ids: Sequence[str] = field(default_factory=tuple)


def select_classes(classes: DataFrame, packs: DataFrame, wanted: Sequence[str] = ()) -> DataFrame:
    """Classes (class_id, description, type) that belong to any of the ``wanted`` packs (pack, class_id).

    Only classes of type ``Feature`` stay; classes of a pack that the catalogue does not describe are
    left out.  Without wanted packs the catalogue comes back as it is.  An unknown pack raises.
    """
    if not wanted:
        return classes
    # Pack names are part of the request, so what comes to the driver is as short as the request.
    found = packs.where(F.col("pack").isin(*wanted))
    unknown = set(wanted) - {r["pack"] for r in found.select("pack").distinct().collect()}
    if unknown:
        raise ValueError(f"unknown packs: {sorted(unknown)}")
    return classes.where(F.col("type") == "Feature").join(found.select("class_id"), "class_id", "left_semi")


def read_catalogue(df: DataFrame) -> list[FeatureClass]:
    """Catalogue table -> plan-time list; it defines output columns, so its size is the schema's."""
    rows = df.orderBy("class_id").collect()
    out = []
    for r in rows:
        avail = r["availability"] if "availability" in df.columns else None
        pairs = None if avail is None else tuple((a["systemVersion"], a["status"]) for a in avail)
        out.append(FeatureClass(r["class_id"], r["description"], pairs))
    return out


def returnable(version: Column, availability: Column, alpha: bool = False, beta: bool = False) -> Column:
    """Can a class be returned at a version?  Unknown version or availability counts as yes."""
    statuses = ["prod"] + (["alpha"] if alpha else []) + (["beta"] if beta else [])
    match = F.exists(availability, lambda a: (a["systemVersion"] == version) & a["status"].isin(*statuses))
    unknown = version.isNull() | (version == "") | availability.isNull()
    return unknown | F.coalesce(match, F.lit(False))


def _returnable_literal(version: Column, cls: FeatureClass, alpha: bool, beta: bool) -> Column:
    if cls.availability is None:
        return F.lit(True)
    ok = {"prod"} | ({"alpha"} if alpha else set()) | ({"beta"} if beta else set())
    versions = [v for v, s in cls.availability if s in ok]
    known = version.isin(*versions) if versions else F.lit(False)
    return version.isNull() | (version == "") | known


def noisy_or(confidence: Column) -> Column:
    """1 - product(1 - c); only NULLs give 0, no rows at all give NULL."""
    return F.when(F.count(F.lit(1)) > 0, 1 - F.coalesce(F.product(1 - confidence), F.lit(1.0)))


def _countable(features: DataFrame) -> Column:
    """Roof instances count only as roofs."""
    counts = (F.col("class_id") != ROOF_INSTANCE) | (F.col("kind") == "roof") if "kind" in features.columns else F.lit(True)
    return F.coalesce(counts, F.lit(False))


def _primary_candidates(features: DataFrame, country: str, method: str, planar: bool) -> tuple[DataFrame, Column]:
    """The features, with a distance where the method asks for it, and the ordering whose minimum is primary."""
    cols = features.columns
    is_ri, countable = F.col("class_id") == ROOF_INSTANCE, _countable(features)
    rows = features
    area = F.when(is_ri, F.col("area_sqm")).otherwise(F.col("clipped_area_sqm"))
    second = F.when(is_ri, F.lit(None)).otherwise(F.col("unclipped_area_sqm"))
    sure = F.when(is_ri, F.col("trust_score") if "trust_score" in cols else F.lit(None)).otherwise(F.col("confidence"))
    distance, has_target = None, None
    if method in ("nearest", "optimal"):
        lat, lon = F.col("lat"), F.col("lon")
        has_target = lat.isNotNull() & lon.isNotNull()
        metres = (
            planar_point_distance(F.col("geometry"), lon, lat, area)
            if planar
            else point_distance(F.col("geometry"), lat, lon, area, country)
        )
        rows = rows.withColumn("_distance", metres)
        distance = F.col("_distance")
    order = primary_order(method, area, second, distance=distance, has_target=has_target, confidence=sure)
    kind_rank = F.when(is_ri & ~countable, 1).otherwise(0)
    order = F.when(order.isNotNull(), F.struct(kind_rank.alias("kind"), order.alias("order")))
    return rows, order


def primary_ids(
    features: DataFrame, class_ids: Sequence[str], country: str, *, method: str = "largest", planar: bool = False
) -> DataFrame:
    """(aoi_id, class_id, feature_id) of the primary features alone: what :func:`class_metrics` chooses, without
    carrying metrics and records along."""
    rows, order = _primary_candidates(features.where(F.col("class_id").isin(*class_ids)), country, method, planar)
    chosen = rows.groupBy("aoi_id", "class_id").agg(F.min_by(F.struct("feature_id"), order).alias("p"))
    return chosen.select("aoi_id", "class_id", F.col("p.feature_id").cast("string").alias("feature_id")).where(F.col("feature_id").isNotNull())


def class_metrics(
    features: DataFrame,
    country: str,
    *,
    method: str = "largest",
    planar: bool = False,
    keep: Sequence[str] = (),
    extra: Sequence[Column] = (),
) -> DataFrame:
    """(aoi_id, class_id) -> count, areas, confidence and the primary feature as a struct.

    Roof instances count only ``kind='roof'``, have a single area, and prefer roof records as
    primary.  ``keep`` names extra feature columns to carry with the primary one, ``extra`` holds more aggregates.
    """
    u = area_unit(country)
    cols = features.columns
    countable = _countable(features)

    def total(name):
        return zero_if_null(F.sum(F.when(countable, F.col(name)))) if name in cols else F.lit(0.0)

    rows, order = _primary_candidates(features, country, method, planar)
    carried = ["feature_id", "confidence", "fidelity", "multiparcel_feature", f"area_{u}", f"clipped_area_{u}", f"unclipped_area_{u}", *keep]
    primary = F.struct(*[(F.col(c) if c in cols else F.lit(None).cast("double")).alias(c) for c in dict.fromkeys(carried)])
    multi = F.sum(F.when(F.col("multiparcel_feature"), 1).otherwise(0)) if "multiparcel_feature" in cols else F.lit(0)
    return rows.groupBy("aoi_id", "class_id").agg(
        F.sum(F.when(countable, 1).otherwise(0)).alias("count"),
        total(f"area_{u}").alias("area"),
        half_even(total(f"clipped_area_{u}"), 1).alias("clipped"),
        half_even(total(f"unclipped_area_{u}"), 1).alias("unclipped"),
        noisy_or(F.col("confidence")).alias("confidence"),
        multi.cast("bigint").alias("multiparcel"),
        F.min_by(primary, order).alias("primary"),
        *extra,
    )


def fold_classes(metrics: DataFrame) -> DataFrame:
    """(aoi_id, class_id) rows -> one map per area; an area has at most catalogue-many classes.

    A column ``mesh`` (mesh_date, feature_id) gives the area's ``mesh_date``: that of the smallest feature id, over
    all classes and features without a class."""
    value = F.struct(*[c for c in metrics.columns if c not in ("aoi_id", "class_id", "mesh")])
    entry = F.when(F.col("class_id").isNotNull(), F.struct("class_id", value.alias("m")))
    aggs = [F.map_from_entries(F.collect_list(entry)).alias("classes")]
    if "mesh" in metrics.columns:
        aggs.append(F.min_by("mesh.mesh_date", "mesh.feature_id").alias("mesh_date"))
    return metrics.groupBy("aoi_id").agg(*aggs).where(F.size("classes") > 0)


def fold_by_area(rows: DataFrame, fold: Callable[[DataFrame], DataFrame], crowded: int = CROWDED) -> DataFrame:
    """``fold`` of ``rows``, which are a stored table, as they are read twice.

    Where areas are small, hardly anything is aggregated before a shuffle, and what aggregates hold is wider than
    the rows.  So rows of such areas meet by area, once for all steps of ``fold``.  Areas of more than ``crowded``
    features, of which there is at most one for so many rows, are folded apart and never meet as rows.
    """
    large = rows.where(F.col("aoi_id").isNotNull()).groupBy("aoi_id").count().where(F.col("count") > crowded)
    large = cut_lineage(large.select("aoi_id"))
    known = rows.where(F.col("aoi_id").isNotNull())
    if large.isEmpty():
        return fold(known.repartition("aoi_id"))
    large = F.broadcast(large)
    small = fold(known.join(large, "aoi_id", "left_anti").repartition("aoi_id"))
    return small.unionByName(fold(known.join(large, "aoi_id", "left_semi")))


def class_columns(cls: FeatureClass, country: str, observed: Column, metrics: Column, has_features: Column) -> dict[str, Column]:
    """All rollup columns of one class.

    Not observed -> NULL; observed without features -> 'N', 0 and no confidence.
    """
    u, n = area_unit(country), cls.name
    ri = cls.class_id == ROOF_INSTANCE

    def seen(value):
        return F.when(observed, value)

    out = {
        f"{n}_present": seen(F.when(F.coalesce(metrics["count"], F.lit(0)) > 0, "Y").otherwise("N")),
        f"{n}_count": seen(F.coalesce(metrics["count"], F.lit(0)).cast("bigint")),
        f"{n}_total_area_{u}": seen(zero_if_null(metrics["area"])),
    }
    if not ri:
        out[f"{n}_total_clipped_area_{u}"] = seen(zero_if_null(metrics["clipped"]))
        out[f"{n}_total_unclipped_area_{u}"] = seen(zero_if_null(metrics["unclipped"]))
        out[f"{n}_confidence"] = seen(half_even(metrics["confidence"], 2))
    if cls.class_id in BUILDING_STYLE_CLASSES:
        out[f"{n}_multiparcel_feature_count"] = seen(
            F.when(has_features, F.coalesce(metrics["multiparcel"], F.lit(0)).cast("bigint"))
        )
    if cls.class_id in PRIMARY_CLASSES:
        p = metrics["primary"]
        for kind in ("area",) if ri else ("area", "clipped_area", "unclipped_area"):
            out[f"primary_{n}_{kind}_{u}"] = seen(zero_if_null(half_even(p[f"{kind}_{u}"], 1)))
        if not ri:
            out[f"primary_{n}_confidence"] = seen(half_even(p["confidence"], 2))
        if cls.class_id in BUILDING_STYLE_CLASSES:
            if not ri:
                out[f"primary_{n}_fidelity"] = p["fidelity"]
            out[f"primary_{n}_multiparcel_feature"] = F.when(p["multiparcel_feature"].cast("boolean"), "Y").when(
                ~p["multiparcel_feature"].cast("boolean"), "N"
            )
        out[f"primary_{n}_feature_id"] = p["feature_id"]
    return out


def parcel_rollup(
    aois: DataFrame,
    features: DataFrame,
    catalogue: Sequence[FeatureClass],
    country: str,
    *,
    method: str = "largest",
    api_results: Sequence[ApiResult] = (),
    alpha: bool = False,
    beta: bool = False,
    planar: bool = False,
    keep: Sequence[str] = (),
    stored: bool = False,
) -> DataFrame:
    """Exactly one row per area of ``aois``.

    ``keep`` columns of primary features come back as a ``primaries`` map class_id -> struct, for
    attribute flattening after the rollup.  ``stored`` features may be read twice: see :func:`fold_by_area`.
    """
    rows = drop_deprecated(features)
    if method in ("nearest", "optimal"):
        rows = rows.drop("lat", "lon").join(aois.select("aoi_id", "lat", "lon"), "aoi_id")
    mesh = []
    if "mesh_date" in features.columns:
        # In the same pass as the metrics, so that features are read (and payloads parsed) once.
        dated = F.when(F.col("mesh_date").isNotNull(), F.col("feature_id"))
        mesh = [F.min_by(F.struct("mesh_date", "feature_id"), dated).alias("mesh")]
    fold = lambda df: fold_classes(class_metrics(df, country, method=method, planar=planar, keep=keep, extra=mesh))
    folded = fold_by_area(rows, fold) if stored else fold(rows)
    base = aois.select("aoi_id").join(folded, "aoi_id", "left")
    covered: dict[str, Column] = {}
    by_id = {c.class_id: c for c in catalogue}
    for i, api in enumerate(api_results):
        ok, version = f"_ok{i}", f"_version{i}"
        sv = F.col("system_version") if "system_version" in api.metadata.columns else F.lit(None).cast("string")
        answered = api.metadata.select("aoi_id", F.lit(True).alias(ok), sv.alias(version))
        base = base.join(answered, "aoi_id", "left")
        for cid in api.class_ids:
            if cid not in by_id:
                continue
            here = F.coalesce(F.col(ok), F.lit(False)) & _returnable_literal(F.col(version), by_id[cid], alpha, beta)
            covered[cid] = covered[cid] & here if cid in covered else here
    has_features = F.col("classes").isNotNull()
    columns: dict[str, Column] = {}
    for cls in catalogue:
        m = F.col("classes")[cls.class_id]
        columns.update(class_columns(cls, country, covered.get(cls.class_id, F.lit(True)), m, has_features))
    extra = ["mesh_date"] if "mesh_date" in features.columns else []
    if keep:
        columns["primaries"] = F.transform_values("classes", lambda _, m: m["primary"])
    return base.select("aoi_id", *[v.alias(k) for k, v in columns.items()], *extra)


def check_row_count(rollup: DataFrame, aois: DataFrame) -> None:
    """Raise unless the rollup has one row per area."""
    n, want = rollup.count(), aois.count()
    if n != want:
        raise RuntimeError(f"rollup has {n} rows for {want} areas")


def weighted_range(
    values: DataFrame, keys: list[str], columns: Sequence[str], area_col: str, digits: dict[str, int] | None = None
) -> DataFrame:
    """Min, max and area-weighted mean of several columns per key; NULL values are left out.

    A missing area weighs 0, and a total weight of 0 gives no mean.
    """
    w = F.coalesce(F.col(area_col), F.lit(0.0))
    aggs = []
    for c in columns:
        weight = F.sum(F.when(F.col(c).isNotNull(), w))
        mean = F.sum(F.col(c) * w) / F.nullif(weight, F.lit(0.0))
        if digits and c in digits:
            mean = half_even(mean, digits[c])
        aggs += [
            F.min(c).alias(f"{c}_min"),
            F.max(c).alias(f"{c}_max"),
            mean.alias(f"{c}_area_weighted_mean"),
        ]
    return values.groupBy(*keys).agg(*aggs)


def score_statistics(resolved: DataFrame, roofs: DataFrame, country_area: str) -> DataFrame:
    """Per area statistics of the resolved headline index (mean to 1 decimal) and peril scores."""
    cols = {"roof_spotlight_index": F.col("rsi.value")}
    for peril, fields in SCORE_FIELDS.items():
        usable = ~F.coalesce(F.col(f"scores.{peril}.skipped"), F.lit(False))
        for key in fields:
            cols[INCLUDES[peril]["fields"][key]] = F.when(usable, F.col(f"scores.{peril}.{key}"))
    flat = resolved.join(roofs.select("aoi_id", "feature_id", F.col(country_area).alias("_area")), ["aoi_id", "feature_id"], "left")
    flat = flat.select("aoi_id", "_area", *[v.alias(k) for k, v in cols.items()])
    return weighted_range(flat, ["aoi_id"], list(cols), "_area", {"roof_spotlight_index": 1})
