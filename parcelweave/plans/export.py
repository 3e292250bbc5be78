"""The unified export as lazy plans: features, metadata and areas in, tables out."""

from __future__ import annotations

import functools
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelweave.config import (
    BUILDING,
    BUILDING_LIFECYCLE,
    INCLUDES,
    METADATA_COLUMNS,
    PERILS,
    POOL,
    PRIMARY_ID_COLUMNS,
    ROOF,
    ROOF_AGE_COLUMNS,
    ROOF_INSTANCE,
    area_unit,
)
from parcelweave.functions.columns import age_years, half_even
from parcelweave.operators import attributes, chains, includes, linking, rollup, spatial
from parcelweave.operators.changes import union_sources
from parcelweave.operators.primary import mark_primary, stack_primary_ids
from parcelweave.operators.stats import success_flags
from parcelweave.session import cut_lineage
from parcelweave.sources import sinks


@dataclass
class ExportInputs:
    """Tables of one run, already parsed."""

    aois: DataFrame
    features: DataFrame
    metadata: DataFrame
    catalogue: Sequence[rollup.FeatureClass]
    roof_instances: DataFrame | None = None
    roof_age_metadata: DataFrame | None = None
    feature_errors: DataFrame | None = None
    roof_age_errors: DataFrame | None = None


def linked_features(
    inputs: ExportInputs, country: str, *, cell_size: float = 0.002, materialize: bool = True
) -> DataFrame:
    """Features of both sources with all link columns, retired classes dropped.

    Roofs, buildings and roof instances get their links by joining back small id tables; other classes take
    no part in these joins.  Every
    output table starts from this one, so it is written to the shared folder once and read back
    column by column instead of being linked again per output.
    """
    keep = cut_lineage if materialize else lambda df: df
    base = chains.forget_roof_parents(chains.drop_deprecated(inputs.features))
    roofs, buildings = (base.where(F.col("class_id") == c) for c in (ROOF, BUILDING))
    # Pairs meet once for all that is joined back from them.
    to_building = keep(linking.link_summary(linking.iou_pairs(roofs, buildings, cell_size=cell_size)))
    parts, instances = [base.where(~F.coalesce(F.col("class_id").isin(ROOF, BUILDING), F.lit(False)))], []
    of_roofs = {"parent_id": "parent_building_id", "parent_iou": "parent_building_iou"}
    linked_roofs = _attach(roofs, to_building, "child", of_roofs)
    if inputs.roof_instances is not None:
        ri = sinks.with_instance_sqft(inputs.roof_instances, country)
        ri = ri.withColumn("roof_age_years_as_of_date", age_years(F.col("installation_date"), F.col("as_of_date")))
        to_roof = keep(linking.link_summary(linking.iou_pairs(ri, roofs, cell_size=cell_size), with_kind=True))
        ri = _attach(ri.drop("parent_id", "parent_iou"), to_roof, "child", {"parent_id": "parent_id", "parent_iou": "parent_iou"})
        instances.append(ri.withColumn("parent_iou", F.coalesce(F.col("parent_iou"), F.lit(0.0))))
        linked_roofs = _attach(linked_roofs, to_roof, "parent", {
            "primary_child_id": "primary_child_roof_age_feature_id", "primary_child_iou": "primary_child_roof_age_iou",
            "children": "child_roof_instances", "child_count": "child_roof_instance_count",
        })
    parts.append(linked_roofs)
    parts.append(_attach(buildings, to_building, "parent", {
        "primary_child_id": "primary_child_roof_id", "primary_child_iou": "primary_child_roof_iou",
        "children": "child_roofs", "child_count": "child_roof_count",
    }))
    return keep(union_sources(*parts, *instances))


def _attach(features: DataFrame, summary: DataFrame, role: str, names: dict[str, str]) -> DataFrame:
    """Features of one class ⟕ their links.  What is just its upright box travels as that box."""
    s = summary.where(F.col("role") == role).select("aoi_id", "feature_id", *[F.col(a).alias(b) for a, b in names.items()])
    if not {"geometry", "bbox"} <= set(features.columns):
        return features.join(s, ["aoi_id", "feature_id"], "left")
    outline = linking.as_outline(F.col("bbox"))
    plain = F.coalesce(F.col("geometry") == outline, F.lit(False))
    packed = features.withColumn("_plain", plain).withColumn("geometry", F.when(~F.col("_plain"), F.col("geometry")))
    joined = packed.join(s, ["aoi_id", "feature_id"], "left")
    return joined.withColumn("geometry", F.when(F.col("_plain"), outline).otherwise(F.col("geometry"))).drop("_plain")


def parcel_tables(
    inputs: ExportInputs, country: str, *, method: str = "largest", alpha: bool = False, beta: bool = False,
    linked: DataFrame | None = None, recalculate_clipped: bool = True, gridded_aois: DataFrame | None = None,
    cell_size: float = 0.002, component_names: Sequence[str] | None = None, model_input_names: Sequence[str] | None = None,
    zones: Sequence[int] | None = None, storeys: Sequence[str] | None = None, damage_names: Sequence[str] | None = None,
) -> DataFrame:
    """The rollup: one row per area with class metrics, primary attributes and resolved scores.

    Dynamic column families (components, model inputs, storeys, damage classes, zones) come out for
    the declared names, or, where none are declared, for every name that occurs in the run.
    Components of clipped primary roofs are recomputed from child outlines, as in :func:`roof_table`;
    roofs of ``gridded_aois`` are clipped to their area first.
    """
    linked = linked if linked is not None else linked_features(inputs, country)
    keep = ["attributes", "damage", "primary_child_roof_age_feature_id", *ROOF_AGE_COLUMNS]
    keep = [c for c in keep if c in linked.columns]
    feature_ids = [c.class_id for c in inputs.catalogue if c.class_id != ROOF_INSTANCE]
    apis = [rollup.ApiResult(inputs.metadata, feature_ids)]
    if inputs.roof_age_metadata is not None:
        apis.append(rollup.ApiResult(inputs.roof_age_metadata, [ROOF_INSTANCE]))
    base = rollup.parcel_rollup(
        inputs.aois, linked, inputs.catalogue, country, method=method, api_results=apis, alpha=alpha, beta=beta, keep=keep, stored=True
    )
    roofs = linked.where(F.col("class_id") == ROOF)
    if recalculate_clipped and "primary_roof_feature_id" in base.columns and "geometry" in linked.columns:
        parents = spatial.clip_gridded_roofs(roofs, gridded_aois) if gridded_aois is not None else roofs
        redo = spatial.component_overlaps(parents, linked.where(F.col("class_id") != ROOF), country, cell_size=cell_size)
        redo = redo.select("aoi_id", F.col("feature_id").alias("primary_roof_feature_id"), F.col("recalc").alias("_recalc"))
        base = base.join(redo, ["aoi_id", "primary_roof_feature_id"], "left")
    # Read for the names, the primary roofs and the statistics.
    resolved = cut_lineage(chains.resolve_scores(linked, roofs.select("aoi_id", "feature_id", "parent_building_id")))
    names = dict(component=component_names, model_input=model_input_names, zone=zones, storey=storeys, damage=damage_names)
    if any(v is None for v in names.values()):
        found = dynamic_names(linked, resolved, inputs.metadata, country)
        names = {k: found[k] if v is None else v for k, v in names.items()}
    out = primary_attributes(base, country, inputs.catalogue, names["component"], names["storey"], names["damage"])
    if inputs.roof_instances is not None:
        out = _linked_primary_instance(out, linked, country)
    out = primary_scores(out, resolved, country, names["model_input"], names["zone"])
    stats = rollup.score_statistics(resolved, roofs, f"clipped_area_{area_unit(country)}")
    out = out.join(stats, "aoi_id", "left")
    if "aggregate" in inputs.metadata.columns:
        out = out.join(aggregate_zones(inputs.metadata, country, names["zone"]), "aoi_id", "left")
    return out.drop("primaries")


def dynamic_names(linked: DataFrame, resolved: DataFrame, metadata: DataFrame, country: str) -> dict[str, list]:
    """Names of each dynamic column family that occur in the run, sorted.

    They are reduced to distinct names in Spark; how many there are is set by the class catalogue, not by
    the number of features.  Zones hold the three known ones at least.
    """
    u = area_unit(country)
    attrs = attributes.parse_attributes(F.col("attributes"))
    has = linked.columns

    def tagged(kind: str, keys) -> Column:
        return F.transform(F.coalesce(keys, F.array().cast("array<string>")), lambda k: F.struct(F.lit(kind).alias("kind"), k.alias("name")))

    frames = []
    if "attributes" in has:
        numbers = F.map_keys(attributes.to_map(attributes.component_numbers(attrs, country)))
        storeys = F.map_keys(attributes.building_3d_columns(attrs, country)["storeys"])
        per = F.when(F.col("class_id").isin(ROOF, POOL), tagged("component", numbers)).when(F.col("class_id") == BUILDING, tagged("storey", storeys))
        frames.append(linked.where(F.col("class_id").isin(ROOF, POOL, BUILDING)).select(F.explode(per).alias("x")))
    if "damage" in has:
        lifecycles = attributes.flatten_lifecycle_damage(linked.where(F.col("class_id") == BUILDING_LIFECYCLE).select("damage"))
        frames.append(lifecycles.select(F.explode(tagged("damage", F.map_keys("damage_numbers"))).alias("x")))
    inputs = [F.coalesce(F.map_keys(includes.model_inputs(k, F.col(f"scores.{k}"))), F.array().cast("array<string>")) for k in PERILS]
    ds = F.map_keys(includes.defensible_space_metrics(F.col("scores.defensible_space"), country))
    frames.append(resolved.select(F.explode(F.concat(tagged("model_input", F.concat(*inputs)), tagged("zone", ds))).alias("x")))
    if "aggregate" in metadata.columns:
        payload = includes.parse_include("defensible_space", F.get_json_object("aggregate", "$.defensibleSpace"))
        own = metadata.select(payload.alias("p")).select(F.map_keys(includes.defensible_space_metrics(F.col("p"), country)).alias("k"))
        frames.append(own.select(F.explode(tagged("zone", F.col("k"))).alias("x")))
    rows = functools.reduce(DataFrame.unionByName, frames).select("x.*").distinct().collect()
    out = {k: set() for k in ("component", "storey", "damage", "model_input", "zone")}
    for kind, name in rows:
        if kind == "component" and name.endswith(f"_area_{u}"):
            out[kind].add(name.removesuffix(f"_area_{u}"))
        elif kind == "storey":
            out[kind].add(name.removeprefix("num_storeys_").removesuffix("_confidence"))
        elif kind == "zone":
            out[kind].add(int(name.removeprefix("defensible_space_zone_").partition("_")[0]))
        elif kind in ("damage", "model_input"):
            out[kind].add(name)
    out["zone"] |= {0, 1, 2}
    return {k: sorted(v) for k, v in out.items()}


def primary_attributes(
    base: DataFrame, country: str, catalogue, component_names=(), storeys=(), damage_names=()
) -> DataFrame:
    """Flatten the attributes of each primary feature, one per area and class, into columns."""
    u = area_unit(country)
    ids = {c.class_id: c.name for c in catalogue}
    parsed, cols = {}, {}
    p = F.col("primaries")
    if ROOF in ids:
        attrs = F.col("_roof_attrs")
        head = f"primary_{ids[ROOF]}_"
        parsed["_roof_attrs"] = attributes.parse_attributes(p[ROOF]["attributes"])
        recalc = F.col("_recalc") if "_recalc" in base.columns else None
        cols.update(attributes.dominants(attrs, country, recalc))
        cols.update({head + k: v for k, v in attributes.roof_3d_columns(attrs).items()})
        cols["_roof_numbers"] = attributes.to_map(attributes.component_numbers(attrs, country, recalc))
        cols["_roof_texts"] = attributes.to_map(attributes.component_texts(attrs, recalc))
    if BUILDING in ids:
        attrs = F.col("_building_attrs")
        parsed["_building_attrs"] = attributes.parse_attributes(p[BUILDING]["attributes"])
        for k, v in attributes.building_3d_columns(attrs, country).items():
            cols["_storeys" if k == "storeys" else f"primary_{ids[BUILDING]}_{k}"] = v
    if POOL in ids:
        attrs = F.col("_pool_attrs")
        parsed["_pool_attrs"] = attributes.parse_attributes(p[POOL]["attributes"])
        cols["_pool_numbers"] = attributes.to_map(attributes.component_numbers(attrs, country))
        cols["_pool_texts"] = attributes.to_map(attributes.component_texts(attrs))
    staged = base.withColumns(parsed).withColumns(cols)
    if ROOF in ids:
        staged = staged.withColumns({f"primary_{ids[ROOF]}_{k}": v for k, v in attributes.dominant_columns(country).items()})
    staged = staged.drop(*parsed, "_dominant_roof_material", "_dominant_roof_types")
    if BUILDING_LIFECYCLE in ids:
        damage = attributes.flatten_lifecycle_damage(staged.withColumn("damage", p[BUILDING_LIFECYCLE]["damage"])).drop("damage")
        head = f"primary_{ids[BUILDING_LIFECYCLE]}_"
        staged = damage.withColumnsRenamed({c: head + c for c in ("damage_class", "damage_class_confidence")})
        staged = staged.withColumn(f"{head}damage_class_confidence", half_even(F.col(f"{head}damage_class_confidence"), 2))
        staged = staged.withColumns({
            head + n: half_even(F.col("damage_numbers")[n], 2) if n.endswith("_confidence") else F.col("damage_numbers")[n]
            for n in damage_names
        }).drop("damage_numbers")
    named = {}
    for n in component_names:
        for kind, cid in (("roof", ROOF), ("pool", POOL)):
            if cid in ids:
                for m in (f"area_{u}", "confidence", "ratio"):
                    value = F.col(f"_{kind}_numbers")[f"{n}_{m}"]
                    named[f"primary_{ids[cid]}_{n}_{m}"] = half_even(value, 2) if m == "confidence" else value
                for m in ("present", "dominant"):
                    named[f"primary_{ids[cid]}_{n}_{m}"] = F.col(f"_{kind}_texts")[f"{n}_{m}"]
    for k in storeys:
        if BUILDING in ids:
            named[f"primary_{ids[BUILDING]}_num_storeys_{k}_confidence"] = half_even(
                F.col("_storeys")[f"num_storeys_{k}_confidence"], 2
            )
    return staged.withColumns(named).drop("_roof_numbers", "_roof_texts", "_storeys", "_pool_numbers", "_pool_texts", "_recalc")


def _linked_primary_instance(out: DataFrame, linked: DataFrame, country: str) -> DataFrame:
    """The primary roof's linked instance replaces the independently chosen one where it exists."""
    u = area_unit(country)
    instances = linked.where(F.col("class_id") == ROOF_INSTANCE)
    wanted = F.col("primaries")[ROOF]["primary_child_roof_age_feature_id"]
    cols = [c for c in ROOF_AGE_COLUMNS if c in instances.columns]
    ri = instances.groupBy("aoi_id", F.col("feature_id").alias("_want")).agg(
        F.first(F.struct("feature_id", f"area_{u}", *cols)).alias("_linked")
    )
    staged = out.withColumn("_want", wanted).join(ri, ["aoi_id", "_want"], "left")
    own = F.col("primaries")[ROOF_INSTANCE]
    chosen = {c: F.when(F.col("_linked").isNotNull(), F.col(f"_linked.{c}")).otherwise(own[c]) for c in ["feature_id", f"area_{u}", *cols]}
    staged = staged.withColumns({
        "primary_roof_instance_feature_id": chosen["feature_id"],
        f"primary_roof_instance_area_{u}": F.coalesce(half_even(chosen[f"area_{u}"], 1), F.col(f"primary_roof_instance_area_{u}")),
        **{f"_ri_{c}": chosen[c] for c in cols},
    })
    renamed = staged.select(*[c for c in staged.columns if not c.startswith("_ri_")], F.struct(*[F.col(f"_ri_{c}").alias(c) for c in cols]).alias("_ri"))
    plain = renamed.select("*", "_ri.*")
    flat = attributes.roof_instance_columns(cols, prefix="primary_roof_instance_")
    return plain.withColumns(flat).drop("_ri", "_want", "_linked", *cols)


def primary_scores(out: DataFrame, resolved: DataFrame, country: str, model_input_names=(), zones=(0, 1, 2)) -> DataFrame:
    """Resolved index and scores of the primary roof as ``primary_*`` columns."""
    s = resolved.select("aoi_id", F.col("feature_id").alias("primary_roof_feature_id"), "rsi", "scores")
    staged = out.join(s, ["aoi_id", "primary_roof_feature_id"], "left")
    cols = {
        "primary_roof_spotlight_index": F.col("rsi.value"),
        "primary_roof_spotlight_index_confidence": half_even(F.col("rsi.confidence"), 2),
        "primary_roof_spotlight_index_model_version": F.col("rsi.modelVersion"),
        "primary_roof_spotlight_index_skipped": includes.include_columns(
            "roof_spotlight_index", F.col("scores.roof_spotlight_index")
        )["roof_spotlight_index_skipped"],
    }
    for peril in PERILS:
        payload = F.col(f"scores.{peril}")
        cols.update({f"primary_{k}": v for k, v in includes.include_columns(peril, payload).items()})
        names = [n for n in model_input_names if n.startswith(INCLUDES[peril]["model_input_prefix"])]
        inputs = includes.model_inputs(peril, payload)
        cols.update({f"primary_{n}": inputs[n] for n in names})
    ds = F.col("scores.defensible_space")
    metrics = includes.defensible_space_metrics(ds, country)
    cols["primary_defensible_space_skipped"] = F.when(ds.isNotNull(), F.coalesce(ds["skipped"], F.lit(False)))
    cols["primary_defensible_space_model_version"] = ds["modelVersion"]
    staged = staged.withColumn("_ds", metrics)
    cols.update({f"primary_{n}": F.col("_ds")[n] for n in includes.zone_column_order(country, tuple(zones), "defensible_space_zone")})
    return staged.withColumns(cols).drop("rsi", "scores", "_ds")


def aggregate_zones(metadata: DataFrame, country: str, zones: Sequence[int] = (0, 1, 2)) -> DataFrame:
    """Area-level defensible space from the metadata's aggregate section."""
    text = F.get_json_object("aggregate", "$.defensibleSpace")
    payload = includes.parse_include("defensible_space", text)
    prefix = "aggregate_defensible_space_zone"
    staged = metadata.select("aoi_id", payload.alias("_p")).withColumn(
        "_m", includes.defensible_space_metrics(F.col("_p"), country, prefix)
    )
    return staged.select(
        "aoi_id",
        F.when(F.col("_p").isNotNull(), F.coalesce(F.col("_p.skipped"), F.lit(False))).alias("aggregate_defensible_space_skipped"),
        *[F.col("_m")[n].alias(n) for n in includes.zone_column_order(country, tuple(zones), prefix)],
    )


def zone_columns(country: str, zones: Sequence[int] = (0, 1, 2)) -> list[str]:
    """All zone columns in output order: the primary roof's, then the aggregate's."""
    return [
        *[f"primary_{c}" for c in includes.zone_column_order(country, tuple(zones), "defensible_space_zone")],
        *includes.zone_column_order(country, tuple(zones), "aggregate_defensible_space_zone"),
    ]


def finished_rollup(rollup_df: DataFrame, inputs: ExportInputs, country: str) -> DataFrame:
    """Rollup ⟕ metadata ⋈ areas with success flags, the output's column order and units."""
    meta = sinks.rename_clashes(inputs.metadata, inputs.aois)
    meta_cols = [c for c in meta.columns if c in METADATA_COLUMNS or c.startswith("source_")]
    meta = meta.select("aoi_id", *[F.col(c).alias("_meta_mesh_date" if c == "mesh_date" else c) for c in meta_cols])
    out = rollup_df.join(meta, "aoi_id", "left").join(inputs.aois.drop("geometry"), "aoi_id", "inner")
    if "_meta_mesh_date" in out.columns:
        own = F.col("mesh_date") if "mesh_date" in rollup_df.columns else F.lit(None).cast("string")
        out = out.withColumn("mesh_date", F.coalesce(own, F.col("_meta_mesh_date"))).drop("_meta_mesh_date")
    flags = {}
    if inputs.feature_errors is not None:
        flags["feature_api"] = inputs.feature_errors
    if inputs.roof_age_errors is not None:
        flags["roof_age_api"] = inputs.roof_age_errors
    if flags:
        out = out.join(success_flags(inputs.aois, flags), "aoi_id", "left")
    out = sinks.ensure_columns(out, METADATA_COLUMNS)
    aoi_cols = [c for c in inputs.aois.columns if c not in ("aoi_id", "geometry")]
    return sinks.order_columns(out, aoi_cols, [*meta_cols, *METADATA_COLUMNS], zone_columns(country))


def feature_output(
    linked: DataFrame, inputs: ExportInputs, rollup_df: DataFrame | None, country: str, *, method: str = "largest"
) -> DataFrame:
    """Metadata ⋈ features ⋈ areas with ``is_primary``; one unit family, outlines only.

    Without a rollup the primary features of the run's classes are chosen here, by their ids alone.
    """
    if rollup_df is not None:
        chosen = stack_primary_ids(rollup_df, PRIMARY_ID_COLUMNS)
    else:
        known = {c.class_id for c in inputs.catalogue} & set(PRIMARY_ID_COLUMNS.values())
        by_point = method in ("nearest", "optimal")
        placed = linked.drop("lat", "lon").join(inputs.aois.select("aoi_id", "lat", "lon"), "aoi_id") if by_point else linked
        chosen = rollup.primary_ids(placed, sorted(known), country, method=method)
    marked = mark_primary(linked, chosen)
    meta_cols = [c for c in inputs.metadata.columns if c in METADATA_COLUMNS and c not in linked.columns]
    aoi_cols = [c for c in inputs.aois.columns if c not in ("aoi_id", "geometry") and c not in marked.columns and c not in meta_cols]
    shapes = [sinks.G.to_wkt(F.col("geometry")).alias("aoi_geometry")] if "geometry" in inputs.aois.columns else []
    areas = inputs.aois.select("aoi_id", *aoi_cols, *shapes)
    joined = inputs.metadata.select("aoi_id", *meta_cols).join(marked, "aoi_id").join(areas, "aoi_id")
    return sinks.keep_country_units(sinks.drop_empty_geometry(joined), country)


def column_collisions(*frames: DataFrame) -> list[str]:
    """Columns other than the key that occur in more than one table."""
    seen: dict[str, int] = {}
    for df in frames:
        for c in df.columns:
            seen[c] = seen.get(c, 0) + 1
    return sorted(c for c, n in seen.items() if n > 1 and c != "aoi_id")


def roof_table(linked: DataFrame, country: str, gridded_aois: DataFrame | None = None, *, recalculate: bool = True, cell_size: float = 0.002) -> DataFrame:
    """Roofs with flattened attributes, resolved scores and their primary instance's record.

    Components of clipped roofs are recomputed from child outlines; roofs of gridded areas are
    clipped to the area first.
    """
    roofs = linked.where(F.col("class_id") == ROOF)
    if recalculate:
        parents = spatial.clip_gridded_roofs(roofs, gridded_aois) if gridded_aois is not None else roofs
        redo = spatial.component_overlaps(parents, linked.where(F.col("class_id") != ROOF), country, cell_size=cell_size)
        roofs = roofs.join(redo.select("aoi_id", "feature_id", "recalc"), ["aoi_id", "feature_id"], "left")
    out = attributes.flatten_roofs(roofs, country, recalc_col="recalc" if recalculate else None)
    out = out.drop("recalc")
    if "primary_child_roof_age_feature_id" in out.columns:
        instances = linked.where(F.col("class_id") == ROOF_INSTANCE)
        cols = attributes.roof_instance_columns(instances.columns)
        records = instances.select("aoi_id", "feature_id", *[v.alias(k) for k, v in cols.items()])
        out = chains.attach_by_id(out, records, "primary_child_roof_age_feature_id", list(cols), "primary_child_")
    return out


def building_table(linked: DataFrame, roofs: DataFrame, resolved: DataFrame, country: str) -> DataFrame:
    """Buildings with 3D columns, their primary child roof's attributes and the index range of all
    child roofs; raw scores of the child roof stay out."""
    buildings = attributes.flatten_buildings(linked.where(F.col("class_id") == BUILDING), country)
    carried = [c for c in roofs.columns if c.startswith("dominant_") or c in ("roof_numbers", "roof_texts", "has_3d_attributes", "pitch_degrees")]
    out = chains.attach_by_id(buildings, roofs, "primary_child_roof_id", carried, "primary_child_roof_")
    aged = [c for c in roofs.columns if c.startswith("primary_child_roof_age_")]
    if aged:
        out = out.drop(*[c for c in aged if c in out.columns])
        out = chains.attach_by_id(out, roofs, "primary_child_roof_id", aged, "")
    pairs = out.select("aoi_id", F.col("feature_id").alias("parent_id"), F.explode("child_roofs").alias("c")).select(
        "aoi_id", "parent_id", F.col("c.feature_id").alias("child_id")
    )
    index = resolved.select("aoi_id", "feature_id", F.col("rsi.value").alias("roof_spotlight_index"))
    span = chains.child_score_range(pairs, index, "roof_spotlight_index").withColumnRenamed("parent_id", "feature_id")
    return out.join(span, ["aoi_id", "feature_id"], "left")


def lifecycle_table(linked: DataFrame, country: str) -> DataFrame:
    """Building lifecycles with damage columns and their largest child roof."""
    lifecycles = attributes.flatten_lifecycle_damage(linked.where(F.col("class_id") == BUILDING_LIFECYCLE))
    children = chains.lifecycle_child_roofs(
        linked.where(F.col("class_id") == BUILDING), linked.where(F.col("class_id") == ROOF), f"clipped_area_{area_unit(country)}"
    ).withColumnRenamed("lifecycle_id", "feature_id")
    out = lifecycles.drop("primary_child_roof_id", "child_roof_count").join(children, ["aoi_id", "feature_id"], "left")
    return out.withColumn("child_roof_count", F.coalesce("child_roof_count", F.lit(0)))
