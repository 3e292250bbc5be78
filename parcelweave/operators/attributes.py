"""Nested feature attributes -> flat columns and per-row metric maps."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelweave.config import (
    CLIPPED_AREA_TOLERANCE,
    DAMAGE_RATINGS,
    DOMINANT_MATERIAL_MIN_RATIO,
    METERS_TO_FEET,
    RETIRED_ROOF_SHAPE_CLASSES,
    RETIRED_ROOF_SHAPE_NAMES,
    ROOF_AGE_COLUMNS,
    area_unit,
)
from parcelweave.functions.columns import age_years, half_even, json_object, label, let, yes_no
from parcelweave.functions.maps import entry, to_map

HISTOGRAM = "struct<binType:string,ratios:array<double>>"
COMPONENT = (
    "struct<description:string,classId:string,areaSqm:double,areaSqft:double,confidence:double,"
    f"ratio:double,dominant:boolean,confidenceStats:struct<histograms:array<{HISTOGRAM}>>>"
)
ATTRIBUTE = (
    f"struct<description:string,classId:string,components:array<{COMPONENT}>,has3dAttributes:boolean,"
    "height:double,numStories:map<string,double>,fidelity:double,pitch:double,available:boolean,value:double>"
)
DAMAGE = (
    "struct<confidences:struct<raw:map<string,double>,`3tier`:map<string,double>,`2tier`:map<string,double>>,"
    "ratios:array<struct<description:string,ratioAbove50PctConf:double>>>"
)
DAMAGE_BLOCK = "struct<rating:string,confidence:double,rawRatings:map<string,double>,classRatios:string,latestCaptureDate:string>"
NUMBERS = "array<struct<key:string,value:double>>"
TEXTS = "array<struct<key:string,value:string>>"
# Per component name: what an overlay of child features on the clipped parent gives.
RECALC = "map<string,struct<class_id:string,area:double,ratio:double,confidence:double>>"


def parse_attributes(text: Column) -> Column:
    """Attribute list JSON -> array of structs; malformed or not a list -> NULL."""
    return F.from_json(text, f"array<{ATTRIBUTE}>")


def is_clipped(country: str) -> Column:
    """Clipped area noticeably (1 %) below unclipped area, in the country's unit."""
    u = area_unit(country)
    return F.coalesce(
        F.col(f"clipped_area_{u}") < F.col(f"unclipped_area_{u}") * F.lit(CLIPPED_AREA_TOLERANCE), F.lit(False)
    )


def _component_rows(attributes: Column) -> Column:
    """Flat list of (group, name, component); low-confidence groups prefix their names."""
    with_components = F.filter(attributes, lambda a: a["components"].isNotNull())

    def rows(a):
        low = F.coalesce(F.contains(a["description"], F.lit("Low confidence")), F.lit(False))
        return F.transform(
            a["components"],
            lambda c: F.struct(
                F.coalesce(label(a["description"]), F.lit("")).alias("group"),
                F.concat(F.when(low, F.lit("low_conf_")).otherwise(F.lit("")), label(c["description"])).alias("name"),
                c.alias("c"),
            ),
        )

    return F.flatten(F.transform(with_components, rows))


def _stats_entries(row: Column) -> Column:
    """Confidence histogram bins of a component; NULL lists count as empty."""
    return F.flatten(
        F.transform(
            F.coalesce(row["c"]["confidenceStats"]["histograms"], F.array().cast(f"array<{HISTOGRAM}>")),
            lambda h: F.transform(
                F.coalesce(h["ratios"], F.array().cast("array<double>")),
                lambda v, i: entry(
                    F.concat(
                        row["name"], F.lit("_confidence_stats_"), F.coalesce(h["binType"], F.lit("unknown")),
                        F.lit("_bin_"), i.cast("string"),
                    ),
                    v,
                ),
            ),
        )
    )


def component_numbers(attributes: Column, country: str, recalc: Column | None = None) -> Column:
    """Entries: area, confidence, ratio and histogram bins of every component.

    A recalculated component (clipped parent) replaces area, ratio and confidence; without any
    overlap it has no confidence.
    """
    u = area_unit(country)
    api_area = f"area{u.capitalize()}"

    def numbers(r):
        new = F.lit(None).cast("struct<class_id:string,area:double,ratio:double,confidence:double>") if recalc is None else recalc[r["name"]]
        redone = new.isNotNull()
        head = F.array(
            entry(F.concat(r["name"], F.lit(f"_area_{u}")), F.when(redone, new["area"]).otherwise(r["c"][api_area])),
            entry(F.concat(r["name"], F.lit("_confidence")), F.when(redone, new["confidence"]).otherwise(r["c"]["confidence"])),
            entry(F.concat(r["name"], F.lit("_ratio")), F.when(redone, new["ratio"]).otherwise(r["c"]["ratio"])),
        )
        return F.concat(head, _stats_entries(r))

    return F.coalesce(F.flatten(F.transform(_component_rows(attributes), numbers)), F.array().cast(NUMBERS))


def component_texts(attributes: Column, recalc: Column | None = None) -> Column:
    """Entries: Y/N presence (positive area) and dominance of every component."""

    def texts(r):
        area = r["c"]["areaSqm"]
        if recalc is not None:
            new = recalc[r["name"]]
            area = F.when(new.isNotNull(), new["area"]).otherwise(area)
        return F.array(
            entry(F.concat(r["name"], F.lit("_present")), F.when(area > 0, F.lit("Y")).otherwise(F.lit("N"))),
            entry(F.concat(r["name"], F.lit("_dominant")), yes_no(r["c"]["dominant"])),
        )

    return F.coalesce(F.flatten(F.transform(_component_rows(attributes), texts)), F.array().cast(TEXTS))


def dominant_component(attributes: Column, group: str, country: str, recalc: Column | None = None) -> Column:
    """Winner of one attribute group as struct<class_id,description,area,ratio,confidence>.

    Highest ratio wins, the earlier component on ties.  Retired roof shapes never win.  A
    material below the majority ratio, a shape without area, or a list of retired shapes only
    gives ``unknown``; no components at all gives NULL.
    """
    u = area_unit(country)
    api_area = f"area{u.capitalize()}"
    rows = F.filter(_component_rows(attributes), lambda r: r["group"] == group)

    def stats(r, i):
        new = F.lit(None).cast("struct<class_id:string,area:double,ratio:double,confidence:double>") if recalc is None else recalc[r["name"]]
        redone = new.isNotNull()
        return F.struct(
            F.coalesce(F.when(redone, new["ratio"]).otherwise(r["c"]["ratio"]), F.lit(0.0)).alias("ratio"),
            (-i).alias("position"),
            F.when(redone, new["class_id"]).otherwise(r["c"]["classId"]).alias("class_id"),
            label(r["c"]["description"]).alias("description"),
            F.coalesce(F.when(redone, new["area"]).otherwise(r["c"][api_area]), F.lit(0.0)).alias("area"),
            F.when(redone, new["confidence"]).otherwise(r["c"]["confidence"]).alias("confidence"),
        )

    candidates = F.transform(rows, stats)
    material = group == "roof_material"
    if not material:
        candidates = F.filter(
            candidates,
            lambda s: ~(
                F.coalesce(s["class_id"].isin(*RETIRED_ROOF_SHAPE_CLASSES), F.lit(False))
                | s["description"].isin(*RETIRED_ROOF_SHAPE_NAMES)
            ),
        )

    def verdict(best):
        known = best["ratio"] >= DOMINANT_MATERIAL_MIN_RATIO if material else best["area"] > 0
        known = F.coalesce(known, F.lit(False))
        return F.struct(
            F.when(known, best["class_id"]).alias("feature_class"),
            F.when(known, best["description"]).otherwise(F.lit("unknown")).alias("description"),
            F.when(known, best["area"]).alias("area"),
            F.when(known, best["ratio"]).alias("ratio"),
            F.when(known, best["confidence"]).alias("confidence"),
        )

    return F.when(F.size(rows) > 0, let(F.array_max(candidates), verdict))


def dominants(attributes: Column, country: str, recalc: Column | None = None) -> dict[str, Column]:
    """``_dominant_<group>`` structs, to be staged before :func:`dominant_columns` reads them."""
    return {f"_dominant_{g}": dominant_component(attributes, g, country, recalc) for g in ("roof_material", "roof_types")}


def dominant_columns(country: str) -> dict[str, Column]:
    """Flat ``dominant_roof_material_*`` and ``dominant_roof_types_*`` columns of staged winners."""
    u, out = area_unit(country), {}
    for group in ("roof_material", "roof_types"):
        d = F.col(f"_dominant_{group}")
        out[f"dominant_{group}_feature_class"] = d["feature_class"]
        out[f"dominant_{group}_description"] = d["description"]
        out[f"dominant_{group}_area_{u}"] = d["area"]
        if group == "roof_material":
            out[f"dominant_{group}_ratio"] = d["ratio"]
        out[f"dominant_{group}_confidence"] = d["confidence"]
    return out


def roof_3d_columns(attributes: Column) -> dict[str, Column]:
    """``has_3d_attributes`` and the pitch where 3D data exists."""
    a = F.get(F.filter(attributes, lambda x: x["components"].isNull() & x["has3dAttributes"].isNotNull()), F.lit(0))
    return {
        "has_3d_attributes": yes_no(a["has3dAttributes"]),
        "pitch_degrees": F.when(a["has3dAttributes"], a["pitch"]),
    }


def flatten_roofs(roofs: DataFrame, country: str, *, recalc_col: str | None = None) -> DataFrame:
    """Add dominant and 3D columns and the maps ``roof_numbers`` / ``roof_texts``."""
    attrs = parse_attributes(F.col("attributes"))
    staged = roofs.withColumn("_attrs", attrs)
    a = F.col("_attrs")
    recalc = F.col(recalc_col) if recalc_col else None
    return staged.withColumns(
        {
            **dominants(a, country, recalc),
            **roof_3d_columns(a),
            "roof_numbers": to_map(component_numbers(a, country, recalc)),
            "roof_texts": to_map(component_texts(a, recalc)),
        }
    ).withColumns(dominant_columns(country)).drop("_attrs", "_dominant_roof_material", "_dominant_roof_types")


def flatten_pools(pools: DataFrame, country: str) -> DataFrame:
    """Add the maps ``pool_numbers`` / ``pool_texts`` with the condition components."""
    staged = pools.withColumn("_attrs", parse_attributes(F.col("attributes")))
    a = F.col("_attrs")
    return staged.withColumns(
        {"pool_numbers": to_map(component_numbers(a, country)), "pool_texts": to_map(component_texts(a))}
    ).drop("_attrs")


def building_3d_columns(attributes: Column, country: str) -> dict[str, Column]:
    """Height, pitch, ground height, fidelity and the storey-confidence map of a building."""

    def described(name):
        return F.get(F.filter(attributes, lambda a: a["description"] == name), F.lit(0))

    main, pitch, ground = described("Building 3d attributes"), described("Building pitch"), described("Ground height")
    unit, factor = ("ft", METERS_TO_FEET) if area_unit(country) == "sqft" else ("m", 1.0)
    has = main["has3dAttributes"]
    storeys = F.transform(
        F.map_entries(main["numStories"]),
        lambda e: entry(F.concat(F.lit("num_storeys_"), e["key"], F.lit("_confidence")), e["value"]),
    )
    return {
        "has_3d_attributes": yes_no(has),
        f"height_{unit}": F.when(has, half_even(main["height"] * F.lit(factor), 1)),
        "storeys": F.when(has, to_map(storeys)),
        "pitch_degrees": F.when(pitch["available"], half_even(pitch["value"], 2)),
        f"ground_height_{unit}": F.when(ground["available"], half_even(ground["value"] * F.lit(factor), 1)),
        "fidelity_3d": main["fidelity"],
    }


def flatten_buildings(buildings: DataFrame, country: str) -> DataFrame:
    """Add the 3D columns to building features."""
    staged = buildings.withColumn("_attrs", parse_attributes(F.col("attributes")))
    return staged.withColumns(building_3d_columns(F.col("_attrs"), country)).drop("_attrs")


def first_largest(confidences: Column) -> Column:
    """Entry of a map with the greatest value, the earlier one on ties; NULL values never win."""
    entries = F.transform(
        F.map_entries(confidences),
        lambda e, i: F.struct(e["value"].alias("value"), (-i).alias("position"), e["key"].alias("key")),
    )
    return F.array_max(F.filter(entries, lambda e: e["value"].isNotNull()))


def flatten_lifecycle_damage(features: DataFrame) -> DataFrame:
    """Add ``damage_class``, its confidence and the map ``damage_numbers``."""
    usable = json_object(F.col("damage"))
    staged = features.withColumn("_damage", F.from_json(usable, DAMAGE))
    conf = F.col("_damage.confidences")
    best = first_largest(conf["raw"])

    def named(source, head):
        return F.coalesce(
            F.transform(
                F.map_entries(source),
                lambda e: entry(F.concat(F.lit(head), e["key"], F.lit("_confidence")), e["value"]),
            ),
            F.array().cast(NUMBERS),
        )

    ratios = F.coalesce(
        F.transform(
            F.col("_damage.ratios"),
            lambda r: entry(F.concat(F.lit("damage_ratio_"), label(r["description"])), r["ratioAbove50PctConf"]),
        ),
        F.array().cast(NUMBERS),
    )
    numbers = F.concat(named(conf["raw"], "damage_class_"), named(conf["2tier"], "damage_2tier_"), ratios)
    return staged.withColumns(
        {
            "damage_class": best["key"],
            "damage_class_confidence": best["value"],
            # Ratios count only where confidences exist.
            "damage_numbers": F.when(conf.isNotNull(), to_map(numbers)),
        }
    ).drop("_damage")


def damage_dotted(damage: Column) -> Column:
    """MAP with dotted names over all three tiers and the ratios."""
    d = F.from_json(json_object(damage), DAMAGE)

    def tier(name):
        return F.coalesce(
            F.transform(
                F.map_entries(d["confidences"][name]),
                lambda e: entry(F.concat(F.lit(f"damage.confidences.{name}."), e["key"]), e["value"]),
            ),
            F.array().cast(NUMBERS),
        )

    ratios = F.coalesce(
        F.transform(
            d["ratios"],
            lambda r: entry(F.concat(F.lit("damage.ratios."), r["description"]), r["ratioAbove50PctConf"]),
        ),
        F.array().cast(NUMBERS),
    )
    return F.when(d.isNotNull(), to_map(F.concat(tier("raw"), tier("3tier"), tier("2tier"), ratios)))


def conflated_damage_columns(damage: Column) -> dict[str, Column]:
    """Fixed column set of an event-scoped rating: post-event and pre-event blocks.

    ``damage`` is struct<event,preEvent> of damage blocks; an absent block gives NULLs.
    """
    out = {}
    for block, prefix in (("event", "event"), ("preEvent", "pre_event")):
        b = damage[block]
        out[f"damage_{prefix}_rating"] = b["rating"]
        out[f"damage_{prefix}_confidence"] = b["confidence"]
        for key, name in DAMAGE_RATINGS.items():
            out[f"damage_{prefix}_raw_{name}"] = b["rawRatings"][key]
        out[f"damage_{prefix}_class_ratios"] = F.when(F.startswith(b["classRatios"], F.lit("[")), b["classRatios"])
        out[f"damage_{prefix}_latest_capture_date"] = b["latestCaptureDate"]
    return out


def attribute_list_dotted(text: Column) -> Column:
    """Generic attribute list -> MAP<STRING,STRING> with dotted names.

    Internal ids are left out, one level of nesting is spelled out, components stay JSON.
    """
    items = F.from_json(text, "array<map<string,string>>")
    hidden = r'"internalClassId"\s*:\s*("[^"]*"|[^,}\]]*)'

    def fields(attr, i):
        head = F.coalesce(attr["description"], F.concat(F.lit("attr_"), i.cast("string")))

        def one(e):
            name = F.concat(head, F.lit("."), e["key"])
            shown = F.regexp_replace(F.regexp_replace(e["value"], hidden + r"\s*,\s*", ""), r",?\s*" + hidden, "")
            plain = F.array(entry(name, F.when(e["key"] == "components", shown).otherwise(e["value"])))
            nested = F.transform(
                F.map_entries(F.from_json(e["value"], "map<string,string>")),
                lambda s: entry(F.concat(name, F.lit("."), s["key"]), s["value"]),
            )
            is_object = F.startswith(e["value"], F.lit("{")) & (e["key"] != "components")
            return F.when(is_object, nested).otherwise(plain)

        kept = F.filter(
            F.map_entries(attr),
            lambda e: ~e["key"].isin("description", "internalClassId") & e["value"].isNotNull(),
        )
        return F.flatten(F.transform(kept, one))

    return to_map(F.flatten(F.transform(items, fields)))


def roof_instance_columns(columns: list[str], prefix: str = "") -> dict[str, Column]:
    """All canonical ``roof_age_*`` columns in order; absent inputs are NULL, booleans Y/N.

    ``as_of_date`` falls back to ``until_date``; the age follows the map link column.
    """

    def source(name):
        return F.col(name) if name in columns else F.lit(None).cast("string")

    as_of = F.coalesce(source("as_of_date"), source("until_date"))
    out: dict[str, Column] = {}
    for name in ROOF_AGE_COLUMNS:
        value = source(name)
        if name == "as_of_date":
            value = as_of
        elif name in ("relevant_permits", "assessor_data") and name in columns:
            value = yes_no(value.cast("boolean"))
        out[f"{prefix}roof_age_{name}"] = value
        if name == "map_browser_url":
            out[f"{prefix}roof_age_years_as_of_date"] = age_years(source("installation_date"), as_of)
    return out
