"""Include payloads: scores, their model inputs and defensible-space zones."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelweave.config import (
    DS_RISK_CLASSES,
    DS_ZONE_FIELDS,
    INCLUDE_COLUMNS,
    INCLUDES,
    TEXT_INCLUDE_FIELDS,
    area_unit,
)
from parcelweave.functions.columns import label, snake
from parcelweave.functions.maps import entry, to_map

RISK_OBJECT = "struct<description:string,areaSqft:double,areaSqm:double,ratio:double>"
ZONE = (
    "struct<zoneId:int,zoneAreaSqft:double,zoneAreaSqm:double,defensibleSpaceAreaSqft:double,"
    "defensibleSpaceAreaSqm:double,totalRiskObjectAreaSqft:double,totalRiskObjectAreaSqm:double,"
    f"defensibleSpaceCoverageRatio:double,riskObjects:array<{RISK_OBJECT}>>"
)
DEFENSIBLE_SPACE = f"struct<skipped:boolean,modelVersion:string,zones:array<{ZONE}>>"


def include_schema(name: str) -> str:
    """DDL of one include payload."""
    if name == "defensible_space":
        return DEFENSIBLE_SPACE
    fields = ["skipped:boolean", "modelVersion:string"]
    for key in INCLUDES[name]["fields"]:
        fields.append(f"{key}:{'string' if key in TEXT_INCLUDE_FIELDS else 'double'}")
    if INCLUDES[name]["model_input_prefix"]:
        fields.append("modelInputFeatures:map<string,double>")
    return f"struct<{','.join(fields)}>"


def parse_include(name: str, text: Column) -> Column:
    """JSON text -> struct; NULL when absent, malformed, not an object, or empty."""
    return F.when(F.size(F.json_object_keys(text)) > 0, F.from_json(text, include_schema(name)))


def parse_includes(df: DataFrame) -> DataFrame:
    """Replace each include text column by its struct; missing ones become NULL structs."""
    cols = {}
    for name in INCLUDE_COLUMNS:
        text = F.col(name) if name in df.columns else F.lit(None).cast("string")
        cols[name] = parse_include(name, text)
    return df.withColumns(cols)


def include_columns(name: str, payload: Column) -> dict[str, Column]:
    """Flat columns of a parsed include.

    ``<name>_skipped`` is NULL when absent, true when the payload says it was skipped and false
    when it carries data; a skipped payload gives no field values but keeps its model version.
    """
    skipped = F.when(payload.isNotNull(), F.coalesce(payload["skipped"], F.lit(False)))
    out = {f"{name}_skipped": skipped}
    for key, column in INCLUDES.get(name, {"fields": {}})["fields"].items():
        out[column] = F.when(~skipped, payload[key])
    out[f"{name}_model_version"] = payload["modelVersion"]
    return out


def model_inputs(name: str, payload: Column) -> Column:
    """MAP of ``<prefix>_<snake_case key>`` -> value."""
    prefix = INCLUDES[name]["model_input_prefix"]
    entries = F.transform(
        F.map_entries(payload["modelInputFeatures"]),
        lambda e: entry(F.concat(F.lit(f"{prefix}_"), snake(e["key"])), e["value"]),
    )
    return F.when(~F.coalesce(payload["skipped"], F.lit(False)), to_map(entries))


def flatten_includes(df: DataFrame, names: tuple[str, ...] = tuple(INCLUDES)) -> DataFrame:
    """Add every flat include column plus the ``model_inputs`` map to parsed features."""
    cols: dict[str, Column] = {}
    for name in names:
        cols.update({k: v for k, v in include_columns(name, F.col(name)).items() if k != name})
    maps = [
        F.coalesce(model_inputs(n, F.col(n)), F.map_from_arrays(F.array().cast("array<string>"), F.array().cast("array<double>")))
        for n in names
        if INCLUDES[n]["model_input_prefix"]
    ]
    if maps:
        cols["model_inputs"] = F.map_concat(*maps) if len(maps) > 1 else maps[0]
    # The score struct and its headline value may share a name: keep the flat value.
    own = {name: v for name in names for k, v in include_columns(name, F.col(name)).items() if k == name}
    return df.withColumns(cols).withColumns(own)


def zone_metrics(zone: Column, country: str) -> Column:
    """Entries (metric, value) of one zone.

    The known risk classes always appear, 0.0 unless reported; other classes only if reported.
    """
    unit = area_unit(country)
    api = unit.capitalize()
    entries = [entry(f"{out}_{unit}", zone[f"{key}{api}"]) for key, out in DS_ZONE_FIELDS]
    entries.append(entry("coverage_ratio", zone["defensibleSpaceCoverageRatio"]))
    defaults = [
        entry(f"{name}_{metric}", F.lit(0.0)) for name in DS_RISK_CLASSES for metric in (f"area_{unit}", "ratio")
    ]
    reported = F.flatten(
        F.transform(
            F.filter(zone["riskObjects"], lambda r: r["description"].isNotNull()),
            lambda r: F.array(
                entry(F.concat(label(r["description"]), F.lit(f"_area_{unit}")), F.coalesce(r[f"area{api}"], F.lit(0.0))),
                entry(F.concat(label(r["description"]), F.lit("_ratio")), F.coalesce(r["ratio"], F.lit(0.0))),
            ),
        )
    )
    none = F.array().cast("array<struct<key:string,value:double>>")
    return F.concat(F.array(*entries, *defaults), F.coalesce(reported, none))


def defensible_space_metrics(payload: Column, country: str, prefix: str = "defensible_space_zone") -> Column:
    """MAP of ``<prefix>_<zone>_<metric>`` over all zones with an id; NULL when absent or skipped."""
    zones = F.filter(payload["zones"], lambda z: z["zoneId"].isNotNull())
    entries = F.flatten(
        F.transform(
            zones,
            lambda z: F.transform(
                zone_metrics(z, country),
                lambda e: entry(
                    F.concat(F.lit(f"{prefix}_"), z["zoneId"].cast("string"), F.lit("_"), e["key"]), e["value"]
                ),
            ),
        )
    )
    return F.when(payload.isNotNull() & ~F.coalesce(payload["skipped"], F.lit(False)), to_map(entries))


def zone_column_order(country: str, zones: tuple[int, ...], prefix: str) -> list[str]:
    """Declared output order: by zone, then zone metrics, then each known class."""
    unit = area_unit(country)
    metrics = [f"zone_area_{unit}", f"defensible_space_area_{unit}", "coverage_ratio", f"risk_object_area_{unit}"]
    for name in DS_RISK_CLASSES:
        metrics += [f"{name}_area_{unit}", f"{name}_ratio"]
    return [f"{prefix}_{z}_{m}" for z in zones for m in metrics]


def skip_flags(df: DataFrame, keys: list[str]) -> DataFrame:
    """Which ``*_skipped`` columns are true anywhere, per key: a work list of areas to re-run."""
    flags = [c for c in df.columns if c.endswith("_skipped")]
    aggs = [F.coalesce(F.bool_or(c), F.lit(False)).alias(c) for c in flags]
    hit = [F.when(F.col(c), F.lit(c)) for c in flags]
    return (
        df.groupBy(*keys).agg(*aggs)
        .withColumn("skipped_includes", F.array_compact(F.array(*hit)))
        .where(F.size("skipped_includes") > 0)
    )


def skip_counts(df: DataFrame) -> DataFrame:
    """One row: how many features had each include skipped."""
    flags = [c for c in df.columns if c.endswith("_skipped")]
    return df.agg(*[F.count_if(F.coalesce(F.col(c), F.lit(False))).alias(f"{c}_count") for c in flags])
