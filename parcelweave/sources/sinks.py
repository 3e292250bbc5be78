"""Writing tables: CSV-safe projections, per-class tables, errors, parts of differing schema."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelweave.config import (
    AOI_ID,
    DAMAGE_PUBLIC_COLUMNS,
    METADATA_COLUMNS,
    PER_CLASS_TABLES,
    ROOF_AGE_COLUMNS,
    ROOF_AGE_PUBLIC_COLUMNS,
    SQM_TO_SQFT,
    area_unit,
    wrong_unit_area_columns,
)
from parcelweave.functions import geometry as G
from parcelweave.functions.columns import age_years, let, yes_no
from parcelweave.sources.geoparquet import write_geoparquet


# ------------------------------------------------------------------ shaping for output
def ensure_columns(df: DataFrame, columns: Sequence[str], type_: str = "string") -> DataFrame:
    """Add missing columns as NULL."""
    return df.withColumns({c: F.lit(None).cast(type_) for c in columns if c not in df.columns})


def keep_country_units(df: DataFrame, country: str) -> DataFrame:
    """Drop the area columns of the other unit family."""
    return df.drop(*wrong_unit_area_columns(country))


def booleans_to_yn(df: DataFrame) -> DataFrame:
    """Y/N for every boolean column, NULL kept."""
    flags = [f.name for f in df.schema.fields if isinstance(f.dataType, T.BooleanType)]
    return df.withColumns({c: yes_no(F.col(f"`{c}`")) for c in flags})


def nested_to_json(df: DataFrame) -> DataFrame:
    """JSON text for every array, map, struct or variant column other than the geometry."""
    nested = (T.ArrayType, T.MapType, T.StructType, T.VariantType)
    names = [f.name for f in df.schema.fields if isinstance(f.dataType, nested) and f.name != "geometry"]
    return df.withColumns({c: F.to_json(F.col(f"`{c}`")) for c in names})


def csv_ready(df: DataFrame) -> DataFrame:
    """Everything a CSV needs: Y/N, JSON text, WKT."""
    out = nested_to_json(booleans_to_yn(df))
    if "geometry" in out.columns and dict(out.dtypes)["geometry"] == G.GEOM:
        out = out.withColumn("geometry", G.to_wkt(F.col("geometry")))
    return out


def drop_empty_geometry(df: DataFrame) -> DataFrame:
    return df.where(F.col("geometry").isNotNull() & (F.size("geometry") > 0))


def rename_clashes(metadata: DataFrame, aois: DataFrame, prefix: str = "source_") -> DataFrame:
    """Metadata columns that clash with the user's own get a prefix."""
    clash = [c for c in METADATA_COLUMNS if c in aois.columns and c in metadata.columns]
    return metadata.withColumnsRenamed({c: f"{prefix}{c}" for c in clash})


def order_columns(df: DataFrame, aoi_columns: Sequence[str], metadata_columns: Sequence[str], zones: Sequence[str] = ()) -> DataFrame:
    """Area columns, metadata columns, the rest; declared zone columns stay together in order."""
    head = [c for c in [AOI_ID, *aoi_columns, *metadata_columns] if c in df.columns and c != "geometry"]
    head = list(dict.fromkeys(head))
    rest = [c for c in df.columns if c not in head and c != "geometry"]
    zone = [c for c in zones if c in rest]
    if zone:
        at = min(rest.index(c) for c in zone)
        plain_before = [c for c in rest[:at] if c not in zone]
        plain_after = [c for c in rest[at:] if c not in zone]
        rest = plain_before + zone + plain_after
    tail = ["geometry"] if "geometry" in df.columns else []
    return df.select(*[F.col(f"`{c}`") for c in head + rest + tail])


def map_link(base_url: str, geom: Column, date: Column, zoom: str = "21.00z,0d") -> Column:
    """Viewer link from centroid and date (YYYYMMDD); without a date a dateless link."""
    day = F.nullif(F.substring(F.replace(date, F.lit("-"), F.lit("")), 1, 8), F.lit(""))
    tail = F.concat(F.coalesce(F.concat(F.lit("/V/"), day), F.lit("")), F.lit("?locationMarker"))

    def link(c):
        at = F.concat(F.lit(base_url), c["y"].cast("string"), F.lit(","), c["x"].cast("string"), F.lit(f",{zoom}"))
        return F.when(c.isNotNull(), F.concat(at, tail))

    return let(G.centroid(geom), link)


def with_query_point(aois: DataFrame) -> DataFrame:
    """``query_aoi_lat`` / ``query_aoi_lon``: a point inside the area."""
    p = G.inside_point(F.col("geometry"))
    return aois.withColumn("_p", p).withColumns(
        {"query_aoi_lat": F.col("_p.y"), "query_aoi_lon": F.col("_p.x")}
    ).drop("_p")


def with_instance_sqft(instances: DataFrame, country: str) -> DataFrame:
    """Roof instances report square metres; imperial countries get square feet too."""
    if area_unit(country) != "sqft":
        return instances
    return instances.withColumn("area_sqft", F.col("area_sqm") * F.lit(SQM_TO_SQFT))


def all_null_columns(df: DataFrame, candidates: Sequence[str]) -> list[str]:
    """Candidate columns without any value: one aggregate over all of them."""
    if not candidates:
        return []
    row = df.agg(*[F.count(F.col(f"`{c}`")).alias(c) for c in candidates]).first()
    return [c for c in candidates if row[c] == 0]


def drop_unused_class_columns(rollup: DataFrame, class_columns: Sequence[str], aois: DataFrame) -> DataFrame:
    """Drop class columns that are NULL everywhere; the user's own columns never."""
    own = set(aois.columns)
    unused = all_null_columns(rollup, [c for c in class_columns if c in rollup.columns and c not in own])
    return rollup.drop(*unused)


# ------------------------------------------------------------------ writing
def write_table(df: DataFrame, path: str, format: str = "parquet") -> None:
    if format == "csv":
        csv_ready(df).write.mode("overwrite").option("header", True).option("escape", '"').csv(path)
    elif format == "parquet":
        df.write.mode("overwrite").parquet(path)
    else:
        raise ValueError(f"unknown output format: {format}")


def write_class_tables(features: DataFrame, path: str, *, class_ids: Sequence[str] = PER_CLASS_TABLES, geo: bool = False) -> None:
    """One table per listed class.

    The feature table is partitioned by class once; each class table is then a pruned read away
    instead of one more pass over all features.
    """
    chosen = features.where(F.col("class_id").isin(*class_ids))
    if geo:
        for cid in class_ids:
            write_geoparquet(chosen.where(F.col("class_id") == cid), f"{path}/class_id={cid}", sort=("feature_id",))
        return
    spread = chosen.repartition("class_id", F.pmod(F.xxhash64("aoi_id", "feature_id"), F.lit(32)))
    spread.write.mode("overwrite").partitionBy("class_id").parquet(path)


def write_features_by_class(features: DataFrame, path: str) -> None:
    """Plain parquet alternative to GeoParquet, partitioned by class, sorted inside files."""
    spread = features.repartitionByRange("class_id", "feature_id").sortWithinPartitions("class_id", "feature_id")
    spread.write.mode("overwrite").partitionBy("class_id").parquet(path)


def errors_with_context(errors: DataFrame, aois: DataFrame) -> DataFrame:
    """Errors ⟕ areas; a cell's own outline wins over the area's."""
    shapes = aois.select("aoi_id", F.col("geometry").alias("_aoi_geometry"))
    out = errors.join(shapes, "aoi_id", "left")
    own = F.col("geometry") if "geometry" in errors.columns else F.lit(None).cast(G.GEOM)
    return out.withColumn("geometry", F.coalesce(own, F.col("_aoi_geometry"))).drop("_aoi_geometry")


def damage_public(buildings: DataFrame, country: str, *, aois: DataFrame | None = None) -> DataFrame:
    """Fixed public columns of the damage export, optionally with the area's outline as WKT."""
    df = keep_country_units(buildings, country)
    if aois is not None:
        df = df.join(aois.select("aoi_id", G.to_wkt(F.col("geometry")).alias("aoi_geometry")), "aoi_id", "left")
    area = f"area_{area_unit(country)}"
    names = []
    for c in DAMAGE_PUBLIC_COLUMNS:
        names += [area, c] if c == "confidence" else [c]
    names += ["geometry", "aoi_geometry"]
    return df.select(*[c for c in names if c in df.columns])


def roof_age_output(instances: DataFrame) -> DataFrame:
    """Prefix the record columns, Y/N, and add the age."""
    df = instances.withColumnsRenamed({c: f"roof_age_{c}" for c in ROOF_AGE_COLUMNS if c in instances.columns})
    df = booleans_to_yn(df)
    if {"roof_age_installation_date", "roof_age_as_of_date"} <= set(df.columns):
        df = df.withColumn("roof_age_years_as_of_date", age_years(F.col("roof_age_installation_date"), F.col("roof_age_as_of_date")))
    return df


def roof_age_public(instances: DataFrame) -> DataFrame:
    """Fixed public columns of the roof-age export."""
    df = roof_age_output(instances)
    names = [*ROOF_AGE_PUBLIC_COLUMNS, "aoi_geometry"]
    return df.select(*[c for c in names if c in df.columns])


def write_snapshot(spark: SparkSession, catalogue: DataFrame, parameters: dict, path: str) -> None:
    """The class catalogue and the run parameters beside the output."""
    catalogue.write.mode("overwrite").json(f"{path}/catalogue")
    pairs = [(k, None if v is None else str(v)) for k, v in sorted(parameters.items())]
    spark.createDataFrame(pairs, "name string, value string").write.mode("overwrite").json(f"{path}/parameters")


# ------------------------------------------------------------------ parts of differing schema
def _wider(a: T.DataType, b: T.DataType) -> T.DataType:
    """Common type of two parts' columns: NULL gives way, numbers widen, the rest becomes text."""
    if a == b or isinstance(b, T.NullType):
        return a
    if isinstance(a, T.NullType):
        return b
    order = [T.ByteType, T.ShortType, T.IntegerType, T.LongType]
    ints = [next((i for i, k in enumerate(order) if isinstance(x, k)), None) for x in (a, b)]
    if None not in ints:
        return order[max(ints)]()
    if isinstance(a, T.NumericType) and isinstance(b, T.NumericType):
        return T.DoubleType()
    # Unreconcilable types keep the first part's; values that do not fit become NULL.
    return a


def union_parts(parts: Sequence[DataFrame]) -> DataFrame:
    """Union of parts by name with permissive widening; a value that cannot be cast becomes NULL."""
    target: dict[str, T.DataType] = {}
    for df in parts:
        for f in df.schema.fields:
            target[f.name] = _wider(target[f.name], f.dataType) if f.name in target else f.dataType
    aligned = []
    for df in parts:
        have = {f.name: f.dataType for f in df.schema.fields}
        cols = []
        for name, type_ in target.items():
            if name not in have or isinstance(have[name], T.NullType):
                value = F.lit(None).cast(type_)
            elif have[name] == type_:
                value = F.col(f"`{name}`")
            else:
                value = F.col(f"`{name}`").try_cast(type_)
            cols.append(value.alias(name))
        aligned.append(df.select(*cols))
    out = aligned[0]
    for df in aligned[1:]:
        out = out.unionByName(df)
    return out


def read_parts(spark: SparkSession, folder: str, prefix: str) -> DataFrame:
    """All parts whose name starts with a prefix; unreadable files are skipped, schemas merged."""
    return (
        spark.read.option("mergeSchema", True).option("ignoreCorruptFiles", True)
        .parquet(f"{folder.rstrip('/')}/{prefix}*")
    )
