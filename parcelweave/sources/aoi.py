"""Reading and validating areas of interest."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from parcelweave.config import ADDRESS_FIELDS, AOI_ID, ROOF_AGE_DATASETS, ROOF_AGE_DATASETS_WITHOUT_CUTOFF
from parcelweave.functions import geometry as G
from parcelweave.sources.geopackage import read_geopackage
from parcelweave.operators.outlines import faults, invalid_reasons
from parcelweave.session import cut_lineage
from parcelweave.sources.ids import dense_ids

SEPARATORS = {"csv": ",", "tsv": "\t", "psv": "|"}


def suffix_of(path: str) -> str:
    return path.rstrip("/").rsplit(".", 1)[-1].lower()


def read_table(spark: SparkSession, path: str, format: str | None = None) -> DataFrame:
    """Any supported AOI file or folder; ``geometry`` comes back parsed if there is one."""
    kind = (format or suffix_of(path)).lower()
    if kind in SEPARATORS:
        df = spark.read.csv(
            path, sep=SEPARATORS[kind], header=True, multiLine=True, escape='"', inferSchema=False
        )
        return df.withColumn("geometry", G.from_wkt(F.col("geometry"))) if "geometry" in df.columns else df
    if kind == "parquet":
        df = spark.read.parquet(path)
        field = next((f for f in df.schema.fields if f.name == "geometry"), None)
        if field is None:
            return df
        if isinstance(field.dataType, T.BinaryType):
            return df.withColumn("geometry", G.from_wkb("geometry"))
        if isinstance(field.dataType, T.StringType):
            return df.withColumn("geometry", G.from_wkt(F.col("geometry")))
        return df
    if kind in ("geojson", "json"):
        return read_geojson(spark, path)
    if kind == "gpkg":
        return read_geopackage(spark, path)
    raise NotImplementedError(f"unsupported AOI format: {kind}")


def read_geojson(spark: SparkSession, path: str) -> DataFrame:
    """FeatureCollection files: properties become columns, the geometry is parsed."""
    reader = spark.read.option("multiLine", True).option("primitivesAsString", True)
    properties = reader.json(path).select(F.explode("features").alias("f")).schema["f"].dataType["properties"].dataType
    props = [f.name for f in properties.fields]
    # Each geometry stays JSON text: polygons and multi-polygons of one file nest to different depths.
    feature = T.StructType([T.StructField("geometry", T.StringType()), T.StructField("properties", properties)])
    features = reader.schema(T.StructType([T.StructField("features", T.ArrayType(feature))])).json(path).select(F.explode("features").alias("f"))
    shape = G.from_geojson(F.col("f.geometry"))
    return features.select(*[F.col(f"f.properties.`{p}`").alias(p) for p in props], shape.alias("geometry"))


def header_columns(spark: SparkSession, path: str, format: str | None = None) -> list[str]:
    """Column names only; formats with a footer or header are not scanned."""
    kind = (format or suffix_of(path)).lower()
    if kind in SEPARATORS:
        return spark.read.csv(path, sep=SEPARATORS[kind], header=True).columns
    if kind == "parquet":
        return spark.read.parquet(path).columns
    return read_table(spark, path, kind).columns


def with_ids(df: DataFrame, id_column: str = AOI_ID) -> DataFrame:
    """Sequential ids where the column is missing; the id is text."""
    if id_column not in df.columns:
        df = dense_ids(df, id_column)
    return df.withColumn(id_column, F.col(id_column).cast("string"))


def duplicate_ids(df: DataFrame, id_column: str = AOI_ID) -> DataFrame:
    """Ids that occur more than once."""
    return df.groupBy(id_column).count().where(F.col("count") > 1)


def valid_geometry(df: DataFrame) -> DataFrame:
    """Leave out missing, empty and zero-area geometries, and those that are no valid area: see
    :func:`parcelweave.operators.outlines.invalid_reasons`."""
    # Written once, as the row numbers would change if they were made again.  The number stands below the
    # filters, which keeps the optimizer from parsing each geometry again for every one of them.
    shaped = df.withColumn("_row", F.monotonically_increasing_id()).where(F.col("geometry").isNotNull() & (F.size("geometry") > 0))
    # Measured and judged together; what is told to be invalid is not written.
    measured = shaped.withColumns({"_area": G.areas(F.col("geometry")), "_fault": faults()})
    rows = cut_lineage(measured.where((F.col("_area") > 0) & F.col("_fault").isin(0, -1)).drop("_area"))
    good = rows.where(F.col("_fault") == 0).drop("_fault", "_row")
    large = rows.where(F.col("_fault") < 0).drop("_fault")
    if large.isEmpty():
        return good
    bad = invalid_reasons(large, "_row").select("_row")
    return good.unionByName(large.join(bad, "_row", "left_anti").drop("_row"))


def reproject(df: DataFrame, country: str) -> DataFrame:
    """Geometry from lon/lat to the country's grid."""
    return df.withColumn("geometry", G.project(F.col("geometry"), country))


def check_windows(df: DataFrame, columns: Sequence[str] = ("since", "until")) -> None:
    """Date limits must be text, so that per-area overrides are never skipped silently."""
    for c in columns:
        if c in df.columns and not isinstance(df.schema[c].dataType, (T.StringType, T.NullType)):
            raise TypeError(f"column {c!r} must hold YYYY-MM-DD text, not {df.schema[c].dataType.simpleString()}")


def rejected_cutoffs(df: DataFrame, dataset: str, columns: Sequence[str] = ("since", "until"), id_column: str = AOI_ID) -> DataFrame:
    """(id, column, value): date limits of single areas that the roof-age ``dataset`` (a name or an id) cannot
    apply; no rows for a dataset that knows limits."""
    resource = ROOF_AGE_DATASETS.get(dataset, dataset)
    refused = F.lit(resource in ROOF_AGE_DATASETS_WITHOUT_CUTOFF)
    given = [F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("value")) for c in columns if c in df.columns]
    kind = "array<struct<column:string,value:string>>"
    limits = F.array(*given).cast(kind) if given else F.from_json(F.lit("[]"), kind)
    return df.where(refused).select(id_column, F.explode(limits).alias("c")).select(id_column, "c.*").where(F.col("value").isNotNull())


def check_cutoffs(df: DataFrame, dataset: str) -> None:
    """Raise where an area sets a date limit that the dataset would ignore."""
    first = rejected_cutoffs(df, dataset).first()
    if first is not None:
        raise ValueError(f"column {first['column']!r} has values, but dataset {dataset!r} knows no date limits")


def query_mode(df: DataFrame) -> str:
    """'geometry' if the table has outlines, else 'address' if it has all address fields."""
    if "geometry" in df.columns:
        return "geometry"
    if set(ADDRESS_FIELDS) <= set(df.columns):
        return "address"
    raise ValueError(f"areas need a geometry or all of {ADDRESS_FIELDS}")


def usable_rows(df: DataFrame) -> DataFrame:
    """Rows with the columns their mode needs."""
    if query_mode(df) == "geometry":
        return df.where(F.col("geometry").isNotNull())
    cond = F.lit(True)
    for c in ADDRESS_FIELDS:
        cond = cond & F.col(c).isNotNull()
    return df.where(cond)


def read_aois(
    spark: SparkSession, path: str, *, format: str | None = None, id_column: str = AOI_ID, drop_invalid: bool = True,
    country: str | None = None,
) -> DataFrame:
    """Read, validate, identify and optionally project areas.

    Raises when nothing usable is left or ids repeat.
    """
    df = read_table(spark, path, format)
    check_windows(df)
    if "geometry" in df.columns and drop_invalid:
        # Written once: the checks below and the caller then read the validated table.
        df = cut_lineage(valid_geometry(df))
    if df.isEmpty():
        raise ValueError(f"no valid areas in {path}")
    df = with_ids(df, id_column)
    if not duplicate_ids(df, id_column).isEmpty():
        raise ValueError(f"duplicate ids in column {id_column!r}")
    return reproject(df, country) if country and "geometry" in df.columns else df
