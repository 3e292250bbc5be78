"""Splitting large areas into grid cells and recombining what the cells returned."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelweave.config import GRID_SIZE_DEGREES, MAX_AOI_SQM_BEFORE_GRIDDING, SIZE_ERROR_CODES
from parcelweave.functions import geometry as G
from parcelweave.operators.outlines import dissolve, group_sizes
from parcelweave.session import cut_lineage, spread

SUMMED = ("area_sqm", "area_sqft", "clipped_area_sqm", "clipped_area_sqft")
METADATA_IDENTITY = (
    "system_version", "link", "survey_date", "survey_id", "survey_resource_id", "perspective", "mesh_date",
)


def needs_gridding(
    aois: DataFrame, country: str, *, errors: DataFrame | None = None, skips: DataFrame | None = None
) -> DataFrame:
    """(aoi_id, reason) of areas to grid: too large, refused for size, or includes skipped."""
    large = aois.where(G.area_sqm(F.col("geometry"), country) > MAX_AOI_SQM_BEFORE_GRIDDING).select(
        "aoi_id", F.lit("area").alias("reason")
    )
    work = large
    if errors is not None:
        work = work.unionByName(
            errors.where(F.col("message").isin(*SIZE_ERROR_CODES)).select("aoi_id", F.lit("request_size").alias("reason"))
        )
    if skips is not None:
        work = work.unionByName(skips.select("aoi_id", F.lit("include_skip").alias("reason")))
    return work.groupBy("aoi_id").agg(F.min("reason").alias("reason"))


def grid_cells(extents: DataFrame, cell: float, box_col: str = "box") -> DataFrame:
    """One row per cell over each extent: ceil(width/cell) columns by ceil(height/cell) rows,
    counted column by column from the lower-left corner."""
    b = F.col(box_col)
    cols = F.ceil((b["maxx"] - b["minx"]) / cell)
    rows = F.ceil((b["maxy"] - b["miny"]) / cell)

    def upto(n):
        return F.when(n > 0, F.sequence(F.lit(0).cast("bigint"), n - 1)).otherwise(F.array().cast("array<bigint>"))

    out = extents.withColumn("cell_col", F.explode(upto(cols))).withColumn("cell_row", F.explode(upto(rows)))
    x, y = b["minx"] + F.col("cell_col") * cell, b["miny"] + F.col("cell_row") * cell
    x2, y2 = b["minx"] + (F.col("cell_col") + 1) * cell, b["miny"] + (F.col("cell_row") + 1) * cell
    return out.withColumn("cell_box", F.struct(x.alias("minx"), y.alias("miny"), x2.alias("maxx"), y2.alias("maxy")))


def split_into_grid(aois: DataFrame, cell: float = GRID_SIZE_DEGREES) -> DataFrame:
    """(aoi_id, cell_col, cell_row, piece, geometry): area ∩ cell, several parts exploded.

    Columns are cut first and rows second, so the outline that travels to a cell is already the
    strip's, not the whole area's, and the work grows with the outline rather than with
    outline x cells.
    """
    b = F.col("box")
    extents = aois.select("aoi_id", "geometry", G.bbox(F.col("geometry")).alias("box")).where(b.isNotNull())
    n_cols = F.ceil((b["maxx"] - b["minx"]) / cell)
    strips = extents.where(n_cols > 0).withColumn("cell_col", F.explode(F.sequence(F.lit(0).cast("bigint"), n_cols - 1)))
    x1 = b["minx"] + F.col("cell_col") * cell
    x2 = b["minx"] + (F.col("cell_col") + 1) * cell
    strips = spread(strips, "aoi_id", "cell_col").select(
        "aoi_id", "box", "cell_col",
        G.clip_to_box(F.col("geometry"), x1, b["miny"], x2, b["maxy"]).alias("geometry"),
    ).where(F.col("geometry").isNotNull())
    # Only the rows the strip really reaches.
    s = F.col("strip_box")
    first = F.greatest(F.floor((s["miny"] - b["miny"]) / cell), F.lit(0))
    last = F.least(F.floor((s["maxy"] - b["miny"]) / cell), F.ceil((b["maxy"] - b["miny"]) / cell) - 1)
    cells = strips.withColumn("strip_box", G.bbox(F.col("geometry"))).withColumn(
        "cell_row", F.explode(F.sequence(first, F.greatest(first, last)))
    )
    y1 = b["miny"] + F.col("cell_row") * cell
    y2 = b["miny"] + (F.col("cell_row") + 1) * cell
    clipped = cells.select(
        "aoi_id", "cell_col", "cell_row",
        G.clip_to_box(F.col("geometry"), s["minx"], y1, s["maxx"], y2).alias("parts"),
    )
    return clipped.select("aoi_id", "cell_col", "cell_row", F.posexplode("parts").alias("piece", "part")).select(
        "aoi_id", "cell_col", "cell_row", "piece", F.array("part").alias("geometry")
    )


def combine_grid_features(
    features: DataFrame,
    *,
    keys: tuple[str, ...] = ("aoi_id", "feature_id"),
    dedupe_before_sum: bool = False,
    tie: Column | None = None,
) -> DataFrame:
    """Parts of one feature returned by several cells -> one row.

    Areas are summed over the rows as returned, so an outline returned whole by two cells counts
    twice; ``dedupe_before_sum`` drops repeated outlines first.  Every other column comes from the
    largest part.  The geometry is the union of the parts, without overlaps and without the borders of
    the cells; where all parts have one outline, it stays as it is.
    """
    rows = features
    if dedupe_before_sum and "geometry" in features.columns:
        rows = rows.withColumn("_shape", F.xxhash64("geometry"))
        rows = rows.dropDuplicates([*keys, "_shape"]).drop("_shape")
    sums = [c for c in SUMMED if c in features.columns]
    sort = F.col("clipped_area_sqm") if "clipped_area_sqm" in features.columns else F.col("area_sqm")
    others = [c for c in features.columns if c not in (*keys, *sums, "geometry")]
    order = [sort.isNull().alias("null_last"), (-sort).alias("size")]
    if tie is not None:
        order.append(tie.alias("tie"))
    aggs = [F.sum(c).alias(c) for c in sums]
    if others:
        aggs.append(F.min_by(F.struct(*others), F.struct(*order)).alias("_top"))
    shaped = "geometry" in features.columns
    if shaped:
        # Read twice; outlines may be costly to make.
        rows = cut_lineage(rows)
        aggs += group_sizes()
    out = rows.groupBy(*keys).agg(*aggs)
    zeros = {c: F.coalesce(F.col(c), F.lit(0.0)) for c in sums}
    picked = [F.col(f"_top.{c}").alias(c) for c in others]
    if not shaped:
        return out.withColumns(zeros).select(*keys, *picked, *sums)
    out = cut_lineage(out.withColumns(zeros).select(*keys, *picked, *sums, "_shapes", "_most"))
    united = dissolve(rows.select(*keys, "geometry"), list(keys), sizes=out.where("_shapes > 0"), keep=True)
    key = F.struct(*keys).alias("_key")
    joined = out.drop("_shapes", "_most").withColumn("_key", key).join(united.select(key, "geometry"), "_key", "left")
    return joined.drop("_key")


def conflicting_features(
    features: DataFrame, *, keys: tuple[str, ...] = ("aoi_id", "feature_id")
) -> DataFrame:
    """Features whose identity columns differ between cells, with the number of variants."""
    skip = {*keys, *SUMMED, "geometry"}
    cols = [c for c in features.columns if c not in skip]
    variants = F.struct(*cols)
    return (
        features.select(*keys, variants.alias("_v")).distinct()
        .groupBy(*keys).agg(F.count(F.lit(1)).alias("variants"))
        .where(F.col("variants") > 1)
    )


def accept_gridded(
    cells: DataFrame, *, min_pct: float = 100.0, inexact: bool = False
) -> DataFrame:
    """(aoi_id, cells_total, cells_ok, survey_dates, error): gridded areas with their verdict.

    ``cells`` has one row per requested cell with ``ok`` and ``survey_date``.  The number of failed
    cells may not exceed floor(total x allowed share); several survey dates are an error unless
    ``inexact``; an area without any good cell is an error.
    """
    g = cells.groupBy("aoi_id").agg(
        F.count(F.lit(1)).alias("cells_total"),
        F.count_if("ok").alias("cells_ok"),
        F.countDistinct(F.when(F.col("ok"), F.col("survey_date"))).alias("survey_dates"),
    )
    failed = F.col("cells_total") - F.col("cells_ok")
    allowed = F.floor(F.col("cells_total") * F.lit((100.0 - min_pct) / 100.0))
    error = (
        F.when(F.col("cells_ok") == 0, "all cells failed")
        .when(failed > allowed, "too many failed cells")
        .when((F.col("survey_dates") > 1) & F.lit(not inexact), "multiple survey dates")
    )
    return g.withColumn("error", error)


def grid_cell_errors(errors: DataFrame, cells: DataFrame) -> DataFrame:
    """Cell failures keep the cell's outline and the outer area id, marked as grid failures.

    ``cells`` have a ``geometry`` or, as :func:`grid_cells` gives them, a ``cell_box``: then four numbers travel
    and the outline is made where cell and failure have met.
    """
    boxed = "geometry" not in cells.columns
    shapes = cells.select("aoi_id", "cell_id", F.col("cell_box" if boxed else "geometry").alias("_cell"))
    met = errors.drop("geometry", "failure_type").join(shapes, ["aoi_id", "cell_id"], "left")
    b = F.col("_cell")
    shape = F.when(b.isNotNull(), G.box(b["minx"], b["miny"], b["maxx"], b["maxy"])) if boxed else b
    return met.withColumn("geometry", shape).drop("_cell").withColumn("failure_type", F.lit("grid"))


def first_cell_metadata(metadata: DataFrame) -> DataFrame:
    """One metadata row per gridded area: the first cell's, flagged ``gridded``."""
    others = [c for c in metadata.columns if c not in ("aoi_id", "cell_id", "gridded", "aggregate")]
    return (
        metadata.groupBy("aoi_id").agg(F.min_by(F.struct(*others), F.col("cell_id")).alias("m"))
        .select("aoi_id", "m.*", F.lit(True).alias("gridded"))
    )


def distinct_metadata(metadata: DataFrame) -> DataFrame:
    """Cell metadata without repeats, compared on the scalar columns only."""
    cols = [c for c in METADATA_IDENTITY if c in metadata.columns]
    return metadata.dropDuplicates(["aoi_id", *cols])
