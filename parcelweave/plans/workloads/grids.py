"""Grids, recombination, projections and footprint unions."""

from __future__ import annotations


from pyspark.sql import functions as F

from parcelweave.functions import geometry as G
from parcelweave.functions import kernel
from parcelweave.functions.columns import half_even
from parcelweave.operators import coverage, grid, spatial
from parcelweave.plans.registry import query
from parcelweave.plans.samples import ctes, half_even_sql as he, with_boxes
from parcelweave.session import spread
from parcelweave.sources import sinks
from parcelweave.config import MAX_AOI_SQM_BEFORE_GRIDDING, SMALL_BUILDING_SQM

_PARTS = """
with parts as (select cast(l_orderkey as string) as aoi_id, l_linenumber as feature_id, l_quantity as clipped_area_sqm,
  l_extendedprice as area_sqm, l_returnflag as flag, cast(cast(l_shipdate as date) as string) as survey_date,
  l_partkey, l_suppkey from lineitem)
"""


def _parts(t):
    return t.lineitem.select(
        F.col("l_orderkey").cast("string").alias("aoi_id"), F.col("l_linenumber").alias("feature_id"), F.col("l_quantity").alias("clipped_area_sqm"),
        F.col("l_extendedprice").alias("area_sqm"), F.col("l_returnflag").alias("flag"),
        F.col("l_shipdate").cast("date").cast("string").alias("survey_date"), "l_partkey", "l_suppkey",
    )


@query("combine_grid", _PARTS + f"""
select aoi_id, feature_id, {he('sum(clipped_area_sqm)', 2)} as clipped_area_sqm, {he('sum(area_sqm)', 2)} as area_sqm,
  first(flag order by clipped_area_sqm desc nulls last, l_partkey, l_suppkey, survey_date) as flag,
  first(survey_date order by clipped_area_sqm desc nulls last, l_partkey, l_suppkey, survey_date) as survey_date
from parts group by all""")
def combine_grid(t):
    """Parts of one feature from several cells: sums, and the largest part's values."""
    tie = F.struct("l_partkey", "l_suppkey", "survey_date")
    c = grid.combine_grid_features(_parts(t), tie=tie)
    return c.select(
        "aoi_id", "feature_id", half_even(F.col("clipped_area_sqm"), 2).alias("clipped_area_sqm"),
        half_even(F.col("area_sqm"), 2).alias("area_sqm"), "flag", "survey_date",
    )


@query("grid_conflicts", _PARTS + """
select aoi_id, feature_id, count(*) as variants from (select distinct aoi_id, feature_id, flag from parts) group by all having count(*) > 1""")
def grid_conflicts(t):
    """Features whose flag differs between their parts."""
    return grid.conflicting_features(_parts(t).drop("l_partkey", "l_suppkey", "survey_date"))


@query("grid_cells", ctes("aois") + """
select aoi_id, i as cell_col, j as cell_row, x1 + i * 25e-1 as minx, y1 + j * 25e-1 as miny
from aois, generate_series(0, cast(ceil((x2 - x1) / 25e-1) as bigint) - 1) a(i), generate_series(0, cast(ceil((y2 - y1) / 25e-1) as bigint) - 1) b(j)""")
def grid_cells(t):
    """All cells over each area's extent."""
    g = grid.grid_cells(t.aois(geometry=True).select("aoi_id", F.col("bbox").alias("box")), 2.5)
    return g.select("aoi_id", "cell_col", "cell_row", F.col("cell_box.minx").alias("minx"), F.col("cell_box.miny").alias("miny"))


@query("split_into_grid", ctes("aois") + f"""
select aoi_id, i as cell_col, j as cell_row, {he('(least(x2, x1 + (i + 1) * 25e-1) - (x1 + i * 25e-1)) * (least(y2, y1 + (j + 1) * 25e-1) - (y1 + j * 25e-1))', 6)} as area
from aois, generate_series(0, cast(ceil((x2 - x1) / 25e-1) as bigint) - 1) a(i), generate_series(0, cast(ceil((y2 - y1) / 25e-1) as bigint) - 1) b(j)""")
def split_into_grid(t):
    """Area ∩ cell pieces; the pieces of an area add up to it."""
    # Spread before the boxes are made: a table of small rows may be one task's to read.
    boxes = spread(t.aois().select("aoi_id", "x1", "y1", "x2", "y2"), "aoi_id")
    s = grid.split_into_grid(with_boxes(boxes), 2.5)
    return s.select("aoi_id", "cell_col", "cell_row", half_even(G.areas(F.col("geometry")), 6).alias("area"))


def _albers_sql(lon: str, lat: str) -> tuple[str, str]:
    p = G.PROJECTIONS["au"]
    a, inv = G.GRS80
    n, c, rho0, e = kernel.albers_constants(a, inv, p["lat0"], p["lat1"], p["lat2"])
    d = lambda v: f"cast('{v!r}' as double)"
    s = f"sin(radians({lat}))"
    q = f"{d(1 - e * e)} * ({s} / (1e0 - {d(e * e)} * {s} * {s}) - ln((1e0 - {d(e)} * {s}) / (1e0 + {d(e)} * {s})) / {d(2 * e)})"
    rho = f"({d(a / n)} * sqrt({d(c)} - {d(n)} * ({q})))"
    th = f"({d(n)} * radians({lon} - {d(p['lon0'])}))"
    return f"{rho} * sin({th})", f"{d(rho0)} - {rho} * cos({th})"


_LONLAT = """, g as (select *, 14e1 + l_partkey / 1e3 as lon, -3e1 - l_suppkey / 1e3 as lat from features)"""


@query("project_points", ctes("features") + _LONLAT + f"""
select aoi_id, feature_id, {he(_albers_sql('lon', 'lat')[0], 3)} as x, {he(_albers_sql('lon', 'lat')[1], 3)} as y from g""")
def project_points(t):
    """Longitude/latitude to the national equal-area grid."""
    lon, lat = F.lit(140.0) + F.col("l_partkey") / 1e3, F.lit(-30.0) - F.col("l_suppkey") / 1e3
    x, y = G.project_xy(lon, lat, "au")
    return t.features().select("aoi_id", "feature_id", half_even(x, 3).alias("x"), half_even(y, 3).alias("y"))


def _degree_box(t):
    """Areas of a few hundred metres to a few kilometres in degrees."""
    k = F.col("o_orderkey")
    lon, lat = F.lit(140.0) + (k % 1000) / 1e3, F.lit(-30.0) - (F.col("o_custkey") % 1000) / 1e3
    w, h = (1 + k % 20) / 1e3, (1 + F.col("o_custkey") % 20) / 1e3
    return with_boxes(t.aois().select("aoi_id", lon.alias("x1"), lat.alias("y1"), (lon + w).alias("x2"), (lat + h).alias("y2")))


def _grid_sql() -> str:
    corners = [("x1", "y1"), ("x2", "y1"), ("x2", "y2"), ("x1", "y2")]
    cols = []
    for i, (x, y) in enumerate(corners):
        px, py = _albers_sql(f"g.{x}", f"g.{y}")
        cols += [f"{px} as px{i}", f"{py} as py{i}"]
    area = " + ".join(f"(px{i} - px0) * (py{(i + 1) % 4} - py0) - (px{(i + 1) % 4} - px0) * (py{i} - py0)" for i in range(4))
    return ctes("aois") + f"""
    , g as (select aoi_id, o_orderkey, 14e1 + o_orderkey % 1000 / 1e3 as x1, -3e1 - o_custkey % 1000 / 1e3 as y1,
      14e1 + o_orderkey % 1000 / 1e3 + (1 + o_orderkey % 20) / 1e3 as x2, -3e1 - o_custkey % 1000 / 1e3 + (1 + o_custkey % 20) / 1e3 as y2 from aois)
    , p as (select aoi_id, o_orderkey, {', '.join(cols)} from g)
    , w as (select aoi_id, 'area' as reason from p where abs({area}) / 2e0 > {MAX_AOI_SQM_BEFORE_GRIDDING:e}
      union all select aoi_id, 'request_size' from g where o_orderkey % 40 = 1
      union all select aoi_id, 'include_skip' from g where o_orderkey % 50 = 7)
    select aoi_id, min(reason) as reason from w group by aoi_id"""


@query("needs_gridding", _grid_sql())
def needs_gridding(t):
    """Areas above one square kilometre, refused for size, or with skipped includes."""
    a = t.aois()
    errors = a.where(F.col("o_orderkey") % 40 == 1).select("aoi_id", F.lit("POLYGON_TOO_COMPLEX").alias("message"))
    skips = a.where(F.col("o_orderkey") % 50 == 7).select("aoi_id")
    return grid.needs_gridding(_degree_box(t), "au", errors=errors, skips=skips)


_CELLS = """
with cells as (select cast(l_orderkey as string) as aoi_id, l_linenumber as cell_id, l_suppkey % 4 <> 0 as ok,
  case when l_partkey % 9 = 0 then 'b' else 'a' end as survey_date, l_partkey, l_suppkey from lineitem)
"""


def _cells(t):
    return t.lineitem.select(
        F.col("l_orderkey").cast("string").alias("aoi_id"), F.col("l_linenumber").alias("cell_id"), (F.col("l_suppkey") % 4 != 0).alias("ok"),
        F.when(F.col("l_partkey") % 9 == 0, "b").otherwise("a").alias("survey_date"), "l_partkey", "l_suppkey",
    )


@query("accept_gridded", _CELLS + """
, g as (select aoi_id, count(*) as cells_total, count(*) filter (ok) as cells_ok, count(distinct case when ok then survey_date end) as survey_dates from cells group by aoi_id)
select *, case when cells_ok = 0 then 'all cells failed' when cells_total - cells_ok > floor(cells_total * 5e-1) then 'too many failed cells'
  when survey_dates > 1 then 'multiple survey dates' end as error from g""")
def accept_gridded(t):
    """Verdict per gridded area when half of the cells may fail."""
    return grid.accept_gridded(_cells(t), min_pct=50.0)


@query("grid_cell_errors", _CELLS + """
select aoi_id, cell_id, 'grid' as failure_type, 4e0 * cell_id as area, l_partkey, l_suppkey from cells where not ok""")
def grid_cell_errors(t):
    """Failed cells with the outline of their own cell."""
    cells = _cells(t)
    box = F.struct(F.lit(0.0).alias("minx"), F.lit(0.0).alias("miny"), F.col("cell_id").cast("double").alias("maxx"), F.lit(4.0).alias("maxy"))
    shapes = cells.select("aoi_id", "cell_id").distinct().withColumn("cell_box", box)
    errors = cells.where(~F.col("ok")).withColumn("failure_type", F.lit("standard"))
    out = grid.grid_cell_errors(errors, shapes)
    return out.select("aoi_id", "cell_id", "failure_type", G.area(F.col("geometry")).alias("area"), "l_partkey", "l_suppkey")


@query("first_cell_metadata", _CELLS + """
select aoi_id, first(survey_date order by cell_id, l_partkey, l_suppkey) as survey_date, true as gridded from cells group by aoi_id""")
def first_cell_metadata(t):
    """Metadata of the first cell for each gridded area."""
    c = _cells(t)
    m = c.select("aoi_id", F.struct("cell_id", "l_partkey", "l_suppkey").alias("cell_id"), "survey_date")
    return grid.first_cell_metadata(m)


@query("distinct_cell_metadata", _CELLS + "select distinct aoi_id, survey_date from cells")
def distinct_cell_metadata(t):
    """Cell metadata without repeats."""
    return grid.distinct_metadata(_cells(t).select("aoi_id", "survey_date"))


@query("clip_to_area", ctes("features", "aois") + f"""
select f.aoi_id, f.feature_id, {he('greatest(least(f.x2, a.x2) - f.x1, 0e0) * greatest(least(f.y2, a.y2) - f.y1, 0e0)', 6)} as area
from features f join aois a using (aoi_id)""")
def clip_to_area(t):
    """Features clipped to their area."""
    masks = t.aois(geometry=True).select("aoi_id", F.col("geometry").alias("mask"))
    f = t.features(geometry=True).join(masks, "aoi_id")
    cut = f.select("aoi_id", "feature_id", G.clip_to_geometry(F.col("geometry"), F.col("mask")).alias("geometry"))
    return cut.select("aoi_id", "feature_id", half_even(F.coalesce(G.area(F.col("geometry")), F.lit(0.0)), 6).alias("area"))


@query("clipped_ground_areas")
def clipped_ground_areas(t):
    """Clipped areas in square metres and square feet, on the national grid."""
    a = _degree_box(t)
    f = t.features().select("aoi_id", "feature_id", "l_partkey").join(a.select("aoi_id", "x1", "y1"), "aoi_id")
    w = (1 + F.col("l_partkey") % 5) / 1e3
    f = with_boxes(f.withColumns({"x2": F.col("x1") + w, "y2": F.col("y1") + w}))
    return spatial.clip_to_aoi(f, a, "au").select("aoi_id", "feature_id", "clipped_area_sqm", "clipped_area_sqft")


_FOOT = """
with feet as (select event_type as event_id, cast(user_id % 40 as double) as x1, cast(event_id % 30 as double) as y1,
  cast(user_id % 40 + 1 + event_id % 6 as double) as x2, cast(event_id % 30 + 1 + user_id % 5 as double) as y2 from events)
"""


def _feet(t):
    u, e = F.col("user_id"), F.col("event_id")
    return with_boxes(t.events.select(
        F.col("event_type").alias("event_id"), (u % 40).cast("double").alias("x1"), (e % 30).cast("double").alias("y1"),
        (u % 40 + 1 + e % 6).cast("double").alias("x2"), (e % 30 + 1 + u % 5).cast("double").alias("y2"),
    ))


@query("footprint_union_area", _FOOT + f"""
select event_id, {he('count(*)', 6)} as area from (select distinct event_id, i, j from feet,
  generate_series(cast(x1 as bigint), cast(x2 as bigint) - 1) a(i), generate_series(cast(y1 as bigint), cast(y2 as bigint) - 1) b(j)) group by event_id""")
def footprint_union_area(t):
    """Area covered by any footprint of an event, overlaps counted once."""
    cells = spatial.union_cells(_feet(t).drop("bbox"), ["event_id"], cell_size=8.0)
    return spatial.union_area(cells, ["event_id"]).select("event_id", half_even(F.col("area"), 6).alias("area"))


@query("points_in_footprints", _FOOT + """
, pts as (select c_custkey, cast(c_custkey % 50 as double) + 25e-2 as lon, cast(c_nationkey as double) + 75e-2 as lat from customer),
hits as (select c_custkey, event_id, count(*) as n from pts join feet on lon > x1 and lon < x2 and lat > y1 and lat < y2 group by all)
select * from hits""")
def points_in_footprints(t):
    """Points ⋈ the footprints around them."""
    pts = t.customer.select("c_custkey", ((F.col("c_custkey") % 50) + 0.25).cast("double").alias("lon"), (F.col("c_nationkey") + 0.75).cast("double").alias("lat"))
    return coverage.count_footprints_at_points(pts, _feet(t).select("event_id", "geometry"), "c_custkey", ["event_id"], cell_size=8.0)


@query("query_points", ctes("aois") + """
select aoi_id, (y1 + y2) / 2e0 as query_aoi_lat, (x1 + x2) / 2e0 as query_aoi_lon from aois""")
def query_points(t):
    """A point inside each area; the centroid for a convex one."""
    return sinks.with_query_point(t.aois(geometry=True)).select("aoi_id", "query_aoi_lat", "query_aoi_lon")


@query("map_links", ctes("features") + """
select aoi_id, feature_id, 'https://maps.example/#/@' || cast(cast((y1 + y2) / 2e0 as decimal(9, 1)) as string) || ',' || cast(cast((x1 + x2) / 2e0 as decimal(9, 1)) as string)
  || ',21.00z,0d' || case when l_partkey % 4 = 0 then '' else '/V/' || replace(survey_date, '-', '') end || '?locationMarker' as link from features""")
def map_links(t):
    """Viewer link from centroid and date; dateless where there is no date."""
    day = F.when(F.col("l_partkey") % 4 != 0, F.col("survey_date"))
    f = t.features(geometry=True)
    return f.select("aoi_id", "feature_id", sinks.map_link("https://maps.example/#/@", F.col("geometry"), day).alias("link"))


@query("small_buildings", ctes("features") + f"""
select aoi_id, feature_id, (x2 - x1) * (y2 - y1) * 4e0 < {SMALL_BUILDING_SQM:e} as is_small from features""")
def small_buildings(t):
    """Strictly below the small-building area."""
    f = t.features(geometry=True)
    return f.select("aoi_id", "feature_id", (G.area(F.col("geometry")) * 4.0 < SMALL_BUILDING_SQM).alias("is_small"))


@query("geometry_round_trip", ctes("features") + """
select aoi_id, feature_id, (x2 - x1) * (y2 - y1) as area, x1 as minx, y2 as maxy from features""")
def geometry_round_trip(t):
    """Outline → WKT → outline → WKB → outline keeps area and extent."""
    f = t.features(geometry=True)
    g = f.select("aoi_id", "feature_id", G.from_wkb(G.to_wkb(G.from_wkt(G.to_wkt(F.col("geometry"))))).alias("g"))
    b = G.bbox(F.col("g"))
    return g.select("aoi_id", "feature_id", G.areas(F.col("g")).alias("area"), b["minx"].alias("minx"), b["maxy"].alias("maxy"))
