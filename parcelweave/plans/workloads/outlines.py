"""Unions and checks of outlines that are no rectangles: triangles, L-shapes and frames.

All shapes lie on half unit squares, cut along one diagonal, so plain SQL can list what each covers.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from parcelweave.functions import geometry as G
from parcelweave.functions.columns import half_even
from parcelweave.operators import coverage, grid, outlines
from parcelweave.operators.outlines import boundary_length
from parcelweave.plans.registry import query
from parcelweave.plans.samples import ctes, half_even_sql as he
from parcelweave.session import spread
from parcelweave.sources import aoi, payloads


def _coordinates(kind: Column, x: Column, y: Column, s: Column) -> Column:
    """GeoJSON coordinates of a square (0), lower (1) or upper (2) triangle, L (3) or frame (4) of size s."""
    c = s - F.floor(s / 2)

    def ring(*points):
        return F.concat(F.lit("["), F.concat_ws(",", *[F.concat(F.lit("["), (x + a).cast("string"), F.lit(","), (y + b).cast("string"), F.lit("]")) for a, b in points]), F.lit("]"))

    o, one = F.lit(0), F.lit(1)
    square = ring((o, o), (s, o), (s, s), (o, s), (o, o))
    inner = ring((one, one), (one, s - 1), (s - 1, s - 1), (s - 1, one), (one, one))
    shape = (
        F.when(kind == 0, square).when(kind == 1, ring((o, o), (s, o), (o, s), (o, o))).when(kind == 2, ring((s, o), (s, s), (o, s), (s, o)))
        .when(kind == 3, ring((o, o), (s, o), (s, c), (c, c), (c, s), (o, s), (o, o))).otherwise(F.concat(square, F.lit(","), inner))
    )
    return F.concat(F.lit("["), shape, F.lit("]"))


def _geojson(kind: Column, x: Column, y: Column, s: Column) -> Column:
    return F.concat(F.lit('{"type":"Polygon","coordinates":'), _coordinates(kind, x, y, s), F.lit("}"))


def _measured(key: str) -> str:
    """SQL of the area and length of each group's union, from ``shapes`` (key, kind, x, y, s)."""
    return f"""
halves as (select distinct {key}, x + a as i, y + b as j, h from shapes, generate_series(0, s - 1) p(a), generate_series(0, s - 1) q(b), (values (0), (1)) r(h)
  where case kind when 0 then true when 1 then a + b + h <= s - 1 when 2 then a + b + h >= s when 3 then not (a >= s - s // 2 and b >= s - s // 2)
    else not (a between 1 and s - 2 and b between 1 and s - 2) end),
sides as (select {key}, i, j, 1 - h as h, sqrt(2e0) as len from halves union all select {key}, i - 1 + 2 * h, j, 1 - h, 1e0 from halves union all select {key}, i, j - 1 + 2 * h, 1 - h, 1e0 from halves),
open_sides as (select {key}, sum(len) as boundary_length from sides anti join halves using ({key}, i, j, h) group by {key}),
covered as (select {key}, count(*) / 2e0 as area from halves group by {key})"""


_GRID_PARTS = """
with parts as (select l_orderkey as aoi_id, l_linenumber % 2 as feature_id, l_quantity as clipped_area_sqm, l_partkey % 5 as kind,
  l_partkey % 7 as x, l_suppkey % 5 as y, case l_partkey % 5 when 4 then 3 else 2 end + l_suppkey % 3 as s from lineitem),
shapes as (select aoi_id * 2 + feature_id as g, * from parts),"""


@query("combine_grid_outlines", _GRID_PARTS + _measured("g") + f"""
select aoi_id, feature_id, clipped_area_sqm, {he('area', 6)} as area, {he('boundary_length', 6)} as boundary_length
from (select aoi_id, feature_id, g, sum(clipped_area_sqm) as clipped_area_sqm from shapes group by all) join covered using (g) join open_sides using (g)""")
def combine_grid_outlines(t):
    """Parts of one feature dissolved into one outline: its area and the length of its boundary."""
    k, u = F.col("l_partkey"), F.col("l_suppkey")
    size = F.when(k % 5 == 4, 3).otherwise(2) + u % 3
    # Texts are made and parsed by all tasks, however few row groups the table has.
    parts = spread(t.lineitem.select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity")).select(
        F.col("l_orderkey").alias("aoi_id"), (F.col("l_linenumber") % 2).alias("feature_id"), F.col("l_quantity").alias("clipped_area_sqm"),
        G.from_geojson(_geojson(k % 5, k % 7, u % 5, size)).alias("geometry"),
    )
    whole = grid.combine_grid_features(parts)
    return whole.select(
        "aoi_id", "feature_id", "clipped_area_sqm", half_even(G.area(F.col("geometry")), 6).alias("area"), half_even(boundary_length(F.col("geometry")), 6).alias("boundary_length")
    )


_EVENTS = """
with shapes as (select 'ev' || cast(event_id % 97 as string) as event_id, cast(ts as date) as day, event_id % 5 as kind,
  event_id * 7919 % 89 as x, (user_id * 31 + event_id) % 61 as y, case event_id % 5 when 4 then 3 else 2 end + user_id % 3 as s
  from events where cast(ts as date) <= date '2024-01-24'),
counts as (select event_id, count(*) as footprints, cast(min(day) as string) as first_capture, cast(max(day) as string) as last_capture from shapes group by event_id),"""


@query("event_boundary", _EVENTS + _measured("event_id") + f"""
select event_id, footprints, first_capture, last_capture, {he('area', 6)} as area, {he('boundary_length', 6)} as boundary_length
from counts join covered using (event_id) join open_sides using (event_id)""")
def event_boundary(t):
    """Coverage payloads → tagged tiles → one outline per event as of a day."""
    e, u = F.col("event_id"), F.col("user_id")
    tile = _geojson(e % 5, e * 7919 % 89, (u * 31 + e) % 61, F.when(e % 5 == 4, 3).otherwise(2) + u % 3)
    payload = F.concat(
        F.lit('{"surveys":[{"id":"s'), e.cast("string"), F.lit('","captureDate":"'), F.date_format("ts", "yyyy-MM-dd"), F.lit('","tags":{"postCatEventId":"ev'), (e % 97).cast("string"),
        F.lit('"},"resources":{"tiles":[{"id":"t","boundary":'), tile, F.lit("}]}}]}"),
    )
    surveys = payloads.survey_rows(spread(t.events.select("event_id", "user_id", "ts")).select(u.cast("string").alias("aoi_id"), payload.alias("payload")))
    found = coverage.event_boundary(payloads.survey_footprints(surveys), until="2024-01-24")
    return found.select(
        "event_id", "footprints", F.col("first_capture").cast("string").alias("first_capture"), F.col("last_capture").cast("string").alias("last_capture"),
        half_even(G.area(F.col("geometry")), 6).alias("area"), half_even(boundary_length(F.col("geometry")), 6).alias("boundary_length"),
    )


#: (parts as rings of corners in shares of the feature's box, what is wrong with it).
_B = lambda a, b, c, d: ((a, b), (c, b), (c, d), (a, d), (a, b))
_HOLE = outlines.REASONS[5]
_OUTLINES = [
    ([[_B(0, 0, 1, 1)]], None),
    ([[((0, 0), (1, 1), (1, 0), (0, 0.5), (0, 0))]], "ring meets itself"),
    ([[_B(0, 0, 0.5, 0.5)], [_B(0.25, 0.25, 1, 1)]], "rings cross"),
    ([[_B(0, 0, 0.5, 0.5), _B(0.625, 0.625, 0.875, 0.875)]], _HOLE),
    ([[((0, 0), (1, 0), (0.5, 0.5), (1, 1), (0, 1), (0.5, 0.5), (0, 0))]], "ring meets itself"),
    ([[_B(0, 0, 0.75, 0.75), _B(0.5, 0.25, 1, 0.5)]], "rings cross"),
    ([[_B(0, 0, 1, 1), ((0, 0.5), (0.5, 0.25), (0.5, 0.75), (0, 0.5))]], None),
    ([[_B(0, 0, 0.5, 0.5)], [_B(0.5, 0.5, 1, 1)]], None),
    ([[_B(0, 0, 1, 1), _B(0.125, 0.125, 0.875, 0.875), _B(0.25, 0.25, 0.5, 0.5)]], _HOLE),
    ([[_B(0, 0, 1, 1), _B(0.125, 0.125, 0.875, 0.875)], [_B(0.25, 0.25, 0.5, 0.5)]], None),
    ([[_B(0, 0, 0.5, 1)], [_B(0.5, 0, 1, 1)]], "rings share a line"),
    ([[_B(0, 0, 1, 1)], [_B(0.25, 0.25, 0.5, 0.5)]], "parts overlap"),
    ([[_B(0, 0, 1, 1), ((0, 0.5), (0.5, 0.25), (1, 0.5), (0.5, 0.75), (0, 0.5))]], "inside is not connected"),
    ([[((0, 0), (1, 0), (1, 1), (1, 0), (0, 1), (0, 0))]], "ring meets itself"),
]


def _odd_outlines(t):
    """Features whose outline is one of the cases, in turn; each fifteenth is missing."""
    x1, y1, w, h = F.col("x1"), F.col("y1"), F.col("x2") - F.col("x1"), F.col("y2") - F.col("y1")

    def number(c):
        return c.cast("string")

    def ring(points):
        return F.concat(F.lit("("), F.concat_ws(",", *[F.concat(number(x1 + w * a), F.lit(" "), number(y1 + h * b)) for a, b in points]), F.lit(")"))

    text = F.when(F.col("l_suppkey") % 2 == 0, "POLYGON EMPTY").otherwise("POINT (1 2)")
    for k, (parts, _) in enumerate(_OUTLINES):
        body = F.concat_ws(",", *[F.concat(F.lit("("), F.concat_ws(",", *[ring(r) for r in p]), F.lit(")")) for p in parts])
        text = F.when(F.col("l_partkey") % 15 == k, F.concat(F.lit("MULTIPOLYGON ("), body, F.lit(")"))).otherwise(text)
    # Texts are made and parsed by all tasks, however few row groups the table has.
    return spread(t.features()).withColumn("geometry", G.from_wkt(text))


_GOOD = ", ".join(str(k) for k, (_, reason) in enumerate(_OUTLINES) if reason is None)


@query("valid_geometry", ctes("features") + f"""
select aoi_id, feature_id from features where l_partkey % 15 in ({_GOOD})""")
def valid_geometry(t):
    """Missing outlines, and those that are no valid area, are left out."""
    return aoi.valid_geometry(_odd_outlines(t).select("aoi_id", "feature_id", "geometry")).select("aoi_id", "feature_id")


@query("invalid_outlines", ctes("features") + f"""
select aoi_id, feature_id, l_linenumber, case l_partkey % 15 {' '.join(f"when {k} then '{reason}'" for k, (_, reason) in enumerate(_OUTLINES) if reason)} end as reason
from features where l_partkey % 15 not in (14, {_GOOD})""")
def invalid_outlines(t):
    """What is wrong with each outline that is no valid area."""
    rows = _odd_outlines(t).select("aoi_id", "feature_id", "l_linenumber", "geometry").withColumn("row", F.monotonically_increasing_id())
    told = outlines.judged(rows, "row").where(F.col("reason").isNotNull())
    return told.select("aoi_id", "feature_id", "l_linenumber", "reason")
