"""Geometry as ordinary nested columns.

``GEOM`` is ``array<array<array<struct<x,y>>>>``: parts, rings, points.  Parsing WKT and GeoJSON,
bounding boxes, areas, centroids, containment, distances and projections are built-in column
expressions; only operations on pairs of arbitrary outlines go through an Arrow function.
"""

from __future__ import annotations


import numpy as np
import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from parcelweave.functions import kernel, unions
from parcelweave.functions.columns import let

POINT = "struct<x:double,y:double>"
RING = f"array<{POINT}>"
GEOM = f"array<array<{RING}>>"
# Type objects, because decorators run before there is a session to parse DDL.
POINT_TYPE = T.StructType([T.StructField("x", T.DoubleType()), T.StructField("y", T.DoubleType())])
GEOM_TYPE = T.ArrayType(T.ArrayType(T.ArrayType(POINT_TYPE)))


def _once(function):
    """Keep the optimizer from copying a kernel call into a filter on its result."""
    return function.asNondeterministic()


# ------------------------------------------------------------------ text formats
@_once
@arrow_udf(GEOM_TYPE)
def _regular_wkt(text: pa.Array) -> pa.Array:
    return kernel.parse_wkt_rows(text)


def from_wkt(text: Column) -> Column:
    """WKT POLYGON / MULTIPOLYGON -> GEOM; anything else (also EMPTY) -> NULL.

    Two-dimensional ones are read a batch at a time, only the others by expressions."""
    return F.coalesce(_regular_wkt(text), _any_wkt(text))


def _any_wkt(text: Column) -> Column:
    kind = F.upper(F.regexp_extract(text, r"^\s*([A-Za-z]+)", 1))
    body = F.regexp_replace(text, r"^\s*[A-Za-z]+(\s+[ZzMm]{1,2}(?=\s*\())?\s*", "")
    points = F.regexp_replace(
        body, r"([-0-9.eE]+)\s+([-0-9.eE]+)(?:\s+[-0-9.eE]+)*", '{"x":$1,"y":$2}'
    )
    arrays = F.translate(points, "()", "[]")
    coords = F.when(kind == "POLYGON", F.concat(F.lit("["), arrays, F.lit("]"))).when(
        kind == "MULTIPOLYGON", arrays
    )
    return F.from_json(coords, GEOM)


def to_wkt(geom: Column) -> Column:
    """GEOM -> WKT, POLYGON for one part and MULTIPOLYGON for several."""

    def ring(r):
        pts = F.transform(r, lambda p: F.concat(p["x"].cast("string"), F.lit(" "), p["y"].cast("string")))
        return F.concat(F.lit("("), F.array_join(pts, ", "), F.lit(")"))

    def part(p):
        return F.concat(F.lit("("), F.array_join(F.transform(p, ring), ", "), F.lit(")"))

    parts = F.transform(geom, part)
    return F.when(F.size(geom) == 1, F.concat(F.lit("POLYGON "), F.get(parts, F.lit(0)))).when(
        F.size(geom) > 1, F.concat(F.lit("MULTIPOLYGON ("), F.array_join(parts, ", "), F.lit(")"))
    )


def from_geojson(text: Column) -> Column:
    """GeoJSON geometry text -> GEOM; other geometry types and malformed text -> NULL."""
    kind = F.get_json_object(text, "$.type")
    coords = F.get_json_object(text, "$.coordinates")
    nested = F.when(kind == "Polygon", F.concat(F.lit("["), coords, F.lit("]"))).when(
        kind == "MultiPolygon", coords
    )
    numbers = F.from_json(nested, "array<array<array<array<double>>>>")
    return F.transform(
        numbers,
        lambda part: F.transform(
            part, lambda ring: F.transform(ring, lambda p: F.struct(F.get(p, F.lit(0)).alias("x"), F.get(p, F.lit(1)).alias("y")))
        ),
    )


def box(x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Axis-aligned rectangle as GEOM, counter-clockwise and closed."""

    def pt(x, y):
        return F.struct(x.cast("double").alias("x"), y.cast("double").alias("y"))

    return F.array(F.array(F.array(pt(x1, y1), pt(x2, y1), pt(x2, y2), pt(x1, y2), pt(x1, y1))))


# ------------------------------------------------------------------ binary format
@_once
@arrow_udf(GEOM_TYPE)
def from_wkb(blob: pa.Array) -> pa.Array:
    """WKB -> GEOM; a blob that cannot be read becomes NULL."""
    return kernel.parse_wkb_rows(blob)


@_once
@arrow_udf(T.BinaryType())
def to_wkb(geom: pa.Array) -> pa.Array:
    """GEOM -> WKB."""
    return kernel.format_wkb_rows(geom)


# ------------------------------------------------------------------ measures
def bbox(geom: Column) -> Column:
    """Bounding box struct; NULL for NULL or empty geometry."""
    pts = F.flatten(F.flatten(geom))
    xs, ys = pts.getField("x"), pts.getField("y")
    return F.when(
        F.size(pts) > 0,
        F.struct(
            F.array_min(xs).alias("minx"),
            F.array_min(ys).alias("miny"),
            F.array_max(xs).alias("maxx"),
            F.array_max(ys).alias("maxy"),
        ),
    )


def _edges(ring: Column, start: Column, step) -> Column:
    """Fold ``step(acc, p, q)`` over consecutive point pairs of a closed ring."""
    return F.aggregate(
        F.arrays_zip(
            F.slice(ring, F.lit(1), F.greatest(F.size(ring) - 1, F.lit(0))).alias("p"),
            F.slice(ring, F.lit(2), F.greatest(F.size(ring) - 1, F.lit(0))).alias("q"),
        ),
        start,
        lambda acc, e: step(acc, e["p"], e["q"]),
    )


def _ring_area(ring: Column) -> Column:
    """Signed shoelace area relative to the ring's first point."""
    first = F.get(ring, F.lit(0))
    x0, y0 = first["x"], first["y"]
    return _edges(
        ring,
        F.lit(0.0),
        lambda acc, p, q: acc + (p["x"] - x0) * (q["y"] - y0) - (q["x"] - x0) * (p["y"] - y0),
    ) / F.lit(2.0)


def area(geom: Column) -> Column:
    """Planar area: outlines minus holes."""

    def part(p):
        holes = F.aggregate(
            F.slice(p, F.lit(2), F.greatest(F.size(p) - 1, F.lit(0))),
            F.lit(0.0),
            lambda acc, r: acc + F.abs(_ring_area(r)),
        )
        return F.abs(_ring_area(F.get(p, F.lit(0)))) - holes

    return F.aggregate(geom, F.lit(0.0), lambda acc, p: acc + part(p))


@_once
@arrow_udf(T.DoubleType())
def areas(geom: pa.Array) -> pa.Array:
    """:func:`area`, a batch at a time: for many rows of small outlines, but not inside a lambda."""
    return kernel.planar_areas(geom)


def centroid(geom: Column) -> Column:
    """Area-weighted centroid as struct<x,y>."""
    zero = F.struct(F.lit(0.0).alias("a"), F.lit(0.0).alias("x"), F.lit(0.0).alias("y"))

    def moments(ring, x0, y0):
        def step(acc, p, q):
            px, py, qx, qy = p["x"] - x0, p["y"] - y0, q["x"] - x0, q["y"] - y0
            w = px * qy - qx * py
            return F.struct(
                (acc["a"] + w).alias("a"),
                (acc["x"] + (px + qx) * w).alias("x"),
                (acc["y"] + (py + qy) * w).alias("y"),
            )

        return _edges(ring, zero, step)

    def signed(m, i):
        s = F.signum(m["a"]) * F.when(i == 0, F.lit(1.0)).otherwise(F.lit(-1.0))
        return F.struct((m["a"] * s).alias("a"), (m["x"] * s).alias("x"), (m["y"] * s).alias("y"))

    def answer(g):
        first = F.get(F.get(F.get(g, F.lit(0)), F.lit(0)), F.lit(0))

        def around(o):
            per_ring = F.flatten(
                F.transform(g, lambda part: F.transform(F.transform(part, lambda r: moments(r, o["x"], o["y"])), signed))
            )
            total = F.aggregate(
                per_ring,
                zero,
                lambda acc, m: F.struct(
                    (acc["a"] + m["a"]).alias("a"), (acc["x"] + m["x"]).alias("x"), (acc["y"] + m["y"]).alias("y")
                ),
            )
            return let(
                total,
                lambda t: F.when(
                    t["a"] != 0,
                    F.struct((o["x"] + t["x"] / (t["a"] * 3)).alias("x"), (o["y"] + t["y"] / (t["a"] * 3)).alias("y")),
                ),
            )

        return let(first, around)

    return let(geom, answer)


def _all_rings(geom: Column) -> Column:
    return F.flatten(geom)


def _target(geom: Column, px: Column, py: Column) -> Column:
    return F.struct(geom.alias("g"), px.alias("x"), py.alias("y"))


def contains_point(geom: Column, px: Column, py: Column) -> Column:
    """Even-odd crossing test over all rings; boundary points count as outside or inside by side."""
    return let(_target(geom, px, py), lambda t: _contains(t["g"], t["x"], t["y"]))


def _contains(geom: Column, px: Column, py: Column) -> Column:
    def crossings(ring):
        def step(acc, p, q):
            spans = (p["y"] > py) != (q["y"] > py)
            at = p["x"] + (py - p["y"]) * (q["x"] - p["x"]) / F.nullif(q["y"] - p["y"], F.lit(0.0))
            return acc + F.when(spans & (px < at), 1).otherwise(0)

        return _edges(ring, F.lit(0), step)

    total = F.aggregate(_all_rings(geom), F.lit(0), lambda acc, r: acc + crossings(r))
    return total % 2 == 1


def distance_to_point(geom: Column, px: Column, py: Column) -> Column:
    """Planar distance from a point to the filled shape; 0 inside."""
    return let(_target(geom, px, py), lambda t: _distance(t["g"], t["x"], t["y"]))


def _distance(geom: Column, px: Column, py: Column) -> Column:
    def nearest(ring):
        def step(acc, p, q):
            dx, dy = q["x"] - p["x"], q["y"] - p["y"]
            len2 = dx * dx + dy * dy
            t = F.coalesce(((px - p["x"]) * dx + (py - p["y"]) * dy) / F.nullif(len2, F.lit(0.0)), F.lit(0.0))
            t = F.greatest(F.lit(0.0), F.least(F.lit(1.0), t))
            return F.least(acc, F.hypot(px - p["x"] - t * dx, py - p["y"] - t * dy))

        return _edges(ring, F.lit(float("inf")), step)

    edge = F.aggregate(_all_rings(geom), F.lit(float("inf")), lambda acc, r: F.least(acc, nearest(r)))
    return F.when(_contains(geom, px, py), F.lit(0.0)).otherwise(edge)


def inside_point(geom: Column) -> Column:
    """A point inside the shape: the centroid if it lies inside, else the middle of the widest
    interior run of the largest part along a horizontal line through its bounding box."""

    def crossings(ring, y):
        hits = F.transform(
            F.arrays_zip(
                F.slice(ring, F.lit(1), F.greatest(F.size(ring) - 1, F.lit(0))).alias("p"),
                F.slice(ring, F.lit(2), F.greatest(F.size(ring) - 1, F.lit(0))).alias("q"),
            ),
            lambda e: F.when(
                (e["p"]["y"] > y) != (e["q"]["y"] > y),
                e["p"]["x"]
                + (y - e["p"]["y"]) * (e["q"]["x"] - e["p"]["x"]) / F.nullif(e["q"]["y"] - e["p"]["y"], F.lit(0.0)),
            ),
        )
        return F.filter(hits, lambda v: v.isNotNull())

    def widest(xs, y):
        runs = F.transform(
            F.filter(F.sequence(F.lit(0), F.greatest(F.size(xs) - 2, F.lit(0))), lambda i: i % 2 == 0),
            lambda i: F.struct(
                (F.get(xs, i + 1) - F.get(xs, i)).alias("width"), ((F.get(xs, i) + F.get(xs, i + 1)) / 2).alias("x")
            ),
        )
        return F.when(F.size(xs) > 1, F.struct(F.array_max(runs)["x"].alias("x"), y.alias("y")))

    def scan(g):
        parts = F.transform(g, lambda p: F.struct(area(F.array(p)).alias("a"), p.alias("part")))

        def across(rings):
            b = bbox(F.array(rings))
            # Nudge off the middle so that the scan line does not run through typical vertices.
            middle = let(b, lambda v: v["miny"] + (v["maxy"] - v["miny"]) * F.lit(0.4999871))
            return let(
                middle,
                lambda y: let(F.array_sort(F.flatten(F.transform(rings, lambda r: crossings(r, y)))), lambda xs: widest(xs, y)),
            )

        return let(F.array_max(parts)["part"], across)

    return let(
        geom, lambda g: let(centroid(g), lambda c: F.when(_contains(g, c["x"], c["y"]), c).otherwise(scan(g)))
    )


# ------------------------------------------------------------------ projections
# Public registry parameters of the equal-area (or national) grid per country,
# all on the GRS80 ellipsoid.
GRS80 = (6378137.0, 298.257222101)
PROJECTIONS = {
    "au": {"code": "EPSG:3577", "kind": "albers", "lat0": 0.0, "lon0": 132.0, "lat1": -18.0, "lat2": -36.0},
    "ca": {"code": "ESRI:102001", "kind": "albers", "lat0": 40.0, "lon0": -96.0, "lat1": 50.0, "lat2": 70.0},
    "nz": {"code": "EPSG:2193", "kind": "tm", "lat0": 0.0, "lon0": 173.0, "k0": 0.9996, "fe": 1600000.0, "fn": 10000000.0},
    "us": {"code": "ESRI:102003", "kind": "albers", "lat0": 37.5, "lon0": -96.0, "lat1": 29.5, "lat2": 45.5},
}


def _albers_polar(lon: Column, lat: Column, p: dict) -> tuple[Column, Column, float]:
    a, inv_f = GRS80
    n, c, rho0, e = kernel.albers_constants(a, inv_f, p["lat0"], p["lat1"], p["lat2"])

    def radius(s):
        q = F.lit(1 - e * e) * (
            s / (1 - F.lit(e * e) * s * s) - F.log((1 - F.lit(e) * s) / (1 + F.lit(e) * s)) / F.lit(2 * e)
        )
        return F.lit(a / n) * F.sqrt(F.lit(c) - F.lit(n) * q)

    return let(F.sin(F.radians(lat)), radius), F.lit(n) * F.radians(lon - F.lit(p["lon0"])), rho0


def _albers(lon: Column, lat: Column, p: dict) -> tuple[Column, Column]:
    rho, theta, rho0 = _albers_polar(lon, lat, p)
    return rho * F.sin(theta), F.lit(rho0) - rho * F.cos(theta)


def _transverse_mercator(lon: Column, lat: Column, p: dict) -> tuple[Column, Column]:
    a, inv_f = GRS80
    f = 1 / inv_f
    e2 = 2 * f - f * f
    ep2 = e2 / (1 - e2)

    def meridian(phi: Column) -> Column:
        terms = (
            (1 - e2 / 4 - 3 * e2**2 / 64 - 5 * e2**3 / 256, 0),
            (-(3 * e2 / 8 + 3 * e2**2 / 32 + 45 * e2**3 / 1024), 2),
            (15 * e2**2 / 256 + 45 * e2**3 / 1024, 4),
            (-(35 * e2**3 / 3072), 6),
        )
        total = F.lit(0.0)
        for k, m in terms:
            total = total + F.lit(k) * (phi if m == 0 else F.sin(F.lit(float(m)) * phi))
        return F.lit(a) * total

    phi = F.radians(lat)
    cos, tan = F.cos(phi), F.tan(phi)
    t, c = tan * tan, F.lit(ep2) * cos * cos
    big_a = F.radians(lon - F.lit(p["lon0"])) * cos
    n = F.lit(a) / F.sqrt(1 - F.lit(e2) * F.sin(phi) * F.sin(phi))
    a2 = big_a * big_a
    east = n * (
        big_a
        + (1 - t + c) * a2 * big_a / 6
        + (5 - 18 * t + t * t + 72 * c - F.lit(58 * ep2)) * a2 * a2 * big_a / 120
    )
    north = meridian(phi) + n * tan * (
        a2 / 2
        + (5 - t + 9 * c + 4 * c * c) * a2 * a2 / 24
        + (61 - 58 * t + t * t + 600 * c - F.lit(330 * ep2)) * a2 * a2 * a2 / 720
    )
    m0 = F.lit(0.0) if p["lat0"] == 0 else meridian(F.radians(F.lit(p["lat0"])))
    return F.lit(p["fe"]) + F.lit(p["k0"]) * east, F.lit(p["fn"]) + F.lit(p["k0"]) * (north - m0)


def project_xy(lon: Column, lat: Column, country: str) -> tuple[Column, Column]:
    """Longitude/latitude in degrees -> metres on the country's grid."""
    p = PROJECTIONS[country.lower()]
    return (_albers if p["kind"] == "albers" else _transverse_mercator)(lon, lat, p)


def project(geom: Column, country: str) -> Column:
    """Project every point of a lon/lat geometry to the country's grid."""

    grid = PROJECTIONS[country.lower()]

    def pt(p):
        if grid["kind"] == "albers":
            # Radius and angle once per point, not once per coordinate.
            rho, theta, rho0 = _albers_polar(p["x"], p["y"], grid)
            polar = F.struct(rho.alias("r"), theta.alias("t"))
            return let(polar, lambda v: F.struct((v["r"] * F.sin(v["t"])).alias("x"), (F.lit(rho0) - v["r"] * F.cos(v["t"])).alias("y")))
        x, y = project_xy(p["x"], p["y"], country)
        return F.struct(x.alias("x"), y.alias("y"))

    return F.transform(geom, lambda part: F.transform(part, lambda ring: F.transform(ring, pt)))


def area_sqm(geom: Column, country: str) -> Column:
    """Ground area in square metres."""
    return area(project(geom, country))


# ------------------------------------------------------------------ pairs of outlines
@_once
@arrow_udf(T.DoubleType())
def intersection_area(left: pa.Array, right: pa.Array) -> pa.Array:
    """Area of the intersection; NULL when a side is NULL or empty."""
    _, _, both, valid = kernel.overlap_areas(left, right)
    return pa.array(both, mask=~valid)


@_once
@arrow_udf(T.DoubleType())
def iou(left: pa.Array, right: pa.Array) -> pa.Array:
    """Intersection over union; 0 for NULL or disjoint shapes."""
    area_l, area_r, both, _ = kernel.overlap_areas(left, right)
    union = area_l + area_r - both
    with np.errstate(divide="ignore", invalid="ignore"):
        ratio = np.where(union > 0, both / union, 0.0)
    return pa.array(ratio)


@_once
@arrow_udf(GEOM_TYPE)
def clip_to_box(geom: pa.Array, x1: pa.Array, y1: pa.Array, x2: pa.Array, y2: pa.Array) -> pa.Array:
    """The part of each geometry inside an axis-aligned box, as real separate parts."""
    bounds = np.column_stack([np.asarray(c, dtype=np.float64) for c in (x1, y1, x2, y2)])
    return kernel.clip_to_boxes(geom, bounds)


@_once
@arrow_udf(GEOM_TYPE)
def clip_to_geometry(geom: pa.Array, mask: pa.Array) -> pa.Array:
    """The part of each geometry inside another one.

    A concave mask is applied as disjoint convex pieces, so the result is exact as a point set
    and in area but may hold several parts that touch along a line.
    """
    ext, _, upright = kernel.extents(mask)
    trimmed = kernel.clip_to_boxes(geom, ext)
    # For other masks the extent's clip above only trimmed the outline; the real mask decides.
    odd = np.flatnonzero(~upright & np.asarray(trimmed.is_valid()))
    if not len(odd):
        return trimmed
    rows = []
    for parts, mask_parts in zip(kernel.rows_to_parts(trimmed.take(pa.array(odd))), kernel.rows_to_parts(mask.take(pa.array(odd)))):
        pieces = [piece for rings in mask_parts for piece in kernel.convex_pieces(rings)]
        rows.append([p for piece in pieces for p in kernel.clip_convex(parts, piece)])
    kept = np.flatnonzero(upright)
    return kernel.merge_rows(len(geom), [(kept, trimmed.take(pa.array(kept))), (odd, kernel.parts_to_rows(rows))])


@_once
@arrow_udf(T.IntegerType())
def outline_faults(geom: pa.Array, digits: pa.Array, most: pa.Array) -> pa.Array:
    """Place in ``outlines.REASONS`` of what is wrong with each outline, 0 for nothing and -1 for outlines of more
    than ``most`` points."""
    if not len(geom):
        return pa.array([], pa.int32())
    return kernel.outline_faults(geom, digits[0].as_py(), most[0].as_py())


@_once
@arrow_udf(GEOM_TYPE)
def union_parts(geom: pa.Array, digits: pa.Array) -> pa.Array:
    """Union of each row's parts, which may overlap, for rows of few points; NULL where nothing is covered."""
    return unions.dissolve_rows(geom, digits[0].as_py() if len(digits) else 0)
