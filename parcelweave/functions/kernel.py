"""Arrow-batched polygon kernels.

Geometry travels as ``array<array<array<struct<x,y>>>>`` (parts, rings, points; ring 0 of a
part is its outline, the others are holes).  Spark moves the rows; these helpers only turn one
Arrow batch into one Arrow column.

Area of an intersection needs no clipped polygon.  With every ring oriented, the indicator
function of a polygon is a signed sum of "below this edge" strips, so the product of two
indicators integrates to a signed sum of ``integral of min(edge_a, edge_b)`` over the common
x-range of each edge pair, which is closed-form.  Holes and several parts need no special case.
"""

from __future__ import annotations

import math
import struct

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

POINT = pa.struct([("x", pa.float64()), ("y", pa.float64())])
GEOM_ARROW = pa.list_(pa.list_(pa.list_(POINT)))
MAX_EDGE_PAIRS = 1 << 21
# An overlap below this share of the smaller polygon is rounding noise of touching outlines.
RELATIVE_NOISE = 1e-9


# ---------------------------------------------------------------- ragged batches
def _lengths(array: pa.Array) -> np.ndarray:
    return np.asarray(pc.fill_null(pc.list_value_length(array), 0), dtype=np.int64)


def _starts(lengths: np.ndarray) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(lengths)))


class Edges:
    """Oriented, non-vertical edges of a batch of geometries, grouped by row."""

    def __init__(self, geoms: pa.Array):
        n_rows = len(geoms)
        parts_per_row = _lengths(geoms)
        parts = geoms.flatten()
        rings_per_part = _lengths(parts)
        rings = parts.flatten()
        pts_per_ring = _lengths(rings)
        points = rings.flatten()
        x = np.asarray(points.field("x"), dtype=np.float64)
        y = np.asarray(points.field("y"), dtype=np.float64)

        row_of_part = np.repeat(np.arange(n_rows), parts_per_row)
        part_of_ring = np.repeat(np.arange(len(rings_per_part)), rings_per_part)
        row_of_ring = row_of_part[part_of_ring] if len(part_of_ring) else part_of_ring
        first_ring = _starts(rings_per_part)[:-1]
        is_outline = np.arange(len(part_of_ring)) == first_ring[part_of_ring] if len(part_of_ring) else np.zeros(0, bool)

        ring_start = _starts(pts_per_ring)
        ring_of_pt = np.repeat(np.arange(len(pts_per_ring)), pts_per_ring)
        nxt = np.arange(len(x)) + 1
        nonempty = pts_per_ring > 0
        nxt[ring_start[1:][nonempty] - 1] = ring_start[:-1][nonempty]

        # Shift each row to a local origin so that small shapes keep their precision.
        row_of_pt = row_of_ring[ring_of_pt] if len(ring_of_pt) else ring_of_pt
        pts_per_row = np.bincount(row_of_pt, minlength=n_rows) if len(row_of_pt) else np.zeros(n_rows, np.int64)
        self.n_rows = n_rows
        self.x0 = np.zeros(n_rows)
        self.y0 = np.zeros(n_rows)
        has = pts_per_row > 0
        row_start = _starts(pts_per_row)[:-1]
        self.x0[has] = x[row_start[has]]
        self.y0[has] = y[row_start[has]]
        self._raw = (x, y, nxt, ring_of_pt, row_of_pt, is_outline, len(pts_per_ring))
        self.has = has

    def shifted(self, x0: np.ndarray, y0: np.ndarray):
        """(row, xl, xr, yl, yr, sign) of the non-vertical edges, plus the area per row."""
        x, y, nxt, ring_of_pt, row_of_pt, is_outline, n_rings = self._raw
        xs = x - x0[row_of_pt]
        ys = y - y0[row_of_pt]
        xe, ye = xs[nxt], ys[nxt]
        twice = np.bincount(ring_of_pt, weights=xs * ye - xe * ys, minlength=n_rings)
        flip = np.where((twice > 0) == is_outline, 1.0, -1.0)
        signed = np.where(is_outline, 1.0, -1.0) * np.abs(twice) / 2
        row_of_ring_first = np.zeros(n_rings, np.int64)
        row_of_ring_first[ring_of_pt] = row_of_pt
        area = np.bincount(row_of_ring_first, weights=signed, minlength=self.n_rows) if n_rings else np.zeros(self.n_rows)
        keep = xs != xe
        sign = -np.sign(xe - xs) * flip[ring_of_pt]
        fwd = xe > xs
        xl, xr = np.where(fwd, xs, xe), np.where(fwd, xe, xs)
        yl, yr = np.where(fwd, ys, ye), np.where(fwd, ye, ys)
        return (row_of_pt[keep], xl[keep], xr[keep], yl[keep], yr[keep], sign[keep]), area


def _row_extent(row, low, high, n):
    lo = np.full(n, np.inf)
    hi = np.full(n, -np.inf)
    np.minimum.at(lo, row, low)
    np.maximum.at(hi, row, high)
    return lo, hi


def _inside_extent(edges, lo, hi):
    row, xl, xr, yl, yr, s = edges
    m = (xr > lo[row]) & (xl < hi[row])
    return row[m], xl[m], xr[m], yl[m], yr[m], s[m]


def _min_integral(xl, xr, a, b, ia, ib):
    """Integral of min(edge a, edge b) over [xl, xr]."""
    _, axl, axr, ayl, ayr, _ = a
    _, bxl, bxr, byl, byr, _ = b
    ka = (ayr[ia] - ayl[ia]) / (axr[ia] - axl[ia])
    kb = (byr[ib] - byl[ib]) / (bxr[ib] - bxl[ib])
    al = ayl[ia] + ka * (xl - axl[ia])
    ar = ayl[ia] + ka * (xr - axl[ia])
    bl = byl[ib] + kb * (xl - bxl[ib])
    br = byl[ib] + kb * (xr - bxl[ib])
    w = xr - xl
    dl, dr = al - bl, ar - br
    lo_l, lo_r = np.minimum(al, bl), np.minimum(ar, br)
    plain = (lo_l + lo_r) * w / 2
    crossing = dl * dr < 0
    gap = np.where(crossing, dl - dr, 1.0)
    t = np.where(crossing, dl / gap, 0.0)
    mid = al + t * (ar - al)
    split = w * (t * (lo_l + mid) + (1 - t) * (mid + lo_r)) / 2
    return np.where(crossing, split, plain)


def overlap_areas(left: pa.Array, right: pa.Array):
    """Areas of ``left``, ``right`` and their intersection, row by row."""
    ea, eb = Edges(left), Edges(right)
    n = ea.n_rows
    x0, y0 = np.where(ea.has, ea.x0, eb.x0), np.where(ea.has, ea.y0, eb.y0)
    a, area_a = ea.shifted(x0, y0)
    b, area_b = eb.shifted(x0, y0)
    a_lo, a_hi = _row_extent(a[0], a[1], a[2], n)
    b_lo, b_hi = _row_extent(b[0], b[1], b[2], n)
    a = _inside_extent(a, b_lo, b_hi)
    b = _inside_extent(b, a_lo, a_hi)
    na = np.bincount(a[0], minlength=n)
    nb = np.bincount(b[0], minlength=n)
    a_start, b_start = _starts(na), _starts(nb)
    # One work unit per edge of the left side: it meets every edge of its row's right side.
    partners = nb[a[0]]
    todo = _starts(partners)
    out = np.zeros(n)
    lo = 0
    while lo < len(partners):
        hi = int(np.searchsorted(todo, todo[lo] + MAX_EDGE_PAIRS, side="right")) - 1
        hi = max(hi, lo + 1)
        ia = np.repeat(np.arange(lo, hi), partners[lo:hi])
        k = np.arange(len(ia)) - np.repeat(todo[lo:hi] - todo[lo], partners[lo:hi])
        ib = b_start[a[0][ia]] + k
        xl = np.maximum(a[1][ia], b[1][ib])
        xr = np.minimum(a[2][ia], b[2][ib])
        m = xr > xl
        ia, ib, xl, xr = ia[m], ib[m], xl[m], xr[m]
        term = _min_integral(xl, xr, a, b, ia, ib) * a[5][ia] * b[5][ib]
        out += np.bincount(a[0][ia], weights=term, minlength=n)
        lo = hi
    noise = RELATIVE_NOISE * np.minimum(area_a, area_b)
    out = np.where(out > noise, out, 0.0)
    out = np.minimum(out, np.minimum(area_a, area_b))
    return area_a, area_b, out, ea.has & eb.has


# ---------------------------------------------------------------- clipped outlines
def _ring_area(ring: np.ndarray) -> float:
    d = ring - ring[0]
    x, y = d[:, 0], d[:, 1]
    return float(np.dot(x, np.roll(y, -1)) - np.dot(np.roll(x, -1), y)) / 2


def _open(ring: np.ndarray) -> np.ndarray:
    return ring[:-1] if len(ring) > 1 and (ring[0] == ring[-1]).all() else ring


def orient(rings: list[np.ndarray]) -> list[np.ndarray]:
    """Outline counter-clockwise, holes clockwise, closing points dropped."""
    out = []
    for i, ring in enumerate(rings):
        ring = _open(ring)
        if len(ring) < 3:
            continue
        area = _ring_area(ring)
        if area == 0:
            continue
        out.append(ring if (area > 0) == (i == 0) else ring[::-1])
    return out


def _point_in_ring(px: float, py: float, ring: np.ndarray) -> bool:
    x, y = ring[:, 0], ring[:, 1]
    x2, y2 = np.roll(x, -1), np.roll(y, -1)
    spans = (y > py) != (y2 > py)
    with np.errstate(divide="ignore", invalid="ignore"):
        cross = x + (py - y) * (x2 - x) / (y2 - y)
    return bool(np.count_nonzero(spans & (px < cross)) % 2)


def clip_half_plane(rings: list[np.ndarray], a: float, b: float, c: float) -> list[np.ndarray]:
    """Keep the part of oriented rings where ``a*x + b*y <= c``.

    A ring that leaves the half-plane is cut into chains; along the cut line the chain ends,
    sorted by position, pair up as the segments interior to the polygon.  Following chains and
    segments alternately gives every resulting ring, so a concave shape falls into real parts.
    """
    whole, chains = [], []
    for ring in rings:
        d = ring[:, 0] * a + ring[:, 1] * b - c
        inside = d <= 0
        if inside.all():
            if (d < 0).any():
                whole.append(ring)
            continue
        if not (d < 0).any():
            continue
        # Edge i runs from point i to point i + 1; crossings alternate between entry and exit.
        n = len(ring)
        crossing = np.flatnonzero(inside != np.roll(inside, -1))
        nxt = (crossing + 1) % n
        t = d[crossing] / (d[crossing] - d[nxt])
        cuts = ring[crossing] + t[:, None] * (ring[nxt] - ring[crossing])
        if inside[crossing[0]]:  # start with an entry
            crossing, cuts = np.roll(crossing, -1), np.roll(cuts, -1, axis=0)
        twice = np.vstack([ring, ring])
        for k in range(0, len(crossing), 2):
            first, last = crossing[k] + 1, crossing[k + 1]
            if last < first:
                last += n
            chains.append(np.vstack([cuts[k], twice[first : last + 1], cuts[k + 1]]))
    if not chains:
        return whole
    along = np.array([-b, a])
    ends = sorted(
        [(float(ch[0] @ along), 0, k) for k, ch in enumerate(chains)]
        + [(float(ch[-1] @ along), 1, k) for k, ch in enumerate(chains)]
    )
    mate = {}
    for (_, kind_a, ka), (_, kind_b, kb) in zip(ends[0::2], ends[1::2]):
        mate[(kind_a, ka)] = (kind_b, kb)
        mate[(kind_b, kb)] = (kind_a, ka)
    used, out = set(), list(whole)
    for k in range(len(chains)):
        if k in used:
            continue
        loop, cur = [], k
        while cur not in used:
            used.add(cur)
            loop.append(chains[cur])
            kind, nxt = mate[(1, cur)]
            if kind != 0:  # ends that coincide in a vertex: close on the chain itself
                break
            cur = nxt
        ring = np.vstack(loop)
        keep = np.any(ring != np.roll(ring, 1, axis=0), axis=1)
        ring = ring[keep]
        if len(ring) >= 3 and _ring_area(ring) != 0:
            out.append(ring)
    return out


def assemble_parts(rings: list[np.ndarray]) -> list[list[np.ndarray]]:
    """Group oriented rings into parts: each hole joins the smallest outline around it."""
    outlines = [[r] for r in rings if _ring_area(r) > 0]
    for hole in (r for r in rings if _ring_area(r) < 0):
        mid = (hole[0] + hole[1]) / 2
        around = [p for p in outlines if _point_in_ring(mid[0], mid[1], p[0])]
        if around:
            min(around, key=lambda p: _ring_area(p[0])).append(hole)
    return outlines


def clip_convex(parts: list[list[np.ndarray]], convex: np.ndarray) -> list[list[np.ndarray]]:
    """Clip a multi-part shape to one convex counter-clockwise ring."""
    out = []
    # A side of rounding-noise length has no direction: merge its ends.
    gap = np.abs(convex - np.roll(convex, 1, axis=0)).max(axis=1)
    convex = convex[gap > 1e-12 * np.ptp(convex, axis=0).max()]
    for rings in parts:
        rings = orient(rings)
        for i in range(len(convex)):
            if not rings:
                break
            (x1, y1), (x2, y2) = convex[i], convex[(i + 1) % len(convex)]
            a, b = y2 - y1, x1 - x2
            rings = clip_half_plane(rings, a, b, a * x1 + b * y1)
        out.extend(assemble_parts(rings))
    return out


def clip_box(parts, x1, y1, x2, y2):
    """Clip a multi-part shape to an axis-aligned box."""
    out = []
    for rings in parts:
        rings = orient(rings)
        for a, b, c in ((-1.0, 0.0, -x1), (1.0, 0.0, x2), (0.0, -1.0, -y1), (0.0, 1.0, y2)):
            if rings:
                rings = clip_half_plane(rings, a, b, c)
        out.extend(assemble_parts(rings))
    return out


def extents(geoms: pa.Array):
    """Per row (minx, miny, maxx, maxy), whether it has points, and whether it is one upright box."""
    n = len(geoms)
    parts_per_row = _lengths(geoms)
    parts = geoms.flatten()
    rings_per_part = _lengths(parts)
    rings = parts.flatten()
    per_ring = _lengths(rings)
    pts = rings.flatten()
    x, y = (np.asarray(pts.field(k), dtype=np.float64) for k in ("x", "y"))
    row_of_part = np.repeat(np.arange(n), parts_per_row)
    row_of_ring = np.repeat(row_of_part, rings_per_part)
    row = np.repeat(row_of_ring, per_ring)
    n_pts = np.bincount(row, minlength=n) if len(row) else np.zeros(n, np.int64)
    filled, first = n_pts > 0, _starts(n_pts)[:-1]
    lo_x, lo_y, hi_x, hi_y = (np.full(n, v) for v in (np.inf, np.inf, -np.inf, -np.inf))
    if len(row):  # the points of a row lie side by side
        for out, take, of in ((lo_x, np.minimum, x), (lo_y, np.minimum, y), (hi_x, np.maximum, x), (hi_y, np.maximum, y)):
            out[filled] = take.reduceat(of, first[filled])
    on_corner = ((x == lo_x[row]) | (x == hi_x[row])) & ((y == lo_y[row]) | (y == hi_y[row]))
    corners = np.bincount(row, weights=on_corner, minlength=n) if len(row) else np.zeros(n)
    turns = np.zeros(n)
    if len(row) > 1:
        same = row[1:] == row[:-1]
        straight = (x[1:] == x[:-1]) != (y[1:] == y[:-1])
        turns = np.bincount(row[1:], weights=same & straight, minlength=n)
    rings_per_row = np.bincount(row_of_ring, minlength=n) if len(row_of_ring) else np.zeros(n, np.int64)
    upright = (rings_per_row == 1) & (n_pts == 5) & (corners == 5) & (turns == 4)
    return np.column_stack([lo_x, lo_y, hi_x, hi_y]), filled, upright


def box_ring(x1, y1, x2, y2) -> np.ndarray:
    return np.array([[x1, y1], [x2, y1], [x2, y2], [x1, y2], [x1, y1]], dtype=np.float64)


def _against_boxes(geoms: pa.Array, boxes: np.ndarray):
    """(lo, hi, meets, inside, upright): the common extent of each row and its box, and how they lie."""
    ext, filled, upright = extents(geoms)
    lo, hi = np.maximum(ext[:, :2], boxes[:, :2]), np.minimum(ext[:, 2:], boxes[:, 2:])
    meets = filled & (lo < hi).all(axis=1)
    inside = meets & (ext[:, :2] >= boxes[:, :2]).all(axis=1) & (ext[:, 2:] <= boxes[:, 2:]).all(axis=1)
    return lo, hi, meets, inside, upright


def clip_to_boxes(geoms: pa.Array, boxes: np.ndarray) -> pa.Array:
    """:func:`clip_rows_to_boxes` as an Arrow column.  Rows that stay and upright boxes are handled as whole
    arrays; only the rest is taken apart row by row."""
    lo, hi, meets, inside, upright = _against_boxes(geoms, boxes)
    stay, cut = inside & closed_rows(geoms), meets & ~inside & upright
    rest = np.flatnonzero(meets & ~stay & ~cut)
    boxed = box_rows(lo[cut, 0], lo[cut, 1], hi[cut, 0], hi[cut, 1])
    slow = parts_to_rows(clip_rows_to_boxes(geoms.take(pa.array(rest)), boxes[rest]) if len(rest) else [])
    return merge_rows(len(geoms), [(np.flatnonzero(stay), plain_rows(geoms.take(pa.array(np.flatnonzero(stay))))), (np.flatnonzero(cut), boxed), (rest, slow)])


def clip_rows_to_boxes(geoms: pa.Array, boxes: np.ndarray) -> list:
    """Clip each row to its box: rows inside stay, rows outside vanish, upright boxes are cut by
    arithmetic, and only the rest is cut edge by edge."""
    lo, hi, meets, inside, upright = _against_boxes(geoms, boxes)
    rows = rows_to_parts(geoms)
    out = []
    for i, parts in enumerate(rows):
        if not meets[i]:
            out.append(None)
        elif inside[i]:
            out.append(parts)
        elif upright[i]:
            out.append([[box_ring(lo[i, 0], lo[i, 1], hi[i, 0], hi[i, 1])]])
        else:
            out.append(clip_box(parts, *boxes[i]))
    return out


def convex_pieces(rings: list[np.ndarray]) -> list[np.ndarray]:
    """Cut one part into convex pieces: the part itself if convex, else trapezoids between
    consecutive vertex abscissae."""
    rings = orient(rings)
    if not rings:
        return []
    if len(rings) == 1:
        e = np.roll(rings[0], -1, axis=0) - rings[0]
        f = np.roll(e, -1, axis=0)
        if (e[:, 0] * f[:, 1] - e[:, 1] * f[:, 0] >= 0).all():
            return [rings[0]]
    return trapezoids([rings])


def trapezoids(parts: list[list[np.ndarray]]) -> list[np.ndarray]:
    """Disjoint trapezoids covering the union of oriented parts (non-zero winding)."""
    seg = np.vstack(
        [np.hstack([r, np.roll(r, -1, axis=0)]) for rings in parts for r in rings] or [np.zeros((0, 4))]
    )
    seg = seg[seg[:, 0] != seg[:, 2]]
    if not len(seg):
        return []
    fwd = seg[:, 2] > seg[:, 0]
    sign = np.where(fwd, -1, 1)
    lo = np.where(fwd[:, None], seg, seg[:, [2, 3, 0, 1]])
    xl, yl, xr, yr = lo.T
    slope = (yr - yl) / (xr - xl)
    cuts = [np.concatenate([xl, xr])]
    # abscissae where two edges cross
    for i in range(len(xl)):
        j = np.arange(i + 1, len(xl))
        j = j[(xr[j] > xl[i]) & (xl[j] < xr[i]) & (slope[j] != slope[i])]
        if len(j):
            x = ((yl[j] - slope[j] * xl[j]) - (yl[i] - slope[i] * xl[i])) / (slope[i] - slope[j])
            ok = (x > np.maximum(xl[i], xl[j])) & (x < np.minimum(xr[i], xr[j]))
            cuts.append(x[ok])
    xs = np.unique(np.concatenate(cuts))
    out = []
    for x1, x2 in zip(xs[:-1], xs[1:]):
        m = np.flatnonzero((xl <= x1) & (xr >= x2))
        if not len(m):
            continue
        y1 = yl[m] + slope[m] * (x1 - xl[m])
        y2 = yl[m] + slope[m] * (x2 - xl[m])
        order = np.argsort(y1 + y2, kind="stable")
        depth, base = 0, None
        for k in order:
            # edges run right-to-left on top (+1) and left-to-right underneath (-1)
            before = depth
            depth -= int(sign[m[k]])
            if before == 0 and depth != 0:
                base = k
            elif before != 0 and depth == 0 and (y1[k] > y1[base] or y2[k] > y2[base]):
                quad = np.array([[x1, y1[base]], [x2, y2[base]], [x2, y2[k]], [x1, y1[k]]])
                keep = np.any(quad != np.roll(quad, 1, axis=0), axis=1)
                out.append(quad[keep])
    return out


def union_area(parts: list[list[np.ndarray]]) -> float:
    """Area covered by any of the parts, overlaps counted once."""
    return float(sum(abs(_ring_area(t)) for t in trapezoids([orient(r) for r in parts])))


# ---------------------------------------------------------------- Arrow <-> numpy
def rows_to_parts(geoms: pa.Array) -> list:
    """Arrow geometry column -> per row a list of parts, each a list of (n, 2) rings."""
    parts_per_row = _lengths(geoms)
    parts = geoms.flatten()
    rings_per_part = _lengths(parts)
    rings = parts.flatten()
    pts = rings.flatten()
    xy = np.column_stack(
        [np.asarray(pts.field("x"), dtype=np.float64), np.asarray(pts.field("y"), dtype=np.float64)]
    )
    ring_arrays = np.split(xy, np.cumsum(_lengths(rings))[:-1]) if len(rings) else []
    ring_at, part_at = _starts(rings_per_part), _starts(parts_per_row)
    part_lists = [ring_arrays[ring_at[i] : ring_at[i + 1]] for i in range(len(rings_per_part))]
    return [part_lists[part_at[i] : part_at[i + 1]] for i in range(len(parts_per_row))]


def parts_to_rows(rows: list) -> pa.Array:
    """Inverse of :func:`rows_to_parts`; rings are closed, ``None`` or no parts gives NULL."""
    row_off, part_off, ring_off, chunks = [0], [0], [0], []
    valid = []
    for parts in rows:
        parts = parts or []
        for rings in parts:
            for ring in rings:
                shut = len(ring) and ring[0, 0] == ring[-1, 0] and ring[0, 1] == ring[-1, 1]
                closed = ring if shut else np.vstack([ring, ring[:1]])
                chunks.append(closed)
                ring_off.append(ring_off[-1] + len(closed))
            part_off.append(len(ring_off) - 1)
        row_off.append(len(part_off) - 1)
        valid.append(bool(parts))
    xy = np.vstack(chunks) if chunks else np.zeros((0, 2))
    pts = pa.StructArray.from_arrays([pa.array(xy[:, 0]), pa.array(xy[:, 1])], fields=list(POINT))
    rings = pa.ListArray.from_arrays(pa.array(ring_off, pa.int32()), pts)
    parts = pa.ListArray.from_arrays(pa.array(part_off, pa.int32()), rings)
    mask = pa.array([not v for v in valid], pa.bool_())
    return pa.ListArray.from_arrays(pa.array(row_off, pa.int32()), parts, mask=mask)


def _nested(parts_per_row, rings_per_part, pts_per_ring, x: np.ndarray, y: np.ndarray) -> pa.Array:
    """Geometry column from its lengths and flat coordinates; no row is NULL."""
    out = pa.StructArray.from_arrays([pa.array(x), pa.array(y)], fields=list(POINT))
    for lengths in (pts_per_ring, rings_per_part, parts_per_row):
        out = pa.ListArray.from_arrays(pa.array(_starts(lengths), pa.int32()), out)
    return out


def plain_rows(geoms: pa.Array) -> pa.Array:
    """The column with the field names of ``GEOM_ARROW``; rows are not NULL."""
    parts = geoms.flatten()
    rings = parts.flatten()
    pts = rings.flatten()
    x, y = (np.asarray(pts.field(k), dtype=np.float64) for k in ("x", "y"))
    return _nested(_lengths(geoms), _lengths(parts), _lengths(rings), x, y)


def closed_rows(geoms: pa.Array) -> np.ndarray:
    """Per row whether all its rings end where they begin."""
    parts = geoms.flatten()
    rings = parts.flatten()
    per_row, per_part, per_ring = _lengths(geoms), _lengths(parts), _lengths(rings)
    pts = rings.flatten()
    x, y = (np.asarray(pts.field(k), dtype=np.float64) for k in ("x", "y"))
    some, at = per_ring > 0, _starts(per_ring)
    first, last = at[:-1][some], at[1:][some] - 1
    row = np.repeat(np.repeat(np.arange(len(geoms)), per_row), per_part)[some]
    out = np.ones(len(geoms), bool)
    out[row[(x[first] != x[last]) | (y[first] != y[last])]] = False
    return out


def box_rows(x1: np.ndarray, y1: np.ndarray, x2: np.ndarray, y2: np.ndarray) -> pa.Array:
    """One upright box per row, points as in :func:`box_ring`."""
    one = np.ones(len(x1), np.int64)
    x, y = np.column_stack([x1, x2, x2, x1, x1]), np.column_stack([y1, y1, y2, y2, y1])
    return _nested(one, one, 5 * one, x.ravel(), y.ravel())


def merge_rows(n: int, pieces: list[tuple[np.ndarray, pa.Array]]) -> pa.Array:
    """``n`` rows, of which each piece gives those at its places; the others are NULL."""
    source, start = np.full(n, -1), 0
    for places, rows in pieces:
        source[places] = start + np.arange(len(places))
        start += len(places)
    every = pa.concat_arrays([rows for _, rows in pieces])
    return every.take(pa.array(source, mask=source < 0))


def _crosses(p, q, r, s) -> np.ndarray:
    """Do open segments p-q and r-s cross properly?  Inputs broadcast."""

    def side(o, d, v):
        return d[..., 0] * (v[..., 1] - o[..., 1]) - d[..., 1] * (v[..., 0] - o[..., 0])

    e, f = q - p, s - r
    return (side(p, e, r) * side(p, e, s) < 0) & (side(r, f, p) * side(r, f, q) < 0)


def simple_rings(parts: list[list[np.ndarray]]) -> bool:
    """True if every ring has at least three points and no ring crosses itself."""
    for rings in parts:
        for ring in rings:
            p = _open(ring)
            n = len(p)
            if n < 3:
                return False
            q = np.roll(p, -1, axis=0)
            block = max(1, (1 << 18) // n)
            for i in range(0, n, block):
                a, b = p[i : i + block, None], q[i : i + block, None]
                if _crosses(a, b, p[None], q[None]).any():
                    return False
    return True


# ---------------------------------------------------------------- validity
def _rounded_edges(geoms: pa.Array, digits: int) -> dict[str, np.ndarray]:
    """Directed edges of all rings of a batch, as ``outlines.ring_edges`` makes them: closed, rounded, without
    repeated points, the inside on the left.  ``row, part, ring, pos, n, ax, ay, bx, by``, in order of rows."""
    per_row, parts = _lengths(geoms), geoms.flatten()
    per_part, rings = _lengths(parts), parts.flatten()
    per_ring, points = _lengths(rings), rings.flatten()
    x, y = (np.asarray(points.field(k), dtype=np.float64) for k in ("x", "y"))
    row_of_part = np.repeat(np.arange(len(per_row)), per_row)
    part_of_ring = np.repeat(np.arange(len(per_part)), per_part)
    start = _starts(per_ring)[:-1]
    filled = per_ring > 0
    first, last = start[filled], start[filled] + per_ring[filled] - 1
    opened = np.zeros(len(per_ring), bool)
    opened[filled] = (x[first] != x[last]) | (y[first] != y[last])
    count = per_ring + opened
    ring = np.repeat(np.arange(len(count)), count)
    k = np.arange(len(ring)) - _starts(count)[ring]
    at = start[ring] + np.where(k < per_ring[ring], k, 0)
    scale = 10.0**digits
    x, y = np.rint(x[at] * scale) / scale, np.rint(y[at] * scale) / scale
    if len(x):
        keep = np.concatenate(([True], (ring[1:] != ring[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1])))
        x, y, ring = x[keep], y[keep], ring[keep]
    count = np.bincount(ring, minlength=len(count))
    begin = _starts(count)[:-1]
    i = np.flatnonzero(ring[1:] == ring[:-1]) if len(ring) else np.zeros(0, np.int64)
    ring_of, x0, y0 = ring[i], x[begin[ring[i]]], y[begin[ring[i]]]
    twice = np.bincount(ring_of, weights=(x[i] - x0) * (y[i + 1] - y0) - (x[i + 1] - x0) * (y[i] - y0), minlength=len(count))
    inner = np.arange(len(count)) - _starts(per_part)[part_of_ring]
    as_is = ((twice > 0) == (inner == 0))[ring_of]
    a, b = np.where(as_is, i, i + 1), np.where(as_is, i + 1, i)
    part = part_of_ring[ring_of]
    row = row_of_part[part]
    return {
        "row": row, "part": part - _starts(per_row)[row], "ring": inner[ring_of], "pos": i - begin[ring_of],
        "n": count[ring_of] - 1, "ax": x[a], "ay": y[a], "bx": x[b], "by": y[b],
    }


def _pairs_of_rows(row: np.ndarray, n_rows: int):
    """Blocks of index pairs (i, j), i < j, of equal rows; a block has about ``MAX_EDGE_PAIRS``."""
    end = _starts(np.bincount(row, minlength=n_rows))[1:]
    partners = end[row] - np.arange(len(row)) - 1
    todo, lo = _starts(partners), 0
    while lo < len(row):
        hi = max(int(np.searchsorted(todo, todo[lo] + MAX_EDGE_PAIRS, side="right")) - 1, lo + 1)
        i = np.repeat(np.arange(lo, hi), partners[lo:hi])
        yield i, i + 1 + np.arange(len(i)) - np.repeat(todo[lo:hi] - todo[lo], partners[lo:hi])
        lo = hi


def _near_pairs(e: dict[str, np.ndarray], n_rows: int, tol: float):
    """Blocks of pairs of edges of one row whose boxes meet."""
    for i, j in _pairs_of_rows(e["row"], n_rows):
        near = np.ones(len(i), bool)
        for a, b in (("ax", "bx"), ("ay", "by")):
            low, high = np.minimum(e[a], e[b]), np.maximum(e[a], e[b])
            near &= (high[i] + tol >= low[j]) & (high[j] + tol >= low[i])
        yield i[near], j[near]


def _side(s: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray) -> np.ndarray:
    return (s["bx"] - s["ax"]) * (y - s["ay"]) - (s["by"] - s["ay"]) * (x - s["ax"])


def _on(s: dict[str, np.ndarray], x: np.ndarray, y: np.ndarray, tol: float):
    """Whether points lie inside edges, and whether inside or at their ends."""
    dx, dy = s["bx"] - s["ax"], s["by"] - s["ay"]
    along = (x - s["ax"]) * dx + (y - s["ay"]) * dy
    end = ((x == s["ax"]) & (y == s["ay"])) | ((x == s["bx"]) & (y == s["by"]))
    inside = (along > 0) & (along < dx * dx + dy * dy) & ~end & (np.abs(_side(s, x, y)) <= tol * np.hypot(dx, dy))
    return inside, inside | end


def _cross(l: dict[str, np.ndarray], r: dict[str, np.ndarray]) -> np.ndarray:  # noqa: E741
    one = np.sign(_side(l, r["ax"], r["ay"])) * np.sign(_side(l, r["bx"], r["by"])) < 0
    return one & (np.sign(_side(r, l["ax"], l["ay"])) * np.sign(_side(r, l["bx"], l["by"])) < 0)


def _pieces(e: dict[str, np.ndarray], asked: np.ndarray, of: np.ndarray, x: np.ndarray, y: np.ndarray):
    """Edges ``asked`` cut at points (x, y) of edges ``of``: the edge of each piece, its ends in order and the sign
    that tells whether the edge runs that way."""
    along = (x - e["ax"][of]) * (e["bx"] - e["ax"])[of] + (y - e["ay"][of]) * (e["by"] - e["ay"])[of]
    edge = np.concatenate([asked, of, asked])
    t = np.concatenate([np.full(len(asked), -np.inf), along, np.full(len(asked), np.inf)])
    x, y = np.concatenate([e["ax"][asked], x, e["bx"][asked]]), np.concatenate([e["ay"][asked], y, e["by"][asked]])
    order = np.lexsort((t, edge))
    edge, x, y = edge[order], x[order], y[order]
    k = np.flatnonzero((edge[1:] == edge[:-1]) & ((x[1:] != x[:-1]) | (y[1:] != y[:-1])))
    edge, px, py, qx, qy = edge[k], x[k], y[k], x[k + 1], y[k + 1]
    right = (px < qx) | ((px == qx) & (py < qy))
    lx, ly, hx, hy = (np.where(right, u, v) for u, v in ((px, qx), (py, qy), (qx, px), (qy, py)))
    return edge, lx, ly, hx, hy, np.where(right, 1, -1)


def ring_faults(geoms: pa.Array, digits: int) -> np.ndarray:
    """Per row the place in ``outlines.REASONS`` (from 1) of the first rule that its rings break, 0 if none.

    The rules are those of ``outlines.invalid_reasons`` but for rings without area; every edge meets every
    other one of its row, so this is for outlines of few edges.
    """
    none = 99
    tol = 0.5 * 10.0**-digits
    e = _rounded_edges(geoms, digits)
    fault = np.full(len(geoms), none)
    cuts, touches = [], []
    for i, j in _near_pairs(e, len(geoms), tol):
        l, r = ({c: v[at] for c, v in e.items()} for at in (i, j))
        crosses = _cross(l, r)
        found, n = [], np.zeros(len(i), np.int64)
        for s, o, of in ((l, r, i), (r, l, j)):
            for p in "ab":
                x, y = o[f"{p}x"], o[f"{p}y"]
                inside, met = _on(s, x, y, tol)
                again = np.zeros(len(i), bool)
                for m, u, v in found:
                    again |= m & (u == x) & (v == y)
                n += met & ~again
                found.append((met, x, y))
                cuts.append((of[inside], x[inside], y[inside]))
        one_part = l["part"] == r["part"]
        one_ring = one_part & (l["ring"] == r["ring"])
        steps = np.abs(l["pos"] - r["pos"])
        neighbours = one_ring & ((steps == 1) | (steps == l["n"] - 1))
        told = np.where(
            one_ring, np.where(crosses | (n > 1) | ((n > 0) & ~neighbours), 2, none),
            np.where(crosses, 3, np.where(n > 1, 4, none)),
        )
        np.minimum.at(fault, l["row"], told)
        for met, x, y in found:
            m = met & one_part & ~one_ring
            a, b = np.minimum(l["ring"], r["ring"]), np.maximum(l["ring"], r["ring"])
            touches.append(np.column_stack([l["row"][m], l["part"][m], a[m], b[m], x[m], y[m]]))
    if touches:
        # Two rings of a part that touch twice cut its inside in two.
        at = np.unique(np.vstack(touches), axis=0)
        twice = at[1:][(at[1:, :4] == at[:-1, :4]).all(axis=1)]
        np.minimum.at(fault, twice[:, 0].astype(np.int64), 5)
    _misplaced(e, cuts, fault, none)
    return np.where(fault == none, 0, fault)


def _misplaced(e: dict[str, np.ndarray], cuts: list, fault: np.ndarray, none: int) -> None:
    """Lower ``fault`` where a piece of a ring lies where it may not: see ``outlines._misplaced_rings``."""
    n_rows = len(fault)
    several = np.zeros(n_rows, bool)
    several[e["row"][(e["part"] > 0) | (e["ring"] > 0)]] = True
    asked = np.flatnonzero((several & (fault == none))[e["row"]])
    if not len(asked):
        return
    of, x, y = (np.concatenate(c) for c in zip(*cuts))
    m = (several & (fault == none))[e["row"][of]]
    of, x, y = of[m], x[m], y[m]
    edge, lx, ly, hx, hy, sign = _pieces(e, asked, of, x, y)
    mx, my = (lx + hx) / 2, (ly + hy) / 2
    row, part, ring = e["row"][edge], e["part"][edge], e["ring"][edge]
    own, others = np.zeros(len(row)), np.zeros(len(row))
    for i, j in _pairs_of_rows(row, n_rows):
        for p, s in ((i, j), (j, i)):
            m = ((part[p] != part[s]) | (ring[p] != ring[s])) & (lx[s] <= mx[p]) & (mx[p] < hx[s])
            p, s = p[m], s[m]
            m = ly[s] + (mx[p] - lx[s]) * (hy[s] - ly[s]) / (hx[s] - lx[s]) < my[p]
            p, s = p[m], s[m]
            same = part[p] == part[s]
            own += np.bincount(p, weights=np.where(same, sign[s], 0), minlength=len(row))
            others += np.bincount(p, weights=np.where(same, 0, sign[s]), minlength=len(row))
    told = np.where(others != 0, 7, np.where(own != (ring > 0), 6, none))
    np.minimum.at(fault, row, told)


# ---------------------------------------------------------------- areas
def _signed_areas(rings: pa.Array) -> np.ndarray:
    """Area of each ring, positive where it turns left, added up in the order of the points."""
    per_ring, pts = _lengths(rings), rings.flatten()
    x, y = (np.asarray(pts.field(k), dtype=np.float64) for k in ("x", "y"))
    ring = np.repeat(np.arange(len(per_ring)), per_ring)
    first = _starts(per_ring)[:-1][ring]
    x, y = x - x[first], y - y[first]
    here = np.flatnonzero(ring[1:] == ring[:-1])
    terms = np.column_stack([x[here] * y[here + 1], -(x[here + 1] * y[here])])
    return np.bincount(np.repeat(ring[here], 2), weights=terms.ravel(), minlength=len(per_ring)) / 2


def hollow_rows(geoms: pa.Array) -> np.ndarray:
    """Rows of which a part has no ring, a ring no area or less than three points, or anything is missing."""
    parts = geoms.flatten()
    rings = parts.flatten()
    points = rings.flatten()
    per_part, per_ring = _lengths(parts), _lengths(rings)
    row_of_part = np.repeat(np.arange(len(geoms)), _lengths(geoms))
    row_of_ring = np.repeat(row_of_part, per_part)
    gone = np.zeros(len(points), bool)
    for column in (points, points.field("x"), points.field("y")):
        if column.null_count:
            gone |= ~np.asarray(column.is_valid())
    area = _signed_areas(rings)
    out = np.zeros(len(geoms), bool)
    out[row_of_part[per_part == 0]] = True
    out[row_of_ring[(per_ring < 3) | (area == 0) | np.isnan(area)]] = True
    out[np.repeat(row_of_ring, per_ring)[gone]] = True
    return out


def outline_faults(geoms: pa.Array, digits: int, most: int) -> pa.Array:
    """:func:`ring_faults` with 1 for rings without area; -1 for outlines of more than ``most`` points, which are not
    judged, and NULL for NULL."""
    parts = geoms.flatten()
    rings = parts.flatten()
    row_of_ring = np.repeat(np.repeat(np.arange(len(geoms)), _lengths(geoms)), _lengths(parts))
    n_points = np.bincount(row_of_ring, weights=_lengths(rings), minlength=len(geoms))
    small = np.flatnonzero(n_points <= most)
    out = np.full(len(geoms), -1)
    few = geoms if len(small) == len(geoms) else geoms.take(pa.array(small))
    out[small] = np.where(hollow_rows(few), 1, ring_faults(few, digits))
    return pa.array(out, pa.int32(), mask=~np.asarray(geoms.is_valid()))


def planar_areas(geoms: pa.Array) -> pa.Array:
    """Outlines minus holes, row by row, added up in the order of the points; NULL for NULL.  Rings are taken as
    they are: one that does not end where it begins lacks its last edge."""
    parts = geoms.flatten()
    rings = parts.flatten()
    per_part, per_ring = _lengths(parts), _lengths(rings)
    size = np.abs(_signed_areas(rings))
    outline = np.zeros(len(per_ring), bool)
    some = per_part > 0
    outline[_starts(per_part)[:-1][some]] = True
    part = np.repeat(np.arange(len(per_part)), per_part)
    holes = np.bincount(part, weights=np.where(outline, 0.0, size), minlength=len(per_part))
    whole = np.bincount(part, weights=np.where(outline, size, 0.0), minlength=len(per_part)) - holes
    row = np.repeat(np.arange(len(geoms)), _lengths(geoms))
    out = np.bincount(row, weights=whole, minlength=len(geoms)) if len(row) else np.zeros(len(geoms))
    # A part without rings has no area at all.
    hollow = np.zeros(len(geoms), bool)
    hollow[row[~some]] = True
    return pa.array(out, pa.float64(), mask=~np.asarray(geoms.is_valid()) | hollow)


# ---------------------------------------------------------------- WKT
_NUMBER = r"-?(?:0|[1-9][0-9]{0,15})(?:\.[0-9]{1,17})?(?:[eE]-?[0-9]{1,2})?"
_PLAIN_WKT = rf"^ *(?i:POLYGON) *\( *\( *{_NUMBER} +{_NUMBER}(?: *, *{_NUMBER} +{_NUMBER})* *\) *\) *$"
_IN_NUMBERS = np.array([chr(c) in "0123456789.-eE" for c in range(256)])


def _numbers(raw: bytes) -> np.ndarray:
    """The numbers of checked texts."""
    marks = np.frombuffer(raw, np.uint8)
    inside = np.concatenate(([False], _IN_NUMBERS[marks], [False]))
    edges = np.flatnonzero(inside[1:] != inside[:-1])
    offsets = _starts(edges[1::2] - edges[0::2]).astype(np.int32)
    texts = pa.StringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets), pa.py_buffer(marks[inside[1:-1]]))
    return texts.cast(pa.float64()).to_numpy()


def parse_plain_wkt(texts: pa.Array) -> pa.Array:
    """WKT polygons of one ring of two-dimensional points, as most are, read together; other texts give NULL."""
    texts = texts.cast(pa.string())
    plain = np.flatnonzero(np.asarray(pc.fill_null(pc.match_substring_regex(texts, _PLAIN_WKT), False)))
    if not len(plain):
        return pa.nulls(len(texts), GEOM_ARROW)
    chosen = texts.take(pa.array(plain))
    offsets = np.frombuffer(chosen.buffers()[1], np.int32, len(plain) + 1, 4 * chosen.offset).astype(np.int64)
    raw = chosen.buffers()[2].to_pybytes()[offsets[0] : offsets[-1]]
    commas = np.flatnonzero(np.frombuffer(raw, np.uint8) == ord(","))
    n_pts = 1 + np.diff(np.searchsorted(commas, offsets - offsets[0]))
    numbers = _numbers(raw)
    one = np.ones(len(plain), np.int64)
    rows = _nested(one, one, n_pts, np.ascontiguousarray(numbers[0::2]), np.ascontiguousarray(numbers[1::2]))
    return merge_rows(len(texts), [(plain, rows)])


_RING_WKT = rf"\( *{_NUMBER} +{_NUMBER}(?: *, *{_NUMBER} +{_NUMBER})* *\)"
_PART_WKT = rf"\( *{_RING_WKT}(?: *, *{_RING_WKT})* *\)"
_MULTI_WKT = rf"^ *(?i:MULTIPOLYGON) *\( *{_PART_WKT}(?: *, *{_PART_WKT})* *\) *$"
_HOLED_WKT = rf"^ *(?i:POLYGON) *{_PART_WKT} *$"


def parse_wkt_rows(texts: pa.Array) -> pa.Array:
    """WKT polygons and multi-polygons of two-dimensional points, a column at a time; other texts give NULL."""
    texts = texts.cast(pa.string())
    here = lambda pattern, among: np.asarray(pc.fill_null(pc.match_substring_regex(among, pattern), False))
    plain = here(_PLAIN_WKT, texts)
    rest = np.flatnonzero(~plain)
    others = texts.take(pa.array(rest))
    holed, multi = here(_HOLED_WKT, others), here(_MULTI_WKT, others)
    nested = rest[holed | multi]
    if not len(nested):
        return parse_plain_wkt(texts)
    chosen = texts.take(pa.array(nested))
    offsets = np.frombuffer(chosen.buffers()[1], np.int32, len(nested) + 1, 4 * chosen.offset).astype(np.int64)
    raw = chosen.buffers()[2].to_pybytes()[offsets[0] : offsets[-1]]
    starts = offsets[:-1] - offsets[0]
    marks = np.frombuffer(raw, np.uint8)
    at = np.flatnonzero((marks == ord("(")) | (marks == ord(")")) | (marks == ord(",")))
    mark, row = marks[at], np.searchsorted(starts, at, side="right") - 1
    # Depth 2 holds rings and depth 3 points; a polygon lacks the outermost brackets.
    depth = np.cumsum((mark == ord("(")).astype(np.int64) - (mark == ord(")"))) + holed[holed | multi][row]
    ring, part = ((mark == ord("(")) & (depth == d) for d in (3, 2))
    of_ring, of_part = np.cumsum(ring) - 1, np.cumsum(part) - 1
    n_pts = 1 + np.bincount(of_ring[(mark == ord(",")) & (depth == 3)], minlength=int(ring.sum()))
    n_rings = np.bincount(of_part[ring], minlength=int(part.sum()))
    n_parts = np.bincount(row[part], minlength=len(nested))
    numbers = _numbers(raw)
    rows = _nested(n_parts, n_rings, n_pts, np.ascontiguousarray(numbers[0::2]), np.ascontiguousarray(numbers[1::2]))
    simple = np.flatnonzero(plain)
    pieces = [(simple, parse_plain_wkt(texts.take(pa.array(simple))))] if len(simple) else []
    return merge_rows(len(texts), [*pieces, (nested, rows)])


# ---------------------------------------------------------------- WKB
def parse_wkb(blob: bytes) -> list | None:
    """WKB Polygon / MultiPolygon (any byte order, extra ordinates dropped) -> parts."""

    def header(at):
        order = "<" if blob[at] == 1 else ">"
        (code,) = struct.unpack_from(order + "I", blob, at + 1)
        at += 5
        if code & 0x20000000:
            at += 4
        extra = bool(code & 0x80000000) + bool(code & 0x40000000)
        base = code & 0x0FFFFFFF
        if 1000 <= base < 4000:
            extra = max(extra, (1, 1, 2)[base // 1000 - 1])
        return order, base % 1000, 2 + extra, at

    def polygon(at, order, dims):
        (n_rings,) = struct.unpack_from(order + "I", blob, at)
        at += 4
        rings = []
        for _ in range(n_rings):
            (n,) = struct.unpack_from(order + "I", blob, at)
            at += 4
            pts = np.frombuffer(blob, order + "f8", n * dims, at).reshape(n, dims)
            rings.append(pts if dims == 2 else pts[:, :2])
            at += 8 * n * dims
        return rings, at

    order, kind, dims, at = header(0)
    if kind == 3:
        rings, _ = polygon(at, order, dims)
        return [rings] if rings else None
    if kind == 6:
        (n,) = struct.unpack_from(order + "I", blob, at)
        at += 4
        parts = []
        for _ in range(n):
            order, _, dims, at = header(at)
            rings, at = polygon(at, order, dims)
            if rings:
                parts.append(rings)
        return parts or None
    return None


def format_wkb(parts: list) -> bytes:
    """Parts -> little-endian WKB: Polygon for one part, MultiPolygon for several."""
    u4 = lambda v: struct.pack("<I", v)

    def polygon(rings):
        body = b"".join(u4(len(r)) + np.ascontiguousarray(r, "<f8").tobytes() for r in rings)
        return b"\x01" + u4(3) + u4(len(rings)) + body

    if len(parts) == 1:
        return polygon(parts[0])
    return b"\x01" + u4(6) + u4(len(parts)) + b"".join(polygon(p) for p in parts)


def _put(out: np.ndarray, at: np.ndarray, values: np.ndarray) -> None:
    """Write little-endian ``values`` into bytes, each row of bytes at its place."""
    if not len(at):
        return
    raw = np.ascontiguousarray(values).view(np.uint8).reshape(len(at), -1)
    out[at[:, None] + np.arange(raw.shape[1])] = raw


def format_wkb_rows(geoms: pa.Array) -> pa.Array:
    """:func:`format_wkb` of a whole column; NULL and empty rows give NULL."""
    parts = geoms.flatten()
    rings = parts.flatten()
    per_row, per_part, per_ring = _lengths(geoms), _lengths(parts), _lengths(rings)
    pts = rings.flatten()
    xy = np.column_stack([np.asarray(pts.field(k), dtype="<f8") for k in ("x", "y")])
    ring_bytes = 4 + 16 * per_ring
    ring_at, part_at = _starts(ring_bytes), _starts(per_part)
    # Headers of nine bytes stand before each part and before rows of several parts.
    part_bytes = 9 + ring_at[part_at[1:]] - ring_at[part_at[:-1]]
    row_at = _starts(per_row)
    in_parts = _starts(part_bytes)
    several = per_row > 1
    offsets = _starts(in_parts[row_at[1:]] - in_parts[row_at[:-1]] + 9 * several)
    out = np.zeros(offsets[-1], np.uint8)
    row_of_part = np.repeat(np.arange(len(geoms)), per_row)
    part_start = in_parts[:-1] + 9 * np.cumsum(several)[row_of_part]
    part_of_ring = np.repeat(np.arange(len(per_part)), per_part)
    ring_start = ring_at[:-1] + (part_start - ring_at[part_at[:-1]] + 9)[part_of_ring]
    ring_of_pt = np.repeat(np.arange(len(per_ring)), per_ring)
    point = np.arange(len(xy)) - _starts(per_ring)[:-1][ring_of_pt]
    for kind, at, counts in ((3, part_start, per_part), (6, offsets[:-1][several], per_row[several])):
        out[at] = 1
        out[at + 1] = kind
        _put(out, at + 5, counts.astype("<u4"))
    _put(out, ring_start, per_ring.astype("<u4"))
    _put(out, ring_start[ring_of_pt] + 4 + 16 * point, xy)
    whole = pa.Array.from_buffers(pa.binary(), len(geoms), [None, pa.array(offsets, pa.int32()).buffers()[1], pa.py_buffer(out)])
    return pc.if_else(pa.array(per_row > 0), whole, pa.scalar(None, pa.binary()))


def parse_wkb_rows(blobs: pa.Array) -> pa.Array:
    """:func:`parse_wkb` of a whole column; a blob that cannot be read becomes NULL.  Little-endian polygons of
    one closed ring, as most are, are read together."""
    blobs = blobs.cast(pa.binary())
    n = len(blobs)
    offsets = np.frombuffer(blobs.buffers()[1], np.int32, n + 1, 4 * blobs.offset).astype(np.int64) if n else np.zeros(1, np.int64)
    data = np.frombuffer(blobs.buffers()[2], np.uint8) if n and blobs.buffers()[2] is not None else np.zeros(0, np.uint8)
    at, size = offsets[:-1], np.diff(offsets)
    present = np.asarray(blobs.is_valid()) & (size > 0)
    plain = np.flatnonzero(present & (size >= 13 + 16) & ((size - 13) % 16 == 0))
    head = np.ascontiguousarray(data[at[plain][:, None] + np.arange(13)]) if len(plain) else np.zeros((0, 13), np.uint8)
    n_pts = (size[plain] - 13) // 16
    numbers = np.ascontiguousarray(head[:, 1:]).view("<u4").reshape(len(plain), 3)
    same = (head[:, 0] == 1) & (numbers[:, 0] == 3) & (numbers[:, 1] == 1) & (numbers[:, 2] == n_pts)
    plain, n_pts = plain[same], n_pts[same]
    ring = np.repeat(np.arange(len(plain)), n_pts)
    first = _starts(n_pts)
    place = at[plain][ring] + 13 + 16 * (np.arange(first[-1]) - first[:-1][ring])
    xy = np.ascontiguousarray(data[place[:, None] + np.arange(16)]).view("<f8").reshape(-1, 2) if len(place) else np.zeros((0, 2))
    one = np.ones(len(plain), np.int64)
    fast = _nested(one, one, n_pts, np.ascontiguousarray(xy[:, 0]), np.ascontiguousarray(xy[:, 1]))
    shut = closed_rows(fast)
    fast, plain = fast.filter(pa.array(shut)), plain[shut]
    left = present.copy()
    left[plain] = False
    rest, rows = np.flatnonzero(left), []
    for blob in blobs.take(pa.array(rest)):
        try:
            rows.append(parse_wkb(blob.as_py()))
        except (ValueError, IndexError, struct.error):
            rows.append(None)
    return merge_rows(n, [(plain, fast), (rest, parts_to_rows(rows))])


def albers_constants(a, inv_f, lat0, lat1, lat2):
    """(n, C, rho0, e) of an ellipsoidal Albers conic."""
    f = 1 / inv_f
    e2 = 2 * f - f * f
    e = math.sqrt(e2)

    def q(phi):
        s = math.sin(phi)
        return (1 - e2) * (s / (1 - e2 * s * s) - math.log((1 - e * s) / (1 + e * s)) / (2 * e))

    def m(phi):
        s = math.sin(phi)
        return math.cos(phi) / math.sqrt(1 - e2 * s * s)

    p0, p1, p2 = (math.radians(v) for v in (lat0, lat1, lat2))
    n = (m(p1) ** 2 - m(p2) ** 2) / (q(p2) - q(p1))
    c = m(p1) ** 2 + n * q(p1)
    rho0 = a * math.sqrt(c - n * q(p0)) / n
    return n, c, rho0, e
