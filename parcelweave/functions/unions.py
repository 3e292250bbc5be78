"""Unions of few shapes inside an Arrow batch, with the steps of ``operators/outlines.py``.

A row holds the shapes of one group as its parts, which may overlap.  All rows of a slice go through each step
together: edges are cut where they meet, kept where one side only is covered, and linked to rings.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa

from parcelweave.functions import kernel as K

#: Points that are worked on at once.
SLICE_POINTS = 1 << 16


def dissolve_rows(geoms: pa.Array, digits: int) -> pa.Array:
    """Per row the union of its parts, as ``outlines.dissolve`` gives it; NULL where nothing is covered."""
    parts = geoms.flatten()
    points = K._starts(K._lengths(parts.flatten()))[K._starts(K._lengths(parts))[K._starts(K._lengths(geoms))]]
    done, lo = [], 0
    while lo < len(geoms):
        hi = max(int(np.searchsorted(points, points[lo] + SLICE_POINTS, side="right")) - 1, lo + 1)
        done.append(_polygons(hi - lo, *_boundary(geoms.slice(lo, hi - lo), digits)))
        lo = hi
    return pa.concat_arrays(done) if done else pa.array([], K.GEOM_ARROW)


def _groups(*keys: np.ndarray):
    """Order of the rows by ``keys`` and the number of each ordered row's group."""
    order = np.lexsort(keys[::-1])
    new = np.zeros(len(order), bool)
    for k in keys:
        new[1:] |= k[order][1:] != k[order][:-1]
    return order, np.cumsum(new)


def _numbers(*keys: np.ndarray) -> np.ndarray:
    """Number of each row's group."""
    order, group = _groups(*keys)
    out = np.empty(len(order), np.int64)
    out[order] = group
    return out


def _ragged(first: np.ndarray, count: np.ndarray):
    """(i, j) with j = first[i] .. first[i] + count[i] - 1."""
    i = np.repeat(np.arange(len(count)), count)
    return i, first[i] + np.arange(len(i)) - K._starts(count)[i]


def _boundary(geoms: pa.Array, digits: int):
    """``row, ax, ay, bx, by`` of the directed edges around each row's union, the inside on the left."""
    e = K._rounded_edges(geoms, digits)
    tol, scale = 0.5 * 10.0**-digits, 10.0**digits
    cuts = [(np.zeros(0, np.int64), np.zeros(0), np.zeros(0))]
    for i, j in K._near_pairs(e, len(geoms), tol):
        l, r = ({c: e[c][at] for c in ("ax", "ay", "bx", "by")} for at in (i, j))
        for s, o, of in ((l, r, i), (r, l, j)):
            for p in "ab":
                x, y = o[f"{p}x"], o[f"{p}y"]
                inside, _ = K._on(s, x, y, tol)
                cuts.append((of[inside], x[inside], y[inside]))
        m = np.flatnonzero(K._cross(l, r))
        l, r = ({c: v[m] for c, v in s.items()} for s in (l, r))
        before, after = K._side(r, l["ax"], l["ay"]), K._side(r, l["bx"], l["by"])
        share = before / (before - after)
        x, y = (np.rint((l[f"a{c}"] + share * (l[f"b{c}"] - l[f"a{c}"])) * scale) / scale for c in "xy")
        cuts += [(i[m], x, y), (j[m], x, y)]
    edge, lx, ly, hx, hy, sign = K._pieces(e, np.arange(len(e["row"])), *(np.concatenate(c) for c in zip(*cuts)))
    row = e["row"][edge]
    order, group = _groups(row, lx, ly, hx, hy)
    first = np.flatnonzero(np.diff(group, prepend=-1))
    net = np.bincount(group, weights=sign[order]).astype(np.int64)
    crowd = np.bincount(group)
    told = net != 0
    at = order[first][told]
    row, lx, ly, hx, hy, net = row[at], lx[at], ly[at], hx[at], hy[at], net[told]
    # Where edges of both directions lie on one another, both sides are inside.
    single = np.abs(net) == crowd[told]
    mx, my, right = (lx + hx) / 2, (ly + hy) / 2, np.zeros(len(row))
    for i, j in K._pairs_of_rows(row, len(geoms)):
        for p, s in ((i, j), (j, i)):
            m = single[p] & (lx[s] <= mx[p]) & (mx[p] < hx[s])
            p, s = p[m], s[m]
            m = ly[s] + (mx[p] - lx[s]) * (hy[s] - ly[s]) / (hx[s] - lx[s]) < my[p]
            right += np.bincount(p[m], weights=net[s[m]], minlength=len(row))
    left_in, right_in = right + net > 0, right > 0
    k = single & (left_in != right_in)
    up = left_in[k]
    lx, ly, hx, hy = lx[k], ly[k], hx[k], hy[k]
    return row[k], np.where(up, lx, hx), np.where(up, ly, hy), np.where(up, hx, lx), np.where(up, hy, ly)


def _next(start: np.ndarray, end: np.ndarray, came: np.ndarray, goes: np.ndarray, widest: bool):
    """Edge that follows each edge, and whether there was a choice: see ``outlines._next``."""
    out = np.argsort(start, kind="stable")
    degree = np.bincount(start, minlength=int(max(start.max(), end.max())) + 1)
    i, j = _ragged(K._starts(degree)[end], degree[end])
    j = out[j]
    turn = np.mod(came[i] - goes[j], 2 * math.pi)
    order = np.lexsort((-turn if widest else turn, i))
    first = np.flatnonzero(np.diff(i[order], prepend=-1))
    return j[order][first], bool((degree[end] > 1).any())


def _cycles(to: np.ndarray):
    """Smallest edge of the ring of each edge, and the edge's place counted from there."""
    ids = np.arange(len(to))
    low, off, reach = np.minimum(ids, to), (to < ids).astype(np.int64), 1
    while reach <= len(ids):
        ahead = low[to]
        low, off, to, reach = np.minimum(low, ahead), np.where(ahead < low, off[to] + reach, off), to[to], 2 * reach
        if (low[to] == low).all() and reach > np.bincount(low).max():
            break
    size = np.zeros(len(ids), np.int64)
    np.maximum.at(size, low, off + 1)
    return low, np.mod(size[low] - off, size[low])


def _polygons(n_rows: int, row, ax, ay, bx, by) -> pa.Array:
    """Rings of the boundary edges of each row, put together to polygons as ``outlines.polygons`` orders them."""
    nodes = _numbers(np.concatenate([row, row]), np.concatenate([ax, bx]), np.concatenate([ay, by]))
    start, end = nodes[: len(row)], nodes[len(row) :]
    if not len(row):
        return pa.nulls(n_rows, K.GEOM_ARROW)
    came, goes = np.arctan2(ay - by, ax - bx), np.arctan2(by - ay, bx - ax)
    to, crowded = _next(start, end, came, goes, widest=False)
    ring, pos = _cycles(to)
    if crowded:
        nodes = _numbers(np.concatenate([ring, ring]), nodes)
        to, _ = _next(nodes[: len(row)], nodes[len(row) :], came, goes, widest=True)
        ring, pos = _cycles(to)
    order = np.lexsort((pos, ring))
    row, ax, ay, bx, by = (v[order] for v in (row, ax, ay, bx, by))
    ring = np.cumsum(np.diff(ring[order], prepend=-1) != 0) - 1
    edge_row, edge_ring = row, ring

    def around(ring):
        count = np.bincount(ring, minlength=int(edge_ring[-1]) + 1)
        return count, K._starts(count)[:-1][ring], count[ring]

    _, base, n = around(ring)
    k = np.arange(len(ring)) - base
    a, b = base + (k - 1) % n, base + (k + 1) % n
    bend = (ax - ax[a]) * (ay[b] - ay) != (ay - ay[a]) * (ax[b] - ax)
    count = np.bincount(ring[bend], minlength=int(ring[-1]) + 1)
    bend &= count[ring] > 2
    x, y, ring, row = ax[bend], ay[bend], ring[bend], row[bend]
    # From the smallest point on.
    count, base, n = around(ring)
    by_point = np.lexsort((y, x, ring))
    smallest = by_point[K._starts(count)[:-1][ring]] - base
    at = base + (np.arange(len(ring)) - base + smallest) % n
    x, y = x[at], y[at]
    b = base + (np.arange(len(ring)) - base + 1) % n
    twice = np.bincount(ring, weights=(x - x[base]) * (y[b] - y[base]) - (x[b] - x[base]) * (y - y[base]), minlength=len(count))
    row_of = np.zeros(len(count), np.int64)
    row_of[ring] = row
    rings = np.flatnonzero(count > 0)
    owner = np.arange(len(count))
    holes = rings[twice[rings] < 0]
    if len(holes):
        owner[holes] = _owners(n_rows, holes, twice, edge_row, edge_ring, ax, ay, bx, by)
        rings = rings[owner[rings] >= 0]
    first = K._starts(count)[:-1]
    corner = [v[first[rings] + k] for k in (0, 1) for v in (x, y)]
    hole = owner[rings] != rings
    # Polygons in order of their outline, then the outline before its holes.  Two points tell rings apart.
    rank = np.zeros(len(count), np.int64)
    outer = np.flatnonzero(~hole)
    rank[rings[outer[np.lexsort((*[c[outer] for c in corner[::-1]], row_of[rings[outer]]))]]] = np.arange(len(outer))
    rings = rings[np.lexsort((*corner[::-1], hole, rank[owner[rings]]))]
    closed = count[rings] + 1
    i, j = _ragged(np.zeros(len(rings), np.int64), closed)
    at = first[rings[i]] + j % count[rings[i]]
    points = pa.StructArray.from_arrays([pa.array(x[at]), pa.array(y[at])], fields=list(K.POINT))

    def lists(lengths, values, **kw):
        return pa.ListArray.from_arrays(pa.array(K._starts(lengths), pa.int32()), values, **kw)

    outlines = np.flatnonzero(owner[rings] == rings)
    per_part = np.diff(np.append(outlines, len(rings)))
    per_row = np.bincount(row_of[rings[outlines]], minlength=n_rows)
    return lists(per_row, lists(per_part, lists(closed, points)), mask=pa.array(per_row == 0))


def _owners(n_rows: int, holes, twice, row, ring, ax, ay, bx, by) -> np.ndarray:
    """Smallest outline around each hole, -1 for none: see ``outlines._owners``."""
    sloped = ax != bx
    row, ring, ax, ay, bx, by = (v[sloped] for v in (row, ring, ax, ay, bx, by))
    order = np.argsort(row, kind="stable")
    row, ring, ax, ay, bx, by = (v[order] for v in (row, ring, ax, ay, bx, by))
    mx, my = (ax + bx) / 2, (ay + by) / 2
    of_hole = np.flatnonzero(twice[ring] < 0)
    by_middle = of_hole[np.lexsort((my[of_hole], mx[of_hole], ring[of_hole]))]
    probe = by_middle[np.flatnonzero(np.diff(ring[by_middle], prepend=-1))]
    out = of_hole[:0] if not len(probe) else probe
    edges = np.flatnonzero(twice[ring] > 0)
    per_row = np.bincount(row[edges], minlength=n_rows)
    found = np.full(len(twice), -1)
    turns = []
    # A slice has few holes; each meets the outlines' edges of its row.
    for block in np.array_split(out, max(1, int(per_row[row[out]].sum()) >> 20)):
        i, j = _ragged(K._starts(per_row)[row[block]], per_row[row[block]])
        p, s = block[i], edges[j]
        m = (np.minimum(ax[s], bx[s]) <= mx[p]) & (mx[p] < np.maximum(ax[s], bx[s]))
        p, s = p[m], s[m]
        m = ay[s] + (mx[p] - ax[s]) * (by[s] - ay[s]) / (bx[s] - ax[s]) < my[p]
        turns.append((ring[p[m]], ring[s[m]], np.sign(bx[s] - ax[s])[m]))
    h, o, sign = (np.concatenate(t) for t in zip(*turns))
    if len(h):
        order, group = _groups(h, o)
        around = np.bincount(group, weights=sign[order]) > 0
        at = order[np.flatnonzero(np.diff(group, prepend=-1))][around]
        h, o = h[at], o[at]
        order = np.lexsort((twice[o], h))[::-1]
        found[h[order]] = o[order]
    return found[holes]
