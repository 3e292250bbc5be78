"""Polygon kernels against independent computations."""

import math

import numpy as np
import pyarrow as pa
import pytest

from parcelweave.functions import kernel as K


def star(rng, cx, cy, n=14):
    """Random concave polygon around a centre."""
    ang = np.sort(rng.uniform(0, 2 * math.pi, n))
    rad = rng.uniform(0.3, 1.5, n)
    return np.column_stack([cx + rad * np.cos(ang), cy + rad * np.sin(ang)])


def rows(*shapes):
    return K.parts_to_rows(list(shapes))


def area(parts):
    return sum(abs(K._ring_area(r[0])) - sum(abs(K._ring_area(h)) for h in r[1:]) for r in parts)


def test_intersection_matches_clipping_pieces():
    rng = np.random.default_rng(7)
    a = [[[star(rng, *rng.uniform(-1, 1, 2))]] for _ in range(60)]
    b = [[[star(rng, *rng.uniform(-1, 1, 2))]] for _ in range(60)]
    area_a, area_b, both, _ = K.overlap_areas(rows(*a), rows(*b))
    for i in range(60):
        pieces = K.convex_pieces(b[i][0])
        assert sum(abs(K._ring_area(p)) for p in pieces) == pytest.approx(area_b[i], rel=1e-9)
        assert sum(area(K.clip_convex(a[i], p)) for p in pieces) == pytest.approx(both[i], abs=1e-9)
        union = K.union_area([a[i][0], b[i][0]])
        assert union == pytest.approx(area_a[i] + area_b[i] - both[i], rel=1e-9)


def test_chunked_edge_pairs_give_the_same(monkeypatch):
    rng = np.random.default_rng(3)
    a = rows(*[[[star(rng, 0, 0)]] for _ in range(20)])
    b = rows(*[[[star(rng, 0.2, 0)]] for _ in range(20)])
    whole = K.overlap_areas(a, b)[2]
    monkeypatch.setattr(K, "MAX_EDGE_PAIRS", 17)
    assert np.allclose(K.overlap_areas(a, b)[2], whole)


def test_holes_parts_and_far_origin():
    shift = np.array([1.5e6, -3.2e6])
    outer, hole = K.box_ring(0, 0, 4, 4) + shift, K.box_ring(1, 1, 2, 2) + shift
    other = K.box_ring(1, 1, 6, 3) + shift
    _, _, both, _ = K.overlap_areas(rows([[outer, hole]]), rows([[other]]))
    assert both[0] == pytest.approx(5.0, abs=1e-6)
    two = [[K.box_ring(0, 0, 1, 1)], [K.box_ring(5, 5, 6, 6)]]
    assert K.overlap_areas(rows(two), rows([[K.box_ring(0.5, 0.5, 5.5, 5.5)]]))[2][0] == pytest.approx(0.5)


def test_touching_shapes_do_not_overlap():
    _, _, both, _ = K.overlap_areas(rows([[K.box_ring(0, 0, 1, 1)]]), rows([[K.box_ring(1, 0, 2, 1)]]))
    assert both[0] == 0.0


def test_slices_and_nulls():
    arr = K.parts_to_rows([[[K.box_ring(0, 0, 1, 1)]], None, [[K.box_ring(0, 0, 2, 2)]]])
    assert arr.null_count == 1
    a, _, both, valid = K.overlap_areas(arr.slice(1), arr.slice(1))
    assert list(valid) == [False, True] and both[1] == 4.0 and a[1] == 4.0


def test_half_plane_cut_gives_real_parts():
    u = np.array([[0, 0], [4, 0], [4, 4], [3, 4], [3, 1], [1, 1], [1, 4], [0, 4]], float)
    top = K.clip_box([[u]], -1, 2, 9, 9)
    assert len(top) == 2 and area(top) == pytest.approx(4.0)
    ring_with_hole = [[K.box_ring(0, 0, 4, 4), K.box_ring(1, 1, 3, 3)]]
    left = K.clip_box(ring_with_hole, 0, 0, 2, 4)
    assert area(left) == pytest.approx(6.0)
    assert area(K.clip_box(ring_with_hole, 0, 0, 3.5, 4)) == pytest.approx(10.0)


def test_box_clip_shortcuts_match_general_path():
    rng = np.random.default_rng(11)
    shapes = [[[star(rng, *rng.uniform(-1, 1, 2))]] for _ in range(40)] + [[[K.box_ring(*b)]] for b in [(0, 0, 1, 1), (-2, -2, 3, 3)]]
    boxes = np.tile([[-0.5, -0.5, 0.5, 0.5]], (len(shapes), 1))
    for fast, shape in zip(K.clip_rows_to_boxes(rows(*shapes), boxes), shapes):
        assert area(fast or []) == pytest.approx(area(K.clip_box(shape, *boxes[0])), abs=1e-12)


def test_simple_rings():
    assert K.simple_rings([[K.box_ring(0, 0, 1, 1)]])
    assert not K.simple_rings([[np.array([[0, 0], [1, 1], [1, 0], [0, 1]], float)]])
    assert not K.simple_rings([[np.array([[0, 0], [1, 1]], float)]])


def test_wkb_round_trip_and_big_endian():
    parts = [[K.box_ring(0, 0, 1, 1)], [K.box_ring(2, 2, 3, 3), K.box_ring(2.2, 2.2, 2.4, 2.4)]]
    back = K.parse_wkb(K.format_wkb(parts))
    assert all(np.array_equal(a, b) for p, q in zip(parts, back) for a, b in zip(p, q))
    ring = K.box_ring(0, 0, 1, 1)
    blob = b"\x00" + (3).to_bytes(4, "big") + (1).to_bytes(4, "big") + (5).to_bytes(4, "big") + ring.astype(">f8").tobytes()
    assert np.array_equal(K.parse_wkb(blob)[0][0], ring)
    assert K.parse_wkb(b"\x01" + (1).to_bytes(4, "little") + b"\x00" * 16) is None


def test_arrow_type():
    assert K.parts_to_rows([[[K.box_ring(0, 0, 1, 1)]]]).type == K.GEOM_ARROW
    assert pa.types.is_list(K.GEOM_ARROW)


def _mixed_shapes():
    """Boxes, stars, several parts, holes, open rings, empty and missing rows."""
    rng = np.random.default_rng(5)
    hole = [[K.box_ring(0, 0, 4, 4), K.box_ring(1, 1, 2, 2)]]
    two = [[K.box_ring(0, 0, 1, 1)], [K.box_ring(2, 2, 3, 3), K.box_ring(2.2, 2.2, 2.4, 2.4)]]
    return [[[K.box_ring(0, 0, 2, 1)]], None, hole, two, [[star(rng, 0, 0)]], [], [[K.box_ring(-1, -1, 9, 9)]], two, [[K.box_ring(7, 7, 8, 8)]]]


def _no_row_by_row(monkeypatch, *names):
    for name in names:
        monkeypatch.setattr(K, name, lambda *a: pytest.fail(f"{name} was called for a plain row"))


def test_wkb_columns_match_rows(monkeypatch):
    shapes = _mixed_shapes()
    column = rows(*shapes)
    blobs = K.format_wkb_rows(column)
    parts = K.rows_to_parts(column)
    assert blobs.to_pylist() == [K.format_wkb(p) if p else None for p in parts]
    assert K.format_wkb_rows(column.slice(2, 4)).to_pylist() == blobs.to_pylist()[2:6]
    ring = K.box_ring(0, 0, 1, 1)
    big = b"\x00" + (3).to_bytes(4, "big") + (1).to_bytes(4, "big") + (5).to_bytes(4, "big") + ring.astype(">f8").tobytes()
    unclosed = K.format_wkb([[ring[:4]]])
    odd = [big, unclosed, b"", b"\x01", blobs[0].as_py()[:-3], blobs[0].as_py() + b"\x00" * 16]
    given = pa.array(blobs.to_pylist() + odd, pa.binary())
    back = K.parse_wkb_rows(given)
    assert back.slice(0, len(column)).to_pylist() == column.to_pylist()
    square = K.parts_to_rows([[[ring]]]).to_pylist()
    assert back.slice(len(column)).to_pylist() == [*square, *square, None, None, None, column[0].as_py()]
    assert K.parse_wkb_rows(given.slice(3, 5)).to_pylist() == back.slice(3, 5).to_pylist()
    assert len(K.parse_wkb_rows(given.slice(0, 0))) == len(K.format_wkb_rows(column.slice(0, 0))) == 0
    boxes = rows(*[[[K.box_ring(k, 0, k + 1, 2)]] for k in range(50)])
    _no_row_by_row(monkeypatch, "parse_wkb", "format_wkb", "rows_to_parts")
    assert K.parse_wkb_rows(K.format_wkb_rows(boxes)).to_pylist() == boxes.to_pylist()


def test_clipped_columns_match_rows(monkeypatch):
    shapes = _mixed_shapes()
    column = rows(*shapes)
    boxes = np.tile([[-0.5, -0.5, 1.5, 3.5]], (len(shapes), 1))
    assert K.clip_to_boxes(column, boxes).to_pylist() == K.parts_to_rows(K.clip_rows_to_boxes(column, boxes)).to_pylist()
    assert K.clip_to_boxes(column.slice(1, 5), boxes[:5]).to_pylist() == K.parts_to_rows(K.clip_rows_to_boxes(column.slice(1, 5), boxes[:5])).to_pylist()
    upright = rows(*[[[K.box_ring(k / 10, 0, k / 10 + 1, 2)]] for k in range(50)])
    want = K.parts_to_rows(K.clip_rows_to_boxes(upright, boxes[:1].repeat(50, axis=0))).to_pylist()
    _no_row_by_row(monkeypatch, "rows_to_parts")
    assert K.clip_to_boxes(upright, boxes[:1].repeat(50, axis=0)).to_pylist() == want


def test_plain_wkt_and_areas_of_columns(spark):
    from pyspark.sql import functions as F

    from parcelweave.functions import geometry as G

    texts = [
        "POLYGON ((0 0, 4 0, 4 3, 0 3, 0 0))", "polygon((-1.5 0,2e-3 0, 2 1.25E1,-1.5 0)) ", "POLYGON((0 0, 1 0, 1 1))", "POLYGON ((0 0 5, 1 0 5, 1 1 5, 0 0 5))",
        "MULTIPOLYGON (((0 0, 1 0, 1 1, 0 0)), ((5 5, 6 5, 6 6, 5 5)))", "POLYGON ((0 0, 4 0, 4 4, 0 4, 0 0), (1 1, 2 1, 2 2, 1 1))", "POLYGON EMPTY", "POINT (1 2)",
        "POLYGON ((01 0, 1 0, 1 1))", "POLYGON ((1. 0, 1 0, 1 1))", "POLYGON ((0 0, 1 0", "POLYGON ((0 0, , 1 1))", "", None, "POLYGON ((0.1 0.2, 123456.789012345 0.3, 7 1e2, 0.1 0.2))",
    ]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").repartition(1)
    both = df.select("i", G.from_wkt(F.col("t")).alias("g"), G._any_wkt(F.col("t")).alias("plain")).collect()
    assert [r.g for r in both] == [r.plain for r in both]
    assert sum(v is not None for v in K.parse_plain_wkt(pa.array(texts)).to_pylist()) == 4
    shapes = spark.createDataFrame([(K.parts_to_rows([s]).to_pylist()[0],) for s in _mixed_shapes()] + [([],), ([[]],), ([[[]]],)], f"g {G.GEOM}")
    shapes = shapes.unionByName(df.select(G.from_wkt(F.col("t")).alias("g")))
    for row in shapes.select(G.area(F.col("g")).alias("a"), G.areas(F.col("g")).alias("b"), "g").collect():
        assert row.a == row.b, row


def test_nested_wkt_is_read_by_columns():
    box, hole = "(0 0, 4 0, 4 4, 0 4, 0 0)", "(1 1, 2e0 1,2 -2.5E-1, 1 1)"
    texts = [
        f"POLYGON ({box})", f"MULTIPOLYGON (({box}, {hole}), ({hole}))", None, f"polygon({box},{hole})", f"MultiPolygon((({box[1:]}))", "MULTIPOLYGON EMPTY",
        f"MULTIPOLYGON (({box}), ({hole}, {box}, {hole}))", "MULTIPOLYGON (((0 0 1, 1 0 1, 1 1 1)))", f"POLYGON (({box}))", f"MULTIPOLYGON ({box})", f"MULTIPOLYGON (({box}),)",
    ]
    b, h = [(0, 0), (4, 0), (4, 4), (0, 4), (0, 0)], [(1, 1), (2, 1), (2, -0.25), (1, 1)]
    want = [[[b]], [[b, h], [h]], None, [[b, h]], [[b]], None, [[b], [h, b, h]], None, None, None, None]
    flat = lambda rows: [r and [[[(p["x"], p["y"]) for p in ring] for ring in part] for part in r] for r in rows.to_pylist()]
    assert flat(K.parse_wkt_rows(pa.array(texts))) == want
    assert flat(K.parse_wkt_rows(pa.array(texts).slice(2, 6))) == want[2:8] and len(K.parse_wkt_rows(pa.array([], pa.string()))) == 0


def test_outlines_are_measured_and_judged_in_one_call():
    p = lambda *xy: [{"x": x, "y": y} for x, y in xy]
    box, bow = p((0, 0), (4, 0), (4, 4), (0, 4), (0, 0)), p((0, 0), (4, 4), (4, 0), (0, 3), (0, 0))
    many = p(*[(float(k), float(k * k)) for k in range(65)])
    shapes = [[[box]], None, [], [[bow]], [[p((0, 0), (1, 1), (2, 2), (0, 0))]], [[many]], [[box], []], [[box], None], [[[*box[:2], None, *box[2:]]]], [[box], [box]], [[box[:2]]], [[[*box[:2], {"x": None, "y": 1.0}, *box[2:]]]]]
    rows = pa.array(shapes, K.GEOM_ARROW)
    assert K.outline_faults(rows, 9, 64).to_pylist() == [0, None, 0, 2, 1, -1, 1, 1, 1, 4, 1, 1]
    assert K.outline_faults(rows.slice(3, 3), 9, 64).to_pylist() == [2, 1, -1]
