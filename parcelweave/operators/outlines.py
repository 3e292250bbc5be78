"""Outlines as tables of directed edges: splitting at crossings, coverage, boundaries and rings.

Every ring is exploded into edges that have the shape's inside on their left.  Edges are cut where they
meet, so that afterwards two of them are equal, opposite or apart; how many shapes cover either side of
one is a sum over the edges below it.  All steps are equi-joins on small cells and aggregations, so neither
a large outline nor a crowded place becomes one task's work, and rings are put together by pointer doubling.
Groups of few shapes of few points take the same steps in one Arrow batch (``functions/unions.py``).
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelweave.functions import geometry as G
from parcelweave.functions.columns import half_even
from parcelweave.session import cut_lineage

#: Decimal digits that coordinates are rounded to: a tenth of a millimetre where they are degrees.
DIGITS = 9
#: Outlines of up to so many points are checked in place, edge by edge; larger ones as tables of edges.
SMALL = 64
#: Shapes that are united at once.
RUN = 64
_SEGMENT = ["lx", "ly", "hx", "hy"]


def ring_edges(shapes: DataFrame, keys: list[str], digits: int = DIGITS) -> DataFrame:
    """``keys, shape, part, ring, pos, n, ax, ay, bx, by, eid`` of all edges of the ``geometry`` column.

    ``shape`` numbers the input rows and ``eid`` the edges; ``n`` is the number of edges of the ring and
    ``pos`` the place in it as given.  Outlines run counter-clockwise, holes clockwise, so the inside is on
    the left; open rings are closed, and edges without length are left out.  The table is written once, as its numbers would change if
    it were computed again.
    """
    numbered = shapes.select(*keys, "geometry").withColumn("shape", F.monotonically_increasing_id())
    parts = numbered.select(*keys, "shape", F.posexplode("geometry").alias("part", "_rings"))
    rings = parts.select(*keys, "shape", "part", F.posexplode("_rings").alias("ring", "_points"))
    closed = F.when(F.get("_points", F.lit(0)) == F.element_at("_points", -1), F.col("_points")).otherwise(F.concat("_points", F.slice("_points", 1, 1)))
    snapped = F.transform("_points", lambda p: F.struct(half_even(p["x"], digits).alias("x"), half_even(p["y"], digits).alias("y")))
    # Repeated points would be edges without length.
    kept = F.filter(F.col("_points"), lambda p, i: (i == 0) | (p != F.get(F.col("_points"), i - 1)))
    rings = rings.where(F.size("_points") > 0).withColumn("_points", closed).withColumn("_points", snapped).withColumn("_points", kept)
    rings = rings.withColumn("_turn", G._ring_area(F.col("_points"))).where(F.size("_points") > 1)
    steps = F.transform(
        F.sequence(F.lit(0), F.size("_points") - 2),
        lambda i: F.struct(i.alias("pos"), F.get(F.col("_points"), i).alias("a"), F.get(F.col("_points"), i + 1).alias("b")),
    )
    each = rings.select(*keys, "shape", "part", "ring", "_turn", (F.size("_points") - 1).alias("n"), F.explode(steps).alias("e"))
    as_is = (F.col("_turn") > 0) == (F.col("ring") == 0)
    a, b = F.when(as_is, F.col("e.a")).otherwise(F.col("e.b")), F.when(as_is, F.col("e.b")).otherwise(F.col("e.a"))
    out = each.select(*keys, "shape", "part", "ring", F.col("e.pos").alias("pos"), "n", a.alias("a"), b.alias("b"))
    return cut_lineage(
        out.select(
            *keys, "shape", "part", "ring", "pos", "n", F.col("a.x").alias("ax"), F.col("a.y").alias("ay"),
            F.col("b.x").alias("bx"), F.col("b.y").alias("by"), F.monotonically_increasing_id().alias("eid"),
        )
    )


def mesh_of(edges: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, _x0, _y0, _s``: origin and cell size of each group's own mesh, of about as many cells as the
    group has edges, so that cells stay small however many edges there are."""
    stats = edges.groupBy(*keys).agg(
        F.min(F.least("ax", "bx")).alias("_x0"), F.min(F.least("ay", "by")).alias("_y0"),
        F.max(F.greatest("ax", "bx")).alias("_x1"), F.max(F.greatest("ay", "by")).alias("_y1"), F.count(F.lit(1)).alias("_n"),
    )
    side = F.greatest(F.col("_x1") - F.col("_x0"), F.col("_y1") - F.col("_y0"))
    size = F.when(side > 0, side / F.ceil(F.sqrt("_n"))).otherwise(1.0)
    return cut_lineage(stats.select(*keys, "_x0", "_y0", size.alias("_s")))


def column_of(x: Column) -> Column:
    return F.floor((x - F.col("_x0")) / F.col("_s"))


def row_of(y: Column) -> Column:
    return F.floor((y - F.col("_y0")) / F.col("_s"))


def in_cells(edges: DataFrame, tol: float) -> DataFrame:
    """One row per edge and cell of the mesh it touches: ``_cx, _cy``.  A long edge lies in the cells along
    it, not in all of its box."""
    ax, ay, bx, by = (F.col(c) for c in ("ax", "ay", "bx", "by"))
    first, last = column_of(F.least(ax, bx) - tol), column_of(F.greatest(ax, bx) + tol)
    columns = edges.withColumn("_cx", F.explode(F.sequence(first, last)))
    low, high = F.least(ay, by), F.greatest(ay, by)
    slope = (by - ay) / F.nullif(bx - ax, F.lit(0.0))

    def at(x):
        return F.coalesce(ay + (F.greatest(F.least(ax, bx), F.least(x, F.greatest(ax, bx))) - ax) * slope, low)

    left, right = at(F.col("_x0") + F.col("_cx") * F.col("_s") - tol), at(F.col("_x0") + (F.col("_cx") + 1) * F.col("_s") + tol)
    upright = ax == bx
    bottom = F.when(upright, low).otherwise(F.greatest(low, F.least(left, right)))
    top = F.when(upright, high).otherwise(F.least(high, F.greatest(left, right)))
    # A little room, as the heights at the column's sides are rounded.
    room = F.lit(tol) + (high - low) * F.lit(1e-12)
    return columns.withColumn("_cy", F.explode(F.sequence(row_of(bottom - room), row_of(top + room))))


def meeting_pairs(edges: DataFrame, mesh: DataFrame, keys: list[str], tol: float) -> DataFrame:
    """Pairs ``l, r`` (structs of the edges, l with the smaller number) of one group whose boxes meet; a pair
    comes once for each cell that both lie in."""
    cells = in_cells(edges.join(mesh, keys), tol)
    row = F.struct(*[c for c in edges.columns if c not in keys])
    left = cells.select(*keys, "_cx", "_cy", row.alias("l"))
    right = cells.select(*keys, "_cx", "_cy", row.alias("r"))
    pairs = left.join(right, [*keys, "_cx", "_cy"]).where(F.col("l.eid") < F.col("r.eid"))
    apart = F.lit(False)
    for a, b in (("ax", "bx"), ("ay", "by")):
        for one, other in (("l", "r"), ("r", "l")):
            apart = apart | (F.greatest(f"{one}.{a}", f"{one}.{b}") + tol < F.least(f"{other}.{a}", f"{other}.{b}"))
    return pairs.where(~apart).drop("_cx", "_cy")


def side(e: Column, x: Column, y: Column) -> Column:
    """Twice the area of edge and point: positive where the point is on the edge's left."""
    return (e["bx"] - e["ax"]) * (y - e["ay"]) - (e["by"] - e["ay"]) * (x - e["ax"])


def on_edge(e: Column, x: Column, y: Column, tol: float) -> Column:
    """True for a point within ``tol`` of the edge that is none of its ends."""
    dx, dy = e["bx"] - e["ax"], e["by"] - e["ay"]
    along = (x - e["ax"]) * dx + (y - e["ay"]) * dy
    inner = (along > 0) & (along < dx * dx + dy * dy)
    end = ((x == e["ax"]) & (y == e["ay"])) | ((x == e["bx"]) & (y == e["by"]))
    return inner & ~end & (F.abs(side(e, x, y)) <= tol * F.hypot(dx, dy))


def cross_properly(l: Column, r: Column) -> Column:  # noqa: E741
    """True where either edge has one end strictly on each side of the other."""
    one = F.signum(side(l, r["ax"], r["ay"])) * F.signum(side(l, r["bx"], r["by"]))
    other = F.signum(side(r, l["ax"], l["ay"])) * F.signum(side(r, l["bx"], l["by"]))
    return (one < 0) & (other < 0)


def split_edges(edges: DataFrame, mesh: DataFrame, keys: list[str], digits: int = DIGITS, carry: tuple[str, ...] = ("shape",)) -> DataFrame:
    """All edges cut where another edge of the group meets them: ``keys, carry, lx, ly, hx, hy, sign``.

    The ends are in order of x and y; ``sign`` is 1 where the edge runs from the lower to the higher one.
    """
    tol = 0.5 * 10.0**-digits
    pairs = meeting_pairs(edges, mesh, keys, tol)
    l, r = F.col("l"), F.col("r")  # noqa: E741

    def at(e, x, y, of):
        return F.when(on_edge(e, x, y, tol), F.struct(of.alias("eid"), x.alias("x"), y.alias("y")))

    ends = [at(l, r[f"{p}x"], r[f"{p}y"], l["eid"]) for p in "ab"] + [at(r, l[f"{p}x"], l[f"{p}y"], r["eid"]) for p in "ab"]
    before, after = side(r, l["ax"], l["ay"]), side(r, l["bx"], l["by"])
    share = before / F.nullif(before - after, F.lit(0.0))
    point = F.when(
        cross_properly(l, r),
        F.struct(half_even(l["ax"] + share * (l["bx"] - l["ax"]), digits).alias("x"), half_even(l["ay"] + share * (l["by"] - l["ay"]), digits).alias("y")),
    )
    found = pairs.select(F.array(*ends).alias("ends"), l["eid"].alias("l"), r["eid"].alias("r"), point.alias("p"))
    both = F.transform(F.array("l", "r"), lambda e: F.when(F.col("p").isNotNull(), F.struct(e.alias("eid"), F.col("p.x").alias("x"), F.col("p.y").alias("y"))))
    cuts = found.select(F.explode(F.filter(F.concat("ends", both), lambda c: c.isNotNull())).alias("c")).select("c.*")
    cuts = cuts.groupBy("eid").agg(F.collect_set(F.struct("x", "y")).alias("_cuts"))
    joined = edges.select(*keys, *carry, "eid", "ax", "ay", "bx", "by").join(cuts, "eid", "left")
    dx, dy = F.col("bx") - F.col("ax"), F.col("by") - F.col("ay")
    a, b = F.struct(F.col("ax").alias("x"), F.col("ay").alias("y")), F.struct(F.col("bx").alias("x"), F.col("by").alias("y"))
    inner = F.transform(
        F.array_sort(F.transform("_cuts", lambda c: F.struct(((c["x"] - F.col("ax")) * dx + (c["y"] - F.col("ay")) * dy).alias("t"), c.alias("c")))),
        lambda s: s["c"],
    )
    points = F.concat(F.array(a), F.coalesce(inner, F.array().cast("array<struct<x:double,y:double>>")), F.array(b))
    split = joined.withColumn("_points", points).select(
        *keys, *carry, F.explode(F.transform(F.sequence(F.lit(0), F.size("_points") - 2), lambda i: F.struct(F.get(F.col("_points"), i).alias("p"), F.get(F.col("_points"), i + 1).alias("q")))).alias("e")
    ).where(F.col("e.p") != F.col("e.q"))
    low, high = F.least("e.p", "e.q"), F.greatest("e.p", "e.q")
    return split.select(
        *keys, *carry, low["x"].alias("lx"), low["y"].alias("ly"), high["x"].alias("hx"), high["y"].alias("hy"),
        F.when(F.col("e.p") == low, 1).otherwise(-1).alias("sign"),
    )


def covered_below(probes: DataFrame, targets: DataFrame, keys: list[str], unless: Column) -> DataFrame:
    """Pairs of a probe (``_mx, _my``) and a target segment below it: the sum of the targets' signs is the
    number of shapes around the probe.  ``probes`` and ``targets`` are structs ``m`` and ``t`` with ``_x0,
    _y0, _s`` of the mesh; a target stands in all rows of the mesh from its own up to its shape's top, above
    which the shape's edges sum up to nothing.
    """
    at = probes.select(*keys, column_of(F.col("m._mx")).alias("_cx"), row_of(F.col("m._my")).alias("_cy"), "m")
    wide = targets.where(F.col("t.lx") < F.col("t.hx")).withColumn("_cx", F.explode(F.sequence(column_of(F.col("t.lx")), column_of(F.col("t.hx")))))
    tall = wide.withColumn("_cy", F.explode(F.sequence(row_of(F.least("t.ly", "t.hy")), row_of(F.col("t.top")))))
    spans = (F.col("t.lx") <= F.col("m._mx")) & (F.col("m._mx") < F.col("t.hx"))
    height = F.col("t.ly") + (F.col("m._mx") - F.col("t.lx")) * (F.col("t.hy") - F.col("t.ly")) / (F.col("t.hx") - F.col("t.lx"))
    met = at.join(tall.select(*keys, "_cx", "_cy", "t"), [*keys, "_cx", "_cy"])
    return met.where(spans & (height < F.col("m._my")) & unless).select(*keys, "m", "t", height.alias("height"))


def union_boundary(edges: DataFrame, keys: list[str], digits: int = DIGITS, run: int = RUN) -> DataFrame:
    """``keys, ax, ay, bx, by``: directed edges around the union of each group's shapes, inside on the left.

    Groups of many shapes are united as a tree: shapes of one neighbourhood first (about ``run`` of them),
    then the outlines that are left of each, and so on, so that what lies many times on top of one another
    meets only within its run.
    """
    while True:
        each = edges.groupBy(*keys, "shape").agg(
            F.min(F.least("ax", "bx")).alias("x"), F.min(F.least("ay", "by")).alias("y"), F.max(F.greatest("ax", "bx")).alias("x1"), F.max(F.greatest("ay", "by")).alias("y1")
        )
        groups = each.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"), F.min("x").alias("_x0"), F.min("y").alias("_y0"), F.max("x1").alias("_x1"), F.max("y1").alias("_y1"))
        groups = cut_lineage(groups)
        if (groups.agg(F.max("_n")).first()[0] or 0) <= run:
            return _boundary(edges, keys, digits)
        per_side = F.ceil(F.sqrt(F.col("_n") / run))
        at = lambda low, high, least, most: F.least(F.floor(((low + high) / 2 - least) / (most - least) * per_side), per_side - 1)
        place = each.join(groups, keys).select(
            *keys, "shape", (at(F.col("x"), F.col("x1"), F.col("_x0"), F.col("_x1")) * F.lit(1 << 31) + at(F.col("y"), F.col("y1"), F.col("_y0"), F.col("_y1"))).alias("_run")
        )
        merged = _boundary(edges.join(cut_lineage(place), [*keys, "shape"]), [*keys, "_run"], digits)
        edges = cut_lineage(merged.withColumnRenamed("_run", "shape").withColumn("eid", F.monotonically_increasing_id()))


def _boundary(edges: DataFrame, keys: list[str], digits: int) -> DataFrame:
    mesh = mesh_of(edges, keys)
    split = cut_lineage(split_edges(edges, mesh, keys, digits))
    tops = edges.groupBy(*keys, "shape").agg(F.max(F.greatest("ay", "by")).alias("top"))
    segments = split.groupBy(*keys, *_SEGMENT).agg(F.sum("sign").alias("net"), F.count_if(F.col("sign") > 0).alias("ups"), F.count(F.lit(1)).alias("all"))
    # Where edges of both directions lie on one another, both sides are inside.
    single = segments.where((F.col("ups") == 0) | (F.col("ups") == F.col("all"))).select(*keys, *_SEGMENT, "net")
    single = cut_lineage(single)
    middle = F.struct(*_SEGMENT, "net", ((F.col("lx") + F.col("hx")) / 2).alias("_mx"), ((F.col("ly") + F.col("hy")) / 2).alias("_my"))
    probes = single.join(mesh, keys).select(*keys, "_x0", "_y0", "_s", middle.alias("m"))
    targets = split.join(tops, [*keys, "shape"]).join(mesh, keys).select(*keys, "_x0", "_y0", "_s", F.struct(*_SEGMENT, "sign", "top").alias("t"))
    other = F.lit(False)
    for c in _SEGMENT:
        other = other | (F.col(f"m.{c}") != F.col(f"t.{c}"))
    below = covered_below(probes, targets, keys, other).select(*keys, "m.lx", "m.ly", "m.hx", "m.hy", "m.net", F.col("t.sign").alias("sign"))
    told = below.unionByName(single.withColumn("sign", F.lit(0)))
    sums = told.groupBy(*keys, *_SEGMENT, "net").agg(F.sum("sign").alias("right"))
    left_in, right_in = F.col("right") + F.col("net") > 0, F.col("right") > 0
    kept = sums.where(left_in != right_in)
    return kept.select(
        *keys,
        *[F.when(left_in, F.col(a)).otherwise(F.col(b)).alias(c) for a, b, c in (("lx", "hx", "ax"), ("ly", "hy", "ay"), ("hx", "lx", "bx"), ("hy", "ly", "by"))],
    )


def cycles(links: DataFrame, longest: int) -> DataFrame:
    """``id, ring, pos`` of every node of the cycles ``id -> to``: the ring is the smallest id of the cycle,
    ``pos`` counts from it.

    Each node knows the smallest id within its reach and how far off it is.  Reach doubles by a join of the
    nodes with those they reach, twice a round, so cycles of up to ``longest`` nodes take half as many rounds
    as that number has bits.
    """
    near = F.col("to") < F.col("id")
    state = links.select("id", "to", F.least("id", "to").alias("low"), F.when(near, 1).otherwise(0).cast("long").alias("off"))
    reach = 1

    def doubled(known: DataFrame, reach: int) -> DataFrame:
        ahead = known.select(F.col("id").alias("to"), F.col("to").alias("_to"), F.col("low").alias("_low"), F.col("off").alias("_off"))
        nearer = F.col("_low") < F.col("low")
        return known.join(ahead, "to").select(
            "id", F.col("_to").alias("to"), F.least("low", "_low").alias("low"), F.when(nearer, F.col("_off") + reach).otherwise(F.col("off")).alias("off")
        )

    while reach <= longest:
        before = state
        state = cut_lineage(doubled(doubled(state, reach), 2 * reach), before)
        reach *= 4
    sizes = state.groupBy("low").agg((F.max("off") + 1).alias("_n"))
    return state.join(sizes, "low").select("id", F.col("low").alias("ring"), F.pmod(F.col("_n") - F.col("off"), F.col("_n")).alias("pos"))


def _next(edges: DataFrame, keys: list[str], widest: bool) -> DataFrame:
    """``id, to, crowd``: where several edges leave a point, the one next to the inside (or, ``widest``, to the
    outside) of the edge that comes in."""
    comes = edges.select(*keys, F.col("bx").alias("x"), F.col("by").alias("y"), "id", F.atan2(F.col("ay") - F.col("by"), F.col("ax") - F.col("bx")).alias("_in"))
    goes = edges.select(*keys, F.col("ax").alias("x"), F.col("ay").alias("y"), F.col("id").alias("to"), F.atan2(F.col("by") - F.col("ay"), F.col("bx") - F.col("ax")).alias("_out"))
    turn = F.pmod(F.col("_in") - F.col("_out"), F.lit(2 * math.pi))
    pick = F.max_by if widest else F.min_by
    return comes.join(goes, [*keys, "x", "y"]).groupBy("id").agg(pick("to", turn).alias("to"), F.count(F.lit(1)).alias("crowd"))


def rings(boundary: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, ring, pos, ax, ay, bx, by``: the boundary's edges in order of their simple rings.

    Pieces that touch in a point are rings of their own, and so are holes that touch each other or the
    outline: pieces are told apart first, then the rings of each piece.
    """
    edges = cut_lineage(boundary.withColumn("id", F.monotonically_increasing_id()))
    longest = edges.groupBy(*keys).count().agg(F.max("count")).first()[0] or 0
    links = cut_lineage(_next(edges, keys, widest=False))
    found = cut_lineage(cycles(links.select("id", "to"), longest))
    if not links.where("crowd > 1").isEmpty():
        pieces = edges.join(found.select("id", F.col("ring").alias("_piece")), "id")
        again = cut_lineage(_next(pieces, [*keys, "_piece"], widest=True))
        found = cycles(again.select("id", "to"), longest)
    return edges.join(found, "id").drop("id")


def _tidy(points: Column) -> Column:
    """Ring of points without those on a straight line, closed, from its smallest point on."""
    n = F.size(points)

    def bend(p, i):
        a, b = F.get(points, F.pmod(i - 1, n)), F.get(points, F.pmod(i + 1, n))
        return (p["x"] - a["x"]) * (b["y"] - p["y"]) != (p["y"] - a["y"]) * (b["x"] - p["x"])

    return F.filter(points, bend)


def _from_smallest(points: Column) -> Column:
    at = F.array_position(points, F.array_min(points)).cast("int")
    turned = F.concat(F.slice(points, at, F.size(points)), F.slice(points, F.lit(1), at - 1))
    return F.concat(turned, F.slice(turned, 1, 1))


def polygons(boundary: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, rings``: one row per polygon, its outline first, then its holes in order."""
    edges = cut_lineage(rings(boundary, keys))
    step = F.struct("pos", F.struct(F.col("ax").alias("x"), F.col("ay").alias("y")).alias("p"))
    lines = edges.groupBy(*keys, "ring").agg(F.array_sort(F.collect_list(step)).alias("_steps"))
    lines = lines.select(*keys, "ring", F.col("_steps.p").alias("_points"))
    lines = lines.withColumn("_points", _tidy(F.col("_points"))).where(F.size("_points") > 2)
    lines = lines.withColumn("_points", _from_smallest(F.col("_points"))).withColumn("_hole", G._ring_area(F.col("_points")) < 0)
    lines = cut_lineage(lines)
    holes = lines.where("_hole")
    if holes.isEmpty():
        return lines.select(*keys, F.array("_points").alias("rings"))
    owners = _owners(edges, lines, keys)
    inner = holes.join(owners, "ring").groupBy(F.col("owner").alias("ring")).agg(F.array_sort(F.collect_list("_points")).alias("_inner"))
    outer = lines.where(~F.col("_hole")).join(inner, "ring", "left")
    return outer.select(*keys, F.concat(F.array("_points"), F.coalesce("_inner", F.array().cast(f"array<{G.RING}>"))).alias("rings"))


def _owners(edges: DataFrame, lines: DataFrame, keys: list[str]) -> DataFrame:
    """``ring, owner`` of every hole: the smallest outline around it.

    An outline is around a point if its edges below the point run once more to the right than to the left;
    the middle of a hole's edge lies on no other ring, as edges are cut wherever rings meet."""
    kinds = lines.select("ring", "_hole", F.abs(G._ring_area(F.col("_points"))).alias("_size"))
    meshed = edges.join(mesh_of(edges, keys), keys).join(kinds, "ring").where(F.col("ax") != F.col("bx"))
    middle = F.struct(((F.col("ax") + F.col("bx")) / 2).alias("_mx"), ((F.col("ay") + F.col("by")) / 2).alias("_my"))
    probes = meshed.where("_hole").groupBy(*keys, "ring", "_x0", "_s").agg(F.min(middle).alias("m"))
    probes = probes.select(*keys, F.col("ring").alias("_of"), "m", column_of(F.col("m._mx")).alias("_cx"))
    low, high = F.least("ax", "bx"), F.greatest("ax", "bx")
    spans = meshed.where("not _hole").withColumn("_cx", F.explode(F.sequence(column_of(low), column_of(high))))
    height = F.col("ay") + (F.col("m._mx") - F.col("ax")) * (F.col("by") - F.col("ay")) / (F.col("bx") - F.col("ax"))
    below = probes.join(spans, [*keys, "_cx"]).where((low <= F.col("m._mx")) & (F.col("m._mx") < high) & (height < F.col("m._my")))
    turns = below.groupBy("_of", "ring", "_size").agg(F.sum(F.signum(F.col("bx") - F.col("ax"))).alias("n")).where("n > 0")
    return turns.groupBy(F.col("_of").alias("ring")).agg(F.min_by("ring", "_size").alias("owner"))


def dissolve(shapes: DataFrame, keys: list[str], digits: int = DIGITS, run: int = RUN, sizes: DataFrame | None = None, keep: bool = False) -> DataFrame:
    """``keys, geometry``: the union of each group's shapes, without overlaps and inner borders.

    Coordinates are rounded to ``digits`` decimals, and points as close as that to an edge lie on it.  Shapes
    are taken as valid; groups without any area have no row.  With ``keep``, groups whose shapes are all equal
    keep that outline as it is, and so do groups without any area (the smallest of theirs).

    Groups of few shapes meet in one Arrow batch.  Of the others, neighbouring shapes do so in runs of about
    ``run`` first; what is left of each run, and shapes of many points, meet as tables of edges.  ``sizes``
    (:func:`group_sizes`, by ``keys``) may be given where it is known.
    """
    given = shapes.where(F.col("geometry").isNotNull()).select(*keys, "geometry")
    if sizes is None:
        sizes = cut_lineage(given.groupBy(*keys).agg(*group_sizes()))
    # As one struct, keys that are null meet too.
    key = F.struct(*keys).alias("_key")
    given, sizes = given.select(key, "geometry"), sizes.select(key, "_shapes", "_most")
    few = (F.col("_shapes") <= run) & (F.col("_most") <= SMALL)
    listed = given.join(sizes.where(few), "_key").groupBy("_key").agg(F.collect_list("geometry").alias("_all"))
    if keep:
        low = F.array_min("_all")
        # A group of equal shapes does not pass through the kernel.
        listed = listed.withColumn("_same", low == F.array_max("_all"))
        united = G.union_parts(F.when(~F.col("_same"), F.flatten("_all")), F.lit(digits))
        united = F.when(F.col("_same"), low).otherwise(F.coalesce(united, low))
    else:
        united = G.union_parts(F.flatten("_all"), F.lit(digits))
    done = listed.select("_key.*", united.alias("geometry")).where(F.col("geometry").isNotNull())
    many = sizes.where(~few)
    if many.isEmpty():
        return done
    rows = cut_lineage(given.join(many.select("_key", "_shapes"), "_key").select("_key.*", "geometry", "_shapes"))
    return done.unionByName(_dissolve_many(rows, keys, digits, run, keep))


def group_sizes() -> list[Column]:
    """What :func:`dissolve` has to know of a group of ``geometry``: its shapes, and the most points of one."""
    points = F.when(F.col("geometry").isNotNull(), F.coalesce(F.size(F.flatten(F.flatten("geometry"))), F.lit(0)))
    return [F.count("geometry").alias("_shapes"), F.max(points).alias("_most")]


def _dissolve_many(rows: DataFrame, keys: list[str], digits: int, run: int, keep: bool) -> DataFrame:
    """:func:`dissolve` of groups of many shapes (``_shapes``) or many points."""
    box = G.bbox(F.col("geometry"))
    placed = rows.where(is_small()).select(*keys, "geometry", "_shapes", ((box["minx"] + box["maxx"]) / 2).alias("_x"), ((box["miny"] + box["maxy"]) / 2).alias("_y"))
    extent = placed.groupBy(*keys).agg(*[f(c).alias(f"{c}{n}") for c in ("_x", "_y") for f, n in ((F.min, 0), (F.max, 1))])
    per_side = F.ceil(F.sqrt(F.col("_shapes") / run))

    def place(c):
        share = (F.col(c) - F.col(f"{c}0")) / F.nullif(F.col(f"{c}1") - F.col(f"{c}0"), F.lit(0.0))
        return F.coalesce(F.least(F.floor(share * per_side), per_side - 1), F.lit(0))

    placed = placed.join(cut_lineage(extent), keys).select(*keys, "geometry", place("_x").alias("_cx"), place("_y").alias("_cy"))
    cells = [*keys, "_cx", "_cy"]
    crowds = placed.groupBy(*cells).agg(F.ceil(F.count(F.lit(1)) / run).alias("_chunks"))
    # A crowded place is dealt over several runs.
    dealt = placed.join(cut_lineage(crowds), cells).withColumn("_chunk", F.pmod(F.xxhash64("geometry"), F.col("_chunks")))
    runs = dealt.groupBy(*cells, "_chunk").agg(F.flatten(F.collect_list("geometry")).alias("geometry"))
    first = runs.select(*keys, G.union_parts(F.col("geometry"), F.lit(digits)).alias("geometry")).where(F.col("geometry").isNotNull())
    edges = ring_edges(first.unionByName(rows.where(~is_small()).select(*keys, "geometry")), keys, digits)
    parts = polygons(union_boundary(edges, keys, digits, run), keys)
    united = parts.groupBy(*keys).agg(F.array_sort(F.collect_list("rings")).alias("geometry"))
    if not keep:
        return united
    lows = rows.groupBy(*keys).agg(F.min("geometry").alias("_low"), F.max("geometry").alias("_high"))
    kept = lows.join(united, keys, "left")
    return kept.select(*keys, F.when(F.col("_low") == F.col("_high"), F.col("_low")).otherwise(F.coalesce("geometry", "_low")).alias("geometry"))


def boundary_length(geom: Column) -> Column:
    """Length of all rings."""

    def ring(points):
        return G._edges(points, F.lit(0.0), lambda acc, p, q: acc + F.hypot(q["x"] - p["x"], q["y"] - p["y"]))

    return F.aggregate(F.flatten(geom), F.lit(0.0), lambda acc, r: acc + ring(r))


# ------------------------------------------------------------------ validity
_HOLE = "hole is not inside its outline, or in a hole"
#: What may be wrong; of several the first is told.
REASONS = ("ring without area", "ring meets itself", "rings cross", "rings share a line", "inside is not connected", _HOLE, "parts overlap")


def invalid_reasons(shapes: DataFrame, key: str, digits: int = DIGITS) -> DataFrame:
    """``key, reason``: the rows whose ``geometry`` is no valid area, each with one reason.

    Rings may not be short, without area, or meet themselves; different rings may touch in single points
    only; holes lie inside their outline and outside each other; parts do not overlap; two rings of a part
    that touch twice cut its inside in two.  (Rings that do so only as a closed chain of three or more are
    not looked for.)  Null and empty geometries are not told about; ``key`` is unique.  Outlines of few
    points are judged where they are, without a shuffle; the others meet edge by edge in joins.
    """
    given = shapes.where(F.size("geometry") > 0).select(key, "geometry")
    told = small_outlines(given, digits).where(F.col("reason").isNotNull()).select(key, "reason")
    large = given.where(~is_small())
    return told if large.isEmpty() else told.unionByName(_reasons_by_edges(large, key, digits))


def judged(shapes: DataFrame, key: str, digits: int = DIGITS) -> DataFrame:
    """The rows with a geometry that is not empty and their ``reason``, NULL where they are valid; without the geometry.

    Outlines of few points are judged on the way to a table that is written once, and then left out of it."""
    given = shapes.where(F.size("geometry") > 0).withColumn("_fault", faults(digits))
    rows = cut_lineage(given.withColumn("geometry", F.when(F.col("_fault") < 0, F.col("geometry"))))
    small = rows.where(F.col("_fault") >= 0).withColumn("reason", _told(F.col("_fault"))).drop("geometry", "_fault")
    large = rows.where(F.col("_fault") < 0).drop("_fault")
    if large.isEmpty():
        return small
    reasons = _reasons_by_edges(large.select(key, "geometry"), key, digits)
    return small.unionByName(large.drop("geometry").join(reasons, key, "left"))


def is_small() -> Column:
    """True for a ``geometry`` of up to ``SMALL`` points."""
    return F.coalesce(F.size(F.flatten(F.flatten("geometry"))) <= SMALL, F.lit(True))


def faults(digits: int = DIGITS) -> Column:
    """Number of the reason why ``geometry`` is not valid, 0 for none, -1 for one of more than ``SMALL`` points."""
    return F.coalesce(G.outline_faults(F.col("geometry"), F.lit(digits), F.lit(SMALL)), F.lit(1))


def _told(fault: Column) -> Column:
    return F.get(F.array(*[F.lit(x) for x in REASONS]), fault - 1)


def _hollow() -> Column:
    odd_ring = lambda r: (F.size(r) < 3) | (G._ring_area(r) == 0)
    bad = F.exists("geometry", lambda part: part.isNull() | (F.size(part) == 0) | F.exists(part, odd_ring))
    return F.coalesce(bad, F.lit(True))


def small_outlines(shapes: DataFrame, digits: int = DIGITS) -> DataFrame:
    """The rows with small outlines and their ``reason``, NULL where they are valid."""
    judged = shapes.withColumn("_fault", faults(digits)).where(F.col("_fault") >= 0)
    return judged.withColumn("reason", _told(F.col("_fault"))).drop("_fault")


def _reasons_by_edges(given: DataFrame, key: str, digits: int) -> DataFrame:
    tol = 0.5 * 10.0**-digits
    flat = given.where(_hollow()).select(key, F.lit(REASONS[0]).alias("reason"))
    edges = ring_edges(given, [key], digits)
    mesh = mesh_of(edges, [key])
    l, r = F.col("l"), F.col("r")  # noqa: E741
    here = lambda e, x, y: on_edge(e, x, y, tol) | ((e["ax"] == x) & (e["ay"] == y)) | ((e["bx"] == x) & (e["by"] == y))
    points = [F.when(here(e, o[f"{p}x"], o[f"{p}y"]), F.struct(o[f"{p}x"].alias("x"), o[f"{p}y"].alias("y"))) for e, o in ((l, r), (r, l)) for p in "ab"]
    one_ring = (l["part"] == r["part"]) & (l["ring"] == r["ring"])
    steps = F.abs(l["pos"] - r["pos"])
    neighbours = one_ring & ((steps == 1) | (steps == l["n"] - 1))
    met = meeting_pairs(edges, mesh, [key], tol).select(
        key, one_ring.alias("one_ring"), neighbours.alias("neighbours"), cross_properly(l, r).alias("crosses"),
        F.array_distinct(F.filter(F.array(*points), lambda p: p.isNotNull())).alias("points"),
        F.when(l["part"] == r["part"], F.struct(l["part"].alias("part"), F.least(l["ring"], r["ring"]).alias("a"), F.greatest(l["ring"], r["ring"]).alias("b"))).alias("rings"),
    ).where(F.col("crosses") | (F.size("points") > 0))
    met = cut_lineage(met)
    n = F.size("points")
    told = F.when(F.col("one_ring") & (F.col("crosses") | (n > 1) | ~F.col("neighbours")), "ring meets itself").when(
        ~F.col("one_ring") & F.col("crosses"), "rings cross"
    ).when(~F.col("one_ring") & (n > 1), "rings share a line")
    pairs = met.select(key, told.alias("reason")).where(F.col("reason").isNotNull())
    touched = met.where(~F.col("one_ring") & F.col("rings").isNotNull()).select(key, "rings", F.explode("points").alias("p")).distinct()
    cut_off = touched.groupBy(key, "rings").count().where("count > 1").select(key, F.lit("inside is not connected").alias("reason"))
    reasons = flat.unionByName(pairs).unionByName(cut_off).unionByName(_misplaced_rings(edges, mesh, key, digits))
    rank = F.array_position(F.array(*[F.lit(x) for x in REASONS]), F.col("reason"))
    return reasons.groupBy(key).agg(F.min_by("reason", rank).alias("reason"))


def _misplaced_rings(edges: DataFrame, mesh: DataFrame, key: str, digits: int) -> DataFrame:
    """Rings of which a piece lies where it may not: along a hole its part's other rings must be around once
    in all (the outline, and no hole), along an outline not at all, and other parts nowhere."""
    several = edges.groupBy(key).agg(F.countDistinct("part", "ring").alias("_k")).where("_k > 1").select(key)
    some = cut_lineage(edges.join(several, key, "left_semi"))
    split = cut_lineage(split_edges(some, mesh, [key], digits, carry=("part", "ring")))
    tops = some.groupBy(key, "part", "ring").agg(F.max(F.greatest("ay", "by")).alias("top"))
    middle = F.struct("part", "ring", *_SEGMENT, ((F.col("lx") + F.col("hx")) / 2).alias("_mx"), ((F.col("ly") + F.col("hy")) / 2).alias("_my"))
    probes = split.join(mesh, key).select(key, "_x0", "_y0", "_s", middle.alias("m"))
    targets = split.join(tops, [key, "part", "ring"]).join(mesh, key)
    targets = targets.select(key, "_x0", "_y0", "_s", F.struct("part", "ring", *_SEGMENT, "sign", "top").alias("t"))
    other = (F.col("m.part") != F.col("t.part")) | (F.col("m.ring") != F.col("t.ring"))
    own = F.col("m.part") == F.col("t.part")
    below = covered_below(probes, targets, [key], other).select(key, "m", F.when(own, F.col("t.sign")).otherwise(0).alias("own"), F.when(own, 0).otherwise(F.col("t.sign")).alias("others"))
    none = probes.select(key, "m", F.lit(0).alias("own"), F.lit(0).alias("others"))
    sums = below.unionByName(none).groupBy(key, "m").agg(F.sum("own").alias("own"), F.sum("others").alias("others"))
    hole = F.col("m.ring") > 0
    told = F.when(F.col("others") != 0, "parts overlap").when(F.col("own") != F.when(hole, 1).otherwise(0), _HOLE)
    return sums.select(key, told.alias("reason")).where(F.col("reason").isNotNull())
