"""Survey coverage over points: latest surveys, fractions, events and greedy cover."""

from __future__ import annotations

import functools
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from parcelweave.functions import geometry as G
from parcelweave.operators.outlines import dissolve
from parcelweave.session import cut_lineage, spread


def points_with_history(points: DataFrame, history: DataFrame, key: str) -> DataFrame:
    """Every history row with its point's columns (right join)."""
    return points.join(history, key, "right")


def latest_per_point(
    coverage: DataFrame, key: str, *, date_col: str = "captureDate", tie_col: str = "survey_id",
    columns: Sequence[str] | None = None,
) -> DataFrame:
    """Last non-null value of each column by date: one row per point."""
    cols = columns or [c for c in coverage.columns if c not in (key, date_col)]

    def last(c):
        order = F.struct(F.col(date_col), F.col(tie_col))
        return F.max_by(c, F.when(F.col(c).isNotNull(), order)).alias(c)

    return coverage.groupBy(key).agg(F.max(date_col).alias(date_col), *[last(c) for c in cols])


def distinct_surveys(coverage: DataFrame, *, flag_col: str = "aifeatures", tie_cols: Sequence[str] = ()) -> DataFrame:
    """One row per survey, preferring a row that carries AI features."""
    others = [c for c in coverage.columns if c != "survey_id"]
    order = F.struct(F.col(flag_col), *[F.col(c) for c in tie_cols])
    return coverage.groupBy("survey_id").agg(F.max_by(F.struct(*others), order).alias("r")).select("survey_id", "r.*")


def without_ai_coverage(coverage: DataFrame, key: str, *, flag_col: str = "aifeatures") -> DataFrame:
    """Coverage rows of points that have no AI survey at all."""
    covered = coverage.where(F.col(flag_col)).select(key).distinct()
    return coverage.join(covered, key, "left_anti")


def coverage_fractions(points: DataFrame, coverage: DataFrame, key: str, *, flag_col: str = "aifeatures") -> DataFrame:
    """One row: share of points with imagery, with AI, and with AI among those with imagery."""
    per_point = coverage.groupBy(key).agg(F.coalesce(F.bool_or(flag_col), F.lit(False)).alias("ai"))
    joined = points.select(key).join(per_point, key, "left")
    n, seen, ai = F.count(F.lit(1)), F.count("ai"), F.count_if(F.coalesce("ai", F.lit(False)))
    return joined.agg(
        n.alias("points"), seen.alias("with_imagery"), ai.alias("with_ai"),
        (seen / F.nullif(n, F.lit(0))).alias("imagery_fraction"),
        (ai / F.nullif(n, F.lit(0))).alias("ai_fraction"),
        (ai / F.nullif(seen, F.lit(0))).alias("ai_given_imagery"),
    )


def greedy_cover(coverage: DataFrame, key: str, *, budget: int | None = None) -> DataFrame:
    """``rank, survey_id, captureDate, points, open_points``: a greedy cover, in order.

    Each survey covers most points not yet covered; equal counts take the smaller survey id.  Rounds
    go on until no point is left, or up to ``budget``; ``open_points`` says how many are left after
    each.  The shrinking list of open (point, survey) pairs and each round's choice are written out,
    so plans stay flat and the driver only learns whether a round chose anything.
    """
    open_pairs = cut_lineage(
        coverage.where(F.col("survey_id").isNotNull()).groupBy(key, "survey_id").agg(F.min("captureDate").alias("captureDate"))
    )
    rounds: list[DataFrame] = []
    while budget is None or len(rounds) < budget:
        best = F.min(F.struct((-F.col("n")).alias("order"), "survey_id", "n", "day"))
        counts = open_pairs.groupBy("survey_id").agg(F.count(F.lit(1)).alias("n"), F.min("captureDate").alias("day"))
        top = cut_lineage(counts.agg(best.alias("b")).where(F.col("b").isNotNull()).select("b.*"))
        choice = top.first()
        if choice is None:
            break
        gone = open_pairs.where(F.col("survey_id") == F.lit(choice["survey_id"])).select(key)
        open_pairs = cut_lineage(open_pairs.join(gone, key, "left_anti"), replaces=open_pairs)
        left = open_pairs.agg(F.count_distinct(key).alias("open_points"))
        rounds.append(
            cut_lineage(
                top.crossJoin(left).select(  # one row by one row
                    F.lit(len(rounds)).alias("rank"), "survey_id", F.col("day").alias("captureDate"), F.col("n").alias("points"), "open_points"
                )
            )
        )
    if not rounds:
        none = coverage.where(F.lit(False))
        return none.select(F.lit(0).alias("rank"), "survey_id", "captureDate", *[F.lit(0).cast("bigint").alias(c) for c in ("points", "open_points")])
    return functools.reduce(DataFrame.unionByName, rounds)


def latest_event_per_point(surveys: DataFrame, key: str) -> DataFrame:
    """(key, event_id, event_name, event_date, event_type, n_events, other_event_ids).

    Surveys of one event collapse to one entry first; the newest event date wins, a missing date
    comes last, equal dates take the smaller id.
    """
    events = surveys.where(F.col("event_id").isNotNull() & (F.col("event_id") != "")).groupBy(key, "event_id").agg(
        F.min(F.struct("event_name", "event_date", "event_type")).alias("info")
    )
    date = F.col("info.event_date")
    ranked = events.groupBy(key).agg(
        F.min_by(
            F.struct("event_id", "info"),
            F.struct(
                date.isNull().alias("missing"),
                (-F.unix_date(date.try_cast("date"))).alias("newest"),
                F.col("event_id").alias("tie"),
            ),
        ).alias("top"),
        F.count(F.lit(1)).alias("n_events"),
        F.array_sort(F.collect_set("event_id")).alias("ids"),
    )
    return ranked.select(
        key, F.col("top.event_id").alias("event_id"), "top.info.event_name", "top.info.event_date", "top.info.event_type",
        "n_events", F.array_remove("ids", F.col("top.event_id")).alias("other_event_ids"),
    )


def footprints_at_points(
    points: DataFrame, footprints: DataFrame, key: str, *, x_col: str = "lon", y_col: str = "lat", cell_size: float = 0.05
) -> DataFrame:
    """Points ⋈ the footprints that contain them.

    Footprints are cut to cells, so a point meets only the piece of its own cell and no large
    outline is repeated per point.
    """
    b = F.col("_b")
    span = lambda lo, hi: F.sequence(F.floor(lo / cell_size), F.floor(hi / cell_size))
    s = F.lit(cell_size)
    cells = (
        footprints.withColumn("_b", G.bbox(F.col("geometry"))).where(b.isNotNull())
        .withColumn("_cx", F.explode(span(b["minx"], b["maxx"])))
        .withColumn("_cy", F.explode(span(b["miny"], b["maxy"])))
    )
    pieces = (
        spread(cells, "_cx", "_cy", "_b")
        .withColumn(
            "geometry",
            G.clip_to_box(F.col("geometry"), F.col("_cx") * s, F.col("_cy") * s, (F.col("_cx") + 1) * s, (F.col("_cy") + 1) * s),
        )
        .where(F.col("geometry").isNotNull()).drop("_b")
    )
    located = points.withColumns({"_cx": F.floor(F.col(x_col) / s), "_cy": F.floor(F.col(y_col) / s)})
    inside = G.contains_point(F.col("geometry"), F.col(x_col), F.col(y_col))
    return located.join(pieces, ["_cx", "_cy"]).where(inside).drop("_cx", "_cy", "geometry")


def _places(points: DataFrame, x_col: str, y_col: str) -> DataFrame:
    """``_place, lon, lat`` of the distinct places of points."""
    x, y = F.col(x_col).cast("double").alias("lon"), F.col(y_col).cast("double").alias("lat")
    return points.select(x, y).where("lon is not null and lat is not null").distinct().withColumn("_place", F.struct("lon", "lat"))


def _at(points: DataFrame, per_place: DataFrame, x_col: str, y_col: str) -> DataFrame:
    """Points ⋈ what is known of their place."""
    place = F.struct(F.col(x_col).cast("double").alias("lon"), F.col(y_col).cast("double").alias("lat"))
    return points.withColumn("_place", place).join(per_place, "_place").drop("_place")


def count_footprints_at_points(
    points: DataFrame, footprints: DataFrame, key: str, by: Sequence[str], *, x_col: str = "lon", y_col: str = "lat", cell_size: float = 0.05
) -> DataFrame:
    """(key, by, n): how many footprints of each ``by`` group contain each point.

    Points of one place and footprints of one outline meet once and are counted, so that copies on both
    sides are not multiplied.
    """
    shapes = footprints.groupBy(*by, "geometry").agg(F.count(F.lit(1)).alias("_n"))
    hits = footprints_at_points(_places(points, x_col, y_col), shapes, "_place", cell_size=cell_size)
    per_place = hits.groupBy("_place", *by).agg(F.sum("_n").alias("_n"))
    found = _at(points.select(key, x_col, y_col), per_place, x_col, y_col)
    return found.groupBy(key, *by).agg(F.sum("_n").alias("n"))


def discover_events(
    points: DataFrame, footprints: DataFrame, key: str, *, x_col: str = "lon", y_col: str = "lat", cell_size: float = 0.05
) -> DataFrame:
    """Latest event per point from footprints that carry event columns.

    Footprints of one event and outline meet the distinct places of the points once, and a place hands on
    one row per event.
    """
    info = ("event_name", "event_date", "event_type")

    def one(df, *keys):
        return df.groupBy(*keys).agg(F.min(F.struct(*info)).alias("_info")).select(*keys, "_info.*")

    tagged = footprints.where(F.col("event_id").isNotNull() & (F.col("event_id") != ""))
    hits = footprints_at_points(_places(points, x_col, y_col), one(tagged, "event_id", "geometry"), "_place", cell_size=cell_size)
    return latest_event_per_point(_at(points.select(key, x_col, y_col), one(hits, "_place", "event_id"), x_col, y_col), key)


def event_boundary(footprints: DataFrame, *, since: str | None = None, until: str | None = None) -> DataFrame:
    """(event_id, footprints, first_capture, last_capture, geometry): the area that an event's surveys cover
    together, as one outline without overlaps.

    ``since`` and ``until`` (inclusive dates) give the boundary as of a point in time, as it grows while
    captures land.  Rows without an event or an outline are left out.
    """
    day = F.to_date("captureDate")
    rows = footprints.where(F.col("event_id").isNotNull() & (F.col("event_id") != "") & F.col("geometry").isNotNull())
    if since is not None:
        rows = rows.where(day >= F.lit(since).cast("date"))
    if until is not None:
        rows = rows.where(day <= F.lit(until).cast("date"))
    rows = cut_lineage(rows.select("event_id", day.alias("day"), "geometry"))
    counts = rows.groupBy("event_id").agg(F.count(F.lit(1)).alias("footprints"), F.min("day").alias("first_capture"), F.max("day").alias("last_capture"))
    # The same tile is flown again and again: its outline is needed once.
    return counts.join(dissolve(rows.select("event_id", "geometry").distinct(), ["event_id"]), "event_id")
