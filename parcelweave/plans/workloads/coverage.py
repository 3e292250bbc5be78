"""Survey coverage over points."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelweave.operators import coverage as C
from parcelweave.plans.registry import query
from parcelweave.plans.samples import ctes


def _points(t):
    """Customers as points; only some have survey history."""
    return t.customer.select(F.col("c_custkey").alias("user_id"), "c_nationkey")


@query("points_with_history", ctes("coverage") + "select user_id, event_id, c_nationkey, survey_id from customer right join coverage on c_custkey = user_id")
def points_with_history(t):
    """Points ⋈ coverage history, every history row kept."""
    j = C.points_with_history(_points(t), t.coverage(), "user_id")
    return j.select("user_id", "event_id", "c_nationkey", "survey_id")


@query("latest_survey_per_point", ctes("coverage") + """
select user_id, max("captureDate") as "captureDate", last(survey_id order by "captureDate", event_id) as survey_id,
  last(survey_resource_id order by "captureDate", event_id) filter (survey_resource_id is not null) as survey_resource_id,
  last(aifeatures order by "captureDate", event_id) as aifeatures from coverage group by user_id""")
def latest_survey_per_point(t):
    """Last non-null value of each column by date."""
    return C.latest_per_point(t.coverage(), "user_id", tie_col="event_id", columns=["survey_id", "survey_resource_id", "aifeatures"])


@query("distinct_surveys", ctes("coverage") + """
select survey_id, last(aifeatures order by aifeatures, event_id) as aifeatures, last(event_id order by aifeatures, event_id) as event_id from coverage group by survey_id""")
def distinct_surveys(t):
    """One row per survey, an AI-bearing one if any."""
    return C.distinct_surveys(t.coverage(), tie_cols=["event_id"]).select("survey_id", "aifeatures", "event_id")


@query("points_without_ai", ctes("coverage") + """
select user_id, event_id from coverage where user_id not in (select user_id from coverage where aifeatures and value > 2e2)""")
def points_without_ai(t):
    """History of points without any AI survey."""
    cov = t.coverage().withColumn("aifeatures", F.col("aifeatures") & (F.col("value") > 200.0))
    return C.without_ai_coverage(cov, "user_id").select("user_id", "event_id")


@query("coverage_fractions", ctes("coverage") + """
, p as (select c_custkey as user_id, bool_or(aifeatures and value > 2e2) as ai from customer left join coverage on c_custkey = user_id group by 1)
select count(*) as points, count(ai) as with_imagery, count(*) filter (ai) as with_ai, count(ai) / cast(count(*) as double) as imagery_fraction,
  count(*) filter (ai) / cast(count(*) as double) as ai_fraction, count(*) filter (ai) / cast(count(ai) as double) as ai_given_imagery from p""")
def coverage_fractions(t):
    """Shares of points with imagery and with AI."""
    cov = t.coverage().withColumn("aifeatures", F.col("aifeatures") & (F.col("value") > 200.0))
    return C.coverage_fractions(_points(t), cov, "user_id")


@query("greedy_survey_cover")
def greedy_survey_cover(t):
    """Greedy cover of all points by surveys."""
    return C.greedy_cover(t.coverage().select("user_id", "survey_id", "captureDate"), "user_id")


_EVENTS = """
, s as (select user_id, case when event_id % 3 <> 0 then 'ev' || cast(event_id % 5 as string) end as event_id,
  case when event_id % 5 = 1 then null else cast(cast('2024-01-01' as date) + cast(event_id % 5 as int) as string) end as event_date from coverage)
, e as (select distinct user_id, event_id, event_date from s where event_id is not null)
"""


@query("latest_event_per_point", ctes("coverage") + _EVENTS + """
select user_id, first(event_id order by event_date desc nulls last, event_id) as event_id,
  first(event_date order by event_date desc nulls last, event_id) as event_date, count(*) as n_events from e group by user_id""")
def latest_event_per_point(t):
    """Newest event at each point, a missing date last."""
    e = F.col("event_id")
    s = t.coverage().select(
        "user_id", F.when(e % 3 != 0, F.concat(F.lit("ev"), (e % 5).cast("string"))).alias("event_id"), F.lit("n").alias("event_name"),
        F.when(e % 5 != 1, F.date_add(F.lit("2024-01-01").cast("date"), (e % 5).cast("int")).cast("string")).alias("event_date"), F.lit("fire").alias("event_type"),
    )
    return C.latest_event_per_point(s, "user_id").select("user_id", "event_id", "event_date", "n_events")


@query("discover_events", """
with feet as (select event_type as event_id, cast(user_id % 40 as double) as x1, cast(event_id % 30 as double) as y1,
  cast(user_id % 40 + 1 + event_id % 6 as double) as x2, cast(event_id % 30 + 1 + user_id % 5 as double) as y2,
  case event_type when 'view' then '2024-03-01' when 'click' then '2024-02-01' when 'error' then '2024-04-01' end as event_date from events),
pts as (select c_custkey, cast(c_custkey % 50 as double) + 25e-2 as lon, cast(c_nationkey as double) + 75e-2 as lat from customer),
hits as (select distinct c_custkey, event_id, event_date from pts join feet on lon > x1 and lon < x2 and lat > y1 and lat < y2)
select c_custkey, first(event_id order by event_date desc nulls last, event_id) as event_id, count(*) as n_events from hits group by c_custkey""")
def discover_events(t):
    """Latest event whose footprint contains each point."""
    from parcelweave.plans.workloads.grids import _feet

    dates = F.create_map(*[F.lit(x) for x in ("view", "2024-03-01", "click", "2024-02-01", "error", "2024-04-01")])
    feet = _feet(t).select(
        "event_id", F.lit("n").alias("event_name"), dates[F.col("event_id")].alias("event_date"), F.lit("fire").alias("event_type"), "geometry"
    )
    pts = t.customer.select("c_custkey", ((F.col("c_custkey") % 50) + 0.25).cast("double").alias("lon"), (F.col("c_nationkey") + 0.75).cast("double").alias("lat"))
    return C.discover_events(pts, feet, "c_custkey", cell_size=8.0).select("c_custkey", "event_id", "n_events")
