"""Distribution statistics, histograms and error accounting."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelweave.config import LATENCY_EDGES
from parcelweave.functions.columns import half_even
from parcelweave.operators import profile as P
from parcelweave.operators import stats as S
from parcelweave.plans.registry import query
from parcelweave.plans.samples import half_even_sql as he

_BIN_CASES = " ".join(f"when ms < {hi:e} then {i}" for i, hi in enumerate(LATENCY_EDGES[1:]))
_MS = "with e as (select event_type, user_id, value * 1e2 as ms from events)"
_BINS = f"{_MS}, b as (select *, case {_BIN_CASES} else 12 end as bin from e where ms >= 0)"


def _latencies(t):
    return t.events.select("event_type", "user_id", (F.col("value") * 100.0).alias("ms"))


@query("latency_stats", f"""{_MS} select event_type, {he('avg(ms)', 4)} as mean, min(ms) as min, max(ms) as max, count(*) as count,
  {', '.join(f"{he(f'quantile_cont(ms, {p} / 1e2)', 6)} as p{p}" for p in (50, 90, 95, 99))} from e group by event_type""")
def latency_stats(t):
    """Mean, exact percentiles and extremes per group."""
    s = S.latency_stats(_latencies(t), ["event_type"], "ms")
    return s.select(
        "event_type", half_even(F.col("mean"), 4).alias("mean"), "min", "max", "count", *[half_even(F.col(f"p{p}"), 6).alias(f"p{p}") for p in (50, 90, 95, 99)]
    )


@query("latency_histograms", f"{_BINS} select event_type, bin, count(*) as n from b group by all")
def latency_histograms(t):
    """Counts per bin, empty bins left out."""
    s = _latencies(t).groupBy("event_type").agg(S.histogram(F.col("ms")).alias("h"))
    return s.select("event_type", F.posexplode("h").alias("bin", "n")).where(F.col("n") > 0)


def _merged_sql() -> str:
    pieces = []
    edges = list(LATENCY_EDGES)
    for p in (50, 90, 95, 99):
        pick = "first(case when bin = 12 then lo else lo + (total * {p} / 1e2 - before) / n * (hi - lo) end order by bin) filter (upto >= total * {p} / 1e2)".format(p=p)
        pieces.append(f"{he(pick, 6)} as p{p}")
    los = "[" + ", ".join(f"{e:e}" for e in edges) + "]"
    return f"""{_BINS}, c as (select bin, count(*) as n from b group by bin),
    w as (select bin, n, sum(n) over (order by bin) as upto, sum(n) over (order by bin) - n as before, sum(n) over () as total,
      {los}[bin + 1] as lo, {los}[bin + 2] as hi from c)
    select cast(max(total) as bigint) as count, {', '.join(pieces)} from w"""


@query("merged_histogram_percentiles", _merged_sql())
def merged_histogram_percentiles(t):
    """Histograms per user merged, percentiles by interpolation inside the bin."""
    per_user = _latencies(t).groupBy("user_id").agg(S.histogram(F.col("ms")).alias("histogram"))
    m = S.merge_histograms(per_user, [])
    h = F.col("histogram")
    return m.select(
        F.aggregate(h, F.lit(0).cast("bigint"), lambda a, x: a + x).alias("count"),
        *[half_even(S.histogram_percentile(h, p), 6).alias(f"p{p}") for p in (50, 90, 95, 99)],
    )


def _bootstrap_sql(reps: int) -> str:
    """All replicates in SQL: Poisson weights from the same digests, then percentiles as above for each."""
    weight = " + ".join(f"(u >= {t})::bigint" for t in S.POISSON)
    los = "[" + ", ".join(f"{e:e}" for e in LATENCY_EDGES) + "]"

    def percentile(p: int) -> str:
        return f"first(case when bin = 12 then lo else lo + (total * {p} / 1e2 - before) / n * (hi - lo) end order by bin) filter (upto >= total * {p} / 1e2)"

    ends = ", ".join(f"{he(f'quantile_cont(p{p}, {q})', 6)} as p{p}_{e}" for p in (50, 90, 95, 99) for q, e in ((0.025, "low"), (0.975, "high")))
    return f"""{_BINS}, per_user as (select cast(user_id as string) as k, bin, count(*) as n from b group by all),
    draws as (select k, r, cast('0x' || substr(md5('42|' || cast(r // 8 as string) || '|' || k), 4 * (r % 8) + 1, 4) as bigint) as u
      from (select distinct k from per_user), generate_series(0, {reps - 1}) g(r)),
    weighted as (select r, bin, sum(n * w) as n from (select k, r, {weight} as w from draws) join per_user using (k) where w > 0 group by r, bin
      union all select -1, bin, sum(n) from per_user group by bin),
    c as (select r, bin, n, sum(n) over (partition by r order by bin) as upto, sum(n) over (partition by r order by bin) - n as before,
      sum(n) over (partition by r) as total, {los}[bin + 1] as lo, {los}[bin + 2] as hi from weighted),
    q as (select r, {', '.join(f'{percentile(p)} as p{p}' for p in (50, 90, 95, 99))} from c group by r)
    select (select count(*) from e) as count, (select {he('avg(ms)', 4)} from e) as mean,
      {', '.join(f"(select {he(f'p{p}', 6)} from q where r = -1) as p{p}" for p in (50, 90, 95, 99))}, {ends} from q where r >= 0"""


@query("global_latency_stats", _bootstrap_sql(200))
def global_latency_stats(t):
    """Global mean and percentiles with bootstrap intervals over users as chunks."""
    chunks = _latencies(t).groupBy("user_id").agg(
        F.count(F.lit(1)).alias("count"), F.avg("ms").alias("mean"), S.histogram(F.col("ms")).alias("histogram")
    )
    g = S.global_stats(chunks, "user_id", n_bootstrap=200)
    ends = [half_even(F.col(f"p{p}_ci")[i], 6).alias(f"p{p}_{e}") for p in (50, 90, 95, 99) for i, e in enumerate(("low", "high"))]
    return g.select("count", half_even(F.col("mean"), 4).alias("mean"), *[half_even(F.col(f"p{p}"), 6).alias(f"p{p}") for p in (50, 90, 95, 99)], *ends)


@query("error_summary", """
with e as (select 400 + page_id % 5 as status_code, 'failed: ' || url || ' again' as message from pages)
select 'status_code' as kind, cast(status_code as string) as value, count(*) as count from e group by all
union all select 'message', array_to_string(list_transform(string_split(message, ' '),
  lambda w: case when contains(w, '://') and contains(w, '?') then split_part(w, '?', 1) || '?...' else w end), ' '), count(*) from e group by all""")
def error_summary(t):
    """Errors by status and by message without URL queries."""
    e = t.pages.select((F.col("page_id") % 5 + 400).alias("status_code"), F.concat(F.lit("failed: "), F.col("url"), F.lit(" again")).alias("message"))
    return S.error_summary(e)


@query("cache_hit_rate", """
select cast(sum(l_linenumber) as bigint) as cache_hits, cast(sum(l_linenumber + l_suppkey) as bigint) as checked,
  sum(l_linenumber) / cast(sum(l_linenumber + l_suppkey) as double) as hit_rate from lineitem""")
def cache_hit_rate(t):
    """Share of requests answered from the cache."""
    return S.cache_hit_rate(t.lineitem.select(F.col("l_linenumber").alias("cache_hits"), F.col("l_suppkey").alias("cache_misses")))


def _failed(t, k):
    return t.lineitem.where(F.col("l_partkey") % k == 0).select(F.col("l_orderkey").alias("aoi_id"))


@query("error_budget", """
select count(*) as areas, count(*) filter (bad) as failed, cast(floor(count(*) * 25e-2) as bigint) as allowed, count(*) filter (bad) > floor(count(*) * 25e-2) as exceeded
from (select o_orderkey in (select l_orderkey from lineitem where l_partkey % 7 = 0) as bad from orders)""")
def error_budget(t):
    """Failed areas against the allowed share."""
    return S.error_budget(t.orders.select(F.col("o_orderkey").alias("aoi_id")), _failed(t, 7), 25.0)


@query("success_flags", """
select o_orderkey as aoi_id, case when o_orderkey in (select l_orderkey from lineitem where l_partkey % 7 = 0) then 'N' else 'Y' end as feature_api_success,
  case when o_orderkey in (select l_orderkey from lineitem where l_partkey % 11 = 0) then 'N' else 'Y' end as roof_age_api_success from orders""")
def success_flags(t):
    """Y/N per area and source."""
    return S.success_flags(t.orders.select(F.col("o_orderkey").alias("aoi_id")), {"feature_api": _failed(t, 7), "roof_age_api": _failed(t, 11)})


@query("error_sample")
def error_sample(t):
    """A few errors other than 404 for a report."""
    e = t.lineitem.select(F.col("l_orderkey").alias("aoi_id"), (F.col("l_suppkey") % 2 * 100 + 404).alias("status_code"), F.col("l_returnflag").alias("message"))
    return S.error_sample(e)


@query("column_profile", " union all ".join(
    f"""select '{c}' as "column", '{ty}' as type, count(*) as n_rows, 1e0 - count({c}) / cast(count(*) as double) as null_rate,
    count(distinct {c}) as n_distinct, '{d}' as description from (select *, case when c_custkey % 3 = 0 then null else c_mktsegment end as primary_roof_present from customer)"""
    for c, ty, d in (("c_custkey", "bigint", "?"), ("c_nationkey", "int", "?"), ("primary_roof_present", "string", "Property of the primary roof"))))
def column_profile(t):
    """Null rate and exact distinct count per column, joined to the naming rules."""
    df = t.customer.select("c_custkey", "c_nationkey", F.when(F.col("c_custkey") % 3 != 0, F.col("c_mktsegment")).alias("primary_roof_present"))
    return P.profile_with_dictionary(df).select("column", "type", "n_rows", "null_rate", "n_distinct", "description")
