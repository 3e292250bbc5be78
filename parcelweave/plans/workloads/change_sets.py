"""Unions, passes, requests and vintages."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelweave.functions.columns import half_even
from parcelweave.operators import changes as C
from parcelweave.plans.registry import query
from parcelweave.plans.samples import half_even_sql as he


@query("union_sources", """
select cast(c_custkey as string) as aoi_id, c_acctbal as confidence, cast(null as double) as trust_score from customer
union all select cast(s_suppkey as string), null, s_acctbal from supplier""")
def union_sources(t):
    """Two sources with different columns in one table."""
    a = t.customer.select(F.col("c_custkey").cast("string").alias("aoi_id"), F.col("c_acctbal").alias("confidence"))
    b = t.supplier.select(F.col("s_suppkey").cast("string").alias("aoi_id"), F.col("s_acctbal").alias("trust_score"))
    return C.union_sources(a, b)


def _orders(t):
    return t.orders.select(F.col("o_orderkey").alias("aoi_id"))


def _items(t):
    return t.lineitem.select(F.col("l_orderkey").alias("aoi_id"), "l_partkey", "l_suppkey", "l_linenumber")


@query("failed_areas", "select o_orderkey as aoi_id from orders where o_orderkey not in (select l_orderkey from lineitem)")
def failed_areas(t):
    """Areas without any answer."""
    return C.failed_areas(_orders(t), _items(t))


@query("areas_on_both_sides", """
select distinct l_orderkey as aoi_id from lineitem where l_suppkey % 2 = 0 and l_orderkey in (select l_orderkey from lineitem where l_suppkey % 2 = 1)""")
def areas_on_both_sides(t):
    """Areas present in both feature sets."""
    i = _items(t)
    return C.areas_on_both_sides(i.where(F.col("l_suppkey") % 2 == 0), i.where(F.col("l_suppkey") % 2 == 1))


@query("merge_passes", """
with retry as (select distinct l_orderkey from lineitem join orders on l_orderkey = o_orderkey where l_suppkey % 20 = 4 and o_orderstatus <> 'P')
select l_orderkey as aoi_id, l_partkey, 'first' as pass from lineitem where l_orderkey not in (select l_orderkey from retry)
union all select l_orderkey, l_partkey, 'second' from lineitem where l_orderkey in (select l_orderkey from retry)""")
def merge_passes(t):
    """Second-pass rows replace all rows of retried areas; pinned areas are never retried."""
    i = _items(t)
    aois = t.orders.select(F.col("o_orderkey").alias("aoi_id"), F.when(F.col("o_orderstatus") == "P", "pin").alias("survey_resource_id"))
    errors = i.select("aoi_id", F.when(F.col("l_suppkey") % 20 == 4, 404).otherwise(500).alias("status_code"))
    retry = C.retry_areas(errors, aois)
    first = i.select("aoi_id", "l_partkey", F.lit("first").alias("pass"))
    second = i.join(C.hashed(retry), "aoi_id", "left_semi").select("aoi_id", "l_partkey", F.lit("second").alias("pass"))
    return C.merge_passes(first, second, retry)


@query("distinct_requests", "select l_partkey, l_suppkey, count(*) as n_areas from lineitem group by all")
def distinct_requests(t):
    """Equal requests are planned once."""
    return C.distinct_requests(_items(t), ["l_partkey", "l_suppkey"]).drop("request_key")


@query("fan_out_responses", "select l_orderkey as aoi_id, l_linenumber, l_partkey, l_suppkey, l_partkey * 2 as answer from lineitem")
def fan_out_responses(t):
    """Each distinct answer goes back to every area that asked."""
    i = _items(t)
    keys = ["l_partkey", "l_suppkey"]
    answers = C.distinct_requests(i, keys).select("request_key", *keys, (F.col("l_partkey") * 2).alias("answer"))
    return C.fan_out_responses(i, answers, keys).select("aoi_id", "l_linenumber", "l_partkey", "l_suppkey", "answer")


@query("pending_areas", "select o_orderkey as aoi_id from orders where o_orderkey not in (select l_orderkey from lineitem where l_linenumber < 4)")
def pending_areas(t):
    """Areas not yet in the completed rollup."""
    return C.pending_areas(_orders(t), _items(t).where(F.col("l_linenumber") < 4))


@query("rollup_diff", f"""
with v as (select l_orderkey as aoi_id, l_suppkey % 2 as side, count(*) as n, {he('sum(l_quantity)', 2)} as area from lineitem group by all),
b as (select * from v where side = 0), a as (select * from v where side = 1)
select coalesce(b.aoi_id, a.aoi_id) as aoi_id, case when b.aoi_id is null then 'added' when a.aoi_id is null then 'removed'
  when b.n = a.n and b.area = a.area then 'unchanged' else 'changed' end as status,
  b.n as n_before, a.n as n_after, b.area as area_before, a.area as area_after, a.n - b.n as n_delta, a.area - b.area as area_delta
from b full join a on a.aoi_id = b.aoi_id""")
def rollup_diff(t):
    """Two vintages compared: status and deltas."""
    v = t.lineitem.groupBy(F.col("l_orderkey").alias("aoi_id"), (F.col("l_suppkey") % 2).alias("side")).agg(
        F.count(F.lit(1)).alias("n"), half_even(F.sum("l_quantity"), 2).alias("area")
    )
    return C.rollup_diff(v.where(F.col("side") == 0), v.where(F.col("side") == 1), ["n", "area"])
