"""Distribution statistics, histograms and error accounting."""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from parcelweave.config import LATENCY_EDGES
from parcelweave.functions.columns import strip_url_query

PERCENTILES = (50, 90, 95, 99)
BRACKET = 0.0005
SKETCH_ACCURACY = 10_000
BINS = 1024
# Below this size a bracket would be narrower than a few ranks: the whole group is its bracket.
SMALL_GROUP = 8_000


def histogram(value: Column, edges: Sequence[float] = LATENCY_EDGES) -> Column:
    """Aggregate: counts per bin [edge, next edge), the last bin open-ended."""
    uppers = list(edges[1:]) + [None]
    bins = [
        F.count_if((value >= lo) & (F.lit(True) if hi is None else value < hi)) for lo, hi in zip(edges, uppers)
    ]
    return F.array(*bins)


def _bracket_bin(v: Column, low: Column, high: Column) -> Column:
    """Bin of a value between two bounds, -1 below and ``BINS`` above; never falls as the value grows."""
    share = (v / 2 - low / 2) / (high / 2 - low / 2)
    even = (low > float("-inf")) & (high < float("inf")) & (low < high)
    inner = F.when(even, F.least(F.floor(share * BINS).cast("int"), F.lit(BINS - 1))).otherwise(0)
    return F.when(v < low, -1).when(v > high, BINS).otherwise(inner)


def exact_percentiles(df: DataFrame, keys: list[str], value: str, percentiles: Sequence[float]) -> DataFrame:
    """(keys, p<NN>...): exact percentiles with linear interpolation, by distributed selection.

    Three passes, each one aggregate with map-side combining.  A mergeable sketch brackets each wanted
    rank (small groups are their own bracket, as ranks lie further apart there than the sketch's error).
    Every row is then placed in one of ``BINS`` bins of each bracket; as values lie on a line, the places for
    all brackets together take few distinct combinations, so one count of combinations says what lies
    below and in which bin a rank is.  Only rows of those bins, about a millionth of a large group, are sorted.
    Values that heap up in one bin cost time, not exactness: equal ones are counted before the sort.
    """
    rows = df.where(F.col(value).isNotNull()).select(*keys, F.col(value).cast("double").alias("_v"))
    probes = [min(max(p / 100 + d, 0.0), 1.0) for p in percentiles for d in (-BRACKET, BRACKET)]
    bounds = rows.groupBy(*keys).agg(
        F.percentile_approx("_v", F.array(*[F.lit(q) for q in probes]), SKETCH_ACCURACY).alias("_q"),
        F.count(F.lit(1)).alias("_n"), F.min("_v").alias("_min"), F.max("_v").alias("_max"),
    )
    small = F.col("_n") < SMALL_GROUP
    places = [
        _bracket_bin(
            F.col("_v"), F.when(small, F.col("_min")).otherwise(F.col("_q")[2 * i]),
            F.when(small, F.col("_max")).otherwise(F.col("_q")[2 * i + 1]),
        )
        for i in range(len(percentiles))
    ]
    placed = rows.join(bounds, keys).select(*keys, "_n", "_v", F.array(*places).alias("_c"))
    cells = placed.groupBy(*keys, "_n", "_c").agg(F.count(F.lit(1)).alias("_k"))
    bins = cells.select(*keys, "_n", "_k", F.posexplode("_c").alias("_i", "_b"))
    bins = bins.groupBy(*keys, "_n", "_i", "_b").agg(F.sum("_k").alias("_k"))
    # At most BINS + 2 rows each.
    upto = F.sum("_k").over(W.partitionBy(*keys, "_i").orderBy("_b").rowsBetween(W.unboundedPreceding, 0))
    rank = F.array(*[F.lit(p / 100.0) for p in percentiles])[F.col("_i")] * (F.col("_n") - 1)
    bins = bins.select(*keys, "_i", "_b", (upto - F.col("_k")).alias("_base"), upto.alias("_upto"), rank.alias("_rank"))
    holds = lambda r, low, high: (r >= low) & (r < high)
    floor, ceil = F.floor("_rank"), F.ceil("_rank")
    chosen = bins.where(holds(floor, F.col("_base"), F.col("_upto")) | holds(ceil, F.col("_base"), F.col("_upto"))).drop("_upto")

    within = F.filter(
        F.transform("_c", lambda b, i: F.struct(i.alias("_i"), b.alias("_b"))), lambda c: (c["_b"] >= 0) & (c["_b"] < BINS)
    )
    near = placed.select(*keys, "_v", F.inline(within)).join(chosen, [*keys, "_i", "_b"])
    near = near.groupBy(*keys, "_i", "_b", "_base", "_rank", "_v").agg(F.count(F.lit(1)).alias("_k"))
    upto = F.sum("_k").over(W.partitionBy(*keys, "_i", "_b").orderBy("_v").rowsBetween(W.unboundedPreceding, 0))
    near = near.withColumn("_hi", upto + F.col("_base")).withColumn("_lo", F.col("_hi") - F.col("_k"))
    at = lambda r: F.max(F.when(holds(r, F.col("_lo"), F.col("_hi")), F.col("_v")))
    found = near.groupBy(*keys, "_i").agg(at(floor).alias("a"), at(ceil).alias("b"))
    missed = F.raise_error(F.lit("a percentile lies outside its bracket")).cast("double")
    point = F.when(F.col("a").isNull() | F.col("b").isNull(), missed).otherwise(
        F.col("a") + (F.col("b") - F.col("a")) * (F.col("_rank") - floor)
    )
    wanted = chosen.groupBy(*keys, "_i").agg(F.max("_rank").alias("_rank"))
    return wanted.join(found, [*keys, "_i"], "left").groupBy(*keys).agg(
        *[F.max(F.when(F.col("_i") == i, point)).alias(f"p{_name(p)}") for i, p in enumerate(percentiles)]
    )


def _name(p: float) -> str:
    return str(p).replace(".", "_")


def latency_stats(df: DataFrame, keys: list[str], value: str, percentiles: Sequence[float] = PERCENTILES) -> DataFrame:
    """Per group: mean, percentiles, min, max, count and histogram."""
    base = df.where(F.col(value).isNotNull()).groupBy(*keys).agg(
        F.avg(value).alias("mean"), F.min(value).alias("min"), F.max(value).alias("max"),
        F.count(F.lit(1)).alias("count"), histogram(F.col(value)).alias("histogram"),
    )
    return base.join(exact_percentiles(df, keys, value, percentiles), keys, "left")


def merge_histograms(df: DataFrame, keys: list[str], column: str = "histogram", bins: int = len(LATENCY_EDGES)) -> DataFrame:
    """Element-wise sum of histograms per key."""
    h = F.col(column)
    return df.groupBy(*keys).agg(F.array(*[F.coalesce(F.sum(h[i]), F.lit(0)) for i in range(bins)]).alias(column))


def histogram_percentile(hist: Column, percentile: float, edges: Sequence[float] = LATENCY_EDGES) -> Column:
    """Percentile by linear interpolation inside its bin.

    The open last bin answers with its lower edge; an empty histogram answers 0.
    """
    n = len(edges)
    total = F.aggregate(hist, F.lit(0).cast("bigint"), lambda a, x: a + x)
    target = total * F.lit(percentile / 100.0)
    start = F.struct(F.lit(0).cast("bigint").alias("seen"), F.lit(None).cast("double").alias("answer"))
    lower = F.array(*[F.lit(float(e)) for e in edges])
    width = F.array(*[F.lit(float(b - a)) for a, b in zip(edges, edges[1:])], F.lit(0.0))
    bins = F.transform(hist, lambda c, i: F.struct(c.alias("c"), F.get(lower, i).alias("lo"), F.get(width, i).alias("w"), i.alias("i")))

    def step(acc, b):
        upto = acc["seen"] + b["c"]
        here = b["lo"] + F.coalesce((target - acc["seen"]) / F.nullif(b["c"].cast("double"), F.lit(0.0)), F.lit(0.0)) * b["w"]
        reached = (upto >= target) | (b["i"] == n - 1)
        return F.struct(
            upto.alias("seen"),
            F.when(acc["answer"].isNotNull(), acc["answer"]).when(reached, here).alias("answer"),
        )

    return F.when(total == 0, F.lit(0.0)).otherwise(F.aggregate(bins, start, step)["answer"])


#: u < POISSON[k] of a 16-bit number u means at most k events where one is expected.
POISSON = [round(65536 * sum(math.exp(-1) / math.factorial(j) for j in range(k + 1))) for k in range(9)]


def _replicate_sums(n: int, seed: int):
    """Function that adds up a task's histograms under ``n`` sets of Poisson weights, one row per set."""

    def run(batches: Iterator) -> Iterator:
        import hashlib

        import numpy as np
        import pyarrow as pa

        total = None
        for batch in batches:
            keys, hists = batch.column(0).to_pylist(), batch.column(1)
            table = hists.flatten().to_numpy(zero_copy_only=False).reshape(len(keys), -1).astype(np.float64)
            for start in range(0, len(keys), 1024):
                drawn = [b"".join(hashlib.md5(f"{seed}|{i}|{k}".encode()).digest() for i in range(-(-n // 8))) for k in keys[start : start + 1024]]
                even = np.frombuffer(b"".join(drawn), dtype=">u2").reshape(len(drawn), -1)[:, :n]
                part = np.searchsorted(POISSON, even, side="right").astype(np.float64).T @ table[start : start + 1024]
                total = part if total is None else total + part
        if total is not None:
            sums = pa.array(list(np.rint(total).astype(np.int64)), pa.list_(pa.int64()))
            yield pa.RecordBatch.from_arrays([pa.array(np.arange(n)), sums], ["_rep", "histogram"])

    return run


def global_stats(
    groups: DataFrame, group_key: str, *, n_bootstrap: int = 1000, seed: int = 42, percentiles: Sequence[int] = PERCENTILES
) -> DataFrame:
    """One row: mean, histogram percentiles and bootstrap 95 % intervals over resampled groups.

    Groups without samples are left out.  A replicate weighs each group by a Poisson number of mean 1, which
    is how often it would be drawn; it comes from the MD5 digest of (seed, replicate, group), so a recomputed
    task repeats it, and each task hands on one sum per replicate however many groups it has.  Replicates that
    draw no group at all do not count.
    """
    used = groups.where(F.col("count") > 0).select(F.col(group_key).cast("string").alias("_key"), "count", "mean", "histogram")
    bins = len(LATENCY_EDGES)
    overall = used.agg(
        (F.sum(F.col("mean") * F.col("count")) / F.sum("count")).alias("mean"), F.sum("count").alias("count"),
        F.array(*[F.coalesce(F.sum(F.col("histogram")[i]), F.lit(0)) for i in range(bins)]).alias("histogram"),
    )
    sums = used.select("_key", "histogram").mapInArrow(_replicate_sums(n_bootstrap, seed), "_rep long, histogram array<bigint>")
    resampled = merge_histograms(sums, ["_rep"]).where(F.aggregate("histogram", F.lit(0).cast("bigint"), lambda a, x: a + x) > 0)
    per_rep = resampled.select(*[histogram_percentile(F.col("histogram"), p).alias(f"p{p}") for p in percentiles])
    ci = per_rep.agg(
        *[F.percentile(f"p{p}", F.array(F.lit(0.025), F.lit(0.975))).alias(f"p{p}_ci") for p in percentiles]
    ).select(F.struct(*[f"p{p}_ci" for p in percentiles])).scalar()
    return overall.select(
        "count", "mean",
        *[histogram_percentile(F.col("histogram"), p).alias(f"p{p}") for p in percentiles],
        ci.alias("_ci"),
    ).select("count", "mean", *[f"p{p}" for p in percentiles], "_ci.*")


def error_summary(errors: DataFrame) -> DataFrame:
    """(kind, value, count): errors by status code and by message without URL queries."""
    kinds = F.explode(
        F.array(
            F.struct(F.lit("status_code").alias("kind"), F.col("status_code").cast("string").alias("value")),
            F.struct(F.lit("message").alias("kind"), strip_url_query(F.col("message")).alias("value")),
        )
    )
    return (
        errors.select(kinds.alias("k")).select("k.kind", "k.value").where(F.col("value").isNotNull())
        .groupBy("kind", "value").agg(F.count(F.lit(1)).alias("count"))
    )


def cache_hit_rate(chunks: DataFrame) -> DataFrame:
    """One row: hits, checked and hit rate; NULL when nothing was checked."""
    hits, checked = F.sum("cache_hits"), F.sum(F.col("cache_hits") + F.col("cache_misses"))
    return chunks.agg(
        F.coalesce(hits, F.lit(0)).alias("cache_hits"), F.coalesce(checked, F.lit(0)).alias("checked"),
        (hits / F.nullif(checked, F.lit(0))).alias("hit_rate"),
    )


def error_budget(aois: DataFrame, errors: DataFrame, max_error_pct: float) -> DataFrame:
    """One row: areas, failed areas, allowed failures (rounded down) and whether it is exceeded."""
    failed = errors.select("aoi_id").distinct().withColumn("_bad", F.lit(1))
    joined = aois.select("aoi_id").join(failed, "aoi_id", "left")
    total, bad = F.count(F.lit(1)), F.count("_bad")
    allowed = F.floor(total * F.lit(max_error_pct / 100.0))
    return joined.agg(
        total.alias("areas"), bad.alias("failed"), allowed.alias("allowed"), (bad > allowed).alias("exceeded")
    )


def require_error_budget(aois: DataFrame, errors: DataFrame, max_error_pct: float) -> None:
    """Raise when more areas failed than allowed."""
    row = error_budget(aois, errors, max_error_pct).first()
    if row["exceeded"]:
        raise RuntimeError(f"{row['failed']} of {row['areas']} areas failed, {row['allowed']} allowed")


def success_flags(aois: DataFrame, errors_by_source: dict[str, DataFrame]) -> DataFrame:
    """``<source>_success`` Y/N per area."""
    out = aois.select("aoi_id")
    for source, errors in errors_by_source.items():
        bad = errors.select("aoi_id").distinct().withColumn("_bad", F.lit(True))
        out = out.join(bad, "aoi_id", "left").withColumn(
            f"{source}_success", F.when(F.col("_bad"), "N").otherwise("Y")
        ).drop("_bad")
    return out


def error_sample(errors: DataFrame, n: int = 5, seed: int = 42) -> DataFrame:
    """At most ``n`` errors other than 404, chosen by a seeded hash (a report, not a data step)."""
    order = F.xxhash64(F.lit(seed), "aoi_id", "status_code", "message")
    return errors.where(F.col("status_code") != 404).orderBy(order).select("aoi_id", "status_code", "message").limit(n)
