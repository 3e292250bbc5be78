"""Column profile joined to a dictionary of naming rules."""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Rule:
    """Documentation of columns: by exact name, by unit template, by scope prefix, or by pattern."""

    kind: str  # exact | template | prefix | pattern
    match: str
    description: str
    unit: str = ""


DEFAULT_RULES = (
    Rule("exact", "aoi_id", "Identifier of the area"),
    Rule("template", r"(.*)_area_(sqm|sqft)", "Area", "{1}"),
    Rule("prefix", "primary_", "Property of the primary feature of its class"),
    Rule("prefix", "primary_roof_", "Property of the primary roof"),
    Rule("pattern", r".*_count$", "Number of features", "count"),
    Rule("pattern", r".*_confidence$", "Confidence between 0 and 1"),
    Rule("pattern", r".*_present$", "Y if at least one feature was found, else N"),
)


def describe_column(name: str, rules: Sequence[Rule] = DEFAULT_RULES) -> tuple[str, str]:
    """(description, unit): exact, then template, then longest prefix, then first pattern, else '?'."""
    for r in rules:
        if r.kind == "exact" and r.match == name:
            return r.description, r.unit
    for r in rules:
        if r.kind == "template" and (m := re.fullmatch(r.match, name)):
            groups = m.groups()
            return r.description, re.sub(r"\{(\d)\}", lambda k: groups[int(k.group(1))], r.unit)
    scoped = [r for r in rules if r.kind == "prefix" and name.startswith(r.match)]
    if scoped:
        best = max(scoped, key=lambda r: len(r.match))
        return best.description, best.unit
    for r in rules:
        if r.kind == "pattern" and re.search(r.match, name):
            return r.description, r.unit
    return "?", ""


def profile(df: DataFrame, *, exact_distinct: bool = True) -> DataFrame:
    """(column, type, n_rows, null_rate, min, max, n_distinct).

    Rows, NULLs and typed extremes are one aggregate without grouping.  The exact distinct count
    collapses equal values per task before it shuffles, so a column dominated by one value costs
    little; the sketch (``exact_distinct=False``) needs no further pass.
    """
    names = df.columns
    count = {c: F.count(F.col(f"`{c}`")) for c in names}
    stats = df.agg(
        F.count(F.lit(1)).alias("_rows"),
        F.array(
            *[
                F.struct(
                    F.lit(c).alias("column"), F.lit(t).alias("type"), count[c].alias("filled"),
                    F.min(F.col(f"`{c}`")).cast("string").alias("min"), F.max(F.col(f"`{c}`")).cast("string").alias("max"),
                    F.approx_count_distinct(F.col(f"`{c}`")).alias("about") if not exact_distinct else F.lit(None).cast("bigint").alias("about"),
                )
                for c, t in df.dtypes
            ]
        ).alias("_columns"),
    ).select("_rows", F.explode("_columns").alias("s")).select(
        "s.column", "s.type", F.col("_rows").alias("n_rows"),
        (1 - F.col("s.filled") / F.nullif("_rows", F.lit(0))).alias("null_rate"), "s.min", "s.max", "s.about",
    )
    if not exact_distinct:
        return stats.withColumnRenamed("about", "n_distinct")
    cells = df.select(
        F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(f"`{c}`").cast("string").alias("value")) for c in names])).alias("c")
    ).select("c.column", "c.value").where(F.col("value").isNotNull())
    distinct = cells.distinct().groupBy("column").agg(F.count(F.lit(1)).alias("n_distinct"))
    return stats.drop("about").join(distinct, "column", "left").withColumn("n_distinct", F.coalesce("n_distinct", F.lit(0)))


def profile_with_dictionary(df: DataFrame, rules: Sequence[Rule] = DEFAULT_RULES, **kwargs) -> DataFrame:
    """Profile plus description and unit per column."""
    docs = {c: describe_column(c, rules) for c in df.columns}
    text = F.create_map(*[F.lit(x) for c, (d, _) in docs.items() for x in (c, d)])
    unit = F.create_map(*[F.lit(x) for c, (_, u) in docs.items() for x in (c, u)])
    return profile(df, **kwargs).withColumns({"description": text[F.col("column")], "unit": unit[F.col("column")]})
