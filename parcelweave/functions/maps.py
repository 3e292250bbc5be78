"""Dynamic column families as per-row maps.

A flattener turns nested payloads into one MAP column per value type.  Picking a declared list of
names out of a map is a projection, so wide tables need no pivot and no shuffle; exploding the
map gives the long form; the set of names, where unknown, is one small distinct.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelweave.functions.columns import let


def entry(name: Column | str, value: Column) -> Column:
    key = F.lit(name) if isinstance(name, str) else name
    return F.struct(key.alias("key"), value.alias("value"))


def to_map(entries: Column) -> Column:
    """Entries -> map; of equal names the last one wins, NULL names and NULL values are left out."""
    kept = F.filter(entries, lambda e: e["key"].isNotNull() & e["value"].isNotNull())

    def last_of_each(s):
        n = F.size(s["entries"])
        return F.filter(s["entries"], lambda e, i: F.array_position(s["backwards"], e["key"]) == n - i)

    def with_keys(k):
        bundle = F.struct(k.alias("entries"), F.reverse(F.transform(k, lambda e: e["key"])).alias("backwards"))
        return let(bundle, last_of_each)

    return F.map_from_entries(let(kept, with_keys))


def pick(source: Column, names: list[str], prefix: str = "", default: Column | None = None) -> dict[str, Column]:
    """Projection of declared names: {prefix+name: map[name]}."""
    out = {}
    for n in names:
        v = source[n]
        out[f"{prefix}{n}"] = v if default is None else F.coalesce(v, default)
    return out


def long_form(df: DataFrame, keys: list[str], source: str) -> DataFrame:
    """One row per (keys, metric)."""
    # An array made of the map is what is exploded: over the map itself the optimizer would put a filter that
    # computes the map, and the texts it comes from, once more.
    entries = F.coalesce(F.map_entries(source), F.array().cast(f"array<struct<key:string,value:{_value_type(df, source)}>>"))
    return df.select(*keys, F.inline(entries).alias("metric", "value"))


def _value_type(df: DataFrame, source: str) -> str:
    return df.select(source).schema[0].dataType.valueType.simpleString()


def metric_names(df: DataFrame, source: str) -> list[str]:
    """Names that occur in a map column; bounded by the catalogue, never by the data."""
    rows = df.select(F.explode(F.map_keys(source)).alias("name")).distinct().collect()
    return sorted(r["name"] for r in rows)
