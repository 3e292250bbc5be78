"""Area, feature and survey tables derived from the star-schema test tables.

Orders stand for areas, line items for features, users and days for points and surveys.  The
derivations are plain SQL that Spark and the checking engine both read.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelweave.config import BUILDING, BUILDING_LIFECYCLE, POOL, ROOF, ROOF_INSTANCE, SOLAR
from parcelweave.functions import geometry as G
from parcelweave.operators.rollup import FeatureClass
from parcelweave.session import prepare

TRAMPOLINE = "753621ee-0b9f-515e-9bcf-ea40b96612ab"  # never present in the samples

CLASS_CODES = {"AF": ROOF, "NF": BUILDING, "RF": BUILDING_LIFECYCLE, "AO": POOL, "NO": SOLAR, "RO": ROOF_INSTANCE}
CATALOGUE = [
    FeatureClass(ROOF, "Roof", (("gen5", "prod"), ("gen6", "prod"))),
    FeatureClass(BUILDING, "Building", (("gen5", "prod"), ("gen6", "prod"))),
    FeatureClass(BUILDING_LIFECYCLE, "Building Lifecycle"),
    FeatureClass(POOL, "Swimming Pool", (("gen6", "prod"),)),
    FeatureClass(SOLAR, "Solar Panel", (("gen5", "alpha"),)),
    FeatureClass(TRAMPOLINE, "Trampoline", (("gen5", "prod"), ("gen6", "beta"))),
    FeatureClass(ROOF_INSTANCE, "Roof Instance"),
]

_CASES = " ".join(f"when '{k}' then '{v}'" for k, v in CLASS_CODES.items())
FEATURES_SQL = f"""
select cast(l_orderkey as string) as aoi_id,
       cast(l_partkey as string) || '-' || cast(l_suppkey as string) || '-' || cast(l_linenumber as string)
         || '-' || cast(cast(l_shipdate as date) as string) as feature_id,
       case l_returnflag || l_linestatus {_CASES} end as class_id,
       case l_linenumber % 3 when 0 then 'roof' when 1 then 'parcel' else 'other' end as kind,
       l_extendedprice as area_sqm, l_quantity as clipped_area_sqm, l_extendedprice as unclipped_area_sqm,
       1e0 - 2e0 * l_discount as confidence, 1e0 - 2e0 * l_discount as trust_score, 1e0 - l_tax as fidelity,
       l_linenumber % 2 = 0 as multiparcel_feature,
       cast(l_partkey % 12 as double) as x1, cast(l_suppkey % 9 as double) as y1,
       cast(l_partkey % 12 + 1 + cast(l_quantity as int) % 4 as double) as x2,
       cast(l_suppkey % 9 + 1 + l_linenumber % 3 as double) as y2,
       cast(cast(l_shipdate as date) as string) as survey_date,
       l_orderkey, l_partkey, l_suppkey, l_linenumber, l_quantity, l_extendedprice, l_discount, l_tax
from {{lineitem}}
"""
AOIS_SQL = """
select cast(o_orderkey as string) as aoi_id,
       case when o_orderkey % 5 = 0 then null else cast(o_orderkey % 11 as double) + 5e-1 end as lon,
       case when o_orderkey % 5 = 0 then null else cast(o_custkey % 9 as double) + 5e-1 end as lat,
       0e0 as x1, 0e0 as y1, cast(4 + o_orderkey % 10 as double) as x2, cast(3 + o_custkey % 7 as double) as y2,
       o_orderstatus as status, cast(cast(o_orderdate as date) as string) as order_day,
       o_orderkey, o_custkey, o_totalprice
from {orders}
"""
METADATA_SQL = """
select cast(o_orderkey as string) as aoi_id,
       case o_orderkey % 3 when 0 then 'gen5' when 1 then 'gen6' end as system_version,
       cast(cast(o_orderdate as date) as string) as survey_date
from {orders} where o_orderkey % 17 <> 0
"""
COVERAGE_SQL = """
select user_id, cast(ts as date) as "captureDate", 's' || cast(cast(ts as date) as string) || '-' || cast(user_id % 7 as string) as survey_id,
       event_type in ('purchase', 'signup') and value > 15e0 as aifeatures, event_type <> 'view' as tiles,
       event_type = 'error' as "3d", case when event_type = 'click' then 'r' || cast(event_id as string) end as survey_resource_id,
       event_id, value
from {events}
"""


def with_boxes(df: DataFrame) -> DataFrame:
    """Rectangles from x1, y1, x2, y2, with their bounding box as a column of its own."""
    x1, y1, x2, y2 = (F.col(c) for c in ("x1", "y1", "x2", "y2"))
    box = F.struct(x1.alias("minx"), y1.alias("miny"), x2.alias("maxx"), y2.alias("maxy"))
    return df.withColumns({"geometry": G.box(x1, y1, x2, y2), "bbox": box})


class Tables:
    """Parquet tables of one scale folder, read lazily and column-pruned by the plans using them."""

    def __init__(self, spark: SparkSession, folder: str):
        self.spark, self.folder = prepare(spark), folder.rstrip("/")

    def __getattr__(self, name: str) -> DataFrame:
        if name.startswith("_"):
            raise AttributeError(name)
        return self.spark.read.parquet(f"{self.folder}/{name}.parquet")

    def sql(self, text: str, **frames: DataFrame) -> DataFrame:
        return self.spark.sql(text.replace('"captureDate"', "`captureDate`").replace('"3d"', "`3d`"), **frames)

    def features(self, *, geometry: bool = False, rows: DataFrame | None = None, carry: tuple[str, ...] = ()) -> DataFrame:
        """Features of all line items, or of ``rows``, whose columns ``carry`` come along."""
        text = FEATURES_SQL.replace("\nfrom ", f", {', '.join(carry)}\nfrom ") if carry else FEATURES_SQL
        df = self.sql(text, lineitem=self.lineitem if rows is None else rows)
        return with_boxes(df) if geometry else df

    def aois(self, *, geometry: bool = False) -> DataFrame:
        df = self.sql(AOIS_SQL, orders=self.orders)
        return with_boxes(df) if geometry else df

    def metadata(self) -> DataFrame:
        return self.sql(METADATA_SQL, orders=self.orders)

    def coverage(self) -> DataFrame:
        return self.sql(COVERAGE_SQL, events=self.events)


def ctes(*names: str, extra: str = "") -> str:
    """``with`` clause of the derived tables for the checking engine."""
    texts = {
        "features": FEATURES_SQL.format(lineitem="lineitem"),
        "aois": AOIS_SQL.format(orders="orders"),
        "metadata": METADATA_SQL.format(orders="orders"),
        "coverage": COVERAGE_SQL.format(events="events"),
    }
    parts = [f"{n} as ({texts[n]})" for n in names]
    if extra:
        parts.append(extra)
    return "with " + ",\n".join(parts) + "\n"


def half_even_sql(expr: str, digits: int) -> str:
    """Same scale-round-unscale arithmetic as the Spark side."""
    scale = f"1e{digits}"
    return f"(round_even(cast(({expr}) as double) * {scale}, 0) / {scale})" if digits else f"round_even(cast(({expr}) as double), 0)"
