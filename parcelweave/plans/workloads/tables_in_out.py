"""Sources, sinks and incremental ingest over landed files."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from parcelweave.config import BUILDING, ROOF, ROOF_INSTANCE
from parcelweave.functions import geometry as G
from parcelweave.functions.columns import half_even
from parcelweave.operators import rollup
from parcelweave.plans.registry import query
from parcelweave.plans.samples import CATALOGUE, ctes, half_even_sql as he, with_boxes
from parcelweave.session import scratch_path, shuffles_dropped, spread
from parcelweave.sources import aoi, geoparquet, payloads, sinks
from parcelweave.sources.ids import dense_ids
from parcelweave.streaming import ingest


def _scratch(t, name: str) -> str:
    """A fresh folder that drop_scratch deletes with everything in it."""
    return scratch_path(t.spark, f"{name}-{uuid.uuid4().hex}") + "/data"


def _box_text(kind: str):
    """Outline text of a rectangle as WKT or GeoJSON."""
    x1, y1, x2, y2 = (F.col(c).cast("string") for c in ("x1", "y1", "x2", "y2"))
    corners = [(x1, y1), (x2, y1), (x2, y2), (x1, y2), (x1, y1)]
    if kind == "wkt":
        return F.concat(F.lit("POLYGON(("), F.concat_ws(", ", *[F.concat(x, F.lit(" "), y) for x, y in corners]), F.lit("))"))
    pts = F.concat_ws(",", *[F.concat(F.lit("["), x, F.lit(","), y, F.lit("]")) for x, y in corners])
    return F.concat(F.lit('{"type":"Polygon","coordinates":[['), pts, F.lit("]]}"))


def _box_json():
    """The rectangle as a GeoJSON geometry struct."""
    x1, y1, x2, y2 = (F.col(c) for c in ("x1", "y1", "x2", "y2"))
    ring = F.array(*[F.array(x, y) for x, y in [(x1, y1), (x2, y1), (x2, y2), (x1, y2), (x1, y1)]])
    return F.struct(F.lit("Polygon").alias("type"), F.array(ring).alias("coordinates"))


# ------------------------------------------------------------------ AOI sources
_AOI_AREA = "select aoi_id, (x2 - x1) * (y2 - y1) as area from aois"


@query("read_aois_csv", ctes("aois") + _AOI_AREA)
def read_aois_csv(t):
    """Areas from tab-separated text with WKT."""
    path = _scratch(t, "tsv") + ".tsv"
    # Spread before the texts are made: a table of small rows may be one task's to read.
    spread(t.aois().select("aoi_id", "status", "x1", "y1", "x2", "y2")).select("aoi_id", "status", _box_text("wkt").alias("geometry")).write.option("header", True).option("sep", "\t").csv(path)
    df = aoi.read_aois(t.spark, path)
    return df.select("aoi_id", G.areas(F.col("geometry")).alias("area"))


@query("read_aois_parquet", ctes("aois") + _AOI_AREA)
def read_aois_parquet(t):
    """Areas from parquet with WKB."""
    path = _scratch(t, "wkb") + ".parquet"
    with_boxes(spread(t.aois().select("aoi_id", "x1", "y1", "x2", "y2"))).select("aoi_id", G.to_wkb("geometry").alias("geometry")).write.parquet(path)
    df = aoi.read_aois(t.spark, path)
    return df.select("aoi_id", G.areas(F.col("geometry")).alias("area"))


@query("read_aois_geojson", ctes("aois") + _AOI_AREA)
def read_aois_geojson(t):
    """Areas from GeoJSON feature collections."""
    path = _scratch(t, "geojson") + ".geojson"
    feature = F.concat(
        F.lit('{"type":"Feature","properties":{"aoi_id":"'), F.col("aoi_id"), F.lit('"},"geometry":'), _box_text("geojson"), F.lit("}")
    )
    # A file is one task's work, so there are more files for more areas, not larger ones.
    rows = t.aois().groupBy(F.floor(F.col("o_orderkey") / 2048).alias("file")).agg(
        F.concat(F.lit('{"type":"FeatureCollection","features":['), F.array_join(F.collect_list(feature), ","), F.lit("]}")).alias("value")
    )
    rows.select("value").write.option("maxRecordsPerFile", 1).text(path)
    df = aoi.read_geojson(t.spark, f"{path}/part-*")
    return df.select("aoi_id", G.area(F.col("geometry")).alias("area"))


@query("dense_ids", "select count(*) as n, count(distinct id) as ids, min(id) as lo, max(id) as hi from (select row_number() over () - 1 as id from lineitem)")
def dense_id_range(t):
    """Sequential ids without gaps."""
    df = dense_ids(t.lineitem.select("l_orderkey"), "id")
    return df.agg(F.count(F.lit(1)).alias("n"), F.countDistinct("id").alias("ids"), F.min("id").alias("lo"), F.max("id").alias("hi"))


@query("duplicate_ids", "select cast(l_orderkey as string) as aoi_id, count(*) as count from lineitem group by l_orderkey having count(*) > 1")
def duplicate_ids(t):
    """Area ids that occur more than once."""
    return aoi.duplicate_ids(t.lineitem.select(F.col("l_orderkey").cast("string").alias("aoi_id")))


@query("address_rows", "select c_custkey from customer where c_custkey % 4 <> 0")
def address_rows(t):
    """Address mode needs all four address fields."""
    df = t.customer.select(
        "c_custkey", F.col("c_name").alias("streetAddress"), F.lit("c").alias("city"), F.lit("s").alias("state"), F.when(F.col("c_custkey") % 4 != 0, "z").alias("zip")
    )
    assert aoi.query_mode(df) == "address"
    return aoi.usable_rows(df).select("c_custkey")


# ------------------------------------------------------------------ payloads
def landed(t):
    """One JSON payload per order, built from its line items."""
    # Grouped by area below; shuffled first, so that the payload texts are written by all tasks.
    f = t.features().repartition("aoi_id").withColumn("confidence", F.col("confidence") - 0.004)
    item = F.struct(
        F.col("feature_id").alias("id"), F.col("class_id").alias("classId"), F.col("confidence"), F.col("area_sqm").alias("areaSqm"),
        F.col("clipped_area_sqm").alias("clippedAreaSqm"), F.col("unclipped_area_sqm").alias("unclippedAreaSqm"), F.col("survey_date").alias("surveyDate"),
        (F.col("l_suppkey") % 3 != 0).alias("belongsToParcel"), _box_json().alias("geometry"),
        F.when(F.col("l_partkey") % 2 == 0, F.struct((F.col("l_partkey") % 100).alias("value"))).alias("roofSpotlightIndex"),
        F.when(F.col("multiparcel_feature"), _box_json()).alias("clippedGeometry"),
        F.when(F.col("aoi_id").cast("bigint") % 5 == 0, F.struct((F.col("l_suppkey") % 10).alias("grade"), F.array(F.lit("a"), F.col("kind")).alias("notes"))).alias("siteReview"),
    )
    payload = F.struct(
        F.lit("gen6").alias("systemVersion"), F.lit("http://x/y").alias("link"), F.max("survey_date").alias("surveyDate"), F.lit("sid").alias("surveyId"),
        F.lit("rid").alias("resourceId"), F.lit("Vert").alias("perspective"), F.lit(False).alias("postcat"),
        F.struct(F.struct(F.lit("m9").alias("modelVersion")).alias("roofSpotlightIndex")).alias("versions"), F.collect_list(item).alias("features"),
    )
    return f.groupBy("aoi_id").agg(F.to_json(payload).alias("payload"))


@query("parse_features", ctes("features") + f"""
select aoi_id, feature_id, class_id, {he('confidence - 4e-3', 2)} as confidence, area_sqm, survey_date, multiparcel_feature,
  (x2 - x1) * (y2 - y1) as area, cast(case when l_partkey % 2 = 0 then l_partkey % 100 end as double) as rsi, case when l_partkey % 2 = 0 then 'm9' end as rsi_version,
  case when cast(aoi_id as bigint) % 5 = 0 then l_suppkey % 10 end as review_grade, case when cast(aoi_id as bigint) % 5 = 0 then kind end as review_note
from features where l_suppkey % 3 <> 0""")
def parse_features(t):
    """Payloads → features in parcel mode, with model versions filled in from the top level and unnamed keys kept."""
    from parcelweave.operators.includes import parse_include

    f = payloads.feature_rows(landed(t), parcel_mode=True)
    rsi = parse_include("roof_spotlight_index", F.col("roof_spotlight_index"))
    return f.withColumn("r", rsi).select(
        "aoi_id", "feature_id", "class_id", "confidence", "area_sqm", "survey_date", "multiparcel_feature", G.area(F.col("geometry")).alias("area"),
        F.col("r.value").alias("rsi"), F.col("r.modelVersion").alias("rsi_version"),
        F.variant_get("other", "$.siteReview.grade", "bigint").alias("review_grade"), F.variant_get("other", "$.siteReview.notes[1]", "string").alias("review_note"),
    )


@query("parse_metadata", ctes("features") + """
select aoi_id, 'gen6' as system_version, 'http://x/y?locationMarker' as link, max(survey_date) as survey_date, 'rid' as survey_resource_id, '' as mesh_date from features group by aoi_id""")
def parse_metadata(t):
    """Payloads → one metadata row each."""
    m = payloads.feature_metadata(landed(t))
    return m.select("aoi_id", "system_version", "link", "survey_date", "survey_resource_id", "mesh_date")


@query("unreadable_payloads", ctes("features") + """
select distinct aoi_id, 'payload is not valid JSON' as message from features where cast(aoi_id as bigint) % 7 = 0""")
def unreadable_payloads(t):
    """Payloads cut off on their way are errors, not answers."""
    cut = F.when(F.col("aoi_id").cast("bigint") % 7 == 0, F.substring("payload", 1, 60)).otherwise(F.col("payload"))
    return payloads.unreadable_payloads(landed(t).withColumn("payload", cut)).select("aoi_id", "message")


@query("parse_roof_age", ctes("features") + f"""
select aoi_id, feature_id, kind, area_sqm, survey_date as installation_date, trust_score, 'res' || cast(first_page as string) as resource_id, 'http://m?locationMarker' as map_browser_url
from (select *, min(l_linenumber % 2) over (partition by aoi_id) as first_page from features where class_id = '{ROOF_INSTANCE}')""")
def parse_roof_age(t):
    """Paged roof-age payloads → records; metadata from the first page."""
    f = t.features().where(F.col("class_id") == ROOF_INSTANCE)
    item = F.struct(
        _box_json().alias("geometry"),
        F.struct(F.col("feature_id").alias("hilbertId"), "kind", F.col("area_sqm").alias("area"), F.col("survey_date").alias("installationDate"),
                 F.col("trust_score").alias("trustScore"), F.lit("http://m").alias("mapBrowserUrl")).alias("properties"),
    )
    page = (F.col("l_linenumber") % 2).alias("page")
    pages = f.groupBy("aoi_id", page).agg(F.collect_list(item).alias("features")).select(
        "aoi_id", "page", F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), F.concat(F.lit("res"), F.col("page").cast("string")).alias("resourceId"), "features")).alias("payload")
    )
    r = payloads.roof_age_rows(pages)
    return r.select("aoi_id", "feature_id", "kind", "area_sqm", "installation_date", "trust_score", "resource_id", "map_browser_url")


def _damage_pages(t):
    item = F.struct(
        F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("id"),
        F.when(F.col("event_id") % 500 != 7, F.struct(F.lit("Polygon").alias("type"), F.from_json(F.lit("[[[0,0],[1,0],[1,1],[0,0]]]"), "array<array<array<double>>>").alias("coordinates"))).alias("geometry"),
        F.struct(F.col("value").alias("areaSqm"), F.struct(F.struct(F.col("event_type").alias("rating")).alias("event")).alias("damage")).alias("properties"),
    )
    good = t.events.groupBy(F.col("user_id").cast("string").alias("aoi_id"), (F.col("event_id") % 2).alias("page")).agg(F.collect_list(item).alias("features")).select(
        "aoi_id", "page", F.to_json(F.struct(F.lit("FeatureCollection").alias("type"), F.lit("storm").alias("eventName"), "features")).alias("payload")
    )
    bad = t.customer.where(F.col("c_custkey") % 10 == 0).select(
        (F.col("c_custkey") + 1000000).cast("string").alias("aoi_id"), F.lit(0).cast("bigint").alias("page"), F.lit('{"error": "no access", "code": "E1"}').alias("payload")
    )
    return good.unionByName(bad)


@query("parse_damage", """
select cast(user_id as string) as aoi_id, 'e' || cast(event_id as string) as feature_id, value as area_sqm, event_type as damage_event_rating, 'storm' as event_name
from events where user_id not in (select user_id from events where event_id % 500 = 7)""")
def parse_damage(t):
    """Paged damage payloads → buildings of areas without error."""
    return payloads.damage_rows(_damage_pages(t)).select("aoi_id", "feature_id", "area_sqm", "damage_event_rating", "event_name")


@query("damage_errors", """
select cast(user_id as string) as aoi_id, min('feature missing geometry: e' || cast(event_id as string)) as message from events where event_id % 500 = 7 group by user_id
union all select cast(c_custkey + 1000000 as string), 'no access (code: E1)' from customer where c_custkey % 10 = 0""")
def damage_errors(t):
    """Error bodies and features without an outline."""
    return payloads.damage_errors(_damage_pages(t))


def _survey_payloads(t):
    c = t.coverage()
    one = lambda ids: F.transform(ids, lambda i: F.struct(i.alias("id")))
    res = F.struct(
        F.when(F.col("tiles"), one(F.array(F.lit("t")))).alias("tiles"),
        F.when(F.col("aifeatures"), one(F.array(F.lit("old"), F.concat(F.lit("ai"), F.col("event_id").cast("string"))))).alias("aifeatures"),
    )
    tags = F.struct(F.when(F.col("event_id") % 3 == 0, F.concat(F.lit("ev"), (F.col("event_id") % 5).cast("string"))).alias("postCatEventId"))
    s = F.struct(F.concat(F.col("survey_id"), F.lit("#"), F.col("event_id").cast("string")).alias("id"), F.col("captureDate").cast("string").alias("captureDate"), tags.alias("tags"), res.alias("resources"))
    return c.groupBy(F.col("user_id").cast("string").alias("aoi_id")).agg(F.to_json(F.struct(F.collect_list(s).alias("surveys"))).alias("payload"))


_SURVEYS = ctes("coverage")


@query("parse_surveys", _SURVEYS + """
select cast(user_id as string) as aoi_id, survey_id || '#' || cast(event_id as string) as survey_id, cast("captureDate" as string) as capture_day, tiles, aifeatures, false as has_3d,
  case when aifeatures then 'ai' || cast(event_id as string) end as survey_resource_id, case when event_id % 3 = 0 then 'ev' || cast(event_id % 5 as string) end as event_id from coverage""")
def parse_surveys(t):
    """Coverage payloads → surveys with resource flags, the last AI resource and event tags."""
    s = payloads.survey_events(payloads.survey_rows(_survey_payloads(t)))
    return s.select(
        "aoi_id", "survey_id", F.col("captureDate").cast("date").cast("string").alias("capture_day"), "tiles", "aifeatures", F.col("3d").alias("has_3d"), "survey_resource_id", "event_id"
    )


@query("survey_date_errors", """
select cast(user_id as string) as aoi_id, cast(event_id as string) as survey_id, 'capture date is no date: day ' || cast(event_id as string) as message from events where event_id % 11 = 4""")
def survey_date_errors(t):
    """Surveys whose capture date cannot be read are told about."""
    day = F.when(F.col("event_id") % 11 == 4, F.concat(F.lit("day "), F.col("event_id").cast("string"))).when(F.col("event_id") % 11 != 5, F.date_format("ts", "yyyy-MM-dd"))
    s = F.struct(F.col("event_id").cast("string").alias("id"), day.alias("captureDate"))
    p = t.events.groupBy(F.col("user_id").cast("string").alias("aoi_id")).agg(F.to_json(F.struct(F.collect_list(s).alias("surveys"))).alias("payload"))
    return payloads.survey_date_errors(p)


@query("rejected_cutoffs", ctes("aois") + """
select aoi_id, 'since' as "column", order_day as value from aois where o_orderkey % 3 = 0
union all select aoi_id, 'until', order_day from aois where o_orderkey % 4 = 1""")
def rejected_cutoffs(t):
    """Areas with date limits that the chosen roof-age dataset cannot apply."""
    k = F.col("o_orderkey")
    a = t.aois().withColumns({"since": F.when(k % 3 == 0, F.col("order_day")), "until": F.when(k % 4 == 1, F.col("order_day"))})
    return aoi.rejected_cutoffs(a, "A.0")


@query("survey_resources", _SURVEYS + """
select survey_id || '#' || cast(event_id as string) as survey_id, case when tiles and not aifeatures then 't' end as survey_resource_id,
  case when not (tiles and not aifeatures) then 'expected one resource, found ' || cast((case when tiles then 1 else 0 end) + (case when aifeatures then 2 else 0 end) as string) end as message from coverage""")
def survey_resources(t):
    """Lookup by survey id: exactly one resource, the rest reported."""
    good, bad = payloads.survey_resources(payloads.survey_rows(_survey_payloads(t)))
    g = good.select("survey_id", "survey_resource_id", F.lit(None).cast("string").alias("message"))
    return g.unionByName(bad.select("survey_id", F.lit(None).cast("string").alias("survey_resource_id"), "message"))


# ------------------------------------------------------------------ sinks
@query("geoparquet_round_trip", ctes("features") + "select aoi_id, feature_id, class_id, (x2 - x1) * (y2 - y1) as area from features")
def geoparquet_round_trip(t):
    """Features written as GeoParquet, sorted by class, and read back."""
    path = _scratch(t, "geo")
    f = t.features(geometry=True).select("aoi_id", "feature_id", "class_id", "geometry")
    geoparquet.write_geoparquet(f, path)
    back = aoi.read_table(t.spark, path, "parquet")
    return back.select("aoi_id", "feature_id", "class_id", G.areas(F.col("geometry")).alias("area"))


@query("class_tables", ctes("features") + "select aoi_id, feature_id, class_id from features")
def class_tables(t):
    """Per-class tables, all read back."""
    path = _scratch(t, "classes")
    sinks.write_class_tables(t.features().select("aoi_id", "feature_id", "class_id"), path)
    return t.spark.read.parquet(path).select("aoi_id", "feature_id", "class_id")


@query("csv_output", ctes("features") + """
select aoi_id, feature_id, case when multiparcel_feature then 'Y' else 'N' end as multiparcel_feature, '{"k":' || cast(l_partkey as string) || '}' as extra, cast(clipped_area_sqm as string) as clipped_area_sqm from features""")
def csv_output(t):
    """CSV projection: Y/N, JSON text, one unit family, WKT."""
    path = _scratch(t, "csv")
    f = t.features(geometry=True).withColumn("extra", F.struct(F.col("l_partkey").alias("k"))).withColumn("area_sqft", F.lit(1.0))
    out = sinks.keep_country_units(f.select("aoi_id", "feature_id", "multiparcel_feature", "extra", "clipped_area_sqm", "area_sqft", "geometry"), "au")
    sinks.write_table(out, path, "csv")
    back = t.spark.read.option("header", True).option("escape", '"').csv(path)
    assert "area_sqft" not in back.columns
    return back.select("aoi_id", "feature_id", "multiparcel_feature", "extra", F.col("clipped_area_sqm").cast("double").cast("string").alias("clipped_area_sqm"))


@query("union_parts", """
select cast(c_custkey as bigint) as k, cast(c_nationkey as double) as v, cast(null as string) as extra from customer
union all select s_suppkey, s_acctbal, 's' from supplier union all select n_nationkey, null, n_name from nation""")
def union_parts(t):
    """Parts with conflicting types: numbers widen, missing columns and unreadable values are NULL."""
    a = t.customer.select(F.col("c_custkey").cast("int").alias("k"), F.col("c_nationkey").alias("v"))
    b = t.supplier.select(F.col("s_suppkey").alias("k"), F.col("s_acctbal").alias("v"), F.lit("s").alias("extra"))
    c = t.nation.select(F.col("n_nationkey").alias("k"), F.lit("oops").alias("v"), F.col("n_name").alias("extra"))
    return sinks.union_parts([a, b, c])


@query("read_parts", "select l_orderkey, l_linenumber, l_partkey, case when l_linenumber % 2 = 0 then l_suppkey end as l_suppkey from lineitem")
def read_parts(t):
    """Chunk files of one prefix read together, schemas merged."""
    path = _scratch(t, "parts")
    li = t.lineitem
    li.where(F.col("l_linenumber") % 2 == 0).select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey").write.parquet(f"{path}/rollup_0")
    li.where(F.col("l_linenumber") % 2 == 1).select("l_orderkey", "l_linenumber", "l_partkey").write.parquet(f"{path}/rollup_1")
    return sinks.read_parts(t.spark, path, "rollup_").select("l_orderkey", "l_linenumber", "l_partkey", "l_suppkey")


@query("errors_with_context", ctes("aois") + """
select aoi_id, o_custkey, case when o_custkey % 2 = 0 then 1e0 else (x2 - x1) * (y2 - y1) end as area from aois where o_custkey % 3 = 0""")
def errors_with_context(t):
    """Errors with the outline of their cell, else of their area."""
    a = t.aois(geometry=True)
    one = G.box(F.lit(0.0), F.lit(0.0), F.lit(1.0), F.lit(1.0))
    e = a.where(F.col("o_custkey") % 3 == 0).select("aoi_id", "o_custkey", F.when(F.col("o_custkey") % 2 == 0, one).alias("geometry"))
    return sinks.errors_with_context(e, a).select("aoi_id", "o_custkey", G.area(F.col("geometry")).alias("area"))


@query("output_columns", """
select cast(o_orderkey as string) as aoi_id, o_orderstatus as survey_id, 'sid' as source_survey_id, cast(null as string) as link, 1 as roof_count from orders""")
def output_columns(t):
    """Clashing metadata columns renamed, missing ones added, unused class columns dropped."""
    aois = t.orders.select(F.col("o_orderkey").cast("string").alias("aoi_id"), F.col("o_orderstatus").alias("survey_id"))
    meta = sinks.rename_clashes(aois.select("aoi_id", F.lit("sid").alias("survey_id")), aois)
    r = aois.select("aoi_id", F.lit(1).alias("roof_count"), F.lit(None).cast("int").alias("pool_count"))
    r = sinks.drop_unused_class_columns(r, ["roof_count", "pool_count"], aois)
    out = sinks.ensure_columns(r.join(meta, "aoi_id", "left").join(aois, "aoi_id"), ["link"])
    return sinks.order_columns(out, ["survey_id"], ["source_survey_id", "link"])


@query("damage_public", """
select cast(user_id as string) as aoi_id, 'e' || cast(event_id as string) as feature_id, event_type as damage_event_rating, value as area_sqm from events""")
def damage_public(t):
    """Public damage columns in one unit family."""
    b = t.events.select(
        F.col("user_id").cast("string").alias("aoi_id"), F.concat(F.lit("e"), F.col("event_id").cast("string")).alias("feature_id"),
        F.col("event_type").alias("damage_event_rating"), F.col("value").alias("area_sqm"), F.lit(0.0).alias("area_sqft"), F.lit("x").alias("internal"),
    )
    out = sinks.damage_public(b.withColumn("confidence", F.lit(1.0)), "au")
    return out.drop("confidence")


@query("roof_age_public", ctes("features") + f"""
select aoi_id, kind as roof_age_kind, survey_date as roof_age_installation_date, '2024-01-01' as roof_age_as_of_date, area_sqm,
  {he("date_diff('day', cast(survey_date as date), date '2024-01-01') / cast(365.25 as double)", 1)} as roof_age_years_as_of_date,
  case when multiparcel_feature then 'Y' else 'N' end as roof_age_relevant_permits from features where class_id = '{ROOF_INSTANCE}'""")
def roof_age_public(t):
    """Public roof-age columns with prefix, Y/N and age."""
    f = t.features().where(F.col("class_id") == ROOF_INSTANCE).select(
        "aoi_id", "kind", F.col("survey_date").alias("installation_date"), F.lit("2024-01-01").alias("as_of_date"), "area_sqm",
        F.col("multiparcel_feature").alias("relevant_permits"), F.lit("x").alias("hilbert_id"),
    )
    return sinks.roof_age_public(f)


# ------------------------------------------------------------------ incremental ingest
@query("incremental_rollup", ctes("features") + f"""
select aoi_id, count(*) filter (class_id = '{ROOF}') as roof_count, count(*) filter (class_id = '{BUILDING}') as building_count,
  {he(f"coalesce(sum(clipped_area_sqm) filter (class_id = '{ROOF}'), 0e0)", 1)} as roof_area from features group by aoi_id""")
def incremental_rollup(t):
    """Payloads landing in two waves of pages; the second wave updates areas of the first."""
    base = _scratch(t, "stream")
    f = t.features()
    item = F.struct(F.col("feature_id").alias("id"), F.col("class_id").alias("classId"), F.col("clipped_area_sqm").alias("clippedAreaSqm"),
                    F.col("area_sqm").alias("areaSqm"), F.col("unclipped_area_sqm").alias("unclippedAreaSqm"), "confidence")
    # By the order's number, which stands for the area and is shorter to shuffle and compare than its text.
    pages = f.groupBy("l_orderkey", (F.col("l_linenumber") % 2).alias("page")).agg(F.to_json(F.struct(F.collect_list(item).alias("features"))).alias("payload"))
    pages = pages.select(F.col("l_orderkey").cast("string").alias("aoi_id"), "page", "payload")
    cat = [c for c in CATALOGUE if c.class_id in (ROOF, BUILDING)]

    def rollup_of(rows):
        areas = rows.select("aoi_id").distinct()
        return rollup.parcel_rollup(areas, payloads.feature_rows(rows, other=False), cat, "au")

    for wave in (0, 1):
        with shuffles_dropped(t.spark):
            pages.where(F.col("page") == wave).write.mode("append").option("compression", "gzip").json(f"{base}/landing")
        ingest.run_incremental(t.spark, f"{base}/landing", f"{base}/store", f"{base}/rollups", f"{base}/progress", rollup_of, buckets=8)
    now = ingest.current_rollup(t.spark, f"{base}/rollups", ["roof_count", "building_count", "roof_total_clipped_area_sqm"])
    return now.select("aoi_id", "roof_count", "building_count", half_even(F.col("roof_total_clipped_area_sqm"), 1).alias("roof_area"))
