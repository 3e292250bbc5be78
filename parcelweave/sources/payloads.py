"""Landed API payloads -> feature, metadata, error and survey tables.

Input frames hold one payload per row: ``aoi_id``, ``payload`` (JSON text) and, where answers come
in pages, ``page``.  Everything is ``from_json`` with a declared schema plus ``explode``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelweave.config import EVENT_TAGS, INCLUDE_COLUMNS, INCLUDES, ROOF_INSTANCE
from parcelweave.functions import geometry as G
from parcelweave.functions.columns import half_even, snake_name, with_location_marker
from parcelweave.operators.attributes import DAMAGE_BLOCK, conflated_damage_columns

API_INCLUDES = {c: INCLUDES[c]["api_key"] if c in INCLUDES else "defensibleSpace" for c in INCLUDE_COLUMNS}
FLOATS = (
    "fidelity", "confidence", "areaSqm", "clippedAreaSqm", "unclippedAreaSqm",
    "areaSqft", "clippedAreaSqft", "unclippedAreaSqft",
)
TEXTS = ("id", "classId", "description", "parentId", "geometry", "clippedGeometry", "attributes", "damage", "surveyDate", "meshDate")
#: Keys of a feature that become columns; whatever else a feature holds is kept together in ``other``.
FEATURE_KEYS = (*TEXTS, *FLOATS, "belongsToParcel", *API_INCLUDES.values())
FEATURE_PAYLOAD = (
    "struct<systemVersion:string,link:string,surveyDate:string,surveyId:string,resourceId:string,perspective:string,"
    "postcat:string,`3dDate`:string,aggregate:string,versions:map<string,struct<modelVersion:string>>,"
    "features:array<map<string,string>>>"
)
FEATURE_VALUES = "struct<features:array<map<string,variant>>>"


def parsed_features(payloads: DataFrame) -> DataFrame:
    return payloads.withColumn("p", F.from_json("payload", FEATURE_PAYLOAD))


def unreadable_payloads(payloads: DataFrame) -> DataFrame:
    """Errors (aoi_id, status_code, message): payloads that are no JSON or lack the features list.

    Their areas count as not answered."""
    bad = parsed_features(payloads).where(F.col("p.features").isNull())
    broken = F.try_parse_json("payload").isNull()
    text = F.when(broken, "payload is not valid JSON").otherwise("payload has no features")
    return bad.select("aoi_id", F.lit(None).cast("int").alias("status_code"), text.alias("message"))


def feature_metadata(payloads: DataFrame) -> DataFrame:
    """One metadata row per readable payload."""
    p = parsed_features(payloads).where(F.col("p.features").isNotNull())
    return p.select(
        "aoi_id", F.col("p.systemVersion").alias("system_version"),
        with_location_marker(F.col("p.link")).alias("link"),
        F.col("p.surveyDate").alias("survey_date"), F.col("p.surveyId").alias("survey_id"),
        F.col("p.resourceId").alias("survey_resource_id"), F.col("p.perspective").alias("perspective"),
        F.col("p.postcat").alias("postcat"), F.coalesce("p.3dDate", F.lit("")).alias("mesh_date"),
        F.col("p.aggregate").alias("aggregate"),
    )


def _with_model_version(versions: Column, include: Column, api_key: str) -> Column:
    """Put the response-level model version into an include object.

    It goes in front of the text; only an object that names a version of its own is taken apart.
    """
    version = versions[api_key]["modelVersion"]
    fits = F.startswith(include, F.lit("{")) & version.isNotNull() & (version != "")
    given = F.to_json(F.struct(version.alias("modelVersion")))
    head = F.substring(given, F.lit(1), F.length(given) - 1)
    spliced = F.concat(head, F.when(include == "{}", "").otherwise(","), F.substring(include, F.lit(2), F.length(include)))
    # Values, nested objects included, stay as they are.
    others = F.map_filter(F.from_json(include, "map<string,variant>"), lambda name, _: name != "modelVersion")
    own = F.from_json(given, "map<string,variant>")
    named = F.contains(include, F.lit('"modelVersion"'))
    return F.when(fits & named, F.to_json(F.map_concat(own, others))).when(fits, spliced).otherwise(include)


def feature_rows(payloads: DataFrame, *, parcel_mode: bool = False, other: bool = True) -> DataFrame:
    """One row per feature.

    In parcel mode features that do not belong to the parcel are left out, but only where the
    payload's first feature carries the flag at all; a missing flag counts as true.  A clipped
    outline replaces the outline and marks the feature as multi-parcel.  Confidence is rounded to
    two decimals here, before anything is aggregated.  Keys without a column of their own come as one
    VARIANT object, ``other`` (NULL where there are none); only payloads with such keys are read for it, and
    callers without use for it leave it out.
    """
    p = parsed_features(payloads)
    features = F.col("p.features")
    more = F.exists(features, lambda f: F.exists(F.map_keys(f), lambda k: ~k.isin(*FEATURE_KEYS)))
    values = F.when(more, F.from_json("payload", FEATURE_VALUES)["features"]) if other else F.lit(None).cast("array<map<string,variant>>")
    flagged = F.get(features, F.lit(0))["belongsToParcel"].isNotNull()
    p = p.select("aoi_id", F.col("p.versions").alias("_versions"), flagged.alias("_flagged"), features.alias("_f"), values.alias("_v"))
    rows = p.select(
        "aoi_id", "_versions", "_flagged",
        F.explode(F.arrays_zip("_f", F.coalesce("_v", F.array().cast("array<map<string,variant>>")).alias("_v"))).alias("z"),
    ).select("aoi_id", "_versions", "_flagged", F.col("z._f").alias("f"), F.col("z._v").alias("_v"))
    belongs = F.coalesce(F.col("f")["belongsToParcel"].try_cast("boolean"), F.lit(True))
    if parcel_mode:
        rows = rows.where(~F.col("_flagged") | belongs)
    clipped = F.col("f")["clippedGeometry"]
    has_clip = clipped.isNotNull() & ~clipped.isin("", "{}", "null")
    cols = {
        "feature_id": F.col("f")["id"],
        "class_id": F.col("f")["classId"],
        "description": F.col("f")["description"],
        "parent_id": F.col("f")["parentId"],
        "geometry": G.from_geojson(F.when(has_clip, clipped).otherwise(F.col("f")["geometry"])),
        "multiparcel_feature": has_clip,
        "attributes": F.col("f")["attributes"],
        "damage": F.col("f")["damage"],
        "survey_date": F.col("f")["surveyDate"],
        "mesh_date": F.col("f")["meshDate"],
        "belongs_to_parcel": belongs,
    }
    for c in FLOATS:
        value = F.nanvl(F.col("f")[c].try_cast("double"), F.lit(None).cast("double"))
        cols[snake_name(c)] = half_even(value, 2) if c == "confidence" else value
    for name, api_key in API_INCLUDES.items():
        cols[name] = _with_model_version(F.col("_versions"), F.col("f")[api_key], api_key)
    if other:
        unnamed = F.map_filter("_v", lambda name, _: ~name.isin(*FEATURE_KEYS))
        cols["other"] = F.when(F.size(unnamed) > 0, F.to_variant_object(unnamed))
    return rows.select("aoi_id", *[v.alias(k) for k, v in cols.items()])


# ------------------------------------------------------------------ roof age
ROOF_AGE_TEXTS = (
    "afterInstallationCaptureDate", "asOfDate", "assessorDataDetails", "beforeInstallationCaptureDate",
    "evidenceTypeDescription", "hilbertId", "installationDate", "kind", "mapBrowserUrl", "maxCaptureDate",
    "minCaptureDate", "modelVersion", "relevantPermitsDetails", "untilDate",
)
ROOF_AGE_PROPS = (
    "struct<" + ",".join([f"{c}:string" for c in ROOF_AGE_TEXTS])
    + ",area:double,assessorData:boolean,evidenceType:int,numberOfCaptures:int,relevantPermits:boolean,trustScore:double>"
)
ROOF_AGE_PAYLOAD = (
    f"struct<type:string,resourceId:string,modelVersion:string,features:array<struct<geometry:string,properties:{ROOF_AGE_PROPS}>>>"
)


def roof_age_rows(pages: DataFrame) -> DataFrame:
    """One row per roof-age record over all pages; top-level metadata is the first page's.

    Nested lists stay JSON text, ``area`` becomes ``area_sqm`` and ``hilbertId`` the feature id.
    """
    page = F.col("page") if "page" in pages.columns else F.lit(1)
    parsed = pages.select("aoi_id", page.alias("_page"), F.from_json("payload", ROOF_AGE_PAYLOAD).alias("p"))
    first = parsed.groupBy("aoi_id").agg(
        F.min_by(F.struct("p.resourceId", "p.modelVersion"), F.col("_page")).alias("top")
    )
    rows = parsed.select("aoi_id", "_page", F.posexplode("p.features").alias("_pos", "f")).join(first, "aoi_id")
    props = F.col("f.properties")
    cols = {snake_name(c): props[c] for c in ROOF_AGE_TEXTS if c not in ("hilbertId", "mapBrowserUrl", "modelVersion")}
    cols.update(
        map_browser_url=with_location_marker(props["mapBrowserUrl"]),
        area_sqm=props["area"],
        assessor_data=props["assessorData"],
        evidence_type=props["evidenceType"],
        number_of_captures=props["numberOfCaptures"],
        relevant_permits=props["relevantPermits"],
        trust_score=props["trustScore"],
        feature_id=F.coalesce(
            props["hilbertId"], F.concat(F.lit("roof_instance_"), F.col("_page").cast("string"), F.lit("_"), F.col("_pos").cast("string"))
        ),
        resource_id=F.col("top.resourceId"),
        model_version=F.coalesce(F.col("top.modelVersion"), props["modelVersion"]),
        class_id=F.lit(ROOF_INSTANCE),
        description=F.lit("Roof Instance"),
        geometry=G.from_geojson(F.col("f.geometry")),
    )
    return rows.select("aoi_id", *[v.alias(k) for k, v in cols.items()])


# ------------------------------------------------------------------ conflated damage
DAMAGE_PROPS = (
    "struct<areaSqm:double,areaSqft:double,confidence:double,hilbertId:string,"
    f"damage:struct<event:{DAMAGE_BLOCK},preEvent:{DAMAGE_BLOCK}>>"
)
DAMAGE_PAYLOAD = (
    "struct<type:string,error:string,code:string,resourceId:string,eventUuid:string,eventName:string,modelVersion:string,"
    "presentationVersion:string,geomatchedAddress:string,"
    f"features:array<struct<id:string,geometry:string,properties:{DAMAGE_PROPS}>>>"
)


def _damage_pages(pages: DataFrame) -> DataFrame:
    page = F.col("page") if "page" in pages.columns else F.lit(1)
    return pages.select("aoi_id", page.alias("_page"), F.from_json("payload", DAMAGE_PAYLOAD).alias("p"))


def damage_errors(pages: DataFrame) -> DataFrame:
    """(aoi_id, message): answers with an error body, and areas with a feature without outline."""
    parsed = _damage_pages(pages)
    body = parsed.where(F.col("p.error").isNotNull()).select(
        "aoi_id",
        F.concat(F.col("p.error"), F.lit(" (code: "), F.coalesce("p.code", F.lit("UNKNOWN")), F.lit(")")).alias("message"),
    )
    bare = parsed.select("aoi_id", F.explode("p.features").alias("f")).where(
        F.coalesce(F.col("f.geometry"), F.lit("null")) == "null"
    ).select("aoi_id", F.concat(F.lit("feature missing geometry: "), F.coalesce("f.id", F.lit("?"))).alias("message"))
    return body.unionByName(bare).groupBy("aoi_id").agg(F.min("message").alias("message"))


def damage_rows(pages: DataFrame) -> DataFrame:
    """One row per building of areas without error, event metadata copied to every row."""
    parsed = _damage_pages(pages).join(damage_errors(pages).select("aoi_id"), "aoi_id", "left_anti")
    meta = ("resourceId", "eventUuid", "eventName", "modelVersion", "presentationVersion", "geomatchedAddress")
    first = parsed.groupBy("aoi_id").agg(F.min_by(F.struct(*[f"p.{m}" for m in meta]), F.col("_page")).alias("top"))
    rows = parsed.select("aoi_id", F.explode("p.features").alias("f")).join(first, "aoi_id")
    props = F.col("f.properties")
    return rows.select(
        "aoi_id", F.col("f.id").alias("feature_id"), G.from_geojson(F.col("f.geometry")).alias("geometry"),
        props["areaSqm"].alias("area_sqm"), props["areaSqft"].alias("area_sqft"),
        props["confidence"].alias("confidence"), props["hilbertId"].alias("hilbert_id"),
        *[v.alias(k) for k, v in conflated_damage_columns(props["damage"]).items()],
        *[F.col(f"top.{m}").alias(snake_name(m)) for m in meta],
    )


# ------------------------------------------------------------------ coverage
RESOURCE = "array<struct<id:string,boundary:string>>"
SURVEY = f"struct<id:string,captureDate:string,tags:map<string,string>,resources:map<string,{RESOURCE}>>"


def survey_rows(payloads: DataFrame, key: str = "aoi_id") -> DataFrame:
    """One row per survey of a coverage answer.

    ``survey_resource_id`` is the last AI resource, NULL without one; the flags say which kinds of
    resource exist.
    """
    p = payloads.withColumn("p", F.from_json("payload", f"struct<surveys:array<{SURVEY}>>"))
    s = p.select(key, F.explode("p.surveys").alias("s"))
    kinds = F.coalesce(F.map_keys("s.resources"), F.array().cast("array<string>"))
    ai = F.col("s.resources")["aifeatures"]
    return s.select(
        key, F.try_to_timestamp("s.captureDate").alias("captureDate"), F.col("s.id").alias("survey_id"),
        F.when(F.size(ai) > 0, F.element_at(ai, -1)["id"]).alias("survey_resource_id"),
        *[F.array_contains(kinds, k).alias(k) for k in ("tiles", "aifeatures", "3d")],
        F.col("s.tags").alias("tags"), F.col("s.resources").alias("resources"),
    )


def survey_date_errors(payloads: DataFrame, key: str = "aoi_id") -> DataFrame:
    """(key, survey_id, message): surveys whose capture date is there but is no date; :func:`survey_rows` keeps
    them with a NULL date."""
    s = payloads.select(key, F.explode(F.from_json("payload", f"struct<surveys:array<{SURVEY}>>")["surveys"]).alias("s"))
    day = F.col("s.captureDate")
    bad = s.where(day.isNotNull() & F.try_to_timestamp(day).isNull())
    return bad.select(key, F.col("s.id").alias("survey_id"), F.concat(F.lit("capture date is no date: "), day).alias("message"))


def survey_resources(surveys: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Lookup by survey id needs exactly one resource: (rows with it, violations)."""
    n = F.aggregate(F.map_values("resources"), F.lit(0), lambda a, r: a + F.size(r))
    counted = surveys.withColumn("n_resources", F.coalesce(n, F.lit(0)))
    only = F.get(F.flatten(F.map_values("resources")), F.lit(0))["id"]
    good = counted.where(F.col("n_resources") == 1).withColumn("survey_resource_id", only)
    bad = counted.where(F.col("n_resources") != 1).select(
        "survey_id", F.concat(F.lit("expected one resource, found "), F.col("n_resources").cast("string")).alias("message")
    )
    return good, bad


def survey_events(surveys: DataFrame) -> DataFrame:
    """Event tags as columns; surveys flown for no event have NULLs."""
    return surveys.withColumns({out: F.col("tags")[tag] for tag, out in EVENT_TAGS.items()})


def survey_footprints(surveys: DataFrame) -> DataFrame:
    """One row per tile boundary of every survey tagged with an event."""
    tagged = survey_events(surveys).where(F.col("event_id").isNotNull())
    tiles = tagged.select(*EVENT_TAGS.values(), "survey_id", "captureDate", F.explode(F.col("resources")["tiles"]).alias("t"))
    shape = G.from_geojson(F.col("t.boundary"))
    return tiles.select(*EVENT_TAGS.values(), "survey_id", "captureDate", shape.alias("geometry")).where(
        F.col("geometry").isNotNull()
    )
