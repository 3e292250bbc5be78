"""GeoPackage ingest: many files in, one file per task."""

from __future__ import annotations

import sqlite3
import tempfile

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelweave.functions import geometry as G

ENVELOPE_BYTES = {0: 0, 1: 32, 2: 48, 3: 48, 4: 64}


def strip_header(blob: bytes | None) -> bytes | None:
    """GeoPackage geometry blob -> plain WKB; an empty geometry gives NULL."""
    if not blob or blob[:2] != b"GP":
        return None
    flags = blob[3]
    if flags & 0x10:
        return None
    return blob[8 + ENVELOPE_BYTES[(flags >> 1) & 7] :]


def _tables(batches):
    """Each file's feature table as JSON properties plus WKB, in bounded slices."""
    for files in batches:
        for content in files["content"]:
            with tempfile.NamedTemporaryFile(suffix=".gpkg") as copy:
                copy.write(content)
                copy.flush()
                with sqlite3.connect(copy.name) as db:
                    for table, column in db.execute("select table_name, column_name from gpkg_geometry_columns").fetchall():
                        cursor = db.execute(f'select * from "{table}"')
                        names = [d[0] for d in cursor.description]
                        while rows := cursor.fetchmany(2048):
                            frame = pd.DataFrame(rows, columns=names)
                            shape = frame.pop(column).map(strip_header)
                            props = [r.to_json() for _, r in frame.iterrows()]
                            yield pd.DataFrame({"properties": props, "wkb": shape})


def read_geopackage(spark: SparkSession, path: str, properties: str | None = None) -> DataFrame:
    """Feature tables of all matching files; ``properties`` is an optional DDL of the columns.

    Without it the property names are collected first (one small distinct) and kept as text.
    """
    files = spark.read.format("binaryFile").load(path).select("content")
    raw = files.repartition(max(1, spark.sparkContext.defaultParallelism)).mapInPandas(
        _tables, "properties string, wkb binary"
    )
    if properties is None:
        names = raw.select(F.explode(F.json_object_keys("properties")).alias("n")).distinct().collect()
        properties = ", ".join(f"`{r['n']}` string" for r in sorted(names))
    parsed = raw.select(F.from_json("properties", properties).alias("p"), G.from_wkb("wkb").alias("geometry"))
    return parsed.select("p.*", "geometry")
