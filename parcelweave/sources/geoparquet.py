"""GeoParquet sink: parquet files with WKB outlines and the ``geo`` footer entry.

The ordinary parquet writer cannot set that entry, so a Python data source writes each partition
as one Arrow stream.  A task writes under a name of its own; committing reveals nothing new but
the success marker, and an aborted job removes what its tasks wrote.
"""

from __future__ import annotations

import json
import uuid
from dataclasses import dataclass

import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs as pafs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.datasource import DataSource, DataSourceArrowWriter, WriterCommitMessage
from pyspark.sql.pandas.types import to_arrow_schema

from parcelweave.config import ROW_GROUP_ROWS
from parcelweave.functions import geometry as G

# Fixed value: version and encoding of the footer entry.
GEO_VERSION = "1.0.0"


def geo_footer(geometry: str = "geometry") -> bytes:
    column = {"encoding": "WKB", "geometry_types": ["Polygon", "MultiPolygon"]}
    return json.dumps({"version": GEO_VERSION, "primary_column": geometry, "columns": {geometry: column}}).encode()


@dataclass
class WrittenFile(WriterCommitMessage):
    path: str | None
    rows: int


class GeoParquetWriter(DataSourceArrowWriter):
    def __init__(self, path: str, schema, geometry: str, overwrite: bool):
        self.path, self.geometry, self.overwrite = path.rstrip("/"), geometry, overwrite
        self.schema = to_arrow_schema(schema).with_metadata({b"geo": geo_footer(geometry)})

    def _open(self):
        if "://" in self.path:
            return pafs.FileSystem.from_uri(self.path)
        return pafs.LocalFileSystem(), self.path

    def write(self, iterator):
        system, base = self._open()
        system.create_dir(base, recursive=True)
        target, rows, writer = f"{base}/part-{uuid.uuid4().hex}.parquet", 0, None
        held, n_held = [], 0

        def flush():
            nonlocal held, n_held
            if held:
                writer.write_table(pa.Table.from_batches(held, self.schema), row_group_size=ROW_GROUP_ROWS)
                held, n_held = [], 0

        try:
            for batch in iterator:
                if writer is None:
                    writer = pq.ParquetWriter(target, self.schema, filesystem=system, compression="zstd")
                held.append(pa.RecordBatch.from_arrays([c.cast(f.type) for c, f in zip(batch.columns, self.schema)], schema=self.schema))
                n_held += batch.num_rows
                rows += batch.num_rows
                if n_held >= ROW_GROUP_ROWS:
                    flush()
            if writer is not None:
                flush()
        except BaseException:
            if writer is not None:
                writer.close()
                system.delete_file(target)
            raise
        if writer is None:
            return WrittenFile(None, 0)
        writer.close()
        return WrittenFile(target, rows)

    def commit(self, messages):
        system, base = self._open()
        system.create_dir(base, recursive=True)
        kept = {m.path for m in messages if m is not None and m.path}
        if self.overwrite:
            for info in system.get_file_info(pafs.FileSelector(base)):
                if info.base_name.startswith("part-") and info.path not in kept:
                    system.delete_file(info.path)
        with system.open_output_stream(f"{base}/_SUCCESS") as marker:
            marker.write(b"")

    def abort(self, messages):
        system, _ = self._open()
        for m in messages:
            if m is not None and m.path:
                system.delete_file(m.path)


class GeoParquet(DataSource):
    """``df.write.format("geoparquet").save(path)`` with a WKB ``geometry`` column."""

    @classmethod
    def name(cls):
        return "geoparquet"

    def writer(self, schema, overwrite):
        return GeoParquetWriter(self.options["path"], schema, self.options.get("geometry", "geometry"), overwrite)


def register(spark: SparkSession) -> None:
    spark.dataSource.register(GeoParquet)


def write_geoparquet(features: DataFrame, path: str, *, sort: tuple[str, ...] = ("class_id", "feature_id"), partitions: int | None = None) -> None:
    """Features sorted by class across and within files.

    The range key includes the feature id, so one dominant class still spreads over many files.
    """
    register(features.sparkSession)
    keys = [c for c in sort if c in features.columns]
    out = features.withColumn("geometry", G.to_wkb("geometry")) if dict(features.dtypes)["geometry"] != "binary" else features
    if keys:
        out = (out.repartitionByRange(partitions, *keys) if partitions else out.repartitionByRange(*keys)).sortWithinPartitions(*keys)
    out.write.format("geoparquet").mode("overwrite").save(path)
