"""Content-addressed WARC archive.

Two tables make up an archive: ``payloads`` holds the bytes of each distinct payload once, under its
SHA-256 digest; ``headers`` holds the exact WARC header block of every record.  Records are put
together again by a join on the digest.
"""

from __future__ import annotations

from collections.abc import Iterator

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelweave.llm.common import OWN, prepare

#: Equal payloads below this many bytes are written out each time, as a revisit record would be longer.
REVISIT_FROM = 100
DATE = "2026-01-01T00:00:00Z"
EOL = "\r\n"


def _line(name: str, value: Column) -> Column:
    return F.concat(F.lit(f"{name}: "), value, F.lit(EOL))


def _record_id(page: Column) -> Column:
    return F.concat(F.lit("<urn:page:"), F.coalesce(page.cast("string"), F.lit("null")), F.lit(">"))


def write_archive(pages: DataFrame, path: str, id_column: str = "page_id", url: str = "url", payload: str = "html", date: str = DATE) -> None:
    """Write one record per row of ``pages`` under ``path``.

    Of records with equal payloads of at least ``REVISIT_FROM`` bytes, the one with the smallest id is
    the response and the others revisit it; all shorter ones are responses.  Null payloads are empty;
    null urls are empty, and line breaks in urls are percent-encoded.  Rows alike in id and payload are
    all responses if their id is the smallest; a null id comes after every other, and where all are null
    all are responses.  An empty table gives an empty archive; further columns are left out.

    One aggregation finds the smallest id of a digest and keeps the bytes; its map side leaves one row
    per digest and task, so copies are never shuffled together.  A second, unrelated hash and the length
    must agree within a digest.
    """
    body = F.encode(F.coalesce(F.col(payload), F.lit("")), "UTF-8")
    rows = pages.select(F.col(id_column).alias("id"), F.col(url).alias("url"), body.alias("payload"))
    rows = rows.withColumn("digest", F.unhex(F.sha2("payload", 256)))
    check = F.struct(F.octet_length("payload").alias("n"), F.xxhash64("payload").alias("h"))
    stored = rows.groupBy("digest").agg(
        F.min("id").alias("first_id"), F.first("payload").alias("payload"), F.min(check).alias("low"), F.max(check).alias("high")
    )
    clash = F.raise_error(F.concat(F.lit("two payloads under digest "), F.hex("digest"))).cast("binary")
    stored.select(
        "digest", "first_id", F.when(F.col("low") != F.col("high"), clash).otherwise(F.col("payload")).alias("payload")
    ).write.parquet(f"{path}/payloads")

    spark = pages.sparkSession
    firsts = spark.read.parquet(f"{path}/payloads").select("digest", "first_id")
    length = F.octet_length("payload").cast("long")
    records = rows.select("id", "url", "digest", length.alias("n")).join(firsts, "digest")
    revisit = (F.col("n") >= REVISIT_FROM) & F.coalesce(F.col("id") != F.col("first_id"), F.col("first_id").isNotNull())
    safe_url = F.replace(F.replace(F.coalesce("url", F.lit("")), F.lit("\r"), F.lit("%0D")), F.lit("\n"), F.lit("%0A"))
    header = F.concat(
        F.lit(f"WARC/1.1{EOL}"),
        _line("WARC-Type", F.when(revisit, "revisit").otherwise("response")),
        _line("WARC-Record-ID", _record_id(F.col("id"))),
        _line("WARC-Date", F.lit(date)),
        _line("WARC-Target-URI", safe_url),
        _line("WARC-Payload-Digest", F.concat(F.lit("sha256:"), F.lower(F.hex("digest")))),
        F.when(revisit, _line("WARC-Refers-To", _record_id(F.col("first_id")))).otherwise(F.lit("")),
        _line("Content-Type", F.lit("text/html; charset=utf-8")),
        _line("Content-Length", F.when(revisit, F.lit(0)).otherwise(F.col("n")).cast("string")),
    )
    records.select("digest", header.alias("header")).write.parquet(f"{path}/headers")


def field(header: Column, name: str) -> Column:
    """Value of a header field, null if the record lacks it."""
    value = F.regexp_extract(header, rf"\r\n{name}: ([^\r]*)\r\n", 1)
    return F.when(header.contains(f"{EOL}{name}: "), value)


def _page(record_id: Column) -> Column:
    return F.regexp_extract(record_id, r"^<urn:page:(-?\d+)>$", 1).try_cast("long")


def read_archive(spark: SparkSession, path: str) -> DataFrame:
    """One row per record: page_id, url, payload_bytes, payload_digest, record_type, refers_to.

    Every payload's digest is computed again from the stored bytes; one that differs ends the job.
    """
    digest = F.unhex(F.sha2("payload", 256))
    wrong = F.raise_error(F.concat(F.lit("payload does not match digest "), F.hex("digest"))).cast("binary")
    facts = spark.read.parquet(f"{path}/payloads").select(
        F.when(digest == F.col("digest"), digest).otherwise(wrong).alias("digest"), F.octet_length("payload").cast("long").alias("payload_bytes")
    )
    headers = spark.read.parquet(f"{path}/headers")
    told = F.substring_index(field(F.col("header"), "WARC-Payload-Digest"), ":", -1)
    return headers.join(facts, "digest").select(
        _page(field(F.col("header"), "WARC-Record-ID")).alias("page_id"),
        field(F.col("header"), "WARC-Target-URI").alias("url"),
        "payload_bytes",
        told.alias("payload_digest"),
        field(F.col("header"), "WARC-Type").alias("record_type"),
        _page(field(F.col("header"), "WARC-Refers-To")).alias("refers_to"),
    )


def restore(spark: SparkSession, path: str) -> DataFrame:
    """The original records: exact header block and full payload, revisits included."""
    payloads = spark.read.parquet(f"{path}/payloads").select("digest", "payload")
    return spark.read.parquet(f"{path}/headers").join(payloads, "digest").select("header", "payload")


def export_warc(spark: SparkSession, path: str, out: str, records_per_file: int = 10_000) -> None:
    """Write the archive as standard WARC files: revisits without a body, gzip per file."""
    revisit = field(F.col("header"), "WARC-Type") == "revisit"
    body = F.when(revisit, F.lit("")).otherwise(F.decode("payload", "UTF-8"))
    block = restore(spark, path).select(F.concat("header", F.lit(EOL), body).alias("value"))
    (
        block.write.option("lineSep", EOL * 2).option("compression", "gzip").option("maxRecordsPerFile", records_per_file).text(out)
    )


def import_warc(spark: SparkSession, path: str) -> DataFrame:
    """Header block and body of each record in WARC files, cut by Content-Length; one file is one task's work."""
    prepare(spark)
    files = spark.read.format("binaryFile").load(path).select("content", (F.lower("path").endswith(".gz")).alias(f"{OWN}gz"))
    return files.mapInArrow(_records, "header string, payload binary")


def _records(batches: Iterator) -> Iterator:
    import gzip

    import pyarrow as pa

    for batch in batches:
        for data, packed in zip(batch.column(0), batch.column(1), strict=True):
            raw = gzip.decompress(data.as_py()) if packed.as_py() else data.as_py()
            headers, bodies, at = [], [], 0
            while at < len(raw):
                end = raw.index(b"\r\n\r\n", at) + 2
                header = raw[at:end].decode()
                n = int(header.partition("\r\nContent-Length: ")[2].partition("\r\n")[0])
                headers.append(header)
                bodies.append(raw[end + 2 : end + 2 + n])
                at = end + 2 + n + 4
            yield pa.RecordBatch.from_arrays([pa.array(headers, pa.string()), pa.array(bodies, pa.binary())], ["header", "payload"])
