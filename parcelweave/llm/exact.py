"""Exact deduplication over an extendible-hash index on shared files.

The index has a directory of ``2^depth`` slots, one for each value of the leading ``depth`` bits of a
text's hash, and buckets, each reached from all slots that share the bucket's own leading bits.  A bucket
that holds more keys than it may is split by one more bit, and the directory doubles when a bucket needs
more bits than it has.  Copies of one text cannot be split by any bit: a bucket with more rows than it may
hold is dealt over several pages.  A page of a bucket belongs to one task, which groups its rows by hash
and whole text, so that texts of one hash are chained and told apart by their bytes.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelweave.llm.common import OWN, cut_lineage

#: Keys a bucket holds before it is split, and rows a page of it is made for.
CAPACITY = 256
#: The directory doubles so often at most; with more keys than its slots hold, buckets hold more.
MAX_DEPTH = 18


@dataclass
class Index:
    """``directory``: slot, bucket, bits, pages; ``entries``: bucket, bits, hash, digest, text, keep_id,
    group_size, one row per distinct text.  Both are tables in the shared folder."""

    directory: DataFrame
    entries: DataFrame
    depth: int


def _leading(value: Column, bits: int | Column) -> Column:
    """The first ``bits`` of MAX_DEPTH bits."""
    return F.call_function("shiftright", value, F.lit(MAX_DEPTH) - (F.lit(bits) if isinstance(bits, int) else bits))


def _hash(text: Column) -> Column:
    return F.xxhash64(text)


def directory(keys: DataFrame, capacity: int = CAPACITY) -> tuple[DataFrame, int]:
    """``slot, bucket, bits, pages`` and the depth, from the ``hash, rows`` of each key.

    ``cell`` is a slot of the deepest directory, so the loop works on 2^MAX_DEPTH rows at most, whatever
    the corpus.
    """
    cell = F.shiftrightunsigned("hash", 64 - MAX_DEPTH).cast("int")
    counted = keys.groupBy(cell.alias("cell")).agg(F.count("*").alias("keys"), F.sum("rows").alias("rows"))
    cells = cut_lineage(counted.withColumn("bits", F.lit(0)))
    total = cells.agg(F.coalesce(F.sum("keys"), F.lit(0))).first()[0]
    room = max(capacity, -(-total // (1 << (MAX_DEPTH - 3))))
    depth = 0
    bucket = _leading(F.col("cell"), F.col("bits"))
    while True:
        # Sums first: at the start all cells are one bucket, which no single task should hold.
        held = cells.groupBy("bits", bucket.alias("bucket")).agg(F.sum("keys").alias("held"))
        split = cells.withColumn("bucket", bucket).join(held, ["bits", "bucket"]).withColumn("over", (F.col("held") > room) & (F.col("bits") < MAX_DEPTH))
        grown = cut_lineage(split.select("cell", "keys", "rows", (F.col("bits") + F.col("over").cast("int")).alias("bits")), cells)
        deepest = grown.agg(F.max("bits")).first()[0] or 0
        cells = grown
        if deepest == depth:
            break
        depth = deepest
    buckets = cells.groupBy(bucket.alias("bucket"), "bits").agg(F.sum("rows").alias("rows"))
    # Some copies among its keys are no reason to split a bucket up.
    buckets = buckets.withColumn("pages", F.when(F.col("rows") > 4 * room, F.ceil(F.col("rows") / room)).otherwise(1).cast("int"))
    wide = F.lit(depth) - F.col("bits")
    low = F.call_function("shiftleft", F.col("bucket"), wide)
    slots = buckets.select(F.explode(F.sequence(low, low + F.call_function("shiftleft", F.lit(1), wide) - 1)).alias("slot"), "bucket", "bits", "pages")
    return cut_lineage(slots), depth


def build(rows: DataFrame, capacity: int = CAPACITY) -> Index:
    """Index of the ``id, text, hash`` rows; texts are whole and not null."""
    keys = rows.groupBy("hash").agg(F.count("*").alias("rows"))
    slots, depth = directory(keys, capacity)
    # 2^MAX_DEPTH rows of four numbers at most: 4 MB.
    found = rows.withColumn("slot", _slot(F.col("hash"), depth)).join(F.broadcast(slots), "slot").drop("slot")
    # Any share of a page will do: pages of one bucket are put together below.
    page = F.pmod(F.xxhash64("hash", "id", F.lit("page")), F.col("pages"))
    owned = found.withColumn("page", page).repartition("bucket", "bits", "page")
    each = ["bucket", "bits", "page", "pages", "hash", "text"]
    paged = cut_lineage(owned.groupBy(*each).agg(F.max("id").alias("keep_id"), F.count("*").alias("group_size")))
    whole = paged.filter("pages = 1").select("bucket", "bits", "hash", "text", "keep_id", "group_size")
    over = paged.filter("pages > 1").groupBy("bucket", "bits", "hash", "text")
    joined = over.agg(F.max("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size"))
    entries = whole.unionByName(joined).withColumn("digest", F.unhex(F.sha2("text", 256)))
    return Index(slots, entries, depth)


def _slot(value: Column, depth: int) -> Column:
    return F.shiftrightunsigned(value, 64 - depth).cast("int") if depth else F.lit(0)


def lookup(index: Index, texts: DataFrame, text: str = "text") -> DataFrame:
    """The rows of ``texts`` with ``keep_id`` and ``group_size`` of the equal indexed text, null where there
    is none.  A null text is looked up as an empty one."""
    own = [f"{OWN}{c}" for c in ("bucket", "bits", "hash", "text")]
    body = F.coalesce(F.col(text), F.lit(""))
    asked = texts.withColumn(own[3], body).withColumn(own[2], _hash(body)).withColumn(f"{OWN}slot", _slot(F.col(own[2]), index.depth))
    slots = index.directory.select(F.col("slot").alias(f"{OWN}slot"), F.col("bucket").alias(own[0]), F.col("bits").alias(own[1]))
    placed = asked.join(F.broadcast(slots), f"{OWN}slot", "left")
    held = index.entries.select(*[F.col(c).alias(f"{OWN}{c}") for c in ("bucket", "bits", "hash", "text")], "keep_id", "group_size")
    return placed.join(held, own, "left").select(*[F.col(f"`{c}`") for c in texts.columns], "keep_id", "group_size")


def classes(docs: DataFrame, id_column: str = "doc_id", text: str = "text", capacity: int = CAPACITY) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are one class if their bytes are equal; a null text counts as empty, and empty texts are a class
    like any other.  ``keep_id`` is the largest id of the class, null only if it has no other, and the row
    with that id is kept.  Rows alike in id and text stand for one document and get the same answer (all
    kept or none), each counting in ``group_size``.  Long texts are compared whole; an empty table gives
    no rows; further columns are left out.

    The answer reaches a row by its text's hash and SHA-256 digest; were two different texts to share
    both, the join would find two classes, and the job ends with an error instead.
    """
    whole = docs.select(F.col(id_column).alias("id"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    rows = whole.withColumn("hash", _hash(F.col("text")))
    names = cut_lineage(rows.select("id", "hash", F.unhex(F.sha2("text", 256)).alias("digest")))
    index = build(rows, capacity)
    held = index.entries.groupBy("hash", "digest").agg(F.max("keep_id").alias("keep_id"), F.max("group_size").alias("group_size"), F.count("*").alias("texts"))
    clash = F.raise_error(F.concat(F.lit("two texts under digest "), F.hex("digest"))).cast("long")
    told = cut_lineage(held.select("hash", "digest", "keep_id", F.when(F.col("texts") == 1, F.col("group_size")).otherwise(clash).alias("group_size")))
    # The classes grow with the corpus: a merge join of two plain tables, whose hot keys adaptive execution splits.
    return names.join(told.hint("merge"), ["hash", "digest"]).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", F.col("id").eqNullSafe(F.col("keep_id")).alias("kept"), F.lower(F.hex("digest")).alias("text_sha256")
    )


def dedup(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row of each class of equal texts, with the input's columns: that with the largest id.

    Of rows alike in id and text, the one whose other columns come first as JSON text stays, so reruns
    agree.  Null and empty texts are one class, of which one row stays.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    own = [f"{OWN}hash", f"{OWN}digest"]
    marked = docs.withColumns({own[0]: _hash(body), own[1]: F.unhex(F.sha2(body, 256))})
    rows = docs.select(F.col(id_column).alias("id"), body.alias("text"))
    entries = build(rows.withColumn("hash", _hash(F.col("text")))).entries
    last = entries.select(F.col("hash").alias(own[0]), F.col("digest").alias(own[1]), F.col("keep_id").alias(f"{OWN}keep"))
    kept = marked.join(last.hint("merge"), own).filter(F.col(id_column).eqNullSafe(F.col(f"{OWN}keep"))).drop(f"{OWN}keep")
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    return kept.groupBy(*own).agg(F.min_by(row, F.to_json(row)).alias(f"{OWN}row")).select(f"{OWN}row.*")


def read_index(spark: SparkSession, path: str) -> Index:
    """An index that :func:`write_index` left under ``path``."""
    slots = spark.read.parquet(f"{path}/directory")
    depth = slots.agg(F.max("depth")).first()[0] or 0
    return Index(slots.drop("depth"), spark.read.parquet(f"{path}/entries"), depth)


def write_index(index: Index, path: str) -> None:
    """Write directory and entries under ``path``; buckets of one range of hashes lie in one file."""
    index.directory.withColumn("depth", F.lit(index.depth)).write.parquet(f"{path}/directory")
    index.entries.write.parquet(f"{path}/entries")
