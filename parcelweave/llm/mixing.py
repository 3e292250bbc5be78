"""Mixing sources to target weights by Efraimidis-Spirakis sampling.

A document gets the key ``-ln(u) / quality`` with ``u`` a fixed hash of its id.  Within its source,
documents in order of their keys are a sample without replacement whose odds follow quality.  A
source's budget is first spent on complete epochs; the rest goes to the documents whose prefix sum of
sizes stays inside it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from parcelweave.llm.common import OWN, n_words

#: A source may be repeated this often at most.
MAX_EPOCHS = 3
#: Key ranges per source; one range of one source is sorted by one task.
RANGES = 4096


def quality_weight(text: Column) -> Column:
    """Between 0.5 and 1: the fewer symbols a word, the better."""
    symbols = F.regexp_count(F.coalesce(text, F.lit("")), F.lit(r"[#*$%&|<>]")).cast("double")
    return 1.0 / (1.0 + F.least(F.lit(1.0), symbols / F.greatest(n_words(text), F.lit(1)).cast("double")))


def uniform(key: Column) -> Column:
    """A number in (0, 1) that depends on the key alone; null counts as a key of its own."""
    digest = F.md5(F.concat(F.lit("mix "), F.coalesce(key.cast("string"), F.lit("null"))))
    return (F.conv(F.substring(digest, 1, 12), 16, 10).cast("double") + 0.5) / float(2**48)


def targets(sizes: DataFrame) -> DataFrame:
    """Budget of each source from one row per source with ``source`` and ``source_size``.

    Sources in order of code points, null last, weigh 1, 2, 3 and again; together they get the sum of
    all sizes.  No target passes three times its source's size: in order of cap per weight, sources
    whose cap lies below the water level that the rest would reach are held at their cap.
    """
    everyone = Window.partitionBy()
    ordered = everyone.orderBy(F.col("source").asc_nulls_last())
    rows = sizes.withColumn(f"{OWN}w", (F.row_number().over(ordered) - 1) % 3 + 1)
    rows = rows.withColumn(f"{OWN}cap", MAX_EPOCHS * F.col("source_size"))
    rows = rows.withColumn(f"{OWN}at", F.col(f"{OWN}cap") / F.col(f"{OWN}w"))
    by_level = everyone.orderBy(f"{OWN}at", F.col("source").asc_nulls_last())
    before, after = by_level.rowsBetween(Window.unboundedPreceding, -1), by_level.rowsBetween(0, Window.unboundedFollowing)
    left = F.sum("source_size").over(everyone) - F.coalesce(F.sum(f"{OWN}cap").over(before), F.lit(0))
    rows = rows.withColumn(f"{OWN}level", left / F.sum(f"{OWN}w").over(after))
    free = F.col(f"{OWN}at") >= F.col(f"{OWN}level")
    level = F.min(F.when(free, F.struct(f"{OWN}at", "source", f"{OWN}level"))).over(everyone)[f"{OWN}level"]
    target = F.when(free, level * F.col(f"{OWN}w")).otherwise(F.col(f"{OWN}cap").cast("double"))
    return rows.select("source", "source_size", target.alias("target"))


def mix(docs: DataFrame, id_column: str = "doc_id", text: str = "text", source: str = "source") -> DataFrame:
    """One row per input row: the id, size, source_size, target, taken.

    ``taken`` is the number of words the mix takes of a document, repeats counted: its size times the
    complete epochs of its source, and once more if the fractional epoch reaches at least its middle.
    A source ends within half a document of its target.

    Null and empty texts have size zero and are taken zero times; null sources form one source, last
    in order; null ids are one id.  Rows alike in id have the same key; ties go by id, then size, so
    reruns agree.  An empty table gives an empty result.

    No task sorts a source: keys are cut into ranges by their place in (0, 1), ranges are summed
    first, and only rows of one range of one source are ordered together.
    """
    u = uniform(F.col(id_column))
    rows = docs.select(
        F.col(id_column).alias("doc_id"),
        F.col(source).alias("source"),
        n_words(F.col(text)).alias("size"),
        (-F.log(u) / quality_weight(F.col(text))).alias(f"{OWN}key"),
    )
    place = 1.0 - F.exp(-F.col(f"{OWN}key"))
    rows = rows.withColumn(f"{OWN}range", F.least(F.floor(place * RANGES), F.lit(RANGES - 1)).cast("int"))
    # The null source joins like any other.
    rows = rows.withColumn(f"{OWN}src", F.struct(F.col("source").isNull().alias("n"), F.coalesce("source", F.lit("")).alias("s")))
    own = [f"{OWN}src", f"{OWN}range"]
    ranges = rows.groupBy(*own).agg(F.sum("size").alias(f"{OWN}sum"))
    sizes = ranges.groupBy(f"{OWN}src").agg(F.sum(f"{OWN}sum").alias("source_size"))
    sizes = sizes.withColumn("source", F.when(~F.col(f"{OWN}src.n"), F.col(f"{OWN}src.s")))
    budget = targets(sizes.select("source", "source_size"))
    budget = budget.select(
        F.struct(F.col("source").isNull().alias("n"), F.coalesce("source", F.lit("")).alias("s")).alias(f"{OWN}src"), "source_size", "target"
    )
    earlier = Window.partitionBy(f"{OWN}src").orderBy(f"{OWN}range").rowsBetween(Window.unboundedPreceding, -1)
    starts = ranges.select(*own, F.coalesce(F.sum(f"{OWN}sum").over(earlier), F.lit(0)).alias(f"{OWN}start"))
    starts = starts.join(budget, f"{OWN}src")
    inside = Window.partitionBy(*own).orderBy(f"{OWN}key", "doc_id", "size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn(f"{OWN}in", F.coalesce(F.sum("size").over(inside), F.lit(0))).join(starts, own)
    epochs = F.when(F.col("source_size") > 0, F.floor(F.col("target") / F.col("source_size"))).otherwise(0).cast("long")
    rest = F.col("target") - epochs * F.col("source_size")
    middle = 2 * (F.col(f"{OWN}start") + F.col(f"{OWN}in")) + F.col("size")
    taken = F.col("size") * (epochs + (middle <= 2 * rest).cast("long"))
    return rows.select("doc_id", "size", "source_size", "target", taken.alias("taken"))
