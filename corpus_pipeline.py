"""From raw documents to a training mix: quality rules, line deduplication, near-duplicates, benchmark
decontamination, mixing.

Each stage takes the documents its predecessor kept, is written as Parquet and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelweave.llm import decontaminate, lines, mixing, quality, simhash
from parcelweave.llm.common import table
from parcelweave.session import cut_lineage


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects.

    Null and empty texts are rejected; repeated rows share a verdict; other columns are kept."""
    return quality.keep_good(docs)


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, less their runs of lines that an earlier place holds; ``n_chars`` follows.

    Null texts stay null, with the n_chars they came with; a text cut whole becomes empty."""
    cut = lines.dedup_lines(docs)
    if "n_chars" not in docs.columns:
        return cut
    kind = docs.schema["n_chars"].dataType
    return cut.withColumn("n_chars", F.coalesce(F.length("text").cast(kind), F.col("n_chars")))


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates: that with the smallest id, nulls last.

    Texts without words are one group; of rows alike in id and text, one stays."""
    return simhash.keep_first(docs)


def decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that are not contaminated by a benchmark item.

    Texts without words are kept; each row is judged by its own text."""
    return decontaminate.keep_clean(docs, table(spark, sf_dir, "benchmark"))


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents the mix takes: doc_id, size, source_size, target, taken (words, repeats counted).

    Documents it does not take, and those without words, are not in the result."""
    return mixing.mix(docs).filter(F.col("taken") > 0)


STAGES = [
    ("quality_rules", quality_rules),
    ("line_dedup", line_dedup),
    ("near_dedup", near_dedup),
    ("decontamination", decontamination),
    ("source_mix", source_mix),
]

#: SQL has neither the hash of the fingerprints nor that of the lines; a plain version stands in the tests.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents of ``sf_dir``."""
    docs, before = table(spark, sf_dir, "documents"), None
    for _, stage in STAGES:
        docs = before = cut_lineage(stage(spark, docs, sf_dir), before)
    return docs
