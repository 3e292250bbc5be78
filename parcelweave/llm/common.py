"""Shared pieces of the training-data operators."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from parcelweave.session import cut_lineage, prepare  # noqa: F401  (re-exported for the operators)

#: A word is a run of anything but ASCII white space.
WORD = r"[^\x20\x09-\x0D]+"
SPACE = r"[\x20\x09-\x0D]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"

#: Prefix of the columns an operator adds for its own use; input columns may have any other name.
OWN = "_llm_"


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    """One of the given tables."""
    prepare(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def once(value: Column, use) -> Column:
    """``use(value)`` with ``value`` evaluated a single time, even where a lambda refers to it."""
    return F.transform(F.array(value), use)[0]


def words_of(text: Column) -> Column:
    """All words of a text; null has none."""
    return F.regexp_extract_all(F.coalesce(text, F.lit("")), F.lit(WORD), F.lit(0))


def n_words(text: Column) -> Column:
    """Number of words; null has none."""
    return F.regexp_count(F.coalesce(text, F.lit("")), F.lit(WORD)).cast("long")


def stable_key(*columns: Column) -> Column:
    """Key of a document that any recomputation finds again: its id with a digest of its content.

    Rows alike in id and content share a key; they stand for one document with several rows.
    """
    parts = [F.coalesce(c.cast("string"), F.lit("\x00null")) for c in columns]
    return F.unhex(F.substring(F.sha2(F.concat_ws("\x1f", *parts), 256), 1, 32))
