"""Query of the SimHash near-duplicates."""

from __future__ import annotations

from parcelweave.llm.common import table
from parcelweave.llm.simhash import hex_digits, near_duplicates

NAME = "op4_simhash_dedup"


def query(spark, folder):
    found = near_duplicates(table(spark, folder, "documents"))
    return found.select("doc_id", hex_digits(found["fp"]).alias("fingerprint"), "component_id")
