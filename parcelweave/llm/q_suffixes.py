"""Query of the repeated passages."""

from __future__ import annotations

from parcelweave.llm.common import table
from parcelweave.llm.suffixes import repeated_passages

NAME = "op10_suffix_dedup"


def query(spark, folder):
    return repeated_passages(table(spark, folder, "documents"))
