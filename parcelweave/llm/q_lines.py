"""Query of the line deduplication."""

from __future__ import annotations

from parcelweave.llm.common import table
from parcelweave.llm.lines import line_report

NAME = "op6_line_dedup"


def query(spark, folder):
    return line_report(table(spark, folder, "documents"))
