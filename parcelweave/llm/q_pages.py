"""Query of the main-text extraction."""

from __future__ import annotations

from parcelweave.llm.common import table
from parcelweave.llm.pages import extract

NAME = "op5_html_extract"


def query(spark, folder):
    return extract(table(spark, folder, "pages"))
