"""Query of the perplexity classifier."""

from __future__ import annotations

from parcelweave.llm.common import table
from parcelweave.llm.perplexity import classify

NAME = "op9_quality_classifier"


def query(spark, folder):
    return classify(table(spark, folder, "documents"), table(spark, folder, "labels"))
