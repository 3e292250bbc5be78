"""Query of the embedding whitening."""

from __future__ import annotations

from parcelweave.llm.common import table
from parcelweave.llm.whitening import whiten

NAME = "op12_embedding_whitening"


def query(spark, folder):
    return whiten(table(spark, folder, "embeddings"))
