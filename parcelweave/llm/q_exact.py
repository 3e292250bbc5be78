"""Query of the exact deduplication."""

from __future__ import annotations

from parcelweave.llm.common import table
from parcelweave.llm.exact import classes

NAME = "op13_exact_dedup"


def query(spark, folder):
    return classes(table(spark, folder, "documents"))


SQL = r"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS body FROM documents),
g AS (SELECT doc_id, body, max(doc_id) OVER (PARTITION BY body) AS keep_id, count(*) OVER (PARTITION BY body) AS group_size FROM d)
SELECT doc_id, keep_id, group_size, doc_id IS NOT DISTINCT FROM keep_id AS kept, sha256(body) AS text_sha256
FROM g
"""
