"""Query of the WARC archive: written to the shared folder, then read back."""

from __future__ import annotations

import uuid

from parcelweave.llm.common import table
from parcelweave.llm.warc import read_archive, write_archive
from parcelweave.session import scratch_path

NAME = "op7_warc_archive"


def query(spark, folder):
    path = scratch_path(spark, f"warc-{uuid.uuid4().hex}")
    write_archive(table(spark, folder, "pages"), path)
    return read_archive(spark, path).drop("url")


SQL = r"""
WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS body FROM pages),
d AS (SELECT page_id, octet_length(body)::BIGINT AS payload_bytes, sha256(body) AS payload_digest FROM p),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS first_id FROM d)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN payload_bytes >= 100 AND page_id IS DISTINCT FROM first_id THEN first_id END AS refers_to
FROM f
"""
