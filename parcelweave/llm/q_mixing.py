"""Query of the source mix."""

from __future__ import annotations

from parcelweave.llm.common import table
from parcelweave.llm.mixing import mix

NAME = "op3_source_mix"


def query(spark, folder):
    return mix(table(spark, folder, "documents"))


def sql(docs: str = "documents") -> str:
    return rf"""
WITH d AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size,
         len(regexp_extract_all(coalesce(text, ''), '[#*$%&|<>]'))::DOUBLE AS symbols,
         (('0x' || substr(md5('mix ' || coalesce(doc_id::VARCHAR, 'null')), 1, 12))::BIGINT::DOUBLE + 0.5) / 281474976710656.0 AS u
  FROM {docs}),
k AS (
  SELECT *, -ln(u) / (1.0::DOUBLE / (1.0::DOUBLE + least(1.0::DOUBLE, symbols / greatest(size, 1)::DOUBLE))) AS key FROM d),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, ((row_number() OVER (ORDER BY source ASC NULLS LAST) - 1) % 3 + 1)::BIGINT AS w FROM s),
c AS (SELECT *, 3 * source_size AS cap, (3 * source_size)::DOUBLE / w::DOUBLE AS lvl_at FROM w),
l AS (
  SELECT *, ((SELECT sum(source_size) FROM s)::BIGINT
             - coalesce(sum(cap) OVER (ORDER BY lvl_at, source ASC NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))::DOUBLE
            / (sum(w) OVER (ORDER BY lvl_at, source ASC NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING))::DOUBLE AS level
  FROM c),
t AS (
  SELECT source, source_size,
         CASE WHEN lvl_at >= level THEN (SELECT level FROM l WHERE lvl_at >= level ORDER BY lvl_at, source NULLS FIRST LIMIT 1) * w
              ELSE cap::DOUBLE END AS target FROM l),
p AS (
  SELECT k.doc_id, k.size, t.source_size, t.target,
         CASE WHEN t.source_size > 0 THEN floor(t.target / t.source_size)::BIGINT ELSE 0 END AS epochs,
         coalesce(sum(k.size) OVER (PARTITION BY k.source ORDER BY k.key, k.doc_id, k.size ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before
  FROM k JOIN t ON k.source IS NOT DISTINCT FROM t.source)
SELECT doc_id, size, source_size, target,
       size * (epochs + (2 * before + size <= 2 * (target - epochs * source_size))::BIGINT) AS taken
FROM p
"""


SQL = sql()
