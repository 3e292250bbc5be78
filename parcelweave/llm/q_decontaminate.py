"""Query of the benchmark decontamination."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelweave.llm.common import table
from parcelweave.llm.decontaminate import contamination, judged

NAME = "op8_decontamination"


def query(spark, folder):
    found = judged(contamination(table(spark, folder, "documents"), table(spark, folder, "benchmark")))
    return found.select("doc_id", "n_words", "n_hit", "n_items", F.sha2(F.array_join("items", ","), 256).alias("items_sha256"), "contaminated")


def contaminated_sql(docs: str = "documents") -> str:
    """Common table expressions ending in ``decon(doc_id, n_words, n_hit, n_items, items_sha256, contaminated)``."""
    words = "regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')"
    return f"""
dw AS (SELECT row_number() OVER () AS k, doc_id, {words} AS w FROM {docs}),
iw AS (SELECT item_id::VARCHAR AS item, {words} AS w FROM benchmark),
pw AS (
  SELECT DISTINCT item, least(13, len(w)) AS n, list_aggregate(w[i:i + least(13, len(w)) - 1], 'string_agg', ' ') AS win
  FROM (SELECT item, w, unnest(range(1, greatest(1, len(w) - 12) + 1)) AS i FROM iw WHERE len(w) > 0)),
lens AS (SELECT DISTINCT n FROM pw),
dwin AS (
  SELECT k, n, i, list_aggregate(w[i:i + n - 1], 'string_agg', ' ') AS win
  FROM (SELECT k, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM dw, lens WHERE len(w) >= n)),
found AS (SELECT d.k, d.i, d.n, p.item FROM dwin d JOIN pw p ON d.n = p.n AND d.win = p.win),
hits AS (SELECT k, count(DISTINCT wpos) AS n_hit FROM (SELECT k, unnest(range(i, i + n)) AS wpos FROM (SELECT DISTINCT k, i, n FROM found)) GROUP BY k),
its AS (SELECT k, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items FROM (SELECT DISTINCT k, item FROM found) GROUP BY k),
decon AS (
  SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
         sha256(coalesce(items, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
  FROM dw LEFT JOIN hits USING (k) LEFT JOIN its USING (k))"""


SQL = f"WITH {contaminated_sql()} SELECT * FROM decon"
