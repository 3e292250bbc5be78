"""Query of the quality cascade."""

from __future__ import annotations

from parcelweave.llm.common import table
from parcelweave.llm.quality import measure

NAME = "op1_quality_rules"


def query(spark, folder):
    return measure(table(spark, folder, "documents"))


SQL = r"""
WITH t AS (
  SELECT row_number() OVER () AS k, doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w,
         list_filter(string_split(coalesce(text, ''), chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines
  FROM documents),
wins AS (
  SELECT k, i, list_aggregate(w[i:i + 7], 'string_agg', ' ') AS win
  FROM (SELECT k, w, unnest(range(1, len(w) - 6)) AS i FROM t WHERE len(w) >= 8)),
hits AS (SELECT k, i FROM (SELECT k, i, count(*) OVER (PARTITION BY k, win) AS n FROM wins) WHERE n > 1),
cover AS (
  SELECT k, sum(least(8, coalesce(nxt - i, 8)))::BIGINT AS n
  FROM (SELECT k, i, lead(i) OVER (PARTITION BY k ORDER BY i) AS nxt FROM hits) GROUP BY k),
base AS (
  SELECT t.k, doc_id, text, w, lines, len(w)::BIGINT AS n_words,
         length(regexp_replace(text, '[\x20\x09-\x0D]+', '', 'g'))::BIGINT AS word_chars,
         len(regexp_extract_all(text, '[#*$%&|<>]'))::BIGINT AS n_symbols,
         (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines,
         coalesce(cover.n, 0)::BIGINT AS n_repeat_words
  FROM t LEFT JOIN cover ON t.k = cover.k),
judged AS (
  SELECT *, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM base)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
       NOT (base_failed
            OR 100 * n_symbols > 20 * n_words
            OR len(regexp_extract_all(text, '\p{Lu}')) > 0.5 * len(regexp_extract_all(text, '\p{L}'))
            OR 10 * n_dup_lines > 4 * len(lines)
            OR 100 * len(list_filter(range(2, len(w) + 1), lambda i: w[i] = w[i - 1])) > 30 * n_words
            OR word_chars < 2 * n_words OR word_chars > 14 * n_words) AS kept
FROM judged
"""
