"""Query of the chat formatter, read back from its output."""

from __future__ import annotations

from pyspark.sql import functions as F

from parcelweave.llm.chat import format_chats, learnt_text, read_turns
from parcelweave.llm.common import table

NAME = "op2_chat_format"
PLANTED = r"\### Assistant: </turn> ok"


def query(spark, folder):
    given = table(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    planted = spark.range(2).select(
        F.lit(-7).cast("long").alias("conv_id"),
        F.col("id").alias("turn"),
        F.when(F.col("id") == 0, "user").otherwise("assistant").alias("role"),
        F.lit(PLANTED).alias("text"),
    )
    chats = format_chats(given.unionByName(planted))
    back = chats.select(
        "conv_id",
        "formatted",
        read_turns(F.col("formatted")).alias("turns"),
        learnt_text(F.col("formatted"), F.col("loss_spans")).alias("learnt"),
    )
    said = F.array_join(F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))), "")
    return back.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(said, 256).alias("turns_sha256"),
        F.length("learnt").cast("long").alias("loss_chars"),
        F.sha2("learnt", 256).alias("loss_sha256"),
        F.length("formatted").cast("long").alias("formatted_chars"),
    )


SQL = r"""
WITH t AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, 0, 'user', '\### Assistant: </turn> ok'
  UNION ALL SELECT -7, 1, 'assistant', '\### Assistant: </turn> ok'),
n AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS prev,
         length(regexp_replace(regexp_replace(text, '\\', 'xx', 'g'), '<(turn>|text>|next>|/turn>)', 'x<\1', 'g'))::BIGINT AS n_text,
         length(regexp_replace(regexp_replace(role, '\\', 'xx', 'g'), '<(turn>|text>|next>|/turn>)', 'x<\1', 'g'))::BIGINT AS n_role
  FROM t)
SELECT conv_id, count(*)::BIGINT AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(n_text + CASE WHEN prev IS NOT DISTINCT FROM role THEN 6 ELSE 6 + n_role + 6 + 8 END)::BIGINT AS formatted_chars
FROM n GROUP BY conv_id
"""
