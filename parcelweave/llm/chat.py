"""Chat formatting with Spark expressions only.

The turns of a conversation are collected as structs and sorted, adjacent turns of one role are
merged by an array aggregation, and the blocks are concatenated::

    <turn>role<text>first text<next>second text</turn>\\n

``<next>`` parts the texts of merged turns.  In roles and texts a backslash is doubled and the ``<``
that begins a control string becomes ``\\l``, so a control string in the output is always one of the
template's, and everything can be read back.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from parcelweave.llm.common import OWN

TURN, TEXT, NEXT, END = "<turn>", "<text>", "<next>", "</turn>\n"
#: Pieces that are counted at a time.
BLOCK = 256
_CONTROL = r"<(?=turn>|text>|next>|/turn>)"


def escape(text: Column) -> Column:
    """Backslashes doubled, control strings broken; null is empty."""
    doubled = F.replace(F.coalesce(text, F.lit("")), F.lit("\\"), F.lit("\\\\"))
    return F.regexp_replace(doubled, _CONTROL, r"\\l")


def unescape(text: Column) -> Column:
    """Inverse of :func:`escape`: a lone ``\\l`` follows an even run of backslashes."""
    opened = F.regexp_replace(text, r"(?<!\\)((?:\\\\)*)\\l", "$1<")
    return F.replace(opened, F.lit("\\\\"), F.lit("\\"))


def format_chats(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text", learn: str = "assistant") -> DataFrame:
    """One row per conversation: its id, ``formatted``, and ``loss_spans``, the places (start from 1,
    length, in code points) of the texts of role ``learn``.

    Turns go by ``turn``, nulls first, ties by role, then text; repeated rows are turns of their own.
    Null roles and texts are empty; rows with a null conversation form one conversation.  Texts of any
    length are kept whole.  An empty table gives no rows; further columns are left out.
    """
    rows = turns.select(
        F.col(conv).alias("conv_id"),
        F.struct(
            F.col(turn).alias("turn"),
            F.coalesce(F.col(role), F.lit("")).alias("role"),
            F.coalesce(F.col(text), F.lit("")).alias("text"),
        ).alias(f"{OWN}t"),
    )
    chats = rows.groupBy("conv_id").agg(F.sort_array(F.collect_list(f"{OWN}t")).alias(f"{OWN}t"))

    # Pieces of output in order: what stands before a text, the text, and whether it is learnt.
    pieces = F.transform(
        F.col(f"{OWN}t"),
        lambda t, i: F.struct(
            F.when(_role(i - 1) == t["role"], F.lit(NEXT))
            .otherwise(F.concat(F.when(i > 0, F.lit(END)).otherwise(F.lit("")), F.lit(TURN), escape(t["role"]), F.lit(TEXT)))
            .alias("lead"),
            escape(t["text"]).alias("text"),
            (t["role"] == F.lit(learn)).alias("learn"),
        ),
    )
    chats = chats.select("conv_id", pieces.alias(f"{OWN}p"))
    formatted = F.concat(F.array_join(F.transform(f"{OWN}p", lambda p: F.concat(p["lead"], p["text"])), ""), F.lit(END))
    spans = F.expr("array_repeat(named_struct('start', 0L, 'length', 0L), 0)")
    empty = F.struct(F.lit(0).cast("long").alias("at"), spans.alias("spans"))

    def step(state: Column, p: Column) -> Column:
        start = state["at"] + F.length(p["lead"])
        length = F.length(p["text"]).cast("long")
        span = F.array(F.struct(start.alias("start"), length.alias("length")))
        return F.struct(
            (start + length).alias("at"),
            F.when(p["learn"], F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"),
        )

    # An array that grows by one is copied each time, so blocks of pieces are counted from their own start.
    first = F.sequence(F.lit(0), F.floor((F.size(f"{OWN}p") - 1) / BLOCK).cast("int"))
    blocks = F.transform(first, lambda b: F.aggregate(F.slice(f"{OWN}p", b * BLOCK + 1, BLOCK), empty, step))
    chats = chats.select("conv_id", formatted.alias("formatted"), blocks.alias(f"{OWN}b"))
    before = F.aggregate(
        f"{OWN}b",
        F.struct(F.lit(1).cast("long").alias("at"), F.expr("array_repeat(0L, 0)").alias("starts")),
        lambda s, b: F.struct((s["at"] + b["at"]).alias("at"), F.concat(s["starts"], F.array(s["at"])).alias("starts")),
        lambda s: s["starts"],
    )
    chats = chats.withColumn(f"{OWN}s", before)
    moved = F.transform(
        F.arrays_zip(F.col(f"{OWN}b").alias("b"), F.col(f"{OWN}s").alias("s")),
        lambda z: F.transform(z["b"]["spans"], lambda x: F.struct((x["start"] + z["s"]).alias("start"), x["length"].alias("length"))),
    )
    return chats.select("conv_id", "formatted", F.flatten(moved).alias("loss_spans"))


def _role(i: Column) -> Column:
    return F.get(F.col(f"{OWN}t"), i)["role"]


def read_turns(formatted: Column) -> Column:
    """The turns of a formatted conversation, as an array of (role, text)."""
    blocks = F.filter(F.split(formatted, "(?<=</turn>\n)(?=<turn>|$)"), lambda b: b != "")

    def turns(block: Column) -> Column:
        inner = F.substring(block, len(TURN) + 1, F.length(block) - len(TURN) - len(END))
        parts = F.split(inner, TEXT, 2)
        return F.transform(
            F.split(parts[1], NEXT), lambda t: F.struct(unescape(parts[0]).alias("role"), unescape(t).alias("text"))
        )

    return F.flatten(F.transform(blocks, turns))


def learnt_text(formatted: Column, spans: Column) -> Column:
    """All text under the loss mask, unescaped, nothing between."""
    return F.array_join(F.transform(spans, lambda s: unescape(F.substring(formatted, s["start"].cast("int"), s["length"].cast("int")))), "")
