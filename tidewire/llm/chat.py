"""Chat formatting with array expressions: a template that can be read back, and the text under the loss mask.

A block of the output is ``<|turn|>role<|text|>text<|end|>``. Adjacent turns of one role share a block, their texts
parted by ``<|next|>``. ``<|`` in a role or text is written ``<|esc|>``, so only the template writes the other marks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

TURN, TEXT, NEXT, END, OPEN, ESCAPED = "<|turn|>", "<|text|>", "<|next|>", "<|end|>", "<|", "<|esc|>"


def escape(text: Column) -> Column:
    return F.replace(text, F.lit(OPEN), F.lit(ESCAPED))


def unescape(text: Column) -> Column:
    return F.replace(text, F.lit(ESCAPED), F.lit(OPEN))


def format_chats(turns: DataFrame, loss_role: str = "assistant") -> DataFrame:
    """(conv_id, segments, formatted) of every conversation.

    ``segments`` are the parts of ``formatted`` in order, each with a flag whether it is under the loss mask: exactly
    the (escaped) texts of ``loss_role`` are. Turns are sorted by ``turn``, then role and text; a NULL turn comes
    first, a NULL role or text is empty, rows with a NULL conv_id form one conversation. Repeated rows are turns of
    their own. The output of a conversation is one row, so its turns meet in one task, after map-side collecting.
    """
    said = turns.select(
        "conv_id",
        F.struct(
            F.col("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
        ).alias("said"),
    )
    sorted_turns = said.groupBy("conv_id").agg(F.array_sort(F.collect_list("said")).alias("turns"))
    roles = F.transform("turns", lambda t: t["role"])
    before = F.concat(F.array(F.lit(None).cast("string")), F.slice(roles, 1, F.size("turns") - 1))
    pairs = F.transform(
        F.arrays_zip(F.col("turns").alias("turn"), before.alias("before")),
        lambda p: F.struct(p["turn"]["role"].alias("role"), p["turn"]["text"].alias("text"), p["before"].alias("before")),
    )

    def segments(pair: Column) -> Column:
        opening = F.concat(F.lit(TURN), escape(pair["role"]), F.lit(TEXT))
        mark = (
            F.when(pair["before"].isNull(), opening)
            .when(pair["before"] == pair["role"], F.lit(NEXT))
            .otherwise(F.concat(F.lit(END), opening))
        )
        return F.array(
            F.struct(mark.alias("text"), F.lit(False).alias("loss")),
            F.struct(escape(pair["text"]).alias("text"), (pair["role"] == loss_role).alias("loss")),
        )

    closing = F.array(F.struct(F.lit(END).alias("text"), F.lit(False).alias("loss")))
    parts = sorted_turns.select("conv_id", F.concat(F.flatten(F.transform(pairs, segments)), closing).alias("segments"))
    return parts.withColumn("formatted", F.array_join(F.transform("segments", lambda s: s["text"]), ""))


def read_turns(formatted: Column) -> Column:
    """The (role, text) of every turn, from the formatted text alone."""

    def block_turns(block: Column) -> Column:
        role = unescape(F.substring_index(block, TEXT, 1))
        body = F.substring_index(F.substring_index(block, TEXT, -1), END, 1)
        return F.transform(
            F.split(body, r"<\|next\|>", -1),
            lambda text: F.struct(role.alias("role"), unescape(text).alias("text")),
        )

    blocks = F.split(formatted, r"<\|turn\|>", -1)
    return F.flatten(F.transform(F.slice(blocks, 2, F.size(blocks)), block_turns))


def loss_text(segments: Column) -> Column:
    """The plain text under the loss mask, in order."""
    return F.array_join(F.transform(F.filter(segments, lambda s: s["loss"]), lambda s: unescape(s["text"])), "")


def digests(formatted: DataFrame) -> DataFrame:
    """What the formatted conversations say when read back."""
    read = formatted.select("conv_id", "segments", "formatted", read_turns(F.col("formatted")).alias("turns"))
    lines = F.transform("turns", lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n")))
    return read.select(
        "conv_id",
        F.size("turns").cast("long").alias("n_turns"),
        F.sha2(F.array_join(lines, ""), 256).alias("turns_sha256"),
        F.char_length(loss_text(F.col("segments"))).cast("long").alias("loss_chars"),
        F.sha2(loss_text(F.col("segments")), 256).alias("loss_sha256"),
        F.char_length("formatted").cast("long").alias("formatted_chars"),
    )


# The same from the rows, without formatting.
DIGESTS_SQL = """
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '</s>[INST] ok [/INST]'), (-1, 1, 'assistant', '</s>[INST] ok [/INST]')
), marked AS (
  SELECT *, lag(role) OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS before FROM turns
)
SELECT conv_id, count(*) AS n_turns,
  sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
  coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
  sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, role, text) FILTER (role = 'assistant'), ''))
    AS loss_sha256,
  sum(length(replace(text, '<|', '<|esc|>')) + CASE WHEN before = role THEN length('<|next|>')
      ELSE length('<|turn|>' || replace(role, '<|', '<|esc|>') || '<|text|>' || '<|end|>') END)::BIGINT
    AS formatted_chars
FROM marked GROUP BY conv_id
"""
