"""Prompt and chat rendering, truncation and padding of token sequences."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from folianta import fixed_values as fixed


def role_header(role: Column) -> Column:
    return F.concat(
        F.lit(fixed.HEADER_START), role, F.lit(f"{fixed.HEADER_END}\n\n")
    )


def tagged(tag: str, text: Column) -> Column:
    return F.concat(F.lit(f"<{tag}>"), F.coalesce(text, F.lit("")), F.lit(f"</{tag}>"))


def render_prompt(
    title: Column,
    abstract: Column,
    label: Column | None = None,
    instructions: str = fixed.PROMPT_INSTRUCTIONS,
    request: str = fixed.PROMPT_REQUEST,
    tags: tuple[str, str] = (fixed.PROMPT_TITLE_TAG, fixed.PROMPT_ABSTRACT_TAG),
    end_token: str = fixed.TURN_END,
) -> Column:
    """A classification prompt. With ``label`` it is a training example, answer included."""
    parts = [
        F.lit(fixed.TEXT_START),
        role_header(F.lit("system")),
        F.lit(instructions + fixed.TURN_END),
        role_header(F.lit("user")),
        F.lit(request),
        tagged(tags[0], title),
        F.lit("\n"),
        tagged(tags[1], abstract),
        F.lit(fixed.TURN_END),
        role_header(F.lit("assistant")),
    ]
    if label is not None:
        parts += [label, F.lit(end_token)]
    return F.concat(*parts)


def render_chat(
    turns: DataFrame,
    conversation: str = "conv_id",
    turn: str = "turn",
    role: str = "role",
    text: str = "text",
    segment_turns: int | None = None,
) -> DataFrame:
    """Conversations as role-marked text: ``(conversation, n_turns, chat)``.

    With ``segment_turns`` a row holds that many consecutive turn numbers at most and is
    numbered by ``segment``, for conversations that are too long for one row; joining them by
    ``segment`` gives the whole.
    """
    parts = [] if segment_turns is None else ["segment"]
    if parts:
        turns = turns.withColumn("segment", F.floor(F.col(turn) / segment_turns).cast("long"))
    marked = turns.select(
        conversation,
        *parts,
        F.col(turn).alias("at"),
        F.concat(
            role_header(F.col(role)), F.coalesce(F.col(text), F.lit("")), F.lit(fixed.TURN_END)
        ).alias("part"),
    )
    pieces = F.array_sort(F.collect_list(F.struct("at", "part")))
    return marked.groupBy(conversation, *parts).agg(
        F.count("*").alias("n_turns"),
        F.array_join(F.transform(pieces, lambda piece: piece["part"]), "").alias("chat"),
    )


def truncate(tokens: Column, limit: int, side: str = "right") -> Column:
    """At most ``limit`` tokens; ``side`` names the end that loses the rest."""
    if side == "right":
        return F.slice(tokens, 1, limit)
    surplus = F.greatest(F.size(tokens) - limit, F.lit(0))
    return F.slice(tokens, surplus + 1, F.lit(limit))


def pad(tokens: Column, length: Column, filler: str, side: str = "right") -> Column:
    missing = F.greatest(length - F.size(tokens), F.lit(0))
    filling = F.array_repeat(F.lit(filler), missing)
    return F.concat(filling, tokens) if side == "left" else F.concat(tokens, filling)


def truncate_pad(
    sequences: DataFrame,
    tokens: str,
    batch: str,
    limit: int = fixed.MAX_TOKENS,
    truncation_side: str = "left",
    padding_side: str = "left",
    filler: str = "[PAD]",
) -> DataFrame:
    """Token arrays cut to ``limit`` and padded to the longest of their batch, with a mask.

    A batch has few rows by definition, so the maximum is a window over it.
    """
    cut = sequences.withColumn(tokens, truncate(F.col(tokens), limit, truncation_side))
    longest = F.max(F.size(tokens)).over(Window.partitionBy(batch))
    real = F.array_repeat(F.lit(1), F.size(tokens))
    blank = F.array_repeat(F.lit(0), F.col("padded_length") - F.size(tokens))
    mask = F.concat(blank, real) if padding_side == "left" else F.concat(real, blank)
    return (
        cut.withColumn("padded_length", longest)
        .withColumn("attention_mask", mask)
        .withColumn(tokens, pad(F.col(tokens), F.col("padded_length"), filler, padding_side))
    )
