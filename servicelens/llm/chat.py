"""Chat formatting by multi-party perspective rotation.

For every participant of a conversation the dialogue is rendered once with
that speaker as the assistant and all others as named users; the mask covers
what the assistant says, so that each party's lines are learnt once.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Fixed values of the chat template.
OPEN, CLOSE, SYSTEM, ASSISTANT = "<|im_start|>", "<|im_end|>", "system", "assistant"


@dataclass(frozen=True)
class ChatParams:
    #: Turns a rendered part covers by their number; longer dialogues go on in further parts.
    turns_a_part: int = 512


def _safe(text: Column) -> Column:
    """Text that cannot be read as a template mark."""
    return F.replace(text, F.lit("<|"), F.lit("< |"))


def _head(role: Column, me: Column) -> Column:
    return (
        F.when(role == me, F.lit(f"{OPEN}{ASSISTANT}\n"))
        .when(role == SYSTEM, F.lit(f"{OPEN}{SYSTEM}\n"))
        .otherwise(F.concat(F.lit(f"{OPEN}user name="), F.regexp_replace(_safe(role), r"\s+", "_"), F.lit("\n")))
    )


def rotate(conversations: DataFrame, params: ChatParams | None = None) -> DataFrame:
    """(conv_id, perspective, part, n_turns, text, spans): one row for each participant and part.

    Turns are ordered by (turn, role, text); exact repeats of a turn count
    once. Every role but ``system`` is a participant. ``spans`` are the
    [start, stop) characters of the assistant's text and closing marks, which
    are trained on. A NULL or empty role is named ``unknown``; a NULL text is
    an empty one; a NULL turn comes first. Rows of a NULL conv_id belong to no
    known dialogue: each different one is rendered as a dialogue of its own. A conversation with system turns only gives no row, nor does
    an empty table. Other columns are not read.
    """
    p = params or ChatParams()
    role = F.coalesce(F.nullif(F.trim(F.col("role").cast("string")), F.lit("")), F.lit("unknown"))
    turns = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), role.alias("role"),
        F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"),
    )
    part = F.coalesce(F.floor(F.col("turn") / p.turns_a_part), F.lit(0)).alias("part")
    # rows without a conversation are told apart by a digest, so that they never meet in one group
    digest = F.sha2(F.concat_ws("\x1f", F.coalesce(F.col("turn").cast("string"), F.lit("")), "role", "text"), 256)
    turns = turns.withColumn("alone", F.when(F.col("conv_id").isNull(), digest).otherwise(F.lit("")))
    # a set, so that repeated rows are merged in each map task before the shuffle
    parts = turns.groupBy("conv_id", "alone", part).agg(F.sort_array(F.collect_set(F.struct("turn", "role", "text"))).alias("turns"))
    people = turns.where(F.col("role") != SYSTEM).select(F.col("conv_id").alias("__conv"), F.col("alone").alias("__alone"), F.col("role").alias("perspective")).distinct()
    seen = parts.join(people, F.col("conv_id").eqNullSafe(F.col("__conv")) & (F.col("alone") == F.col("__alone")))

    me = F.col("perspective")
    pieces = F.transform("turns", lambda t: F.struct(
        _head(t["role"], me).alias("head"), F.concat(_safe(t["text"]), F.lit(CLOSE)).alias("body"), (t["role"] == me).alias("mine")))
    spans = F.aggregate(
        "pieces",
        F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<start:int,stop:int>>").alias("spans")),
        lambda s, x: F.struct(
            (s["at"] + F.length(x["head"]) + F.length(x["body"]) + 1).alias("at"),
            F.when(x["mine"], F.array_append(s["spans"], F.struct(
                (s["at"] + F.length(x["head"])).alias("start"),
                (s["at"] + F.length(x["head"]) + F.length(x["body"])).alias("stop")))).otherwise(s["spans"]).alias("spans"),
        ),
    )["spans"]
    return seen.select("conv_id", "perspective", "part", F.size("turns").alias("n_turns"), pieces.alias("pieces")).select(
        "conv_id", "perspective", "part", "n_turns",
        F.array_join(F.transform("pieces", lambda x: F.concat(x["head"], x["body"], F.lit("\n"))), "").alias("text"),
        spans.alias("spans"),
    )
