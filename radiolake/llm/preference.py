"""Preference pairs: a common prompt and two completions with loss masks.

The turns of two conversations are put side by side by their place. The prompt is the longest
common run of turns from the start, equal in role and text; it is rendered once. What follows in
either conversation is that side's completion, in which the assistant's turns are trained on.

The result has a row per rendered turn, so that a conversation of any length is never in one task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from radiolake.llm.ranking import ranked
from radiolake.session import stage

TRAINED_ROLE = "assistant"


def rendered(role: str = "role", text: str = "text"):
    """One turn in the chat format; missing roles and texts are empty."""
    return F.concat(
        F.lit("<|"), F.coalesce(role, F.lit("")), F.lit("|>\n"), F.coalesce(text, F.lit("")), F.lit("<|end|>\n")
    )


def format_preferences(turns: DataFrame, pairs: DataFrame) -> DataFrame:
    """pair_id, part (prompt, chosen, rejected), position, role, rendered, trained.

    `turns` has conv_id, turn, role, text; `pairs` has pair_id, side (chosen or rejected), conv_id,
    with a conversation in one pair at most. Turns are ordered by turn, role and text, NULL first,
    so repeated turn numbers and repeated rows have a place each; positions count from 0 over
    prompt and completion. Turns of no pair, or without conv_id, are left out. A pair with one
    side has an empty prompt. No turns give no rows.
    """
    named = turns.select("conv_id", "turn", "role", "text").filter("conv_id IS NOT NULL")
    places, _ = ranked(named, "conv_id", "turn", "role", "text")
    placed = stage(
        places.join(pairs.select("conv_id", "pair_id", "side"), "conv_id").select(
            "pair_id", "side", F.col("rank").alias("position"), "role", "text"
        ),
        "placed_turns",
    )
    # Two rows per place of a pair at most; places, not pairs, are the groups.
    agree = placed.groupBy("pair_id", "position").agg(
        (
            (F.count("*") == 2)
            # A missing value on one side only; min, max and the hash pass over NULL.
            & (F.count("role") != 1)
            & (F.count("text") != 1)
            & (F.min(F.xxhash64("role", "text")) == F.max(F.xxhash64("role", "text")))
            & F.min("text").eqNullSafe(F.max("text"))
            & F.min("role").eqNullSafe(F.max("role"))
        ).alias("same")
    )
    length = agree.groupBy("pair_id").agg(
        F.coalesce(F.min(F.when(~F.col("same"), F.col("position"))), F.max("position") + 1).alias("common")
    )
    each = placed.join(length, "pair_id")
    common = F.col("position") < F.col("common")
    return each.filter(~common | (F.col("side") == "chosen")).select(
        "pair_id",
        F.when(common, F.lit("prompt")).otherwise(F.col("side")).alias("part"),
        "position",
        "role",
        rendered().alias("rendered"),
        (~common & F.coalesce(F.col("role") == TRAINED_ROLE, F.lit(False))).alias("trained"),
    )


def neighbours(turns: DataFrame) -> DataFrame:
    """Pairs for a table without preferences: conversation 2k is chosen over 2k + 1."""
    ids = turns.select("conv_id").filter("conv_id IS NOT NULL").distinct()
    return ids.select(
        "conv_id",
        F.expr("conv_id div 2 - if(conv_id < 0 AND conv_id % 2 <> 0, 1, 0)").alias("pair_id"),
        F.when(F.pmod("conv_id", F.lit(2)) == 0, F.lit("chosen")).otherwise(F.lit("rejected")).alias("side"),
    )
