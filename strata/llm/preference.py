"""Preference formatting: one prompt, two masked completions.

For each pair the longest common prefix of turns of the chosen and the
rejected conversation is rendered once as the prompt; what is left of either
side becomes its completion, with the spans a trainer may learn from: the
assistant's text and its end mark. DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

END = "<|end|>"
TRAINED_ROLE = "assistant"


def _clean(value: Column) -> Column:
    """Text that cannot be read as a mark."""
    return F.replace(F.coalesce(value, F.lit("")), F.lit("<|"), F.lit("< |"))


def _head(turn: Column) -> Column:
    return F.concat(F.lit("<|"), turn["role"], F.lit("|>\n"))


def _render(turns: Column) -> Column:
    return F.array_join(F.transform(turns, lambda t: F.concat(_head(t), t["text"], F.lit(f"{END}\n"))), "")


def _spans(turns: Column) -> Column:
    """``start:end`` (code points, end exclusive) of every trained stretch."""

    def step(seen: Column, turn: Column) -> Column:
        start = seen["at"] + F.length(_head(turn))
        end = start + F.length(turn["text"]) + len(END)
        span = F.concat_ws(":", start.cast("string"), end.cast("string"))
        spans = F.when(turn["role"] == TRAINED_ROLE, F.concat(seen["spans"], F.array(span))).otherwise(seen["spans"])
        return F.struct((end + 1).alias("at"), spans.alias("spans"))

    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))
    return F.array_join(F.aggregate(turns, start, step, lambda seen: seen["spans"]), ",")


def format_preferences(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """``chosen`` and ``rejected`` have ``pair_id, turn, role, text``, one row per turn.

    One row per pair_id of either side: ``pair_id``, ``status``,
    ``prompt_turns``, ``prompt``, ``chosen``, ``rejected``, ``chosen_mask``,
    ``rejected_mask``. ``status`` is ``pair`` when both completions hold
    turns, ``equal`` when the conversations are the same, otherwise
    ``chosen_empty`` or ``rejected_empty`` (one is a prefix of the other, or
    missing).

    Turns are ordered by turn number (null last), then role and text, so ties
    and repeated rows have a defined order and stay. Null roles and texts
    render as empty. Rows with a null pair_id belong to no pair and are left
    out. Empty tables give no rows; other columns are ignored. A rendered
    conversation is one value, so its turns meet in one task; nothing else does.
    """
    sides = [
        df.select(
            "pair_id",
            F.struct(
                F.col("turn").isNull().alias("last"),
                F.col("turn").cast("long").alias("turn"),
                _clean(F.col("role")).alias("role"),
                _clean(F.col("text")).alias("text"),
            ).alias(name),
        )
        for name, df in (("c", chosen), ("r", rejected))
    ]
    rows = sides[0].unionByName(sides[1], allowMissingColumns=True).filter("pair_id is not null")
    pairs = rows.groupBy("pair_id").agg(*(F.sort_array(F.collect_list(side)).alias(side) for side in ("c", "r")))
    both = F.least(F.size("c"), F.size("r"))
    same = F.zip_with(
        F.slice("c", F.lit(1), both),
        F.slice("r", F.lit(1), both),
        lambda a, b: (a["role"] == b["role"]) & (a["text"] == b["text"]),
    )
    differs = F.array_position(same, False)
    counted = pairs.withColumn("prompt_turns", F.when(differs > 0, differs - 1).otherwise(both).cast("int"))
    after = [
        F.slice(side, F.col("prompt_turns") + 1, F.size(side)).alias(f"{side}_rest") for side in ("c", "r")
    ]
    cut = counted.select("pair_id", "prompt_turns", F.slice("c", F.lit(1), F.col("prompt_turns")).alias("shared"), *after)
    no_c, no_r = F.size("c_rest") == 0, F.size("r_rest") == 0
    status = (
        F.when(no_c & no_r, "equal").when(no_c, "chosen_empty").when(no_r, "rejected_empty").otherwise("pair")
    )
    return cut.select(
        "pair_id",
        status.alias("status"),
        "prompt_turns",
        _render(F.col("shared")).alias("prompt"),
        _render(F.col("c_rest")).alias("chosen"),
        _render(F.col("r_rest")).alias("rejected"),
        _spans(F.col("c_rest")).alias("chosen_mask"),
        _spans(F.col("r_rest")).alias("rejected_mask"),
    )


def swapped_answers(conversations: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Preference data from plain ``conversations(conv_id, turn, role, text)``.

    Chosen: a conversation up to its last assistant turn (whole, if it has
    none). Rejected: the same with that turn's text taken from the last
    assistant turn of its neighbour, the conversation whose id differs in the
    lowest bit; without such a neighbour the turn is left out. Repeated turns
    count as one answer: the greatest text of the last turn number stands.
    """
    turns = conversations.select(F.col("conv_id").cast("long").alias("pair_id"), "turn", "role", "text")
    answer = F.struct("turn", "text")
    last = (
        turns.filter((F.col("role") == TRAINED_ROLE) & F.col("turn").isNotNull())
        .groupBy("pair_id")
        .agg(F.max(answer).alias("answer"))
    )
    swapped = last.select(F.col("pair_id").bitwiseXOR(F.lit(1)).alias("pair_id"), F.col("answer.text").alias("other"))
    swapped = swapped.withColumn("has_other", F.lit(True))
    known = last.select("pair_id", F.col("answer.turn").alias("end")).join(swapped, "pair_id", "left")
    cut = turns.join(known, "pair_id", "left").filter("end is null or turn <= end")
    is_last = (F.col("role") == TRAINED_ROLE) & (F.col("turn") == F.col("end"))
    is_last = F.coalesce(is_last, F.lit(False))
    chosen = cut.select("pair_id", "turn", "role", "text")
    rejected = cut.filter(~is_last | F.col("has_other")).select(
        "pair_id", "turn", "role", F.when(is_last, F.col("other")).otherwise(F.col("text")).alias("text")
    )
    return chosen, rejected
