"""Preference pairs as text with marked completions.

A pair holds two conversations. The turns at their beginning that are alike, role and text, are the
prompt and are written once; the rest of each is its completion. In a completion only what the assistant says,
with the mark that ends the turn, is to be learned. All of it are built-in functions on arrays.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from reedbed.llm.common import column

#: How a turn is written: ``<|role|>``, a line break, the text, ``<|end|>``, a line break.
HEAD, TAIL, LEARNED_ROLE = ("<|", "|>\n"), "<|end|>\n", "assistant"


def conversations(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """One row for each conversation: ``conv`` and its ``turns`` in order (turn number, then role and text).

    Null roles and texts count as empty. A repeated turn is kept as often as it is there.
    """
    one = F.struct(column(turn).alias("turn"), F.coalesce(column(role), F.lit("")).alias("role"), F.coalesce(column(text), F.lit("")).alias("text"))
    grouped = turns.groupBy(column(conv).alias(conv)).agg(F.sort_array(F.collect_list(one)).alias("turns"))
    return grouped.withColumn("turns", F.transform("turns", lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text"))))


def _written(turn: Column) -> Column:
    return F.concat(F.lit(HEAD[0]), turn["role"], F.lit(HEAD[1]), turn["text"], F.lit(TAIL))


def _text(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _written), "")


def _mask(turns: Column) -> Column:
    """Spans (start, end) in the written turns that are to be learned, ends exclusive, in code points."""
    start = F.struct(F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans"))

    def step(held: Column, turn: Column) -> Column:
        low = held["at"] + F.length(turn["role"]) + len(HEAD[0]) + len(HEAD[1])
        high = low + F.length(turn["text"]) + len(TAIL) - 1
        span = F.struct(low.cast("long").alias("start"), high.cast("long").alias("end"))
        spans = F.when(turn["role"] == LEARNED_ROLE, F.concat(held["spans"], F.array(span))).otherwise(held["spans"])
        return F.struct((high + 1).cast("long").alias("at"), spans.alias("spans"))

    return F.aggregate(turns, start, step, lambda held: held["spans"])


def format_pairs(pairs: DataFrame, key: str = "pair_id", chosen: str = "chosen", rejected: str = "rejected") -> DataFrame:
    """``key``, ``prompt_turns``, ``prompt``, ``chosen``, ``chosen_mask``, ``rejected``, ``rejected_mask``.

    Null or empty conversations have no turns: the prompt is empty then. Equal conversations are all
    prompt, with empty completions. One row for each pair, repeated ones included.
    """
    none = F.array().cast("array<struct<role:string,text:string>>")
    held = pairs.select(column(key).alias(key), F.coalesce(column(chosen), none).alias("_a"), F.coalesce(column(rejected), none).alias("_b"))
    shorter = F.least(F.size("_a"), F.size("_b"))
    differs = F.transform(F.arrays_zip("_a", "_b"), lambda t: ~t["_a"].eqNullSafe(t["_b"]))
    # Behind the end of the shorter one the zipped turns differ, so the first difference is the common length.
    common = F.when(F.array_contains(differs, True), F.array_position(differs, True).cast("int") - 1).otherwise(shorter)
    cut = held.withColumn("prompt_turns", common)
    rest = {c: F.slice(c, F.col("prompt_turns") + 1, F.greatest(F.size(c) - F.col("prompt_turns"), F.lit(0))) for c in ("_a", "_b")}
    cut = cut.select(key, "prompt_turns", F.slice("_a", 1, F.col("prompt_turns")).alias("_p"), rest["_a"].alias("_a"), rest["_b"].alias("_b"))
    return cut.select(
        key, "prompt_turns", _text(F.col("_p")).alias("prompt"),
        _text(F.col("_a")).alias("chosen"), _mask(F.col("_a")).alias("chosen_mask"),
        _text(F.col("_b")).alias("rejected"), _mask(F.col("_b")).alias("rejected_mask"),
    )


def swapped_answers(turns: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """Pairs from plain conversations: ``pair_id``, ``chosen``, ``rejected``.

    The chosen one is the conversation. The rejected one ends with the neighbour's last answer in place of
    its own last answer and what follows; neighbours are the conversations 2k and 2k + 1. Without an
    answer on either side it ends before the answer. Two neighbours meet in one group of two conversations.
    """
    whole = conversations(turns, conv, turn, role, text)
    answers = F.filter("turns", lambda t: t["role"] == LEARNED_ROLE)
    flags = F.transform(F.reverse("turns"), lambda t: t["role"] == LEARNED_ROLE)
    at = F.array_position(flags, True).cast("int")  # from the end
    kept = F.when(F.size(answers) > 0, F.slice("turns", 1, F.size("turns") - at)).otherwise(F.col("turns"))
    parts = whole.select(F.col(conv).alias("pair_id"), F.col("turns").alias("chosen"), kept.alias("kept"), F.slice(F.reverse(answers), 1, 1).alias("answer"))
    other = parts.select(F.col("pair_id").bitwiseXOR(F.lit(1)).alias("pair_id"), F.col("answer").alias("other"))
    paired = parts.join(other, "pair_id", "left")
    return paired.select("pair_id", "chosen", F.concat("kept", F.coalesce("other", F.slice("kept", 1, 0))).alias("rejected"))
