"""Preference formatting (operator 4), with DataFrame functions only.

A pair has a chosen and a rejected conversation. Their longest common prefix of
turns (same turn number, role and text, from the start) is rendered once, as the
prompt; the turns after it are the two completions. Each rendered turn says
which of its characters carry loss: those of an assistant's turn in a
completion, after the role's header; none in the prompt.

The result is long: one row for each rendered turn, ordered by (pair, part,
turn). The prefix length is an aggregate (the smallest turn that differs), joined
back to the turns, so no conversation is ever gathered into one row or task; a
pair of any length spreads over tasks by (pair, turn). ``assemble`` builds one
row a pair for those who need it.

Defined cases: rows with a null pair or turn take no part; a null text is
rendered as empty, a null role as an empty role, and null equals null; a
repeated (pair, turn) is one turn, the smallest (role, text) of its rows; equal
conversations are all prompt, with empty completions; a pair that has only one
side has an empty prompt; an empty table gives an empty result; other columns
are not read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The chat template: the text of a turn between its header and its end.
HEADER, MIDDLE, END = "<|im_start|>", "\n", "<|im_end|>\n"


def one_row_a_turn(turns: DataFrame, pair_col: str, turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """``(pair, turn, said: struct<role, text>)``."""
    rows = turns.select(F.col(pair_col).alias("pair"), F.col(turn_col).alias("turn"), F.struct(F.col(role_col).alias("role"), F.col(text_col).alias("text")).alias("said"))
    return rows.where("pair IS NOT NULL AND turn IS NOT NULL").groupBy("pair", "turn").agg(F.min("said").alias("said"))


def _header(said: Column) -> Column:
    return F.concat(F.lit(HEADER), F.coalesce(said["role"], F.lit("")), F.lit(MIDDLE))


def preference_segments(chosen: DataFrame, rejected: DataFrame, assistant: str = "assistant") -> DataFrame:
    """``chosen`` and ``rejected`` are ``(pair, turn, said)`` tables, as of
    :func:`one_row_a_turn`. Returns ``(pair, part, turn, role, rendered,
    mask_from, mask_to)``: part is prompt, chosen or rejected; characters
    ``[mask_from, mask_to)`` of ``rendered`` carry loss."""
    a = chosen.select("pair", "turn", F.col("said").alias("c"), F.lit(True).alias("in_c"))
    b = rejected.select("pair", "turn", F.col("said").alias("r"), F.lit(True).alias("in_r"))
    both = a.join(b, ["pair", "turn"], "full")
    same = F.col("in_c").isNotNull() & F.col("in_r").isNotNull() & F.col("c.role").eqNullSafe(F.col("r.role")) & F.col("c.text").eqNullSafe(F.col("r.text"))
    both = both.withColumn("same", same)
    split = both.where(~F.col("same")).groupBy("pair").agg(F.min("turn").alias("split"))
    both = both.join(split, "pair", "left")
    prompt = F.col("split").isNull() | (F.col("turn") < F.col("split"))
    sides = F.array(
        F.when(prompt, F.struct(F.lit("prompt").alias("part"), F.col("c").alias("said"))),
        F.when(~prompt & F.col("in_c"), F.struct(F.lit("chosen").alias("part"), F.col("c").alias("said"))),
        F.when(~prompt & F.col("in_r"), F.struct(F.lit("rejected").alias("part"), F.col("r").alias("said"))),
    )
    rows = both.select("pair", "turn", F.inline(F.filter(sides, lambda s: s.isNotNull())))
    said = F.col("said")
    rendered = F.concat(_header(said), F.coalesce(said["text"], F.lit("")), F.lit(END))
    carries = (F.col("part") != "prompt") & F.coalesce(said["role"] == assistant, F.lit(False))
    return rows.select(
        "pair",
        "part",
        "turn",
        said["role"].alias("role"),
        rendered.alias("rendered"),
        F.when(carries, F.length(_header(said))).otherwise(0).alias("mask_from"),
        F.when(carries, F.length(rendered)).otherwise(0).alias("mask_to"),
    )


def assemble(segments: DataFrame) -> DataFrame:
    """One row a pair: ``(pair, prompt, chosen, rejected)`` texts, with the masks
    of the completions as arrays of [from, to) in their texts. A pair must fit
    in a row, as in any training example."""
    rows = segments.groupBy("pair", "part").agg(F.sort_array(F.collect_list(F.struct("turn", "rendered", "mask_from", "mask_to"))).alias("turns"))
    text = F.concat_ws("", F.transform("turns", lambda t: t["rendered"]))
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<struct<from:int,to:int>>").alias("spans"))
    masks = F.aggregate(
        "turns",
        start,
        lambda acc, t: F.struct(
            (acc["at"] + F.length(t["rendered"])).alias("at"),
            F.when(t["mask_to"] > t["mask_from"], F.concat(acc["spans"], F.array(F.struct((acc["at"] + t["mask_from"]).alias("from"), (acc["at"] + t["mask_to"]).alias("to")))))
            .otherwise(acc["spans"])
            .alias("spans"),
        ),
    )["spans"]
    parts = rows.select("pair", "part", text.alias("text"), masks.alias("masks"))

    def pick(part: str, column: str) -> Column:
        return F.max(F.when(F.col("part") == part, F.col(column)))

    empty = F.lit("")
    return parts.groupBy("pair").agg(
        F.coalesce(pick("prompt", "text"), empty).alias("prompt"),
        F.coalesce(pick("chosen", "text"), empty).alias("chosen"),
        F.coalesce(pick("rejected", "text"), empty).alias("rejected"),
        pick("chosen", "masks").alias("chosen_masks"),
        pick("rejected", "masks").alias("rejected_masks"),
    )


def swapped_endings(turns: DataFrame) -> DataFrame:
    """Rejected counterparts for ``(pair, turn, said)`` conversations with whole
    numbers as pairs: the last turn is replaced by that of the neighbour, the
    pair whose number differs in the lowest bit, and left out without one."""
    last = turns.groupBy("pair").agg(F.max(F.struct("turn", "said")).alias("last"))
    other = last.select(F.col("pair").bitwiseXOR(F.lit(1)).alias("pair"), F.col("last.said").alias("theirs"))
    joined = turns.join(last.select("pair", F.col("last.turn").alias("end")), "pair").join(other, "pair", "left")
    said = F.when(F.col("turn") < F.col("end"), F.col("said")).otherwise(F.col("theirs"))
    return joined.where("turn < end OR theirs IS NOT NULL").select("pair", "turn", said.alias("said"))
