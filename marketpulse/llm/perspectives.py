"""Perspective rotation of multi-party dialogues: one training example per participant.

For every participant of a conversation the whole dialogue is rendered with that speaker as the assistant and all others
as users who carry their names; the mask marks what the assistant says, and nothing else is a training target. Context
roles (the system prompt) stay what they are in every rendering and are nobody's perspective.

A conversation is rendered in parts of `turns_per_part` turn numbers, so a dialogue of millions of turns is never put
together in one task: its rendering is its parts, one after another. Usual dialogues have part 0 only. Turn numbers do
not bound rows, as turns may repeat, have no number, or belong to no conversation. A part of more than `rows_per_part`
rows is therefore cut, in the order of its turns, into parts of so many rows, and the parts after it in its conversation
are numbered on. One after another, the pieces' texts are the text that the part would have whole.

Turns are ordered by turn, role and text, nulls first, so ties have one order; a repeated row is rendered as often as it
occurs. A turn without a role is a user without a name, and one without a text has an empty body. Turns without a turn
number come first, from part -1 on. Rows without a conversation id are one conversation. A conversation in which only context
roles speak is rendered once, for the participant null and without a mask. An empty table gives no row.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame, Window, functions as F

from marketpulse.llm.common import settle
from marketpulse.operators.sizing import broadcast_when_small

CONTEXT_ROLES = ("system",)
TURNS_PER_PART, ROWS_PER_PART = 256, 4096
BEGIN, END = "<|im_start|>", "<|im_end|>\n"


def safe_name(role: Column) -> Column:
    """A speaker's name on a header line: no blanks and no marker characters."""
    return F.regexp_replace(role, r"[\x20\x09-\x0D<>|]", "_")


def safe_body(text: Column) -> Column:
    """A body in which no marker can be read: the markers' first characters are set apart."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|im_"), F.lit("<| im_"))


def header(role: Column, participant: Column, context_roles: Sequence[str]) -> Column:
    return F.concat(
        F.lit(BEGIN),
        F.when(role == participant, F.lit("assistant"))
        .when(role.isNull(), F.lit("user"))
        .when(role.isin(*context_roles), role)
        .otherwise(F.concat(F.lit("user name="), safe_name(role))),
        F.lit("\n"),
    )


def same(left: Sequence[str], right: Sequence[str]) -> Column:
    """Columns are equal pair by pair, nulls too."""
    return reduce(and_, (F.col(a).eqNullSafe(F.col(b)) for a, b in zip(left, right)))


def running(df: DataFrame, group: Sequence[str], order: Sequence[str], amount: str) -> DataFrame:
    """`df` with `at`, the sum of `amount` over the rows of the group that come before by `order`, which has no ties.

    Rows are sorted into ranges, and each range starts from the sum of the ones before it, so a group spreads over tasks.
    """
    before = (Window.unboundedPreceding, -1)
    ranges = settle(df.orderBy(*group, *order).withColumn("_range", F.spark_partition_id()))
    sums = ranges.groupBy(*group, "_range").agg(F.sum(amount).alias("_sum"))
    keys = [*group, "_range"]
    starts = settle(sums.select(
        *[F.col(c).alias(f"_{c}") for c in keys],
        F.coalesce(F.sum("_sum").over(Window.partitionBy(*group).orderBy("_range").rowsBetween(*before)), F.lit(0)).alias("_start"),
    ))
    inside = F.coalesce(F.sum(amount).over(Window.partitionBy(*keys).orderBy(*order).rowsBetween(*before)), F.lit(0))
    joined = ranges.withColumn("_inside", inside).join(broadcast_when_small(starts), same(keys, [f"_{c}" for c in keys]))
    return joined.select(*df.columns, (F.col("_start") + F.col("_inside")).alias("at"))


def whole_parts(turns: DataFrame) -> DataFrame:
    """(conv_id, part, turns): the turns of each part in order."""
    return turns.groupBy("conv_id", "part").agg(F.array_sort(F.collect_list(F.struct("turn", "role", "text"))).alias("turns"))


def cut_parts(turns: DataFrame, over: DataFrame, bound: int) -> DataFrame:
    """(conv_id, part, turns) as `whole_parts` has them, but the parts in `over` come in pieces of at most `bound` rows."""
    part, piece = ["conv_id", "part"], F.col("piece")
    keys = broadcast_when_small(over.select(F.col("conv_id").alias("_conv"), F.col("part").alias("_part")))
    is_over = same(part, ["_conv", "_part"])
    # Equal rows are counted, so neither many turns nor many copies of one lie in one task.
    copies = turns.join(keys, is_over, "left_semi").groupBy(*part, "turn", "role", "text").agg(F.count("*").alias("n"))
    placed = running(copies, part, ["turn", "role", "text"], "n").withColumn("end", F.col("at") + F.col("n"))
    dealt = placed.withColumn("piece", F.explode(F.sequence(F.floor(F.col("at") / bound), F.floor((F.col("end") - 1) / bound))))
    own = F.least("end", (piece + 1) * bound) - F.greatest("at", piece * bound)
    cut = dealt.groupBy(*part, "piece").agg(
        F.array_sort(F.collect_list(F.struct("turn", "role", "text", own.cast("int").alias("n")))).alias("turns")
    ).withColumn("turns", F.flatten(F.transform(
        "turns", lambda t: F.array_repeat(F.struct(t["turn"].alias("turn"), t["role"].alias("role"), t["text"].alias("text")), t["n"])
    )))
    usual = whole_parts(turns.join(keys, is_over, "left_anti")).withColumn("piece", F.lit(0).cast("bigint"))
    # How far the pieces of earlier parts move a part's number; conversations without a cut part keep theirs.
    hot = broadcast_when_small(settle(over.select(F.col("conv_id").alias("_conv")).distinct()))
    extra = turns.join(hot, same(["conv_id"], ["_conv"]), "left_semi").groupBy(*part).agg(
        F.floor((F.count("*") - 1) / bound).alias("extra")
    )
    moved = settle(running(extra, ["conv_id"], ["part"], "extra").select(
        F.col("conv_id").alias("_conv"), F.col("part").alias("_part"), F.col("at").alias("moved")
    ))
    return usual.unionByName(cut).join(broadcast_when_small(moved), is_over, "left").select(
        "conv_id", (F.col("part") + F.coalesce("moved", F.lit(0)) + piece).alias("part"), "turns"
    )


def rotate(
    turns: DataFrame, context_roles: Sequence[str] = CONTEXT_ROLES, turns_per_part: int = TURNS_PER_PART,
    rows_per_part: int = ROWS_PER_PART,
) -> DataFrame:
    """(conv_id, participant, part, n_turns, text, mask): mask is an array of (start, end) character offsets in text.

    The rows of each part are counted first. Then one shuffle of the turns by conversation and part, one of the distinct
    roles, which are combined before it. Spark joins the two by conversation; a hot conversation has one row for each
    part there. Parts of too many rows are sorted and cut first, and only they.
    """
    part = F.coalesce(F.floor(F.col("turn") / turns_per_part).cast("bigint"), F.lit(-1).cast("bigint"))
    turns = turns.select("conv_id", "turn", "role", "text", part.alias("part"))
    over = settle(turns.groupBy("conv_id", "part").agg(F.count("*").alias("rows")).where(F.col("rows") > rows_per_part))
    parts = whole_parts(turns) if over.isEmpty() else cut_parts(turns, over, rows_per_part)
    speakers = turns.where(F.col("role").isNotNull() & ~F.col("role").isin(*context_roles)).select(
        F.col("conv_id").alias("speaker_conv"), "role"
    ).distinct()
    nobody = F.lit(None).cast("string")
    # A left join keeps conversations in which nobody but the context speaks.
    seats = parts.join(speakers, F.col("conv_id").eqNullSafe(F.col("speaker_conv")), "left").select(
        "conv_id", F.coalesce(F.col("role"), nobody).alias("participant"), "part", "turns"
    )
    who = F.col("participant")
    lines = seats.select(
        "conv_id", "participant", "part",
        F.transform("turns", lambda t: F.struct(
            header(t["role"], who, context_roles).alias("head"),
            safe_body(t["text"]).alias("body"),
            F.coalesce(t["role"] == who, F.lit(False)).alias("target"),
        )).alias("lines"),
    )
    none = F.array().cast("array<struct<start:int,end:int>>")

    def move(state: Column, line: Column) -> Column:
        start = state["at"] + F.length(line["head"])
        end = start + F.length(line["body"])
        span = F.array(F.struct(start.alias("start"), end.alias("end")))
        return F.struct(
            (end + len(END)).alias("at"),
            F.when(line["target"], F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"),
        )

    walked = F.aggregate("lines", F.struct(F.lit(0).alias("at"), none.alias("spans")), move)
    return lines.select(
        "conv_id", "participant", "part", F.size("lines").alias("n_turns"),
        F.array_join(F.transform("lines", lambda l: F.concat(l["head"], l["body"], F.lit(END))), "").alias("text"),
        walked["spans"].alias("mask"),
    )
