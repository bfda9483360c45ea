"""Chosen and rejected conversations as one prompt and two masked completions.

The longest common prefix of turns (role and text equal) is rendered once as the prompt. What follows on either side is its
completion, and the mask lists the stretches to train on, as code points from the completion's start, end exclusive:
what the assistant wrote, with the mark that ends its turn. Two equal conversations share everything and have empty
completions.

Turns are ordered by number, then role, then text; a turn without a number comes first, a null role is rendered as ``user``,
a null text as empty. Marks inside a text are escaped, so that no text can end its turn. A pair of which one side has no turns
has an empty prompt. Repeated rows are turns of their own. A conversation is the unit of work: it is one row of the result.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from caremeld.llm.shared import col

BEGIN, END = "<|im_start|>", "<|im_end|>"
TURN = "array<struct<turn:long,role:string,text:string>>"


def conversations(turns: DataFrame, id: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """(conv_id, turns in order) for every conversation."""
    one = F.struct(
        col(turn).cast("long").alias("turn"),
        F.coalesce(col(role), F.lit("user")).alias("role"),
        F.coalesce(col(text), F.lit("")).alias("text"),
    )
    return turns.groupBy(col(id).alias("conv_id")).agg(F.array_sort(F.collect_list(one)).alias("turns"))


def common_turns(chosen: Column, rejected: Column) -> Column:
    """How many turns both sides begin with."""
    same = F.zip_with(chosen, rejected, lambda a, b: F.coalesce((a["role"] == b["role"]) & (a["text"] == b["text"]), F.lit(False)))
    return F.coalesce(F.nullif(F.array_position(same, False), F.lit(0)) - 1, F.size(same)).cast("int")


def rendered(turn: Column) -> Column:
    return F.concat(head(turn), body(turn), F.lit("\n"))


def head(turn: Column) -> Column:
    return F.concat(F.lit(BEGIN), F.replace(turn["role"], F.lit("<|"), F.lit("<\\|")), F.lit("\n"))


def body(turn: Column) -> Column:
    return F.concat(F.replace(turn["text"], F.lit("<|"), F.lit("<\\|")), F.lit(END))


def mask(turns: Column) -> Column:
    """The stretches of the rendered turns that the assistant wrote."""
    none = F.array().cast("array<struct<start:int,end:int>>")
    nothing = F.struct(F.lit(0).alias("at"), none.alias("spans"))

    def step(state: Column, turn: Column) -> Column:
        start = state["at"] + F.length(head(turn))
        end = start + F.length(body(turn))
        own = F.when(turn["role"] == "assistant", F.array(F.struct(start.alias("start"), end.alias("end"))))
        return F.struct((end + 1).alias("at"), F.concat(state["spans"], F.coalesce(own, none)).alias("spans"))

    return F.aggregate(turns, nothing, step, lambda state: state["spans"])


def format_preferences(pairs: DataFrame) -> DataFrame:
    """Adds nothing to and needs of ``pairs`` only (pair_id, chosen, rejected), both arrays of turns in order."""
    empty = F.array().cast(TURN)
    chosen, rejected = (F.coalesce(F.col(c), empty) for c in ("chosen", "rejected"))
    split = pairs.select("pair_id", chosen.alias("chosen"), rejected.alias("rejected")).withColumn(
        "n_common", common_turns(F.col("chosen"), F.col("rejected"))
    )
    rest = {c: F.slice(F.col(c), F.col("n_common") + 1, F.greatest(F.size(c) - F.col("n_common"), F.lit(0))) for c in ("chosen", "rejected")}
    whole = lambda turns: F.array_join(F.transform(turns, rendered), "")
    return split.select(
        "pair_id",
        "n_common",
        whole(F.slice(F.col("chosen"), F.lit(1), F.col("n_common"))).alias("prompt"),
        whole(rest["chosen"]).alias("chosen_completion"),
        mask(rest["chosen"]).alias("chosen_mask"),
        whole(rest["rejected"]).alias("rejected_completion"),
        mask(rest["rejected"]).alias("rejected_mask"),
    )


def swapped_replies(turns: DataFrame) -> DataFrame:
    """Pairs out of plain conversations: each is chosen over itself with its last assistant turn taken from its neighbour.

    The neighbour of an even id is the next, of an odd id the one before. What follows the last assistant turn is
    left out of the rejected side; without an own assistant turn or a neighbour's, the rejected side ends before the reply.
    """
    every = conversations(turns).where("conv_id is not null")
    replies = F.filter(F.col("turns"), lambda t: t["role"] == "assistant")
    place = F.size("turns") - F.array_position(F.transform(F.reverse("turns"), lambda t: t["role"]), "assistant").cast("int")
    known = every.select("conv_id", "turns", F.get(replies, F.size(replies) - 1).alias("reply"), place.alias("place"))
    other = known.select(F.col("conv_id").bitwiseXOR(F.lit(1)).alias("conv_id"), F.col("reply").alias("theirs"))
    taken = F.when(F.col("reply").isNotNull() & F.col("theirs").isNotNull(), F.array("theirs")).otherwise(F.array().cast(TURN))
    return known.join(other, "conv_id", "left").select(
        F.col("conv_id").alias("pair_id"),
        F.col("turns").alias("chosen"),
        F.concat(F.slice("turns", F.lit(1), F.col("place")), taken).alias("rejected"),
    )
