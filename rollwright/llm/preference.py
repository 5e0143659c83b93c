"""Preference pairs as prompt and masked completions.

Two conversations of a pair share their first turns up to the first that differs in role or text. These turns
are rendered once, as prompt; what follows is rendered for each side as completion. In a completion the
contents of assistant turns, each with the end mark behind it, are trained on; everything else is masked.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

OPEN, BODY, END = "<|", "|>\n", "<|end|>\n"
TURNS = "array<struct<turn:bigint,role:string,text:string>>"


def conversations(turns: DataFrame, id_column: str = "conv_id") -> DataFrame:
    """``pair_id, turns``: one row for each conversation, in turn order. A conversation is one cell.

    Null texts and roles count as ''; equal turn numbers are ordered by role and text; rows that repeat a
    turn word for word count once. Rows without an id are left out.
    """
    turn = F.struct(
        F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit("")).alias("role"), F.coalesce("text", F.lit("")).alias("text")
    )
    return turns.where(F.col(id_column).isNotNull()).groupBy(F.col(id_column).cast("long").alias("pair_id")).agg(
        F.array_sort(F.collect_set(turn)).alias("turns")
    )


def rendered(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit(BODY), turn["text"], F.lit(END))


def spans(turns: Column) -> Column:
    """Start and end (in characters) of what is trained on in the rendered turns."""
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    start = F.struct(F.lit(0).cast("long").alias("at"), none.alias("spans"))

    def step(a: Column, turn: Column) -> Column:
        head = a["at"] + F.length(turn["role"]) + len(OPEN) + len(BODY)
        end = head + F.length(turn["text"]) + len(END)
        span = F.array(F.struct(head.cast("long").alias("start"), end.cast("long").alias("end")))
        return F.struct(
            end.cast("long").alias("at"),
            F.when(turn["role"] == "assistant", F.concat(a["spans"], span)).otherwise(a["spans"]).alias("spans"),
        )

    return F.aggregate(turns, start, step, lambda a: a["spans"])


def preference_pairs(chosen: DataFrame, rejected: DataFrame) -> DataFrame:
    """``pair_id, n_prompt_turns, prompt, chosen, rejected, chosen_spans, rejected_spans``.

    Both inputs have ``pair_id, turns``; a pair that one side lacks gives no row. Equal conversations are all
    prompt, with empty completions; conversations that differ from the start have an empty prompt. An id given
    twice on one side makes a pair for each. No rows in, no rows out.
    """
    both = chosen.select("pair_id", F.col("turns").alias("c")).join(rejected.select("pair_id", F.col("turns").alias("r")), "pair_id")
    same = F.zip_with(
        "c", "r", lambda x, y: x["role"].eqNullSafe(y["role"]) & x["text"].eqNullSafe(y["text"])
    )
    first = F.array_position(same, False)
    shared = F.when(first > 0, first - 1).otherwise(F.size("c")).cast("int")
    cut = both.withColumn("n", shared).select(
        "pair_id", F.col("n").cast("long").alias("n_prompt_turns"), F.slice("c", 1, F.col("n")).alias("p"),
        F.slice("c", F.col("n") + 1, F.size("c")).alias("c"), F.slice("r", F.col("n") + 1, F.size("r")).alias("r"),
    )
    text = lambda name: F.array_join(F.transform(name, rendered), "")
    return cut.select(
        "pair_id", "n_prompt_turns", text("p").alias("prompt"), text("c").alias("chosen"), text("r").alias("rejected"),
        spans(F.col("c")).alias("chosen_spans"), spans(F.col("r")).alias("rejected_spans"),
    )


def with_weaker_reply(chosen: DataFrame) -> DataFrame:
    """Rejected sides for conversations that come without one: the last assistant turn is cut to half its words."""
    last = F.aggregate(
        F.transform("turns", lambda t, i: F.when(t["role"] == "assistant", i).otherwise(F.lit(-1))), F.lit(-1),
        lambda a, i: F.greatest(a, i),
    )
    words = lambda t: F.split(t["text"], " ")
    weaker = F.transform(
        "turns",
        lambda t, i: F.when(
            i == F.col("last"),
            F.struct(t["turn"].alias("turn"), t["role"].alias("role"), F.array_join(
                F.slice(words(t), 1, F.floor(F.size(words(t)) / 2).cast("int")), " ").alias("text")),
        ).otherwise(t),
    )
    return chosen.withColumn("last", last).select("pair_id", weaker.alias("turns"))
