"""Preference pairs as one prompt and two masked completions.

The turns that the chosen and the rejected conversation begin with alike are rendered once, as
the prompt.  What follows is rendered for each side, with the spans that a loss should look at:
what the assistant says, up to and with the end of its turn.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from tierwise.llm.frames import settled

CHOSEN, REJECTED = "chosen", "rejected"
ASSISTANT = "assistant"
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _plain(text: Column) -> Column:
    """A text that cannot open or close a turn."""
    return F.replace(F.coalesce(text, F.lit("")), F.lit("<|"), F.lit("<\\|"))


def _rendered(turn: Column) -> Column:
    return F.concat(F.lit(OPEN), turn["role"], F.lit("\n"), turn["text"], F.lit(CLOSE + "\n"))


def _text(turns: Column) -> Column:
    return F.array_join(F.transform(turns, _rendered), "")


def _spans(turns: Column) -> Column:
    """Begin and end, in code points, of what the assistant says in the rendered turns."""
    start = F.struct(
        F.lit(0).cast("long").alias("at"), F.array().cast("array<struct<start:bigint,end:bigint>>").alias("spans")
    )

    def add(state: Column, turn: Column) -> Column:
        begin = state["at"] + len(OPEN) + F.length(turn["role"]) + 1
        end = begin + F.length(turn["text"]) + len(CLOSE) + 1
        span = F.array(F.struct(begin.cast("long").alias("start"), end.cast("long").alias("end")))
        return F.struct(
            end.cast("long").alias("at"),
            F.when(turn["role"] == ASSISTANT, F.concat(state["spans"], span)).otherwise(state["spans"]).alias("spans"),
        )

    return F.aggregate(turns, start, add, lambda state: state["spans"])


def preference_pairs(turns: DataFrame, pair: str = "pair_id") -> DataFrame:
    """``pair, n_prompt_turns, prompt, chosen, rejected, chosen_spans, rejected_spans``.

    ``turns`` has ``pair``, ``side`` (chosen or rejected), ``turn``, ``role`` and ``text``; one
    result row for each pair.  Turns are ordered by number, null first, then by role and text;
    repeated turns stay.  A null role or text is empty.  Turns are alike if role and text are.
    Text that looks like the marks of a turn is broken up.  A missing side is a conversation
    without turns, and equal conversations are all prompt, so completions can be empty; spans
    are empty where the assistant says nothing.  Rows with a null pair or another side are left
    out.  A pair is held as a whole in one row, as a conversation is.
    """
    plain = F.struct("turn", _plain(F.col("role")).alias("role"), _plain(F.col("text")).alias("text"))
    side = lambda name: F.array_sort(F.collect_list(F.when(F.col("side") == name, plain)))
    both = (
        turns.where(F.col(pair).isNotNull() & F.col("side").isin(CHOSEN, REJECTED))
        .groupBy(pair)
        .agg(side(CHOSEN).alias("_c"), side(REJECTED).alias("_r"))
    )
    unnumbered = lambda c: F.transform(c, lambda t: F.struct(t["role"].alias("role"), t["text"].alias("text")))
    both = settled(both, _a=unnumbered("_c"), _b=unnumbered("_r"))
    alike = F.zip_with("_a", "_b", lambda a, b: F.coalesce(a == b, F.lit(False)))
    first = F.array_position(alike, False).cast("int")
    both = settled(both, _n=F.when(first == 0, F.size("_a")).otherwise(first - 1))
    rest = lambda c: F.slice(c, F.col("_n") + 1, F.greatest(F.size(c), F.lit(1)))
    both = settled(both, _x=rest("_a"), _y=rest("_b"))
    return both.select(
        pair,
        F.col("_n").cast("long").alias("n_prompt_turns"),
        _text(F.slice("_a", F.lit(1), F.col("_n"))).alias("prompt"),
        _text(F.col("_x")).alias("chosen"),
        _text(F.col("_y")).alias("rejected"),
        _spans(F.col("_x")).alias("chosen_spans"),
        _spans(F.col("_y")).alias("rejected_spans"),
    )
