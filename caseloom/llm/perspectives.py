"""Multi-party perspective rotation of dialogues, in DataFrame functions only.

For every participant the dialogue is rendered once with that participant as the assistant
and all others as users under their names; the mask marks what the assistant says.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from caseloom.session import store

OPEN, CLOSE, END = "<|", "|>", "<|end|>"
UNKNOWN = "unknown"
TURNS_PER_PART = 256


def escaped(text: Column) -> Column:
    """Text in which no marker of the format can stand: ``<|`` becomes ``<||``, which no marker holds."""
    return F.replace(text, F.lit("<|"), F.lit("<||"))


def in_parts(rows: DataFrame, context: tuple[str, ...], size: int) -> DataFrame:
    """``rows`` (conv_id, turn, who, said) with ``part`` and ``again``: ``size`` successive turns are a part.

    ``again`` is 0 for a turn and -1 for the opening turn of a context speaker, which stands
    at the head of every later part once more.  Only conversations of more than ``size``
    turns are ranked: dealt by ranges of their turns, counted by range and numbered in it,
    so that no task ranks a whole conversation.
    """
    sizes = rows.groupBy(F.col("conv_id").alias("_conv")).agg(F.count(F.lit(1)).alias("_n"))
    long = store(sizes.where(F.col("_n") > size).select("_conv"))
    on = F.col("conv_id") == F.col("_conv")
    short = rows.join(long, on, "left_anti").select("*", F.lit(0).cast("long").alias("part"), F.lit(0).alias("again"))

    # the last key keeps even a group of equal turns from being one range
    ordered = ["turn", "who", "said", "tie"]
    dealt = rows.join(long, on, "left_semi").withColumn("tie", F.monotonically_increasing_id())
    dealt = store(dealt.repartitionByRange("conv_id", *ordered).withColumn("range", F.spark_partition_id()))
    ranges = dealt.groupBy("conv_id", "range").agg(F.count(F.lit(1)).alias("_n"))
    earlier = Window.partitionBy("conv_id").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    ranges = ranges.select("conv_id", "range", F.coalesce(F.sum("_n").over(earlier), F.lit(0)).alias("before"))
    number = F.row_number().over(Window.partitionBy("conv_id", "range").orderBy(*ordered)) - 1
    ranked = dealt.withColumn("place", number).join(ranges, ["conv_id", "range"])
    ranked = ranked.select(*rows.columns, (F.col("before") + F.col("place")).alias("rank"))
    turns = ranked.select(*rows.columns, F.floor(F.col("rank") / size).cast("long").alias("part"), F.lit(0).alias("again"))
    opening = ranked.where((F.col("rank") == 0) & F.col("who").isin(*context)).select(*rows.columns)
    later = dealt.groupBy("conv_id").agg(F.count(F.lit(1)).alias("_n")).select("conv_id", F.explode(F.sequence(F.lit(1).cast("long"), F.floor((F.col("_n") - 1) / size).cast("long"))).alias("part"))
    heads = opening.join(later, "conv_id").select(*rows.columns, "part", F.lit(-1).alias("again"))
    return short.unionByName(turns).unionByName(heads)


def rotate(
    turns: DataFrame,
    context: tuple[str, ...] = ("system",),
    turns_per_part: int = TURNS_PER_PART,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    speaker_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """One row per conversation, participant and part: ``conv_id, speaker, part, n_turns, text, mask``.

    A turn is ``<|assistant|>``, ``<|user name|>`` or ``<|system|>``, a line end, the text,
    ``<|end|>`` and a line end.  mask holds ``start:end`` of each stretch the speaker says, its
    end marker included, counted in characters of the part and joined by commas.

    Speakers named in ``context`` take no perspective and are never masked in.  A part holds
    ``turns_per_part`` successive turns, whatever their numbers, so that no conversation,
    however long, is gathered in one row; a context speaker's opening turn heads the later
    parts too and counts in their ``n_turns``.  A null speaker is called ``unknown``, a null
    text is empty and a null turn comes first; rows without a conversation go; equal turns
    are ordered by speaker and text and repeated rows are kept; texts are kept whole.  A
    conversation of context only and an empty table give no row.
    """
    rows = turns.where(F.col(conv_col).isNotNull()).select(
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).cast("long").alias("turn"),
        escaped(F.coalesce(F.col(speaker_col).cast("string"), F.lit(UNKNOWN))).alias("who"),
        escaped(F.coalesce(F.col(text_col).cast("string"), F.lit(""))).alias("said"),
    )
    names = [n for n in context]
    speakers = rows.where(~F.col("who").isin(*names) if names else F.lit(True)).select("conv_id", F.col("who").alias("speaker")).distinct()
    parts = in_parts(rows, context, turns_per_part).groupBy("conv_id", "part")
    parts = parts.agg(F.sort_array(F.collect_list(F.struct("again", "turn", "who", "said"))).alias("turns"))
    seen = parts.join(speakers, "conv_id")

    def head(who: Column) -> Column:
        mine = F.when(who == F.col("speaker"), F.lit("assistant"))
        if names:
            mine = mine.when(who.isin(*names), who)
        return F.concat(F.lit(OPEN), mine.otherwise(F.concat(F.lit("user "), who)), F.lit(CLOSE + "\n"))

    tail = F.lit(END)
    pieces = F.transform("turns", lambda t: F.struct(head(t["who"]).alias("head"), F.concat(t["said"], tail).alias("body"), (t["who"] == F.col("speaker")).alias("own")))
    text = F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit("\n"))), "")
    start = F.struct(F.lit(0).alias("at"), F.array().cast("array<string>").alias("spans"))

    def step(acc: Column, p: Column) -> Column:
        lo = acc["at"] + F.length(p["head"])
        hi = lo + F.length(p["body"])
        span = F.concat(lo.cast("string"), F.lit(":"), hi.cast("string"))
        return F.struct((hi + 1).alias("at"), F.when(p["own"], F.concat(acc["spans"], F.array(span))).otherwise(acc["spans"]).alias("spans"))

    mask = F.array_join(F.aggregate("pieces", start, step, lambda acc: acc["spans"]), ",")
    made = seen.withColumn("pieces", pieces)
    return made.select("conv_id", "speaker", "part", F.size("turns").cast("long").alias("n_turns"), text.alias("text"), mask.alias("mask"))
