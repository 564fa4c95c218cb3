"""Chat formatting: cumulative snapshots of a conversation collapse into the longest one."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from kedai.llm.common import store

# Turns of one output row; longer conversations are rendered in parts.
PART_TURNS = 1024

# Markers of the rendered format; the same characters inside a text are parted by a blank.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _decimal(column: Column) -> Column:
    return column.cast("decimal(20,0)")


def turns_of(conversations: DataFrame) -> DataFrame:
    """Turns without repeated rows, in parts of at most ``PART_TURNS`` turn numbers, with two hashes."""
    rows = conversations.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce("role", F.lit("")).alias("role"),
        F.coalesce("text", F.lit("")).alias("text"),
    ).where("conv_id IS NOT NULL")
    part = F.coalesce(F.floor(F.col("turn") / PART_TURNS), F.lit(-(1 << 54))).cast("long")
    rows = rows.withColumn("part", part)
    order = Window.partitionBy("conv_id", "part").orderBy("turn", "role", "text")
    this = F.struct("turn", "role", "text")
    content = ("turn", "role", "text")
    return (
        rows.withColumn("again", this.eqNullSafe(F.lag(this).over(order)))
        .where(~F.col("again"))
        .drop("again")
        .withColumn("h1", _decimal(F.xxhash64(*content)))
        .withColumn("h2", _decimal(F.xxhash64(F.lit("second"), *content)))
    )


def prefixes(turns: DataFrame) -> DataFrame:
    """Rolling hashes of every conversation after each turn: conv_id, n, p1, p2.

    A prefix hash is the sum of the hashes of its turns' numbers, roles and texts. Sums run inside
    parts and over the parts' totals, so that no task holds more than a part of one conversation.
    """
    totals = turns.groupBy("conv_id", "part").agg(
        F.count("*").alias("n"), F.sum("h1").alias("s1"), F.sum("h2").alias("s2")
    )
    before = Window.partitionBy("conv_id").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    offsets = totals.select(
        "conv_id",
        "part",
        *(F.coalesce(F.sum(c).over(before), F.lit(0)).alias(f"ahead_{c}") for c in ("n", "s1", "s2")),
    )
    # Rows of one turn number enter together: a prefix ends after a whole turn.
    running = Window.partitionBy("conv_id", "part").orderBy("turn")
    inside = turns.select(
        "conv_id",
        "part",
        "turn",
        F.count("*").over(running).alias("n"),
        F.sum("h1").over(running).alias("s1"),
        F.sum("h2").over(running).alias("s2"),
    ).distinct()
    return inside.join(offsets, ["conv_id", "part"]).select(
        "conv_id",
        (F.col("n") + F.col("ahead_n")).alias("n"),
        (F.col("s1") + F.col("ahead_s1")).alias("p1"),
        (F.col("s2") + F.col("ahead_s2")).alias("p2"),
    )


def collapse(conversations: DataFrame) -> DataFrame:
    """Maximal conversations, rendered: conv_id, part, n_turns, copies, text.

    A conversation whose turns (number, role and text) are exactly the first turns of a longer one
    is a snapshot of it and goes. Of equal conversations the smallest id stays; ``copies`` counts
    them. The text of a part is its turns in order as ``<|im_start|>role``, line break, text,
    ``<|im_end|>``, line break; the parts of a conversation follow one another.

    Repeated rows count once. Rows that share a turn number are ordered by role and text, null turn
    numbers come first. Null roles and texts are empty. Rows with a null conversation id belong to no
    conversation and are left out. Extra columns are ignored; an empty table gives an empty result.
    Hashes that many conversations share (a common first turn) are combined before the shuffle.
    """
    turns = store(turns_of(conversations), "turns")
    rolling = store(prefixes(turns), "prefixes")
    whole = store(
        rolling.groupBy("conv_id").agg(F.max(F.struct("n", "p1", "p2")).alias("end")).select("conv_id", "end.*"),
        "whole",
    )
    hashes = ["n", "p1", "p2"]
    proper = (
        rolling.join(whole.select("conv_id", F.col("n").alias("length")), "conv_id")
        .where("n < length")
        .select(*hashes)
        .distinct()
    )
    longest = (
        whole.groupBy(*hashes)
        .agg(F.min("conv_id").alias("conv_id"), F.count("*").alias("copies"))
        .join(proper, hashes, "left_anti")
        .select("conv_id", F.col("n").alias("n_turns"), "copies")
    )
    plain = F.replace(F.col("text"), F.lit("<|"), F.lit("< |"))
    name = F.replace(F.col("role"), F.lit("<|"), F.lit("< |"))
    line = F.concat(F.lit(OPEN), name, F.lit("\n"), plain, F.lit(CLOSE + "\n"))
    kept = turns.join(store(longest, "longest"), "conv_id")
    ordered = F.sort_array(F.collect_list(F.struct("turn", "role", "text", line.alias("line"))))
    return (
        kept.groupBy("conv_id", "part", "n_turns", "copies")
        .agg(ordered.alias("lines"))
        .select(
            "conv_id",
            "part",
            "n_turns",
            "copies",
            F.array_join(F.transform("lines", lambda x: x["line"]), "").alias("text"),
        )
    )
