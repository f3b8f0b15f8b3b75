"""Chat formatting with cumulative-snapshot collapse.

A chat log often holds a conversation once after every turn. Each turn gets
the hash of all turns up to it (the exclusive-or of 64-bit hashes of position,
role and text, with two seeds, so prefixes need no text to be carried). A
conversation whose last prefix is an inner prefix of another one is dropped
by an anti-join, equal conversations keep the smallest conv_id, and what
remains is rendered.

Turns are ordered by (turn, role, text), nulls first; exact repeats of a row
are one turn. Running hashes are taken in two levels, within blocks of
``BLOCK`` turn numbers and over the blocks, so that a conversation with very
many turns is not one task's sort. Null roles render as "unknown", null texts
as empty; rows with a null conv_id belong to no conversation and are left
out; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .scratch import Scratch

BLOCK = 256


def _turn_hash(seed: int) -> Column:
    return F.xxhash64(F.lit(seed), "pos", F.col("role").isNull(), F.coalesce("role", F.lit("")), F.col("text").isNull(), F.coalesce("text", F.lit("")))


def prefix_hashes(turns: DataFrame) -> DataFrame:
    """conv_id, turn, role, text, pos (from 1), p1, p2 (hashes of the first ``pos`` turns)."""
    order = [F.asc_nulls_first("turn"), F.asc_nulls_first("role"), F.asc_nulls_first("text")]
    t = turns.select("conv_id", "turn", F.col("role").cast("string").alias("role"), F.col("text").cast("string").alias("text")).where("conv_id is not null").distinct()
    t = t.withColumn("block", F.floor(F.col("turn") / BLOCK))
    inner = Window.partitionBy("conv_id", "block").orderBy(*order)
    upto = inner.rowsBetween(Window.unboundedPreceding, 0)
    over = Window.partitionBy("conv_id").orderBy(F.asc_nulls_first("block"))
    before = over.rowsBetween(Window.unboundedPreceding, -1)
    numbered = t.withColumn("in", F.row_number().over(inner))
    sizes = t.groupBy("conv_id", "block").agg(F.count(F.lit(1)).alias("n")).select("conv_id", "block", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("ahead"))

    def same(a: str, b: str) -> Column:
        return (F.col(f"{a}.conv_id") == F.col(f"{b}.conv_id")) & F.col(f"{a}.block").eqNullSafe(F.col(f"{b}.block"))
    placed = (numbered.alias("t").join(sizes.alias("s"), same("t", "s")).select("t.*", (F.col("s.ahead") + F.col("t.in")).alias("pos"))
              .withColumn("h1", _turn_hash(1)).withColumn("h2", _turn_hash(2)))
    run = placed.withColumn("i1", F.bit_xor("h1").over(upto)).withColumn("i2", F.bit_xor("h2").over(upto))
    sums = placed.groupBy("conv_id", "block").agg(F.bit_xor("h1").alias("x1"), F.bit_xor("h2").alias("x2")).select(
        "conv_id", "block", F.coalesce(F.bit_xor("x1").over(before), F.lit(0)).alias("b1"), F.coalesce(F.bit_xor("x2").over(before), F.lit(0)).alias("b2"))
    return run.alias("t").join(sums.alias("s"), same("t", "s")).select(
        "t.conv_id", "turn", "role", "text", "pos", F.col("i1").bitwiseXOR(F.col("b1")).alias("p1"), F.col("i2").bitwiseXOR(F.col("b2")).alias("p2"))


def maximal_conversations(turns: DataFrame) -> DataFrame:
    """The conversations that no longer one begins with: conv_id, n_turns, n_copies, and their turns as an ordered array."""
    scratch = Scratch(turns.sparkSession, "conversations")
    rows = scratch.keep(prefix_hashes(turns), "prefixes")
    ends = rows.groupBy("conv_id").agg(F.max(F.struct("pos", "p1", "p2")).alias("e")).select("conv_id", "e.pos", "e.p1", "e.p2")
    ends = scratch.keep(ends, "ends")
    whole = ends.groupBy("pos", "p1", "p2").agg(F.min("conv_id").alias("conv_id"), F.count(F.lit(1)).alias("n_copies"))
    lengths = ends.select("conv_id", F.col("pos").alias("n"))
    inner = rows.select("conv_id", "pos", "p1", "p2").join(lengths, "conv_id").where("pos < n").select("pos", "p1", "p2").distinct()
    kept = whole.join(inner, ["pos", "p1", "p2"], "left_anti").select("conv_id", F.col("pos").alias("n_turns"), "n_copies")
    said = F.struct("pos", F.coalesce("role", F.lit("unknown")).alias("role"), F.coalesce("text", F.lit("")).alias("text"))
    return (rows.join(kept, "conv_id").groupBy("conv_id", "n_turns", "n_copies").agg(F.array_sort(F.collect_list(said)).alias("turns")))


def render_chats(turns: DataFrame, begin: str = "<|im_start|>", end: str = "<|im_end|>") -> DataFrame:
    """conv_id, n_turns, n_copies, chat: the maximal conversations in chat markup.

    Marks inside a turn's text are taken apart (a blank after "<|"), so a text cannot open or close a turn.
    """
    def safe(x: Column) -> Column:
        return F.replace(x, F.lit("<|"), F.lit("< |"))
    shown = F.transform("turns", lambda t: F.concat(F.lit(begin), safe(t["role"]), F.lit("\n"), safe(t["text"]), F.lit(end + "\n")))
    return maximal_conversations(turns).select("conv_id", "n_turns", "n_copies", F.array_join(shown, "").alias("chat"))
