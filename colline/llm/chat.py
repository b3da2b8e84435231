"""Chat formatting (operator 3): cumulative snapshots collapse, then conversations are rendered.

A log often holds a conversation again and again as it grows.  The rolling hash
of a conversation's first k turns combines the hashes of (position, role, text)
one by one; a conversation whose hash over all its turns equals the hash of the
first k turns of a longer one is a snapshot of it.  Conversations that are
equal leave the one with the smallest id.  Anti-joins on (turns, hash) drop the
snapshots; only the rest is rendered.

Turns are dealt by conversation and chunk of 1024 turn numbers, so a very long
conversation is spread over many tasks: positions and hashes are first summed
by chunk, and carried into the chunks by a window over chunks.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from colline.llm.common import save

CHUNK = 1024
START, END = "<|im_start|>", "<|im_end|>"


def _turns(df: DataFrame, conv_col: str, turn_col: str, role_col: str, text_col: str) -> DataFrame:
    role, text = F.coalesce(F.col(role_col).cast("string"), F.lit("")), F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    turn = F.coalesce(F.col(turn_col).cast("bigint"), F.lit(-(2**62)))
    return df.select(
        F.col(conv_col).cast("bigint").alias("conv_id"), turn.alias("turn"), F.floor(turn / F.lit(CHUNK)).alias("chunk"),
        role.alias("role"), text.alias("text"),
    )


def _running(df: DataFrame) -> DataFrame:
    """``conv_id, k, a, b``: the rolling hashes a, b of the first k turns, for every turn."""
    rows = df.select(
        "conv_id", "turn", "chunk", F.xxhash64(F.lit(1), "role", "text").alias("x"), F.xxhash64(F.lit(2), "role", "text").alias("y")
    ).distinct()
    rows = save(rows, "chat-turns")
    chunks = rows.groupBy("conv_id", "chunk").agg(F.count(F.lit(1)).alias("n"))
    before = Window.partitionBy("conv_id").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = chunks.withColumn("first", F.coalesce(F.sum("n").over(before), F.lit(0))).drop("n")
    inside = Window.partitionBy("conv_id", "chunk").orderBy("turn", "x", "y")
    placed = _on_chunk(rows, chunks).withColumn("k", F.col("first") + F.row_number().over(inside))
    placed = placed.select(
        "conv_id", "chunk", "k", F.xxhash64("k", "x", "y").alias("a"), F.xxhash64(F.lit(7), "y", "k", "x").alias("b")
    )
    placed = save(placed, "chat-places")
    sums = placed.groupBy("conv_id", "chunk").agg(F.bit_xor("a").alias("a0"), F.bit_xor("b").alias("b0"))
    carry = sums.select(
        "conv_id", "chunk", *[F.coalesce(F.bit_xor(c).over(before), F.lit(0)).alias(c) for c in ("a0", "b0")]
    )
    upto = Window.partitionBy("conv_id", "chunk").orderBy("k").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return _on_chunk(placed, carry).select(
        "conv_id", "k", *[F.col(f"{c}0").bitwiseXOR(F.bit_xor(c).over(upto)).alias(c) for c in ("a", "b")]
    )


def _on_chunk(rows: DataFrame, chunks: DataFrame) -> DataFrame:
    chunks = chunks.withColumnRenamed("conv_id", "_conv").withColumnRenamed("chunk", "_chunk")
    same = F.col("conv_id").eqNullSafe(F.col("_conv")) & (F.col("chunk") == F.col("_chunk"))
    return rows.join(chunks, same).drop("_conv", "_chunk")


def maximal_conversations(
    df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``conv_id, n_turns`` of the conversations that are no prefix of a longer one, one of equal ones."""
    running = save(_running(_turns(df, conv_col, turn_col, role_col, text_col)), "chat-running")
    last = running.groupBy("conv_id").agg(F.max(F.struct("k", "a", "b")).alias("z")).select("conv_id", "z.k", "z.a", "z.b")
    last = save(last, "chat-last")
    ids = last.groupBy("k", "a", "b").agg(F.min("conv_id").alias("conv_id"))
    lengths = last.select(F.col("conv_id").alias("_conv"), F.col("k").alias("_n"))
    prefixes = running.join(lengths, F.col("conv_id").eqNullSafe(F.col("_conv"))).where("k < _n").select("k", "a", "b").distinct()
    return ids.join(prefixes, ["k", "a", "b"], "left_anti").select("conv_id", F.col("k").alias("n_turns"))


def rendered_turn(role: Column, text: Column) -> Column:
    return F.concat(F.lit(START), role, F.lit("\n"), text, F.lit(END), F.lit("\n"))


def chat_documents(
    df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """``conv_id, part, n_turns, text``: the maximal conversations, rendered in the order of their turns.

    A part holds the turns of one chunk of turn numbers (0 to 1023 is part 0),
    so that no row gathers an unbounded conversation.  A turn logged twice with
    the same content counts once; turns of one number stand in the order of
    their content's hash.  Null turn numbers come first, null roles and texts
    are empty, and rows with a null id are one conversation with a null id.
    Other columns are not read; an empty table gives an empty result.  Equality
    of prefixes is that of 128-bit hashes.
    """
    kept = save(maximal_conversations(df, conv_col, turn_col, role_col, text_col), "chat-kept")
    kept = kept.withColumnRenamed("conv_id", "_conv")
    turns = _turns(df, conv_col, turn_col, role_col, text_col)
    turns = turns.withColumn("x", F.xxhash64(F.lit(1), "role", "text")).withColumn("y", F.xxhash64(F.lit(2), "role", "text"))
    turns = turns.groupBy("conv_id", "turn", "chunk", "x", "y").agg(F.first(rendered_turn(F.col("role"), F.col("text"))).alias("piece"))
    turns = turns.join(kept, F.col("conv_id").eqNullSafe(F.col("_conv")))
    parts = turns.groupBy("conv_id", "chunk", "n_turns").agg(
        F.sort_array(F.collect_list(F.struct("turn", "x", "y", "piece"))).alias("pieces")
    )
    return parts.select("conv_id", F.col("chunk").alias("part"), "n_turns", F.array_join("pieces.piece", "").alias("text"))
